"""Date expressions: parsing, repair and search."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vellumine.functions.text import Text, _c, strip


def iso_date(x: Text) -> Column:
    """A stripped yyyy-MM-dd string as a date, else null."""
    text = strip(x)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def field_date(x: Text) -> Column:
    """ISO, else "5 Jan 1926", else null."""
    return F.coalesce(iso_date(x), F.when(_c(x).rlike(r"^\d{1,2} [A-Za-z]{3} \d{4}$"), F.try_to_date(_c(x), "d MMM yyyy")))


def without_duplicates(application: Text, publication: Text, foreign: Text) -> dict[str, Column]:
    """Of dates that were copied: application goes if it equals publication, and foreign if all are equal.

    Compares the strings as they are.
    """
    a, p, f = _c(application), _c(publication), _c(foreign)
    same = F.coalesce(a == p, F.lit(False))
    return {"application": F.when(~same, a), "publication": p, "foreign": F.when(~(same & F.coalesce(f == p, F.lit(False))), f)}


def in_order(application: Text, publication: Text, foreign: Text) -> dict[str, Column]:
    """Dates that contradict their order go, one after another.

    Application after publication, then foreign after what is left of application, then,
    without an application, foreign after publication.
    """
    a, p, f = _c(application), _c(publication), _c(foreign)
    a2 = F.when(F.coalesce(a <= p, F.lit(True)), a)
    f2 = F.when(F.coalesce(f <= a2, F.lit(True)), f)
    f3 = F.when(a2.isNotNull() | F.coalesce(f2 <= p, F.lit(True)), f2)
    return {"application": a2, "publication": p, "foreign": f3}


def coherence(application: Text, publication: Text, foreign: Text) -> Column:
    """Share of the possible order checks that hold; 0.6 if none is possible."""
    a, p, f = _c(application), _c(publication), _c(foreign)
    checks = a.isNotNull().cast("int") * p.isNotNull().cast("int") + f.isNotNull().cast("int") * a.isNotNull().cast("int")
    held = F.coalesce((a <= p).cast("int"), F.lit(0)) + F.coalesce((f <= a).cast("int"), F.lit(0))
    return F.when(checks > 0, held / checks).otherwise(0.6)


def earliest_consistent(applications: Text, publications: Text, foreigns: Text) -> dict[str, Column]:
    """One date of each kind from arrays of candidates: the earliest that fits the one before it."""
    p = F.array_min(_c(publications))
    fitting = F.array_min(F.filter(_c(applications), lambda d: d <= p))
    a = F.coalesce(fitting, F.array_min(_c(applications)))
    f = F.coalesce(F.array_min(F.filter(_c(foreigns), lambda d: d <= a)), F.array_min(_c(foreigns)))
    return {"application": a, "publication": p, "foreign": f}


#: What looks like a date: day first with points, ISO, day first with strokes, a bare year. Fixed values.
PATTERNS = (r"\b\d{1,2}\.\d{1,2}\.\d{4}\b", r"\b\d{4}-\d{2}-\d{2}\b", r"\b\d{1,2}/\d{1,2}/\d{4}\b", r"\b\d{4}\b")


def date_strings(x: Text) -> Column:
    """All that looks like a date, pattern after pattern, so years of full dates come again."""
    return F.concat(*[F.regexp_extract_all(_c(x), F.lit(p), F.lit(0)) for p in PATTERNS])


#: Names of the months in French, German, English and Italian, without accents; fixed values.
MONTHS = (
    ("janvier", "janv", "januar", "janner", "january", "gennaio", "jan"),
    ("fevrier", "fevr", "februar", "february", "febbraio", "feb"),
    ("mars", "marz", "march", "marzo", "mar"),
    ("avril", "april", "aprile", "apr"),
    ("mai", "may", "maggio"),
    ("juin", "juni", "june", "giugno", "jun"),
    ("juillet", "juli", "july", "luglio", "jul"),
    ("aout", "august", "agosto", "aug"),
    ("septembre", "sept", "september", "settembre", "sep"),
    ("octobre", "oktober", "october", "ottobre", "oct", "okt"),
    ("novembre", "november", "nov"),
    ("decembre", "dezember", "december", "dicembre", "dec", "dez"),
)


def spellings(day: Text) -> Column:
    """Spellings of a date in a search-normalised text: numeric in two orders, with month names."""
    d = _c(day)
    dd, mm, yyyy = F.dayofmonth(d).cast("string"), F.month(d).cast("string"), F.year(d).cast("string")
    d2, m2 = F.lpad(dd, 2, "0"), F.lpad(mm, 2, "0")
    names = F.element_at(F.array(*[F.array(*[F.lit(n) for n in m]) for m in MONTHS]), F.month(d))
    named = F.concat(F.transform(names, lambda n: F.concat_ws(" ", dd, n, yyyy)), F.transform(names, lambda n: F.concat_ws(" ", d2, n, yyyy)))
    numeric = F.array(F.concat_ws(" ", yyyy, m2, d2), F.concat_ws(" ", d2, m2, yyyy), F.concat_ws(" ", dd, mm, yyyy))
    return F.when(d.isNotNull(), F.array_distinct(F.concat(numeric, named)))


def date_present(normal_text: Text, raw_text: Text, day: Text) -> Column:
    """Whether one of the date's spellings stands in a text; null without a date.

    normal_text is search-normalised; raw_text is searched for dates with points or strokes.
    """
    d = _c(day)
    dd, mm, yyyy = F.dayofmonth(d).cast("string"), F.month(d).cast("string"), F.year(d).cast("string")
    d2, m2 = F.lpad(dd, 2, "0"), F.lpad(mm, 2, "0")
    mark = F.lit("[./-]")
    numeric = F.concat(F.lit(r"\b(?:"), d2, mark, m2, mark, yyyy, F.lit("|"), dd, mark, mm, mark, yyyy, F.lit("|"), yyyy, mark, m2, mark, d2, F.lit(r")\b"))
    there = F.exists(spellings(d), lambda s: F.contains(_c(normal_text), s)) | F.regexp_like(_c(raw_text), numeric)
    return F.when(d.isNotNull(), F.coalesce(there, F.lit(False)))
