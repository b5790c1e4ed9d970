"""Text expressions. Arguments are columns or column names; null in, null out unless said.

White space is every character of the Unicode property White_Space, as in (?U)\\s.
"""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, StringType

Text = Column | str


def _c(x: Text) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Trimming and normal forms --------------------------------------------------------------


#: The characters of the Unicode property White_Space; fixed values.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(x: Text) -> Column:
    """Without white space at either end."""
    return F.btrim(_c(x), F.lit(WHITE))


def blank(x: Text) -> Column:
    """Whether there is nothing but white space; null counts as blank. Stops at the first visible character."""
    return ~F.coalesce(F.rlike(_c(x), F.lit(r"(?U)\S")), F.lit(False))


def collapsed(x: Text) -> Column:
    """White space runs become one blank; ends stripped."""
    return strip(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def lowered(x: Text) -> Column:
    """Collapsed and in lower case: the key of votes and of entity names."""
    return F.lower(collapsed(x))


def lines(x: Text) -> Column:
    """The lines as Python's splitlines cuts them, without a last empty one."""
    unix = F.regexp_replace(_c(x), "\r\n", "\n")
    cut = F.split(unix, "[\n\r\u000b\u000c\u001c-\u001e\u0085  ]")
    return F.when(F.element_at(cut, -1) == "", F.slice(cut, 1, F.greatest(F.size(cut) - 1, F.lit(0)))).otherwise(cut)


def first_lines(x: Text, n: int) -> Column:
    """The first n lines, joined by line feeds."""
    return F.array_join(F.slice(lines(x), 1, n), "\n")


def first_filled(values: Text) -> Column:
    """The first element that isn't blank, stripped; null if there is none."""
    return F.get(F.filter(F.transform(_c(values), strip), lambda v: v != ""), F.lit(0))


def longest_filled(values: Text) -> Column:
    """The longest stripped element that isn't blank, the first of equally long ones."""
    full = F.filter(F.transform(_c(values), strip), lambda v: v != "")
    return F.aggregate(full, F.lit(None).cast("string"), lambda best, v: F.when(best.isNull() | (F.length(v) > F.length(best)), v).otherwise(best))


# Identifiers ----------------------------------------------------------------------------


def stem(path: Text) -> Column:
    """A path's file name without its last suffix."""
    return F.regexp_replace(F.substring_index(_c(path), "/", -1), r"\.[^.]*$", "")


def id_before_underscore(path: Text) -> Column:
    return F.substring_index(stem(path), "_", 1)


def id_without_full(path: Text) -> Column:
    return F.regexp_replace(stem(path), "_full$", "")


def number_in_id(ident: Text) -> Column:
    """The number of an identifier like CH-20123-A, for sorting; null if there is none."""
    return F.nullif(F.regexp_extract(_c(ident), r"^[A-Z]{2}-(\d+)-", 1), F.lit("")).try_cast("int")


# Cues and tokens ------------------------------------------------------------------------

#: Patterns that tell a company, on lower-case names; fixed values.
COMPANY_PATTERNS = (r"\&", r"\bund\b", r"\bet\b", r"\bgmbh\b", r"\bag\b", r"\bsa\b", r"\bco\.", r"\bkg\b", r"\bltd\b", r"\binc\b", r"\bcorp\b", r"\bs\.a\.", r"\bs\.r\.l\.")


def is_company(name: Text) -> Column:
    """A company by its words, or by more than 60 % capitals among the letters; null is none."""
    letters = F.regexp_replace(_c(name), r"\P{L}", "")
    capitals = F.regexp_replace(_c(name), r"\P{Lu}", "")
    return F.coalesce(F.lower(_c(name)).rlike("|".join(COMPANY_PATTERNS)) | ((F.length(letters) > 0) & (F.length(capitals) > F.length(letters) * 0.6)), F.lit(False))


def search_tokens(normal: Text) -> Column:
    """Tokens of a normalised text that have a digit or three characters."""
    return F.filter(F.split(_c(normal), " "), lambda t: t.rlike("[0-9]") | (F.length(t) >= 3))


def distinct_tokens(normal: Text) -> Column:
    return F.array_sort(F.array_distinct(search_tokens(normal)))


#: What announces a classification, alone and with its number on the same line; fixed values.
CLASS_CUE = r"(?i)\b(?:klasse|classe|class(?:ification)?|int\.?\s*cl\.?)\b"
CLASS_INLINE = r"(?i)\b(?:klasse|classe|class(?:ification)?|int\.?\s*cl\.?)\b[^\n]{0,48}?\d{1,3}\s*[a-z]?\b"
#: What tells of inventors who apply themselves, beside "anmelder"; fixed values.
SELF_CUES = ("ist als erfinder genannt worden", "als erfinder benannt", "ist als erfinder benannt")


def has_class_cue(x: Text) -> Column:
    """Whether a classification with its number stands in the text; false for null."""
    return F.coalesce(_c(x).rlike(CLASS_INLINE), F.lit(False))


def class_snippets(x: Text) -> Column:
    """Lines with a classification cue and a digit, first seen; else the places inside lines."""
    full = F.filter(F.transform(lines(x), strip), lambda v: v.rlike(CLASS_CUE) & v.rlike(r"\d"))
    inline = F.filter(F.transform(F.regexp_extract_all(_c(x), F.lit(CLASS_INLINE), F.lit(0)), strip), lambda v: v != "")
    return F.array_distinct(F.when(F.size(full) > 0, full).otherwise(inline))


def self_applicant_cue(x: Text) -> Column:
    low = F.lower(_c(x))
    any_phrase = F.lit(False)
    for phrase in SELF_CUES:
        any_phrase = any_phrase | low.contains(phrase)
    return F.coalesce(low.contains("anmelder") & any_phrase, F.lit(False))


# Measures -------------------------------------------------------------------------------


def safe_ratio(part: Text, whole: Text) -> Column:
    """part / whole, null unless whole is positive."""
    return F.when(_c(whole) > 0, _c(part) / _c(whole))


def proxies(x: Text, cut_lines: Text | None = None) -> dict[str, Column]:
    """Measures of a text without a reference: characters, lines, empty lines, mean line length.

    cut_lines: a column that holds ``lines(x)``, so that the text is cut but once.
    """
    every = lines(x) if cut_lines is None else _c(cut_lines)
    sums = F.aggregate(
        every,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("chars")),
        lambda a, v: F.when(v.rlike(r"(?U)\S"), F.struct((a["n"] + 1).alias("n"), (a["chars"] + F.length(v)).alias("chars"))).otherwise(a),
    )
    return {
        "n_chars": F.length(_c(x)).cast("bigint"),
        "n_lines": sums["n"].cast("bigint"),
        "n_empty_lines": (F.size(every) - sums["n"]).cast("bigint"),
        "avg_line_len": F.round(F.coalesce(safe_ratio(sums["chars"], sums["n"]), F.lit(0.0)), 6),
    }


#: Letters of the frequency profile; fixed values.
PROFILE = "ecoagpnrvthkslyq"


def letter_profile(x: Text, letters: str = PROFILE) -> list[Column]:
    """Share of each letter among the letters a to z, in percent with two places."""
    low = F.lower(_c(x))
    total = F.length(F.regexp_replace(low, "[^a-z]", ""))
    return [
        F.round(F.when(total > 0, F.length(F.regexp_replace(low, f"[^{c}]", "")) * F.lit(100.0) / total).otherwise(0.0), 2).alias(f"freq_{c}") for c in letters
    ]


def char_distance(a: Text, b: Text) -> Column:
    return F.levenshtein(_c(a), _c(b)).cast("bigint")


def word_distance(a: Text, b: Text) -> Column:
    """Levenshtein distance over words (split at blanks).

    Each distinct word of the pair becomes one UTF-16 unit, so the built-in character
    distance counts words. Holds for up to 55,000 distinct words a pair.
    """
    left, right = F.split(_c(a), " "), F.split(_c(b), " ")
    words = F.array_union(left, right)

    def coded(ws: Column) -> Column:
        units = F.transform(F.filter(ws, lambda w: w != ""), lambda w: F.lpad(F.hex(F.array_position(words, w) + 256), 4, "0"))
        return F.decode(F.unhex(F.array_join(units, "")), "UTF-16BE")

    return F.levenshtein(coded(left), coded(right)).cast("bigint")


def similarity(distance: Text, a: Text, b: Text) -> Column:
    """1 - distance / length of the longer text."""
    return 1 - _c(distance) / F.greatest(F.length(_c(a)), F.length(_c(b)), F.lit(1))


# What no built-in expresses: decomposition and matching ratios, as Arrow batches ----------


def _decomposed(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


@F.pandas_udf(StringType())
def without_accents(x: pd.Series) -> pd.Series:
    """Compatibility decomposition without the combining marks."""
    return x.map(lambda t: t if t is None or t.isascii() else _decomposed(t))


def identity_key(name: Text) -> Column:
    """Letters and digits of a name without accents and case, in single blanks."""
    return strip(F.regexp_replace(F.lower(without_accents(_c(name))), "[^a-z0-9]+", " "))


def search_normal(x: Text) -> Column:
    """As identity_key, with & read as "and"."""
    return strip(F.regexp_replace(F.replace(F.lower(without_accents(_c(x))), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


@F.pandas_udf(DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity, with its popular-element heuristic from 200 characters on."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def same_person(a: Text, b: Text, least: float = 0.92) -> Column:
    """Equal identity keys, or nearly so; empty keys are no one."""
    x, y = identity_key(a), identity_key(b)
    return F.coalesce((x != "") & (y != "") & ((x == y) | (matching_ratio(x, y) >= least)), F.lit(False))


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    row = (1 << len(a)) - 1
    for c in b:
        u = row & masks.get(c, 0)
        row = (row + u) | (row - u)
    return sum(not row >> i & 1 for i in range(len(a)))


def indel_percent(a: str, b: str) -> float:
    """Normalised insertion-deletion similarity, 0 to 100.

    >>> indel_percent("Kolben", "Kolbens"), indel_percent("ab", "cd")
    (92.3076923076923, 0.0)
    """
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * _common(a, b) / total


def _token_found(token: str, tokens: list[str], known: set[str], least: float) -> bool:
    if token in known:
        return True
    return len(token) >= 4 and any(abs(len(token) - len(t)) <= len(token) and indel_percent(token, t) >= least for t in tokens)


def phrase_score(normal_text: Text, normal_phrase: Text, least: float = 88.0) -> Column:
    """1 if the phrase stands in the text, else the share of its tokens found, nearly or exactly.

    Both arguments are normalised texts. Null if the phrase has no token to look for.
    """

    @F.pandas_udf("double")
    def score(text: pd.Series, phrase: pd.Series) -> pd.Series:
        out: list[float | None] = []
        for t, p in zip(text, phrase):
            if t is None or not p:
                out.append(None)
            elif p in t:
                out.append(1.0)
            else:
                wanted = [w for w in p.split(" ") if len(w) >= 3 or any(c.isdigit() for c in w)]
                tokens = list(dict.fromkeys(w for w in t.split(" ") if len(w) >= 3 or any(c.isdigit() for c in w)))
                known = set(tokens)
                out.append(sum(_token_found(w, tokens, known, least) for w in wanted) / len(wanted) if wanted else None)
        return pd.Series(out, dtype="float64")

    return score(_c(normal_text), _c(normal_phrase))


def phrase_present(score: Text, n_tokens: Text) -> Column:
    """Whether enough of a phrase is there: all of one token, two thirds of three, else 3/4; null without a score."""
    least = F.when(_c(n_tokens) <= 1, 1.0).when(_c(n_tokens) <= 3, 2 / 3).otherwise(0.75)
    return _c(score) >= least


def classification_present(normal_text: Text, normal_value: Text) -> Column:
    """Whether a classification stands in a text, both in search form; null for an empty one."""
    return F.when(_c(normal_value) != "", F.contains(_c(normal_text), _c(normal_value)))


def printed(x: Text, places: int = 4) -> Column:
    """A number with so many places, NA for null."""
    return F.coalesce(F.format_string(f"%.{places}f", _c(x).cast("double")), F.lit("NA"))


def languages(x: Text) -> Column:
    """The languages of a comma separated list, stripped, blank ones left out; null if there is none."""
    found = F.filter(F.transform(F.split(_c(x), ","), strip), lambda v: v != "")
    return F.when(F.size(found) > 0, found)
