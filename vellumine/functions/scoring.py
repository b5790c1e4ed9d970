"""Choice among candidates, votes, confidence and variance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vellumine.functions import dates, entities
from vellumine.functions.text import Text, _c, lowered, strip

POLICIES = ("prefer_first", "prefer_last", "prefer_non_null", "vote_majority")
SCALARS = ("title", "classification", "industrial_field")
VOTED = ("title", "inventors", "assignees", "pub_date_application", "pub_date_publication", "pub_date_foreign", "classification", "industrial_field")
CRITICAL = ("title", "inventors", "assignees", "pub_date_application", "pub_date_publication")


def _present(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull() & (strip(v) != ""))


def vote(values: Text) -> Column:
    """The most frequent value of an ordered array, compared in lower case and single blanks.

    Ties go to the key seen first; the first value with the winning key is returned as it
    stands. Null if all are missing.
    """
    full = _present(_c(values))
    keys = F.transform(full, lowered)
    counted = F.transform(
        F.array_distinct(keys),
        lambda k: F.struct(F.size(F.filter(keys, lambda x: x == k)).alias("n"), (-F.array_position(keys, k)).alias("early")),
    )
    best = F.array_max(counted)
    return F.get(full, (-best["early"] - 1).cast("int"))


def chosen(values: Text, policy: str) -> Column:
    """One value of an ordered array of candidates under a policy."""
    v = _c(values)
    if policy == "prefer_first":
        return F.get(v, F.lit(0))
    if policy == "prefer_last":
        return F.element_at(F.when(F.size(v) > 0, v), -1)
    if policy == "prefer_non_null":
        return F.get(_present(v), F.lit(0))
    if policy == "vote_majority":
        return vote(v)
    raise ValueError(f"unknown policy {policy!r}; one of {', '.join(POLICIES)}")


def missing_critical(fields: dict[str, Column]) -> Column:
    """Names of the critical fields that are missing, in their order."""
    kinds = {"inventors": "array", "assignees": "array"}
    return F.array_compact(F.array(*[F.when(entities.missing(fields[f], kinds.get(f, "string")), F.lit(f)) for f in CRITICAL]))


def confidence(record: Column, text: Text) -> dict[str, Column]:
    """Confidence of a record and its four parts.

    0.45 completeness of the eight fields, 0.25 coherence of the dates, 0.20 quality of the
    entities, 0.10 whether the title stands in the text; between 0 and 1, six places.
    """
    filled = F.lit(0)
    for f in ("title", "pub_date_application", "pub_date_publication", "pub_date_foreign", "classification", "industrial_field"):
        filled = filled + (~entities.missing(record[f], "string")).cast("int")
    for f in ("inventors", "assignees"):
        filled = filled + (~entities.missing(record[f], "array")).cast("int")
    complete = filled / 8
    coherent = dates.coherence(*[dates.iso_date(record[f"pub_date_{d}"]) for d in ("application", "publication", "foreign")])
    quality = (entities.quality(entities.normalized(record["inventors"])) + entities.quality(entities.normalized(record["assignees"]))) / 2
    title = strip(record["title"])
    titled = F.when((title != "") & F.contains(_c(text), title), 1.0).otherwise(0.0)
    total = 0.45 * complete + 0.25 * coherent + 0.20 * quality + 0.10 * titled
    return {
        "completeness": F.round(complete, 6),
        "date_coherence": F.round(coherent, 6),
        "entity_quality": F.round(quality, 6),
        "title_in_text": titled,
        "confidence": F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)), 6),
    }


def vote_key(value: Column, field: str) -> Column:
    """The form in which values of a field are compared; null where the value is missing."""
    if field in ("inventors", "assignees"):
        whole = F.to_json(F.transform(value, lambda e: F.struct(e["address"].alias("address"), e["name"].alias("name"))), {"ignoreNullFields": "false"})
        return F.when(F.size(value) > 0, whole)
    return F.nullif(lowered(value), F.lit(""))


def variance(keys: Text) -> Column:
    """(distinct - 1) / (present - 1) of an array of vote keys; 0 with fewer than two present."""
    full = F.filter(_c(keys), lambda k: k.isNotNull() & (k != ""))
    return F.when(F.size(full) > 1, (F.size(F.array_distinct(full)) - 1) / (F.size(full) - 1)).otherwise(0.0)


def variances(keys: dict[str, Column]) -> dict[str, Column]:
    """The variance of each field's vote keys, and their mean; six places."""
    each = {f: F.round(variance(k), 6) for f, k in keys.items()}
    return each | {"mean": F.round(sum(each.values(), F.lit(0.0)) / len(each), 6)}
