"""Merging the candidate records of one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vellumine.functions import dates, entities, records
from vellumine.functions.scoring import chosen
from vellumine.functions.text import longest_filled, first_filled

_DAYS = ("application", "publication", "foreign")


def merged_record(candidates: Column, policy: str | None) -> Column:
    """One record from an ordered array of records.

    policy None: the longest title, the first classification and field, the earliest dates
    that fit, all entities. A policy: each scalar by it, dates put in order, all entities.
    What comes out is validated as an answer is: companies among the inventors move to the
    assignees, dates that were copied go, and there is no identifier. One candidate stays as
    it is; none gives null.
    """
    values = {f: candidates[f] for f in records.SCALARS}
    people = entities.companies_moved(*[entities.merged(candidates[f]) for f in ("inventors", "assignees")])
    if policy is None:
        scalars = {"title": longest_filled(values["title"])} | {f: first_filled(values[f]) for f in ("classification", "industrial_field")}
        days = [F.filter(F.transform(values[f"pub_date_{d}"], dates.iso_date), lambda x: x.isNotNull()) for d in _DAYS]
        picked = dates.earliest_consistent(*days)
    else:
        scalars = {f: chosen(values[f], policy) for f in ("title", "classification", "industrial_field")}
        picked = dates.in_order(*[dates.iso_date(chosen(values[f"pub_date_{d}"], policy)) for d in _DAYS])
    once = dates.without_duplicates(*[picked[d] for d in _DAYS])
    parts = scalars | people | {f"pub_date_{d}": once[d].cast("string") for d in _DAYS} | {"identifier": F.lit(None).cast("string")}
    names = ("title", "inventors", "assignees", *[f"pub_date_{d}" for d in _DAYS], "classification", "industrial_field", "identifier")
    whole = F.struct(*[parts[n].alias(n) for n in names]).cast(records.RECORD)
    return F.when(F.size(candidates) == 1, F.get(candidates, F.lit(0)).cast(records.RECORD)).when(F.size(candidates) > 1, whole)


def merged_records(rows: DataFrame, key: str, order: str, record: str, policy: str | None) -> DataFrame:
    """key and record, merged over each key's rows in the order of ``order``; null records don't count.

    Of rows with the same key and order the lesser record goes first.
    """
    gathered = (
        rows.filter(F.col(record).isNotNull()).groupBy(key)
        .agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(record).alias("r")))).alias("_all"))
    )
    return gathered.select(key, merged_record(F.transform("_all", lambda x: x["r"]), policy).alias(record))
