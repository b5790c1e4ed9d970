"""Bounded samples that don't depend on partitions or order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SCALE = 1 << 30


def bounded(rows: DataFrame, text: str, most: int, group: Column | None = None) -> list[tuple]:
    """(group, text) of at most ``most`` different texts of each group, chosen by the texts' hashes.

    The share of the hashes that is taken follows from the groups' row counts, so each task
    passes on but a few texts; equal texts are one. Null and empty texts are left out.
    """
    group = F.lit(0) if group is None else group
    keyed = rows.filter(F.length(text) > 0).select(group.alias("g"), F.col(text).alias("t")).filter("g is not null")
    counts = {r["g"]: r["n"] for r in keyed.groupBy("g").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, int(min(1.0, 1.3 * most / n + 1e-9) * _SCALE))])
    hashed = keyed.withColumn("h", F.xxhash64("t"))
    taken = hashed.filter(F.pmod("h", F.lit(_SCALE)) < share[F.col("g")]).groupBy("g", "h").agg(F.first("t").alias("t"))
    by: dict = {}
    for r in sorted(taken.collect(), key=lambda r: (str(r["g"]), r["h"])):
        by.setdefault(r["g"], []).append((r["g"], r["t"]))
    return [x for group_rows in by.values() for x in group_rows[:most]]
