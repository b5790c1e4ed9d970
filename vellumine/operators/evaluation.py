"""Scoring, joins by identifier, summaries, samples and orders over document collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vellumine.functions import text as tx
from vellumine.functions.text import Text, _c, safe_ratio
from vellumine.session import cut


def last_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """One row a key, the last in the order; null keys go. Combines before the shuffle."""
    columns = [c for c in df.columns if c != key]
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    picked = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*columns), rank).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])


def matched(gold: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    """Rows of both sides with a common key."""
    return gold.join(predicted, key)


def with_missing(gold: DataFrame, predicted: DataFrame, key: str, text: str) -> DataFrame:
    """Every gold row; without a prediction pred_missing is true and the text empty."""
    marked = predicted.withColumn("_has", F.lit(True))
    return gold.join(marked, key, "left").withColumn("pred_missing", F.col("_has").isNull()).withColumn(text, F.coalesce(text, F.lit(""))).drop("_has")


def error_rates(pairs: DataFrame, gold: str, pred: str) -> DataFrame:
    """Character and word error rates and their parts, added to pairs of texts."""
    g, p = tx.collapsed(gold), tx.collapsed(pred)
    n_words = F.when(g != "", F.size(F.split(g, " "))).otherwise(0)
    return (
        pairs.withColumn("char_dist", tx.char_distance(g, p))
        .withColumn("word_dist", tx.word_distance(g, p))
        .withColumn("cer", F.round(safe_ratio(F.col("char_dist"), F.length(g)), 6))
        .withColumn("wer", F.round(safe_ratio(F.col("word_dist"), n_words), 6))
        .withColumn("len_ratio", F.round(safe_ratio(F.length(p), F.length(g)), 6))
        .withColumn("similarity", F.round(tx.similarity(F.col("char_dist"), g, p), 6))
    )


def worst(scored: DataFrame, n: int, *order: Column) -> DataFrame:
    """The n worst rows: a report, so the limit is the feature."""
    return scored.orderBy(*order).limit(n)


def cumulated(df: DataFrame, groups: list[str], order: list[Column | str], **sums: Column) -> DataFrame:
    """df with, for each name in sums, name_upto (the sum over the group's rows up to this one) and name_all.

    The rows are sorted into ranges of (group, order); each range is summed by itself and
    shifted by the sums of the ranges before it, so no task holds more than a range, however
    large a group is. The order should be total.
    """
    keys = [f"_k{i}" for i in range(len(groups))]
    named = df.withColumns({k: F.col(g) for k, g in zip(keys, groups)} | {f"_v_{n}": c for n, c in sums.items()})
    # written once, as the ranges must be the same for the sums and for the rows
    placed = cut(named.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id()))
    totals = placed.groupBy(*keys, "_part").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    shifts = totals.select(
        *[F.col(k).alias(f"{k}_") for k in keys], F.col("_part").alias("_part_"),
        *[c for n in sums for c in (F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_b_{n}"), F.sum(f"_s_{n}").over(whole).alias(f"{n}_all"))],
    )
    same = F.col("_part") == F.col("_part_")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
    within = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.withColumns({f"_w_{n}": F.sum(f"_v_{n}").over(within) for n in sums}).join(shifts, same)
    return joined.select(*df.columns, *[c for n in sums for c in ((F.col(f"_w_{n}") + F.col(f"_b_{n}")).alias(f"{n}_upto"), F.col(f"{n}_all"))])


def numbered(df: DataFrame, *order: Column | str, start: int = 1, name: str = "rank") -> DataFrame:
    """Rows with their number in an order."""
    ranked = cumulated(df, [], list(order), _r=F.lit(1).cast("bigint"))
    return ranked.select(*df.columns, (F.col("_r_upto") + (start - 1)).alias(name))


def _counted(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """The distinct values of each group with how many rows have them and how many have them or less."""
    return cumulated(df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count("*").alias("_n")), groups, [value], n=F.col("_n"))


def nearest_rank(df: DataFrame, group: str, value: str, quantiles: dict[str, float]) -> DataFrame:
    """The value at position round((n - 1) q), half to even, of each group's sorted values.

    Positions come from counts of equal values, so a group's rows are never gathered.
    """
    picks = [F.min(F.when(F.col("n_upto") > F.bround((F.col("n_all") - 1) * F.lit(q)), F.col(value))).alias(name) for name, q in quantiles.items()]
    return _counted(df, [group], value).groupBy(group).agg(*picks)


def medians(df: DataFrame, groups: list[str], values: list[str]) -> DataFrame:
    """The groups with the median of each value, as value_median; the mean of both middle values where there are two.

    Without groups one row. Counts of equal values, not the rows, are put in order.
    """
    if not groups:
        return medians(df.withColumn("_one", F.lit(1)), ["_one"], values).drop("_one")
    out = None
    for v in values:
        lower, upper = ((F.min(F.when(F.col("n_upto") > F.floor((F.col("n_all") - 1 + k) / 2), F.col(v)))) for k in (0, 1))
        one = _counted(df.select(*groups, v), groups, v).groupBy(*groups).agg(((lower + upper) / 2).alias(f"{v}_median"))
        out = one if out is None else out.join(one, groups, "full_outer")
    return out


def presence_by_field(items: DataFrame, run: str, key: str, field: str, present: Text, score: Text) -> DataFrame:
    """By run, document and field: items that could be judged, items present, rate, sum and mean of scores.

    A row for each field of a document, also without an item; rates of none are null.
    """
    n, there = F.count(_c(score)), F.count_if(_c(score).isNotNull() & _c(present))
    total = F.coalesce(F.sum(_c(score)), F.lit(0.0))
    return items.groupBy(run, key, field).agg(
        n.alias("n_items"), there.alias("n_present"), F.round(F.when(n > 0, there / n), 6).alias("presence_rate"),
        F.round(total, 6).alias("score_sum"), F.round(F.when(n > 0, total / n), 6).alias("score_mean"),
    )


def presence_by_document(fields: DataFrame, run: str, key: str) -> DataFrame:
    """By run and document, over the rows of presence_by_field: items, items present, their share, mean score."""
    n, there, total = F.sum("n_items"), F.sum("n_present"), F.sum("score_sum")
    return fields.groupBy(run, key).agg(
        n.alias("n_items"), there.alias("n_present"), F.round(F.when(n > 0, there / n), 6).alias("presence"), F.round(F.when(n > 0, total / n), 6).alias("score")
    )


def presence_summary(fields: DataFrame, run: str, field: str, labels: dict[str, str]) -> DataFrame:
    """By run and field, over the rows of presence_by_field: sums, rates of the sums and the field's label."""
    n, there, total = F.sum("n_items"), F.sum("n_present"), F.sum("score_sum")
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])[F.col(field)]
    return fields.groupBy(run, field).agg(
        n.alias("n_items"), there.alias("n_present"), F.round(F.when(n > 0, there / n), 6).alias("presence_rate"), F.round(F.when(n > 0, total / n), 6).alias("score_mean")
    ).withColumn("label", label)


def ecdf(df: DataFrame, group: str, value: str, tie: str) -> DataFrame:
    """Each row's share (i + 1) / n of its group's rows, in the order of the value."""
    ranked = cumulated(df, [group], [value, tie], _r=F.lit(1).cast("bigint"))
    return ranked.select(*df.columns, F.round(F.col("_r_upto") / F.col("_r_all"), 6).alias("ecdf"))


def running_mean(df: DataFrame, group: str, value: str, every: int, *order: Column | str) -> DataFrame:
    """Mean of all values up to every ``every``-th row of a group's order."""
    summed = cumulated(df, [group], list(order), _r=F.lit(1).cast("bigint"), _m=F.col(value).cast("double"))
    return summed.filter(F.col("_r_upto") % every == 0).select(group, F.col("_r_upto").cast("int").alias("n"), F.round(F.col("_m_upto") / F.col("_r_upto"), 6).alias("running_avg"))


def first_seen(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The distinct keys with the row in which each was seen first; null keys go."""
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(rank).alias("first")).select(key, *[F.col(f"first.o{i}").alias(f"first_{i}") for i in range(len(order))])


def request_timing() -> dict[str, Column]:
    """Durations of a request from its times, floored at 0; null where a time is missing or out of order."""
    def at(name: str) -> Column:
        return F.greatest(F.col(name), F.lit(0.0))

    def span(a: str, b: str) -> Column:
        return F.when(F.col(a).isNotNull() & F.col(b).isNotNull() & (at(b) >= at(a)), F.round(at(b) - at(a), 6))

    def own(name: str) -> Column:
        return F.when(F.col(name).isNotNull(), F.round(at(name), 6))

    return {
        "t_request": span("arrival_time", "finished_time"),
        "t_ttft": span("arrival_time", "first_token_time"),
        "t_decode": span("first_token_time", "finished_time"),
        "t_queue": F.coalesce(own("time_in_queue"), span("arrival_time", "first_scheduled_time")),
        "t_scheduler": own("scheduler_time"),
        "t_model_forward": own("model_forward_time"),
        "t_model_execute": own("model_execute_time"),
    }


def batch_rollup(df: DataFrame, doc: str, batch: Text, sums: list[str], shared: str, parts: list[str]) -> DataFrame:
    """By document: the sums of its requests' times, the shared time of its batches, and the total.

    Of the shared time the most in each batch counts, then the sum over batches. The total is
    the sum of the ``parts`` of the sums, or the shared time where they are nothing. Negative
    times count as 0.
    """
    floored = df.select(doc, _c(batch).alias("_b"), *[F.when(F.col(c).isNotNull(), F.greatest(F.col(c), F.lit(0.0))).alias(c) for c in dict.fromkeys([*sums, shared])])
    per_batch = floored.groupBy(doc, "_b").agg(*[F.sum(c).alias(f"_s_{c}") for c in sums], F.max(shared).alias("_shared"))
    by_doc = per_batch.groupBy(doc).agg(*[F.round(F.sum(f"_s_{c}"), 6).alias(c) for c in sums], F.round(F.sum("_shared"), 6).alias("t_shared"))
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in parts), F.lit(0.0))
    return by_doc.withColumn("t_total", F.when(total > 0, F.round(total, 6)).otherwise(F.col("t_shared")))


def compared(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pairs of texts with exact_equal, normal_equal (single blanks, ends stripped), ratio, and both lengths."""
    x, y = tx.collapsed(a), tx.collapsed(b)
    return pairs.withColumns({
        "exact_equal": F.col(a) == F.col(b), "normal_equal": x == y,
        "ratio": F.when(x == y, 1.0).otherwise(F.round(tx.matching_ratio(x, y), 6)), "length_a": F.length(a), "length_b": F.length(b),
    })


def comparison_summary(rows: DataFrame, seconds: str | None = None) -> DataFrame:
    """One row: pairs, those equal exactly and in normal form, and seconds a pair."""
    timed = [F.round(F.sum(seconds) / F.count("*"), 3).alias("seconds_each")] if seconds else []
    return rows.agg(F.count("*").alias("n"), F.count_if("exact_equal").alias("exact_equal"), F.count_if("normal_equal").alias("normal_equal"), *timed)


def chosen_file(wanted: DataFrame, key: str, better: DataFrame, worse: DataFrame) -> DataFrame:
    """wanted with the path of each key in ``better``, else in ``worse`` (key, path); source names the one, missing where there is none."""
    one, two = (x.groupBy(key).agg(F.min("path").alias(n)) for x, n in ((better, "_better"), (worse, "_worse")))
    joined = wanted.join(one, key, "left").join(two, key, "left")
    source = F.when(F.col("_better").isNotNull(), "better").when(F.col("_worse").isNotNull(), "worse").otherwise("missing")
    return joined.select(*wanted.columns, F.coalesce("_better", "_worse").alias("path"), source.alias("source"))


def with_texts(report: DataFrame, texts: DataFrame, path: str) -> DataFrame:
    """report with has_text: whether its path is among the texts' paths."""
    known = texts.select(F.col("path").alias("_path")).distinct().withColumn("_there", F.lit(True))
    return report.join(known, F.col(path) == F.col("_path"), "left").withColumn("has_text", F.coalesce("_there", F.lit(False))).drop("_path", "_there")


def summary(df: DataFrame, values: list[str], among: Column | None = None, prefix: str = "") -> list[Column]:
    """Mean, least and most of columns, over all rows or those where ``among`` holds; see medians for the rest."""
    out = []
    for v in values:
        x = F.col(v) if among is None else F.when(among, F.col(v))
        for name, f in (("mean", F.avg), ("min", F.min), ("max", F.max)):
            out.append(F.round(f(x).cast("double"), 6).alias(f"{prefix}{v}_{name}"))
    return out


def reconciled(expected: DataFrame, found: DataFrame, group: str, key: str) -> DataFrame:
    """By group: expected, found, present (both), missing and extra keys."""
    e = expected.select(group, key).distinct().withColumn("_e", F.lit(1))
    f = found.select(group, key).distinct().withColumn("_f", F.lit(1))
    both = e.join(f, [group, key], "full_outer")
    has_e, has_f = F.col("_e").isNotNull(), F.col("_f").isNotNull()
    return both.groupBy(group).agg(
        F.count_if(has_e).alias("expected"), F.count_if(has_f).alias("found"), F.count_if(has_e & has_f).alias("present"),
        F.count_if(has_e & ~has_f).alias("missing"), F.count_if(~has_e & has_f).alias("extra"),
    )


def evenly_spaced(ids: DataFrame, key: str, *order: Column | str, count: int) -> DataFrame:
    """``count`` of the ids at even distances in the order; an error if there are fewer.

    Positions are the centres of count equal stretches, half to even.
    """
    total = ids.count()
    if count > total:
        raise ValueError(f"{count} ids wanted, {total} available")
    spark = ids.sparkSession
    at = F.bround((F.col("id") + 0.5) * total / count - 0.5).cast("int")
    wanted = spark.range(count).select((F.col("id") + 1).cast("int").alias("sample_rank"), (F.least(F.greatest(at, F.lit(0)), F.lit(total - 1)) + 1).alias("_at"))
    return numbered(ids.select(key), *order, name="_at").join(F.broadcast(wanted), "_at").select("sample_rank", key)


def resumed(docs: DataFrame, done: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Documents still to do, and those skipped because their output is there."""
    return docs.join(done.select(key).distinct(), key, "left_anti"), docs.join(done.select(key).distinct(), key, "left_semi").withColumn("status", F.lit("skipped"))
