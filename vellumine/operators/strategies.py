"""Extraction strategies as dataflow: expand, infer, parse, merge, and again on a subset."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vellumine.functions import records
from vellumine.functions.scoring import CRITICAL, VOTED, confidence, missing_critical, variances, vote_key
from vellumine.functions.text import blank
from vellumine.operators import chunking
from vellumine.operators.inference import Sampling, infer
from vellumine.operators.merging import merged_record, merged_records
from vellumine.session import cut

TEMPLATE = "Extract the bibliographic fields of this text as JSON:\n{text}"
#: Put behind the prompt of a second pass; fixed value.
CORRECTION = "\n\nCorrection mode: Re-check missing/uncertain fields and date consistency against the text. Output only corrected JSON.\n"
#: Names of the merge rules where no policy applies; fixed values.
BY_FIELD, SINGLE = "legacy_baseline", "n/a_single"
_ERRORS = ("error", "error_type", "error_detail")


@dataclass(frozen=True)
class Extraction:
    """What a strategy runs with.

    fallback: documents that the strategy fails on get the baseline's answer.
    """

    backend: str = "echo"
    chunks: chunking.Chunking = chunking.Chunking()
    template: str = TEMPLATE
    policy: str = "prefer_non_null"
    threshold: float = 0.6
    rounds: int = 2
    round_temperature: float = 0.2
    sampling: Sampling = Sampling()
    batch: int = 32
    fallback: bool = False


def _pass(docs: DataFrame, c: Extraction, policy: str | None = None, suffix: str = chunking.JSON_SUFFIX, chunks: chunking.Chunking | None = None, sampling: Sampling | None = None) -> DataFrame:
    """One pass over the documents: id, record, errors, chunks_count, raw_output, merge_policy_used.

    The answers are the only thing written. A document's prompts are merged by ``policy``, or
    by the rules of each field; the first error stands where no prompt succeeded. An answer
    that is no valid record counts as an empty one.
    """
    rows = chunking.prompt_rows(docs, "id", "text", chunks or c.chunks).withColumn("prompt", F.concat(chunking.rendered(c.template, "body"), F.lit(suffix)))
    answered = infer(rows.select("id", "candidate_order", "in_chunks", "prompt"), "prompt", c.backend, c.batch, sampling or c.sampling)
    found = records.with_validated(answered.withColumn("_json", records.json_of("answer")), "_json", "record")
    one = F.struct(F.col("candidate_order").alias("o"), F.when(F.col("error").isNull(), F.coalesce("record", records.empty())).alias("r"), *_ERRORS, "answer")
    gathered = found.groupBy("id").agg(F.array_sort(F.collect_list(one)).alias("all"), F.max("in_chunks").alias("in_chunks"))
    good = F.transform(F.filter("all", lambda x: x["error"].isNull()), lambda x: x["r"])
    failed = F.when(F.size(good) == 0, F.get(F.filter("all", lambda x: x["error"].isNotNull()), F.lit(0)))
    return gathered.select(
        "id", merged_record(good, policy).alias("record"), *[failed[e].alias(e) for e in _ERRORS], F.size("all").alias("chunks_count"),
        F.to_json(F.transform(F.filter("all", lambda x: x["error"].isNull()), lambda x: x["answer"])).alias("raw_output"),
        F.when(F.col("in_chunks"), F.lit(policy or BY_FIELD)).otherwise(F.lit(SINGLE)).alias("merge_policy_used"),
    )


def _told(df: DataFrame, policy: Column, **more: Column) -> DataFrame:
    """df with all columns of a strategy's result; those not given have their plain values."""
    plain = {
        "was_rerun": F.lit(False), "pass_count": F.col("chunks_count"), "header_first_used": F.lit(False), "fallback_to_full": F.lit(None).cast("boolean"),
        "merge_policy_used": policy, "self_consistency_n_used": F.lit(1), "self_consistency_variance": F.lit(None).cast("double"),
        "self_consistency_variance_by_field": F.lit(None).cast("map<string,double>"),
    } | more
    return df.select("id", "record", *_ERRORS, F.col("chunks_count").cast("int"), "raw_output", *[v.alias(n) for n, v in plain.items()])


def baseline(docs: DataFrame, c: Extraction) -> DataFrame:
    """One pass; long texts in chunks, merged by the rules of each field."""
    return _told(_pass(docs, c), F.col("merge_policy_used"))


def chunked(docs: DataFrame, c: Extraction) -> DataFrame:
    """Always in chunks, merged under the policy."""
    return _told(_pass(docs, c, c.policy, chunks=dataclasses.replace(c.chunks, mode="chunked")), F.lit(c.policy))


def _second(first: DataFrame, docs: DataFrame, c: Extraction, suffix: str, names: tuple[str, str]) -> DataFrame:
    """first (with a column ``again``) and, where that holds, a second pass merged into it under the policy.

    One good answer of the two stays as it is; without any, the second pass's error stands.
    """
    todo = docs.join(first.filter("again").select("id"), "id", "left_semi")
    second = _pass(todo, c, suffix=suffix).select("id", *[F.col(n).alias(f"{n}2") for n in ("record", *_ERRORS, "chunks_count", "raw_output")])
    both = first.join(second, "id", "left")
    pair = F.filter(F.array("record", "record2"), lambda r: r.isNotNull())
    raw = F.to_json(F.struct(F.col("raw_output").alias(names[0]), F.col("raw_output2").alias(names[1])))
    return both.withColumns(
        {"record": merged_record(pair, c.policy), "raw_output": raw, "chunks1": F.col("chunks_count"), "chunks_count": F.col("chunks_count") + F.coalesce("chunks_count2", F.lit(0))}
        | {e: F.when(F.size(pair) == 0, F.coalesce(f"{e}2", e)) for e in _ERRORS}
    )


def header_first(docs: DataFrame, c: Extraction) -> DataFrame:
    """The header first, the whole text only where a critical field is missing."""
    heads = docs.withColumn("text", chunking.header("text", c.chunks))
    lacking = missing_critical({f: F.col("record")[f] for f in CRITICAL})
    first = cut(_pass(heads, c, chunks=dataclasses.replace(c.chunks, mode="single", max_chars=2**31 - 1)).withColumn("again", F.col("record").isNull() | (F.size(lacking) > 0)))
    got = _second(first, docs, c, chunking.JSON_SUFFIX, ("header", "full_text"))
    return _told(got, F.lit(c.policy), was_rerun=F.col("again"), header_first_used=F.lit(True), fallback_to_full=F.col("again"))


def two_pass(docs: DataFrame, c: Extraction) -> DataFrame:
    """A second pass with a correction where the first left low confidence."""
    scored = _pass(docs, c).join(docs.select("id", F.col("text").alias("_t")), "id")
    low = F.coalesce(confidence(F.col("record"), F.col("_t"))["confidence"], F.lit(0.0)) < c.threshold
    first = cut(scored.withColumn("again", low).drop("_t"))
    return _told(_second(first, docs, c, chunking.JSON_SUFFIX + CORRECTION, ("pass1", "pass2")), F.lit(c.policy), was_rerun=F.col("again"))


def _keys(candidates: Column, field: str) -> Column:
    """The vote keys of a field over an array of records."""
    return F.transform(candidates, lambda r: vote_key(r[field], field))


def self_consistency(docs: DataFrame, c: Extraction) -> DataFrame:
    """Several rounds, each field by vote; variance tells how far the rounds differ.

    All rounds are one model stage. A document fails only if all its rounds do; the first
    error stands then.
    """
    rounds = docs.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(c.rounds - 1)))).withColumn("id", F.struct("id", "round"))
    warm = dataclasses.replace(c.sampling, temperature=c.round_temperature, do_sample=c.round_temperature > 0 or c.sampling.do_sample)
    each = _pass(rounds, c, sampling=warm)
    one = F.struct(F.col("id.round").alias("o"), "record", *_ERRORS, "chunks_count", "raw_output")
    gathered = each.groupBy(F.col("id.id").alias("id")).agg(F.array_sort(F.collect_list(one)).alias("all"))
    good = F.transform(F.filter("all", lambda x: x["record"].isNotNull()), lambda x: x["record"])
    spread = variances({f: _keys(good, f) for f in VOTED})
    failed = F.when(F.size(good) == 0, F.get(F.filter("all", lambda x: x["error"].isNotNull()), F.lit(0)))
    told = gathered.select(
        "id", merged_record(good, "vote_majority").alias("record"), *[failed[e].alias(e) for e in _ERRORS],
        F.aggregate("all", F.lit(0), lambda n, x: n + x["chunks_count"]).alias("chunks_count"), F.to_json(F.transform("all", lambda x: x["raw_output"])).alias("raw_output"),
        F.when(F.size(good) > 0, spread["mean"]).alias("mean"), F.when(F.size(good) > 0, F.create_map(*[x for f in VOTED for x in (F.lit(f), spread[f])])).alias("fields"),
    )
    return _told(
        told, F.lit("vote_majority"), was_rerun=F.lit(c.rounds > 1), self_consistency_n_used=F.lit(c.rounds),
        self_consistency_variance=F.col("mean"), self_consistency_variance_by_field=F.col("fields"),
    )


STRATEGIES: dict[str, Callable[[DataFrame, Extraction], DataFrame]] = {
    "baseline": baseline, "chunked": chunked, "header_first": header_first, "two_pass_targeted": two_pass, "self_consistency": self_consistency,
}


def extract(docs: DataFrame, key: str, text: str, strategy: str, c: Extraction = Extraction()) -> DataFrame:
    """The record of each document: id, record, error, error_type, error_detail, confidence, subscores, and how it came about.

    An unknown strategy raises ValueError. Blank and null texts don't reach the model and give
    error empty_ocr.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; one of {', '.join(STRATEGIES)}")
    all_docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    full = all_docs.filter(~blank("text"))
    got = STRATEGIES[strategy](full, c).withColumn("strategy_used", F.lit(strategy)).withColumn("strategy_fallback_from", F.lit(None).cast("string"))
    if c.fallback and strategy != "baseline":
        got = cut(got)
        lost = full.join(got.filter("record is null").select("id"), "id", "left_semi")
        again = baseline(lost, c).withColumn("strategy_used", F.lit("baseline")).withColumn("strategy_fallback_from", F.lit(strategy))
        got = got.filter("record is not null").unionByName(again)
    parts = confidence(F.col("record"), F.col("text"))
    names = [n for n in parts if n != "confidence"]
    there = F.col("record").isNotNull()
    scored = got.join(full, "id").select(
        *got.columns, F.when(there, parts["confidence"]).otherwise(0.0).alias("confidence"), F.when(there, F.struct(*[parts[n].alias(n) for n in names])).alias("subscores")
    )
    empty = all_docs.filter(blank("text")).select("id", F.lit("empty_ocr").alias("error"), F.lit(0.0).alias("confidence"), F.lit(strategy).alias("strategy_used"))
    return scored.unionByName(empty, allowMissingColumns=True)
