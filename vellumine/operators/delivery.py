"""Results as the records that are delivered: with what is asked for, and errors as records of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vellumine.config import Profile
from vellumine.functions.text import stem

#: Columns that tell how a record came about, delivered on request. Fixed values.
META = (
    "subscores", "pass_count", "was_rerun", "chunks_count", "header_first_used", "merge_policy_used", "self_consistency_n_used",
    "fallback_to_full", "self_consistency_variance",
)


def delivered(results: DataFrame, docs: DataFrame, profile: Profile, prompt_hash: str) -> DataFrame:
    """One record a document: results (of strategies.extract) with docs (id, file_name, ocr_path, ocr_text).

    A record has its text, model and prediction; the prediction's identifier is the file's
    name up to the first underscore. An error has neither, but error, error_type and
    error_detail, and confidence 0. The prompt's id is there if it has one, META with
    save_strategy_meta, raw_output with save_raw_output.
    """
    ok = F.col("record").isNotNull()
    ident = F.substring_index(stem("file_name"), "_", 1)
    columns: dict[str, Column] = {
        "file_name": F.col("file_name"), "ocr_path": F.col("ocr_path"),
        "ocr_text": F.when(ok, F.col("ocr_text")), "model": F.when(ok, F.lit(profile.model_name)), "prediction": F.when(ok, F.col("record").withField("identifier", ident)),
        "error": F.when(~ok, F.coalesce("error", F.lit("exception: RuntimeError"))), "error_type": F.when(~ok, F.col("error_type")), "error_detail": F.when(~ok, F.col("error_detail")),
        "strategy_used": F.coalesce("strategy_used", F.lit(profile.name)), "confidence_score": F.when(ok, F.coalesce("confidence", F.lit(0.0))).otherwise(0.0), "prompt_hash": F.lit(prompt_hash),
    }
    if profile.prompt_id is not None:
        columns["prompt_id"] = F.lit(profile.prompt_id)
    if profile.save_strategy_meta:
        columns |= {("confidence_subscores" if n == "subscores" else n): F.when(ok, F.col(n)) for n in META if n in results.columns}
    if profile.save_raw_output:
        columns["raw_output"] = F.when(ok, F.col("raw_output"))
    kept = results.select("id", *[c for c in results.columns if c != "id"])
    return docs.select("id", "file_name", "ocr_path", "ocr_text").join(kept, "id").select("id", *[c.alias(n) for n, c in columns.items()])


def ocr_only(report: DataFrame, texts: DataFrame) -> DataFrame:
    """Records of scans that were only recognised: those with status ok that have a text.

    report needs file_name and status, texts file_name, path and ocr_text; both are matched by
    the name without its ending.
    """
    ok = report.filter(F.col("status") == "ok").select(stem("file_name").alias("_stem")).distinct()
    named = texts.withColumn("_stem", stem("file_name"))
    return named.join(ok, "_stem", "left_semi").select("file_name", F.col("path").alias("ocr_path"), F.lit("ocr_only").alias("status"), "ocr_text")


def raw_text(raw: Column | str, separator: str = "\n\n" + "=" * 40 + " CHUNK " + "=" * 40 + "\n\n") -> Column:
    """A raw answer as the text of its file: parts of a list joined by a separator, an object as JSON, a string as it is."""
    x = F.col(raw) if isinstance(raw, str) else raw
    v = F.try_parse_json(x)
    kind = F.schema_of_variant(v)
    parts = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda p: F.when(F.schema_of_variant(p) == "STRING", F.try_variant_get(p, "$", "string")).otherwise(F.to_json(p)))
    return F.when(kind.startswith("ARRAY"), F.array_join(parts, separator)).otherwise(F.coalesce(x, F.lit("")))
