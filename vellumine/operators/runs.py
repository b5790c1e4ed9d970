"""Whole runs: a folder of scans to texts and a report, a folder of texts to delivered records."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from vellumine.config import Profile
from vellumine.functions.text import stem
from vellumine.operators import chunking, delivery, inference, pages, strategies
from vellumine.session import cut
from vellumine.sources import readers, writers


def extraction_of(profile: Profile, backend: str, template: str = strategies.TEMPLATE, fallback: bool = False) -> strategies.Extraction:
    """What a strategy runs with, from a profile's settings."""
    sizes = chunking.Chunking(
        max_chars=profile.max_ocr_chars, size=profile.chunk_size_chars, overlap=profile.chunk_overlap_chars, passes=profile.extraction_passes,
        mode=profile.extraction_mode, header_lines=profile.header_lines,
    )
    return strategies.Extraction(
        backend=backend, chunks=sizes, template=template, policy=profile.merge_policy, threshold=profile.targeted_rerun_threshold, rounds=profile.self_consistency_n,
        round_temperature=profile.self_consistency_temp, sampling=inference.Sampling(profile.max_new_tokens, profile.temperature, profile.do_sample),
        batch=profile.doc_batch_size or 1 << 30, fallback=fallback,
    )


def _first(names: DataFrame, limit: int | None) -> DataFrame:
    return names if limit is None else names.orderBy("file_name").limit(limit)


def extract_texts(spark: SparkSession, texts: str, out: str, profile: Profile, backend: str, template: str = strategies.TEMPLATE, limit: int | None = None, force: bool = False) -> dict:
    """Records of the texts of a folder: predictions as JSON lines, raw answers if asked for, and run.json on the driver.

    limit: only the first so many files by name, chosen before any is read. Returns what
    run.json says.
    """
    began = datetime.now(timezone.utc)
    docs = readers.texts(spark, texts).withColumnRenamed("path", "ocr_path").withColumn("id", F.col("file_name"))
    total = docs.count()
    if limit is not None:
        docs = docs.join(F.broadcast(_first(docs.select("file_name"), limit)), "file_name", "left_semi")
    results = strategies.extract(docs, "id", "ocr_text", profile.name, extraction_of(profile, backend, template))
    digest = spark.range(1).select(chunking.prompt_identity(template)).first()[0]
    records = cut(delivery.delivered(results, docs, profile, digest).drop("id"))
    if profile.save_raw_output:
        writers.raw_outputs(records, f"{out}/raw_outputs", force=force)
    writers.json_lines(records.drop("raw_output").withColumn("_order", F.col("file_name")), f"{out}/predictions", "_order", keep_nulls=False, force=force)
    return writers.run_metadata(
        f"{out}/run.json", began, datetime.now(timezone.utc), kind="extraction", texts=texts, docs_total=total, docs_limit=limit, docs_written=records.count(),
        errors=records.filter("error is not null").count(), prompt_hash=digest, backend=backend, config=profile.as_dict(),
    )


def read_scans(
    spark: SparkSession, scans: str, out: str, decoder: Callable[[], Any], segmenter: Callable[[], Any], make: Callable[[], Any],
    pages_at_once: int = 16, limit: int | None = None, force: bool = False, **told: Any,
) -> dict:
    """Texts and report of the scans of a folder, OCR-only records, and run.json on the driver; see pages.read_pages."""
    began = datetime.now(timezone.utc)
    read = pages.read_pages(readers.pages(spark, scans, limit=limit), decoder, segmenter, make, pages_at_once)
    report = pages.page_texts(read).withColumn("file_name", F.substring_index("path", "/", -1))
    name = F.concat(stem("file_name"), F.lit(".txt"))
    texts = report.filter("status <> 'error'").select(name.alias("file_name"), F.concat(F.lit(f"{out}/texts/"), name).alias("path"), "ocr_text")
    writers.texts(texts, f"{out}/texts", force=force)
    writers.ocr_only(delivery.ocr_only(report, texts), f"{out}/ocr_only", force=force)
    lacking = {c: F.lit(None).cast("double") for c in ("deskew_angle", "t_deskew_s", "t_write_s")}
    writers.report(report.withColumns(lacking).withColumn("out_txt", F.when(F.col("status") != "error", F.concat(F.lit(f"{out}/texts/"), name))), f"{out}/report", force=force)
    counts = {r["status"]: r["n"] for r in report.groupBy("status").agg(F.count("*").alias("n")).collect()}
    return writers.run_metadata(f"{out}/run.json", began, datetime.now(timezone.utc), kind="ocr", scans=scans, docs=counts, **told)
