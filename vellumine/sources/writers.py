"""Writers: records as JSON lines, reports, manifests, texts; with guards and resumption."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Mapping
from datetime import datetime
from pathlib import Path, PurePath
from typing import Any

from pyspark.sql import DataFrame, functions as F

from vellumine.operators.delivery import raw_text
from vellumine.sources.readers import REPORT

_MODES = {False: "errorifexists", True: "overwrite"}


def json_lines(df: DataFrame, path: str, order: str | None = None, keep_nulls: bool = True, force: bool = False) -> None:
    """One JSON object a row. order: column to sort by, which makes the parts ordered ranges."""
    rows = df.orderBy(order) if order else df
    kept = [c for c in rows.columns if c != order]
    rows.select(F.to_json(F.struct(*kept), {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value")).write.mode(_MODES[force]).text(path)


def report(df: DataFrame, path: str, force: bool = False) -> None:
    """An OCR report with a header; angles with four places, times with six."""
    def printed(name: str):
        if name == "deskew_angle":
            return F.format_string("%.4f", name).alias(name)
        return F.format_string("%.6f", name).alias(name) if name.startswith("t_") else F.col(name)

    names = [field.split()[0] for field in REPORT.split(", ")]
    df.select(*[printed(n) for n in names]).write.mode(_MODES[force]).csv(path, header=True)


def manifest(df: DataFrame, path: str, force: bool = False) -> None:
    """A small table as one CSV file with a header."""
    df.coalesce(1).write.mode(_MODES[force]).csv(path, header=True)


def texts(df: DataFrame, path: str, keep_empty: bool = True, force: bool = False) -> None:
    """Texts as a parquet table of file_name and ocr_text; empty ones only if asked for."""
    rows = df.select("file_name", F.coalesce("ocr_text", F.lit("")).alias("ocr_text"))
    (rows if keep_empty else rows.filter(F.trim("ocr_text") != "")).write.mode(_MODES[force]).parquet(path)


def raw_outputs(df: DataFrame, path: str, raw: str = "raw_output", force: bool = False) -> None:
    """Raw answers as a parquet table of file_name and text, named as the files they stand for."""
    df.filter(F.col(raw).isNotNull()).select(F.concat("file_name", F.lit(".raw.txt")).alias("file_name"), raw_text(raw).alias("text")).write.mode(_MODES[force]).parquet(path)


def ocr_only(df: DataFrame, path: str, force: bool = False) -> None:
    """Records of scans that were only recognised, one JSON object a line."""
    json_lines(df.select("file_name", "ocr_path", "status", "ocr_text"), path, keep_nulls=False, force=force)


def plain(value: Any) -> Any:
    """A value as JSON can hold it: paths as strings, also inside mappings, sequences and dataclasses."""
    if isinstance(value, PurePath):
        return str(value)
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return plain(dataclasses.asdict(value))
    if isinstance(value, Mapping):
        return {str(k): plain(v) for k, v in value.items()}
    return [plain(v) for v in value] if isinstance(value, (list, tuple, set, frozenset)) else value


def run_metadata(path: str, started: datetime, finished: datetime, **told: Any) -> dict:
    """Writes what is told of a run, with its times, as one JSON file on the driver; returns it."""
    meta = plain({**told, "started_at": started.isoformat(), "finished_at": finished.isoformat(), "wall_s": round(max(0.0, (finished - started).total_seconds()), 6)})
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(meta, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")
    return meta


def scored(scores: DataFrame, summary: DataFrame, folder: str, order: list[str], worst: DataFrame | None = None, force: bool = False) -> None:
    """Rows as CSV in an order, the worst ones as one CSV file, and a summary of one row or few as JSON, in one folder."""
    mode = _MODES[force]
    scores.orderBy(*order).write.mode(mode).csv(f"{folder}/scores", header=True)
    if worst is not None:
        manifest(worst, f"{folder}/worst", force)
    summary.coalesce(1).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(f"{folder}/summary")
