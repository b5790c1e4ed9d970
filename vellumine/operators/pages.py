"""Scanned pages to text: decoders, segmenters and recognisers as plug-ins of one stage.

None of the engines is part of this library; the stage fixes what they are given, what they
return, how blocks of several pages share a batch, and what a failure costs.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame, functions as F

from vellumine.functions.text import class_snippets, has_class_cue, strip
from vellumine.session import cut

PAGE_SCHEMA = "path string, blocks array<string>, boxes array<struct<x1:int,y1:int,x2:int,y2:int>>, error string, t_load_s double, t_segment_s double, t_ocr_s double"


class Decoder(Protocol):
    """Bytes of a file to the image of its first page."""

    def load(self, content: bytes, path: str) -> Any: ...


class Segmenter(Protocol):
    """An image to its blocks in reading order: (image of the block, box)."""

    def process(self, image: Any) -> list[tuple[Any, tuple[int, int, int, int]]]: ...


class Recogniser(Protocol):
    """Images of blocks to their texts, as many and in their order."""

    def run_blocks(self, blocks: list[Any]) -> list[str]: ...


#: Short names of recognisers: name to "module:factory". Plug-ins add theirs.
RECOGNISERS: dict[str, str] = {}


def plug_in(spec: str, known: dict[str, str] = RECOGNISERS) -> Callable[..., Any]:
    """The factory of a plug-in, by short name, as "module:factory" or as "module.factory"."""
    target = known.get(spec, spec)
    module, _, name = target.partition(":") if ":" in target else target.rpartition(".")
    if not module or not name:
        raise ValueError(f"unknown plug-in {spec!r}; known: {', '.join(sorted(known))}, or module:factory")
    found = getattr(importlib.import_module(module), name, None)
    if found is None:
        raise ImportError(f"no {name} in {module}")
    return found


def block_prompts(blocks: str, header: str, other: str, first: int = 1) -> Column:
    """The prompt of each block of a page: ``header`` for the first ones, ``other`` for the rest."""
    return F.transform(blocks, lambda b, i: F.when(i < first, F.lit(header)).otherwise(F.lit(other)))


def recognised(engine: Recogniser, blocks: list[Any]) -> list[str]:
    """Texts of blocks; a batch that fails goes block by block, a block that fails is empty.

    An answer of the wrong length counts as a failure of its batch.
    """
    if not blocks:
        return []
    try:
        got = engine.run_blocks(blocks)
        if len(got) == len(blocks):
            return [t or "" for t in got]
    except Exception:
        pass
    return [""] if len(blocks) == 1 else [t for b in blocks for t in recognised(engine, [b])]


def read_pages(files: DataFrame, decoder: Callable[[], Decoder], segmenter: Callable[[], Segmenter], engine: Callable[[], Recogniser], batch: int = 16, progress: Accumulator | None = None) -> DataFrame:
    """path, blocks, boxes, error and timings of each file (path, content).

    Blocks of several pages fill one batch of the engine. Plug-ins are built once a worker.
    A page that can't be read or segmented has an error and no blocks. Written once, so
    that no engine runs twice for a page. progress: an accumulator that counts read pages.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tools = None
        for part in parts:
            tools = tools or (decoder(), segmenter(), engine())
            load, cut_up, read = tools
            pages: list[dict] = []
            waiting: list[tuple[int, Any]] = []

            def flush() -> None:
                began = time.perf_counter()
                got = recognised(read, [b for _, b in waiting])
                share = (time.perf_counter() - began) / max(len(waiting), 1)
                for (i, _), t in zip(waiting, got):
                    pages[i]["blocks"].append(t)
                    pages[i]["t_ocr_s"] += share
                waiting.clear()

            for path, content in zip(part["path"], part["content"]):
                page = {"path": path, "blocks": [], "boxes": [], "error": None, "t_load_s": 0.0, "t_segment_s": 0.0, "t_ocr_s": 0.0}
                pages.append(page)
                try:
                    began = time.perf_counter()
                    image = load.load(bytes(content), path)
                    page["t_load_s"] = time.perf_counter() - began
                    began = time.perf_counter()
                    blocks = cut_up.process(image)
                    page["t_segment_s"] = time.perf_counter() - began
                except Exception as problem:
                    page["error"] = f"{type(problem).__name__}: {problem}"
                    continue
                page["boxes"] = [dict(zip(("x1", "y1", "x2", "y2"), map(int, box))) for _, box in blocks]
                for block, _ in blocks:
                    waiting.append((len(pages) - 1, block))
                    if len(waiting) == batch:
                        flush()
            flush()
            if progress is not None:
                progress.add(len(pages))
            yield pd.DataFrame(pages, columns=[c.split()[0] for c in ("path", "blocks", "boxes", "error", "t_load_s", "t_segment_s", "t_ocr_s")])

    return cut(files.select("path", "content").mapInPandas(run, PAGE_SCHEMA))


def page_texts(pages: DataFrame, join_with: str = "\n\n") -> DataFrame:
    """The report of read pages with their texts: blank blocks go, the rest is joined.

    status is error, empty or ok; n_blocks counts all blocks, n_blocks_kept those with text.
    """
    kept = F.filter(F.transform("blocks", strip), lambda b: b != "")
    return pages.withColumn("_kept", kept).select(
        "path",
        F.when(F.col("error").isNotNull(), "error").when(F.size("_kept") == 0, "empty").otherwise("ok").alias("status"),
        F.size("blocks").alias("n_blocks"),
        F.size("_kept").alias("n_blocks_kept"),
        F.array_join("_kept", join_with).alias("ocr_text"),
        "error",
        *[F.round(t, 6).alias(t) for t in ("t_load_s", "t_segment_s", "t_ocr_s")],
        F.round(F.col("t_load_s") + F.col("t_segment_s") + F.col("t_ocr_s"), 6).alias("t_total_s"),
    )


def with_classification(pages: DataFrame, second: str) -> DataFrame:
    """Pages whose first block lacks a classification get the snippets of a second reading in front.

    second: column with the text of the second reading, null where there was none.
    """
    first = F.get("blocks", F.lit(0))
    found = F.array_join(class_snippets(second), "\n")
    missing = (F.size("blocks") > 0) & ~has_class_cue(first) & (F.coalesce(found, F.lit("")) != "")
    amended = F.concat(F.array(F.concat_ws("\n", found, first)), F.slice("blocks", 2, F.greatest(F.size("blocks") - 1, F.lit(0))))
    return pages.withColumn("blocks", F.when(missing, amended).otherwise(F.col("blocks")))
