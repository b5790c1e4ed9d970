"""Texts to prompts: routing, overlapping windows, headers, rendering, micro-batches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from vellumine.functions.text import Text, _c, blank, first_lines
from vellumine.session import cut

#: The mark behind a cut text, and the end of every prompt; fixed values.
TRUNCATED = "\n[...] (truncated)"
JSON_SUFFIX = "\n\nNow output ONLY the JSON object, without any extra text.\n"


@dataclass(frozen=True)
class Chunking:
    """Sizes in characters. mode: auto, single or chunked."""

    max_chars: int = 10_000
    size: int = 7_000
    overlap: int = 800
    passes: int = 2
    mode: str = "auto"
    header_lines: int = 30

    def __post_init__(self):
        if not 0 <= self.overlap < self.size:
            raise ValueError("the overlap must be at least 0 and less than the size")
        if self.mode not in ("auto", "single", "chunked"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if min(self.max_chars, self.size, self.passes, self.header_lines) < 1:
            raise ValueError("sizes and counts must be at least 1")

    @property
    def offsets(self) -> list[int]:
        """Where the passes begin: multiples of size // passes, distinct and sorted."""
        step = max(1, self.size // self.passes)
        return sorted({i * step for i in range(self.passes)}) if self.passes > 1 else [0]


def truncated(text: Text, most: int) -> Column:
    """The first ``most`` characters and a mark, if the text is longer."""
    return F.when(F.length(_c(text)) > most, F.concat(F.substring(_c(text), 1, most), F.lit(TRUNCATED))).otherwise(_c(text))


def chunked(text: Text, c: Chunking) -> Column:
    """Whether a text goes in chunks."""
    return F.lit(c.mode == "chunked") if c.mode != "auto" else F.length(_c(text)) > c.max_chars


def windows(text: Text, size: int, overlap: int, offset: int = 0) -> Column:
    """Overlapping windows from ``offset`` on; the first to reach the end is the last; blank ones go."""
    step = size - overlap
    n = F.length(_c(text))
    count = F.when(n <= offset, 0).otherwise(1 + F.ceil(F.greatest(n - offset - size, F.lit(0)) / step)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda k: F.substring(_c(text), F.lit(offset + 1) + k * step, F.lit(size)))
    return F.filter(F.slice(parts, F.lit(1), count), lambda w: ~blank(w))


def prompt_rows(docs: DataFrame, key: str, text: str, c: Chunking) -> DataFrame:
    """One row a prompt: key, candidate_order from 0 over all passes, body, in_chunks.

    A chunked text without any window, and every other text, gives one truncated row.
    """
    parts = F.concat(*[windows(text, c.size, c.overlap, o) for o in c.offsets])
    whole = F.array(truncated(text, c.max_chars))
    in_chunks = chunked(text, c) & (F.size(parts) > 0)
    bodies = F.when(in_chunks, parts).otherwise(whole)
    return docs.select(key, in_chunks.alias("in_chunks"), F.posexplode(bodies).alias("candidate_order", "body")).select(key, "candidate_order", "body", "in_chunks")


def header(text: Text, c: Chunking) -> Column:
    """The first lines of a text."""
    return first_lines(text, c.header_lines)


def rendered(template: str, text: Text) -> Column:
    """The template with {text} replaced; doubled braces of the template become single ones."""
    if "{text}" not in template:
        raise ValueError("the template needs {text}")
    plain = [part.replace("{{", "{").replace("}}", "}") for part in template.split("{text}")]
    pieces = [F.lit(plain[0])]
    for part in plain[1:]:
        pieces += [_c(text), F.lit(part)]
    return F.concat(*pieces)


def prompt_identity(template: str, suffix: str = JSON_SUFFIX) -> Column:
    return F.sha2(F.lit(template + suffix), 256)


def micro_batches(prompts: DataFrame, keys: list[str], length: Text, size: int | None) -> DataFrame:
    """Keys with position and microbatch, longest prompt first, ties by the keys.

    The position is global, so it is computed over key columns and lengths only: ranges of
    the order are numbered within their partitions and shifted by the partitions' counts,
    and no task sees more than its range.
    """
    narrow = prompts.select(*keys, _c(length).cast("bigint").alias("length"))
    ordered = narrow.repartitionByRange(F.desc("length"), *keys).sortWithinPartitions(F.desc("length"), *keys)
    # written once, as the ranges must be the same for the counts and for the rows
    numbered = cut(ordered.withColumn("_part", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    counts = numbered.groupBy("_part").agg(F.count("*").alias("_c"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_c").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = numbered.join(F.broadcast(before.select("_part", "_before")), "_part").withColumn("position", F.col("_before") + F.col("_n"))
    batch = F.lit(0).cast("bigint") if size is None else F.floor(F.col("position") / size)
    return placed.select(*keys, "length", "position", batch.alias("microbatch"))
