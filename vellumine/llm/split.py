"""Splitting oversized texts at natural boundaries, by ranges.

A text is a cell of a table or a file; a file is never loaded whole, and a giant cell is left
after one pass of slicing. Either is worked on as ranges, spread over all tasks:

1. workers detect the boundaries in their range, reading a halo behind it: paragraph ends
   (lines that are empty or blank), line ends and word gaps, as places within the range. A
   file's ranges are byte ranges, moved to the next beginning of a character;
2. the boundary tables of a text are stitched in order of its ranges. A range knows only its
   own length in characters, so places become offsets by the running sum of the lengths;
3. pieces are planned over the stitched tables, one range at a time: a piece ends at the last
   paragraph end that lets it be within the limit and above half of it, else at the last line
   end, else the last word gap, else at the limit, and the next one begins ``overlap`` characters
   before that;
4. pieces are emitted by offset: each range cuts the pieces that begin in it.

A text of one range takes all steps in one, without a shuffle. ``boundary_units`` needs sums
only: every range tells the longest line, word and paragraph in it and what is open at its
edges, and these are folded in order of the ranges.

Lengths are code points. A paragraph runs from its first to its last non-blank line; lines
end at a line feed only; blank means only white space.

Defined cases: null and short texts give no row in ``boundary_units`` and one piece (none if
null) in ``pieces``; an empty text gives one empty piece, an empty file none; repeated rows give
repeated rows; bytes of a file that are no UTF-8 are replaced.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

LIMIT, OVERLAP, RANGE_CHARS, RANGE_BYTES = 7_000, 800, 1_048_576, 4_194_304
#: Bytes read behind a range of a file beside what its last piece needs.
HALO = 65_536

_BLANK_LINES = re.compile(r"\n(?:[^\S\n]*\n)+")
_LINE = re.compile("\n")
_WORD_GAP = re.compile(r"\s+")


# Ranges ---------------------------------------------------------------------------------


def _cells(df: DataFrame, key: str, text: str, range_chars: int, behind: int) -> DataFrame:
    """The ranges of the texts of more than one range: key, same, k, size, part (with a halo), spread over all tasks.

    Slices are taken in Python: a slice costs its own length there, wherever it begins.
    """
    kind = dict(df.dtypes)[key]

    def sliced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key_, same, t in batch.itertuples(index=False):
                starts = range(0, len(t), range_chars)
                for a in range(0, len(starts), 16):
                    some = [(key_, same, k, min(range_chars, len(t) - k * range_chars), t[k * range_chars : (k + 1) * range_chars + behind]) for k in range(a, min(a + 16, len(starts)))]
                    yield pd.DataFrame(some, columns=["key", "same", "k", "size", "part"])

    long = df.filter(F.char_length(text) > range_chars).select(F.col(key).alias("key"), F.xxhash64(text).alias("same"), F.col(text).alias("_text"))
    n = max(df.sparkSession.sparkContext.defaultParallelism, 2)
    return long.mapInPandas(sliced, f"key {kind}, same bigint, k int, size int, part string").repartition(n, "key", "same", "k")


def _open(path: str):
    """A file for reading at places, from any file system pyarrow knows."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
        path = path if os.path.exists(path) else unquote(path)
    system, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(name)


def _range_of(path: str, at: int, size: int, total: int, behind: int) -> tuple[str, str]:
    """The characters that begin in a byte range of a file, and up to ``behind`` bytes more."""
    with _open(path) as source:
        source.seek(at)
        raw = source.read(min(size + behind + 4, total - at))
    begin = 0
    while at and begin < min(4, len(raw)) and raw[begin] & 0xC0 == 0x80:
        begin += 1
    end = min(size, len(raw))
    while end < len(raw) and raw[end] & 0xC0 == 0x80:
        end += 1
    stop = len(raw)
    if at + stop < total:  # not within a character
        while stop > end and raw[stop - 1] & 0xC0 == 0x80:
            stop -= 1
        stop -= stop > end and raw[stop - 1] >= 0xC0
    return raw[begin:end].decode("utf-8", "replace"), raw[end:stop].decode("utf-8", "replace")


def _files(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """The byte ranges of files: key (the path), same, k, at, bytes, total. Only names and sizes are read."""
    listed = spark.read.format("binaryFile").load(path).select(F.col("path").alias("key"), F.col("length").alias("total"))
    n = F.greatest(F.ceil(F.col("total") / F.lit(range_bytes)), F.lit(1)).cast("int")
    ranges = listed.select("key", F.lit(0).cast("bigint").alias("same"), "total", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
    at = F.col("k").cast("bigint") * range_bytes
    tasks = max(spark.sparkContext.defaultParallelism, 2)
    return ranges.select("key", "same", "k", at.alias("at"), F.lit(range_bytes).alias("bytes"), "total").repartition(tasks, "key", "k")


# The coarsest unit that fits -------------------------------------------------------------

_SUMMARY = "head int, head_ink boolean, broken boolean, first int, inner int, final int, blank boolean, tail int, tail_ink boolean, line int, word_head int, word int, word_tail int, spaced boolean"


def _summary(own: str) -> tuple:
    """What a range tells of its lines, paragraphs and words; see _SUMMARY.

    head and tail are the parts of lines at its edges (ink: not blank). Between them stand
    whole lines: first, inner and final are the paragraphs of these, open at both ends.
    """
    lines = own.split("\n")
    head, tail = lines[0], lines[-1] if len(lines) > 1 else ""
    runs, current, blank = [], -1, False
    for line in lines[1:-1]:
        if line.strip():
            current += len(line) + 1
        else:
            blank = True
            runs.append(max(current, 0))
            current = -1
    runs.append(max(current, 0))
    first, inner, final = (runs[0], max(runs[1:-1], default=0), runs[-1]) if blank else (runs[0], 0, runs[0])
    words = own.split()
    spaced = len(words) != 1 or len(words[0]) != len(own)
    word_head = len(words[0]) if words and not own[0].isspace() else 0
    word_tail = len(words[-1]) if words and not own[-1].isspace() else 0
    return (
        len(head), bool(head.strip()), len(lines) > 1, first, inner, final, blank, len(tail), bool(tail.strip()),
        max(map(len, lines[1:-1]), default=0), word_head, max(map(len, words), default=0), word_tail, spaced,
    )


def _unit(parts: list[tuple], limit: int) -> str:
    """The coarsest unit that fits, from the summaries of a text's ranges in order."""
    paragraph = open_ = line = word = part = run = 0
    ink = False

    def closed() -> None:
        nonlocal paragraph, open_, line
        line = max(line, part)
        if ink:
            open_ += part + bool(open_)
            paragraph = max(paragraph, open_)
        else:
            open_ = 0

    for head, head_ink, broken, first, inner, final, blank, tail, tail_ink, longest, word_head, longest_word, word_tail, spaced in parts:
        part, ink = part + head, ink or head_ink
        if broken:
            closed()
            open_ += first + bool(open_ and first)
            paragraph, line = max(paragraph, open_, inner), max(line, longest)
            if blank:
                open_ = final
                paragraph = max(paragraph, open_)
            part, ink = tail, tail_ink
        word = max(word, run + word_head, longest_word)
        run = word_tail if spaced else run + word_tail
        word = max(word, run)
    closed()
    return "paragraph" if paragraph <= limit else "line" if line <= limit else "word" if word <= limit else "none"


def _folded(summaries: DataFrame, limit: int) -> DataFrame:
    """key and boundary of the texts, from the summaries of their ranges."""
    kind = dict(summaries.dtypes)["key"]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = [_unit([tuple(p.values())[1:] for p in parts], limit) for parts in batch["parts"]]
            yield pd.DataFrame({"key": batch["key"], "boundary": units})[batch["total"] > limit]

    fields = [f.split()[0] for f in _SUMMARY.split(", ")]
    gathered = summaries.groupBy("key", "same").agg(
        F.array_sort(F.collect_list(F.struct("k", *fields))).alias("parts"), F.sum("chars").alias("total")
    )
    return gathered.select("key", "parts", "total").mapInPandas(fold, f"key {kind}, boundary string")


def boundary_units(df: DataFrame, key: str, text: str, limit: int = LIMIT, range_chars: int = RANGE_CHARS) -> DataFrame:
    """The coarsest unit that fits, for each row whose text has more than ``limit`` characters.

    Result: the key and boundary, one of paragraph, line, word, none. Of texts of several
    ranges, rows with the same key count as one text each only if their texts are equal.
    """
    kind = dict(df.dtypes)[key]

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "boundary": [_unit([_summary(t)], limit) for t in batch["_text"]]})

    def ranged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key_, same, k, size, *_summary(part)) for key_, same, k, size, part in batch.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=["key", "same", "k", "chars", *[f.split()[0] for f in _SUMMARY.split(", ")]])

    n = F.char_length(text)
    one = df.filter((n > limit) & (n <= range_chars)).select(F.col(key).alias("key"), F.col(text).alias("_text")).mapInPandas(whole, f"key {kind}, boundary string")
    summaries = _cells(df, key, text, range_chars, 0).mapInPandas(ranged, f"key {kind}, same bigint, k int, chars bigint, {_SUMMARY}")
    return one.unionByName(_folded(summaries, limit)).withColumnRenamed("key", key)


def file_boundary_units(spark: SparkSession, path: str, limit: int = LIMIT, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path and boundary of each file (or files of a folder or pattern) of more than ``limit`` characters."""

    def ranged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key_, same, k, at, size, total in batch.itertuples(index=False):
                own = _range_of(key_, at, size, total, 0)[0]
                yield pd.DataFrame([(key_, same, k, len(own), *_summary(own))], columns=["key", "same", "k", "chars", *[f.split()[0] for f in _SUMMARY.split(", ")]])

    summaries = _files(spark, path, range_bytes).mapInPandas(ranged, f"key string, same bigint, k int, chars bigint, {_SUMMARY}")
    return _folded(summaries, limit).withColumnRenamed("key", "path")


# Pieces -----------------------------------------------------------------------------------


def _boundaries(own: str, behind: str, limit: int) -> tuple[list[int], list[int], list[int]]:
    """Where paragraphs, lines and words begin in a range: places from 1 up to its end, and behind its end what began in it.

    Word gaps are told only in lines of a quarter of the limit and more: elsewhere a line end
    is always nearer than they are needed.
    """
    n, whole = len(own), own + behind
    paragraphs = [m.end() for m in _BLANK_LINES.finditer(whole) if m.start() < n]
    lines = [m.end() for m in _LINE.finditer(own)]
    words: list[int] = []
    for a, b in zip([0, *lines], [*lines, n]):
        if a == 0 or b == n or b - a >= limit // 4:
            end = b if b < n else len(whole)
            words += [m.end() for m in _WORD_GAP.finditer(whole, a, end) if m.start() < b]
    return paragraphs, lines, words


class _Plan:
    """Plans the pieces of one text over its ranges' boundaries, given in order."""

    def __init__(self, limit: int, overlap: int):
        self.limit, self.overlap, self.least = limit, overlap, max(limit // 2, overlap + 1)
        self.start = self.number = self.offset = 0
        self.known: list[list[int]] = [[], [], []]

    def add(self, chars: int, tables: tuple, last: bool) -> list[tuple[int, int, int, str]]:
        """The pieces that are certain once this range is known: number, start, end, unit."""
        for known, table in zip(self.known, tables):
            known += [self.offset + x for x in table]
        self.offset += chars
        out = []
        while self.offset - self.start > self.limit:
            for known, unit in zip(self.known, ("paragraph", "line", "word")):
                at = bisect_right(known, self.start + self.limit) - 1
                if at >= 0 and known[at] > self.start + self.least:
                    end = known[at]
                    break
            else:
                end, unit = self.start + self.limit, "none"
            out.append((self.number, self.start, end, unit))
            self.start, self.number = end - self.overlap, self.number + 1
        if last:
            out.append((self.number, self.start, self.offset, "end"))
        self.known = [known[bisect_right(known, self.start) :] for known in self.known]
        return out


def _checked(limit: int, overlap: int, size: int) -> None:
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be at least 0 and less than half of the limit")
    if size < limit:
        raise ValueError("a range must be at least as long as the limit")


_PIECES = "piece_no int, start bigint, cut string, piece string"
_TABLES = "chars bigint, paragraphs array<int>, lines array<int>, words array<int>"


def _planned(tables: DataFrame, limit: int, overlap: int) -> DataFrame:
    """The pieces of each range: key, same, k, and plan: number, start, end, unit and place in the range.

    A text's tables pass through one task in order, but one batch at a time; what is kept of
    a text is where its last piece began and the boundaries since.
    """
    kind = dict(tables.dtypes)["key"]

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        text, run, before = None, None, []
        for batch in batches:
            rows = []
            for key, same, k, last, chars, paragraphs, lines, words in batch.itertuples(index=False):
                ident = (None if key != key else key, same)  # a null key may come as NaN
                if ident != text:
                    text, run, before = ident, _Plan(limit, overlap), []
                before.append((k, run.offset))
                for number, start, end, unit in run.add(chars, (paragraphs, lines, words), last):
                    # the range that the piece begins in: this one or the one before
                    own, offset = next((x for x in reversed(before) if x[1] <= start))
                    rows.append((key, same, own, number, start, end - start, unit, start - offset))
                before = before[-2:]
            yield pd.DataFrame(rows, columns=["key", "same", "k", "piece_no", "start", "length", "cut", "place"])

    # ordered within tasks by text and range
    ordered = tables.repartition("key", "same").sortWithinPartitions("key", "same", "k").select("key", "same", "k", "last", *[f.split()[0] for f in _TABLES.split(", ")])
    pieces = ordered.mapInPandas(plan, f"key {kind}, same bigint, k int, piece_no int, start bigint, length int, cut string, place int")
    return pieces.groupBy("key", "same", "k").agg(F.collect_list(F.struct("piece_no", "start", "length", "cut", "place")).alias("plan"))


def pieces(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP, range_chars: int = RANGE_CHARS) -> DataFrame:
    """The texts in pieces of at most ``limit`` characters.

    Result: the key, piece_no from 0, start and length in characters, cut (the boundary at
    which the piece ends, ``end`` for the last) and piece. A piece starts ``overlap``
    characters before the end of the piece before it. Of texts of several ranges, rows with
    one key are told apart only by their texts.
    """
    _checked(limit, overlap, range_chars)
    kind = dict(df.dtypes)[key]

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key_, t in batch.itertuples(index=False):
                plan = _Plan(limit, overlap).add(len(t), _boundaries(t, "", limit) if len(t) > limit else ((), (), ()), True)
                rows += [(key_, number, start, unit, t[start:end]) for number, start, end, unit in plan]
            yield pd.DataFrame(rows, columns=["key", "piece_no", "start", "cut", "piece"])

    def detected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key_, same, k, size, part in batch.itertuples(index=False):
                rows.append((key_, same, k, len(part) <= size, size, *_boundaries(part[:size], part[size:], limit)))
            yield pd.DataFrame(rows, columns=["key", "same", "k", "last", *[f.split()[0] for f in _TABLES.split(", ")]])

    def emitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(key_, p["piece_no"], p["start"], p["cut"], part[p["place"] : p["place"] + p["length"]]) for key_, part, plan in batch.itertuples(index=False) for p in plan]
            yield pd.DataFrame(rows, columns=["key", "piece_no", "start", "cut", "piece"])

    short = df.filter(F.char_length(text) <= range_chars).select(F.col(key).alias("key"), F.col(text).alias("_text"))
    ranges = _cells(df, key, text, range_chars, limit)
    plan = _planned(ranges.mapInPandas(detected, f"key {kind}, same bigint, k int, last boolean, {_TABLES}"), limit, overlap)
    long = ranges.join(plan, ["key", "same", "k"]).select("key", "part", "plan").mapInPandas(emitted, f"key {kind}, {_PIECES}")
    return short.mapInPandas(whole, f"key {kind}, {_PIECES}").unionByName(long).select(
        F.col("key").alias(key), "piece_no", "start", F.char_length("piece").alias("length"), "cut", "piece"
    )


def file_pieces(spark: SparkSession, path: str, limit: int = LIMIT, overlap: int = OVERLAP, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The files of a folder or pattern in pieces: path, piece_no, start, length, cut, piece; see ``pieces``."""
    _checked(limit, overlap, range_bytes // 4)
    behind = 4 * limit + HALO

    def detected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, same, k, at, size, total in batch.itertuples(index=False):
                own, more = _range_of(key, at, size, total, behind)
                row = (key, same, k, at + size >= total, len(own), *_boundaries(own, more, limit))
                yield pd.DataFrame([row], columns=["key", "same", "k", "last", *[f.split()[0] for f in _TABLES.split(", ")]])

    def emitted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, at, size, total, plan in batch.itertuples(index=False):
                part = "".join(_range_of(key, at, size, total, behind))
                rows = [(key, p["piece_no"], p["start"], p["cut"], part[p["place"] : p["place"] + p["length"]]) for p in plan]
                yield pd.DataFrame(rows, columns=["key", "piece_no", "start", "cut", "piece"])

    ranges = _files(spark, path, range_bytes)
    plan = _planned(ranges.mapInPandas(detected, f"key string, same bigint, k int, last boolean, {_TABLES}"), limit, overlap)
    out = ranges.join(plan, ["key", "same", "k"]).select("key", "at", "bytes", "total", "plan").mapInPandas(emitted, f"key string, {_PIECES}")
    return out.select(F.col("key").alias("path"), "piece_no", "start", F.char_length("piece").alias("length"), "cut", "piece")
