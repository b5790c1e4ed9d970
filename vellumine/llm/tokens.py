"""Encoding a corpus with a public byte-level BPE vocabulary, each shared chunk once.

A rolling hash over the characters sets content-defined chunk borders, so a passage that
stands in many documents gives the same chunks in all of them.

What a border does to the merges is repaired exactly. A position before a single space
that stands between two visible characters always starts a new pre-token, whatever comes
before or after it; between such *certain* positions encodings simply concatenate. Of each
chunk only the core, from its first to its last certain position, is reused. The rest, from
the last certain position of one chunk to the first of the next, is re-encoded as one
string across the border; a chunk without a certain position becomes part of that string,
so the re-encoded window widens until both ends are certain.

Three passes over the texts, of which only the narrow sides are shuffled:

1. the hashes of all cores are counted; those of two and more set the bits of a filter of
   fixed size, which every task gets;
2. a text without a shared core is encoded where it is;
3. of the others, everything between shared cores is encoded where it is; a shared core
   goes on as a digest. Each distinct core is encoded once and its ids are joined back.

What passes the filter wrongly is treated as shared, which costs a shuffle of that core and
changes no id.

Defined cases: null and empty texts give an empty list; strings that look like special
tokens are ordinary text; repeated texts give equal lists.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vellumine.llm.filters import FILTER_BITS, fixed_filter, passing
from vellumine.session import cut, spread

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that belongs to the vocabulary; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters the rolling hash sees, and the mean distance of its borders.
WINDOW, SPACING = 24, 512
_POWERS = {k: np.uint32(pow(0x01000193, k, 1 << 32)) for k in (1, 2, 4, 8, 16)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str = PATTERN):
    """The vocabulary as an encoder; kept for the life of a worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _borders(codes: np.ndarray, spacing: int) -> np.ndarray:
    """Positions at which the hash of the WINDOW characters before asks for a border."""
    n = len(codes)
    if n <= WINDOW:
        return np.empty(0, dtype=np.int64)
    # hashes of 1, 2, 4, 8 and 16 characters, each from two of half the length; WINDOW is 8 + 16
    hashed = eight = codes * np.uint32(0x9E3779B1)
    for size in (1, 2, 4, 8):
        eight = hashed
        hashed = hashed[: n - 2 * size + 1] * _POWERS[size] + hashed[size : size + n - 2 * size + 1]
    last = n - WINDOW
    whole = eight[:last] * _POWERS[16] + hashed[8 : 8 + last]
    whole ^= whole >> np.uint32(15)
    whole *= np.uint32(0x85EBCA77)
    return np.flatnonzero(whole < np.uint32((1 << 32) // spacing)) + WINDOW


_WHITE = np.array([chr(c).isspace() for c in range(0x3002)])


def _certain(codes: np.ndarray) -> np.ndarray:
    """Positions of single spaces between visible characters, in order."""
    white = _WHITE[np.minimum(codes, np.uint32(0x3001))]
    return np.flatnonzero((codes[1:-1] == 32) & ~white[:-2] & ~white[2:]) + 1


def cores(texts: list[str], spacing: int = SPACING) -> list[list[tuple[int, int]]]:
    """For each text, begin and end of the reusable part of each chunk that is long enough to be worth it.

    Done on many texts at once; a text's cores depend on that text alone.
    """
    out: list[list[tuple[int, int]]] = []
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > 1_000_000 or i + 1 == len(texts):
            out += _cores(texts[at : i + 1], spacing)
            at, size = i + 1, 0
    return out


def _cores(texts: list[str], spacing: int) -> list[list[tuple[int, int]]]:
    ends = np.cumsum([len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if len(codes) <= 2 * WINDOW:
        return out
    bounds = np.unique(np.concatenate([[0], ends]))

    # the characters at the ends of a text have no neighbour on one side: line feeds make nothing certain
    codes_ = codes.copy()
    codes_[np.minimum(bounds, len(codes) - 1)] = codes_[np.maximum(bounds - 1, 0)] = 10
    certain, places = _certain(codes_), _borders(codes, spacing)
    text = np.searchsorted(bounds, places, "right") - 1
    edges = np.unique(np.concatenate([bounds, places[places - bounds[text] >= WINDOW]]))
    # the texts' own ends are borders, and certain too
    padded = np.concatenate([[-1], certain, [len(codes)]])
    first = np.minimum(padded[1:][np.searchsorted(certain, edges[:-1], "left")], bounds[np.searchsorted(bounds, edges[:-1], "left")])
    last = np.maximum(padded[np.searchsorted(certain, edges[1:], "right")], bounds[np.searchsorted(bounds, edges[1:], "right") - 1])
    good = last - first > 2 * WINDOW
    first, last = first[good], last[good]
    owner = np.searchsorted(ends, first, "right")
    base = np.concatenate([[0], ends])[owner]
    for k, a, b in zip(owner.tolist(), (first - base).tolist(), (last - base).tolist()):
        out[k].append((a, b))
    return out


def parts(text: str, reused: list[tuple[int, int]]) -> list[tuple[bool, str]]:
    """The text as (reused, string) parts; their encodings concatenate to that of the text."""
    out, at = [], 0
    for begin, end in reused:
        if begin > at:
            out.append((False, text[at:begin]))
        out.append((True, text[begin:end]))
        at = end
    return [*out, (False, text[at:])] if at < len(text) else out


def _hashes(strings: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in strings], dtype=np.uint64).view(np.int64)


def encode_corpus(df: DataFrame, key: str, text: str, path: str = VOCABULARY, spacing: int = SPACING, pattern: str = PATTERN, filter_bits: int = FILTER_BITS) -> DataFrame:
    """key and ids (array<int>) of each row.

    key must be unique; ``path`` must name the vocabulary on every executor.
    """
    kind = dict(df.dtypes)[key]
    some = df.filter(F.length(text) > 0).select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = [t[a:b] for t, own in zip(texts, cores(texts, spacing)) for a, b in own]
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(found), pa.int64())], names=["core"])

    counted = some.select("_text").mapInArrow(hashed, "core bigint").groupBy("core").agg(F.count("*").alias("n")).filter("n > 1")
    sent = df.sparkSession.sparkContext.broadcast(fixed_filter(counted, "core", filter_bits))

    def shared(texts: list[str]) -> list[list[tuple[int, int]]]:
        """The cores of each text that pass the filter."""
        spans = cores(texts, spacing)
        there = iter(passing(_hashes([t[a:b] for t, own in zip(texts, spans) for a, b in own]), sent.value).tolist())
        return [[x for x in own if next(there)] for own in spans]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            kept = [i for i, spans in enumerate(shared(texts)) if not spans]
            ids = own.encode_ordinary_batch([texts[i] for i in kept], num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept, pa.int64())), pa.array(ids, pa.list_(pa.int32()))], names=["_key", "ids"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            index, seq, digest, core, between = [], [], [], [], []
            texts = batch.column(1).to_pylist()
            for i, (t, spans) in enumerate(zip(texts, shared(texts))):
                for n, (reused, s) in enumerate(parts(t, spans) if spans else ()):
                    index.append(i)
                    seq.append(n)
                    digest.append(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=16).digest() if reused else None)
                    core.append(s if reused else None)
                    between.append("" if reused else s)
            ids = own.encode_ordinary_batch(between, num_threads=1)
            ids = [None if d else x for d, x in zip(digest, ids)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int64())), pa.array(seq, pa.int32()), pa.array(digest, pa.binary()), pa.array(core, pa.string()), pa.array(ids, pa.list_(pa.int32()))],
                names=["_key", "seq", "digest", "core", "ids"],
            )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            lists = own.encode_ordinary_batch(batch.column(1).to_pylist(), num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["digest", "coded"])

    # two stages read these parts of texts with shared cores, so they are written once
    chunks = cut(some.mapInArrow(split, f"_key {kind}, seq int, digest binary, core string, ids array<int>"))
    coded = spread(chunks.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.first("core").alias("core"))).mapInArrow(encode, "digest binary, coded array<int>")
    joined = (
        chunks.drop("core")
        .join(coded, "digest", "left")
        .groupBy("_key")
        .agg(F.array_sort(F.collect_list(F.struct("seq", F.coalesce("coded", "ids").alias("ids")))).alias("_parts"))
        .select("_key", F.flatten(F.col("_parts.ids")).alias("ids"))
    )
    none = df.filter(F.coalesce(F.length(text), F.lit(0)) == 0).select(F.col(key).alias("_key"), F.array().cast("array<int>").alias("ids"))
    return some.mapInArrow(whole, f"_key {kind}, ids array<int>").unionByName(joined).unionByName(none).withColumnRenamed("_key", key)
