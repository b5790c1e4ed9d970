"""Evaluation passages inside training texts, found by spaced seeds.

Texts become words without case, accents and punctuation. A seed is the hash of six words
at the positions of a fixed mask, so the words between them may differ. The masks are
chosen so that any 20 words in a row of which up to four were changed share at least one
seed with the original (98.8 % with five changed). Seeds of the evaluation items are looked
up at every position of every text; a hit names the item and the diagonal, the distance
between the two positions. Around the hits of a diagonal the two word sequences are then
compared word by word, tolerating substitutions; stretches on neighbouring diagonals are
joined, so a word left out, put in or broken in two does no harm.

An evaluation side of up to ``held_words`` words is sent to the workers, which then find and
verify in one pass over the texts. A larger one stays distributed: its seeds set the bits of a
filter of fixed size, the texts' seeds that pass it are joined to the items' seeds by a shuffle
(seeds only, so a frequent one costs a few bytes a text), and the pairs found this way are
verified in just the same way. The rarity of a word is counted once over all items in both.

Defined cases: null, empty and blank texts and items share nothing; an item shorter than
``least`` words can't be found; repeated items are each reported; a document and an item
are one row however often the passage stands in it.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vellumine.llm.edits import distance
from vellumine.llm.filters import FILTER_BITS, fixed_filter, passing
from vellumine.session import cut

#: Positions of the six words of a seed; fixed values, see the module's text.
MASKS = ((0, 1, 3, 4, 5, 6), (0, 1, 5, 7, 8, 9), (0, 1, 3, 4, 5, 7))
SPAN = max(m[-1] for m in MASKS) + 1
#: A passage has this many words of the item in a row.
LEAST = 20
#: The share of them that agrees, each weighted by its rarity among the items: texts of one
#: kind share turns of phrase, and differ in just the rare words. Long passages need less.
AGREE, AGREE_LONG, LONG = 0.9, 0.87, 32
#: Most words of an evaluation side that is sent to the workers, some 100 bytes a word there.
HELD_WORDS = 500_000
_BREAK = re.compile(r"(?<=\w)[-‐¬­]\s*\n\s*(?=\w)")
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_WORD = re.compile(r"[^\W_]+")
_MARKS = re.compile("[\u0300-\u036f]")
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 2**64) | 1) for k in range(6)]


def normal(text: str) -> str:
    """Without accents, case, hidden characters and hyphens at line ends."""
    text = _HIDDEN.sub("", _BREAK.sub("", text)).casefold()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return text.replace("ae", "a").replace("oe", "o").replace("ue", "u")


def words_of(text: str) -> tuple[list[str], list[int]]:
    """The words, and for each the number of the blank-separated word it is part of."""
    words, numbers = [], []
    n = 0
    for chunk in normal(text).split():
        own = _WORD.findall(chunk)
        words += own
        numbers += [n] * len(own)
        n += bool(own)
    return words, numbers


class _Items:
    """Items of the evaluation side: vocabulary, seeds, and the items' word numbers.

    Built from (item, words, numbers, weights); an item of fewer than half of LEAST words is left out.
    """

    def __init__(self, items: list[tuple]):
        self.ids, self.words, self.codes, self.numbers, self.weights = [], [], [], [], []
        self.vocabulary: dict[str, int] = {}
        for item, words, numbers, weights in items:
            if _long_enough(numbers):
                self.ids.append(item)
                self.words.append(list(words))
                self.codes.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], dtype=np.int64))
                self.numbers.append(np.array(numbers))
                self.weights.append(np.array(weights, dtype=float))
        self.lengths = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + SPAN)]).astype(np.int64)
        self.flat = np.full(int(self.starts[-1]) + SPAN, -2, dtype=np.int64)
        self.owner = np.zeros(len(self.flat), dtype=np.int64)
        for k, c in enumerate(self.codes):
            self.flat[self.starts[k] : self.starts[k] + len(c)] = c
            self.owner[self.starts[k] : self.starts[k] + len(c)] = k
        self.seeds = []
        for mask in MASKS:
            keys, places = _seeds(self.flat, mask)
            order = np.argsort(keys, kind="stable")
            unique, first, count = np.unique(keys[order], return_index=True, return_counts=True)
            self.seeds.append((unique, first, count, places[order]))

    @classmethod
    def of_texts(cls, items: list[tuple[int, str]]) -> "_Items":
        """All items from their texts."""
        read = [(item, *words_of(text or "")) for item, text in items]
        read = [r for r in read if _long_enough(r[2])]
        holders = Counter(w for _, words, _ in read for w in set(words))
        return cls([(item, words, numbers, [rarity(len(read), holders[w]) for w in words]) for item, words, numbers in read])


def _long_enough(numbers) -> bool:
    return len(numbers) > 0 and numbers[-1] + 1 >= LEAST // 2


def rarity(items: int, holders: int) -> float:
    """The weight of a word that so many of the items hold."""
    return float(np.log((1 + items) / max(holders, 1)) + 0.2)


def _seeds(codes: np.ndarray, mask: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the seeds without an unknown word, and their positions."""
    n = len(codes) - SPAN
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    good = np.ones(n, dtype=bool)
    key = np.zeros(n, dtype=np.uint64)
    for k, offset in enumerate(mask):
        part = codes[offset : offset + n]
        good &= part >= 0
        key += (part.astype(np.uint64) + np.uint64(1)) * _MIX[k]
    places = np.flatnonzero(good)
    key = key[places]
    key ^= key >> np.uint64(31)
    return key, places


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of diagonals (rows) that agree: row, first, last.

    A disagreement costs three agreements; a stretch begins and ends with an agreement and has
    at least four more agreements than it loses. All rows are walked at once.
    """
    rows = len(same)
    score, best = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
    start, end = np.full(rows, -1, dtype=np.int64), np.full(rows, -1, dtype=np.int64)
    out = []

    def close(which: np.ndarray) -> None:
        which = which[best[which] >= 4]
        if len(which):
            out.append((which, start[which].copy(), end[which].copy()))

    for i in range(same.shape[1]):
        m = same[:, i]
        score += np.where(m, 1, -3)
        start[m & (score == 1) & (start < 0)] = i
        better = score > best
        best[better] = score[better]
        end[better] = i
        over = np.flatnonzero(score <= 0)
        if len(over):
            close(over[start[over] >= 0])
            score[over], best[over], start[over] = 0, 0, -1
    close(np.flatnonzero(start >= 0))
    if not out:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*out))


def find_passages(texts: list[str], block: _Items, least: int = LEAST) -> list[tuple[int, int, int, float]]:
    """(index of the text, item, words, share in agreement) of every passage of ``least`` words found."""
    get = block.vocabulary.get
    parts, starts, at = [], [], 0
    for t in texts:
        codes = [get(w, -1) for w in _WORD.findall(normal(t))] if t else []
        parts.append(np.array(codes, dtype=np.int64))
        starts.append(at)
        at += len(codes) + SPAN
    flat = np.full(at + SPAN, -1, dtype=np.int64)
    for s, p in zip(starts, parts):
        flat[s : s + len(p)] = p
    starts_ = np.array(starts, dtype=np.int64)
    lengths_ = np.array([len(p) for p in parts], dtype=np.int64)
    pairs = []  # packed diagonals: text position of the item's first word, item
    for mask, (unique, first, count, places) in zip(MASKS, block.seeds):
        keys, positions = _seeds(flat, mask)
        if not len(keys) or not len(unique):
            continue
        found = np.searchsorted(unique, keys)
        found[found == len(unique)] = 0
        hit = unique[found] == keys
        found, positions = found[hit], positions[hit]
        n = count[found]
        rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = places[np.repeat(first[found], n) + rank]
        item = block.owner[place]
        origin = np.repeat(positions, n) - (place - block.starts[item])
        pairs.append((origin + SPAN * 1_000) * len(block.ids) + item)
    if not pairs:
        return []
    packed = np.unique(np.concatenate(pairs))
    item = packed % len(block.ids)
    origin = packed // len(block.ids) - SPAN * 1_000
    # Agreement along each diagonal, in blocks of diagonals, all at once.
    longest = int(block.lengths.max())
    by: dict[tuple[int, int], list[tuple[int, int, int, np.ndarray]]] = {}
    parts_ = []  # text, item, first, last, diagonal, agreements
    for a in range(0, len(packed), 20_000):
        o, k = origin[a : a + 20_000], item[a : a + 20_000]
        reach = np.arange(longest)
        index = o[:, None] + reach
        inside = (index >= 0) & (index < len(flat)) & (reach < block.lengths[k][:, None])
        same = (flat[np.clip(index, 0, len(flat) - 1)] == block.flat[block.starts[k][:, None] + np.minimum(reach, block.lengths[k][:, None])]) & inside
        # the most agreements in any 10 words: enough for a part of a passage?
        total = np.cumsum(np.pad(same, ((0, 0), (1, 0))), axis=1)
        dense = (total[:, 10:] - total[:, :-10]).max(axis=1) >= 8 if longest >= 10 else same.sum(axis=1) >= 8
        o, k, same = o[dense], k[dense], same[dense]
        row, first, last = _stretches(same)
        text = np.searchsorted(starts_, o[row] + first, "right") - 1
        parts_.append((text, k[row], first, last, o[row] - starts_[text], same, row))
    # of a text and an item only if the stretches together are long enough
    text, items_, first, last, diagonal = (np.concatenate(x) for x in list(zip(*parts_))[:5])
    pair, whose = np.unique(text * len(block.ids) + items_, return_inverse=True)
    enough = np.bincount(whose, last - first + 1, len(pair))[whose] >= least - 4 if len(pair) else np.zeros(0, dtype=bool)
    part = np.repeat(np.arange(len(parts_)), [len(x[0]) for x in parts_])[enough]
    row = np.concatenate([x[6] for x in parts_])[enough]
    for t, k, d, s, e, p, r in zip(*(x.tolist() for x in (text[enough], items_[enough], diagonal[enough], first[enough], last[enough], part, row))):
        by.setdefault((t, k), []).append((d, s, e, parts_[p][5][r]))
    out = []
    for (text, k), found in by.items():
        best = (0, 0.0)
        own_words = None
        found.sort(key=lambda x: (x[1], x[2]))
        numbers, weights = block.numbers[k], block.weights[k]
        for i, (diagonal, s, e, same) in enumerate(found):
            agreed = np.zeros(len(weights), dtype=bool)
            agreed[s : e + 1] = same[s : e + 1]
            diagonals: dict[int, int] = {}
            for d2, s2, e2, same2 in found[i + 1 :]:  # joined over a word put in or left out
                if s2 > e - 2 and s2 - e <= 4 and 0 < abs(d2 - diagonal) <= 3 and e2 > e:
                    agreed[s2 : e2 + 1] |= same2[s2 : e2 + 1]
                    diagonals |= dict.fromkeys(range(s2, e2 + 1), d2)
                    diagonal, e = d2, e2
            words = int(numbers[e] - numbers[s]) + 1
            if words < least or words <= best[0]:
                continue
            if own_words is None:
                own_words = _WORD.findall(normal(texts[text]))
            for q in range(s, e + 1):  # a misread word agrees too
                at = diagonals.get(q, found[i][0]) + q
                if not agreed[q] and 0 <= at < len(own_words):
                    agreed[q] = len(own_words[at]) > 4 and distance(own_words[at], block.words[k][q]) <= 2
            own = weights[s : e + 1]
            share = float(own[agreed[s : e + 1]].sum() / own.sum())
            if share >= (AGREE if words < LONG else AGREE_LONG):
                best = (words, share)
        if best[0]:
            out.append((text, block.ids[k], *best))
    return out


def _chunked_passages(texts: list[str], block: _Items, least: int) -> Iterator[tuple[int, int, int, float]]:
    """find_passages over a batch in parts of about as much text, so that memory has a bound."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > 2_000_000 or i - at >= 1_000 or i + 1 == len(texts):
            for found, *rest in find_passages(texts[at : i + 1], block, least):
                yield (at + found, *rest)
            at, size = i + 1, 0


def leaks(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, held_words: int = HELD_WORDS, filter_bits: int = FILTER_BITS
) -> DataFrame:
    """The passages: key, item_id, words, agreement; one row each document and item.

    items needs item_id and text. Further columns of either side don't matter. An evaluation
    side of more than ``held_words`` words is joined instead of sent; the rows are the same.
    """
    kind = dict(documents.dtypes)[key]
    schema = f"_key {kind}, item_id bigint, words int, agreement double"
    wanted = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text is not null")
    source = documents.filter(F.length(text) > 0).select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    total = wanted.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    if total > held_words:
        return _joined(source, wanted, least, filter_bits, schema).withColumnRenamed("_key", key)
    sent = documents.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in wanted.collect()])

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _Items.of_texts(sent.value)
        for batch in batches:
            keys = batch["_key"].tolist()
            rows = [(keys[i], *rest) for i, *rest in (_chunked_passages(batch["_text"].tolist(), own, least) if own.ids else ())]
            yield pd.DataFrame(rows, columns=["_key", "item_id", "words", "agreement"])

    return source.mapInPandas(work, schema).withColumnRenamed("_key", key)


def _hashed_seeds(words: list[str]) -> np.ndarray:
    """The distinct seeds of a sequence of words over all masks, by hashes of the words."""
    import xxhash

    codes = np.array([xxhash.xxh3_64_intdigest(w) >> 2 for w in words] + [-1] * SPAN, dtype=np.int64)
    found = [_seeds(codes, mask)[0] ^ np.uint64(_MIX[n]) for n, mask in enumerate(MASKS)]
    return np.unique(np.concatenate(found)).view(np.int64)


def _joined(source: DataFrame, wanted: DataFrame, least: int, filter_bits: int, schema: str) -> DataFrame:
    """The passages where the evaluation side stays distributed."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(item, *words_of(t)) for item, t in zip(batch["item_id"].tolist(), batch["text"])]
            yield pd.DataFrame([r for r in rows if _long_enough(r[2])], columns=["item_id", "words", "numbers"])

    def seeds_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_hashed_seeds(list(w)) for w in batch["words"]]
            yield pd.DataFrame({"seed": np.concatenate([*found, np.empty(0, np.int64)]), "item_id": np.repeat(batch["item_id"].to_numpy(), [len(f) for f in found])})

    spark = source.sparkSession
    # repeated items are told apart by their row
    read_ = cut(wanted.withColumn("row", F.monotonically_increasing_id()).select(F.col("row").alias("item_id"), "text").mapInPandas(read, "item_id bigint, words array<string>, numbers array<int>"))
    names = cut(wanted.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").alias("name")))
    total = read_.agg(F.count("*").alias("n"))
    each = read_.select("item_id", F.posexplode("words").alias("at", "word"))
    holders = each.groupBy("word").agg(F.countDistinct("item_id").alias("holders"))
    weight = (F.log((F.col("n") + 1) / F.col("holders")) + 0.2).alias("weight")
    weights = each.join(holders, "word").join(F.broadcast(total)).groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("at", weight))).alias("w"))
    told = cut(read_.join(weights, "item_id").select("item_id", "words", "numbers", F.col("w.weight").alias("weights")))
    seeds = cut(read_.mapInPandas(seeds_of, "seed bigint, item_id bigint"))
    sent = spark.sparkContext.broadcast(fixed_filter(seeds, "seed", filter_bits))
    kind = dict(source.dtypes)["_key"]

    def possible(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_hashed_seeds(_WORD.findall(normal(t))) for t in batch["_text"]]
            found = [x[passing(x, sent.value)] for x in found]
            yield pd.DataFrame({"_key": batch["_key"].repeat([len(x) for x in found]), "seed": np.concatenate([*found, np.empty(0, np.int64)])})

    met = source.mapInPandas(possible, f"_key {kind}, seed bigint").join(seeds, "seed").select("_key", "item_id").distinct()
    pairs = met.join(told, "item_id").join(source, "_key")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for item, some in batch.groupby("item_id", sort=False):
                first = some.iloc[0]
                own = _Items([(item, first["words"], first["numbers"], first["weights"])])
                keys = some["_key"].tolist()
                out += [(keys[i], *rest) for i, *rest in _chunked_passages(some["_text"].tolist(), own, least)]
            yield pd.DataFrame(out, columns=["_key", "row", "words", "agreement"])

    found = pairs.mapInPandas(verify, schema.replace("item_id", "row"))
    return found.join(names, "row").select("_key", F.col("name").alias("item_id"), "words", "agreement")
