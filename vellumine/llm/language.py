"""Language of documents and of their parts, by rank-order profiles.

A profile is the ranked list of a language's most frequent character trigrams. A stretch of
text gets the language whose profile its own ranked trigrams are least out of place in: the
distance of a trigram is the difference of its two ranks, or the profile's length where the
profile lacks it.

Profiles are fitted on a bounded sample of rows whose label names one of the languages,
twice: rows that fall to another language in the first round are left out of the second,
so a few wrong labels do no harm. Then every text is cut into blocks of a few words, at line
ends where lines are short and inside long lines, each block gets its distances, and the
cheapest path through the languages, with a price for every change, gives the segments. Segments under ``least`` words join a
neighbour. Everything up to the path is done on whole batches of texts at once.

Defined cases: null, empty and blank texts have no segment; a text without letters gets the
language of the first profile with confidence 0; labels are compared by what they name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vellumine.llm.sampling import bounded

LANGUAGES = ("de", "fr", "it", "en")
#: Length of a profile, words of a block, price of a change in trigrams, least words of a part.
LENGTH, BLOCK, CHANGE, LEAST = 400, 8, 9.0, 25
#: Rows of the sample that the profiles are fitted on.
SAMPLE = 1_500
#: What labels name, in lower case and without region; fixed values.
NAMES = {
    "de": "de deu ger german deutsch allemand tedesco deutschland",
    "fr": "fr fra fre french français francais franz französisch francese",
    "it": "it ita italian italiano italienisch italien",
    "en": "en eng english englisch anglais inglese",
    "es": "es spa spanish español espanol spanisch",
    "pt": "pt por portuguese",
    "nl": "nl nld dut dutch",
    "la": "la lat latin",
}
_NAMED = {w: code for code, ws in NAMES.items() for w in ws.split()}

_SYMBOLS = "abcdefghijklmnopqrstuvwxyzäöüßéèêàâçîïôùûòìœæ'"
_TABLE = np.zeros(0x2100, dtype=np.int64)
for _i, _c in enumerate(_SYMBOLS, 1):
    _TABLE[ord(_c)] = _i
    if _c.upper() != _c and len(_c.upper()) == 1:
        _TABLE[ord(_c.upper())] = _i
_TABLE[0x2019] = _TABLE[ord("'")]
_SPACE = np.zeros(0x3100, dtype=bool)
for _i in range(0x3100):
    _SPACE[_i] = chr(_i).isspace()
_BITS = 6


def named(label: str | None) -> str | None:
    """The language a label names, or None.

    >>> named("de-CH"), named("FRENCH"), named(" ita "), named("xx"), named(None)
    ('de', 'fr', 'it', None, None)
    """
    if label is None:
        return None
    return _NAMED.get(label.strip().lower().replace("_", "-").split("-")[0])


def label_column(column) -> "F.Column":
    """The language a label column names, as a column; null where it names none."""
    base = F.substring_index(F.regexp_replace(F.lower(F.trim(column)), "_", "-"), "-", 1)
    pairs = [F.lit(x) for w, code in _NAMED.items() for x in (w, code)]
    return F.create_map(*pairs)[base]


class _Blocks:
    """A batch of texts as trigrams by block.

    Lines of two blocks and more are cut into parts of ``block`` words, the last one with what
    is left over; then lines and parts that begin in the same ``block`` words make a block.
    """

    def __init__(self, texts: list[str], block: int = BLOCK):
        joined = "\n".join(texts) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
        ends = np.cumsum([len(t) + 1 for t in texts])
        newline = np.flatnonzero(codes == 10)
        starts = np.concatenate([[0], newline[:-1] + 1])
        white = _SPACE[np.minimum(codes, 0x30FF)] & (codes < 0x3100)
        begins = ~white
        begins[1:] &= white[:-1]
        words = np.add.reduceat(begins, starts).astype(np.int64)
        if words.max() >= 2 * block:
            first = np.flatnonzero(begins)
            line = np.repeat(np.arange(len(starts)), words)
            place = np.arange(len(first)) - (np.cumsum(words) - words)[line]
            cut = (place % block == 0) & (place > 0) & (place + block <= words[line])
            starts = np.union1d(starts, first[cut])
            words = np.add.reduceat(begins, starts).astype(np.int64)
        of_text = np.searchsorted(ends, starts, "right")
        before = np.cumsum(words) - words
        first_line = np.searchsorted(of_text, np.arange(len(texts)))
        number = (before - before[first_line][of_text]) // block
        change = np.ones(len(starts), dtype=bool)
        change[1:] = (of_text[1:] != of_text[:-1]) | (number[1:] != number[:-1])
        block_of_line = np.cumsum(change) - 1
        self.count = int(block_of_line[-1]) + 1
        self.text = of_text[change]
        self.words = np.bincount(block_of_line, weights=words, minlength=self.count).astype(np.int64)
        symbol = _TABLE[np.minimum(codes, 0x20FF)]
        middle = np.flatnonzero(symbol[1:-1] > 0) + 1
        gram = (symbol[middle - 1] << (2 * _BITS)) | (symbol[middle] << _BITS) | symbol[middle + 1]
        block_of_char = np.repeat(block_of_line, np.diff(np.concatenate([starts, [len(codes)]])))
        key = (block_of_char[middle] << (3 * _BITS)) | gram
        self.key, self.times = np.unique(key, return_counts=True)

    def distances(self, ranks: np.ndarray) -> np.ndarray:
        """Out-of-place distance of each block to each profile, in units of a missing trigram."""
        out = np.zeros((self.count, len(ranks)))
        if not len(self.key):
            return out
        block, gram = self.key >> (3 * _BITS), self.key & ((1 << (3 * _BITS)) - 1)
        order = np.lexsort((-self.times, block))
        block, gram = block[order], gram[order]
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        rank = np.arange(len(block)) - np.repeat(first, np.diff(np.concatenate([first, [len(block)]])))
        for k, own in enumerate(ranks):
            place = own[gram]
            apart = np.where(place < LENGTH, np.minimum(np.abs(place - rank), LENGTH), LENGTH) / LENGTH
            out[block[first], k] = np.add.reduceat(apart, first)
        return out


def _ranks(counts: np.ndarray) -> np.ndarray:
    top = np.argsort(-counts, kind="stable")[:LENGTH]
    top = top[counts[top] > 0]
    ranks = np.full(len(counts), LENGTH, dtype=np.int64)
    ranks[top] = np.arange(len(top))
    return ranks


def fit_profiles(rows: list[tuple[str, str]], languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Profiles from (language, text) rows: the rank of each trigram by language."""
    size = 1 << (3 * _BITS)
    grams, where = [], []
    for code, text in rows:
        own = _Blocks([text], 1 << 40)
        counts = np.zeros(size)
        counts[own.key & (size - 1)] = own.times
        grams.append((own.key & (size - 1), own.times))
        where.append(languages.index(code))
    keep = [True] * len(rows)
    ranks = np.full((len(languages), size), LENGTH, dtype=np.int64)
    for _ in range(2):
        counts = np.zeros((len(languages), size))
        for (g, n), k, ok in zip(grams, where, keep):
            if ok:
                counts[k, g] += n / max(n.sum(), 1)
        ranks = np.array([_ranks(c) for c in counts])
        keep = []
        for (g, n), k in zip(grams, where):
            top = np.argsort(-n, kind="stable")[:LENGTH]
            apart = [np.minimum(np.abs(r[g[top]] - np.arange(len(top))), LENGTH).sum() for r in ranks]
            keep.append(int(np.argmin(apart)) == k)
    return ranks


def _path(costs: np.ndarray, change: float) -> list[int]:
    """The cheapest path through the columns of costs, each change of column costs ``change``."""
    n = costs.shape[1]
    total = costs[0].tolist()
    back = []
    for row in costs[1:].tolist():
        best = min(range(n), key=total.__getitem__)
        jump = total[best] + change
        came, new = [], []
        for k in range(n):
            if total[k] <= jump:
                came.append(k)
                new.append(total[k] + row[k])
            else:
                came.append(best)
                new.append(jump + row[k])
        back.append(came)
        total = new
    k = min(range(n), key=total.__getitem__)
    path = [k]
    for came in reversed(back):
        k = came[k]
        path.append(k)
    return path[::-1]


def segments_of(texts: list[str], ranks: np.ndarray, least: int = LEAST, change: float = CHANGE) -> list[list[tuple[int, int, float]]]:
    """For each text its segments: (language number, words, confidence)."""
    if not texts:
        return []
    blocks = _Blocks(texts)
    costs = blocks.distances(ranks)
    cheapest = costs.argmin(axis=1)
    edges = np.searchsorted(blocks.text, np.arange(len(texts) + 1))
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        own, words = costs[a:b], blocks.words[a:b]
        if not words.sum():
            out.append([])
            continue
        path = [int(cheapest[a])] * int(b - a) if (cheapest[a:b] == cheapest[a]).all() else _path(own, change)
        parts: list[list] = []  # language, words, costs
        for k, n, cost in zip(path, words.tolist(), own):
            if parts and parts[-1][0] == k:
                parts[-1][1] += n
                parts[-1][2] = parts[-1][2] + cost
            else:
                parts.append([k, n, cost])
        # a change is seen at the edge of a block, so a part's words are known to within a block
        while len(parts) > 1 and min(p[1] for p in parts) < least - BLOCK // 2:
            i = min(range(len(parts)), key=lambda j: parts[j][1])
            beside = [j for j in (i - 1, i + 1) if 0 <= j < len(parts)]
            j = min(beside, key=lambda j: parts[i][2][parts[j][0]])
            parts[j][1] += parts[i][1]
            parts[j][2] = parts[j][2] + parts[i][2]
            parts.pop(i)
            merged: list[list] = []
            for p in parts:
                if merged and merged[-1][0] == p[0]:
                    merged[-1][1] += p[1]
                    merged[-1][2] = merged[-1][2] + p[2]
                else:
                    merged.append(p)
            parts = merged
        done = []
        for k, n, cost in parts:
            ordered = np.sort(cost)
            done.append((k, int(n), float(np.clip((ordered[1] - ordered[0]) / max(ordered[1], 1e-9) * 2, 0, 1)) if ordered[1] > 0 else 0.0))
        out.append(done)
    return out


def profiles_of(rows: DataFrame, text: str, label: str, sample: int = SAMPLE, languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Profiles fitted on at most ``sample`` rows, as many of each language, chosen by the hash of their text.

    Short texts are left out, but for a language that has no others.
    """
    code = label_column(F.col(label))
    group = F.when(code.isin(*languages), code)
    sample_rows = bounded(rows.filter(F.length(text) > 200), text, sample // len(languages), group)
    short = sorted(set(languages) - {g for g, _ in sample_rows})
    if short:
        sample_rows += bounded(rows, text, sample // len(languages), F.when(code.isin(*short), code))
    return fit_profiles(sample_rows, languages)


def segment(rows: DataFrame, key: str, text: str, ranks: np.ndarray, languages: tuple[str, ...] = LANGUAGES, keep: tuple[str, ...] = ()) -> DataFrame:
    """The segments of each text: key, the kept columns, seg_no from 1, of, lang, words, confidence."""
    sent = rows.sparkSession.sparkContext.broadcast(ranks)
    kinds = dict(rows.dtypes)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 400):
                some = batch.iloc[at : at + 400]
                found = segments_of(some["_text"].tolist(), sent.value)
                out = []
                for values, parts in zip(some.drop(columns="_text").itertuples(index=False), found):
                    out += [(*values, i, len(parts), languages[k], n, c) for i, (k, n, c) in enumerate(parts, 1)]
                yield pd.DataFrame(out, columns=["_key", *keep, "seg_no", "of", "lang", "words", "confidence"])

    schema = ", ".join([f"_key {kinds[key]}", *[f"{c} {kinds[c]}" for c in keep], "seg_no int, of int, lang string, words int, confidence double"])
    return rows.filter(F.length(text) > 0).select(F.col(key).alias("_key"), *keep, F.col(text).alias("_text")).mapInPandas(work, schema).withColumnRenamed("_key", key)


def relabelled(predictions: DataFrame) -> DataFrame:
    """The segments of the rows whose label is missing or wrong or that have several segments.

    Result: rec_id, seg_no, lang, words, confidence.
    """
    rows = predictions.filter("prediction is not null and length(ocr_text) > 0").select("rec_id", "ocr_text", label_column(F.col("lang")).alias("declared"), "lang")
    ranks = profiles_of(rows, "ocr_text", "lang")
    found = segment(rows.drop("lang"), "rec_id", "ocr_text", ranks, keep=("declared",))
    return found.filter((F.col("of") > 1) | F.col("declared").isNull() | (F.col("declared") != F.col("lang"))).select("rec_id", "seg_no", "lang", "words", "confidence")
