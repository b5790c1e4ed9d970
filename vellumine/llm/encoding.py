"""Wrongly decoded text: found and restored as a substitution cipher, per source.

A swapped code page replaces each letter outside ASCII by another character or by a short
group of them. What stands for what is learned, not looked up:

1. over all texts, how often each character outside ASCII stands beside which neighbours
   (the language bigrams), and in how many texts it occurs; frequent ones are proper;
2. the other characters and groups, the symbols, are collected with their neighbours and
   summed by source before anything is shuffled by source;
3. expectation-maximization: which letter a symbol stands for is hidden; the expectation weighs
   each letter by its bigrams with the neighbours and by how often the symbol stood for it so
   far, the maximization counts anew. First over all sources, then for each source with that
   result as the prior, so a rare symbol leans on the others and a frequent one on itself;
4. letters with a share of the symbol's uses make the source's map. A check follows: some code
   page read as some other must turn the letter into just this symbol. For code pages outside
   the check's list the learned evidence must be strong instead: a letter between many different
   neighbours, nearly always inside words, and one letter that takes nearly all its uses;
5. a text is affected if one of its symbols is far more likely one of its letters than
   itself in its place, or can't be proper text at all (replacement and control characters,
   and runs of another script that are valid UTF-8 read under a page; neither can be learned).

``restore`` applies the map with translate() where a symbol stands for one letter all over a
text, and place by place where it doesn't, and says what could not be recovered.

Defined cases: null, empty and blank texts aren't affected; texts without a source count as
one source; other scripts, rare characters and markup references are left alone because no
letter explains them better; a source is never gathered in one task but as its sums.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from vellumine.session import cut, spread

#: Code pages that may be swapped; fixed values.
PAGES = ("cp1252", "latin-1", "cp1250", "cp1251", "cp850", "cp437", "mac_roman", "iso8859-2", "iso8859-15", "cp1254", "cp1257", "cp852")
#: Letters and signs a symbol may stand for; fixed values.
LETTERS = "äöüÄÖÜßéèêëàâáçîïíôóòûùúñæœøåÉÈÊÀÂÇÎÔÙìÌ°½¼¾±×’‘“”–—…«»§µ€„·²³¿¡"
#: Share of texts a character is in to be proper; margin a letter must win by.
PROPER, MARGIN = 0.02, 2.0
#: Share of a symbol's uses that a letter must have; uses that the prior counts for.
LEAST_SHARE, PRIOR = 0.0001, 4.0
#: Without a check: different pairs of neighbours, share of uses in words, and share of the one letter.
USES, IN_WORDS, SURE = 5, 0.8, 0.8
_OUTSIDE = re.compile(r"[^\x00-\x7f]+")


@lru_cache(maxsize=1)
def swaps() -> dict[str, str]:
    """Symbol to the letters that a swap of two code pages (also UTF-8, also twice) turns into it."""
    found: dict[str, set] = {}
    for letter in LETTERS:
        for read in PAGES:
            for written in ("utf-8", *PAGES):
                if written == read:
                    continue
                try:
                    once = letter.encode(written).decode(read)
                except UnicodeError:
                    once = _lenient(letter.encode(written, "ignore"), read) if written == "utf-8" else ""
                if once and once != letter and not once.isascii():
                    found.setdefault(once, set()).add(letter)
                    if written == "utf-8":
                        for again in (once.encode("utf-8", "ignore"),):
                            twice = _lenient(again, read)
                            if twice:
                                found.setdefault(twice, set()).add(letter)
                                thrice = _lenient(twice.encode("utf-8", "ignore"), read)
                                if thrice:
                                    found.setdefault(thrice, set()).add(letter)
    return {s: "".join(sorted(ls)) for s, ls in found.items()}


def _lenient(raw: bytes, page: str) -> str:
    """Decoded, with bytes the page lacks as control characters, as many readers do."""
    out = []
    for b in raw:
        try:
            out.append(bytes([b]).decode(page))
        except UnicodeError:
            out.append(chr(b))
    return "".join(out)


@lru_cache(maxsize=1)
def _groups() -> re.Pattern:
    """Groups of two and more characters that one letter may have become, the longest first."""
    long = sorted((s for s in swaps() if len(s) > 1), key=lambda s: (-len(s), s))
    return re.compile("|".join(map(re.escape, long)))


def _near(c: str, proper: frozenset | None = None) -> str:
    """What a neighbour counts as: letter, digit, blank, sign, or * if unknown."""
    if c == "":
        return " "
    if c.isascii():
        return c if c.isalpha() else "0" if c.isdigit() else " " if c.isspace() else "."
    return c if proper is None or c in proper else "*"


@lru_cache(maxsize=50_000)
def _as_utf8(run: str) -> str | None:
    """A run of another script that was UTF-8 read under some page, read rightly."""
    for page in ("cp1252", "latin-1", "cp1250", "cp850", "cp437", "mac_roman"):
        try:
            raw = b"".join(c.encode(page) if c.encode(page, "ignore") else bytes([ord(c)]) for c in run if ord(c) < 256 or c.encode(page, "ignore"))
            read = raw.decode("utf-8")
        except (UnicodeError, ValueError):
            continue
        if 1 < len(read) < len(run):
            return read
    return None


def symbols(text: str, proper: frozenset) -> list[tuple[int, str, str, str]]:
    """(position, symbol, left, right) of the symbols; single ones only in short runs."""
    out = []
    for run in _OUTSIDE.finditer(text):
        s, begin = run.group(), run.start()
        i, own = 0, []
        if len(s) > 3 and not _groups().match(s) and _as_utf8(s):
            out.append((begin, s, _near(text[begin - 1 : begin], proper), _near(text[run.end() : run.end() + 1], proper)))
            continue
        while i < len(s):
            m = _groups().match(s, i)
            piece = m.group() if m else s[i]
            own.append((i, piece))
            i += len(piece)
        single = sum(len(p) == 1 and p not in proper for _, p in own)
        for i, piece in own:
            if len(piece) == 1 and (piece in proper or single > 2 and not 0x7F < ord(piece) < 0xA0):
                continue
            a, b = begin + i, begin + i + len(piece)
            out.append((a, piece, _near(text[a - 1 : a], proper), _near(text[b : b + 1], proper)))
    return out


class Bigrams:
    """How often characters outside ASCII stand beside which neighbours."""

    def __init__(self, rows):
        self.left, self.right, self.total = Counter(), Counter(), Counter()
        for side, c, near, n in rows:
            if side == "l":
                self.left[near, c] += n
                self.total[c] += n
            else:
                self.right[c, near] += n

    def fit(self, left: str, c: str, right: str) -> float:
        """Log of the expected number of times c stands between these neighbours."""
        t = self.total[c]
        if not t:
            return -12.0
        a = t if left == "*" else self.left[left, c] + 0.05
        b = t if right == "*" else self.right[c, right] + 0.05
        return float(np.log(a * b / (t + 1.0)))


class _Fits:
    """The weight of each letter of LETTERS between two neighbours, computed once a pair."""

    def __init__(self, bigrams: Bigrams):
        self.bigrams, self.known = bigrams, {}

    def of(self, left: str, right: str) -> np.ndarray:
        found = self.known.get((left, right))
        if found is None:
            fits = np.array([self.bigrams.fit(left, c, right) for c in LETTERS])
            found = self.known[left, right] = np.exp(fits - fits.max())
        return found


def _expect(contexts: list[tuple[str, str, int]], fits: _Fits, prior: np.ndarray | None = None, rounds: int = 12) -> np.ndarray:
    """Expectation-maximization for one symbol: the share of each letter of LETTERS.

    contexts: left and right neighbour and number of uses. prior: shares to start from, which
    count as PRIOR uses.
    """
    weight = np.array([fits.of(a, b) for a, b, _ in contexts])
    n = np.array([c[2] for c in contexts], dtype=float)
    share = np.full(len(LETTERS), 1.0 / len(LETTERS)) if prior is None else prior
    more = 0.02 if prior is None else PRIOR * prior + 1e-4
    for _ in range(rounds):
        post = weight * share
        post /= post.sum(axis=1, keepdims=True)
        share = (n[:, None] * post).sum(axis=0) + more
        share /= share.sum()
    return share


def _count(column: str):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for t in batch[column]:
                if t.isascii():
                    continue
                seen = set()
                for m in _OUTSIDE.finditer(t):
                    s = m.group()
                    for i, c in enumerate(s, m.start()):
                        counts["l", c, _near(t[i - 1 : i] if i else "")] += 1
                        counts["r", c, _near(t[i + 1 : i + 2])] += 1
                        seen.add(c)
                counts.update(("d", c, "") for c in seen)
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["side", "c", "near", "n"])

    return work


def language_bigrams(documents: DataFrame, text: str = "text") -> DataFrame:
    """side, c, near, n over all texts: bounded by the characters in use, not by the texts."""
    return (
        documents.filter(F.length(text) > 0).select(F.col(text).alias("t"))
        .mapInPandas(_count("t"), "side string, c string, near string, n bigint")
        .groupBy("side", "c", "near").agg(F.sum("n").alias("n"))
    )


def _model(documents: DataFrame, text: str) -> tuple[Bigrams, frozenset]:
    """The bigrams of LETTERS and of every character as itself, and the proper characters.

    Only characters of the Latin blocks, signs and box lines are brought to the driver, with
    neighbours of the same kind: at most a few ten thousand rows, whatever the number of texts.
    """
    total = documents.filter(F.length(text) > 0).count()
    kept = language_bigrams(documents, text).filter(F.length("c") == 1).filter(
        (F.ascii("c") < 0x530) | F.ascii("c").between(0x2000, 0x25FF) | F.ascii("c").isin(0xF8FF, 0xFB01, 0xFB02)
    ).filter((F.length("near") == 0) | (F.ascii("near") < 0x530) | F.ascii("near").between(0x2000, 0x25FF))
    rows = [(r["side"], r["c"], r["near"], r["n"]) for r in kept.collect()]
    proper = frozenset(c for side, c, _, n in rows if side == "d" and n >= max(2, PROPER * total) and c in LETTERS)
    return Bigrams([r for r in rows if r[0] != "d"]), proper


def _map_of(symbol: str, share: np.ndarray, contexts: list[tuple[str, str, int]]) -> list[tuple[str, float]]:
    """The letters that a symbol was learned to stand for and that pass the check, with their shares."""
    allowed = swaps().get(symbol, "")
    # no text has a group by itself, so one of the letters that make it is meant
    whole = sum(x for c, x in zip(LETTERS, share) if c in allowed) if allowed and len(symbol) > 1 else 1.0
    uses = sum(n for _, _, n in contexts)
    inside = sum(n for a, b, n in contexts if (a.isalpha() or b.isalpha()) and not {a, b} & {"0", "."})
    sure = symbol.isalpha() and len({c[:2] for c in contexts}) >= USES and inside >= IN_WORDS * uses
    return [
        (c, float(x / whole)) for c, x in zip(LETTERS, share)
        if (x > LEAST_SHARE * whole if c in allowed else sure and x >= SURE and c.isalpha())
    ]


def learned_letters(occurrences: DataFrame, bigrams: Bigrams, learn: bool = True) -> DataFrame:
    """source, symbol and the letters it stands for there, each with its share.

    learn: without it all letters keep equal shares (for tests of what learning is worth).
    """
    sent = occurrences.sparkSession.sparkContext.broadcast(bigrams)
    counted = occurrences.groupBy("source", "symbol", "left", "right").agg(F.count("*").alias("n"))
    context = F.struct("left", "right", "n")
    everywhere = counted.groupBy("symbol", "left", "right").agg(F.sum("n").alias("n")).groupBy("symbol").agg(F.collect_list(context).alias("all"))
    by_source = counted.groupBy("source", "symbol").agg(F.collect_list(context).alias("contexts"))

    def over_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fits = _Fits(sent.value)
        for batch in batches:
            shares = [_expect([tuple(c.values()) for c in own], fits).tolist() if learn else [1.0 / len(LETTERS)] * len(LETTERS) for own in batch["all"]]
            yield pd.DataFrame({"symbol": batch["symbol"], "prior": shares})

    def by_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fits = _Fits(sent.value)
        for batch in batches:
            rows = []
            for symbol, source, contexts, prior in batch[["symbol", "source", "contexts", "prior"]].itertuples(index=False):
                own = [tuple(c.values()) for c in contexts]
                share = _expect(own, fits, np.array(prior)) if learn else np.array(prior)
                letters = [{"letter": c, "share": x} for c, x in _map_of(symbol, share, own)]
                if letters:
                    rows.append((source, symbol, letters))
            yield pd.DataFrame(rows, columns=["source", "symbol", "letters"])

    priors = spread(everywhere).mapInPandas(over_all, "symbol string, prior array<double>")
    return spread(by_source.join(priors, "symbol")).mapInPandas(by_one, "source string, symbol string, letters array<struct<letter:string,share:double>>")


def judge(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", learn: bool = True) -> DataFrame:
    """Each symbol occurrence with its letter and how far it beats the symbol itself.

    Result: key, at, symbol, letter (null if it can't be recovered), gain.
    """
    kind = dict(documents.dtypes)[key]
    bigrams, proper = _model(documents, text)
    context = documents.sparkSession.sparkContext
    sent, core = context.broadcast(bigrams), context.broadcast(proper)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, s, t in batch.itertuples(index=False):
                if not t.isascii():
                    rows += [(k, s, *x) for x in symbols(t, core.value)]
            yield pd.DataFrame(rows, columns=["_key", "source", "at", "symbol", "left", "right"])

    some = documents.filter(F.length(text) > 0).select(F.col(key).alias("_key"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("_text"))
    seen = cut(some.mapInPandas(find, f"_key {kind}, source string, at int, symbol string, left string, right string"))
    letters = learned_letters(seen, bigrams, learn)

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, at, symbol, left, right, choices in batch.itertuples(index=False):
                lost = symbol == "�" or len(symbol) == 1 and 0x7F < ord(symbol) < 0xA0
                own = sent.value.fit(left, symbol, right) if len(symbol) == 1 else -6.0
                best, gain = None, 0.0
                if len(symbol) == 1 and symbol.lower() != symbol and symbol.lower() in core.value and not (left.islower() or right.islower()):
                    choices = None  # a proper letter in capitals
                elif len(symbol) > 3 and choices is None and _as_utf8(symbol):
                    best, gain = _as_utf8(symbol), 20.0
                for c in choices if choices is not None else ():
                    g = sent.value.fit(left, c["letter"], right) + 0.5 * np.log(c["share"] + 1e-3) - own
                    if best is None or g > gain:
                        best, gain = c["letter"], float(g)
                rows.append((k, at, symbol, best, 99.0 if lost else gain))
            yield pd.DataFrame(rows, columns=["_key", "at", "symbol", "letter", "gain"])

    return (
        seen.join(letters, ["source", "symbol"], "left")
        .select("_key", "at", "symbol", "left", "right", "letters")
        .mapInPandas(decide, f"_key {kind}, at int, symbol string, letter string, gain double")
        .withColumnRenamed("_key", key)
    )


def affected(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", margin: float = MARGIN) -> DataFrame:
    """The keys of the texts with at least one wrongly decoded stretch."""
    return judge(documents, key, text, source).filter(F.col("gain") > margin).select(key).distinct()


def translated(text: str, found: list[tuple[int, str, str | None]]) -> str:
    """The text with the symbols at the given places replaced by their letters.

    A single character that stands for one letter at all its places goes by translate().
    """
    letters: dict[str, set] = {}
    for _, symbol, letter in found:
        if len(symbol) == 1:
            letters.setdefault(symbol, set()).add(letter)
    places = Counter(symbol for _, symbol, _ in found)
    table = {s: next(iter(ls)) for s, ls in letters.items() if len(ls) == 1 and None not in ls and text.count(s) == places[s]}
    out, at = [], 0
    for place, symbol, letter in found:
        if symbol not in table and letter is not None:
            out += [text[at:place].translate(str.maketrans(table)), letter]
            at = place + len(symbol)
    return "".join(out) + text[at:].translate(str.maketrans(table))


def restore(documents: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", margin: float = MARGIN, learn: bool = True) -> DataFrame:
    """The affected texts restored: key, restored, replaced (symbols), lost (not recovered)."""
    kind = dict(documents.dtypes)[key]
    found = (
        judge(documents, key, text, source, learn).filter(F.col("gain") > margin)
        .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "symbol", "letter"))).alias("_found"))
    )

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, t, found_ in batch.itertuples(index=False):
                places = [tuple(f.values()) for f in found_]
                lost = sum(letter is None for _, _, letter in places)
                rows.append((k, translated(t, places), len(places) - lost, lost))
            yield pd.DataFrame(rows, columns=[key, "restored", "replaced", "lost"])

    return (
        documents.select(key, text).join(found, key).select(key, text, "_found")
        .mapInPandas(rewrite, f"{key} {kind}, restored string, replaced int, lost int")
    )
