"""Repairing text from scanned pages.

Lines are labelled by a hidden Markov model. What a line looks like is observed: blank, page
mark, number, figures, capitals, repeated over the text, and for running text whether it is
indented, or shorter than the text's median line and ends like a sentence. Hidden is what it
is: the start, inside or end of a paragraph, the break between two, page furniture, or the
column of a table. Every line goes through the model, and paragraphs are put together as it
says. The model's counts start from stated ones and are fitted on a bounded sample of texts
(decode, count, repeat). Front matter is read off before.

Words are judged by a lexicon of the whole corpus, the words in at least a given share of
all texts; their number is bounded by the words of a text over that share. How letters are
misread is learned from it: rare words are aligned with many times more frequent ones that
differ in one letter (or in two for one), and what is confused in more than a stated share of
its chances makes the table of confusions; the listed ones count only as a prior worth a few
chances. A word is misread if undoing one or two learned confusions turns it into a word many
times more frequent; a word that the lexicon lacks counts as often as it may be without being
there. All bounds are shares of the texts, so verdicts don't change with their number, except
where a share is less than one text. A word broken at a line end is judged whole. A lexicon of
more words than a worker holds is split into parts: every different word is looked up in each,
judged by all that was found, and the verdicts go back to the texts, which gives the same rows.

``defects`` lists the defective lines, ``paragraphs`` gives the repaired text.

Defined cases: null, empty and blank texts give no rows; lines end at a line feed only;
repeated texts give their own rows; a text without front matter is body from its first line.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import accumulate, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vellumine.llm.edits import fold
from vellumine.llm.sampling import bounded
from vellumine.session import cut, spread

#: A word of the lexicon is in this share of the texts, and never in one text only.
SHARE = 5e-5
#: Bounds in units of SHARE of the texts, or of one text where that is less: least of a word
#: and of a part of compounds that others may be misread from, of a common and of a frequent
#: word; most of a word judged as a compound; least of a word that counts as known.
TARGET, PART, COMMON, FREQUENT, RARE, KNOWN = 8, 24, 50, 10, 6, 3
#: A misread word is at least so many times rarer than the word it was.
RATIO = 20
#: A shorter word has too many neighbours to be judged; a longer run of letters is junk.
SHORTEST, LONGEST = 4, 45
#: Most words of a lexicon that is sent to the workers, some 600 bytes a word there; a larger one goes in parts.
HELD_WORDS = 1_000_000
#: About so many words make a part, as a task holds it beside its sorted rows; it only tells how many parts there are.
HELD_PART = 250_000
#: Texts that share one table of verdicts where the lexicon goes in parts, as a power of two.
CHUNK_BITS = 10
#: Texts of the sample on which the model's counts are fitted.
SAMPLE = 500

# Marks that stand for a hyphen at a line end; digits as they are misread.
HYPHENS = "-‐=¬–—\xad"
_D = "[0-9OoIlZSBb]"
_PAGE_WORDS = "Page|Seite|Blatt|Pagina|Foglio|Feuille|Sheet|Pag|Bl"
_SPECIAL = re.compile(
    rf"""^[^\S\n]*(?:
    (?P<P>[—–\-\[(]\s?{_D}{{1,3}}\s?[—–\-\])]|{_D}{{1,3}}\s?/\s?{_D}{{1,4}}|(?:{_PAGE_WORDS})\.?[ ]{_D}{{1,4}}|{_D}{{1,3}}[ ]{{2,}}{_D}{{2}}[ ]?{_D}{{3}}|(?:Nr|No|N)\.?[ ]?{_D}{{2}}[ ]?{_D}{{3}}[ ]{{2,}}{_D}{{1,3}})
    |(?P<N>(?:Nr|No|N)\.?[ ]?{_D}{{2}}[ ]?{_D}{{3}})
    |(?P<n>{_D}{{2}}[ ]?{_D}{{3}})
    |(?P<d>{_D}{{1,3}})
    |(?P<f>[0-9OoIlZSBb]{{1,4}}[.,][0-9OoIlZSBb]{{1,3}}(?:\s+[0-9OoIlZSBb]{{1,4}}[.,][0-9OoIlZSBb]{{1,3}})*)
    |(?P<H>[^\na-zà-öø-ÿ0-9]{{4,40}}:)
    |(?P<C>(?=[^\n]*[A-ZÀ-ÖØ-Þ]{{3}})[^\na-zà-öø-ÿ]{{6,}})
    |(?P<j>[^\w\n]{{4,}}|(?P<again>[^\n]{{1,4}}?)(?P=again){{5,}}[^\n]{{0,4}})
    )[^\S\n]*$""",
    re.M | re.X,
)
_BLANK = re.compile(r"^[^\S\n]*$", re.M)
#: Digits that the first letter of a word may be misread as; fixed value.
FIRST_DIGITS = "015689"
#: Such a digit begins a word if letters follow; not behind another digit or in a decimal fraction.
_AS_LETTER = rf"(?<=[{FIRST_DIGITS}])(?<![^\W_].)(?<!\d[.,].)(?=[^\W\d_]{{2}})"
_WORD = re.compile(rf"[^\W_](?:(?<!\d)|{_AS_LETTER})[^\W_]*")
_LAST_DIGIT = re.compile(rf"\d{_AS_LETTER}[^\W\d_]+[{HYPHENS}]*$")
_ENDING = re.compile(rf"(?:.*[\W\d_])?([^\W\d_]+)([{HYPHENS}]*)$")
_JOIN = re.compile(rf"[{HYPHENS}](?<=[^\W\d_].)[^\S\n]*\n+[^\S\n]*(?=[^\W\d_])")
_FIRST = re.compile(r"[^\S\n]*([^\W\d_]*)")
#: Words after which a part of a word stands alone ("Ein- und"); fixed values.
SUSPENDED = {"und", "oder", "bzw", "sowie", "bis", "et", "ou", "e", "ed", "o", "and", "or", "to"}
_FRONT = re.compile(r"\s*(?:Erfinder|Inventor|Inventeur|Inventore|Ausgegeben|Publi|Pubbli|Angemeldet|Demand|Filed|Deposit|Klasse|Classe|Class|Patentiert|Nr\.|No\.?\s|N\.\s|DESCRI|BESCHREI|Anmelder|Titulaire|Applicant)")

#: Start, inside and end of a paragraph, break, furniture, table.
STATES = "SBEKRT"
#: Running text (plain, short with an end of a sentence, indented), repeated, blank, and the looks of _SPECIAL.
LOOKS = "xsih_PNndfHCj"
TEXT = "xsih"
#: Starting counts of the model, a row each state; fixed values.
_EMIT = np.array([
    [2000, 40, 300, 20, 0.1, 0.01, 0.1, 0.05, 0.1, 2, 60, 0.05, 5],
    [8000, 20, 60, 20, 0.5, 0.1, 0.2, 0.2, 1, 5, 40, 0.3, 15],
    [900, 1500, 30, 10, 0.1, 0.01, 0.05, 0.02, 0.05, 3, 20, 0.05, 5],
    [0.1, 0.1, 0.1, 0.05, 5000, 0.1, 0.1, 0.1, 0.1, 0.1, 0.5, 0.1, 0.5],
    [0.02, 0.01, 0.01, 15, 1000, 700, 300, 200, 400, 2, 0.1, 300, 2],
    [0.1, 0.1, 0.1, 1, 20, 0.05, 0.3, 20, 300, 600, 0.5, 0.5, 20],
])
_MOVE = np.array([
    [20, 8000, 1500, 5, 200, 10],
    [50, 8000, 1500, 20, 200, 20],
    [600, 30, 60, 1500, 200, 20],
    [1200, 20, 150, 150, 4, 10],
    [150, 500, 100, 8, 1600, 10],
    [50, 20, 20, 50, 50, 800],
], dtype=float)
_FIRST_STATE = np.log(np.array([0.6, 0.2, 0.1, 0.05, 0.04, 0.01]))


class LineModel:
    """The hidden Markov model of lines."""

    def __init__(self, emit: np.ndarray = _EMIT, move: np.ndarray = _MOVE):
        self.emit = np.log(emit / emit.sum(axis=1, keepdims=True))
        self.move = np.log(move / move.sum(axis=1, keepdims=True))

    def label(self, looks: str) -> str:
        """The likeliest states of the lines of one text."""
        return self.label_all([looks])[0]

    def label_all(self, looks: list[str]) -> list[str]:
        """The likeliest states of the lines of each text; texts of about equal length are decoded together."""
        out = [""] * len(looks)
        order = sorted((i for i in range(len(looks)) if looks[i]), key=lambda i: -len(looks[i]))
        at = 0
        while at < len(order):
            longest = len(looks[order[at]])
            some = order[at : at + max(1, 400_000 // longest)]
            for i, path in zip(some, self._decode([looks[i] for i in some])):
                out[i] = path
            at += len(some)
        return out

    def _decode(self, looks: list[str]) -> list[str]:
        """Viterbi over texts in order of falling length."""
        lengths = np.array([len(x) for x in looks])
        seen = np.zeros((len(looks), lengths[0]), dtype=np.int8)
        for row, own in zip(seen, looks):
            row[: len(own)] = _LOOK_OF[np.frombuffer(own.encode("ascii"), dtype=np.uint8)]
        back = np.zeros((lengths[0], len(looks), len(STATES)), dtype=np.int8)
        score = _FIRST_STATE + self.emit[:, seen[:, 0]].T
        for t in range(1, lengths[0]):
            n = int(np.searchsorted(-lengths, -t, "left"))  # texts with a line t
            ways = score[:n, :, None] + self.move
            back[t, :n] = ways.argmax(axis=1)
            score[:n] = ways.max(axis=1) + self.emit[:, seen[:n, t]].T
        state = score.argmax(axis=1)
        paths = np.zeros(seen.shape, dtype=np.int8)
        for t in range(lengths[0] - 1, -1, -1):
            n = int(np.searchsorted(-lengths, -t, "left"))
            paths[:n, t] = state[:n]
            if t:
                state[:n] = back[t, np.arange(n), state[:n]]
        return [_STATE_OF[row[:n]].tobytes().decode("ascii") for row, n in zip(paths, lengths)]


_LOOK_OF = np.zeros(128, dtype=np.int8)
_LOOK_OF[[ord(c) for c in LOOKS]] = range(len(LOOKS))
_STATE_OF = np.frombuffer(STATES.encode("ascii"), dtype=np.uint8)
#: What a repeated line is compared by.
_NO_DIGITS = re.compile(r"[\W\d_]+")


class Page:
    """The lines of one text with their looks, its front matter and its title."""

    __slots__ = ("lines", "looks", "body", "title")

    def __init__(self, text: str):
        self.lines = text.split("\n")
        looks = ["x"] * len(self.lines)
        starts = [0, *accumulate(len(line) + 1 for line in self.lines)]
        for m in _SPECIAL.finditer(text):
            look = m.lastgroup if m.lastgroup in LOOKS else "j"
            if look == "d" and len(m.group().strip()) > 1 and not any(c.isdigit() for c in m.group()):
                look = "x"
            looks[bisect_right(starts, m.start()) - 1] = look
        for i, line in enumerate(self.lines):
            if not line or line.isspace():
                looks[i] = "_"
        self.title = ""
        self.body = self._front_end(looks)
        if self.title:
            wanted = self.title
            start, near = wanted[:4].lower(), fold(wanted)[:4]
            for i in range(self.body, len(looks)):
                line = self.lines[i]
                if looks[i] == "x" and 10 <= len(line) <= len(wanted) + 12 and line.lstrip()[:4].lower() in (start, near) and _same_head(line, wanted):
                    looks[i] = "C"
        self._text_looks(looks)
        self.looks = "".join(looks)

    @classmethod
    def restored(cls, text: str, looks: str, states: str) -> Page:
        """The page of a text whose lines were labelled before; its title isn't needed any more."""
        page = cls.__new__(cls)
        page.lines, page.looks, page.body, page.title = text.split("\n"), looks, states.count("F"), ""
        return page

    def _text_looks(self, looks: list[str]) -> None:
        """Tells lines of running text apart by their layout and by their repetition in the text."""
        own = [i for i in range(self.body, len(looks)) if looks[i] == "x"]
        if not own:
            return
        median = sorted(len(self.lines[i]) for i in own)[len(own) // 2]
        short = {}
        for i in own:
            line = self.lines[i]
            end = line.rstrip()[-1]
            if len(line) < 0.75 * median and end in ".:;!?":
                looks[i] = "s"
            elif line[:2].isspace():
                looks[i] = "i"
            if len(line) <= 60 and end not in ".,:;-":
                short.setdefault(_NO_DIGITS.sub("", line).lower(), []).append(i)
        for key, places in short.items():
            if len(key) > 3 and len(places) > 1 and places[1] - places[0] > 5:
                for i in places:
                    looks[i] = "h"

    def _front_end(self, looks: list[str]) -> int:
        """Number of the first line behind the front matter; finds the title on the way."""
        last, others = -1, 0
        for i, line in enumerate(self.lines):
            if looks[i] == "_":
                continue
            if _FRONT.match(line):
                last = i
                continue
            # between the lines of the front matter stand but parties; then come title and text
            others += not (line.rstrip().endswith(".") and ("(" in line or "," in line))
            if others > 1:
                break
        if last < 0:
            return 0
        for i in range(last + 1, len(self.lines)):
            line = self.lines[i].strip()
            if not line:
                continue
            if looks[i] not in "xC":
                return i
            if line.endswith("."):
                # a party stands on one line; a sentence that is no party is body already
                if i - last <= 8 and ("(" in line or "," in line):
                    continue
                return i
            self.title = line
            return i + 1
        return len(self.lines)


def labelled(texts: list[str], model: LineModel) -> list[tuple[Page, str]]:
    """The pages of texts and the states of all their lines; F for the front matter."""
    pages = [Page(t) for t in texts]
    states = model.label_all([p.looks[p.body :] for p in pages])
    return [(p, "F" * p.body + s) for p, s in zip(pages, states)]


def _ending(line: str) -> tuple[str, bool]:
    """The last word of a line, and whether a hyphen follows it; empty if it ends otherwise."""
    line = line.rstrip()
    m = _ENDING.match(line[line.rfind(" ") + 1 :])
    return (m.group(1), bool(m.group(2))) if m else ("", False)


def _same_head(line: str, title: str) -> bool:
    """Whether the line is the title or its beginning, with or without a page number behind."""
    a, b = fold(re.sub(r"\s{2,}\S{1,4}$", "", line.strip())), fold(title)
    if len(a) > len(b) + 2:
        return False
    return sum(x != y for x, y in zip(a, b)) <= len(a) // 10


def fit_lines(texts: list[str], rounds: int = 2) -> LineModel:
    """The model with its counts fitted on texts: decode, count with the starting counts, repeat."""
    model = LineModel()
    for _ in range(rounds):
        emit, move = _EMIT.copy(), _MOVE.copy()
        for page, states in labelled(texts, model):
            states = states[page.body :]
            for s, look in zip(states, page.looks[page.body :]):
                emit[STATES.index(s), LOOKS.index(look)] += 1
            for a, b in zip(states, states[1:]):
                move[STATES.index(a), STATES.index(b)] += 1
        model = LineModel(emit, move)
    return model


# Words ----------------------------------------------------------------------------------

#: Letters that are often misread for one another, by classes, and groups read as one letter: what
#: is believed before anything is learned. Fixed values.
CLASSES = ("eécoaó0", "iíl1jì", "unü", "ftrsvy5", "hbB8ß6", "gq9", "dD", "kK")
GROUPS = (("rn", "m"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("jo", "io"))
#: That belief as a share of the chances, and how many chances it is worth.
BELIEVED, CHANCES = 0.02, 50
#: A confusion is learned if it happens in this share of its chances, and more than twice.
LEARNED, FIRST_SHARE = 0.004, 0.1
#: Most letters or groups of a word that may be misread, in short and in long words.
FEW, MORE = 1, 2


def learned_confusions(words: dict[str, int], ratio: int = RATIO) -> dict[str, tuple[str, ...]]:
    """What a letter or a pair of letters may be a misreading of, learned from words and their counts.

    Words that are equal but for one letter, or for two in place of one or one of two, and of which
    one is ``ratio`` times rarer, are aligned. The last two letters are left out, where inflected
    forms differ. A chance is a frequent word's letter, or two letters, in a place. A digit in
    place of the first letter is never proper, so there a share of the digit's alignments counts.
    """
    low: Counter = Counter()
    for w, n in words.items():
        if 5 <= len(w) <= 20:
            low[w[:1].lower() + w[1:]] += n
    # the most frequent filling of each gap of one letter and of two
    most: dict[tuple[str, str, int], tuple[int, str]] = {}
    for w, n in low.items():
        for i in range(len(w) - 2):
            for size in (1, 2):
                key = w[:i], w[i + size :], size
                if i + size < len(w) - 1 and (n, w[i : i + size]) > most.get(key, (0, "")):
                    most[key] = n, w[i : i + size]
    seen: Counter = Counter()
    chances = Counter(part for (before, _, _), (_, part) in most.items() if before)
    for w, n in low.items():
        for i in range(len(w) - 2):
            for size in (1, 2):
                part = w[i : i + size]
                if i + size >= len(w) - 1 or not i and not part[0].isdigit():
                    continue
                for meant in (1, 2) if size == 1 else (1,):
                    top, other = most.get((w[:i], w[i + size :], meant), (0, ""))
                    if part != other and n * ratio <= top:
                        seen[part, other, not i] += 1
    digits: Counter = Counter()
    for (a, _, first), n in seen.items():
        digits[a] += n * first
    return _confusions(seen, chances, digits)


def _believed() -> set[tuple[str, str]]:
    believed = {(a, b) for group in CLASSES for a in group for b in group if a != b} | set(GROUPS)
    return believed | {(b, a) for a, b in GROUPS}


def _confusions(seen: Counter, chances: Counter, digits: Counter) -> dict[str, tuple[str, ...]]:
    """The confusions of counted alignments (part, other, whether in front), chances of a part, and alignments of a first digit."""
    believed = _believed()
    out: dict[str, set[str]] = {}
    for a, b in believed | {(a, b) for (a, b, _), n in seen.items() if n > 2}:
        n, first, belief = seen[a, b, False], seen[a, b, True], CHANCES * BELIEVED * ((a, b) in believed)
        inside = (n + belief) / (chances[b] + CHANCES) >= LEARNED
        in_front = a.isdigit() and (first > 2 or belief) and first + belief >= FIRST_SHARE * (digits[a] + 1)
        if inside or in_front:
            out.setdefault(a, set()).add(b)
    return {a: tuple(sorted(bs)) for a, bs in out.items()}


def floor(total: int, share: float = SHARE) -> int:
    """In how many of ``total`` texts a word of the lexicon is at least."""
    return max(2, int(share * total))


def entries_of(word: str, n: int) -> Iterator[tuple[str, str, int]]:
    """(kind, key, count) of what a word in ``n`` texts adds to a lexicon.

    The kinds: w, its count; u, capitals less small letters it begins with; for one that may be a
    compound, c, its count as that, h and t, its first and last parts.
    """
    low = word[:1].lower() + word[1:]
    yield "w", low, n
    yield "u", low, n if word[0].isupper() else -n
    if 8 <= len(word) <= LONGEST and word[0].isupper() and n >= 2:
        yield "c", low, n
        for i in range(4, len(word) - 3):
            yield "h", word[:i].lower(), n
            yield "t", word[i:], n


class Lexicon:
    """Words with the number of texts they are in, without regard to the first letter's case.

    ``entries`` are given in place of words for a part of a lexicon, ``top`` is then the whole's.
    """

    def __init__(
        self, words: dict[str, int], ratio: int = RATIO, total: int = 0, share: float = SHARE, confusions: dict[str, tuple[str, ...]] | None = None,
        entries: Iterator[tuple[str, str, int]] | None = None, top: int = 0,
    ):
        self.ratio = ratio
        self.confusions = learned_confusions(words, ratio) if confusions is None else confusions
        #: The unit of the bounds, and the most texts that a word may be in without being here.
        self.unit = max(1.0, share * total)
        self.unseen = max(floor(total, share) - 1, 1)
        self.tables: dict[str, Counter] = {kind: Counter() for kind in "wucht"}
        for kind, key, n in (e for w, n in words.items() for e in entries_of(w, n)) if entries is None else entries:
            self.tables[kind][key] += n
        self.words = self.tables["w"]
        #: Words that mostly begin with a capital.
        self.capital = {w for w, n in self.tables["u"].items() if n > 0}
        #: Words that others may be misread from, and what they begin with.
        self.targets = {w for w, n in self.words.items() if n >= TARGET * self.unit and w[0] not in FIRST_DIGITS and SHORTEST <= len(w) <= LONGEST}
        self.prefixes = {w[:i] for w in self.targets for i in range(1, len(w) + 1)}
        # First and last parts of compounds.
        self.compounds = self.tables["c"]
        self.parts = self.tables["h"], self.tables["t"]
        if entries is None:
            del self.tables["u"]  # is asked of parts only
        self.top = max(self.words.values(), default=0) if entries is None else top
        self.known: dict[str, str | None] = {}

    def looked_up(self, word: str) -> Iterator[tuple[str, str, int]]:
        """The entries held here on which the word's count and correction may rest."""
        low = word[:1].lower() + word[1:]
        asked = {("w", low)}
        if SHORTEST <= len(word) <= LONGEST and not word.isupper():
            digit = low[0] in FIRST_DIGITS
            if digit:
                asked.add(("w", low[1:2].lower() + low[2:]))
            for _, w in self.repairs(low, FEW if len(word) < 7 else MORE):
                asked |= {("w", w), ("u", w)}
            if len(word) >= 8 and (digit or word[0].isupper()):
                asked.add(("c", low))
                asked |= {e for i in range(4, len(low) - 3) for e in (("h", low[:i]), ("t", low[i:]))}
                asked |= {("h", w) for w in self._heads_like(low)} | {("t", w) for w in self._tails_like(low)}
        for kind, key in asked:
            if key in self.tables[kind]:
                yield kind, key, self.tables[kind][key]

    def undone(self, word: str) -> list[str]:
        """The word with one confusion undone, in all ways."""
        out = []
        for i in range(len(word)):
            for size in (1, 2):
                part = word[i : i + size]
                for meant in self.confusions.get(part, ()) if len(part) == size else ():
                    out.append(word[:i] + meant + word[i + size :])
        return out

    def repairs(self, low: str, most: int) -> list[tuple[int, str]]:
        """(confusions undone, word) of all words that may be meant: read from left to right, as long as a word begins so."""
        out, open_ = [], [(0, "", 0)]
        while open_:
            at, done, undone = open_.pop()
            if at == len(low):
                if undone and done in self.targets:
                    out.append((undone, done))
                continue
            if done + low[at] in self.prefixes:
                open_.append((at + 1, done + low[at], undone))
            if undone < most:
                for size in (1, 2):
                    for meant in self.confusions.get(low[at : at + size], ()) if at + size <= len(low) else ():
                        if done + meant in self.prefixes:
                            open_.append((at + size, done + meant, undone + 1))
        return out

    @cached_property
    def frequent_parts(self) -> tuple[set[str], set[str], set[str], set[str]]:
        """First and last parts of compounds that others may be misread from, what those begin with and what these end with."""
        heads, tails = ({w for w, n in counts.items() if n >= PART * self.unit} for counts in self.parts)
        return heads, tails, {w[:i] for w in heads for i in range(len(w) + 1)}, {w[i:] for w in tails for i in range(len(w) + 1)}

    def _heads_like(self, low: str) -> Iterator[str]:
        """The frequent first parts that a beginning of the word is with one confusion undone, read from left to right."""
        heads, _, prefixes, _ = self.frequent_parts
        open_ = [(0, "", False)]
        while open_:
            at, done, undone = open_.pop()
            if undone and at >= 4 and done in heads:
                yield done
            if at == len(low) - 4:
                continue
            if done + low[at] in prefixes:
                open_.append((at + 1, done + low[at], undone))
            for size in (1, 2) if not undone else ():
                for meant in self.confusions.get(low[at : at + size], ()) if at + size <= len(low) - 4 else ():
                    if done + meant in prefixes:
                        open_.append((at + size, done + meant, True))

    def _tails_like(self, low: str) -> Iterator[str]:
        """The same of the last parts and the ends of the word, read from right to left."""
        _, tails, _, suffixes = self.frequent_parts
        open_ = [(len(low), "", False)]
        while open_:
            at, done, undone = open_.pop()
            if undone and at <= len(low) - 4 and done in tails:
                yield done
            if at == 4:
                continue
            if low[at - 1] + done in suffixes:
                open_.append((at - 1, low[at - 1] + done, undone))
            for size in (1, 2) if not undone else ():
                for meant in self.confusions.get(low[at - size : at], ()) if at - size >= 4 else ():
                    if meant + done in suffixes:
                        open_.append((at - size, meant + done, True))

    def count(self, word: str) -> int:
        """Number of texts with the word."""
        return self.words.get(word[:1].lower() + word[1:], 0)

    def correction(self, word: str) -> str | None:
        """The word this one is misread from, or None."""
        if word not in self.known:
            if len(self.known) > 500_000:
                self.known.clear()
            self.known[word] = self._correction(word)
        return self.known[word]

    def _correction(self, word: str) -> str | None:
        if not SHORTEST <= len(word) <= LONGEST or word.isupper():
            return None
        low = word[:1].lower() + word[1:]
        own = max(self.words.get(low, 0), self.unseen)
        digit = low[0] in FIRST_DIGITS
        if digit:  # else it's a reference sign and a word without a blank between them
            own = max(own, self.count(low[1:]))
        least = max(self.ratio * own, TARGET * self.unit)
        if least > self.top:
            return None
        most = FEW if len(word) < 7 else MORE
        good = [(-d, self.words[w], w) for d, w in self.repairs(low, most) if self.words[w] >= least]
        best = max(good)[2] if good else None
        compound = best is None and own <= RARE * self.unit and len(word) >= 8 and (digit or word[0].isupper())
        if compound:
            best = self._compound(low)
        if best is None:
            return None
        return best[:1].upper() + best[1:] if word[0].isupper() or digit and (compound or best in self.capital) else best

    def _compound(self, low: str) -> str | None:
        """A compound of the parts of other compounds that the word is misread from."""
        heads, tails = self.parts
        # as often as the word's own parts are in other compounds
        own = self.compounds.get(low, 0)
        here = max((min(heads[low[:i]], tails[low[i:]]) - own for i in range(4, len(low) - 3)), default=0)
        least = max(self.ratio * max(here, self.unseen), PART * self.unit)
        best, most = None, 0
        for i in range(4, len(low) - 3):
            # each part as it is or with one confusion undone, at least one of them undone
            first = self._parts_like(low[:i], heads, least)
            last = self._parts_like(low[i:], tails, least) if first else []
            for (a, x, undone), (b, y, undone_too) in product(first, last):
                if undone + undone_too and min(x, y) > most:
                    best, most = a + b, min(x, y)
        return best

    @staticmethod
    def _frequent(part: str, counts: Counter, least: float) -> int:
        n = counts.get(part, 0)
        return n if n >= least else 0

    def _parts_like(self, part: str, counts: Counter, least: float) -> list[tuple[str, int, int]]:
        """(part, count, confusions undone): the part itself and its most frequent repair, where frequent enough."""
        out = []
        if n := self._frequent(part, counts, least):
            out.append((part, n, 0))
        repairs = [(n, w) for w in self.undone(part) if (n := self._frequent(w, counts, least))]
        if repairs:
            n, w = max(repairs)
            out.append((w, n, 1))
        return out


def _words_of(text: str) -> set[str]:
    return set(_WORD.findall(_JOIN.sub("", text)))


def counted_words(rows: DataFrame, text: str = "ocr_text", share: float = SHARE) -> tuple[DataFrame, int]:
    """Words in at least ``share`` of all texts (word, n), counted over all and written; the number of all texts.

    The share bounds their number: at most the words of a mean text divided by the share.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch["t"]:
                counts.update(_words_of(t))
            if len(counts) > 300_000:
                yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                counts = Counter()
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    some = rows.filter(F.length(text) > 0).select(F.col(text).alias("t"))
    total = some.count()
    counted = some.mapInPandas(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= floor(total, share))
    return cut(counted), total


def _held(kept: DataFrame) -> dict[str, int]:
    return {r["word"]: r["n"] for r in kept.toLocalIterator()}


def lexicon_of(rows: DataFrame, text: str = "ocr_text", share: float = SHARE, most: int = HELD_WORDS) -> tuple[dict[str, int], int, float]:
    """The counted words as one dictionary of at most ``most``, the number of all texts, and the share they are in.

    The share is doubled until the words fit. ``defects`` and ``paragraphs`` don't rest on a
    raised share: they take all words, in parts if need be.
    """
    kept, total = counted_words(rows, text, share)
    while kept.count() > most:
        share *= 2
        kept = kept.filter(F.col("n") >= floor(total, share))
    return _held(kept), total, share


def _prose(page: Page, states: str) -> list[int]:
    """The lines of running text."""
    return [i for i in range(page.body, len(page.lines)) if states[i] in "SBE" and page.looks[i] in TEXT]


def _line_ends(page: Page, prose: list[int]) -> Iterator[tuple[int, int, str, bool, str]]:
    """(line, the next of running text, the last word of the one, whether a hyphen follows it, the first of the other), where there are both."""
    for i, j in zip(prose, prose[1:]):
        before, hyphen = _ending(page.lines[i])
        after = _FIRST.match(page.lines[j]).group(1) if before else ""
        if after:
            yield i, j, before, hyphen, after


def _last_digit(line: str) -> str:
    """The digit that the last word of a line may begin with, or nothing."""
    digit = _LAST_DIGIT.search(line.rstrip())
    return digit.group()[0] if digit else ""


def line_defects(text: str, model: LineModel, lexicon: Lexicon) -> list[tuple[int, str]]:
    """(line number from 1, kind) of every defect of one text."""
    return defects_of(text, *labelled([text], model)[0], lexicon)


def defects_of(text: str, page: Page, states: str, lexicon: Lexicon) -> list[tuple[int, str]]:
    """The defects of one text whose lines are labelled."""
    lines = page.lines
    out = [(i + 1, "running") for i, s in enumerate(states) if s == "R" and page.looks[i] != "_"]
    prose = _prose(page, states)
    misread: set[int] = set()
    parts: set[tuple[int, int]] = set()  # (line, 0 for its first word, 1 for its last) that are parts of words
    for i, j, before, hyphen, after in _line_ends(page, prose):
        if hyphen:
            parts |= {(i, 1), (j, 0)}
            whole = before + after
            own = lexicon.count(whole)
            if after in SUSPENDED and own < KNOWN * lexicon.unit or after[0].isupper() and not before.isupper() and own < KNOWN * lexicon.unit and lexicon.count(after) > COMMON * lexicon.unit:
                parts.discard((j, 0))
                continue
            out.append((i + 1, "hyphen"))
            digit = _last_digit(lines[i])
            whole = digit + whole
            right = lexicon.correction(whole)
            if right:
                at = next((k for k, (x, y) in enumerate(zip(whole, right)) if x != y), len(whole) - 1)
                misread.add(i if at < len(before) + len(digit) else j)
        elif after[0].islower() and len(before) > 2 and lexicon.count(before) < KNOWN * lexicon.unit:
            # the hyphen itself may be lost
            if lexicon.count(before + after) >= FREQUENT * lexicon.unit and lexicon.correction(before) is None:
                parts |= {(i, 1), (j, 0)}
                out.append((i + 1, "hyphen"))
    wrong = {w for w in set(_WORD.findall(text)) if lexicon.correction(w)}
    if wrong:
        some = re.compile("|".join(map(re.escape, sorted(wrong))))
        for i in prose:
            if i not in misread and some.search(lines[i]):
                words = _WORD.findall(lines[i])
                if not wrong.isdisjoint(words[(i, 0) in parts : len(words) - ((i, 1) in parts)]):
                    misread.add(i)
    out += [(i + 1, "misread") for i in misread]
    return sorted(out)


class _Worker:
    """What a worker needs, built once from the broadcast parts."""

    kept: dict[int, tuple[LineModel, Lexicon]] = {}

    @classmethod
    def of(cls, sent) -> tuple[LineModel, Lexicon]:
        key = id(sent.value)
        if key not in cls.kept:
            model, words, total, confusions = sent.value
            cls.kept = {key: (model, Lexicon(words, total=total, confusions=confusions))}
        return cls.kept[key]


def _texts(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.filter(F.length(text) > 0).select(F.col(key).alias("_key"), F.col(text).alias("_text"))


def _over(rows: DataFrame, key: str, text: str, most: int, of: Callable, ends: bool, columns: str) -> DataFrame:
    """What ``of`` makes of every text with its labels and the lexicon; ``ends`` if it joins words over line ends."""
    model = fit_lines([t for _, t in bounded(rows, text, SAMPLE)])
    kept, total = counted_words(rows, text)
    schema = f"_key {dict(rows.dtypes)[key]}, {columns}"
    names = ["_key", *(c.split()[0] for c in columns.split(", "))]
    size = kept.count()
    if size > most:
        return _over_parts(_texts(rows, key, text), model, kept, total, -(-size // min(most, HELD_PART)), of, ends, schema).withColumnRenamed("_key", key)
    words = _held(kept)
    sent = rows.sparkSession.sparkContext.broadcast((model, words, total, learned_confusions(words)))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, lexicon = _Worker.of(sent)
        for batch in batches:
            out = []
            for at in range(0, len(batch), 1_000):
                keys, texts = batch["_key"].iloc[at : at + 1_000].tolist(), batch["_text"].iloc[at : at + 1_000].tolist()
                for k, t, (page, states) in zip(keys, texts, labelled(texts, model)):
                    out += [(k, *x) for x in of(t, page, states, lexicon)]
            yield pd.DataFrame(out, columns=names)

    return _texts(rows, key, text).mapInPandas(work, schema).withColumnRenamed("_key", key)


def defects(rows: DataFrame, key: str = "rec_id", text: str = "ocr_text", most: int = HELD_WORDS) -> DataFrame:
    """The defective lines: key, line_no, defect (hyphen, misread, running); one row each. A lexicon of over ``most`` words goes in parts."""
    return _over(rows, key, text, most, defects_of, True, "line_no int, defect string")


def repaired(text: str, model: LineModel, lexicon: Lexicon) -> list[str]:
    """The paragraphs of a text: furniture left out, lines joined, words put right."""
    return paragraphs_of(*labelled([text], model)[0], lexicon)


def paragraphs_of(page: Page, states: str, lexicon: Lexicon) -> list[str]:
    """The paragraphs of a text whose lines are labelled; the model's states tell where they break."""
    looks, lines = page.looks, page.lines
    out: list[str] = []
    current, broken = "", False
    for i in range(len(lines)):
        look, state, line = looks[i], states[i], lines[i].strip()
        if state in "RK" or look == "_":
            broken = broken or state == "K"
            continue
        if state == "F" or look not in TEXT:
            if current:
                out.append(current)
            out.append(line)
            current, broken = "", False
            continue
        line = _WORD.sub(lambda m: lexicon.correction(m.group()) or m.group(), line)
        if current and (broken or state == "S"):
            out.append(current)
            current = ""
        first = _FIRST.match(line).group(1)
        if current and _ending(current[-80:])[1] and first and first not in SUSPENDED:
            current = current.rstrip().rstrip(HYPHENS) + line
        else:
            current = f"{current} {line}" if current else line
        broken = state == "E"
    if current:
        out.append(current)
    return out


def _numbered(text: str, page: Page, states: str, lexicon) -> list[tuple[int, str]]:
    return list(enumerate(paragraphs_of(page, states, lexicon), 1))


def paragraphs(rows: DataFrame, key: str = "rec_id", text: str = "ocr_text", most: int = HELD_WORDS) -> DataFrame:
    """The repaired texts: key, par_no from 1, paragraph. A lexicon of over ``most`` words goes in parts."""
    return _over(rows, key, text, most, _numbered, False, "par_no int, paragraph string")


# Lexicons in parts ----------------------------------------------------------------------


class Verdicts:
    """What a lexicon says of the words of some texts, looked up before."""

    def __init__(self, unit: float):
        self.unit = unit
        self.counts: dict[str, int] = {}
        self.right: dict[str, str] = {}

    def count(self, word: str) -> int:
        return self.counts.get(word, 0)

    def correction(self, word: str) -> str | None:
        return self.right.get(word)


def asked_words(text: str, page: Page | None, states: str) -> dict[str, bool]:
    """The words of a text that are judged, and whether their count is asked too; without a page, none over line ends."""
    out = dict.fromkeys(_WORD.findall(text), False)
    for i, _, before, _, after in _line_ends(page, _prose(page, states)) if page else ():
        out.setdefault(_last_digit(page.lines[i]) + before + after, False)
        out |= {before: True, after: True, before + after: True}
    return out


def confusions_of(kept: DataFrame, ratio: int = RATIO) -> dict[str, tuple[str, ...]]:
    """``learned_confusions`` of a table of words and counts of any size; only pairs of letters come to the driver."""

    def lows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(w[:1].lower() + w[1:], n) for w, n in zip(batch["word"], batch["n"]) if 5 <= len(w) <= 20]
            yield pd.DataFrame(out, columns=["low", "n"])

    def gaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for w, n in zip(batch["low"], batch["n"]):
                for i in range(len(w) - 2):
                    for size in (1, 2):
                        if i + size < len(w) - 1:
                            out.append((w[:i], w[i + size :], size, w[i : i + size], n, bool(i) or w[0].isdigit()))
            yield pd.DataFrame(out, columns=["before", "after", "size", "part", "n", "asks"])

    low = kept.mapInPandas(lows, "low string, n bigint").groupBy("low").agg(F.sum("n").alias("n"))
    gap = cut(low.mapInPandas(gaps, "before string, after string, size int, part string, n bigint, asks boolean"))
    tops = cut(gap.groupBy("before", "after", "size").agg(F.max(F.struct("n", "part")).alias("most")).select("before", "after", "size", F.col("most.n").alias("top"), F.col("most.part").alias("other")))
    meant = F.explode(F.when(F.col("size") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    met = gap.filter("asks").select("before", "after", "part", "n", meant.alias("size")).join(tops, ["before", "after", "size"])
    first = (F.col("before") == "").cast("bigint")
    seen = cut(met.filter((F.col("part") != F.col("other")) & (F.col("n") * ratio <= F.col("top"))).groupBy("part", "other").agg(F.sum(1 - first).alias("inside"), F.sum(first).alias("first")))
    chances = Counter({r["other"]: r["n"] for r in tops.filter("before != ''").groupBy("other").agg(F.count("*").alias("n")).toLocalIterator()})
    digits = Counter({r["part"]: r["n"] for r in seen.filter("first > 0").groupBy("part").agg(F.sum("first").alias("n")).toLocalIterator()})
    believed = F.concat("part", F.lit("\n"), "other").isin([f"{a}\n{b}" for a, b in sorted(_believed())])
    counts: Counter = Counter()
    for r in seen.filter((F.col("inside") > 2) | (F.col("first") > 2) | believed).toLocalIterator():
        counts[r["part"], r["other"], False], counts[r["part"], r["other"], True] = r["inside"], r["first"]
    return _confusions(counts, chances, digits)


def _runs(batch: pd.DataFrame, *columns: str) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The stretches of a sorted batch that are equal in the columns."""
    if len(batch):
        changed = (batch[list(columns)] != batch[list(columns)].shift()).any(axis=1).to_numpy()
        places = [*np.flatnonzero(changed), len(batch)]
        for a, b in zip(places, places[1:]):
            yield tuple(batch[c].iat[a] for c in columns), batch.iloc[a:b]


def judged_words(words: DataFrame, kept: DataFrame, total: int, parts: int) -> DataFrame:
    """word, n, right: count and correction of different words by a lexicon in ``parts``; no row for what it doesn't know.

    Entries are split by the hashes of their keys, so that all kinds of a key meet. A task takes up
    one part and lets words pass by it, each word passes all parts, and a word is judged by a
    lexicon of all entries that it met.
    """
    confusions = confusions_of(kept)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [e for w, n in zip(batch["word"], batch["n"]) for e in entries_of(w, n)]
            yield pd.DataFrame(out, columns=["kind", "entry", "n"])

    entries = cut(kept.mapInPandas(split, "kind string, entry string, n bigint").groupBy("kind", "entry").agg(F.sum("n").alias("n")))
    top = entries.filter("kind = 'w'").agg(F.max("n")).first()[0]

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, taken, lexicon = None, [], None
        for batch in batches:
            out = []
            for (part, lane, asked), some in _runs(batch, "part", "lane", "asked"):
                if (part, lane) != at:
                    at, taken, lexicon = (part, lane), [], None
                if not asked:
                    taken.append(some[["kind", "entry", "n"]].copy())
                    continue
                if lexicon is None:
                    held = (e for t in taken for e in zip(t["kind"], t["entry"], t["n"].astype("int64").tolist()))
                    lexicon, taken = Lexicon({}, total=total, confusions=confusions, entries=held, top=top), []
                out += [(w, *e) for w in some["entry"] for e in lexicon.looked_up(w)]
            yield pd.DataFrame(out, columns=["word", "kind", "entry", "n"])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            met = {(e[0], e[1:]): n for es, ns in zip(batch["entries"], batch["ns"]) for e, n in zip(es, ns)}
            lexicon = Lexicon({}, total=total, confusions=confusions, entries=((*e, int(n)) for e, n in met.items()), top=top)
            out = [(w, lexicon.count(w), lexicon.correction(w)) for w in batch["word"]]
            yield pd.DataFrame([x for x in out if x[1] or x[2]], columns=["word", "n", "right"])

    lanes = max(1, 2 * max(words.sparkSession.sparkContext.defaultParallelism, 2) // parts)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = entries.select(F.pmod(F.xxhash64("entry"), F.lit(parts)).cast("int").alias("part"), every(lanes).alias("lane"), F.lit(False).alias("asked"), "kind", "entry", "n")
    passing = words.select(every(parts).alias("part"), F.pmod(F.xxhash64("word"), F.lit(lanes)).cast("int").alias("lane"), F.lit(True).alias("asked"), F.lit("").alias("kind"), F.col("word").alias("entry"), F.lit(0).cast("bigint").alias("n"))
    met = held.unionByName(passing).repartition(parts * lanes, "part", "lane").sortWithinPartitions("part", "lane", "asked").mapInPandas(look_up, "word string, kind string, entry string, n bigint")
    found = met.groupBy("word").agg(F.collect_list(F.struct(F.concat("kind", "entry").alias("e"), "n")).alias("x")).select("word", F.col("x.e").alias("entries"), F.col("x.n").alias("ns"))
    return spread(found).mapInPandas(judge, "word string, n bigint, right string")


def _over_parts(texts: DataFrame, model: LineModel, kept: DataFrame, total: int, parts: int, of: Callable, ends: bool, schema: str) -> DataFrame:
    """What ``of`` makes of every text where the lexicon is too large to be sent: words are judged apart, verdicts go to chunks of texts."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("_text").to_pylist()
            done = [(p.looks, states) for at in range(0, len(own), 1_000) for p, states in labelled(own[at : at + 1_000], model)]
            more = [pa.array([x[i] for x in done], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "looks", "states"])

    kind = schema.split(", ")[0]
    texts = texts.mapInArrow(label, f"{kind}, _text string, looks string, states string")
    texts = cut(texts.withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, words = None, {}
        for batch in batches:
            for (chunk,), some in _runs(batch, "chunk"):
                if chunk != at and words:
                    yield pd.DataFrame({"chunk": at, "word": list(words), "counted": list(words.values())})
                    words = {}
                at = chunk
                for t, looks, states in zip(some["_text"], some["looks"], some["states"]):
                    for w, counted in asked_words(t, Page.restored(t, looks, states) if ends else None, states).items():
                        words[w] = counted or words.get(w, False)
        if words:
            yield pd.DataFrame({"chunk": at, "word": list(words), "counted": list(words.values())})

    asked = cut(texts.select("chunk", "_text", "looks", "states").mapInPandas(ask, "chunk bigint, word string, counted boolean"))
    judged = judged_words(asked.select("word").distinct(), kept, total, parts)
    verdicts = asked.join(judged, "word").filter(F.col("counted") | F.col("right").isNotNull())
    unit = max(1.0, SHARE * total)
    names = [c.split()[0] for c in schema.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, Verdicts(unit)
        for batch in batches:
            out = []
            frame = pa.Table.from_batches([batch]).select(["chunk", "is_text", "_text", "looks", "states", "word", "n", "right"]).to_pandas()
            for (chunk, is_text), some in _runs(frame, "chunk", "is_text"):
                if chunk != at:
                    at, own = chunk, Verdicts(unit)
                if is_text:
                    for k, t, looks, states in zip(some.index, some["_text"], some["looks"], some["states"]):
                        out += [(k, *x) for x in of(t, Page.restored(t, looks, states), states, own)]
                else:
                    own.counts.update(zip(some["word"], some["n"].astype("int64").tolist()))
                    own.right.update((w, r) for w, r in zip(some["word"], some["right"]) if isinstance(r, str))
            if out:
                places, numbers, values = zip(*out)
                # the keys as they are: beside rows without one, pandas would make numbers of them inexact
                keys = batch.column("_key").take(pa.array(places, pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array(numbers, pa.int32()), pa.array(values, pa.string())], names)

    said = verdicts.select("chunk", F.lit(False).alias("is_text"), "word", "n", "right")
    both = texts.withColumn("is_text", F.lit(True)).unionByName(said, allowMissingColumns=True)
    tasks = max(2 * texts.sparkSession.sparkContext.defaultParallelism, (total >> CHUNK_BITS) // 16)
    return both.repartition(tasks, "chunk").sortWithinPartitions("chunk", "is_text").mapInArrow(work, schema)
