"""Small edit distances: deletion neighbourhoods and their verification."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

#: Letter groups that scanning and typing confuse; fixed values, long form first.
LOOKALIKES = (("rn", "m"), ("cl", "d"), ("vv", "w"))


@lru_cache(maxsize=65_536)
def fold(text: str) -> str:
    """Lower case without accents; umlauts and their two-letter spellings become one."""
    text = text.lower().replace("ß", "ss")
    text = unicodedata.normalize("NFKD", text.replace("ä", "a").replace("ö", "o").replace("ü", "u"))
    text = "".join(c for c in text if not unicodedata.combining(c))
    return text.replace("ae", "a").replace("oe", "o").replace("ue", "u")


def merged(token: str) -> str:
    """The token with look-alike groups in their short form."""
    for long, short in LOOKALIKES:
        token = token.replace(long, short)
    return token


def reach(token: str) -> int:
    """How many edits a token of this length may be away."""
    return 0 if len(token) < 4 else 1 if len(token) < 6 else 2


def neighbourhood(token: str, edits: int | None = None) -> set[str]:
    """The token with up to ``edits`` characters deleted.

    Two tokens at most ``edits`` insertions, deletions, substitutions or swaps apart share
    a member of their neighbourhoods.
    """
    out = current = {token}
    for _ in range(reach(token) if edits is None else edits):
        current = {t[:i] + t[i + 1 :] for t in current for i in range(len(t))}
        out = out | current
    return out


def distance(a: str, b: str, most: int = 2) -> int:
    """Edits between two tokens, a swap of neighbours counts one; most + 1 if beyond ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, last[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)
