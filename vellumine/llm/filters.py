"""Filters of a fixed size over hashes: what they let pass may be wrong, what they stop never is."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Bits of a filter (16 MB), whatever the number of hashes in it, and places of each hash.
FILTER_BITS, PLACES = 1 << 27, 4
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 2**64) | 1) for k in range(PLACES)]


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    u = hashes.view(np.uint64)
    return [((u * m) >> np.uint64(20)) % np.uint64(bits) for m in _MIX]


def fixed_filter(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """The filter of a bigint column. The driver gets at most ``bits`` / 64 pairs of integers, by Arrow."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"place": np.concatenate(_places(batch[column].to_numpy(dtype=np.int64), bits)).astype(np.int64)})

    words = (
        hashes.select(column).mapInPandas(places, "place bigint")
        .groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toArrow()
    )
    out = np.zeros(bits // 64 + 1, dtype=np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def passing(hashes: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the filter."""
    bits = (len(held) - 1) * 64
    there = np.ones(len(hashes), dtype=bool)
    for place in _places(hashes, bits):
        there &= (held[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return there
