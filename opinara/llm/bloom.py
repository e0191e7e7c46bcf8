"""A fixed-size Bloom filter built by Spark: rows that cannot join are dropped before a shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import collect_arrays

BITS = 25  # 2**25 bits are 4 MB, whatever the input
LOW, HIGH = 0, 32  # the two bits of a value are named by these parts of it


def build(df: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Filter over a column of hashes (longs). At most 2**bits / 32 numbers reach the driver."""
    size = F.lit(1 << bits)
    places = [F.pmod(F.shiftright(column, n), size) for n in (LOW, HIGH)]
    words = (
        df.select(F.explode(F.array(*places)).alias("bit"))
        .groupBy(F.shiftright("bit", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("bits"))
    )
    found = collect_arrays(words)
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[found["word"]] = found["bits"].astype(np.uint32)
    return out


def _has(filter_words: np.ndarray, hashes: np.ndarray, shift: int) -> np.ndarray:
    bit = (hashes >> np.uint64(shift)) & np.uint64(filter_words.size * 32 - 1)
    return (filter_words[bit >> np.uint64(5)] >> (bit & np.uint64(31)).astype(np.uint32)) & 1 == 1


def possible(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes (uint64) that may be in the filter; none that is in it is left out."""
    first = np.flatnonzero(_has(filter_words, hashes, LOW))
    return first[_has(filter_words, hashes[first], HIGH)]
