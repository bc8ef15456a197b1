"""Bounded Bloom filters, built in Spark and sent out whole.

A filter only says which rows need an exact look: a miss is certain, a hit is
checked afterwards by a join or a count.  Its bits are chosen by the number of
keys up to ``MAX_BITS`` (32 MB); beyond that it fills up and more rows take the
exact way, with the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_BITS, MAX_BITS, BITS_PER_KEY, PROBES = 1 << 16, 1 << 28, 24, 4


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _positions(keys: np.ndarray, bits: int):
    h = mix(keys.view(np.uint64))
    step = mix(h + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for j in range(PROBES):
        yield (h + np.uint64(j) * step) & np.uint64(bits - 1)


class BitFilter:
    """``hits(keys)``: whether each of the signed 64-bit keys may be in the set."""

    def __init__(self, words: np.ndarray):
        self.words, self.bits = words, words.size * 64

    def hits(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(keys.size, dtype=bool)
        for p in _positions(keys, self.bits):
            out &= (self.words[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1
        return out


def build(keys: DataFrame, n: int, max_bits: int = MAX_BITS) -> BitFilter:
    """The filter of ``n`` rows of ``keys(key bigint)``.  The words that have a
    bit set come to the driver: at most ``max_bits`` / 64 rows of 16 bytes."""
    bits = MIN_BITS
    while bits < min(max_bits, BITS_PER_KEY * n):
        bits *= 2

    def run(batches):
        for b in batches:
            at = np.concatenate(list(_positions(b.column(0).to_numpy(zero_copy_only=False), bits)))
            at = np.unique(at)
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if at.size else at
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))],
                                             ["word", "bits"])

    rows = (keys.select("key").mapInArrow(run, "word bigint, bits bigint")
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return BitFilter(words)
