"""Blocked Bloom filter: built by an aggregate, bounded in size, probed with numpy.

A key is given by two 64-bit hashes. The first picks a 512-bit block, the second
one bit in each of its eight words. The filter never misses a key; whoever uses it
removes the false positives with an exact join.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, BITS_PER_KEY = 8, 16


def key_hashes(*columns: Column) -> Column:
    """The two hashes of a key as an array."""
    return F.array(F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns))


def filter_words(keys: DataFrame, hashes: Column, max_blocks: int) -> np.ndarray:
    """The filter over all rows of ``keys`` as an array (blocks, 8) of 64-bit words.

    At most ``max_blocks`` blocks (64 bytes each) reach the driver; with more keys
    than fit, only the false positives grow.
    """
    n_keys = keys.count()
    n_blocks = int(min(max_blocks, max(1, -(-n_keys * BITS_PER_KEY // (64 * WORDS)))))
    hashed = keys.select(hashes.alias("h"))
    bits = hashed.select(
        F.pmod(F.col("h")[0], F.lit(n_blocks).cast("bigint")).alias("block"),
        F.posexplode(F.array(*[F.shiftright(F.col("h")[1], 6 * w).bitwiseAND(63) for w in range(WORDS)]))
        .alias("word", "bit"))
    rows = (bits.select("block", "word", F.expr("shiftleft(1L, cast(bit AS int))").alias("mask"))
            .groupBy("block", "word").agg(F.bit_or("mask").alias("mask"))
            .toPandas())                                        # at most 8 * max_blocks rows
    out = np.zeros((n_blocks, WORDS), np.int64)
    out[rows["block"].to_numpy(np.int64), rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64)
    return out.view(np.uint64)


def probe(words: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Which keys (two 64-bit hashes each) the filter passes; each word is read only for keys that passed the ones before."""
    block = np.mod(first, np.int64(len(words)))
    passed = np.arange(len(first))
    for w in range(WORDS):
        bit = ((second[passed] >> np.int64(6 * w)) & 63).astype(np.uint64)
        passed = passed[(words[block[passed], w] >> bit) & np.uint64(1) > 0]
    out = np.zeros(len(first), bool)
    out[passed] = True
    return out


def split_by_keys(rows: DataFrame, keys: DataFrame, columns: list[str],
                  max_blocks: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """(rows that may have a key in ``keys``, rows that surely have none), by bigint ``columns``.

    The second part needs no join, so wide rows are shuffled only where they may match.
    """
    words = filter_words(keys, key_hashes(*[F.col(c) for c in columns]), max_blocks)
    shared = rows.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def may_have(first: pd.Series, second: pd.Series) -> pd.Series:
        return pd.Series(probe(shared.value, first.to_numpy(np.int64), second.to_numpy(np.int64)))

    hashes = key_hashes(*[F.col(c) for c in columns])
    marked = rows.withColumn("__may", may_have(hashes[0], hashes[1]))
    return marked.where("__may").drop("__may"), marked.where(~F.col("__may")).drop("__may")
