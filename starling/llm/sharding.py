"""Operator 7: reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows get global numbers 0..n-1 in key order; a keyed Feistel network over the smallest
even-bit domain that holds n permutes them, and numbers that leave [0, n) are walked
through the network again until they return (cycle walking), which keeps it a permutation.
Position p goes to shard ``p % shards``, slot ``p // shards``: both are computable from a
row number alone, shard sizes differ by at most one row, and slots have no gaps.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.words import mix64
from starling.operators.keys import row_index

ROUNDS = 6


def permuted(rows: np.ndarray, n: int, seed: int = 0, rounds: int = ROUNDS) -> np.ndarray:
    """Position of each row number in [0, n) under the permutation named by ``seed``."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    bits, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = mix64(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                 ^ np.uint64(seed % (1 << 64)))
    out = np.asarray(rows).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> bits, out[todo] & mask
        for key in keys:
            left, right = right, left ^ (mix64(right ^ key) & mask)
        out[todo] = (left << bits) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def feistel_shards(df: DataFrame, order_by: list[str], shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``row_no`` (global, in ``order_by`` order), ``shard`` (int) and ``slot`` (long).

    Only ``df``'s own columns are shuffled, once, to number the rows: project wide columns
    away first.  Null keys sort first; rows with equal keys are told apart by a hash of the
    whole row; wholly equal rows are interchangeable.  Input columns named like an output
    are replaced; an empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    numbered = row_index(df.drop("row_no", "shard", "slot"), order_by, "row_no", start=0)
    n = numbered.count()

    @F.pandas_udf("long")
    def position(row_no: pd.Series) -> pd.Series:
        return pd.Series(permuted(row_no.to_numpy(), n, seed))

    placed = numbered.withColumn("__position", position("row_no"))
    return (placed.withColumn("shard", F.pmod("__position", F.lit(shards)).cast("int"))
                  .withColumn("slot", F.floor(F.col("__position") / F.lit(shards)).cast("long"))
                  .drop("__position"))
