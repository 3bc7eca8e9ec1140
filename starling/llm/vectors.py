"""Embedding columns as numpy matrices, shared by the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_length(df: DataFrame, vector: str) -> int:
    """The length most vectors have (ties: the smaller), 0 if there is no vector.  Vectors of
    another length take no part anywhere: they have no sums or products with the rest."""
    counts = df.select(F.size(F.col(f"`{vector}`")).alias("n")).where("n > 0").groupBy("n").count()
    first = counts.orderBy(F.col("count").desc(), "n").first()
    return 0 if first is None else int(first["n"])


def as_matrix(column: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, float64 matrix) of the rows whose vector has ``length`` finite components."""
    right = pc.fill_null(pc.equal(pc.list_value_length(column), length), False)
    rows = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    values = column.filter(right).flatten().cast(pa.float64())
    matrix = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, length)
    whole = np.isfinite(matrix).all(axis=1)
    return rows[whole], matrix[whole]


def scaled_floor(matrix: np.ndarray, scale: int, limit: float) -> np.ndarray:
    """floor(scale * x) as float64 integers; an error past ``limit``, where sums would not be exact."""
    out = np.floor(matrix * scale)
    if out.size and max(out.max(), -out.min()) > limit:
        raise ValueError(f"a vector component times {scale} is beyond {limit:.0f}: its sums would not be exact")
    return out
