"""Operator 6: packing documents into fixed windows by non-negative least squares.

1. Every document becomes token ids plus an end id and is cut into full windows and one rest.
2. The histogram of piece lengths (at most ``window`` numbers) reaches the driver.  There,
   shallow combinations of lengths (pairs, triples) that fill a window exactly are enumerated,
   non-negative least squares finds how often to repeat each so that their lengths add up to
   the histogram, repeats are rounded down, and what is left is packed greedily (longest
   first, then the longest that still fits), length by length with repeat counts.
3. The plan is a table of (length, rank range) -> (sequence, offset); its size depends on the
   window, not on the data.  Each piece finds its place from its rank among the pieces of its
   length, which every task numbers locally plus an offset by (task, length).

So pieces are never sorted or collected, and a length shared by a third of all pieces is no
hot key.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starling.llm.common import stored
from starling.llm.tokens import default_path, encoder

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("task", T.LongType()), T.StructField("rank", T.LongType()),
])


def token_pieces(docs: DataFrame, window: int, tokenizer_path: str, end_id: int) -> DataFrame:
    """Pieces of at most ``window`` ids; ``rank`` numbers a task's pieces of equal length.
    ``ids`` are little-endian unsigned 32-bit numbers.  Null text is empty: the end id alone."""
    arrow = to_arrow_schema(PIECES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task, used, encode = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64), encoder(tokenizer_path)
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    part = ids[start:start + window].tobytes()
                    n = len(part) // 4
                    rows.append((doc_id, start, n, len(ids), part, zlib.crc32(part), task, int(used[n])))
                    used[n] += 1
                    held += len(part) + 60
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


def shallow_combinations(present: np.ndarray, window: int, spread: int = 8) -> np.ndarray:
    """Pairs and triples of present lengths that fill the window (rows of 3; 0: no third).
    Each longest length gets up to ``spread`` evenly spaced middle lengths for its triples."""
    has = np.zeros(window + 1, bool)
    has[present] = True
    out = [(a, window - a, 0) for a in present.tolist() if 2 * a >= window and a < window and has[window - a]]
    for a in present.tolist():
        rest = window - a
        middle = np.arange((rest + 1) // 2, min(a, rest - 1) + 1)
        middle = middle[has[middle] & has[rest - middle]] if len(middle) else middle
        if len(middle) > spread:
            middle = middle[np.linspace(0, len(middle) - 1, spread).astype(int)]
        out += [(a, b, rest - b) for b in middle.tolist()]
    return np.array(out, np.int64).reshape(-1, 3)


def least_squares_repeats(combos: np.ndarray, histogram: np.ndarray, steps: int = 200) -> np.ndarray:
    """x >= 0 with little ||A x - histogram||, A counting each length in each combination
    (multiplicative updates: x stays non-negative and the residual never grows)."""
    lengths, width = combos.T, len(histogram)
    used = (lengths > 0).astype(float)

    def product(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(part, x * u, width) for part, u in zip(lengths, used, strict=True))

    def transposed(r: np.ndarray) -> np.ndarray:
        return sum(r[part] * u for part, u in zip(lengths, used, strict=True))

    goal = transposed(histogram.astype(float))
    x = goal / np.maximum(transposed(product(np.ones(len(combos)))), 1e-12)
    for _ in range(steps):
        x = x * goal / np.maximum(transposed(product(x)), 1e-12)
    return x


def packing_plan(histogram: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths of a sequence, how many such sequences)]; uses every piece exactly once."""
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        plan.append(((window,), int(left[window])))
        left[window] = 0
    combos = shallow_combinations(np.flatnonzero(left), window)
    if len(combos):
        x = least_squares_repeats(combos, left)
        for i in np.argsort(-x, kind="stable").tolist():
            if x[i] < 1:
                break
            need = [v for v in combos[i].tolist() if v]
            times = min(int(x[i]), *(int(left[v]) // need.count(v) for v in need))
            if times:
                plan.append((tuple(need), times))
                for v in need:
                    left[v] -= times
    plan += greedy_plan(left, window)
    return plan


def greedy_plan(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest piece first, then always the longest that fits; a pattern repeats while its
    lengths last, so there are about as many patterns as lengths, not as many as pieces."""
    left, plan = left.copy(), []
    present = np.flatnonzero(left).tolist()
    while present:
        pattern, room, taken = [], window, {}
        top = len(present)
        while top:
            top = bisect.bisect_right(present, room, 0, top)
            if not top:
                break
            v = present[top - 1]
            fits = min(room // v, int(left[v]))
            pattern += [v] * fits
            taken[v] = fits
            room -= fits * v
            top -= 1
        times = min(int(left[v]) // k for v, k in taken.items())
        plan.append((tuple(pattern), times))
        for v, k in taken.items():
            left[v] -= k * times
            if not left[v]:
                present.pop(bisect.bisect_left(present, v))
    return plan


def plan_table(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: where the pieces of each rank go."""
    rows, next_rank, sequence = [], {}, 0
    for lengths, times in plan:
        offset = 0
        for v in lengths:
            rows.append((v, next_rank.get(v, 0), sequence, offset))
            next_rank[v] = next_rank.get(v, 0) + times
            offset += v
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(docs: DataFrame, window: int = 2048, tokenizer_path: str | None = None, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids, ids_crc32, sequence_id, offset.

    ``docs`` needs doc_id and text; other columns are ignored.  Null text is empty, null and
    repeated doc_ids are packed like any other row; an empty table gives an empty result.
    """
    pieces = stored(token_pieces(docs, window, tokenizer_path or default_path(), end_id), "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan_table(packing_plan(histogram, window))
    starts = places[:, 0] << 44 | places[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(starts, length.to_numpy() << 44 | rank.to_numpy(), "right") - 1
        return pd.DataFrame({"sequence_id": places[at, 2] + rank.to_numpy() - places[at, 1], "offset": places[at, 3]})

    return (pieces.join(bases, ["task", "length"])
            .withColumn("at", place("length", F.col("base") + F.col("rank")))
            .select("doc_id", "start", "length", "doc_tokens", "ids", "ids_crc32", "at.sequence_id", "at.offset"))
