"""Operator 12: exact top-k inner-product search, bounded by multi-resolution segment statistics.

Vectors become integers floor(scale * x).  A vector is cut into segments of equal length m, few
(coarse) to many (fine); of each it keeps the sum S and the deviation D, D^2 = sum of squares -
S^2 / m.  Over one segment |q - x|^2 >= (Sq - Sx)^2 / m + (Dq - Dx)^2, which is the same as
q.x <= Sq Sx / m + Dq Dx: summed over the segments, a lower bound of the distance and an upper one
of the inner product.  Bounds are compared coarse to fine with the k-th best score known so far;
candidates that no query of a group needs leave the group's matrix at every level, and exact
scores are computed for the survivors only.

* A pilot of about ``PILOT`` candidates, picked by a hash, is broadcast (bounded) and answers every
  query in one distributed pass; its k-th best (score, id) is the query's first threshold.
* Queries, ordered by coarse statistics, are cut into blocks of at most ``BLOCK``; a block meets all
  other candidates in rounds that each hold up to ``GROWTH`` times those before, so a round leaves
  about k * GROWTH candidates better than the threshold for each query however large the table is.
  Candidates are never shuffled; from a task at most k rows a query move on.
* Thresholds are (score, id) pairs: equal scores never pile up, as only a smaller id is better.

Rows whose id is null, or whose vector is null, empty, of another length than most or holds a null
or non-finite component, take no part.  Rows that share an id are candidates each; of query rows that
share an id the one with the smallest vector asks, and no row with its id answers.  Scores past 2^53
are an error.  Without queries or candidates the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.llm.common import stored
from starling.llm.vectors import as_matrix, scaled_floor, vector_length
from starling.operators.keys import row_index

LEVELS = (1, 4, 16)  # segments, coarse to fine
PILOT, GROWTH = 1 << 14, 16
BLOCK = 1 << 14  # queries sent to the tasks at once
GROUP, CHUNK = 256, 1 << 12  # queries and candidates of one matrix inside a task
BUFFER = 1 << 20  # survivors held before the best k of each query are picked
EXACT32, EXACT64 = 2.0 ** 24, 2.0 ** 53
HASHES = 1 << 30
FOUND = "query_id long, vec_id long, score long"


def segment_features(matrix: np.ndarray, segments: int) -> np.ndarray:
    """For every segment S / sqrt(m), then for every segment D: products of two rows' features
    bound the product of the rows."""
    d = matrix.shape[1]
    cuts = np.linspace(0, d, min(segments, d) + 1).astype(np.int64)
    m = np.diff(cuts)
    sums = np.add.reduceat(matrix, cuts[:-1], axis=1)
    squares = np.add.reduceat(matrix * matrix, cuts[:-1], axis=1)
    return np.hstack([sums / np.sqrt(m), np.sqrt(np.maximum(squares - sums * sums / m, 0))])


def levels_of(length: int) -> list[int]:
    return [s for s in LEVELS if s < length]


@dataclass
class Queries:
    """Queries with the (score, id) of their k-th best answer so far."""

    ids: np.ndarray
    matrix: np.ndarray
    score: np.ndarray  # -inf where fewer than k answers are known
    answer: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, matrix: np.ndarray) -> Queries:
        return cls(ids, matrix, np.full(len(ids), -np.inf), np.zeros(len(ids), np.int64))


class Best:
    """The k best answers of each query among those added, better than the queries' thresholds."""

    def __init__(self, queries: Queries, k: int) -> None:
        self.queries, self.k, self.size = queries, k, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.score, self.answer = queries.score.copy(), queries.answer.copy()

    def add(self, query: np.ndarray, answer: np.ndarray, score: np.ndarray) -> None:
        self.parts.append((query, answer, score))
        self.size += len(query)
        if self.size > BUFFER:
            self.shrink()

    def shrink(self) -> None:
        if not self.parts:
            return
        query, answer, score = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.lexsort((answer, -score, query))
        query, answer, score = query[order], answer[order], score[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        last = place == self.k - 1
        self.score[query[last]], self.answer[query[last]] = score[last], answer[last]
        few = place < self.k
        self.parts, self.size = [(query[few], answer[few], score[few])], int(few.sum())

    def batch(self) -> pa.RecordBatch | None:
        self.shrink()
        if not self.size:
            return None
        query, answer, score = self.parts[0]
        return pa.RecordBatch.from_pydict({"query_id": self.queries.ids[query], "vec_id": answer, "score": score.astype(np.int64)})


def search(best: Best, ids: np.ndarray, matrix: np.ndarray) -> None:
    """Adds to ``best`` the candidates (``ids``, ``matrix``) that may be among the k best."""
    queries = best.queries
    if not len(ids) or not len(queries.ids):
        return
    most = math.sqrt(float((queries.matrix ** 2).sum(axis=1).max()) * float((matrix ** 2).sum(axis=1).max()))
    if most >= EXACT64:
        raise ValueError("inner products past 2^53 are not exact")
    kind = np.float32 if most < EXACT32 else np.float64  # products of whole numbers, exact in either
    slack = most * (1e-5 if kind is np.float32 else 1e-12) + 1e-3  # rounding of the bounds
    levels = levels_of(matrix.shape[1])
    asked = [segment_features(queries.matrix, s).astype(kind) for s in levels]
    wanted = queries.matrix.astype(kind)
    for at in range(0, len(ids), CHUNK):
        own, part = ids[at:at + CHUNK], matrix[at:at + CHUNK]
        held = [segment_features(part, s).astype(kind) for s in levels]
        part = part.astype(kind)
        for low in range(0, len(queries.ids), GROUP):
            group = slice(low, min(low + GROUP, len(queries.ids)))
            columns = np.arange(len(own))
            for f, g in zip(asked, held, strict=True):
                useful = (f[group] @ g[columns].T + slack >= best.score[group, None]).any(axis=0)
                columns = columns[useful]
                if not len(columns):
                    break
            else:
                score = (wanted[group] @ part[columns].T).astype(np.float64)
                found = own[columns]
                score[found[None, :] == queries.ids[group, None]] = -np.inf
                limit = best.score[group, None]
                better = (score > limit) | ((score == limit) & (found[None, :] < best.answer[group, None]))
                new = np.flatnonzero(np.isinf(limit[:, 0]))  # no threshold yet: the k best of these candidates
                if len(new):
                    place = len(columns) - best.k
                    least = np.partition(score[new], place, axis=1)[:, place, None] if place > 0 else -np.inf
                    better[new] = (score[new] >= least) & (score[new] > -np.inf)
                query, column = np.nonzero(better)
                best.add(query + low, found[column], score[query, column])
                if len(new):
                    best.shrink()


def _rounds(rate: float) -> list[tuple[int, int]]:
    """Hash ranges [from, to) of the candidates beyond the pilot's, which are below rate."""
    cuts = [int(rate * HASHES)]
    while cuts[-1] < HASHES:
        cuts.append(min(HASHES, max(1, cuts[-1]) * GROWTH))
    return list(zip(cuts, cuts[1:]))


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    """rank 1 to k of each query; a query has at most k rows from each task of a round."""
    window = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _matrix(batch: pa.RecordBatch, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer vectors of the usable rows."""
    rows, matrix = as_matrix(batch.column(1), length)
    return batch.column(0).to_numpy(zero_copy_only=False)[rows].astype(np.int64), scaled_floor(matrix, scale, 2.0 ** 26)


def _together(table: pa.Table, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [_matrix(b, length, scale) for b in table.to_batches()]
    if not parts:
        return np.zeros(0, np.int64), np.zeros((0, length))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _query_blocks(vectors: DataFrame, is_query: Column, length: int, block: int) -> DataFrame:
    """(query_id, v, block): one row a query id, ordered by coarse statistics so that the
    queries of a group look for like candidates."""
    asking = vectors.where(is_query & (F.size("v") == length) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    asking = asking.groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    quarter = max(1, length // 4)
    for i in range(4):
        asking = asking.withColumn(f"s{i}", F.aggregate(F.slice("v", min(i * quarter, length - 1) + 1, quarter), F.lit(0.0), lambda a, x: a + x))
    numbered = row_index(asking, ["s0", "s1", "s2", "s3", "query_id"], "at", start=0)
    return numbered.select("query_id", "v", F.floor(F.col("at") / block).cast("int").alias("block"), "at")


def top_products(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 20,
                 scale: int = 64, pilot: int = PILOT, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row for which ``is_query`` holds, the k rows of ``df``
    with the highest inner product, ties to the smaller id."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    length = vector_length(df, vector)
    if not length:
        return empty
    vectors = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"),
                        F.coalesce(is_query, F.lit(False)).alias("asks")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    n = vectors.count()
    queries = stored(_query_blocks(vectors, F.col("asks"), length, block), "queries")
    blocks = (queries.agg(F.max("block")).first()[0] or 0) + 1 if not queries.isEmpty() else 0
    if not blocks:
        return empty
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(HASHES))
    rate = min(1.0, pilot / n)

    chosen = vectors.where(hashed < int(rate * HASHES)).select("vec_id", "v")
    chosen = spark.sparkContext.broadcast(_together(chosen.toArrow(), length, scale))

    def ask_pilot(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                best = Best(Queries.of(*_matrix(batch.slice(at, GROUP), length, scale)), k)
                search(best, *chosen.value)
                out = best.batch()
                if out is not None:
                    yield out

    first = stored(_best_rows(queries.select("query_id", "v").mapInArrow(ask_pilot, FOUND), k)
                   .join(queries.select("query_id", "block"), "query_id"), "pilot-answers")
    done = []
    for b in range(blocks):
        asked = queries.where(F.col("block") == b).orderBy("at").select("query_id", "v").toArrow()  # at most ``block`` rows
        ids, matrix = _together(asked, length, scale)
        top = first.where(F.col("block") == b).select("query_id", "vec_id", "score", "rank")
        for low, high in _rounds(rate):
            top = _round(vectors.where((hashed >= low) & (hashed < high)), ids, matrix, top, k, length, scale)
        done.append(top)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _round(candidates: DataFrame, ids: np.ndarray, matrix: np.ndarray, top: DataFrame, k: int, length: int, scale: int) -> DataFrame:
    """The best answers of a block of queries after one more part of the candidates."""
    queries = Queries.of(ids, matrix)
    known = top.where(F.col("rank") == k).select("query_id", "score", "vec_id").toArrow()
    order = np.argsort(ids)
    at = order[np.searchsorted(ids, known.column(0).to_numpy(), sorter=order)]
    queries.score[at], queries.answer[at] = known.column(1).to_numpy(), known.column(2).to_numpy()
    shared = candidates.sparkSession.sparkContext.broadcast(queries)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(shared.value, k)
        for batch in batches:
            search(best, *_matrix(batch, length, scale))
        out = best.batch()
        if out is not None:
            yield out

    found = candidates.select("vec_id", "v").mapInArrow(scan, FOUND)
    return stored(_best_rows(top.select("query_id", "vec_id", "score").unionByName(found), k), "answers")
