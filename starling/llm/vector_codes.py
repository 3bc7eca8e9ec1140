"""Operator 13: vector codes (product quantisation) with equal-average nearest-entry search.

Vectors are scaled to integers and cut into equal consecutive parts; each part position has a
codebook.  The nearest entry of a part is found by the equal-average search: a codebook's entries
are sorted by component sum, the search starts at the part's own sum and goes outward, and a side ends
where the squared gap of the sums over the dimension strictly exceeds the best distance (that
quotient never exceeds the squared distance, so an entry at the same distance and a lower index is
still seen).  Parts are handled in groups of like sums against ``STEP`` entries at a time.

Every round is one pass in which a task adds up the parts of each entry and leaves one row an entry;
Spark sums those, and only the codebooks reach the driver.  All arithmetic is on whole numbers.

Rows whose vector is null, empty, of another length than most, or holds a null or non-finite component
are dropped; a null id comes after all others in the choice of first entries (ties: the smaller vector)
and keeps its row.  Repeated rows stay.  A vector length that the number of parts does not divide is
an error, and so is a distance past 2^53.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from starling.llm.common import stored
from starling.llm.vectors import as_matrix, scaled_floor, vector_length

GROUP, STEP = 512, 32  # parts searched together, entries compared at a time
EXACT = 2.0 ** 53


class SortedBook:
    """A codebook (entries x dims, whole numbers) sorted by component sum."""

    def __init__(self, entries: np.ndarray) -> None:
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.entries, self.sums = entries[self.order].astype(np.float64), sums[self.order].astype(np.float64)
        self.squares = (self.entries ** 2).sum(axis=1)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry number, squared distance) of every part; ties to the lower number."""
        count, dims = len(self.sums), parts.shape[1]
        squares, sums = (parts ** 2).sum(axis=1), parts.sum(axis=1)
        if len(parts) and 2 * (squares.max() + self.squares.max()) >= EXACT:
            raise ValueError("squared distances past 2^53 are not exact")
        number, distance = np.zeros(len(parts), np.int64), np.full(len(parts), np.inf)
        like = np.argsort(sums, kind="stable")
        for at in range(0, len(parts), GROUP):
            rows = like[at:at + GROUP]
            low = high = int(np.searchsorted(self.sums, sums[rows[len(rows) // 2]]))
            below, above = rows, rows
            while len(below) or len(above):
                if len(above):
                    stop = min(count, high + STEP)
                    self._compare(parts, squares, above, high, stop, number, distance)
                    high = stop
                if len(below):
                    start = max(0, low - STEP)
                    self._compare(parts, squares, below, start, low, number, distance)
                    low = start
                # what lies further out on a side is at least as far off as its next entry's sum tells
                above = above[:0] if high == count else above[self._open(self.sums[high] - sums[above], dims, distance[above])]
                below = below[:0] if low == 0 else below[self._open(sums[below] - self.sums[low - 1], dims, distance[below])]
        return number, distance.astype(np.int64)

    @staticmethod
    def _open(gap: np.ndarray, dims: int, distance: np.ndarray) -> np.ndarray:
        return (gap <= 0) | (gap * gap <= dims * distance)

    def _compare(self, parts, squares, rows, start, stop, number, distance) -> None:
        if start >= stop:
            return
        found = squares[rows, None] - 2 * (parts[rows] @ self.entries[start:stop].T) + self.squares[None, start:stop]
        least = found.min(axis=1)
        entry = np.where(found == least[:, None], self.order[None, start:stop], len(self.sums)).min(axis=1)
        better = (least < distance[rows]) | ((least == distance[rows]) & (entry < number[rows]))
        number[rows[better]], distance[rows[better]] = entry[better], least[better]


def _parts_of(column: pa.Array, length: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    rows, matrix = as_matrix(column, length)
    return rows, scaled_floor(matrix, scale, 2.0 ** 26)


def _first_entries(vectors: DataFrame, length: int, scale: int, parts: int, entries: int) -> np.ndarray:
    """parts x entries x dims: the parts of the rows with the smallest ids (at most ``entries``)."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & (F.size("v") == length)
    first = vectors.where(whole).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    matrix = np.floor(np.array([r["v"] for r in first], dtype=np.float64).reshape(-1, length) * scale).astype(np.int64)
    return np.stack(np.split(matrix, parts, axis=1))


def train_codebooks(vectors: DataFrame, length: int, scale: int = 1024, parts: int = 4, entries: int = 256,
                    rounds: int = 4) -> np.ndarray:
    """Codebooks after ``rounds`` of assigning every part and replacing each used entry by the floor
    of its parts' mean; ``vectors`` has columns id and v."""
    books = _first_entries(vectors, length, scale, parts, entries)
    dims = length // parts
    columns = ["part long", "entry long", "n long", *[f"s{i} long" for i in range(dims)]]
    for _ in range(rounds if books.shape[1] else 0):
        shared = vectors.sparkSession.sparkContext.broadcast(books)

        def add_up(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            books = shared.value
            sorted_books = [SortedBook(b) for b in books]
            n, sums = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
            for batch in batches:
                matrix = _parts_of(batch.column(0), length, scale)[1]
                for p, part in enumerate(np.split(matrix, len(books), axis=1)):
                    number = sorted_books[p].nearest(part)[0]
                    n[p] += np.bincount(number, minlength=books.shape[1])
                    order = np.argsort(number, kind="stable")
                    if len(order):
                        used, start = np.unique(number[order], return_index=True)
                        sums[p][used] += np.add.reduceat(part[order], start, axis=0).astype(np.int64)
            p, e = np.nonzero(n)
            if len(p):
                yield pa.RecordBatch.from_pydict({"part": p, "entry": e, "n": n[p, e]} | {f"s{i}": sums[p, e, i] for i in range(dims)})

        total = (vectors.select("v").mapInArrow(add_up, ", ".join(columns)).groupBy("part", "entry")
                 .agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(dims)]).collect())
        books = books.copy()
        for r in total:
            books[r["part"], r["entry"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dims)]
    return books


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(df: DataFrame, books: np.ndarray, length: int, id_col: str, vector: str, keep: list[str], scale: int) -> DataFrame:
    """(id, code, error, *keep) of every usable row."""
    shared = df.sparkSession.sparkContext.broadcast(books)
    fields = [T.StructField("id", df.schema[id_col].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    schema = T.StructType(fields + [T.StructField(f"kept{i}", df.schema[c].dataType) for i, c in enumerate(keep)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        sorted_books = [SortedBook(b) for b in books]
        digits = max(2, len(f"{books.shape[1] - 1:x}"))
        names = np.array([f"{i:0{digits}x}" for i in range(books.shape[1])], dtype=object)
        for batch in batches:
            rows, matrix = _parts_of(batch.column(1), length, scale)
            code, error = np.full(len(rows), "", dtype=object), np.zeros(len(rows), np.int64)
            for p, part in enumerate(np.split(matrix, len(books), axis=1)):
                number, distance = sorted_books[p].nearest(part)
                code, error = code + names[number], error + distance
            others = [batch.column(i).take(pa.array(rows)).cast(arrow.field(i + 1).type) for i in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)).cast(arrow.field(0).type), pa.array(code, pa.string()),
                                              pa.array(error), *others], schema=arrow)

    wide = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"),
                     *[F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(keep)])
    return wide.mapInArrow(run, schema)


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 1024,
                 parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """One row per usable row: id, code (hex numbers of the entries), error (squared distances summed
    over the parts), label_error (error summed over equal labels, nulls together), codebooks_sha256."""
    spark = df.sparkSession
    out = T.StructType([df.schema[id_col], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()),
                        T.StructField("label_error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())])
    length = vector_length(df, vector)
    if length % parts:
        raise ValueError(f"{parts} equal parts do not fit vectors of {length} components")
    if not length:
        return spark.createDataFrame([], out)
    vectors = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v")).where("v IS NOT NULL")
    books = train_codebooks(vectors, length, scale, parts, entries, rounds)
    if not books.shape[1]:
        return spark.createDataFrame([], out)
    codes = stored(encode(df, books, length, id_col, vector, [label], scale), "codes")
    errors = codes.groupBy(F.col("kept0").alias("label")).agg(F.sum("error").alias("label_error"))
    both = codes.join(errors, F.col("kept0").eqNullSafe(F.col("label")), "left")
    return both.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
