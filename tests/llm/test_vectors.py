"""Whitening, exact top-k search and vector codes against plain numpy, with edge rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import topk_search, vector_codes, whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int"


def edge_frame(spark, n=300, dims=8, seed=3):
    """Clustered vectors with a hot copy, repeated rows, damaged rows and clashing extra columns."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    rows = []
    for i in range(n):
        v = centres[i % 5] + 0.3 * rng.normal(size=dims) if i % 3 else centres[0]
        rows.append((i, [float(x) for x in np.float32(v)], None if i % 7 == 0 else i % 4))
    rows += [(1000, None, 1), (1001, [None] * dims, 1), (1002, [float("nan")] + [0.0] * (dims - 1), 1),
             (1003, [float("inf")] + [0.0] * (dims - 1), None), (1004, [], 2), (1005, [1.0, 2.0], 2)]
    rows += [rows[20], rows[20], (None, rows[1][1], 3), (40, rows[2][1], 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for clash in ("v", "id", "code", "score", "rank", "query_id", "w", "component", "asks", "__asks", "block", "kept0", "error"):
        df = df.withColumn(clash, F.lit("clash"))
    return df


def usable(df):
    rows = [r for r in df.select("vec_id", "embedding", "label").collect()
            if r[1] and len(r[1]) == 8 and all(x is not None and np.isfinite(x) for x in r[1])]
    return rows, np.array([r[1] for r in rows], dtype=np.float64)


# ------------------------------------------------------------------ whitening
def check_whitening(rows, matrix, got, k):
    x = np.floor(1024 * matrix).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    want = centred @ vectors / np.sqrt(values)
    assert len(got) == n * k
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
        assert r["n"] == n and r["deviation_exact"] == r["deviation"]
        assert abs(r["explained"] - values[r["component"] - 1] / values_total(centred)) < 1e-10
        assert r["identity_error"] < 1e-9
    deviations = [sum(int(n * a - b) ** 2 for a, b in zip(row, sums, strict=True)) for row in x.tolist()]
    signs = np.zeros(k)
    for i, (r, d) in enumerate(zip(rows, deviations, strict=True)):
        for c in range(k):
            own = np.array(by[(r[0], d)][c + 1])
            if signs[c] == 0 and abs(want[i, c]) > 1e-3:
                signs[c] = np.sign(own[0] * want[i, c])
            assert np.abs(own * signs[c] - want[i, c]).max() < 1e-8 or signs[c] == 0


def values_total(centred):
    return (centred ** 2).sum() / len(centred)


@pytest.mark.parametrize("k", [1, 3, 8])
def test_whitening_against_numpy(spark, k):
    df = edge_frame(spark)
    rows, matrix = usable(df)
    check_whitening(rows, matrix, whitening.whitened_rows(df, k=k).collect(), k)


def test_whitening_of_the_query(spark):
    from starling.llm.queries import QUERIES
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = df.collect()
    matrix = np.array([r["embedding"] for r in rows], dtype=np.float64)
    check_whitening([(r["vec_id"],) for r in rows], matrix, QUERIES["op11_embedding_whitening"](spark, SF_SMALL).collect(), 8)


def test_whitening_of_nothing_and_of_equal_rows(spark):
    assert whitening.whitened_rows(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whitened_rows(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0
    assert whitening.whitened_rows(spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)).count() == 0
    # three points on a line: one component only can be whitened
    line = spark.createDataFrame([(i, [float(i), float(i), 0.5], 1) for i in range(3)], SCHEMA)
    assert {r["component"] for r in whitening.whitened_rows(line).collect()} == {1}


@pytest.mark.parametrize("spectrum", [[9, 8, 7, 1, 1, 1], [5, 5, 5, 5, 5, 5], [4, 4, 4, 1, 0, 0], [1, 1 - 1e-9, .5, .25, 0, 0]])
def test_feast_finds_every_eigenvalue_of_the_interval(spectrum):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    values = np.array(spectrum + list(np.linspace(0, min(spectrum[-1], 1e-3), 34)))
    matrix = q * values @ q.T
    matrix = (matrix + matrix.T) / 2
    for shift in (-1, 0.3, 0.9, 4.5, 20):
        assert whitening.inertia_above(matrix, shift) == (np.linalg.eigvalsh(matrix) > shift).sum()
    a, b, count = whitening.leading_interval(matrix, 2)
    found, vectors = whitening.feast(matrix, a, b, count)
    assert count >= 2 and np.allclose(found, np.sort(values)[::-1][:count], atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12
    assert np.abs(vectors.T @ vectors - np.eye(count)).max() < 1e-12


# ------------------------------------------------------------------ top-k
def brute_top(rows, matrix, k, every=20):
    x = np.floor(64 * matrix).astype(np.int64)
    named = [(r[0], tuple(r[1]), v) for r, v in zip(rows, x, strict=True) if r[0] is not None]
    asking = {}
    for i, raw, v in named:
        if i % every == 0 and (i not in asking or raw < asking[i][0]):
            asking[i] = (raw, v)
    out = []
    for q, (_, v) in asking.items():
        best = sorted((-int(v @ w), i) for i, _, w in named if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("pilot,block,k", [(1 << 14, 1 << 14, 20), (16, 4, 20), (1, 3, 5), (40, 100, 400)])
def test_top_products_against_brute_force(spark, pilot, block, k):
    df = edge_frame(spark)
    rows, matrix = usable(df)
    got = topk_search.top_products(df, F.col("vec_id") % 20 == 0, k=k, pilot=pilot, block=block).collect()
    assert sorted(map(tuple, got)) == brute_top(rows, matrix, k)


def test_top_products_of_the_query_and_of_nothing(spark):
    from starling.llm.queries import QUERIES
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    matrix = np.array([r["embedding"] for r in rows], dtype=np.float64)
    assert sorted(map(tuple, QUERIES["op12_topk_search"](spark, SF_SMALL).collect())) == brute_top(rows, matrix, 20)
    asks = F.col("vec_id") % 20 == 0
    assert topk_search.top_products(spark.createDataFrame([], SCHEMA), asks).count() == 0
    assert topk_search.top_products(spark.createDataFrame([(1, [1.0], 1)], SCHEMA), asks).count() == 0
    assert topk_search.top_products(spark.createDataFrame([(20, [1.0], 1)], SCHEMA), asks).count() == 0


@pytest.mark.parametrize("segments", [1, 2, 3, 5, 8])
def test_segment_bound_never_falls_below_the_product(segments):
    rng = np.random.default_rng(segments)
    a, b = (np.floor(64 * rng.normal(size=(50, 8))) for _ in range(2))
    bound = topk_search.segment_features(a, segments) @ topk_search.segment_features(b, segments).T
    assert (bound - a @ b.T).min() > -1e-6
    assert np.abs((topk_search.segment_features(a, 8) @ topk_search.segment_features(b, 8).T) - a @ b.T).max() < 1e-6


# ------------------------------------------------------------------ vector codes
def brute_codes(rows, matrix, parts=4, entries=256, rounds=4):
    x = np.floor(1024 * matrix).astype(np.int64)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, tuple(rows[i][1])))
    books = [p[order[:entries]].copy() for p in np.split(x, parts, axis=1)]

    def assign(part, book):
        d = ((part[:, None, :] - book[None]) ** 2).sum(axis=2)
        return d.argmin(axis=1), d.min(axis=1)

    for _ in range(rounds):
        for p, part in enumerate(np.split(x, parts, axis=1)):
            a = assign(part, books[p])[0]
            for e in set(a.tolist()):
                books[p][e] = part[a == e].sum(axis=0) // (a == e).sum()
    last = [assign(part, books[p]) for p, part in enumerate(np.split(x, parts, axis=1))]
    error = sum(d for _, d in last)
    by_label = {}
    for r, e in zip(rows, error.tolist(), strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    return [(r[0], "".join(f"{a[i]:02x}" for a, _ in last), int(error[i]), by_label[r[2]], digest) for i, r in enumerate(rows)]


def none_last(rows):
    return sorted(rows, key=lambda r: (r[0] is None, *((x is None, x or 0) for x in r)))


@pytest.mark.parametrize("entries", [4, 16, 256])
def test_vector_codes_against_brute_force(spark, entries):
    df = edge_frame(spark)
    rows, matrix = usable(df)
    got = vector_codes.vector_codes(df, entries=entries).collect()
    assert none_last(map(tuple, got)) == none_last(brute_codes(rows, matrix, entries=entries))


def test_vector_codes_of_the_query_and_of_nothing(spark):
    from starling.llm.queries import QUERIES
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    matrix = np.array([r["embedding"] for r in rows], dtype=np.float64)
    got = QUERIES["op13_code_compression"](spark, SF_SMALL).collect()
    assert none_last(map(tuple, got)) == none_last(brute_codes([(r["vec_id"], r["embedding"], r["label"]) for r in rows], matrix))
    assert vector_codes.vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    with pytest.raises(ValueError):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 6, 1)], SCHEMA))


def test_equal_average_search_is_exact():
    rng = np.random.default_rng(9)
    for spread in (3, 50, 4000):
        book = rng.integers(-spread, spread, size=(200, 16))
        book[50:80] = book[:30]  # ties: the lower number
        parts = rng.integers(-spread, spread, size=(3000, 16)).astype(np.float64)
        parts[:200] = book
        d = ((parts[:, None, :] - book[None]) ** 2).sum(axis=2)
        number, distance = vector_codes.SortedBook(book).nearest(parts)
        assert (number == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
