"""Operator 9: a quality score from a factorisation machine.

Features of a document: the distinct words of its whole text hashed into ``BUCKETS`` (each
1/sqrt(distinct)), structure statistics, and its n_chars metadata.  With factors V the score
is w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2], which costs time
linear in the number of features although it holds every pairwise interaction.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starling.llm.common import extended, labelled_sample, text_slices
from starling.llm.line_crf import BANG, DIGITS, LETTERS, PIPE, SYMBOLS, UPPER, Lines
from starling.llm.words import Words, class_counts, distinct_sorted, span_hashes, windows

BUCKETS, FACTORS, STATS = 1 << 15, 8, 16
SIZE = BUCKETS + STATS
NEW = [("score", T.DoubleType())]


def features(text: pa.Array, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: feature numbers, values, and ``first`` offsets by document."""
    words = Words(text, lower=False)
    lines, hashes = Lines(words), Words(text, lower=True).hashes()
    begin, end, n = words.offsets[:-1], words.offsets[1:], np.maximum(words.counts, 1)
    buckets, first = distinct_sorted(hashes % np.uint64(BUCKETS), words.first)
    kinds = np.diff(first)
    share = lambda flags, of: class_counts(words.data, flags, begin, end) / np.maximum(of, 1)
    letters = class_counts(words.data, LETTERS, begin, end)
    grams, gram_first = windows(hashes, words.first, 5)
    gram_kinds, n_grams = np.diff(distinct_sorted(grams, gram_first)[1]), np.diff(gram_first)
    line_kinds = np.diff(distinct_sorted(span_hashes(words.data, lines.starts, lines.ends), lines.first)[1])
    n_lines = np.diff(lines.first)
    size = end - begin
    known = ~np.isnan(n_chars)
    chars = np.where(known, np.maximum(np.nan_to_num(n_chars), 0), 0)
    stats = np.column_stack([
        np.log1p(words.counts) / 10, size / n / 20, np.minimum(share(SYMBOLS, n), 2), np.minimum(share(PIPE, n), 2),
        np.minimum(share(BANG, n), 2), share(UPPER, letters), share(DIGITS, size), 1 - letters / np.maximum(size, 1),
        kinds / n, 1 - gram_kinds / np.maximum(n_grams, 1), 1 - line_kinds / np.maximum(n_lines, 1),
        np.log1p(n_lines) / 10, np.log1p(n / np.maximum(n_lines, 1)) / 10, words.counts < 10,
        np.log1p(chars) / 10, known]).astype(np.float32)
    rows = len(text)
    width = kinds + STATS
    out_first = np.concatenate([[0], np.cumsum(width)])
    index, value = np.empty(out_first[-1], np.int32), np.empty(out_first[-1], np.float32)
    stat_at = out_first[1:, None] - STATS + np.arange(STATS)
    index[stat_at], value[stat_at] = BUCKETS + np.arange(STATS), stats
    doc = np.repeat(np.arange(rows), kinds)
    at = out_first[:-1][doc] + np.arange(len(buckets)) - first[:-1][doc]
    index[at], value[at] = buckets.astype(np.int32), (1 / np.sqrt(np.maximum(kinds, 1)))[doc]
    return index, value, out_first


class Machine:
    def __init__(self, seed: int = 1) -> None:
        self.bias, self.weight = 0.0, np.zeros(SIZE, np.float32)
        self.factor = (np.random.default_rng(seed).standard_normal((SIZE, FACTORS)) * 0.02).astype(np.float32)

    def parts(self, index: np.ndarray, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw scores and the factor sums; every document has features (its statistics)."""
        vx = self.factor[index] * value[:, None]
        sums = np.add.reduceat(vx, first[:-1], axis=0)
        squares = np.add.reduceat((vx * vx).sum(1), first[:-1])
        linear = np.add.reduceat(self.weight[index] * value, first[:-1])
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums

    def probability(self, index: np.ndarray, value: np.ndarray, first: np.ndarray) -> np.ndarray:
        if len(first) == 1:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.parts(index, value, first)[0].astype(float), -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 8,
            rate: float = 0.05, l2: float = 1e-4, batch: int = 64, seed: int = 1) -> Machine:
        """Logistic loss, both labels weighted alike, AdaGrad steps on mini-batches."""
        if len(np.unique(labels)) < 2:
            self.bias = 10.0 * (2 * float(labels.mean()) - 1) if len(labels) else 0.0
            return self
        rng, good = np.random.default_rng(seed), labels.mean()
        weights = np.where(labels == 1, 0.5 / good, 0.5 / (1 - good))
        past_w, past_v, past_b = np.full(SIZE, 1e-6, np.float32), np.full((SIZE, FACTORS), 1e-6, np.float32), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for a in range(0, len(order), batch):
                part = order[a:a + batch]
                index = np.concatenate([rows[i][0] for i in part])
                value = np.concatenate([rows[i][1] for i in part])
                width = np.array([len(rows[i][0]) for i in part])
                first = np.concatenate([[0], np.cumsum(width)])
                raw, sums = self.parts(index, value, first)
                error = ((1 / (1 + np.exp(-raw)) - labels[part]) * weights[part] / len(part)).astype(np.float32)
                each = np.repeat(error, width) * value
                seen, where = np.unique(index, return_inverse=True)
                grad_w = np.bincount(where, each, len(seen)) + l2 * self.weight[seen]
                slope = each[:, None] * (np.repeat(sums, width, axis=0) - self.factor[index] * value[:, None])
                grad_v = np.column_stack([np.bincount(where, slope[:, f], len(seen)) for f in range(FACTORS)])
                grad_v += l2 * self.factor[seen]
                past_w[seen] += grad_w**2
                past_v[seen] += grad_v**2
                past_b += float(error.sum())**2
                self.weight[seen] -= rate * grad_w / np.sqrt(past_w[seen])
                self.factor[seen] -= rate * 0.3 * grad_v / np.sqrt(past_v[seen])
                self.bias -= rate * float(error.sum()) / past_b**0.5
        return self


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: NaN


def train(docs: DataFrame, labels: DataFrame, max_docs: int = 4000) -> Machine:
    """A machine from at most ``max_docs`` labelled documents (docs: doc_id, text, n_chars;
    labels: doc_id, quality 0/1), one for each id.  Only their hashed features reach the driver.  Without
    labels every score is 0.5; with one kind of label it is near that label."""
    rows = labelled_sample(docs, labels, max_docs, ["text", "n_chars"])

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                index, value, first = features(part.column(0), _numbers(part.column(1)))
                cut = list(zip(first[:-1], first[1:], strict=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array([index[x:y].tobytes() for x, y in cut], pa.binary()),
                    pa.array([value[x:y].tobytes() for x, y in cut], pa.binary()), part.column(2).cast(pa.int32())],
                    ["features", "amounts", "quality"])

    got = sorted((bytes(r[0]), bytes(r[1]), r[2]) for r in
                 rows.mapInArrow(run, "features binary, amounts binary, quality int").collect())
    return Machine().fit([(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32)) for i, v, _ in got],
                         np.array([q for *_, q in got], np.float64))


def score_documents(docs: DataFrame, machine: Machine, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus score (0 to 1, higher: good quality likelier) of every whole text.

    Null text counts as empty and is scored like any other; null n_chars has its own flag.
    ``docs`` needs text and n_chars; clashing columns are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def score(text: pa.Array, chars: pa.Array) -> list:
        return [shared.value.probability(*features(text, _numbers(chars)))]

    return extended(docs, ["text", "n_chars"], NEW, score, drop)
