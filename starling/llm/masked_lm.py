"""Operator 4: language-model scores by masked pseudo-likelihood.

Every word is predicted from the two words on either side of it by a small network trained here
in numpy; a document's score is the sum of the log-probabilities of all its words, each given
both sides.

* Words are counted over the whole corpus.  The ``VOCABULARY`` commonest have an id of their own;
  any other word has one of ``BUCKETS`` shared ids by its hash, and within the bucket it is as
  likely as its own corpus count says (a word the corpus lacks counts as one more in the bucket).
  The counts stay a table, joined by word hash to the words of the documents.
* Network: position-wise embeddings of the four neighbours are summed and squashed (tanh); the
  id is predicted in two softmax steps, its class (ids in blocks of ``WIDTH``) and its place in the class.
* Texts are turned into 16-bit ids once, in a stored table that training and scoring read.
* Training is data-parallel and meets every window once, in rounds over a share of the texts each.  A
  round's texts are dealt by their hash over shards of about ``SHARD_TOKENS`` words; AdaGrad runs over a
  shard in hash order, and the shards' parameters are averaged, weighted by windows, in as many levels of 64 as
  it takes.  Shards and their order follow from the texts alone, so the scores do not depend on how
  the table is partitioned, and a shard meets as many words in a large corpus as in a small one.
  Copies of a text are counted before they travel and spread over all shards.
  Only the averaged parameters, whose size does not depend on the corpus, reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import extended, stored, text_slices
from starling.llm.words import Words

WIDTH, CLASSES, DIM, REACH = 64, 32, 24, 2
IDS = WIDTH * CLASSES
BUCKETS = 64
VOCABULARY = IDS - BUCKETS - 1
EDGE = IDS - 1  # stands beyond the ends of a document
OFFSETS = [o for o in range(-REACH, REACH + 1) if o]
FARTHEST = np.float32(60)  # logits are held within it, so that sums of exponentials stay finite
CHUNK = 1 << 14  # parameters travel in pieces of so many numbers
HELD_WORDS = 1 << 20  # a task merges its word counts whenever it holds so many
SHARD_TOKENS = 1 << 21  # words one network is trained on before networks are averaged
MOST_TASKS = 20_000  # of a round; beyond them a task trains several shards, one after the other
NEW = [("n_tokens", T.LongType()), ("log_prob", T.DoubleType()), ("mean_log_prob", T.DoubleType())]


class Vocabulary:
    def __init__(self, top: np.ndarray, log_share: np.ndarray, counts: DataFrame | None = None) -> None:
        order = np.argsort(top)
        self.hashes, self.ids = top[order], order.astype(np.int32)  # ids by falling count
        self.log_share = log_share  # of one occurrence within its bucket
        self.counts = counts  # (word, n) of the words in buckets that occur more than once

    def __getstate__(self) -> dict:  # tables stay with the driver
        return self.__dict__ | {"counts": None}

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        out = (VOCABULARY + (hashes % np.uint64(BUCKETS)).astype(np.int32)).astype(np.int32)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.ids[at[known]]
        return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): 64-bit word hashes and counts over all documents."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            words, inverse = np.unique(np.concatenate([w for w, _ in parts]), return_inverse=True)
            return words, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)

        def batch_of(words: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                words = Words(batch.column(0).slice(a, b - a), lower=True).hashes()
                parts.append(np.unique(words, return_counts=True))
                held += len(parts[-1][0])
                if held > 2 * HELD_WORDS:
                    parts = [merged()]
                    held = len(parts[0][0])
                    if held > HELD_WORDS:
                        yield batch_of(*parts[0])
                        parts, held = [], 0
        if parts:
            yield batch_of(*merged())

    return docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame) -> Vocabulary:
    counts = stored(word_counts(docs), "word-counts")
    first = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    top, often = np.array([r["word"] for r in first], np.int64).view(np.uint64), np.array([r["n"] for r in first], np.int64)
    # the bucket of an unsigned hash, from its signed form (2^64 is a multiple of BUCKETS)
    bucket = F.pmod("word", F.lit(BUCKETS))
    sizes = {r["b"]: r["n"] for r in counts.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).collect()}
    total = np.array([sizes.get(b, 0) for b in range(BUCKETS)], float)
    np.subtract.at(total, (top % np.uint64(BUCKETS)).astype(int), often)
    share = np.zeros(IDS, np.float32)
    share[VOCABULARY:VOCABULARY + BUCKETS] = -np.log(total + 1)
    return Vocabulary(top, share, counts.where("n > 1"))


class Network:
    """Parameters: an embedding table for each offset; weights of the classes and of the places in each class, whose
    last row is the bias (the squashed sum is followed by a 1)."""

    SHAPES = [(len(OFFSETS), IDS, DIM), (DIM + 1, CLASSES), (CLASSES, DIM + 1, WIDTH)]

    def __init__(self, flat: np.ndarray | None = None, seed: int = 1) -> None:
        sizes = [int(np.prod(s)) for s in self.SHAPES]
        if flat is None:
            flat = (np.random.default_rng(seed).standard_normal(sum(sizes)) * 0.1).astype(np.float32)
        self.flat = np.array(flat, np.float32)
        cuts = np.cumsum([0, *sizes])
        self.embed, self.classes, self.places = [
            self.flat[a:b].reshape(s) for a, b, s in zip(cuts[:-1], cuts[1:], self.SHAPES, strict=True)]
        self.to_class, self.class_bias = self.classes[:DIM], self.classes[DIM]
        self.to_word, self.word_bias = self.places[:, :DIM], self.places[:, DIM]

    def hidden(self, context: np.ndarray) -> np.ndarray:
        out = np.ones((context.shape[1], DIM + 1), np.float32)
        total = self.embed[0].take(context[0], 0)
        for table, ids in zip(self.embed[1:], context[1:], strict=True):
            total += table.take(ids, 0)
        np.tanh(total, out=out[:, :DIM])
        return out

    def _place_logits(self, sorted_h: np.ndarray, cuts: list[int]) -> np.ndarray:
        """Logits of the places in the own class of each row; the rows are sorted by class."""
        out = np.empty((len(sorted_h), WIDTH), np.float32)
        for c, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                np.matmul(sorted_h[a:b], self.places[c], out=out[a:b])
        return out

    @staticmethod
    def _log_share(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """The log-softmax of one column of every row."""
        np.clip(logits, -FARTHEST, FARTHEST, out=logits)
        own = logits[np.arange(len(logits)), chosen]
        np.exp(logits, out=logits)
        return own - np.log(logits @ np.ones(logits.shape[1], np.float32))

    def log_probs(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log p(target | both sides) of every window."""
        h = self.hidden(context)
        which, place = target // WIDTH, target % WIDTH
        out = self._log_share(h @ self.classes, which)
        order, cuts = self._by_class(which)
        out[order] += self._log_share(self._place_logits(h.take(order, 0), cuts), place[order])
        return out

    @staticmethod
    def _errors(logits: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Gradient of the mean loss by the logits: softmax less the chosen column, over the rows."""
        n = len(logits)
        np.clip(logits, -FARTHEST, FARTHEST, out=logits)
        np.exp(logits, out=logits)
        logits *= (1 / (n * (logits @ np.ones(logits.shape[1], np.float32))))[:, None]
        logits[np.arange(n), chosen] -= np.float32(1 / n)
        return logits

    @staticmethod
    def _by_class(which: np.ndarray) -> tuple[np.ndarray, list[int]]:
        order = np.argsort(which.astype(np.int16), kind="stable")
        return order, np.searchsorted(which[order], np.arange(CLASSES + 1)).tolist()

    def train(self, context: np.ndarray, target: np.ndarray, past: Network, rate: float = 0.1) -> None:
        """One AdaGrad step on a mini-batch; ``past`` holds the sums of squared gradients."""
        h = self.hidden(context)
        which, place = target // WIDTH, target % WIDTH
        p = self._errors(h @ self.classes, which)
        back = p @ self.to_class.T
        self._step(self.classes, past.classes, h.T @ p, rate)
        order, cuts = self._by_class(which)
        sorted_h = h.take(order, 0)
        q = self._errors(self._place_logits(sorted_h, cuts), place[order])
        inner, words = np.empty((len(h), DIM), np.float32), np.zeros_like(self.places)
        for c, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a < b:
                np.matmul(q[a:b], self.to_word[c].T, out=inner[a:b])
                np.matmul(sorted_h[a:b].T, q[a:b], out=words[c])
        back[order] += inner
        self._step(self.places, past.places, words, rate)
        h = h[:, :DIM]
        back *= 1 - h * h
        for table, squares, ids in zip(self.embed, past.embed, context, strict=True):
            order = np.argsort(ids.astype(np.int16), kind="stable")
            sorted_ids = ids[order]
            first = np.flatnonzero(np.concatenate([[True], sorted_ids[1:] != sorted_ids[:-1]]))
            seen, grad = sorted_ids[first], np.add.reduceat(back.take(order, 0), first, axis=0)
            total = squares.take(seen, 0)
            total += grad * grad
            squares[seen] = total
            grad *= rate
            grad /= np.sqrt(total, out=total)
            table[seen] -= grad

    @staticmethod
    def _step(weights: np.ndarray, squares: np.ndarray, grad: np.ndarray, rate: float) -> None:
        squares += grad * grad
        grad *= rate
        grad /= np.sqrt(squares)
        weights -= grad


def neighbours(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Ids around each word of documents that begin and end at ``first``: one row per offset, EDGE
    beyond the ends of a document."""
    out = np.full((len(OFFSETS), len(ids)), EDGE, np.int32)
    for row, o in zip(out, OFFSETS, strict=True):
        if o > 0:
            row[:-o] = ids[o:]
        else:
            row[-o:] = ids[:o]
        for j in range(abs(o)):  # the last (first) words of a document look beyond it
            at = first[1:] - 1 - j if o > 0 else first[:-1] + j
            row[at[(at >= 0) & (at < len(ids))]] = EDGE
    return out


def joined_ids(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a slice of the ``ids`` column, and where each document's begin and end."""
    first = np.concatenate([[0], np.cumsum(pc.binary_length(rows).to_numpy(zero_copy_only=False))]) // 2
    return np.frombuffer(b"".join(rows.to_pylist()), np.uint16).astype(np.int32), first


def encoded(docs: DataFrame, words: Vocabulary, drop: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """A stored table: columns c0, c1 ... of ``docs`` (but those of ``drop`` and ``NEW``, whose names are
    returned), ``row`` (an id of the row), ``ids`` (16-bit ids of all words of the whole text) and, of the words
    with a shared id, the distinct hashes ``rare`` with their counts ``times``."""
    gone = {n for n, _ in NEW} | {d.lower() for d in drop}
    kept = [c for c in docs.columns if c.lower() not in gone]
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def encode(text: pa.Array) -> list:
        found = Words(text, lower=True)
        hashes, first = found.hashes(), found.first
        ids = shared.value.lookup(hashes)
        small = ids.astype(np.uint16).tobytes()
        lone = np.flatnonzero((ids >= VOCABULARY) & (ids < VOCABULARY + BUCKETS))
        doc, rare = np.searchsorted(first, lone, "right") - 1, hashes[lone]
        order = np.lexsort((rare, doc))
        doc, rare = doc[order], rare[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1])])[:len(doc)])
        times = np.diff(np.concatenate([new, [len(doc)]]))
        begin = np.searchsorted(doc[new], np.arange(len(text) + 1)).astype(np.int32)
        cuts = (2 * first).tolist()
        return [[small[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)],
                pa.ListArray.from_arrays(begin, rare[new].view(np.int64)), pa.ListArray.from_arrays(begin, times.astype(np.int32))]

    wide = docs.select("text", *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    table = extended(wide, ["text"], [("ids", T.BinaryType()), ("rare", T.ArrayType(T.LongType())), ("times", T.ArrayType(T.IntegerType()))],
                     encode, ("text",))
    return stored(table.withColumn("row", F.monotonically_increasing_id()), "lm-ids"), kept


def averaged(parts: DataFrame, size: int) -> np.ndarray | None:
    """The mean of the shards' parameters, weighted by their windows, in levels of groups of 64."""
    def total(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("task")  # the same sum in every run
        weights = rows["weight"].to_numpy()
        summed = sum(w * np.frombuffer(v, np.float32).astype(np.float64) for w, v in zip(weights, rows["numbers"], strict=True))
        mean = (summed / weights.sum()).astype(np.float32)
        return pd.DataFrame({"task": [rows["task"].iloc[0] // 64], "chunk": [rows["chunk"].iloc[0]],
                             "weight": [float(weights.sum())], "numbers": [mean.tobytes()]})

    level = stored(parts, "lm-parts")
    last = level.agg(F.max("task").alias("last")).first()["last"]
    if last is None:
        return None
    while True:
        level = (level.groupBy("chunk", F.expr("task div 64").alias("part"))
                 .applyInPandas(lambda key, rows: total(rows), "task long, chunk int, weight double, numbers binary"))
        last //= 64
        if last == 0:
            break
    flat = np.concatenate([np.frombuffer(r["numbers"], np.float32) for r in sorted(level.collect(), key=lambda r: r["chunk"])])
    return flat[:size]


def train(docs: DataFrame, words: Vocabulary, every: int = 2, batch: int = 1024) -> Network:
    """A network trained on every window of ``docs`` once, in ``every`` rounds of averaging: a text belongs
    to the round that its hash modulo ``every`` names."""
    return train_encoded(encoded(docs.select("text"), words, ("text",))[0], every, batch)


def shards_of_round(table: DataFrame, r: int, every: int, shards: int) -> DataFrame:
    """(shard, ids) of round ``r``, a row for each copy of a text, a shard's rows together and in hash order."""
    texts = (table.where("length(ids) > 0").where(F.pmod(F.xxhash64("ids"), F.lit(every)) == r)
             .groupBy("ids").agg(F.count(F.lit(1)).alias("n")))
    # of n copies every shard gets its part; they multiply only there
    spread = texts.withColumn("turns", F.least("n", F.lit(shards))).select("*", F.explode(F.expr("sequence(0L, turns - 1)")).alias("copy"))
    dealt = spread.select("ids", "copy", F.expr("n div turns + int(copy < n % turns)").alias("times"),
                          F.when(F.col("turns") == shards, F.col("copy")).otherwise(
                              F.pmod(F.xxhash64("copy", "ids"), F.lit(shards))).alias("shard"))
    tasks = min(shards, MOST_TASKS)
    here = dealt.repartitionById(tasks, F.pmod("shard", F.lit(tasks)).cast("int"))
    turned = here.select("shard", "ids", "copy", F.explode(F.expr("sequence(1L, times)")).alias("turn"))
    return (turned.withColumn("place", F.xxhash64("turn", "copy", "ids")).sortWithinPartitions("shard", "place", "ids", "copy", "turn")
            .select("ids", "shard"))


def train_encoded(table: DataFrame, every: int = 2, batch: int = 1024) -> Network:
    """``train`` on a table with a column ``ids``."""
    context, network = table.sparkSession.sparkContext, Network()
    total = (table.agg(F.sum(F.length("ids")).alias("bytes")).first()["bytes"] or 0) // 2
    shards = max(1, math.ceil(total / every / SHARD_TOKENS))
    for r in range(every):
        shared = context.broadcast(network.flat)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            shard, local, past, seen = None, None, None, 0
            waiting: list[tuple[np.ndarray, np.ndarray]] = []
            held = 0

            def learn(least: int) -> None:
                """Trains on what waits, in mini-batches, until fewer than ``least`` windows are left."""
                nonlocal waiting, held, seen
                if held < least:
                    return
                sides, target = np.concatenate([s for s, _ in waiting], 1), np.concatenate([t for _, t in waiting])
                done = 0
                while held - done >= least:
                    step = min(batch, held - done)
                    local.train(sides[:, done:done + step], target[done:done + step], past)
                    done += step
                seen += done
                waiting, held = [(sides[:, done:], target[done:])], held - done

            def learnt() -> pa.RecordBatch:
                learn(1)
                pieces = [local.flat[i:i + CHUNK].tobytes() for i in range(0, len(local.flat), CHUNK)]
                n = len(pieces)
                return pa.RecordBatch.from_arrays(
                    [pa.array([shard] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array([float(seen)] * n), pa.array(pieces, pa.binary())], ["task", "chunk", "weight", "numbers"])

            for rows in batches:
                of = rows.column(1).to_numpy()
                cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
                for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                    if low == high:
                        continue
                    if of[low] != shard:
                        if shard is not None:
                            yield learnt()
                        shard, local, past, seen = int(of[low]), Network(shared.value), Network(np.full(len(shared.value), 1e-6, np.float32)), 0
                        waiting, held = [], 0
                    mine = rows.column(0).slice(low, high - low)
                    for a, b in text_slices(mine):
                        ids, first = joined_ids(mine.slice(a, b - a))
                        waiting.append((neighbours(ids, first), ids))
                        held += len(ids)
                        learn(batch)
            if shard is not None:
                yield learnt()

        parts = shards_of_round(table, r, every, shards).mapInArrow(run, "task long, chunk int, weight double, numbers binary")
        flat = averaged(parts, len(network.flat))
        if flat is not None:  # None: no words in this round
            network = Network(flat)
    return network


def score_documents(docs: DataFrame, words: Vocabulary, network: Network, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus n_tokens, log_prob (sum over all words of the whole text) and mean_log_prob.

    Null and empty texts have 0 words, log_prob 0 and a null mean.  Repeated rows score alike;
    other columns pass through but for those of ``drop``; clashing names are replaced.
    """
    return score_encoded(*encoded(docs, words, drop), words, network)


def score_encoded(table: DataFrame, names: list[str], words: Vocabulary, network: Network) -> DataFrame:
    """``score_documents`` on the table and names that ``encoded`` gave."""
    shared = table.sparkSession.sparkContext.broadcast((words.log_share, network.flat))
    held: list[tuple[np.ndarray, Network]] = []

    def score(rows: pa.Array) -> list:
        if not held:
            held.append((shared.value[0], Network(shared.value[1])))
        log_share, model = held[0]
        target, first = joined_ids(rows)
        sides, each = neighbours(target, first), np.zeros(len(target))
        for a in range(0, len(target), 8192):
            part = target[a:a + 8192]
            each[a:a + 8192] = model.log_probs(sides[:, a:a + 8192], part) + log_share[part]
        total = np.concatenate([[0.0], np.cumsum(each)])
        return [np.diff(first), total[first[1:]] - total[first[:-1]]]

    columns = [f"c{i}" for i in range(len(names))]
    found = extended(table.select("ids", "row", *columns), ["ids"], [("n_tokens", T.LongType()), ("own", T.DoubleType())], score, ("ids",))
    inside = (table.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r"))
              .select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times")).join(words.counts, "word")
              .groupBy("row").agg(F.sum(F.col("times") * F.log("n")).alias("inside")))
    log_prob = F.col("own") + F.coalesce("inside", F.lit(0.0))
    return (found.join(inside, "row", "left")
            .select(*[F.col(c).alias(n) for c, n in zip(columns, names, strict=True)], "n_tokens", log_prob.alias("log_prob"),
                    F.when(F.col("n_tokens") > 0, log_prob / F.col("n_tokens")).alias("mean_log_prob")))


def pseudo_likelihood(docs: DataFrame, drop: tuple[str, ...] = (), **options) -> DataFrame:
    """Train on ``docs`` and score them; ``options`` go to ``train_encoded``."""
    words = vocabulary(docs)
    table, names = encoded(docs, words, drop)
    return score_encoded(table, names, words, train_encoded(table, **options))
