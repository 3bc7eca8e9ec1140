"""Operator 8: language identification, known words first, then shorter and shorter n-grams.

A word known from training adds its log frequency in each language.  An unseen word backs
off: the mean log frequency of its known 4-grams (with word boundary marks), or if none is
known of its 3-grams, 2-grams, letters.  The language with the largest sum wins; the score
is its share after a softmax of sums scaled to at most ``SHARP`` words.  Words are runs of
letters with their combining marks, in any script.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import extended

LETTER_RUNS = regex.compile(r"\p{L}[\p{L}\p{M}\u200c\u200d]*")  # with (non-)joiners, which stand inside words
LONGEST, UNKNOWN, SHARP = 4, "und", 20
CACHED_WORDS = 100_000  # words whose rows a task remembers before it starts over
UNSEEN_WORDS, UNSEEN_GRAMS = 4096, 64  # unseen words looked up at once; a word with more grams is averaged alone
HELD_GRAMS = 1 << 20  # a task hands its counts on whenever it holds so many
NEW = [("lang_pred", T.StringType()), ("score", T.DoubleType())]


def _plain_runs() -> re.Pattern[str]:
    """``LETTER_RUNS`` spelled out for ``re``, which is several times faster with a list of characters; holds for
    texts without characters past U+FFFF."""
    def listed(kind: str) -> str:
        return "".join(f"{m[0][0]}-{m[0][-1]}" for m in regex.finditer(kind, "".join(map(chr, range(0x10000)))))
    return re.compile(f"[{listed(r'\p{L}+')}][{listed(r'[\p{L}\p{M}\u200c\u200d]+')}]*")


PLAIN_RUNS, PAST_PLAIN = _plain_runs(), re.compile("[\U00010000-\U0010ffff]")


def letter_runs(text: str) -> list[str]:
    """The lower-cased words of a text."""
    text = text.lower()
    return (LETTER_RUNS if not text.isascii() and PAST_PLAIN.search(text) else PLAIN_RUNS).findall(text)


def grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    marked = f"_{word}_"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Logs:
    """Log frequencies of words and n-grams (rows) in languages (columns).  Held are only the languages a
    row was found in; in the others it has half a count.  ``logs[rows]`` is the dense matrix of some rows."""

    def __init__(self, row: np.ndarray, lang: np.ndarray, n: np.ndarray, kind: np.ndarray, totals: np.ndarray) -> None:
        order = np.argsort(row, kind="stable")
        self.first = np.searchsorted(row[order], np.arange(len(kind) + 1))
        self.lang, self.gain = lang[order], np.log(n[order] / 0.5).astype(np.float32)
        self.kind, self.base = kind, np.log(0.5 / totals).astype(np.float32)

    def __len__(self) -> int:
        return len(self.kind)

    def __getitem__(self, rows: list[int]) -> np.ndarray:
        at = np.asarray(rows, np.int64)
        out, begin = self.base[self.kind[at]], self.first[at]
        size = self.first[at + 1] - begin
        held = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        out[np.repeat(np.arange(len(at)), size), self.lang[held]] += self.gain[held]
        return out


class Model:
    """``rows`` maps words (order 0) and n-grams (order n) to rows of ``logs`` (languages in columns)."""

    def __init__(self, languages: list[str], rows: list[dict[str, int]], logs: np.ndarray | Logs) -> None:
        self.languages, self.rows, self.logs = languages, rows, logs

    def unseen(self, word: str) -> np.ndarray:
        return self.unseen_rows([word])[0]

    def unseen_rows(self, words: list[str]) -> np.ndarray:
        """Log frequencies of words not known from training, a row each."""
        found = []
        for word in words:
            for n in range(LONGEST, 0, -1):
                get = self.rows[n].get
                known = [r for g in grams(word, n) if (r := get(g)) is not None]
                if known:
                    break
            found.append(known)
        out = np.zeros((len(words), len(self.languages)), np.float32)
        for i, known in enumerate(found):
            if len(known) > UNSEEN_GRAMS:
                out[i], found[i] = self.logs[known].mean(0), []
        size = np.array([len(known) for known in found], np.int64)
        logs, first = self.logs[[r for known in found for r in known]], np.cumsum(size) - size
        todo = np.flatnonzero(size)
        for j in range(size.max(initial=0)):  # the sums of all words grow by one gram a step
            todo = todo[size[todo] > j]
            out[todo] += logs[first[todo] + j]
        todo = np.flatnonzero(size)
        out[todo] /= size[todo, None].astype(np.float32)
        return out


def training_rows(docs: DataFrame, per_language: int) -> DataFrame:
    """(text, lang) of ``per_language`` distinct texts of each language (all of them if there are
    no more): those with the smallest hashes, however many rows repeat a text.

    Distinct hashes are counted first, combined before each shuffle; only the smallest share of them,
    a little over ``per_language`` a language, meets in the task that ranks a language."""
    known = (docs.where("text IS NOT NULL AND lang IS NOT NULL")
             .select("text", "lang", F.xxhash64("text").alias("hash")))
    kinds = known.groupBy("lang", "hash").agg(F.lit(1).alias("one"))
    sizes = kinds.groupBy("lang").count().collect()
    if not sizes:
        return known.select("text", "lang")
    enough = per_language + 10 * math.sqrt(per_language) + 100  # ten deviations more than are wanted
    below = F.create_map(*[F.lit(x) for r in sizes
                           for x in (r["lang"], int(min(1.0, enough / r["count"]) * (2**64 - 2**11)) - 2**63)])
    smallest = Window.partitionBy("lang").orderBy("hash")
    last = (kinds.where(F.col("hash") <= below[F.col("lang")]).withColumn("place", F.row_number().over(smallest))
            .where(F.col("place") <= per_language).groupBy("lang").agg(F.max("hash").alias("last")).collect())
    limit = F.create_map(*[F.lit(x) for r in last for x in (r["lang"], r["last"])])
    return known.where(F.col("hash") <= limit[F.col("lang")]).groupBy("text", "lang").agg(F.lit(1)).select("text", "lang")


def train(docs: DataFrame, per_language: int = 1000) -> Model:
    """A model from ``docs`` (text, lang): counts of every word and every n-gram of ``per_language``
    distinct documents a language, read whole.  No labelled row: no language."""
    def count(batches):
        def table(found: Counter) -> pa.RecordBatch:
            keys = list(found)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.string()), pa.array(list(found.values()), pa.int64())],
                ["lang", "kind", "gram", "n"])
        for batch in batches:
            found: Counter = Counter()
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                for word, k in Counter(letter_runs(text.as_py())).items():
                    found[lang, 0, word] += k
                    for n in range(1, LONGEST + 1):
                        for g in grams(word, n):
                            found[lang, n, g] += k
                    if len(found) >= HELD_GRAMS:
                        yield table(found)
                        found.clear()
            yield table(found)

    got = (training_rows(docs, per_language).mapInArrow(count, "lang string, kind int, gram string, n long")
           .groupBy("lang", "kind", "gram").agg(F.sum("n").alias("n")).toArrow())
    languages = sorted(set(got["lang"].unique().to_pylist()))
    column = {lang: i for i, lang in enumerate(languages)}
    rows: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    row, lang, kinds = np.empty(len(got), np.int64), np.empty(len(got), np.int32), []
    at = 0
    for batch in got.to_batches():
        for name, kind, gram in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            found = rows[kind].setdefault(gram, len(kinds))
            if found == len(kinds):
                kinds.append(kind)
            row[at], lang[at] = found, column[name]
            at += 1
    n, kind_of = got["n"].to_numpy().astype(float), got["kind"].to_numpy()
    totals = np.ones((LONGEST + 1, len(languages)))
    if len(got):
        np.add.at(totals, (kind_of, lang), n)
        totals -= totals > 1  # 1 only where a language has no gram of a length
    return Model(languages, rows, Logs(row, lang, n, np.array(kinds, np.int8), totals))


class Scorer:
    """Scores texts in a task; remembers the rows of words up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, model.rows[0]
        self.table = np.zeros((CACHED_WORDS, len(model.languages)), np.float32)
        self.cache: dict[str, int] = {}

    def rows(self, words: list[str]) -> np.ndarray:
        """Log frequencies of at most ``CACHED_WORDS`` words."""
        if len(self.cache) + len(words) > CACHED_WORDS:
            self.cache.clear()
        new = [w for w in words if w not in self.cache]
        if new:
            begin = len(self.cache)
            self.cache.update(zip(new, range(begin, begin + len(new)), strict=True))
            known = [self.known.get(w, -1) for w in new]
            seen = [i for i, r in enumerate(known) if r >= 0]
            if seen:
                self.table[begin + np.array(seen)] = self.model.logs[[known[i] for i in seen]]
            unseen = [i for i, r in enumerate(known) if r < 0]
            for a in range(0, len(unseen), UNSEEN_WORDS):
                part = unseen[a:a + UNSEEN_WORDS]
                self.table[begin + np.array(part)] = self.model.unseen_rows([new[i] for i in part])
        return self.table[np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))]

    def __call__(self, text: str | None) -> tuple[str, float]:
        found = Counter(letter_runs(text)) if text else None
        if not found or not self.model.languages:
            return UNKNOWN, 0.0
        sums, words = np.zeros(len(self.model.languages)), list(found)
        for a in range(0, len(words), CACHED_WORDS):
            part = words[a:a + CACHED_WORDS]
            sums += np.array([found[w] for w in part]) @ self.rows(part)
        scaled = (sums - sums.max()) * min(1.0, SHARP / found.total())
        best = int(sums.argmax())
        return self.model.languages[best], float(1 / np.exp(scaled).sum())


def identify(docs: DataFrame, model: Model, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus lang_pred and score (0 to 1), from the text alone and the whole of it.

    ``und`` with score 0 for null texts, texts without a letter, and a model without
    languages; ties go to the first language by name.  Clashing columns are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held: list[Scorer] = []

    def score(text: pa.Array) -> list:
        if not held:
            held.append(Scorer(shared.value))
        found = [held[0](t.as_py()) for t in text]
        return [[f[0] for f in found], [f[1] for f in found]]

    return extended(docs, ["text"], NEW, score, drop)
