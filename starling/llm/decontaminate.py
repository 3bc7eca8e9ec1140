"""Operator 2: benchmark decontamination by CGK embedding and bit-sampling LSH.

Words are runs of letters and digits (ASCII punctuation and white space part them), lower-cased
(A-Z); in scripts without spaces every character is a word.  An item of n words leaks into a document if some run of the document's words is within
floor(edit_rate * n) word edits of the whole item; under ``min_words`` words, if they are equal.

* CGK: a random walk copies a window's words to an output of twice its length, moving on to the
  next word or staying by a random bit of (output place, word).  Windows at a small edit distance
  get outputs at a small Hamming distance.
* Bit sampling: a key is a hash of ``SAMPLED`` output places.  Windows share a key if they agree
  there; the number of keys (over several walks) is chosen by simulation so that an occurrence
  with ``edit_rate`` of its words edited is found with probability ``target``, at every size.
* Items are put into size classes; each class slides windows of its own size (``WIDEST`` words at
  most, so that several fit into a long item) over the documents, so densely that every unedited
  occurrence holds a whole window, and indexes all windows of its items.
* Items under ``min_words`` words are looked up by the hash of their whole word sequence.
* Candidates are verified exactly: semi-global word edit distance of the whole item against the
  document around the window.

Items are a stated query set: they are indexed in blocks of ``ITEM_BLOCK``.  One pass without a shuffle
searches all documents: a task cuts a slice of texts into words once and holds it against one block
after the other, each read again from the executor's disk copy, so that a Python worker has one index in
memory however many items there are.  The driver makes one index at a time.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import extended
from starling.llm.words import PUNCTUATION, Words, mix64, windows

SAMPLED, SAMPLES_PER_WALK, ITEM_BLOCK = 6, 8, 2000
WIDEST, MOST_KEYS = 24, 512
FILTER_BITS = 22
LEAK = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("start_word", T.LongType()),
                                 T.StructField("n_words", T.LongType()), T.StructField("edits", T.LongType())]))
_GOLD = np.uint64(0x9E3779B97F4A7C15)


class SizeClass:
    """Items of ``least`` to ``most`` words: window size, stride and the walks' sampled places."""

    def __init__(self, least: int, most: int, keys: int) -> None:
        self.least, self.most = least, most
        self.window = max(1, min(2 * least // 3, WIDEST))
        self.stride = min(least - self.window + 1, self.window)
        self.walks = -(-keys // SAMPLES_PER_WALK)
        rng = np.random.default_rng([least, 17])
        self.places = [[np.sort(rng.choice(2 * self.window, min(SAMPLED, 2 * self.window), replace=False))
                        for _ in range(SAMPLES_PER_WALK)] for _ in range(self.walks)]

    def keys(self, words: np.ndarray, starts: np.ndarray, since: int = 0) -> list[np.ndarray]:
        """All keys, from walk ``since`` on, of the windows that start at ``starts`` (one array per sample)."""
        padded = np.concatenate([words, np.zeros(2 * self.window + 1, np.uint64)])
        end, out = starts + self.window, []
        for w, places in enumerate(self.places[since:], since):
            seed = np.uint64((self.least << 20 | w << 8) % (1 << 64))
            keys = [np.full(len(starts), mix64(np.array([seed + np.uint64(s)], np.uint64))[0]) for s in range(len(places))]
            used = [set(p.tolist()) for p in places]
            at, last = starts.copy(), max(max(u) for u in used)
            for j in range(last + 1):
                if j % 64 == 0:  # 64 random bits a word at a time
                    bits = mix64(padded ^ mix64(np.array([seed], np.uint64) ^ np.uint64(j + 1) * np.array([_GOLD]))[0])
                if any(j in u for u in used):
                    symbol = np.where(at < end, padded[at], np.uint64(0))
                    for k, u in zip(keys, used, strict=True):
                        if j in u:
                            k *= _GOLD
                            k ^= symbol
                            k ^= k >> np.uint64(29)
                at += (bits[at] >> np.uint64(j % 64) & np.uint64(1)).view(np.int64)
            out += [mix64(k) for k in keys]
        return out


@functools.lru_cache(maxsize=64)
def keys_needed(least: int, most: int, edit_rate: float, target: float) -> int:
    """How many keys find an occurrence with probability ``target``: measured on random items in
    random text, at the size of the class with the largest share of edits and at the smallest."""
    hardest = max(range(least, most + 1), key=lambda n: (math.floor(edit_rate * n) / n, -n))
    return max(keys_for_size(least, n, edit_rate, target) for n in {least, hardest})


def keys_for_size(least: int, size: int, edit_rate: float, target: float, trials: int = 300) -> int:
    """``keys_needed`` for items of ``size`` words in the class from ``least`` words on,
    floor(edit_rate * size) words substituted, deleted or inserted."""
    probe = SizeClass(least, size, 0)
    rng = np.random.default_rng(size)
    fresh = lambda n: rng.integers(1, 1 << 62, n, dtype=np.uint64)
    items = fresh((trials, size))
    length = size + 2 * probe.window + math.floor(edit_rate * size)
    texts = np.empty((trials, length), np.uint64)
    for item, row in zip(items, texts, strict=True):
        words = item.tolist()
        for _ in range(math.floor(edit_rate * size)):
            at, kind = int(rng.integers(0, len(words))), rng.integers(0, 3)
            words[at:at + (kind < 2)] = fresh(int(kind != 1)).tolist()  # substitute, delete, insert
        before = int(rng.integers(0, length - len(words) + 1))
        row[:] = np.concatenate([fresh(before), np.array(words, np.uint64), fresh(length - before - len(words))])
    tag = lambda key, n: mix64(key ^ np.repeat(np.arange(trials, dtype=np.uint64), n))
    inside, grid = np.arange(size - probe.window + 1), np.arange(0, length - probe.window + 1, probe.stride)
    in_items = (np.arange(trials)[:, None] * size + inside).ravel()
    in_texts = (np.arange(trials)[:, None] * length + grid).ravel()
    met = np.zeros(trials, bool)
    for walk in range(MOST_KEYS // SAMPLES_PER_WALK):
        probe = SizeClass(least, size, (walk + 1) * SAMPLES_PER_WALK)
        of_items, of_texts = (probe.keys(words.ravel(), starts, walk) for words, starts in ((items, in_items), (texts, in_texts)))
        for k, (a, b) in enumerate(zip(of_items, of_texts, strict=True), 1):
            met |= np.isin(tag(b, len(grid)), tag(a, len(inside))).reshape(trials, -1).any(1)
            if met.mean() >= target:
                return walk * SAMPLES_PER_WALK + k
    raise ValueError(f"{MOST_KEYS} keys find {met.mean():.2f} of the items of {size} words with {edit_rate} of them edited, not {target}")


class Index:
    """The windows of a block of items: sorted keys with the item and window start of each."""

    def __init__(self, items: list[tuple[list[int], np.ndarray]], edit_rate: float, target: float, min_words: int = 8) -> None:
        self.items, self.edit_rate, self.min_words, self.classes = items, edit_rate, min_words, []
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by size: sorted sequence hashes, items
        for size in sorted({len(w) for _, w in items if len(w) < min_words}):
            which = np.array([i for i, (_, w) in enumerate(items) if len(w) == size])
            hashes = np.concatenate([sequences(items[i][1], np.array([0, size]), size)[0] for i in which])
            order = np.argsort(hashes, kind="stable")
            self.short[size] = hashes[order], which[order]
        sizes = sorted({len(w) for _, w in items if len(w) >= min_words})
        keys, owners, offsets = [], [], []
        while sizes:
            least = sizes[0]
            most = max(least, math.ceil(1.5 * least) - 1)
            sizes = [s for s in sizes if s > most]
            kind = SizeClass(least, most, keys_needed(least, most, edit_rate, target))
            self.classes.append(kind)
            for i, (_, words) in enumerate(items):
                if least <= len(words) <= most:
                    starts = np.arange(len(words) - kind.window + 1)
                    for k in kind.keys(words, starts):
                        keys.append(k)
                        owners.append(np.full(len(starts), i))
                        offsets.append(starts)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.owner = np.concatenate(owners)[order] if keys else np.zeros(0, np.int64)
        self.offset = np.concatenate(offsets)[order] if keys else np.zeros(0, np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def candidates(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct (document, item, where the item would start) rows."""
        found = []
        counts = np.diff(first)
        for size, (known, owner) in self.short.items():
            hashes, begin = sequences(words, first, size)
            low, high = np.searchsorted(known, hashes, "left"), np.searchsorted(known, hashes, "right")
            hit = np.flatnonzero(high > low)
            times = (high - low)[hit]
            which = owner[np.repeat(low[hit], times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)]
            hit = np.repeat(hit, times)
            doc = np.searchsorted(begin, hit, "right") - 1
            rows = np.column_stack([doc, which, first[:-1][doc] + hit - begin[doc]])
            found.append(rows[np.unique(rows[:, :2], axis=0, return_index=True)[1]])  # equal words: the first place will do
        for kind in self.classes:
            room = counts - kind.window
            n = np.where(room >= 0, room // kind.stride + 2, 0)  # the last window ends with the document
            doc = np.repeat(np.arange(len(n)), n)
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            starts = first[:-1][doc] + np.minimum(step * kind.stride, room[doc])
            for keys in kind.keys(words, starts):
                hit = np.flatnonzero(self.filter[keys >> np.uint64(64 - FILTER_BITS)])
                low = np.searchsorted(self.keys, keys[hit], "left")
                high = np.searchsorted(self.keys, keys[hit], "right")
                times = high - low
                at = np.repeat(low, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                where = np.repeat(hit, times)
                found.append(np.column_stack([doc[where], self.owner[at], starts[where] - self.offset[at]]))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)

    def leaks(self, text: pa.Array) -> list[list[dict]]:
        words = Words(text, lower=True, space=PUNCTUATION, alone=True)
        return self.leaks_of(words, words.hashes())

    def leaks_of(self, words: Words, hashes: np.ndarray) -> list[list[dict]]:
        out = [[] for _ in range(len(words.first) - 1)]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        checked: set[tuple[int, int, int]] = set()
        for doc, item, start in self.candidates(hashes, words.first).tolist():
            target = self.items[item][1]
            allowed = math.floor(self.edit_rate * len(target)) if len(target) >= self.min_words else 0
            a, b = int(words.first[doc]), int(words.first[doc + 1])
            if best.get((doc, item), (1, 0))[0] == 0 or (doc, item, start // (allowed + 1)) in checked:
                continue
            checked.add((doc, item, start // (allowed + 1)))
            # a window found after edits is off by ``allowed`` at most, and so is its twin in ``checked``
            low, high = max(a, start - 2 * allowed - 1), min(b, start + len(target) + 2 * allowed + 1)
            if np.isin(target, hashes[low:high]).sum() < len(target) - allowed:  # every missing word is an edit
                continue
            edits, end = semi_global(target, hashes[low:high])
            if edits <= allowed and edits < best.get((doc, item), (allowed + 1, 0))[0]:
                best[doc, item] = (edits, low + end - len(target) - a)
        for (doc, item), (edits, start) in sorted(best.items()):
            ids, target = self.items[item]
            out[doc] += [{"item_id": i, "start_word": max(0, start), "n_words": len(target), "edits": edits} for i in ids]
        return out


def sequences(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words and their ``first`` offsets by document."""
    if size <= 64:
        return windows(words, first, size)
    hashes, begin = windows(words, first, 64)
    for step in range(1, size - 63):  # a run is a shorter run and one word more
        n = np.maximum(np.diff(first) - 63 - step, 0)
        out = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        at = np.arange(int(out[-1])) - np.repeat(out[:-1], n)
        hashes = mix64(hashes[np.repeat(begin[:-1], n) + at] ^ words[np.repeat(first[:-1], n) + at + 63 + step])
        begin = out
    return hashes, begin


def semi_global(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Least edits that turn some run of ``region`` into the whole ``item``, and where that run ends."""
    width = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)  # a run may begin anywhere
    for i, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (region != word))
        row = np.minimum.accumulate(new - width) + width  # insertions along the row
    end = int(row.argmin())
    return int(row[end]), end


def item_blocks(benchmark: DataFrame, min_words: int, edit_rate: float, target: float):
    """Indexes of ``benchmark`` (item_id, text) in blocks; items of one text are one entry, and
    null texts and items without a word are no evidence of a leak."""
    blocks = max(1, math.ceil(benchmark.count() / ITEM_BLOCK))
    rows = benchmark.where("text IS NOT NULL").select(
        F.col("item_id").cast("long").alias("item_id"), "text", F.pmod(F.xxhash64("text"), F.lit(blocks)).alias("block"))
    for b in range(blocks):
        got = rows.where(F.col("block") == b).groupBy("text").agg(F.collect_list("item_id").alias("ids")).collect()
        got = sorted((r["text"], sorted(r["ids"])) for r in got)
        words = Words(pa.array([t for t, _ in got], pa.string()), lower=True, space=PUNCTUATION, alone=True)
        hashes = words.hashes()
        yield Index([(ids, hashes[words.first[i]:words.first[i + 1]]) for i, (_, ids) in enumerate(got)
                     if words.counts[i]], edit_rate, target, min_words)


def find_leaks(docs: DataFrame, benchmark: DataFrame, edit_rate: float = 0.15, target: float = 0.9,
               min_words: int = 8, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus ``leaks``: the items found in each whole text, with word position and edits.

    An item is reported once a document, at its fewest edits.  Null and empty texts, an empty
    benchmark: empty lists.  Rows stay rows (repeated ones too); ``drop`` names columns left out; a
    column named ``leaks`` is replaced, any other name may occur.
    """
    context = docs.sparkSession.sparkContext
    blocks = [context.broadcast(index) for index in item_blocks(benchmark, min_words, edit_rate, target) if index.items]

    def search(text: pa.Array) -> list:
        words = Words(text, lower=True, space=PUNCTUATION, alone=True)
        hashes, out = words.hashes(), [[] for _ in range(len(text))]
        for block in blocks:
            index = block.value if len(blocks) == 1 else read_again(block)
            for all_leaks, more in zip(out, index.leaks_of(words, hashes), strict=True):
                all_leaks += more
        return [out]

    found = extended(docs, ["text"], [("leaks", LEAK)], search, drop)
    return found.select(*[c for c in found.columns if c != "leaks"], "leaks")


def read_again(shared: Broadcast) -> Index:
    """The value of a broadcast, which the worker does not keep: ``value`` would hold every block for good."""
    path = getattr(shared, "_path", None)  # none where Spark encrypts the file
    return shared.load_from_path(path) if path else shared.value


def leak_pairs(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, start_word, n_words, edits."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, **options)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
