"""Operator 5: quality rules by labelling lines with a linear-chain conditional random field.

Every line with a word is content or boilerplate.  A two-state CRF scores a line by features
of its shape and neighbouring lines by a transition matrix; Viterbi decoding picks the best
label sequence of each document, and the share of its words in content lines decides whether
it is kept.  The CRF is trained here (maximum likelihood, forward-backward in numpy) on the
lines of at most ``max_docs`` labelled documents: lines of good documents as content, of bad
ones as boilerplate.  Documents have one label throughout, pages do not; so besides the documents
themselves it learns from spliced ones, in which runs of lines of a good and a bad document take
turns, and the transition weights come from chains that change label.  Scoring is one pass over
whole texts without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starling.llm.common import extended, labelled_sample, text_slices
from starling.llm.words import Words, byte_class, class_counts, distinct_sorted, span_hashes, windows

SYMBOLS, PIPE, BANG, DIGITS = byte_class("#*$%&|<>"), byte_class("|"), byte_class("!"), byte_class("0123456789")
UPPER, LETTERS = byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), byte_class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
END_MARKS = byte_class(".!?:;\"')")
CHARACTER_START = np.ones(256, bool)
CHARACTER_START[0x80:0xC0] = False  # UTF-8 continuation bytes
N_FEATURES = 20
BOILERPLATE, CONTENT = 0, 1


class Lines:
    """Lines with a word of a slice of texts: ``first[d]:first[d + 1]`` are those of document d."""

    def __init__(self, words: Words) -> None:
        data, offsets = words.data, words.offsets
        breaks = np.flatnonzero(data == 0x0A)
        starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
        ends = np.sort(np.concatenate([offsets[1:], breaks]))
        word_at = np.searchsorted(words.starts, np.concatenate([starts, ends]))
        n = word_at[len(starts):] - word_at[:len(starts)]
        keep = n > 0
        self.starts, self.ends, self.n_words = starts[keep], ends[keep], n[keep]
        self.first_word = word_at[:len(starts)][keep]
        self.first = np.searchsorted(self.starts, offsets)
        self.first[-1] = len(self.starts)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))


def line_features(words: Words, lines: Lines, hashes: np.ndarray) -> np.ndarray:
    """0/1 features of every line (rows)."""
    n = np.maximum(lines.n_words, 1)
    count = lambda flags: class_counts(words.data, flags, lines.starts, lines.ends)
    symbols, letters = count(SYMBOLS) / n, np.maximum(count(LETTERS), 1)
    size = lines.ends - lines.starts
    text_hash = span_hashes(words.data, lines.starts, lines.ends)
    order = np.lexsort((np.arange(len(text_hash)), text_hash, lines.doc))
    again = np.zeros(len(order), bool)
    if len(order):
        same = (text_hash[order][1:] == text_hash[order][:-1]) & (lines.doc[order][1:] == lines.doc[order][:-1])
        again[order[1:]] = same
    kinds = np.diff(distinct_sorted(hashes, np.concatenate([lines.first_word, [len(hashes)]]))[1]) / n
    last = words.ends[lines.first_word + lines.n_words - 1] - 1 if len(n) else np.zeros(0, int)
    mean = size / n
    return np.column_stack([
        np.ones(len(n)), lines.n_words <= 2, (lines.n_words > 2) & (lines.n_words <= 5),
        (lines.n_words > 5) & (lines.n_words <= 15), lines.n_words > 60,
        symbols > 0.05, symbols > 0.3, symbols > 0.8, count(PIPE) / n > 0.2, count(BANG) / n > 0.2,
        count(UPPER) / letters > 0.3, count(UPPER) / letters > 0.7, count(DIGITS) / np.maximum(size, 1) > 0.2,
        again, kinds < 0.5, kinds < 0.15, END_MARKS[words.data[last]], mean > 14, mean < 3.5,
        UPPER[words.data[words.starts[lines.first_word]]] if len(n) else np.zeros(0)]).astype(np.float32)


class Crf:
    """Weights of the two-state chain: emission (features x 2), transition (2 x 2), start (2)."""

    def __init__(self) -> None:
        self.emit, self.move, self.start = np.zeros((N_FEATURES, 2)), np.zeros((2, 2)), np.zeros(2)
        self.trained = False

    def viterbi(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Best label of every line; all documents advance one line a step."""
        score = features @ self.emit
        n = np.diff(first)
        docs = np.argsort(-n, kind="stable")
        longest = int(n.max()) if len(n) else 0
        back = np.zeros((len(score), 2), np.int8)
        labels = np.zeros(len(score), np.int8)
        best = np.zeros((len(n), 2))
        active_at = np.searchsorted(-n[docs], -np.arange(1, longest + 1), "right")  # documents with over t lines
        for t in range(longest):
            d = docs[:active_at[t]]
            at = first[d] + t
            if t == 0:
                best[d] = self.start + score[at]
                continue
            options = best[d][:, :, None] + self.move
            back[at] = options.argmax(1)
            best[d] = options.max(1) + score[at]
        state = best.argmax(1)
        for t in range(longest - 1, -1, -1):
            d = docs[:active_at[t]]
            at = first[d] + t
            ending = n[d] == t + 1
            state[d] = np.where(ending, best[d].argmax(1), state[d])
            labels[at] = state[d]
            state[d] = back[at, state[d]]
        return labels

    def fit(self, features: np.ndarray, first: np.ndarray, labels: np.ndarray, steps: int = 150,
            rate: float = 0.1, l2: float = 1e-3) -> Crf:
        """Maximum likelihood by forward-backward and Adam; all sequences with over t lines advance to line t together."""
        n = np.diff(first)
        rows = np.flatnonzero(n)
        if not len(rows) or len(np.unique(labels)) < 2:
            return self
        rows = rows[np.argsort(-n[rows], kind="stable")]
        n, begin = n[rows], first[:-1][rows]
        steps_at = np.arange(n.max())
        mask = steps_at[None, :] < n[:, None]
        active = np.searchsorted(-n, -steps_at)  # sequences with over t lines, the first ones
        at = np.where(mask, begin[:, None] + steps_at, 0)
        y, total = labels[at], len(features)
        seen_emit = features.T @ np.eye(2)[labels]
        seen_start = np.bincount(y[:, 0], minlength=2).astype(float)
        pairs = mask[:, 1:]
        seen_move = np.zeros((2, 2))
        np.add.at(seen_move, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
        params = [self.emit, self.move, self.start]
        m = [np.zeros_like(p) for p in params]
        v = [np.zeros_like(p) for p in params]
        for step in range(1, steps + 1):
            score = (features @ self.emit)[at]
            ahead = np.zeros_like(score)
            ahead[:, 0] = self.start + score[:, 0]
            for t in range(1, score.shape[1]):
                k = active[t]
                ahead[:k, t] = np.logaddexp.reduce(ahead[:k, t - 1, :, None] + self.move, axis=1) + score[:k, t]
            log_z = np.logaddexp.reduce(ahead[np.arange(len(n)), n - 1], axis=1)
            behind = np.zeros_like(score)
            for t in range(score.shape[1] - 2, -1, -1):
                k = active[t + 1]
                behind[:k, t] = np.logaddexp.reduce(self.move + (score[:k, t + 1] + behind[:k, t + 1])[:, None, :], axis=2)
            node = np.exp(np.where(mask[:, :, None], ahead + behind - log_z[:, None, None], -np.inf))
            edge = np.exp(np.where(pairs[:, :, None, None], ahead[:, :-1, :, None] + self.move
                                   + (score + behind)[:, 1:, None, :] - log_z[:, None, None, None], -np.inf))
            flat = np.zeros((total, 2))
            flat[at[mask]] = node[mask]
            grads = [(features.T @ flat - seen_emit) / total + l2 * self.emit,
                     (edge.sum((0, 1)) - seen_move) / total + l2 * self.move,
                     (node[:, 0].sum(0) - seen_start) / total + l2 * self.start]
            for i, (p, g) in enumerate(zip(params, grads, strict=True)):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.trained = True
        return self


def base_statistics(words: Words, lines: Lines, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """Exact per-document counts of the base rule (no approximation, whole texts)."""
    begin, end, n = words.offsets[:-1], words.offsets[1:], len(words.offsets) - 1
    ink = CHARACTER_START & ~(byte_class(" \t\n\v\f\r"))
    text_hash = span_hashes(words.data, lines.starts, lines.ends)
    line_kinds = np.diff(distinct_sorted(text_hash, lines.first)[1])
    grams, gram_first = windows(hashes, words.first, 5)
    doc = np.repeat(np.arange(n), np.diff(gram_first))
    order = np.lexsort((grams, doc))
    g, d = grams[order], doc[order]
    twice = np.zeros(len(g), bool)
    if len(g) > 1:
        same = (g[1:] == g[:-1]) & (d[1:] == d[:-1])
        twice[1:] |= same
        twice[:-1] |= same
    at = order[twice]  # windows found twice or more; their words:
    word = words.first[:-1][doc[at]] + at - gram_first[:-1][doc[at]]
    edge = np.zeros(len(hashes) + 6, np.int32)
    np.add.at(edge, word, 1)
    np.add.at(edge, word + 5, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[:len(hashes)] > 0)])
    return {"n_words": words.counts, "word_chars": class_counts(words.data, ink, begin, end),
            "n_symbols": class_counts(words.data, SYMBOLS, begin, end),
            "n_dup_lines": np.diff(lines.first) - line_kinds,
            "n_repeat_words": covered[words.first[1:]] - covered[words.first[:-1]]}


NEW = [(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    ("base_failed", T.BooleanType()), ("content_share", T.DoubleType()), ("kept", T.BooleanType())]


def spliced(good: list[np.ndarray], bad: list[np.ndarray], seed: int = 1, longest_run: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, labels) of chains made from one good and one bad document each: runs of 1 to
    ``longest_run`` of their lines take turns until both are used up.  The shorter list is gone through again
    and again, so that every document is in a chain."""
    rng, out = np.random.default_rng(seed), []
    if not good or not bad:
        return out
    for i in range(max(len(good), len(bad))):
        left = {CONTENT: good[i % len(good)], BOILERPLATE: bad[i % len(bad)]}
        turn = int(rng.integers(2))
        parts, labels = [], []
        while any(len(lines) for lines in left.values()):
            n = min(int(rng.integers(1, longest_run + 1)), len(left[turn]))
            parts.append(left[turn][:n])
            labels += [turn] * n
            left[turn] = left[turn][n:]
            turn = 1 - turn
        out.append((np.concatenate(parts), np.array(labels)))
    return out


def fit_lines(docs: DataFrame, labels: DataFrame, max_docs: int = 1500) -> Crf:
    """A CRF from at most ``max_docs`` labelled documents (labels: doc_id, quality 0/1), one for each id.
    Long documents train as runs of 50 lines.  Without labels of both kinds it stays untrained."""
    rows = labelled_sample(docs.where("text IS NOT NULL"), labels, max_docs, ["text"])

    def run(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                part = batch.slice(a, b - a)
                words = Words(part.column(0))
                lines = Lines(words)
                features = line_features(words, lines, words.hashes())
                quality = np.array(part.column(1))
                out = [(features[x:y].astype(np.uint8).tobytes(), int(quality[d]))
                       for d, (x, y) in enumerate(zip(lines.first[:-1], lines.first[1:], strict=True)) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()),
                                                  pa.array([r[1] for r in out], pa.int32())], ["features", "quality"])

    got = rows.mapInArrow(run, "features binary, quality int").collect()
    chunks: dict[int, list[np.ndarray]] = {CONTENT: [], BOILERPLATE: []}
    for raw, quality in sorted((bytes(r["features"]), r["quality"]) for r in got):
        features = np.frombuffer(raw, np.uint8).reshape(-1, N_FEATURES)
        chunks[CONTENT if quality == 1 else BOILERPLATE] += [features[i:i + 50] for i in range(0, len(features), 50)]
    chains = [(c, np.full(len(c), label)) for label, whole in chunks.items() for c in whole]
    chains += spliced(chunks[CONTENT], chunks[BOILERPLATE])
    if not chains:
        return Crf()
    first = np.concatenate([[0], np.cumsum([len(c) for c, _ in chains])])
    return Crf().fit(np.concatenate([c for c, _ in chains]).astype(np.float32), first, np.concatenate([y for _, y in chains]))


def label_documents(docs: DataFrame, crf: Crf, min_content: float = 0.5, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus the base counts, base_failed, content_share (of words) and kept.

    Null and empty texts have no words and fail the base rule.  Other columns pass through
    but for those of ``drop``; clashing names are replaced.  An untrained CRF calls every line content.
    """
    def score(text: pa.Array) -> list:
        words = Words(text)
        lines, hashes = Lines(words), words.hashes()
        base = base_statistics(words, lines, hashes)
        labels = crf.viterbi(line_features(words, lines, hashes), lines.first) if crf.trained else np.ones(len(lines.doc), np.int8)
        content = np.bincount(lines.doc, lines.n_words * (labels == CONTENT), len(text))
        share = content / np.maximum(base["n_words"], 1)
        failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
        return [*base.values(), failed, share, ~failed & (share >= min_content)]

    return extended(docs, ["text"], NEW, score, drop)
