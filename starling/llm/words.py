"""Vectorised words of Arrow text: byte positions and 64-bit hashes without a Python loop
over words.

A word is a run of bytes other than space and 0x09-0x0D (``[^\\x20\\x09-\\x0D]+``); in UTF-8
these never cut a character.  Null text has no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# white space, control characters and ASCII punctuation: words are then letters and digits only
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
# scripts without spaces, by the first two bytes of a character: Thai, Lao, Tibetan, Myanmar, Khmer,
# kana, bopomofo, Chinese characters (three bytes; four on the supplementary planes)
ALONE = np.zeros(1 << 16, bool)
for _low, _high in [(0xE0B8, 0xE0BF), (0xE180, 0xE182), (0xE19E, 0xE19F), (0xE380, 0xE386), (0xE390, 0xE3BF),
                    (0xE480, 0xE9BF), (0xEFA4, 0xEFAB), (0xEFBD, 0xEFBE), (0xF0A0, 0xF0B3)]:
    ALONE[[_b << 8 | _c for _b in range(_low >> 8, (_high >> 8) + 1)
           for _c in range(_low & 255 if _b == _low >> 8 else 0x80, (_high & 255 if _b == _high >> 8 else 0xBF) + 1)]] = True
_MARKS = [*range(0x3000, 0x3005), *range(0x3008, 0x3021), 0x3030, 0x30FB, *range(0xFF01, 0xFF10), *range(0xFF1A, 0xFF21),
          *range(0xFF3B, 0xFF41), *range(0xFF5B, 0xFF66)]
MARKS = np.array([int.from_bytes(chr(c).encode()) for c in _MARKS])  # punctuation of these scripts
_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)

# odd multipliers of a word's place in a window
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 3, 1 << 64) for k in range(64)], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scrambler (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of a slice of texts: ``starts``/``ends`` are byte offsets into ``data``;
    document ``d`` holds words ``first[d]`` to ``first[d + 1]``.  ``alone``: in scripts without
    spaces every character is a word and their punctuation parts words."""

    __slots__ = ("data", "offsets", "starts", "ends", "first")

    def __init__(self, text: pa.Array, lower: bool = False, space: np.ndarray = SPACE,
                 alone: bool = False) -> None:
        text = pc.fill_null(text.cast(pa.large_string()), "")
        if len(text) == 0:
            self.data, self.offsets = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        else:
            offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            body = text.buffers()[2]
            data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
            self.data = data[offsets[0]:offsets[-1]]
            self.offsets = offsets - offsets[0]
        if lower:
            self.data = LOWER[self.data]
        ink = np.empty(len(self.data) + 1, bool)
        ink[:-1] = ~space[self.data]
        ink[-1] = False
        cuts = np.zeros(len(ink), bool)
        cuts[self.offsets] = True  # a text ends where the next one begins
        if alone:
            self._part_characters(ink, cuts)
        before = np.empty_like(ink)
        before[0], before[1:] = False, ink[:-1]
        self.starts = np.flatnonzero(ink & (cuts | ~before))
        self.ends = np.flatnonzero(before & (cuts | ~ink))
        self.first = np.searchsorted(self.starts, self.offsets)

    def _part_characters(self, ink: np.ndarray, cuts: np.ndarray) -> None:
        lead = np.flatnonzero(self.data >= 0xE0)
        wide = self.data.astype(np.int64) if len(lead) else self.data
        two = wide[lead] << 8 | wide[lead + 1] if len(lead) else lead
        one = ALONE[two]
        cuts[lead[one]] = True
        cuts[lead[one] + np.where(two[one] >= 0xF000, 4, 3)] = True
        near = lead[(two == 0xE380) | (two == 0xE383) | (two == 0xEFBC) | (two == 0xEFBD)]
        mark = near[np.isin(wide[near] << 16 | wide[near + 1] << 8 | wide[near + 2], MARKS)] if len(near) else near
        for k in range(3):
            ink[mark + k] = False

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span (eight bytes a step, all spans at once)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    size = ends - starts
    out = size.astype(np.uint64) * _GOLD
    todo, at = np.flatnonzero(size), 0
    while len(todo):
        piece = eight[starts[todo] + at] & _TAIL[np.minimum(size[todo] - at, 8)]
        out[todo] = mix64(out[todo] ^ piece) * _GOLD
        at += 8
        todo = todo[size[todo] > at]
    return mix64(out)


def class_counts(data: np.ndarray, wanted: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many bytes of each span belong to a class (``wanted``: 256 flags)."""
    total = np.concatenate([[0], np.cumsum(wanted[data], dtype=np.int64)])
    return total[ends] - total[starts]


def byte_class(chars: str) -> np.ndarray:
    """256 flags of the ASCII characters of ``chars``."""
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


def windows(h: np.ndarray, first: np.ndarray, k: int, whole_short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows and the windows' own ``first`` offsets by document.
    ``whole_short``: a document of 1 to k-1 words has its whole sequence as one window.  ``k`` is at most 64."""
    counts = np.diff(first)
    n = np.maximum(counts - k + 1, 0)
    if whole_short:
        n = np.where((counts > 0) & (counts < k), 1, n)
    out_first = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    total = int(out_first[-1])
    doc = np.repeat(np.arange(len(n)), n)
    at = first[:-1][doc] + np.arange(total) - out_first[:-1][doc]
    used = np.minimum(counts, k)[doc]
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    acc = used.astype(np.uint64) * _GOLD
    short = bool(np.any(used < k))
    for j in range(k):
        term = padded[at + j] * _FACTORS[j]
        if short:
            term[used <= j] = 0
        acc = acc + term
    return mix64(acc), out_first


def distinct_sorted(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every document, with new ``first`` offsets."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    v, d = v[keep], d[keep]
    return v, np.searchsorted(d, np.arange(len(first)))
