"""Operator 1: license scan.  MinHash bands over overlapping text windows retrieve templates;
exact shingle containment verifies them.

Words are runs of letters and digits, lower-cased (A-Z); shingles are ``k`` words.  A template is
found in a document if at least ``percent`` % of its distinct shingles occur in the document.

Windows come in sizes of 1, 2, 4, ... shingles; a template uses the largest that fits into it and
all its windows of that size are indexed, so a document window that lies within an occurrence meets
a template window of its own size.  Bands of ``ROWS`` min-hashes each are made as many as bring windows of
Jaccard similarity ``sure_similarity`` together with probability ``sure`` (``band_count``).  Retrieved
templates are counted exactly against the whole document, so bands decide recall, never precision.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.llm.common import extended
from starling.llm.license_texts import LICENSES
from starling.llm.words import PUNCTUATION, Words, mix64, windows

ROWS, LARGEST_WINDOW, FILTER_BITS = 2, 32, 20
MATCH = T.ArrayType(T.StructType([
    T.StructField("template_id", T.LongType()), T.StructField("license", T.StringType()),
    T.StructField("n_matched", T.LongType()), T.StructField("n_template", T.LongType())]))


def band_count(sure_similarity: float, sure: float, rows: int = ROWS) -> int:
    """Bands so that 1 - (1 - s^rows)^bands >= sure at similarity s."""
    return math.ceil(math.log(1 - sure) / math.log(1 - sure_similarity**rows))


@dataclass
class Template:
    id: int
    license: str
    shingles: np.ndarray  # sorted, distinct


class Templates:
    """The index of a stated, small set of templates (a few thousand numbers each)."""

    def __init__(self, texts: list[tuple[str, str]], k: int = 5, percent: int = 75,
                 sure_similarity: float = 0.6, sure: float = 0.99) -> None:
        self.k, self.percent, self.bands = k, percent, band_count(sure_similarity, sure)
        self.salts = mix64(np.arange(1, self.bands * ROWS + 1, dtype=np.uint64))
        words = Words(pa.array([t for _, t in texts], pa.string()), lower=True, space=PUNCTUATION)
        shingles, first = windows(words.hashes(), words.first, k, whole_short=True)
        self.templates, by_size = [], {}
        for i, (license, _) in enumerate(texts):
            own = shingles[first[i]:first[i + 1]]
            if not len(own):
                continue  # a template without words matches nothing
            self.templates.append(Template(i, license, np.unique(own)))
            size = 1
            while 2 * size <= min(LARGEST_WINDOW, max(1, 4 * len(own) // 5)):
                size *= 2
            by_size.setdefault(size, []).append((len(self.templates) - 1, own))
        self.sizes, keys, owners = sorted(by_size), [], []
        for size, members in by_size.items():
            joined = np.concatenate([own for _, own in members])
            begin = np.concatenate([[0], np.cumsum([len(own) for _, own in members])])
            for _, at, found in self._keys(joined, begin, [size], stride_of=lambda s: 1):
                owner = np.array([m for m, _ in members])[np.searchsorted(begin, at, "right") - 1]
                keys.append(found)
                owners.append(owner)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.owner = np.concatenate(owners)[order] if keys else np.zeros(0, np.int64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def _keys(self, shingles: np.ndarray, first: np.ndarray, sizes: list[int], stride_of):
        """(size, window starts, keys) for every band: windows never leave their document."""
        starts = {}
        counts = np.diff(first)
        for size in sizes:
            stride, room = stride_of(size), counts - size
            n = np.where(room >= 0, -(-room // stride) + 1, 0)  # the last window ends with the document
            doc = np.repeat(np.arange(len(n)), n)
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            starts[size] = first[:-1][doc] + np.minimum(step * stride, room[doc])
        for band in range(self.bands):
            parts = {s: np.full(len(starts[s]), np.uint64(band * 64 + s)) for s in sizes}
            for salt in self.salts[band * ROWS:(band + 1) * ROWS]:
                low, width = mix64(shingles ^ salt), 1
                while True:
                    if width in parts:
                        parts[width] = mix64(parts[width] ^ low[starts[width]])
                    if 2 * width > max(sizes) or len(low) <= width:
                        break
                    low = np.minimum(low[:-width], low[width:])  # least of twice as many shingles
                    width *= 2
            for size, key in parts.items():
                yield size, starts[size], key

    def matches(self, text: pa.Array) -> list[list[dict]]:
        words = Words(text, lower=True, space=PUNCTUATION)
        shingles, first = windows(words.hashes(), words.first, self.k, whole_short=True)
        pairs = []
        if len(shingles) and self.sizes:
            for _, starts, keys in self._keys(shingles, first, self.sizes, stride_of=lambda s: max(1, s // 4)):
                hit = np.flatnonzero(self.filter[keys >> np.uint64(64 - FILTER_BITS)])
                low = np.searchsorted(self.keys, keys[hit], "left")
                times = np.searchsorted(self.keys, keys[hit], "right") - low
                at = np.repeat(low, times) + np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                doc = np.searchsorted(first, starts[hit], "right") - 1
                pairs.append(np.column_stack([np.repeat(doc, times), self.owner[at]]))
        out: list[list[dict]] = [[] for _ in range(len(text))]
        for d, i in (np.unique(np.concatenate(pairs), axis=0).tolist() if pairs else []):
            t = self.templates[i]
            n = int(np.isin(t.shingles, shingles[first[d]:first[d + 1]]).sum())
            if 100 * n >= self.percent * len(t.shingles):
                out[d].append({"template_id": t.id, "license": t.license, "n_matched": n, "n_template": len(t.shingles)})
        return out


def scan(docs: DataFrame, templates: Templates | None = None, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` plus ``licenses``: the templates found in each whole text.

    One pass, no shuffle.  Null and empty texts, no templates: empty lists.  Repeated rows are scanned like
    any other; the other columns pass through, but for those of ``drop``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(templates or Templates(LICENSES))
    return extended(docs, ["text"], [("licenses", MATCH)], lambda text: [shared.value.matches(text)], drop)


def license_matches(docs: DataFrame, templates: Templates | None = None) -> DataFrame:
    """One row per document and template found: doc_id, template_id, license, n_matched, n_template."""
    found = scan(docs.select("doc_id", "text"), templates, drop=("text",))
    return found.select("doc_id", F.explode("licenses").alias("m")).select("doc_id", "m.*")


def oracle_sql(k: int = 5, percent: int = 75) -> str:
    """DuckDB SQL of ``license_matches`` over ``documents`` with the default templates."""
    rows = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(LICENSES))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    shingles = f"""SELECT id, unnest(CASE WHEN len(w) >= {k} THEN
        list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s"""
    words = f"regexp_extract_all(translate(text, '{upper}', '{lower}'), '[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+')"
    return f"""
WITH templates(id, license, text) AS (VALUES {rows}),
t AS (SELECT DISTINCT id, s FROM ({shingles} FROM (SELECT id, {words} AS w FROM templates))),
d AS (SELECT DISTINCT id, s FROM ({shingles} FROM (SELECT doc_id AS id, {words} AS w FROM documents))),
n AS (SELECT id, count(*) AS n_template FROM t GROUP BY id)
SELECT d.id AS doc_id, t.id::BIGINT AS template_id, any_value(license) AS license, count(*)::BIGINT AS n_matched,
  any_value(n_template)::BIGINT AS n_template
FROM d JOIN t USING (s) JOIN n ON n.id = t.id JOIN templates ON templates.id = t.id
GROUP BY d.id, t.id HAVING 100 * count(*) >= {percent} * any_value(n_template)
"""
