import random

import numpy as np
import pyarrow as pa

from starling.llm.words import PUNCTUATION, Words, distinct_sorted, windows
from tests.llm.helpers import EDGE_ROWS, lower_ascii, words_of


def _texts():
    rng = random.Random(5)
    letters = "abcXYZéß漢 \t\n\x0b\x0c\r\x1c\xa0.,-"
    return [t for _, t in EDGE_ROWS] + ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 90))) for _ in range(400)]


def test_words_are_the_regex_runs():
    texts = _texts()
    w = Words(pa.array(texts, pa.string()))
    for d, text in enumerate(texts):
        got = [w.data[w.starts[i]:w.ends[i]].tobytes().decode() for i in range(w.first[d], w.first[d + 1])]
        assert got == words_of(text)


def test_hashes_follow_words_and_case():
    texts = _texts()
    h = Words(pa.array(texts, pa.string()), lower=True).hashes()
    seen = {}
    for word, value in zip([x for t in texts for x in words_of(lower_ascii(t))], h.tolist(), strict=True):
        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_sliced_arrays_and_other_separators():
    texts = pa.array(["x y", "Don't-stop, it's 3.5", None, "a b c"])
    w = Words(texts.slice(1, 2), lower=True, space=PUNCTUATION)
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)] == ["don", "t", "stop", "it", "s", "3", "5"]
    assert w.first.tolist() == [0, 7, 7]


def test_characters_of_scripts_without_spaces_stand_alone():
    texts = pa.array(["ab水の、x9。é漢", "ไทย 𠀀𠀁 한국 don’t", "水"])
    w = Words(texts, lower=True, space=PUNCTUATION, alone=True)
    got = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
    assert got == ["ab", "水", "の", "x9", "é", "漢", "ไ", "ท", "ย", "𠀀", "𠀁", "한국", "don’t", "水"]
    assert w.first.tolist() == [0, 6, 13, 14]


def test_windows_and_distinct_sets():
    texts = ["a b c d e a b c d e", "a b", "", "x", "a b c d e"]
    w = Words(pa.array(texts))
    values, first = windows(w.hashes(), w.first, 5, whole_short=True)
    assert np.diff(first).tolist() == [6, 1, 0, 1, 1]
    sets, cuts = distinct_sorted(values, first)
    assert np.diff(cuts).tolist() == [5, 1, 0, 1, 1]
    assert values[first[0]] == values[first[4]]
    bare, first = windows(w.hashes(), w.first, 5)
    assert np.diff(first).tolist() == [6, 0, 0, 0, 1]


def test_texts_travel_in_small_batches(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from starling.llm.common import _ARROW_BYTES, BATCH_BYTES, extended
    docs = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))  # 30 MB in one task

    def batch_bytes(text):  # slices share the batch's buffer
        return [[text.buffers()[2].size] * len(text)]

    try:
        for bound, most in ((None, 2 * BATCH_BYTES), ("1000000", 2_000_000)):  # a bound of the user's own holds
            spark.conf.unset(_ARROW_BYTES)
            if bound:
                spark.conf.set(_ARROW_BYTES, bound)
            rows = extended(docs, ["text"], [("size", T.LongType())], batch_bytes, drop=("text",))
            assert rows.agg(F.count("size"), F.max("size") <= most).first() == (3000, True)
    finally:
        spark.conf.unset(_ARROW_BYTES)
