import random
from collections import defaultdict

import pytest

from starling.llm.components import components
from starling.llm.jaccard_groups import jaccard_components
from tests.llm.helpers import EDGE_ROWS, documents, invented, lower_ascii, words_of


def shingles(text, k=5):
    w = words_of(lower_ascii(text))
    return frozenset([tuple(w)] if 0 < len(w) < k else zip(*[w[i:] for i in range(k)]))


def brute(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min((x for x in (least.get(find(i)), d) if x is not None), default=None)
    return sorted((repr(d), len(sets[i]), repr(least[find(i)] if sets[i] else d)) for i, (d, _) in enumerate(rows))


def mutated(rng, text, rate):
    return " ".join(f"zz{rng.randrange(10**6)}" if rng.random() < rate else w for w in text.split(" "))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [(i, invented(rng, rng.randrange(5, 150))) for i in range(60)]
    for i in range(100, 170):  # near copies on both sides of the threshold
        out.append((i, mutated(rng, rng.choice(out[:60])[1], rng.choice([0.01, 0.03, 0.05]))))
    hot = invented(rng, 90, "hot")
    out += [(200 + i, mutated(rng, hot, 0.015)) for i in range(300)]  # more than a block holds
    out += [(600 + i, hot) for i in range(20)]
    passage = " ".join(f"common{i}" for i in range(50))
    out += [(700 + i, invented(rng, rng.randrange(2, 60), f"p{i}x") + " " + passage) for i in range(60)]
    return out + EDGE_ROWS


def test_same_components_as_brute_force(spark, rows):
    got = jaccard_components(documents(spark, rows).repartition(5))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((repr(r[0]), r[1], repr(r[2])) for r in got.collect()) == brute(rows)


def test_empty_table(spark):
    assert jaccard_components(documents(spark, [])).collect() == []


def test_components_of_paths_stars_and_loose_nodes(spark):
    rng = random.Random(2)
    path = list(range(40))
    rng.shuffle(path)
    edges = list(zip(path, path[1:], strict=False)) + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    nodes = spark.createDataFrame([(i,) for i in [*range(40), *range(100, 130), 999]], "v long")
    got = dict(map(tuple, components(nodes, spark.createDataFrame(edges, "a long, b long"), "v", "c").collect()))
    want = defaultdict(int, {i: 0 for i in range(40)} | {i: 100 for i in range(100, 130)} | {999: 999})
    assert got == dict(want)


def test_sketch_bits_never_exceed_the_differing_tokens():
    import numpy as np
    from starling.llm.jaccard_groups import differing_bits, sketches
    rng = np.random.default_rng(8)
    for n in (1, 5, 900, 3000, 5000, 9000):
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: max(1, 9 * n // 10)], rng.integers(0, 1 << 62, n // 4, dtype=np.uint64)]))
        c = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        raw = sketches(np.concatenate([a, b, c]), np.cumsum([0, len(a), len(b), len(c)]))
        x, y, z = (np.frombuffer(r, np.uint64)[None] for r in raw)
        apart = lambda p, q: len(np.setxor1d(p, q))
        assert differing_bits(x, y)[0, 0] <= apart(a, b) and differing_bits(x, z)[0, 0] <= apart(a, c)
        assert differing_bits(x, x)[0, 0] == 0
        if n >= 900:  # unlike sets are told apart: over the bound of a link at 75 %
            assert 7 * differing_bits(x, z)[0, 0] > len(a) + len(c)


def test_repeated_values_and_sketches_do_not_depend_on_the_cut(monkeypatch):
    import numpy as np
    from starling.llm import jaccard_groups as j
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 50, n, dtype=np.uint64) for n in (0, 3, 200, 400)]
    values, counts = np.unique(np.concatenate(parts), return_counts=True)
    for times in (1, 2, 12, 16, 700):
        held = list(parts)
        got = j.repeated(held, times)
        assert not held
        assert got[0].tolist() == values[counts >= times].tolist() and got[1].tolist() == counts[counts >= times].tolist()
    assert [len(x) for x in j.repeated([], 1)] == [0, 0]
    first = np.cumsum([0, 0, 5, 3000, 1, 0, 1500])
    sets = rng.integers(0, 1 << 62, first[-1], dtype=np.uint64)
    whole = j.sketches(sets, first)
    monkeypatch.setattr(j, "SKETCHED_BITS", 2048)
    assert j.sketches(sets, first) == whole and [8 * len(x) for x in whole] == [1024, 1024, 4096, 1024, 1024, 2048]
    assert j.sketches(sets[:0], np.zeros(1, int)) == []


def test_texts_that_share_one_phrase_are_no_candidates(spark, monkeypatch):
    """A chance meeting in a token or two costs no seat, whichever task holds copies; linked texts keep theirs."""
    from starling.llm import jaccard_groups as j
    rng = random.Random(9)
    phrases = [" ".join(f"q{i}w{x}" for x in range(5)) for i in range(20)]
    rows = [(i, invented(rng, 40, f"a{i}x") + " " + phrases[i % 20]) for i in range(80)]
    rows += [(1000 + i, t) for i, t in rows[:10]]  # copies, in other partitions
    seats, original = [], j.cross_seats

    def counted(*args):
        found = original(*args)
        seats.append(found.count())
        return found

    monkeypatch.setattr(j, "cross_seats", counted)
    got = jaccard_components(documents(spark, rows).repartition(5)).collect()
    assert sorted((repr(r[0]), r[1], repr(r[2])) for r in got) == brute(rows)
    assert seats == [0]


@pytest.mark.parametrize("percent", [30, 75, 100])
def test_links_of_small_sets_need_no_more_tokens_than_they_share(spark, percent, monkeypatch):
    """Without blocks of equal min-hashes every link rests on the prefixes; sets of 1 to 12 shingles."""
    from starling.llm import jaccard_groups as j
    rng = random.Random(percent)
    rows = []
    for i in range(60):
        words = [f"w{i}x{x}" for x in range(rng.randrange(1, 17))]
        a, b = rng.randrange(3), rng.randrange(3)
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(words[a:])), (3 * i + 2, " ".join([*words, *(f"v{i}x{x}" for x in range(b))]))]
    monkeypatch.setattr(j, "star_seats", lambda classes, seats=j.star_seats: seats(classes).where("false"))
    got = jaccard_components(documents(spark, rows).repartition(3), percent=percent).collect()
    assert sorted((repr(r[0]), r[1], repr(r[2])) for r in got) == brute(rows, percent)


def test_equal_blocks_are_worked_off_once(spark, monkeypatch):
    """Near copies that share all min-hashes meet in one block of whole sets, not in one for each min-hash."""
    from starling.llm import jaccard_groups as j
    rng = random.Random(12)
    text = invented(rng, 300)
    rows = [(i, text + f" end{i}") for i in range(3)]
    classes = j.signatures(documents(spark, rows), 5).selectExpr("doc_id AS cls", "*").cache()
    seats = j.star_seats(classes)
    shared = seats.count()
    got = j.promising_seats(seats, classes, 75, True).collect()
    assert shared == 9 and len(got) == 3 and len({(r["block"], r["salt"]) for r in got}) == 1
