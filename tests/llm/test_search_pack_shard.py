"""Decontamination, packing, sharding, WARC, and the pipeline."""

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starling.llm import decontaminate, packing, sharding, tokens, warc
from starling.llm.queries import ORACLE, QUERIES
from starling.session import work_dir
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import EDGE_ROWS, documents, invented, words_of


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        words[at:at + (kind < 2)] = [f"zz{rng.randrange(10**6)}"] if kind != 1 else []
    return words


def plain_distance(item, region):
    """Least word edits from some run of ``region`` to ``item``, cell by cell."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(region, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_semi_global_distance():
    rng = random.Random(3)
    for _ in range(60):
        a, b = [[rng.randrange(5) for _ in range(rng.randrange(1, 14))] for _ in range(2)]
        assert decontaminate.semi_global(np.array(a), np.array(b))[0] == plain_distance(a, b)


def test_planted_leaks_are_found_and_nothing_else(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"b{rng.randrange(400)}" for _ in range(rng.randrange(12, 70)))) for i in range(40)]
    rows, want = [], {}
    for d in range(200):
        body = [f"b{rng.randrange(400)}" for _ in range(rng.randrange(0, 300))]
        if d % 2:
            i, text = rng.choice(items)
            words = edited(rng, text.split(), rng.randrange(0, 1 + int(0.15 * len(text.split()))))
            at = rng.randrange(len(body) + 1)
            body[at:at] = words
        rows.append((d, " ".join(body)))
    for d, text in rows:
        for i, item in items:
            edits = plain_distance(item.split(), text.split())
            if edits <= int(0.15 * len(item.split())):
                want[d, i] = edits
    bench = spark.createDataFrame(items + [(98, None), (99, "too short"), (97, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontaminate.leak_pairs(documents(spark, rows), bench).collect()}
    assert set(got) <= set(want)
    assert len(got) >= 0.95 * len(want)
    assert all(got[k] >= want[k] for k in got)
    exact = {k for k, e in want.items() if e == 0}
    assert exact <= set(got)


@pytest.mark.parametrize("size", [30, 200, 400])
def test_edited_items_are_found_at_any_size(size):
    rng = random.Random(size)
    item = [f"b{rng.randrange(10**6)}" for _ in range(size)]
    hashes = decontaminate.Words(pa.array([" ".join(item)])).hashes()
    index = decontaminate.Index([([1], hashes)], 0.15, 0.9)
    texts = [" ".join([f"c{rng.randrange(10**6)}" for _ in range(300)] + edited(rng, item, int(0.15 * size))
                      + [f"c{rng.randrange(10**6)}" for _ in range(300)]) for _ in range(100)]
    assert sum(map(bool, index.leaks(pa.array(texts)))) >= 85


def test_short_items_and_scripts_without_spaces(spark):
    texts = {1: "Who wrote the play Hamlet?", 2: "Hamlet", 3: "水の沸点は何度ですか。", 4: "中国的首都是哪里", 5: "ประเทศไทย", 6: "?!", 7: "the play Macbeth"}
    bench = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    rows = [(1, "so who wrote the play, Hamlet or not"), (2, "who wrote a play Hamlet"), (3, "前文、水の沸点は何度ですか?後文"),
            (4, "请问中国的首都是哪里呢"), (5, "ในประเทศไทยมี"), (6, "the play"), (7, None), (8, "水の沸点はX度ですか")]
    got = {(r["doc_id"], r["item_id"], r["edits"]) for r in decontaminate.leak_pairs(documents(spark, rows), bench).collect()}
    exact = {(1, 1, 0), (1, 2, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (5, 5, 0)}
    assert exact <= got <= exact | {(8, 3, 1)}


def test_word_runs_of_any_size_by_hash():
    rng = np.random.default_rng(5)
    words, first = rng.integers(0, 3, 900).astype(np.uint64), np.array([0, 0, 70, 400, 465, 900])
    for size in (1, 3, 64, 66, 70):
        hashes, begin = decontaminate.sequences(words, first, size)
        runs = [tuple(words[s:s + size]) for a, b in zip(first, first[1:]) for s in range(a, b - size + 1)]
        assert begin[-1] == len(hashes) == len(runs) and len(set(runs)) == len(set(hashes.tolist()))
        assert len(set(zip(runs, hashes.tolist()))) == len(set(runs))


def test_an_unmet_target_is_an_error():
    with pytest.raises(ValueError):
        decontaminate.keys_needed(60, 60, 0.9, 0.9)


def test_leaks_across_case_punctuation_and_copies(spark):
    item = "Where did the old painter keep his blue brushes, and who found them?"
    bench = spark.createDataFrame([(1, item), (2, item)], "item_id long, text string")
    rows = [(1, "x " * 30 + item.upper().replace(",", " ;") + " y" * 30), (2, item), (3, "nothing like that")] + EDGE_ROWS
    df = decontaminate.find_leaks(documents(spark, rows), bench)
    found = {r["doc_id"]: [x["item_id"] for x in r["leaks"]] for r in df.collect()}
    assert found[1] == found[2] == [1, 2] and found[3] == [] and df.count() == len(rows)
    assert df.where("doc_id = 1").first()["leaks"][0]["start_word"] == 30
    empty = decontaminate.find_leaks(documents(spark, rows), bench.limit(0)).collect()
    assert len(empty) == len(rows) and all(r["leaks"] == [] for r in empty)
    assert decontaminate.find_leaks(documents(spark, []), bench).collect() == []


def test_many_blocks_are_one_step_of_the_plan(spark, monkeypatch):
    rng = random.Random(11)
    items = [invented(rng, 9 + i % 30) for i in range(120)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [(i, f"before {x} after") for i, x in enumerate(items)]
    docs = documents(spark, rows + EDGE_ROWS).withColumn("__found", F.lit("clash"))
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 10)
    df = decontaminate.find_leaks(docs, bench)
    assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = df.collect()
    assert len(got) == len(rows) + len(EDGE_ROWS) and {r["__found"] for r in got} == {"clash"}
    assert all([x["item_id"] for x in r["leaks"]] == [r["doc_id"]] for r in got if r["doc_id"] is not None and r["doc_id"] < 120)


def test_items_in_several_blocks_give_the_same_leaks(spark, monkeypatch):
    bench = spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet")
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    whole = sorted(map(tuple, decontaminate.leak_pairs(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 15)
    assert sorted(map(tuple, decontaminate.leak_pairs(docs, bench).collect())) == whole and whole
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    verbatim = {(d, i) for d, t in texts.items() for i, x in items.items() if x in t}
    assert verbatim <= {(d, i) for d, i, *_ in whole}


def check_packing(rows, docs, path):
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(docs)
    for d, text in docs.items():
        ids = np.array(own.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            part = ids[at:at + r["length"]].tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            if "ids" in r:
                assert bytes(r["ids"]) == part
            at += r["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    return sum(2048 - sum(r["length"] for r in p) for p in by_sequence.values()) / sum(r["length"] for r in rows)


def test_packing_round_trip_and_padding(spark):
    got = [r.asDict() for r in QUERIES["op6_packing"](spark, SF_ORACLE).collect()]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    assert check_packing(got, docs, tokens.default_path()) < 0.01


def test_packing_edge_rows(spark):
    rows = [(i, t) for i, t in EDGE_ROWS[:9] if i is not None] + [(5, " " * 9000 + "x"), (6, "<|endoftext|> ok"), (7, "a" * 30000)]
    got = [r.asDict() for r in packing.pack(documents(spark, rows)).collect()]
    check_packing(got, dict(rows), tokens.default_path())
    assert packing.pack(documents(spark, [])).collect() == []
    repeated = packing.pack(documents(spark, [(None, "a b"), (3, "a b"), (3, "a b")])).collect()
    assert len(repeated) == 3 and len({(r["sequence_id"], r["offset"]) for r in repeated}) == 3


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 64, rng.integers(1, 3000)) if seed % 2 else rng.choice([1, 31, 33, 64], 500)
    histogram = {int(v): int(n) for v, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    plan = packing.packing_plan(histogram, 64)
    used = defaultdict(int)
    for pattern, times in plan:
        assert sum(pattern) <= 64 and times > 0
        for v in pattern:
            used[v] += times
    assert used == histogram


def test_least_squares_repeats_fit_the_histogram():
    combos = packing.shallow_combinations(np.arange(1, 16), 16)
    assert (combos.sum(1) == 16).all()
    goal = np.bincount(combos.ravel(), minlength=17).astype(float) * 10
    goal[0] = 0
    x = packing.least_squares_repeats(combos, goal, 500)
    fit = np.bincount(combos.ravel(), np.repeat(x, 3), 17)
    assert (x >= 0).all() and np.abs(fit[1:] - goal[1:]).max() < 5


def test_shards_are_even_gapless_and_reproducible(spark):
    one = QUERIES["op7_sharding"](spark, SF_ORACLE).toPandas()
    two = QUERIES["op7_sharding"](spark, SF_ORACLE).toPandas()
    assert one.sort_values("doc_id").reset_index(drop=True).equals(two.sort_values("doc_id").reset_index(drop=True))
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    assert {r.doc_id: (r.size_, r.text_crc32) for r in one.rename(columns={"size": "size_"}).itertuples()} == {
        d: (len(t) + 8, zlib.crc32(t)) for d, t in docs.items()}
    sizes = one.groupby("shard").slot.agg(["count", "min", "max"])
    assert len(sizes) == 24 and sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["min"] == 0).all() and (sizes["max"] + 1 == sizes["count"]).all()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 17, 256, 1000, 4097])
def test_feistel_is_a_permutation(n):
    got = sharding.permuted(np.arange(n), n, seed=n)
    assert sorted(got.tolist()) == list(range(n))
    if n >= 256:
        assert (got != np.arange(n)).mean() > 0.9
        assert (got != sharding.permuted(np.arange(n), n, seed=n + 1)).mean() > 0.9


def test_sharding_edge_rows(spark):
    got = sharding.feistel_shards(documents(spark, EDGE_ROWS), ["doc_id"], 4).collect()
    assert len(got) == len(EDGE_ROWS) and sorted(r["row_no"] for r in got) == list(range(len(EDGE_ROWS)))
    assert len({(r["shard"], r["slot"]) for r in got}) == len(EDGE_ROWS)
    assert sharding.feistel_shards(documents(spark, []), ["doc_id"], 4).collect() == []


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


PAGES = [(5, "http://a/\r\nX: y", "p" * 100), (3, "http://b", "p" * 100), (9, None, "p" * 100), (4, "http://c", "q" * 99),
         (6, "http://d", "q" * 99), (1, "http://e", None), (2, "http://f", ""), (7, "é", "ü" * 50), (8, "x", "ü" * 50),
         (None, "no id", "p" * 100), (10, "http://g", "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n" * 9)]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_round_trip(spark, compression):
    path = warc.write_pages(pages(spark, PAGES).repartition(3), work_dir(spark, "warc-test"), compression)
    rows = warc.read_records(spark, path).collect()
    assert len(rows) == len(PAGES)
    by_id = {r["headers"].get("Page-Id"): r for r in rows}
    html = {str(p) if p is not None else None: (h or "").encode() for p, _, h in PAGES}
    revisits = {"5": "<urn:page:3>", "9": "<urn:page:3>", "8": "<urn:page:7>", None: "<urn:page:3>"}
    for p, r in by_id.items():
        assert r["refers_to_id"] == revisits.get(p)
        assert bytes(r["payload"]) == (b"" if p in revisits else html[p])
    assert by_id["5"]["target_uri"] == "http://a/ X: y" and by_id["9"]["target_uri"] is None


def test_warc_filters_reach_the_reader(spark):
    path = warc.write_pages(pages(spark, PAGES), work_dir(spark, "warc-test"))
    some = warc.read_records(spark, path).where("record_type = 'revisit' AND target_uri IN ('x', 'http://b')")
    assert [r["target_uri"] for r in some.collect()] == ["x"]
    bare = warc.read_records(spark, path, payload=False)
    assert bare.where("payload IS NOT NULL").count() == 0 and bare.count() == len(PAGES)
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("content_length",), 5)]))
    assert [type(f) for f in left] == [GreaterThan] and reader.filters == [("record_type", ("response",))]


def test_unwanted_blocks_are_sought_past_not_read():
    import io

    class Watched(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            self.taken += n
            return super().read(n)

    data = b"".join(warc.record_bytes({"record_type": t, "record_id": str(i), "content_type": "text/plain",
                                       "payload": b"z" * 5000}) for i, t in enumerate(["response", "metadata", "metadata"]))
    stream = Watched(data)
    got = list(warc.records(stream, [("record_type", ("response",))], True))
    assert [r["record_id"] for r in got] == ["0"] and stream.taken == 5000
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(data[:3000]), [], True))


def test_warc_query_equals_sql_and_empty_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF_ORACLE}/pages.parquet')")
    got = QUERIES["op3_warc"](spark, SF_ORACLE)
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE['op3_warc']})").fetchall()
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(want)
    assert warc.archive_round_trip(spark, pages(spark, [])).collect() == []


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    rng = random.Random(9)
    clean = [(i, invented(rng, 80)) for i in range(10)]
    item = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first()["text"]
    rows = clean + [(100, clean[0][1]), (101, "??? 123"), (102, None), (103, clean[3][1] + " " + item), (3, clean[3][1])]
    docs = documents(spark, rows).select(*cp.COLUMNS)
    stage = dict(cp.STAGES)
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    deduped = stage["jaccard_join"](spark, docs, SF_SMALL)
    assert deduped.columns == cp.COLUMNS and ids(deduped) == [*range(10), 101, 102, 103]
    assert 103 not in ids(stage["decontamination"](spark, docs, SF_SMALL))
    assert set(range(10)) <= set(ids(stage["decontamination"](spark, docs, SF_SMALL)))
    assert len(words_of(item)) >= 8
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    spoken = stage["language_id"](spark, table.unionByName(documents(
        spark, [(900101, "??? 123"), (900102, None)]).select(*cp.COLUMNS)), SF_SMALL)
    assert not {900101, 900102} & set(ids(spoken)) and spoken.columns == cp.COLUMNS
    kept = stage["quality_rules"](spark, table, SF_SMALL)
    good = spark.read.parquet(f"{SF_SMALL}/labels.parquet").join(table, "doc_id").where("quality = 1 AND size(split(text, ' ')) > 30")
    assert kept.columns == cp.COLUMNS
    assert good.join(kept, "doc_id", "left_anti").count() <= 0.05 * good.count()


def test_near_duplicates_go_by_row_not_by_id(spark):
    import corpus_pipeline as cp
    rng = random.Random(10)
    a, b, c, d = (invented(rng, 80) for _ in range(4))
    docs = documents(spark, [(1, a), (2, a), (2, b), (3, c), (3, d), (None, d), (None, d), (None, b)]).select(*cp.COLUMNS)
    kept = [(r["doc_id"], r["text"]) for r in cp.near_duplicate_stage(spark, docs, SF_SMALL).collect()]
    assert sorted(kept) == sorted([(1, a), (2, b), (3, c), (3, d)])


def test_pipeline_run(spark):
    import corpus_pipeline as cp
    out = cp.run(spark, SF_SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns
