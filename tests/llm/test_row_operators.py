"""Operators that add columns to every document: quality rules, language, quality score, licenses, LM."""

import math
import random
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from starling.llm import lang_id, license_scan, line_crf, masked_lm, quality_fm
from starling.llm.common import labelled_sample
from starling.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import EDGE_ROWS, documents, invented, words_of


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_ORACLE}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF_ORACLE}/labels.parquet")


def base_counts(text):
    w = words_of(text)
    grams = Counter(zip(*[w[i:] for i in range(5)], strict=False))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_base_counts_match_plain_python(spark):
    rng = random.Random(1)
    rows = EDGE_ROWS + [(i, invented(rng, 30) + "\n" + rng.choice(["# $%", "a\na", "x y z x y z x y z x y z"])) for i in range(50)]
    got = line_crf.label_documents(documents(spark, rows), line_crf.Crf()).collect()
    assert len(got) == len(rows)
    by_text = {(r["doc_id"], r["text"]): r for r in got}
    for d, t in rows:
        r = by_text[d, t]
        n, *rest = want = base_counts(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        failed = n < 10 or 100 * rest[-1] > 20 * n
        assert r["base_failed"] == failed and r["kept"] == (not failed)  # untrained: every line is content


def test_lines_of_bad_documents_are_learnt(docs, labels):
    crf = line_crf.fit_lines(docs, labels)
    got = line_crf.label_documents(docs, crf).join(labels, "doc_id").where("NOT base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.98
    assert got[got.quality == 0].kept.mean() < 0.2


def test_lines_of_spliced_documents_get_their_own_labels(docs, labels):
    """Halves of held-out good and bad documents in one text: every line is told by itself and its neighbours."""
    held = "pmod(crc32(cast(doc_id AS string)), 3) = 1"
    crf = line_crf.fit_lines(docs, labels.where(f"NOT {held}"))
    rows = docs.join(labels.where(held), "doc_id").where("text IS NOT NULL").orderBy("doc_id").select("text", "quality").collect()
    by = {q: [x for r in rows if r["quality"] == q and len(x := [y for y in r["text"].split("\n") if words_of(y)]) >= 4] for q in (0, 1)}
    texts, truth, mixed = [], [], 0
    for i, (good, bad) in enumerate(zip(by[1], by[0], strict=False)):
        halves = [(good[:len(good) // 2], 1), (bad[len(bad) // 2:], 0)][::1 if i % 2 else -1]
        texts.append("\n".join(x for part, _ in halves for x in part))
        truth += [label for part, label in halves for _ in part]
    words = line_crf.Words(pa.array(texts))
    lines = line_crf.Lines(words)
    got = crf.viterbi(line_crf.line_features(words, lines, words.hashes()), lines.first)
    assert len(texts) >= 5 and (got == np.array(truth)).mean() > 0.9
    mixed = sum(0 < got[a:b].mean() < 1 for a, b in zip(lines.first[:-1], lines.first[1:], strict=True))
    assert mixed >= 0.9 * len(texts)
    assert crf.move[0, 0] + crf.move[1, 1] > crf.move[0, 1] + crf.move[1, 0]  # labels last, but not for ever


def test_spliced_chains_hold_every_line_once():
    lines = lambda n, x: np.full((n, 3), x, np.uint8)
    good, bad = [lines(n, 1) for n in (3, 20, 1)], [lines(n, 0) for n in (7, 2)]
    chains = line_crf.spliced(good, bad)
    assert [len(y) for _, y in chains] == [10, 22, 8]  # the first bad document serves twice
    assert all((features[:, 0] == labels).all() for features, labels in chains)
    assert all(len(set(labels)) == 2 for _, labels in chains)
    assert line_crf.spliced(good, []) == line_crf.spliced([], bad) == []


def test_repeated_ids_neither_crowd_out_nor_break_the_bound(spark):
    """One label id on most rows, and a document id on most rows: every id counts once."""
    ids = list(range(1, 401))
    labels = spark.createDataFrame([(i, i % 2) for i in ids] + [(7, 1)] * 5000 + [(7, 0), (None, 1), (8, None), (9, 5)],
                                   "doc_id long, quality int")
    docs = documents(spark, [(i, f"text {i}") for i in ids] + [(7, f"text {k % 50:02d} again") for k in range(3000)] + [(11, None)])
    everything = labelled_sample(docs, labels, 1000, ["text"]).collect()
    assert len(everything) == 400 and len({r["text"] for r in everything}) == 400
    assert {r["text"].split()[1]: r["quality"] for r in everything if r["text"].split()[1] == "12"} == {"12": 0}
    picked = labelled_sample(docs, labels, 150, ["text"]).collect()
    assert len(picked) == 150 and sorted(picked) == sorted(labelled_sample(docs.repartition(3), labels, 150, ["text"]).collect())
    assert labelled_sample(docs.limit(0), labels, 150, ["text"]).collect() == []
    assert labelled_sample(docs, labels.limit(0), 150, ["text"]).collect() == []


def test_viterbi_equals_brute_force():
    from itertools import product
    rng = np.random.default_rng(3)
    crf = line_crf.Crf()
    crf.emit, crf.move, crf.start = rng.normal(size=crf.emit.shape), rng.normal(size=(2, 2)), rng.normal(size=2)
    sizes = [0, 1, 5, 3, 0, 7]
    first = np.concatenate([[0], np.cumsum(sizes)])
    features = rng.integers(0, 2, (first[-1], line_crf.N_FEATURES)).astype(np.float32)
    got = crf.viterbi(features, first)
    for a, b in zip(first[:-1], first[1:], strict=True):
        score = features[a:b] @ crf.emit

        def total(path, score=score):
            return crf.start[path[0]] + sum(score[i, y] for i, y in enumerate(path)) + sum(
                crf.move[x, y] for x, y in zip(path, path[1:], strict=False))

        if b > a:
            assert tuple(got[a:b]) == max(product((0, 1), repeat=int(b - a)), key=total)


def test_quality_rules_without_rows_or_labels(spark, docs, labels):
    assert not line_crf.fit_lines(docs, labels.limit(0)).trained
    assert line_crf.label_documents(documents(spark, []), line_crf.Crf()).collect() == []


def test_language_is_learnt_and_held_out_rows_are_right(spark):
    got = QUERIES["op8_language_id"](spark, SF_ORACLE).toPandas().set_index("doc_id")
    want = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id").lang
    held = got[got.held_out]
    assert len(got) == 1000 and (held.lang_pred == want[held.index]).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_edge_cases(spark, docs):
    model = lang_id.train(docs)
    rows = EDGE_ROWS + [(1, "12345 ... !!"), (2, "und der die das nicht mit")]
    got = lang_id.identify(documents(spark, rows), model)
    assert [c for c in got.columns if c.lower() in ("lang_pred", "score")] == ["lang_pred", "score"]
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (900001, 900002, 900003, 1))
    assert by_id[2]["lang_pred"] == "de"
    empty = lang_id.train(documents(spark, []))
    assert {r["lang_pred"] for r in lang_id.identify(documents(spark, rows), empty).collect()} == {"und"}
    assert lang_id.identify(documents(spark, []), model).collect() == []


def test_copies_do_not_crowd_out_a_languages_other_texts(spark):
    rng = random.Random(8)
    other = [("xx", invented(rng, 20, "x")) for _ in range(60)] + [("yy", invented(rng, 20, "y")) for _ in range(5)]
    rows = [("xx", "the same copied text")] * 30000 + other + other[:9] + [(None, "no language"), ("xx", None)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = [(r["lang"], r["text"]) for r in lang_id.training_rows(df, 50).collect()]
    assert len(got) == len(set(got)) and set(got) <= set(rows)
    assert Counter(lang for lang, _ in got) == {"xx": 50, "yy": 5}


def test_unseen_words_back_off_to_shorter_grams():
    model = lang_id.Model(["a", "b"], [{"known": 0}, {"x": 1}, {"qu": 2}, {"que": 3}, {}],
                          np.array([[0, 0], [-9, -1], [-1, -2], [-3, -4]], np.float32))
    assert model.unseen("que").tolist() == [-3, -4]  # a known 3-gram
    assert model.unseen("quo").tolist() == [-1, -2]  # only a 2-gram
    assert model.unseen("x").tolist() == [-9, -1]  # only a letter
    assert model.unseen("zz").tolist() == [0, 0]


def test_unseen_words_of_a_text_are_looked_up_together():
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdé", k=rng.choice([1, 3, 6, 12]))) for _ in range(400)] + ["zz", "ab" * 300]
    held = [sorted({g for w in words[::3] for g in lang_id.grams(w, n)}) for n in range(1, 5)]
    edge, lookups = np.cumsum([0, *map(len, held)]), []

    class Counted:
        table = np.random.default_rng(4).normal(size=(edge[-1], 3)).astype(np.float32)

        def __getitem__(self, rows):
            lookups.append(len(rows))
            return self.table[rows]

    rows = [{}] + [dict(zip(g, range(a, a + len(g)), strict=True)) for a, g in zip(edge[:-1].tolist(), held, strict=True)]
    model = lang_id.Model(["a", "b", "c"], rows, Counted())

    def alone(word):
        known = next((k for n in (4, 3, 2, 1) if (k := [rows[n][g] for g in lang_id.grams(word, n) if g in rows[n]])), None)
        return model.logs.table[known].mean(0) if known else np.zeros(3, np.float32)

    scorer, distinct = lang_id.Scorer(model), list(dict.fromkeys(words))
    got = scorer.rows(distinct)
    assert len(lookups) == 2  # all words but the longest, and that
    assert (got == np.array([alone(w) for w in distinct])).all()
    assert (scorer.rows(distinct[::-1]) == got[::-1]).all() and len(lookups) == 2  # remembered


def test_both_word_patterns_find_the_same_words():
    rng = random.Random(6)
    for _ in range(60):
        text = "".join(chr(rng.choice([rng.randrange(0x250), rng.randrange(0xD800), rng.randrange(0x300, 0x370), 0x200C, 32]))
                       for _ in range(300))
        assert lang_id.letter_runs(text) == lang_id.LETTER_RUNS.findall(text.lower())
        text += " \U00010400x \U0001F600 " + text
        assert lang_id.letter_runs(text) == lang_id.LETTER_RUNS.findall(text.lower())


def plain_language(training, text):
    """(language, log sums by language) of a text by the definition, from (text, lang) rows."""
    def pieces(word):
        marked = f"_{word}_"
        return [[word], list(word)] + [[marked[i:i + n] for i in range(len(marked) - n + 1)] for n in (2, 3, 4)]
    split = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
    count = Counter((lang, n, g) for t, lang in training for w in split(t.lower()) for n, gs in enumerate(pieces(w)) for g in gs)
    total = Counter()
    for (lang, n, _), k in count.items():
        total[lang, n] += k
    languages = sorted({lang for _, lang in training})
    sums = dict.fromkeys(languages, 0.0)
    for w in split(text.lower()):
        for n in (0, 4, 3, 2, 1):
            known = [g for g in pieces(w)[n] if any((lang, n, g) in count for lang in languages)]
            if known:
                for lang in languages:
                    sums[lang] += sum(math.log((count[lang, n, g] or 0.5) / total[lang, n]) for g in known) / len(known)
                break
    return max(languages, key=lambda lang: sums[lang]), sums


def test_language_equals_the_plain_definition(spark):
    """Every word of the training texts is known, however rare; the sums are those of the definition."""
    rng = random.Random(21)
    spoken = lambda letters, n: " ".join("".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(n))
    alphabets = ("abcdefgh", "defghijk", "ghijklmé")
    training = [(spoken(alphabet, 40), alphabet[:2]) for alphabet in alphabets for _ in range(30)]
    training.append(("हिन्दी भाषा में कई शब्द", "hi"))
    model = lang_id.train(spark.createDataFrame(training, "text string, lang string"))
    assert set(model.rows[0]) == {w for t, _ in training for w in regex.findall(r"\p{L}[\p{L}\p{M}]*", t.lower())}
    texts = [spoken(a, 15) + " " + t.split()[0] for a in (*alphabets, "klxyz") for t, _ in training[::7]] + ["भाषा हिन्दीया", "x"]
    got = {r["text"]: r for r in lang_id.identify(documents(spark, list(enumerate(texts))), model).collect()}
    for t in texts:
        lang, sums = plain_language(training, t)
        n = len(regex.findall(r"\p{L}[\p{L}\p{M}]*", t))
        share = 1 / sum(math.exp((s - max(sums.values())) * min(1, 20 / n)) for s in sums.values())
        assert got[t]["lang_pred"] == lang and abs(got[t]["score"] - share) < 1e-3
    assert got["भाषा हिन्दीया"]["lang_pred"] == "hi"


def test_words_keep_their_combining_marks(spark):
    assert lang_id.LETTER_RUNS.findall("हिन्दी भाषा, cafe\u0301 a\u00b2b ½ x_y") == ["हिन्दी", "भाषा", "cafe\u0301", "a", "b", "x", "y"]
    model = lang_id.train(spark.createDataFrame([("word", "en")], "text string, lang string"))
    got = lang_id.identify(documents(spark, [(1, "½ ² \u0301 7"), (2, "Word")]), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {1: "und", 2: "en"}


def test_quality_classifier_on_held_out_rows(spark, labels):
    got = QUERIES["op9_quality_classifier"](spark, SF_ORACLE).join(labels, "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.93
    assert held[held.quality == 1].score.mean() - held[held.quality == 0].score.mean() > 0.6


def test_sum_of_squares_identity():
    rng = np.random.default_rng(4)
    machine = quality_fm.Machine()
    machine.weight = rng.normal(size=quality_fm.SIZE).astype(np.float32)
    index, value = rng.choice(quality_fm.SIZE, 12, replace=False), rng.normal(size=12).astype(np.float32)
    pairs = sum(float(machine.factor[index[i]] @ machine.factor[index[j]]) * value[i] * value[j]
                for i in range(12) for j in range(i))
    got = machine.parts(index, value, np.array([0, 12]))[0][0]
    assert got == pytest.approx(float(machine.weight[index] @ value) + pairs, rel=1e-4)


def test_quality_scores_of_edge_rows(spark, docs, labels):
    machine = quality_fm.train(docs, labels)
    got = quality_fm.score_documents(documents(spark, EDGE_ROWS), machine).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_fm.score_documents(documents(spark, []), machine).collect() == []
    untrained = quality_fm.train(docs, labels.limit(0))
    assert abs(quality_fm.score_documents(documents(spark, [(1, "a b c")]), untrained).first()["score"] - 0.5) < 0.1


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_license_scan_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    got = QUERIES["op1_license_scan"](spark, sf)
    cols = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE['op1_license_scan']})").fetchall()
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(want)


def test_license_in_changed_and_broken_wording(spark):
    apache = license_scan.LICENSES[1][1]
    rng = random.Random(7)
    words = apache.split()
    for i in rng.sample(range(len(words)), 2):
        words[i] = "changed"
    rows = [(1, invented(rng, 200) + " " + "\n".join(words) + " " + invented(rng, 200)), (2, invented(rng, 300)),
            (3, "released UNDER the mit license!"), (4, " ".join(apache.split()[:20]))] + EDGE_ROWS
    got = license_scan.scan(documents(spark, rows))
    found = {r["doc_id"]: {m["template_id"] for m in r["licenses"]} for r in got.collect()}
    assert 1 in found[1] and found[2] == set() and found[3] == {2} and 1 not in found[4]
    assert all(found[d] == set() for d, _ in EDGE_ROWS)
    assert license_scan.scan(documents(spark, [])).collect() == []
    assert {len(r["licenses"]) for r in license_scan.scan(documents(spark, rows), license_scan.Templates([])).collect()} == {0}


def test_band_settings_reach_their_probability():
    bands = license_scan.band_count(0.6, 0.99)
    assert 1 - (1 - 0.6**license_scan.ROWS)**bands >= 0.99 > 1 - (1 - 0.6**license_scan.ROWS)**(bands - 1)


def test_lm_prefers_text_like_the_corpus(spark, docs):
    words = masked_lm.vocabulary(docs)
    network = masked_lm.train(docs, words, every=4)
    text = [r["text"] for r in docs.where("lang = 'en' AND n_chars BETWEEN 1500 AND 3000").orderBy("doc_id").limit(20).collect()]
    rng = random.Random(6)
    rows = [(i, t) for i, t in enumerate(text)] + [(100 + i, " ".join(rng.sample(t.split(), len(t.split())))) for i, t in enumerate(text)]
    got = {r["doc_id"]: r for r in masked_lm.score_documents(documents(spark, rows + EDGE_ROWS), words, network).collect()}
    kept = np.mean([got[i]["mean_log_prob"] for i in range(len(text))])
    noise = masked_lm.score_documents(documents(spark, [(1, invented(rng, 300))]), words, network).first()
    assert kept > noise["mean_log_prob"]
    assert got[0]["n_tokens"] == len(text[0].split())
    assert got[0]["log_prob"] == pytest.approx(got[0]["mean_log_prob"] * got[0]["n_tokens"])
    for d in (900001, 900002, 900003):
        assert (got[d]["n_tokens"], got[d]["log_prob"], got[d]["mean_log_prob"]) == (0, 0.0, None)


def test_lm_trains_on_every_window_once(spark, monkeypatch):
    df = documents(spark, [(i, invented(random.Random(i), 50 + i)) for i in range(40)])
    trained, averaged = [], masked_lm.averaged

    def watched(parts, size):
        trained.append(parts.where("chunk = 0").groupBy().sum("weight").first()[0])
        return averaged(parts, size)

    monkeypatch.setattr(masked_lm, "averaged", watched)
    masked_lm.train(df, masked_lm.vocabulary(df))
    assert sum(trained) == masked_lm.word_counts(df).groupBy().sum("n").first()[0]


def test_lm_tells_words_of_a_bucket_by_their_counts(spark):
    names = pa.array([f"w{i}" for i in range(2000)])
    in_bucket = np.flatnonzero(masked_lm.Words(names).hashes() % np.uint64(masked_lm.BUCKETS) == 5)
    often, seldom, twice, unheard = [names[int(i)].as_py() for i in in_bucket[:4]]
    common = [f"top{i}" for i in range(masked_lm.VOCABULARY)]
    df = documents(spark, [(1, " ".join(common * 8)), (2, f"{often} " * 7 + f"{seldom} {twice} {twice}")])
    words = masked_lm.vocabulary(df)
    network = masked_lm.Network(np.zeros(len(masked_lm.Network().flat)))
    rows = [(1, often), (2, seldom), (3, twice), (4, unheard), (5, f"{twice} {often} {often}"), (6, "top1"), (6, "top1"), (None, often)]
    got = masked_lm.score_documents(documents(spark, rows), words, network).collect()
    by_word = {r["doc_id"]: r["log_prob"] for r in got}
    even = -np.log(masked_lm.CLASSES * masked_lm.WIDTH)
    for d, n in ((1, 7), (2, 1), (3, 2), (4, 1), (None, 7)):  # 10 words of the corpus in the bucket, one to come
        assert by_word[d] == pytest.approx(even + np.log(n / 11), abs=1e-4)
    assert by_word[5] == pytest.approx(3 * even + np.log(2 * 7 * 7 / 11**3), abs=1e-4)
    assert by_word[6] == pytest.approx(even, abs=1e-4) and len(got) == len(rows)
    assert next(r["mean_log_prob"] for r in got if r["doc_id"] == 5) == pytest.approx(by_word[5] / 3)


def test_lm_probabilities_sum_to_one():
    network, rng = masked_lm.Network(seed=3), np.random.default_rng(1)
    sides = np.repeat(rng.integers(0, masked_lm.IDS, (len(masked_lm.OFFSETS), 1)), masked_lm.IDS, axis=1)
    assert np.exp(network.log_probs(sides, np.arange(masked_lm.IDS))).sum() == pytest.approx(1, abs=1e-3)


def test_lm_training_lowers_the_loss():
    rng = np.random.default_rng(2)
    network, past = masked_lm.Network(), masked_lm.Network(np.full(masked_lm.Network().flat.shape, 1e-6))
    target = rng.integers(0, 200, 2000).astype(np.int32)
    sides = np.stack([target, (target * 7) % 200, target, target]).astype(np.int32)  # the sides tell the word
    before = network.log_probs(sides, target).mean()
    for _ in range(30):
        network.train(sides, target, past)
    assert network.log_probs(sides, target).mean() > before + 2


def test_lm_counts_and_empty_corpus(spark):
    rows = [(1, "a b a"), (2, "A c"), (3, None)]
    counts = {r["n"] for r in masked_lm.word_counts(documents(spark, rows)).collect()}
    assert counts == {3, 1}
    assert masked_lm.pseudo_likelihood(documents(spark, [])).collect() == []
    only = masked_lm.pseudo_likelihood(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r["n_tokens"], r["mean_log_prob"]) for r in only] == [(0, None)] * 2


def lm_corpus(spark, parts):
    rng = random.Random(4)
    rows = [(i, invented(rng, 30 + i % 90)) for i in range(300)] + [(1000 + i, "the same text in many rows " * 5) for i in range(150)]
    return documents(spark, rows + EDGE_ROWS).withColumn("row", F.lit("clash")).withColumn("ids", F.lit("clash")).repartition(parts, "doc_id")


def test_lm_scores_do_not_move_with_partitions(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "SHARD_TOKENS", 2000)
    got = [sorted((str(r["doc_id"]), r["n_tokens"], round(r["log_prob"], 3), r["row"], r["ids"])
                  for r in masked_lm.pseudo_likelihood(lm_corpus(spark, parts)).collect()) for parts in (1, 8)]
    assert len(got[0]) == len(got[1]) == 450 + len(EDGE_ROWS)
    for a, b in zip(*got, strict=True):
        assert a[:2] == b[:2] and a[3:] == b[3:] == ("clash", "clash")
        assert abs(a[2] - b[2]) <= 0.05 * max(1, a[1])


def test_lm_copies_are_spread_over_the_shards(spark):
    table = masked_lm.encoded(lm_corpus(spark, 3), masked_lm.vocabulary(lm_corpus(spark, 3)))[0]
    rounds = [masked_lm.shards_of_round(table, r, 2, 7).collect() for r in range(2)]
    assert sorted(bytes(r["ids"]) for rows in rounds for r in rows) == sorted(bytes(r["ids"]) for r in table.collect() if r["ids"])
    hot = max(((bytes(r["ids"]) for rows in rounds for r in rows)), key=[bytes(r["ids"]) for rows in rounds for r in rows].count)
    held = [sum(bytes(r["ids"]) == hot and r["shard"] == s for rows in rounds for r in rows) for s in range(7)]
    assert sum(held) == 150 and max(held) - min(held) <= 1


def test_lm_document_score_equals_the_plain_definition(spark):
    rows = [(1, "a b c d a b"), (2, "B a c c e"), (3, "lonely"), (4, "x\ty z z z a"), (5, "c")]
    df = documents(spark, rows)
    words, network = masked_lm.vocabulary(df), masked_lm.Network(seed=5)
    got = {r["doc_id"]: r["log_prob"] for r in masked_lm.score_documents(df, words, network).collect()}
    soft = lambda v: np.exp(v) / np.exp(v).sum()
    for d, text in rows:
        tokens = text.lower().split()
        ids = words.lookup(masked_lm.Words(pa.array(tokens)).hashes()).tolist()
        expected = 0.0
        for i, target in enumerate(ids):
            h = np.zeros(masked_lm.DIM)
            for table, o in zip(network.embed, (-2, -1, 1, 2), strict=True):
                h = h + table[ids[i + o] if 0 <= i + o < len(ids) else masked_lm.EDGE]
            h = np.tanh(h)
            c, place = divmod(target, masked_lm.WIDTH)
            expected += np.log(soft(h @ network.to_class + network.class_bias)[c])
            expected += np.log(soft(h @ network.to_word[c] + network.word_bias[c])[place])
        assert got[d] == pytest.approx(expected, rel=1e-4)
