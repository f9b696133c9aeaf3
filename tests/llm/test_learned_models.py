"""Learned operators: quality, language, cross-entropy difference."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from codeframe.llm import cross_entropy as C
from codeframe.llm import lang_crf as L
from codeframe.llm import quality as Q

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "12 34 !!"), (5, "x" * 200_000), (6, "word " * 30_000), (7, "é"), (7, "é"), (None, "some words"), (8, "漢字かな"), (9, "\n\n\n")]


def test_quality_held_out(spark, sf):
    rows = Q.quality(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).collect()
    label = dict(zip(*pq.read_table(f"{sf}/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values()))
    assert len(rows) == pq.read_table(f"{sf}/documents.parquet").num_rows
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert sum(r.predicted == label[r.doc_id] for r in held) >= 0.9 * len(held)


def test_quality_odd_rows(spark, docs):
    labels = spark.createDataFrame([(4, 0), (7, 1), (7, 1), (6, 0), (None, 1), (99, 1), (8, None)], "doc_id long, quality int")
    rows = Q.quality(docs(ODD), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1 and len({r.score for r in rows if r.doc_id == 7}) == 1
    assert Q.quality(docs([]), labels).count() == 0
    none = Q.quality(docs(ODD), labels.limit(0)).collect()
    assert {r.predicted for r in none} == {1} and {round(r.score, 9) for r in none} == {0.7}
    kept = Q.scored(docs(ODD), Q.learn(docs(ODD), labels))
    assert kept.columns == [*[c for c in docs([]).columns if c != "score"], "score"]


def test_preferences_are_learned():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(800, len(Q.FEATURES)))
    good = x[:, 0] - 2 * x[:, 1] + 0.3 * draw.normal(size=800) > -0.5
    model = Q.fit(x, good, float((~good).mean()))
    assert ((model.score(x) >= 0.7) == good).mean() > 0.93
    assert abs((model.score(x) < 0.7).mean() - (~good).mean()) < 0.02


def test_every_labelled_document_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(Q, "RARE", 8)
    monkeypatch.setattr(Q, "COMMON", 16)
    monkeypatch.setattr(Q, "LEAST_PAIRS", 1)
    k = len(Q.FEATURES)
    for n_bad, n_good in ((5, 300), (300, 40), (90, 100), (1, 1)):
        rows = [(i, i >= n_bad, [float(i if i >= n_bad else 0), float(0 if i >= n_bad else i)] + [0.0] * (k - 2)) for i in range(n_bad + n_good)]
        labelled = spark.createDataFrame(rows, "h long, good boolean, x array<double>").selectExpr("xxhash64(h) AS h", "good", "x")
        pairs = [(r.x[0], -r.x[1]) for r in Q.preference_pairs(labelled, {False: n_bad, True: n_good}).collect()]
        assert {g for g, _ in pairs} == set(range(n_bad, n_bad + n_good)) and {b for _, b in pairs} == set(range(n_bad))


def test_labels_beyond_any_sample_count(spark):
    # 14,000 documents of each class: those of a style of their own, last by the hash that a sample went by, decide how that style is scored
    n = 14_000
    ids = spark.range(8 * n).where(Q.fold(F.col("id"), 4) != 2).limit(2 * n).withColumn("good", F.col("id") % 2 == 0)
    rank = F.row_number().over(W.partitionBy("good").orderBy(F.xxhash64("id"), "id"))
    docs = ids.withColumn("late", rank > 6000).select(F.col("id").alias("doc_id"), "good", F.when(F.col("late") == F.col("good"), "plain words of a text").otherwise("## 12 %% 34 | 56 !!").alias("text"))
    model = Q.learn(docs, docs.select("doc_id", F.col("good").cast("int").alias("quality")))
    plain, marks = model.score(Q.features(pa.array(["plain words of a text", "## 12 %% 34 | 56 !!"])))
    assert plain > marks  # 8,000 good documents are plain and 6,000 are marks; the first 6,000 alone say the contrary


def test_threshold_is_exact(spark):
    draw = np.random.default_rng(4)
    for values in (draw.normal(size=3001), np.round(draw.normal(size=500), 1), np.full(7, 2.5), np.array([1.0, np.nextafter(1.0, 2)]), np.array([-3.0])):
        worths = spark.createDataFrame([(float(v),) for v in values], "worth double")
        for rank in {0, len(values) // 3, len(values) - 1}:
            assert Q.value_at(worths, rank) == np.sort(values)[rank: rank + 2].mean()


def test_features_by_hand():
    texts = ["Aa bb\nbb bb!", "", None, "X X"]
    f = dict(zip(Q.FEATURES, Q.features(pa.array(texts)).T))
    assert f["words"] == pytest.approx(np.log1p([4, 0, 0, 2])) and f["share_upper"][0] == pytest.approx(math.sqrt(1 / 12))
    assert f["distinct_words"][0] == 0.75 and f["twice_running"][3] == pytest.approx(math.sqrt(0.5)) and f["line_words"][0] == pytest.approx(math.log1p(2))


def test_language_held_out(spark, sf):
    rows = L.identify(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    lang = dict(zip(t["doc_id"], t["lang"]))
    assert len(rows) == len(t["doc_id"]) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_odd_rows(docs):
    train = [(100 + i, t, "s", g) for i in range(40) for t, g in ((f"the cat and the dog number{i}", "en"), (f"der hund und die katze nummer{i}", "de"))]
    train += [(300, "unlabelled words", "s", None)]
    rows = {r.doc_id: r for r in L.identify(docs([*ODD, *train])).where("doc_id <= 9 OR doc_id IS NULL").collect()}
    for i in (1, 2, 3, 4, 9):
        assert (rows[i].lang_pred, rows[i].score) == ("und", 0.0)
    assert rows[5].lang_pred in ("en", "de") and rows[7].lang_pred in ("en", "de") and rows[8].lang_pred in ("en", "de") and rows[None].held_out is False
    assert L.identify(docs([])).count() == 0
    assert {r.lang_pred for r in L.identify(docs([(1, "some words", "s", None)])).collect()} == {"und"}


def test_chain_probabilities_by_enumeration():
    draw = np.random.default_rng(2)
    emit, trans = draw.normal(size=(9, 3)), draw.normal(size=(3, 3))
    first = np.array([0, 4, 4, 5, 9])
    got = L.forward_backward(emit, first, trans)
    from itertools import product
    for a, b in zip(first[:-1], first[1:]):
        total = np.zeros((b - a, 3))
        for path in product(range(3), repeat=b - a):
            s = math.exp(sum(emit[a + i, y] for i, y in enumerate(path)) + sum(trans[x, y] for x, y in zip(path, path[1:])))
            for i, y in enumerate(path):
                total[i, y] += s
        if b > a:
            assert got[a:b] == pytest.approx(total / total.sum(1, keepdims=True))


def test_switched_text_is_labelled_word_by_word():
    en, de = "the cat and the dog were in the house", "der hund und die katze waren in dem haus"
    model = L.fit([en] * 60 + [de] * 60, ["en"] * 60 + ["de"] * 60)
    from codeframe.llm import text as T
    _, _, data, offsets = next(T.blocks(pa.array([en + " " + de])))
    p, _ = model.posteriors(data, offsets)
    assert p.argmax(1).tolist() == [1] * 9 + [0] * 9


def loss_by_hand(texts, targets, prior=C.PRIOR):
    toks = [[255] * 3 + list((t or "").encode()) + [254] for t in texts]
    size = len({x for t in toks for x in t[3:]})
    counts = {}
    for m, use in (("t", targets), ("b", [True] * len(texts))):
        c = Counter()
        for t, u in zip(toks, use):
            for i in range(3, len(t)) if u else ():
                for k in range(1, 5):
                    c[tuple(t[i - k + 1: i + 1])] += 1
                    c[("ctx", *t[i - k + 1: i])] += 1
        counts[m] = c
    out = []
    for t in toks:
        loss = {"t": 0.0, "b": 0.0}
        for i in range(3, len(t)):
            for m, c in counts.items():
                p = (c[(t[i],)] + 1) / (c[("ctx",)] + size)
                for k in range(2, 5):
                    p = (c[tuple(t[i - k + 1: i + 1])] + prior * p) / (c[("ctx", *t[i - k + 1: i])] + prior)
                loss[m] -= math.log(p)
        out.append((len(t) - 3, loss["t"] / (len(t) - 3), loss["b"] / (len(t) - 3)))
    return out


def test_cross_entropy_by_hand(spark, docs):
    rows = [(i, f"Abc dé {i % 7} {'xyz' * (i % 5)}") for i in range(60)] + [(100, None), (101, ""), (5, "a second row"), (None, "no id"), (102, "b" * 3000)]
    targets = spark.createDataFrame([(i,) for i in range(0, 60, 3)] + [(0,), (None,), (777,)], "doc_id long")
    got = C.cross_entropy_difference(docs(rows), targets, chunk_bytes=500).collect()
    want = loss_by_hand([t for _, t in rows], [i is not None and i < 60 and i % 3 == 0 for i, _ in rows])
    key = lambda r: (r[0] if r[0] is not None else -1, *[round(x, 9) for x in r[1:]])
    assert sorted(key((r.doc_id, r.n_tokens, r.target_loss, r.background_loss, r.score)) for r in got) == sorted(
        key((i, n, t, b, t - b)) for (i, _), (n, t, b) in zip(rows, want))
    assert C.cross_entropy_difference(docs([]), targets).count() == 0
    assert C.cross_entropy_difference(docs(rows), targets.limit(0)).count() == len(rows)
