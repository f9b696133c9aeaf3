import math
import random
import re
from collections import Counter

import numpy as np

from codeframe.llm import shared_search as S

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)) for w in TERM.findall(text or "")]


def by_hand(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    total, all_terms = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = {}
    for i, ts in wanted.items():
        scored = []
        for d, c in held:
            m = 10 + (90 * sum(c.values()) * total) // all_terms if all_terms else 0
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out[i] = [(None if none else d, -s) for s, none, d in sorted(scored)[:k]]
    return {i: r for i, r in out.items() if r}


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.rank):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(out[r.item_id])
    return out


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, 7) for i, t in rows], "item_id long, text string, key int")


def corpus(rng, n):
    vocabulary = ["the", "of", "And", "in", "é", "漢字", "x1", "a-b"] + [f"w{i}" for i in range(60)]
    return ["".join(rng.choice(vocabulary[: rng.choice([4, 8, 68])]) + rng.choice(" \n,.-") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_like_by_hand(spark, docs, monkeypatch):
    rng = random.Random(5)
    rows = list(enumerate([None, "", "!!", *corpus(rng, 150)])) + [(None, "the of w1"), (7, "the of w1"), (7, "the of w1"), (900, "w3 " * 40_000 + "漢字")]
    items = list(enumerate(["", None, *corpus(rng, 40)])) + [(None, "w5 of the"), (3, "w9 another"), (500, "nowhere")]
    want = by_hand(rows, items, 6)
    assert results(S.search(docs(rows), items_of(spark, items), 6)) == want
    # many blocks, small slices, two rows of documents a slice
    monkeypatch.setattr(S, "ITEMS", 9)
    monkeypatch.setattr(S, "TERMS", 150)
    monkeypatch.setattr(S, "CELLS", 1)
    assert results(S.search(docs(rows), items_of(spark, items), 6)) == want


def test_ties_go_to_the_smallest_ids(spark, docs):
    rows = [(i, "same words here") for i in range(3000, 0, -1)] + [(i, "others") for i in range(5000, 12000)]
    got = results(S.search(docs(rows).repartition(5), items_of(spark, [(1, "same"), (2, "words same")]), 10))
    assert [[d for d, _ in r] for r in got.values()] == [list(range(1, 11))] * 2


def test_graph_gives_every_item_its_leaves():
    rng = np.random.default_rng(1)
    for has in (rng.random((80, 40)) < rng.random((80, 1)), np.ones((6, 9), bool), np.eye(5, dtype=bool), np.zeros((0, 3), bool)):
        left, right, level, nodes = S.mine(has)
        leaves = [{i} for i in range(len(has))]
        for a, b in zip(left, right):
            assert not leaves[a] & leaves[b]
            leaves.append(leaves[a] | leaves[b])
        for item, own in enumerate(nodes):
            parts = [x for n in own for x in leaves[n]]
            assert sorted(parts) == np.flatnonzero(has[:, item]).tolist()
        assert (np.diff(level) >= 0).all()
        added = len(left) + sum(max(len(n) - 1, 0) for n in nodes)
        assert added <= sum(max(x - 1, 0) for x in has.sum(0))  # never more sums than without sharing
    assert len(S.mine(np.ones((6, 9), bool))[0]) == 5


def test_empty_tables(spark, docs):
    one = items_of(spark, [(1, "a")])
    for d, i in ((docs([]), one), (docs([(1, "a")]), items_of(spark, [])), (docs([(1, None)]), one)):
        out = S.search(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
