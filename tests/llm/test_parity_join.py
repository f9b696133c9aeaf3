import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from brute import groups, linked, shingle_set

from codeframe.llm import linking
from codeframe.llm import parity_join as P
from codeframe.llm import text as T


def run(df, **kw):
    return sorted((r.id if r.id is not None else -1, r.n_shingles, r.component_id) for r in P.similar_groups(df, **kw).collect())


def near_copies(seed, families, copies, size, edits):
    rng = random.Random(seed)
    out = []
    for f in range(families):
        base = [f"w{rng.randrange(300)}" for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(w))
    return out


@pytest.mark.parametrize("group", [2, 16])
def test_against_all_pairs(spark, docs, group):
    texts = [t for size, edits in ((6, 1), (20, 2), (47, 3), (60, 3), (200, 9), (700, 30)) for t in near_copies(size, 3, 9, size, edits)]
    passage = " ".join(f"p{i}" for i in range(30))  # shared by many texts that are not alike
    texts += [passage + " " + " ".join(f"q{i}_{j}" for j in range(20 + 9 * i)) for i in range(40)]
    rows = list(enumerate(texts))
    want = groups({i: shingle_set(t) for i, t in rows})
    got = run(docs(rows), group=group)
    assert got == sorted((i, len(shingle_set(t)), want[i]) for i, t in rows)


def test_odd_rows(docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (6, "a b c"), (7, long), (8, long.upper() + " end"), (9, "a b"), (9, "a b"), (None, "a b c"),
            (10, "é ü ö"), (11, "É ü ö")]
    got = run(docs(rows))
    assert [g for g in got if g[0] in (1, 2, 3)] == [(i, 0, i) for i in (1, 2, 3)]
    assert [g for g in got if g[0] in (4, 5, 9)] == [(4, 1, 4), (5, 1, 4), (9, 1, 4), (9, 1, 4)]
    assert [g for g in got if g[0] in (7, 8)] == [(7, 29_996, 7), (8, 29_997, 7)]
    assert (6, 1, 6) in got and (-1, 1, 6) in got and (10, 1, 10) in got and (11, 1, 11) in got
    assert len(got) == len(rows)
    assert run(docs([])) == []


def test_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    sets = {i: shingle_set(x) for i, x in zip(t["doc_id"], t["text"])}
    want = groups(sets)
    assert run(df) == sorted((i, len(s), want[i]) for i, s in sets.items())


def test_words_that_differ_never_exceed_the_difference():
    draw = np.random.default_rng(0)
    for n in (64, 100, 500, 3000):
        a = np.unique(draw.integers(0, 2**64, n, np.uint64))
        b = np.unique(np.concatenate([a[: -n // 10], draw.integers(0, 2**64, n // 12, np.uint64)]))
        bands = np.array([P.band(np.array([len(x)]))[0] for x in (a, b)]).min().repeat(2)
        row, key, full = P.sketch(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands)
        k = int(P.WORDS[bands[0]])
        same = len(set(key[row == 0]) & set(key[row == 1]))
        differ = len(set(a.tolist()) ^ set(b.tolist()))
        assert k - same - int(np.minimum(k - full[0], k - full[1])) <= differ
        assert set(P.EDGES[1:20] >= 4 * P.EDGES[:19] / 3) == {True}


def test_bit_sketches_bound_the_difference():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 400, n).astype(np.uint64)) for n in (5, 50, 120, 300, 300)]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    import pyarrow as pa
    rows = linking.with_sketches(pa.array(range(5)), np.concatenate(sets), bounds)
    sketch = np.array(rows.column(2).to_pylist(), np.int64).view(np.uint64)
    for i in range(5):
        for j in range(5):
            assert np.bitwise_count(sketch[i] ^ sketch[j]).sum() <= len(np.setxor1d(sets[i], sets[j]))


def test_hot_key_is_settled(spark):
    """Holders of a key that did not link with the first pivot still meet."""
    found = spark.createDataFrame([(1, i, 10) for i in range(1, 8)], "key long, cls long, n long")
    sets = spark.createDataFrame([(i, [x + 100 * (i // 4) for x in range(10)], [i // 4] * linking.SKETCH_WORDS) for i in range(1, 8)], linking.SETS)
    none = spark.createDataFrame([], "a long, b long")
    got = {r.node: r.component for r in linking.settle(none, found, lambda asked: sets.join(asked, "cls")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 4}


def test_word_hashes_and_spans():
    texts = ["", "a", " a  bb\tccc\n", "über straße", "a\x0bb\x0cc", None, "x" * 100_000]
    import pyarrow as pa
    seen = {}
    for a, b, data, offsets in T.blocks(pa.array(texts, pa.string())):
        starts, ends, first = T.words(data, offsets)
        h = T.word_hashes(data, starts)
        for r in range(b - a):
            got = [data[s:e].tobytes().decode() for s, e in zip(starts[first[r]: first[r + 1]], ends[first[r]: first[r + 1]])]
            assert got == [w for w in __import__("re").findall("[^\x20\x09-\x0D]+", texts[a + r] or "")]
            for w, x in zip(got, h[first[r]: first[r + 1]].tolist()):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def _near(rng, words, k=1):
    w = list(words)
    for _ in range(k):
        w[rng.randrange(len(w))] = f"new{rng.random()}"
    return " ".join(w)


def test_links_through_rows_without_an_id(docs):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    steps = [base]
    for _ in range(3):  # each near the one before, the ends apart
        w = list(steps[-1])
        for i in rng.sample(range(120), 2):
            w[i] = f"n{rng.random()}"
        steps.append(w)
    sets = [shingle_set(" ".join(w)) for w in steps]
    assert all(linked(a, b) for a, b in zip(sets, sets[1:])) and not linked(sets[0], sets[3])
    rows = [(5, " ".join(steps[0])), (None, " ".join(steps[1])), (None, " ".join(steps[2])), (None, " ".join(steps[2])), (9, " ".join(steps[3])),
            (None, "alone " * 9), (None, None), (7, "other words here altogether now")]
    got = sorted(((r.id or 0, r.component_id) for r in P.similar_groups(docs(rows)).collect()), key=repr)
    assert got == sorted([(5, 5), (0, 5), (0, 5), (0, 5), (9, 5), (0, None), (0, None), (7, 7)], key=repr)


def test_one_row_of_each_component(docs):
    rng = random.Random(4)
    text = lambda k: [f"{k}_{i}" for i in range(60)]
    rows = [(1, " ".join(text("a"))), (2, _near(rng, text("a"))), (3, " ".join(text("b"))), (3, " ".join(text("a"))), (4, " ".join(text("c"))), (4, " ".join(text("c"))),
            (6, " ".join(text("d"))), (None, " ".join(text("d"))), (None, " ".join(text("e"))), (None, _near(rng, text("e"))), (8, ""), (8, None), (None, None), (9, "unique words of a short text"),
            (10, _near(rng, text("f"))), (10, " ".join(text("f")))]
    out = P.one_of_each(docs(rows))
    assert out.columns == docs(rows).columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len([1, 3, 4, 6, "e", 8, 8, None, 9, 10])
    for want in ((1, rows[0][1]), (3, rows[2][1]), (4, rows[4][1]), (6, rows[6][1]), (8, ""), (8, None), (None, None), rows[13]):
        assert got.count(want) == 1
    assert sum(i is None and t is not None for i, t in got) == 1 and sum(i == 10 for i, _ in got) == 1
    assert P.one_of_each(docs([])).count() == 0


def test_sketches_of_many_short_texts_take_little_memory():
    n = 20_000
    many = np.arange(n) % 3
    bounds = np.concatenate([[0], np.cumsum(many)])
    values = T.mix(np.arange(bounds[-1]))
    tracemalloc.start()
    batch = linking.with_sketches(pa.array(np.arange(n)), values, bounds)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    bits = 64 * linking.SKETCH_WORDS
    for row in (0, 1, 2, 511, 512, 513, 19_999):
        want = 0
        for v in T.mix(values[bounds[row]: bounds[row + 1]]).tolist():
            want ^= 1 << (v % bits)
        got = b"".join(w.to_bytes(8, "little", signed=True) for w in batch.column(2)[row].as_py())
        assert int.from_bytes(got, "little") == want and batch.column(1)[row].as_py() == values[bounds[row]: bounds[row + 1]].view(np.int64).tolist()
