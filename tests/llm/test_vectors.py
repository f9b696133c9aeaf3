import math

import numpy as np
import pyarrow.parquet as pq

from codeframe.llm import bit_sliced as B
from codeframe.llm import hamming_index as H

NAN, INF = float("nan"), float("inf")
ODD = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (50, [0.25, 2.0]), (1, None), (2, []), (3, [1.0, None]), (4, [NAN, 1.0]), (5, [INF, 1.0]), (6, [0.0, 0.0]), (None, [1.0, 1.0]),
       (7, [-1.0, -2.0]), (8, [1.0, 0.5]), (9, [1.0, 0.5, 0.25]), (100, [1.0, 0.0, 0.0])]


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, id string, dim int")


def exact(rows, queries, k, score):
    out = []
    for q, v in queries:
        best = sorted(((-score(v, w), i) for i, w in rows if i != q and len(w) == len(v)))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def test_bit_sliced_against_all_pairs(spark):
    draw = np.random.default_rng(0)
    rows = [(int(i), [float(np.float32(x)) for x in draw.normal(size=6) * 10.0 ** draw.integers(-2, 2)]) for i in draw.permutation(700)]
    rows += [(1000 + i, [0.5] * 6) for i in range(40)]
    floor = lambda a, b: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))
    for blocks in ((65536, 128), (100, 5)):
        got = sorted(tuple(r) for r in B.top_products(frame(spark, rows), "id % 50 = 0", 5, rows_per_block=blocks[0], queries_per_block=blocks[1])
                     .select("query_id", "rank", "vec_id", "score").collect())
        assert got == exact(rows, [r for r in rows if r[0] % 50 == 0], 5, floor)


def test_odd_vectors(spark):
    fine = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (50, [0.25, 2.0]), (6, [0.0, 0.0]), (7, [-1.0, -2.0]), (8, [1.0, 0.5]), (9, [1.0, 0.5, 0.25]), (100, [1.0, 0.0, 0.0])]
    floor = lambda a, b: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b))
    asked = [(0, [1.0, 0.5]), (50, [0.25, 2.0]), (100, [1.0, 0.0, 0.0])]
    for kind in ("float", "double"):
        got = sorted(tuple(r) for r in B.top_products(frame(spark, ODD, kind), "id % 50 = 0", 5).select("query_id", "rank", "vec_id", "score").collect())
        assert got == exact(fine, asked, 5, floor)
    got = sorted(tuple(r) for r in H.nearest(frame(spark, ODD), "id % 50 = 0", 20).collect())
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    assert got == exact([r for r in fine if r[0] != 6], asked, 20, dot)
    for f in (B.top_products, H.nearest):
        assert f(frame(spark, []), "id % 50 = 0").count() == 0
        assert f(frame(spark, [(1, [1.0])]), "id % 50 = 0").count() == 0


def test_adders_and_selection():
    draw = np.random.default_rng(1)
    x = draw.integers(-300, 300, (333, 7))
    index = B.Slices(x)
    for q in draw.integers(-90, 90, (20, 7)):
        sums, shift = index.sums(q)
        total = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:333].astype(np.int64) << i) for i, s in enumerate(sums)) + shift
        assert (total == x @ q).all()
        top = index.top(sums, 9, index.live)
        assert sorted(top) == sorted(np.lexsort((np.arange(333), -(x @ q)))[:9])


def test_probing_finds_every_code_within_the_radius():
    draw = np.random.default_rng(2)
    code = draw.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    code[1500:] = code[:1500] ^ (draw.random((1500, 4, 16)) < 0.1).dot(1 << np.arange(16)).astype(np.uint16)
    index = H.Index(code)
    for q in code[::500]:
        apart = np.bitwise_count(code ^ q).sum(1)
        for radius in (0, 1, 5, 11, 16):
            assert index.within(q, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_recall(spark, sf):
    t = pq.read_table(f"{sf}/embeddings.parquet").to_pydict()
    ids, x = np.array(t["vec_id"]), np.array(t["embedding"], float)
    got = {}
    for r in H.nearest(spark.read.parquet(f"{sf}/embeddings.parquet"), "id % 20 = 0", 20).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:20]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21)) and all(abs(s[ids == v][0] - w) < 1e-12 for _, v, w in mine)
        hits += len({ids[i] for i in order} & {v for _, v, _ in mine})
        total += 20
    assert hits >= 0.9 * total
