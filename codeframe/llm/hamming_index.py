"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: the signs of learned rotations (each a principal-component basis turned until its coordinates lie
near the corners of a cube). A code is split into substrings, and each substring indexes all rows. Two codes within Hamming distance r
agree in some substring within ``r // m`` bits, so probing all values that near to the query's substrings retrieves every code
within r. Retrieved rows are reranked by the inner product of the original vectors.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeframe.llm.tables import written
from codeframe.llm.vectors import matrix, search, usable

#: Bound of the rows that the rotations and the radius are learned from: the first in the order of a hash of the id.
SAMPLE = 4096
ROTATIONS = 4
SUBSTRING = 16
#: Share of the sample's true neighbours that the radius must reach.
REACH = 0.985


def learn_rotations(sample: np.ndarray, rotations: int = ROTATIONS, steps: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """(centre, projection): ``rotations`` orthogonal bases side by side, each fitted by alternating signs and Procrustes rotation."""
    centre = sample.mean(0)
    z = sample - centre
    _, _, axes = np.linalg.svd(z, full_matrices=True)
    turned = z @ axes.T
    dim = sample.shape[1]
    out = []
    for r in range(rotations):
        turn, _ = np.linalg.qr(np.random.default_rng(r).normal(size=(dim, dim)))
        for _ in range(steps):
            u, _, w = np.linalg.svd(np.sign(turned @ turn).T @ turned)
            turn = (u @ w).T
        out.append(axes.T @ turn)
    return centre, np.concatenate(out, 1)


def codes(x: np.ndarray, centre: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Each vector's signs, packed into substrings of 16 bits (the last may be padded with equal bits)."""
    bits = (x - centre) @ projection > 0
    bits = np.concatenate([bits, np.zeros((len(bits), -bits.shape[1] % 64), bool)], 1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint16)


def learn_radius(sample: np.ndarray, centre: np.ndarray, projection: np.ndarray, k: int, reach: float = REACH) -> int:
    """The Hamming radius that holds ``reach`` of the sample's k nearest rows. In a larger table the k nearest are nearer still."""
    if len(sample) < 2:
        return 64 * projection.shape[1]
    some = sample[:: max(1, len(sample) // 256)]
    near = np.argsort(-(some @ sample.T), 1)[:, 1: k + 1]
    c = codes(sample, centre, projection).view(np.uint64)
    mine = codes(some, centre, projection).view(np.uint64)
    return int(np.quantile(np.bitwise_count(mine[:, None] ^ c[near]).sum(2), reach)) + 1


def masks(radius: int, bits: int = SUBSTRING) -> np.ndarray:
    """All bit patterns with at most ``radius`` ones."""
    out = [sum(1 << b for b in c) for r in range(min(radius, bits) + 1) for c in combinations(range(bits), r)]
    return np.array(out, np.uint16)


class Index:
    """One block's rows, sorted by each substring's value."""

    def __init__(self, code: np.ndarray):
        self.code, self.wide = code, np.ascontiguousarray(code).view(np.uint64)
        self.order = [np.argsort(c, kind="stable") for c in code.T]
        self.start = [np.searchsorted(c[o], np.arange((1 << SUBSTRING) + 1)) for c, o in zip(code.T, self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of all codes within the radius: each substring is probed at ``r // m`` bits, those past the remainder at one less."""
        m = len(self.order)
        near, rest = divmod(radius, m)
        hit = np.zeros(len(self.code), bool)
        for j, (order, start) in enumerate(zip(self.order, self.start)):
            reach = near if j <= rest else near - 1
            if reach < 0:
                continue
            value = _masks(reach) ^ code[j]
            a, b = start[value], start[value.astype(np.int64) + 1]
            full = b > a
            a, n = a[full], (b - a)[full]
            hit[order[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())]] = True
        found = np.flatnonzero(hit)
        apart = np.bitwise_count(self.wide[found] ^ np.ascontiguousarray(code).view(np.uint64)).sum(1)
        return found[apart <= radius]


_made: dict[int, np.ndarray] = {}


def _masks(radius: int) -> np.ndarray:
    if radius not in _made:
        _made[radius] = masks(radius)
    return _made[radius]


def _best(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, model: dict) -> tuple[np.ndarray, ...]:
    centre, projection, radius = model.get(rows.shape[1], (None, None, None))
    none = np.zeros(0, np.int64)
    if centre is None:
        index = None
    else:
        index, asked = Index(codes(rows, centre, projection)), codes(queries, centre, projection)
    at, found, scores = [none], [none], [np.zeros(0)]
    for i, q in enumerate(queries):
        near = np.arange(len(rows)) if index is None else index.within(asked[i], radius)
        near = near[ids[near] != query_ids[i]]
        s = rows[near] @ q
        if len(near) > k:  # the k best and all that tie with the last of them
            cut = np.partition(s, len(s) - k)[len(s) - k]
            near, s = near[s >= cut], s[s >= cut]
        at.append(np.full(len(near), i))
        found.append(ids[near])
        scores.append([_dot(rows[n], q) for n in near])
    return np.concatenate(at), np.concatenate(found), np.concatenate(scores)


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    """The inner product, summed in the order of components, so that equal vectors score equally in every task."""
    return float(np.add.accumulate(a * b)[-1])


def nearest(table: DataFrame, queries_where: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            sample: int = SAMPLE, reach: float = REACH) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query's codes within the learned radius, the k rows with the largest inner product.

    ``queries_where`` is a condition on ``id``. Every row is indexed; the rotations and the radius are fitted to at most ``sample`` rows. A query that
    finds fewer than k rows is searched again without a radius. Scores are inner products of the original vectors in
    double precision; ties go to the smaller id. Rows without an id, and vectors that are null, empty, all zero or hold null or non-finite
    components, take no part; only vectors of equal length are compared. Of an id on several rows each row is a candidate of
    other queries, and its first vector asks. Other columns are not read. Empty tables and tables without queries give no rows.
    """
    rows = usable(table, id_col, vector_col, zero=False)
    some = rows.orderBy(F.xxhash64("id"), "id", "v").limit(sample).toArrow()
    model = {}
    dims = some["dim"].to_numpy() if len(some) else np.zeros(0, int)
    for dim in set(dims.tolist()):
        x = matrix(some["v"].take(np.flatnonzero(dims == dim)), dim)
        centre, projection = learn_rotations(x)
        model[dim] = (centre, projection, learn_radius(x, centre, projection, k, reach))
    asked = rows.where(queries_where)
    found = written(search(rows, asked, lambda a, b, c, d: _best(a, b, c, d, k, model), k, "double"), "near")
    full = found.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    short = written(asked.join(full, "id", "left_anti"), "short")
    if short.isEmpty():
        return found
    again = search(rows, short, lambda a, b, c, d: _best(a, b, c, d, k, {}), k, "double")
    return found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
