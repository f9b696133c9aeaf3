"""Exact top-k by integer inner product on a bit-sliced index.

Each attribute (vector component) of a block of rows is kept as slices: bitmap ``b`` holds bit ``b`` of every row's value. A
query's weighted sum of attributes is built with bitmap arithmetic alone: every set bit of a weight contributes the attribute's
slices at a shift, and full adders reduce all bitmaps of equal weight to one. The k best rows are then selected from the most
significant slice of the sums downward; rows that tie at the boundary are resolved by id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from codeframe.llm.vectors import search, usable


class Slices:
    """Slices of the columns of an integer matrix, each column shifted to begin at 0. Rows fill bits from the lowest of each word."""

    def __init__(self, x: np.ndarray):
        self.rows, self.dim = x.shape
        self.least = x.min(0)
        v = (x - self.least).T
        self.bits = [max(1, int(c.max()).bit_length()) for c in v]
        pad = -self.rows % 64
        self.live = self._pack(np.ones(self.rows, bool), pad)
        self.slices = [[self._pack((c >> b) & 1 == 1, pad) for b in range(n)] for c, n in zip(v, self.bits)]
        self.inverse = [[~s & self.live for s in column] for column in self.slices]

    @staticmethod
    def _pack(flags: np.ndarray, pad: int) -> np.ndarray:
        return np.packbits(np.append(flags, np.zeros(pad, bool)), bitorder="little").view(np.uint64)

    def sums(self, q: np.ndarray) -> tuple[list[np.ndarray], int]:
        """The slices of every row's inner product with ``q``, lowest first, and a constant to be added to all.

        A negative weight -w times v is w times the complement of v, less w times its largest value: sums stay non-negative.
        """
        planes: dict[int, list[np.ndarray]] = {}
        shift = 0
        for w, least, bits, plain, inverse in zip(q.tolist(), self.least.tolist(), self.bits, self.slices, self.inverse):
            shift += w * least
            column = plain
            if w < 0:
                shift += w * ((1 << bits) - 1)
                column, w = inverse, -w
            at = 0
            while w >> at:
                if w >> at & 1:
                    for b, s in enumerate(column):
                        planes.setdefault(at + b, []).append(s)
                at += 1
        out, weight = [], 0
        while planes:
            bitmaps = planes.pop(weight, [])
            carry = planes.setdefault(weight + 1, []) if len(bitmaps) > 1 else []
            while len(bitmaps) > 2:
                fresh = []
                for a, b, c in zip(bitmaps[0::3], bitmaps[1::3], bitmaps[2::3]):
                    odd = a ^ b
                    carry.append((a & b) | (odd & c))
                    fresh.append(odd ^ c)
                bitmaps = fresh + bitmaps[len(bitmaps) - len(bitmaps) % 3:]
            if len(bitmaps) == 2:
                carry.append(bitmaps[0] & bitmaps[1])
                bitmaps = [bitmaps[0] ^ bitmaps[1]]
            out.append(bitmaps[0] if bitmaps else np.zeros_like(self.live))
            weight += 1
        return out, shift

    def top(self, sums: list[np.ndarray], k: int, allowed: np.ndarray) -> np.ndarray:
        """Positions of the k rows with the largest sums among the allowed ones; of equal sums the earlier rows."""
        sure, tied = np.zeros_like(allowed), allowed
        for s in reversed(sums):
            high = tied & s
            n = int(np.bitwise_count(sure | high).sum())
            if n > k:
                tied = high
            else:
                sure, tied = sure | high, tied & ~s
                if n == k:
                    return self._positions(sure)
        chosen, rest = self._positions(sure), self._positions(tied)
        return np.concatenate([chosen, rest[: k - len(chosen)]])

    def _positions(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.rows])


def _best(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, scale: int) -> tuple[np.ndarray, ...]:
    x, q = (np.floor(scale * m).astype(np.int64) for m in (rows, queries))
    index = Slices(x)
    at, found, scores = [], [], []
    low, high = np.searchsorted(ids, query_ids), np.searchsorted(ids, query_ids, "right")
    for i in range(len(q)):
        sums, _ = index.sums(q[i])
        allowed = index.live
        if high[i] > low[i]:
            own = np.zeros(index.rows, bool)
            own[low[i]: high[i]] = True
            allowed = allowed & ~Slices._pack(own, -index.rows % 64)
        rows_in = index.top(sums, k, allowed)
        at.append(np.full(len(rows_in), i))
        found.append(ids[rows_in])
        scores.append(x[rows_in] @ q[i])
    return np.concatenate(at), np.concatenate(found), np.concatenate(scores)


def top_products(table: DataFrame, queries_where: str, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
                 rows_per_block: int = 65_536, queries_per_block: int = 128) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows with the largest inner product of ``floor(scale * component)``.

    ``queries_where`` is a condition on ``id``. All rows but the query's own are candidates; ties go to the smaller id. Rows without
    an id, and vectors that are null, empty or hold null or non-finite components, take no part; only vectors of equal
    length are compared. Of an id on several rows each row is a candidate of other queries, and its first vector asks. Scores must fit
    in 64 bits. Other columns are not read. Empty tables and tables without queries give no rows.
    """
    rows = usable(table, id_col, vector_col, zero=True)
    return search(rows, rows.where(queries_where), lambda a, b, c, d: _best(a, b, c, d, k, scale), k, "long", rows_per_block, queries_per_block)

