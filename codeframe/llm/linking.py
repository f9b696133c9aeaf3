"""Linking of sets that share keys (sketch words, MinHash bands), whole and without a group in all its pairs.

Map tasks pack (key, set) entries for each of a number of target partitions; equal sets of a block enter once. A task
of the join holds one partition: about so many keys as the caller sizes it for. Sets that share a key with at most ``GROUP`` others
are listed in pairs. Holders of a key that more have are compared with one pivot, the one that holds most such keys:
of a group of near copies that is the text they were copied from, or one close to it. Once the links found are merged
into components, those holders of a key that still lie in different ones are compared in full, behind a test of small parity
sketches whose Hamming distance never exceeds the sets' difference.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeframe.llm.components import components
from codeframe.llm.tables import dropped, written
from codeframe.llm.text import mix

GROUP = 16
SKETCH_WORDS = 16
#: Sets whose sketches are counted at once.
SKETCH_ROWS = 512

RUN = np.dtype([("cls", "<i8"), ("n", "<i4"), ("words", "<i4"), ("own", "<i4"), ("low", "<i4")])
#: kind 0: sets a and b share ``shared`` keys; kind 1: set b is one of many that hold key a.
FOUND = "kind byte, a long, b long, na long, nb long, empty long, shared long"
_FOUND = pa.schema([("kind", pa.int8()), *((c, pa.int64()) for c in ("a", "b", "na", "nb", "empty", "shared"))])


def near(na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Can sets of these sizes reach 3/4?"""
    return 4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)


def pack(row: np.ndarray, key: np.ndarray, cls: np.ndarray, n: np.ndarray, empty: np.ndarray, parts: int) -> pa.RecordBatch:
    """(part, runs, keys): entries by target partition. A run is one set's keys in a partition; 5 bytes of a key are kept, the rest is in its partition's number."""
    part = ((key >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)
    order = np.lexsort((row, part))
    row, key, part = row[order], key[order], part[order]
    head = np.ones(len(row), bool)
    head[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
    heads = np.flatnonzero(head)
    runs = np.zeros(len(heads), RUN)
    runs["cls"], runs["n"], runs["words"] = cls[row[heads]], n[row[heads]], np.diff(heads, append=len(row))
    runs["own"], runs["low"] = empty[row[heads], 0], empty[row[heads], 1]
    short = np.ascontiguousarray(key.view(np.uint8).reshape(-1, 8)[:, :5])
    cuts = np.flatnonzero(np.diff(part, prepend=-1, append=parts + 1))
    run_cuts = np.searchsorted(heads, cuts)
    return pa.RecordBatch.from_arrays([
        pa.array(part[cuts[:-1]].astype(np.int32)),
        pa.array([runs[x:y].tobytes() for x, y in zip(run_cuts[:-1], run_cuts[1:])], pa.binary()),
        pa.array([short[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary())], names=["part", "runs", "keys"])


def found_pairs(table: pa.Table, group: int, empties: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
                spares: Callable[[np.ndarray], np.ndarray] | None = None) -> pa.Table:
    """One partition's pairs of sets that share a key with few others, counted; for keys of many sets, the holders.

    ``empties`` gives, from two arrays of runs, what goes into the column ``empty`` of their pairs; ``spares`` the same of holders.
    """
    runs = np.concatenate([np.frombuffer(x, RUN) for x in table["runs"].to_pylist()])
    raw = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    keys = wide.view(np.uint64).ravel() | (np.uint64(table["part"][0].as_py()) << np.uint64(40))
    at = np.repeat(np.arange(len(runs)), runs["words"])
    order = np.lexsort((runs["cls"][at], keys))
    keys, at = keys[order], at[order]
    cls = runs["cls"][at]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (cls[1:] != cls[:-1])
    keys, at = keys[fresh], at[fresh]
    heads = np.flatnonzero(np.diff(keys, prepend=keys[0] + np.uint64(1)))
    sizes = np.diff(heads, append=len(keys))
    left, right = [], []
    few = (sizes > 1) & (sizes <= group)
    for step in range(1, group):
        start, size = heads[few & (sizes > step)], sizes[few & (sizes > step)] - step
        x = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        left.append(x)
        right.append(x + step)
    many = np.flatnonzero(sizes > group)
    hot = np.concatenate([np.arange(heads[g], heads[g] + sizes[g]) for g in many]) if len(many) else np.zeros(0, np.int64)
    a, b = runs[at[np.concatenate(left)]], runs[at[np.concatenate(right)]]
    ok = near(a["n"], b["n"])
    a, b = a[ok], b[ok]
    order = np.lexsort((b["cls"], a["cls"]))
    a, b = a[order], b[order]
    empty = empties(a, b) if empties else np.zeros(len(a), np.int64)
    head = np.ones(len(a), bool)
    head[1:] = (a["cls"][1:] != a["cls"][:-1]) | (b["cls"][1:] != b["cls"][:-1])
    heads = np.flatnonzero(head)
    h = runs[at[hot]]
    zero = np.zeros(len(h), np.int64)
    spare = spares(h) if spares else zero
    columns = zip((np.zeros(len(heads), np.int8), a["cls"][heads], b["cls"][heads], a["n"][heads], b["n"][heads], empty[heads],
                   np.diff(heads, append=len(a))),
                  (np.ones(len(h), np.int8), keys[hot].view(np.int64), h["cls"], h["n"], zero, spare, zero))
    return pa.Table.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def held_by_many(found: DataFrame) -> DataFrame:
    """(key, cls, n, spare): the holders of keys that many sets have."""
    return found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("cls"), F.col("na").alias("n"), F.col("empty").alias("spare"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of those pairs whose whole sets (cls, set) have a Jaccard similarity of 3/4 or more."""
    joined = (pairs.select("a", "b").join(sets.select(F.col("cls").alias("b"), F.col("set").alias("sb")), "b")
              .join(sets.select(F.col("cls").alias("a"), F.col("set").alias("sa")), "a"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return joined.where(100 * both >= 75 * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct()


def with_sketches(cls: pa.Array, values: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    """(cls, set, sketch): whole sets, and in 64 * SKETCH_WORDS bits the parity of the elements that fall on each bit.

    An element that only one of two sets has toggles one bit of one sketch, so sketches never differ in more bits than sets in elements.
    """
    n, bits = len(bounds) - 1, 64 * SKETCH_WORDS
    row = np.repeat(np.arange(n), np.diff(bounds))
    bit = (mix(values) % np.uint64(bits)).astype(np.int64)
    words = np.zeros((n, SKETCH_WORDS), np.int64)
    for a in range(0, n, SKETCH_ROWS):  # short texts come many to a block, and counts take eight bytes a bit
        b = min(a + SKETCH_ROWS, n)
        here = slice(bounds[a], bounds[b])
        odd = np.bincount((row[here] - a) * bits + bit[here], minlength=(b - a) * bits).astype(np.uint8) & 1
        words[a:b] = np.packbits(odd.reshape(b - a, bits), axis=1, bitorder="little").view(np.int64)
    sets = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
    sketch = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * SKETCH_WORDS), pa.array(words.ravel()))
    return pa.RecordBatch.from_arrays([cls, sets, sketch], names=["cls", "set", "sketch"])


SETS = "cls long, set array<long>, sketch array<long>"


def settle(likely: DataFrame, hot: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, component) of all sets that have a link.

    ``likely`` has the pairs (a, b) that may be links, ``hot`` the holders (key, cls, n) of keys that many sets have, as far as
    their links need not show in other keys. ``fetch`` brings the whole sets (``SETS``) of a table of ids (cls); it is
    called once, for all sets that any later step may compare. All tables written on the way are deleted.
    """
    tried, hot = written(likely.select("a", "b"), "pairs"), written(hot, "hot")
    made = [tried, hot]
    asked = tried.select(F.explode(F.array("a", "b")).alias("cls")).unionByName(hot.select("cls")).distinct()
    sets = written(fetch(asked), "whole")
    links = written(verified(tried, sets), "links")
    parts = components(links)
    made += [sets, links]
    if hot.isEmpty():
        dropped(*made)
        return parts
    central = hot.groupBy("cls").agg(F.count(F.lit(1)).alias("central"))
    known = central.join(sets.select("cls", "sketch"), "cls")
    hot = written(hot.join(known, "cls"), "hot")
    made.append(hot)
    for compare in (_with_pivot, _in_full):
        more = written(_untried(compare(hot, parts), tried), "more")
        made.append(more)
        if more.isEmpty():
            continue
        tried = tried.unionByName(more)
        fresh = written(verified(more, sets), "links")
        made.append(fresh)
        if not fresh.isEmpty():
            # the components so far are stars: only new links add work
            stars = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
            made.append(parts)
            parts = components(stars.unionByName(fresh))
    dropped(*made)
    return parts


def _mixed(hot: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The holders with their components, and of each key that has holders in several ones the most central holder."""
    placed = hot.join(parts.withColumnRenamed("node", "cls"), "cls", "left").withColumn("part", F.coalesce("component", "cls"))
    most = F.max(F.struct("central", F.xxhash64("cls"), "cls", "n", "part")).alias("pivot")
    return placed, placed.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), most).where("lo <> hi")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _near() -> Column:
    return 4 * F.least("nx", "ny") >= 3 * F.greatest("nx", "ny")


def _with_pivot(hot: DataFrame, parts: DataFrame) -> DataFrame:
    """Each key's most central holder with the others of other components."""
    placed, mixed = _mixed(hot, parts)
    left = mixed.select("key", F.col("pivot.cls").alias("x"), F.col("pivot.n").alias("nx"), F.col("pivot.part").alias("px"))
    right = placed.select("key", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("part").alias("py"))
    return left.join(right, "key").where((F.col("px") != F.col("py")) & _near()).select(*_pair("x", "y"))


def _in_full(hot: DataFrame, parts: DataFrame) -> DataFrame:
    """All holders of a key that lie in different components and whose sketches may belong to sets that reach 3/4.

    Keys whose holders are all in one component, as after a group of near copies, drop out before.
    """
    placed, mixed = _mixed(hot, parts)
    placed = placed.join(mixed.select("key"), "key", "left_semi")
    left = placed.select("key", F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("part").alias("px"), F.col("sketch").alias("sx"))
    right = placed.select("key", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("part").alias("py"), F.col("sketch").alias("sy"))
    apart = sum((F.bit_count(F.col("sx")[i].bitwiseXOR(F.col("sy")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    fits = (F.col("x") < F.col("y")) & (F.col("px") != F.col("py")) & _near() & (7 * apart <= F.col("nx") + F.col("ny"))
    return left.join(right, "key").where(fits).select(*_pair("x", "y"))


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    return pairs.distinct().join(tried, ["a", "b"], "left_anti")
