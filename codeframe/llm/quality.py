"""Quality classifier by Bradley-Terry pairwise ranking.

A document's worth is a linear score of whole-text features. For a preference pair (a good and a bad document) the
model says P(good wins) = sigmoid(worth(good) - worth(bad)); its weights are fitted by logistic loss on feature differences.
Every labelled document that is not held out is in such pairs; the fit passes over a table of them, and tasks send sums only.
The threshold is the quantile of all their worths at the share of bad documents; scores are shifted so that it lies at 0.7.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeframe.llm import text as T
from codeframe.llm.tables import written

#: Documents of the rarer class in a group within which pairs are made, and the most of the other class for each of its parts.
RARE, COMMON = 256, 4096
#: Pairs for each document of the more frequent class: at least two, and in a small table so many that there are about as many pairs as this.
LEAST_PAIRS = 40_000
#: Weight of the squared weights against the mean loss of a pair.
PENALTY = 1 / 40_000
#: Cells of a range of worths that are counted at once.
CELLS = 4096
THRESHOLD = 0.7
#: The cut lies so far below its quantile that rounding does not part equal texts at it.
_EDGE = 1e-9

_KINDS = ["other", "lower", "upper", "digit", "blank", "line", "stop", "pipe", "shout", "mark", "high"]


def _byte_kinds() -> np.ndarray:
    kind = np.zeros(256, np.int64)
    for name, chars in (("digit", "0123456789"), ("blank", " \t\v\f\r"), ("line", "\n"), ("stop", ".,;:'\"()-"), ("pipe", "|"),
                        ("shout", "!?"), ("mark", "*#$%&@+=<>[]{}\\^_~`/")):
        kind[list(chars.encode())] = _KINDS.index(name)
    kind[97:123], kind[65:91], kind[128:] = _KINDS.index("lower"), _KINDS.index("upper"), _KINDS.index("high")
    return kind


_KIND = _byte_kinds()
FEATURES = ["words", "bytes", *(f"share_{k}" for k in _KINDS), "upper_letters", "word_length", "long_words", "short_words",
            "distinct_words", "few_words", "twice_running", "again_after_two", "distinct_lines", "line_words"]


def features(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each whole text; empty and null texts have counts of 0."""
    out = []
    for a, b, data, offsets in T.blocks(column):
        n = b - a
        size = np.diff(offsets)
        doc = np.repeat(np.arange(n), size)
        counts = np.bincount(doc * len(_KINDS) + _KIND[data], minlength=n * len(_KINDS)).reshape(n, -1).astype(float)
        starts, ends, first = T.words(data, offsets)
        h = T.word_hashes(data, starts)
        many = np.diff(first)
        word_doc = np.repeat(np.arange(n), many)
        lengths = ends - starts
        of = lambda flags, d=word_doc, n=n: np.bincount(d, weights=flags, minlength=n)
        _, bounds = T.distinct_sorted(h, first)
        some = np.maximum(many, 1)
        same1 = (h[1:] == h[:-1]) & (word_doc[1:] == word_doc[:-1]) if len(h) > 1 else np.zeros(0, bool)
        same2 = (h[2:] == h[:-2]) & (word_doc[2:] == word_doc[:-2]) if len(h) > 2 else np.zeros(0, bool)
        line, line_first = _lines(data, offsets)
        _, line_bounds = T.distinct_sorted(line, line_first)
        lines = np.maximum(np.diff(line_first), 1)
        letters = np.maximum(counts[:, 1] + counts[:, 2], 1)
        distinct = np.diff(bounds) / some
        out.append(np.column_stack([
            np.log1p(many), np.log1p(size), np.sqrt(counts / np.maximum(size, 1)[:, None]), np.sqrt(counts[:, 2] / letters),
            np.minimum(of(lengths) / some, 30), np.sqrt(of(lengths > 20) / some), of(lengths < 4) / some,
            distinct, np.log(np.maximum(np.diff(bounds), 1)) / np.log(np.maximum(many, 2)),
            np.sqrt(of(same1, word_doc[1:]) / some) if len(h) > 1 else np.zeros(n),
            np.sqrt(of(same2, word_doc[2:]) / some) if len(h) > 2 else np.zeros(n),
            np.diff(line_bounds) / lines, np.log1p(many / lines)]))
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each line that is not empty, and the bounds of each text's lines."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    feed = data == 10
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(feed[:-1]) + 1]))
    starts = starts[(starts < len(data)) & ~feed[np.minimum(starts, len(data) - 1)]]
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    with np.errstate(over="ignore"):
        value = T.mix(data.astype(np.uint64) + np.uint64(1)) * T.mix(np.arange(len(data), dtype=np.uint64) - np.repeat(
            np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(data)]]))).astype(np.uint64))
        value[feed] = 0
        hashes = np.add.reduceat(value, starts)
    return hashes, np.searchsorted(starts, offsets)


@dataclass(frozen=True)
class Ranking:
    """A fitted model; ``score`` is at 0.7 where the worth is at the threshold quantile."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float

    def score(self, x: np.ndarray) -> np.ndarray:
        worth = ((x - self.centre) / self.spread) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(worth + np.log(THRESHOLD / (1 - THRESHOLD)), -60, 60)))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the FEATURES of each row's whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(features(batch.column(1)))], names=["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(rows, f"doc_id {kind}, x array<double>")


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _sums(table: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``of(x)``, a row of numbers for each batch, over all rows of a table with a column ``x``; each task sends one row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((of(_matrix(batch.column(0))) for batch in batches if batch.num_rows), 0.0)
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["s"])

    return np.sum([r["s"] for r in table.select("x").mapInArrow(rows, "s array<double>").collect()], axis=0)


def differences(x: np.ndarray, good: np.ndarray, rarer: bool, each: int) -> np.ndarray:
    """Good minus bad: ``each`` rows of the class ``rarer`` (or all, if fewer) for every row of the other class, going round; none without both classes."""
    one, other = x[good == rarer], x[good != rarer]
    if not len(one) or not len(other):
        return x[:0]
    at = np.repeat(np.arange(max(len(one), len(other))), min(each, len(one)))
    d = one[np.arange(len(at)) % len(one)] - other[at % len(other)]
    return d if rarer else -d


def preference_pairs(labelled: DataFrame, counts: dict[bool, int]) -> DataFrame:
    """(x): differences of the features of a good and a bad document, for pairs in which every row of ``labelled`` (h, good, x) takes part.

    Rows fall into groups by ``h``, a hash of the id: RARE documents of the rarer class and their share of the others, in
    parts of about COMMON, each of which meets all documents of the rarer class in its group. Inside a part
    pairs go round both classes in the order of the hash.
    """
    rarer = counts[True] < counts[False]
    rare, common = sorted(counts.values())
    groups = -(-rare // RARE)
    parts = -(-common // (groups * COMMON))
    each = max(2, -(-LEAST_PAIRS // common))
    cell = F.pmod("h", F.lit(groups * parts))
    copies = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.pmod("h", F.lit(groups)) + i * groups)
    cells = labelled.select("*", F.explode(F.when(F.col("good") == rarer, copies).otherwise(F.array(cell))).alias("cell"))

    def pairs(table: pa.Table) -> pa.Table:
        x, good = _matrix(table["x"].combine_chunks()), table["good"].to_numpy()
        order = np.lexsort((*x.T, table["h"].to_numpy()))
        return pa.table({"x": _lists(differences(x[order], good[order], rarer, each))})

    return cells.groupBy("cell").applyInArrow(pairs, "x array<double>")


def newton(total: Callable[[Callable[[np.ndarray], np.ndarray]], np.ndarray], penalty: float = PENALTY, steps: int = 30) -> np.ndarray:
    """Weights by Newton steps on the mean logistic loss of all preference pairs; each step asks once for the ``total`` of a function of their differences."""
    k = len(FEATURES)
    w = np.zeros(k)
    for _ in range(steps):
        def sums(d: np.ndarray, w: np.ndarray = w) -> np.ndarray:
            p = 1 / (1 + np.exp(-np.clip(d @ w, -60, 60)))
            return np.concatenate([[len(d)], d.T @ (1 - p), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])

        got = total(sums)
        slope, bend = got[1: k + 1] / got[0], got[k + 1:].reshape(k, k) / got[0]
        step = np.linalg.solve(bend + penalty * np.eye(k), slope - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(x: np.ndarray, good: np.ndarray, bad_share: float) -> Ranking:
    """The ranking of rows that lie in memory, by the same pairs and steps as ``learn``; the threshold is the quantile of their worths at ``bad_share``."""
    if not len(x) or good.all() or not good.any():
        return _none()
    centre, spread = x.mean(0), np.maximum(x.std(0), 1e-3)
    z = (x - centre) / spread
    common = max(int(good.sum()), int((~good).sum()))
    d = differences(z, good, good.sum() < (~good).sum(), max(2, -(-LEAST_PAIRS // common)))
    w = newton(lambda f: f(d))
    worth = np.sort(z @ w)
    at = min(max(int(np.ceil(bad_share * len(x) - 1e-9)) - 1, 0), len(x) - 1)
    return Ranking(centre, spread, w, float(worth[at: at + 2].mean()) - _EDGE)


def _none() -> Ranking:
    k = len(FEATURES)
    return Ranking(np.zeros(k), np.ones(k), np.zeros(k), 0.0)


def value_at(worths: DataFrame, rank: int) -> float:
    """The mean of the values of this rank (from 0) and of the next, if there is one, in a table (worth) of any size.

    The range that holds the rank is cut into CELLS equal cells and their rows are counted, until a cell holds one value.
    """
    low, high, n = worths.agg(F.min("worth"), F.max("worth"), F.count("worth")).first()
    left = rank
    while low < high:
        cell = F.least(F.floor((F.col("worth") - low) / ((high - low) / CELLS)), F.lit(CELLS - 1)).alias("cell")
        cells = worths.where(F.col("worth").between(low, high)).groupBy(cell).agg(F.count("*"), F.min("worth"), F.max("worth")).collect()
        for _, rows, first, last in sorted(cells):
            if left < rows:
                low, high = first, last
                break
            left -= rows
    if rank + 1 >= n:
        return low
    upto, after = worths.agg(F.count_if(F.col("worth") <= low), F.min(F.when(F.col("worth") > low, F.col("worth")))).first()
    return low if upto > rank + 1 else (low + after) / 2


def learn(docs: DataFrame, labels: DataFrame) -> Ranking:
    """Fits the ranking to all labelled documents (``labels``: doc_id, quality 0 or 1) whose fold is not held out.

    Features are shuffled to their labels, not texts; only sums of tasks come to the driver. Without documents of both classes
    nothing is preferred: every score is 0.7, and nothing is rejected.
    """
    return _learned(featured(docs.where(fold(F.col("doc_id"), 4) != 2)), labels)


def _learned(table: DataFrame, labels: DataFrame) -> Ranking:
    """``learn`` from a table of features (doc_id, x)."""
    k = len(FEATURES)
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(fold(F.col("doc_id"), 4) != 2)
    known = known.groupBy(F.col("doc_id").alias("__id")).agg((F.max("quality") == 1).alias("good"))
    labelled = table.where(fold(F.col("doc_id"), 4) != 2).join(known, F.col("doc_id") == F.col("__id"))
    labelled = written(labelled.select(F.xxhash64("doc_id").alias("h"), "good", "x"), "labelled")
    counts = {r["good"]: r["n"] for r in labelled.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return _none()
    moments = _sums(labelled, lambda x: np.concatenate([x.sum(0), (x * x).sum(0)])) / sum(counts.values())
    centre = moments[:k]
    spread = np.maximum(np.sqrt(np.maximum(moments[k:] - centre * centre, 0)), 1e-3)

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (_matrix(batch.column(2)) - centre) / spread
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(x)], names=["h", "good", "x"])

    pairs = written(preference_pairs(labelled.mapInArrow(scaled, labelled.schema), counts), "pairs")
    weights = newton(lambda f: _sums(pairs, f))

    def worths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(((_matrix(batch.column(0)) - centre) / spread) @ weights)], names=["worth"])

    cut = value_at(written(labelled.select("x").mapInArrow(worths, "worth double"), "worths"), counts[False] - 1)
    return Ranking(centre, spread, weights, cut - _EDGE)


def scored(docs: DataFrame, model: Ranking) -> DataFrame:
    """``docs`` with ``score`` (a column of that name is replaced): the quality of the whole text, 0 to 1. Null texts score as empty ones.

    Labels, sources, languages and ids are no inputs. No shuffle; every row of ``docs`` comes back, repeated rows too, and
    equal texts have equal scores. An empty table stays empty.
    """
    names = [c for c in docs.columns if c != "score"]
    ordered = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = ordered.withColumn("score", F.lit(0.0)).schema
    at = names.index("text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = pa.array(model.score(features(batch.column(at))), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, s], names=[*names, "score"])

    return ordered.mapInArrow(rows, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document. Features are computed once, for the fit and the scores."""
    table = written(featured(docs), "features")
    model = _learned(table, labels)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch.column(1))), pa.float64())], names=["doc_id", "score"])

    out = table.mapInArrow(rows, f"doc_id {table.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
                      F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
