"""Ranked lexical search for many items at once, with their common subexpressions evaluated once.

An item's score of a document is a sum over its terms, so what several items share may be summed once. From the terms of a block of items a graph is mined:
terms that stand in exactly the same items form one node; then, round by round, the pairs of nodes that most items have in common are joined into a
new node, which takes their place in those items (``mine``). Each document slice gets one accumulator for each node, from the terms up to the
largest shared sets, and an item's scores are the sum of the accumulators of the few nodes that are left to it.

Items come in blocks of bounded size, each block a pass over the documents: what is sent to the tasks is a block's graph and weights. Documents are read in
slices of bounded size; nothing is grouped by document. Terms are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from codeframe.llm import text as T
from codeframe.llm.tables import written

#: About so many items, and item terms, form a block; an item with more terms is one by itself.
ITEMS, TERMS = 512, 100_000
#: Accumulator cells of a slice of documents.
CELLS = 1 << 21
#: Separators as blanks, A-Z in lower case; 0-9, a-z and bytes beyond ASCII stay.
_FOLD = np.full(256, 32, np.uint8)
for _a, _b in ((48, 58), (97, 123), (128, 256)):
    _FOLD[_a:_b] = np.arange(_a, _b)
_FOLD[65:91] = np.arange(97, 123)

_PLAN = ("block int, items array<{item}>, keys array<long>, leaf array<int>, left array<int>, right array<int>, level array<int>, leaves int, "
         "nodes array<int>, first array<int>")


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes of all terms, where each row's begin)."""
    for a, b, data, offsets in T.blocks(column):
        data = _FOLD[data]
        starts, _, first = T.words(data, offsets)
        yield a, b, T.word_hashes(data, starts), first


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, key): the distinct terms of each item as hashes."""
    kind = items.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, first in _terms(batch.column(1)):
                at = pa.array(np.repeat(np.arange(a, b), np.diff(first)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(hashes.view(np.int64))], names=["item", "key"])

    return items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("t")).mapInArrow(rows, f"item {kind}, key long").distinct()


def mine(has: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """(left, right, level, nodes of each item) from a table of leaves (rows) by items (columns).

    Node ``len(has) + i`` is ``left[i] + right[i]``, made in round ``level[i]``. Every item's nodes are disjoint and hold its leaves. In a round each node is joined at
    most once, with the node it shares most items with; pairs of fewer than two items save nothing and end the search.
    """
    bits = has.astype(np.float32)
    left, right, level = [], [], []
    round_no = 0
    while True:
        use = np.flatnonzero(bits.sum(1) > 1)
        if len(use) < 2:
            break
        best, count = np.zeros(len(use), np.int64), np.zeros(len(use), np.int64)
        sub = bits[use]
        for x in range(0, len(use), 512):
            both = sub[x: x + 512] @ sub.T
            both[np.arange(len(both)), np.arange(x, x + len(both))] = 0
            best[x: x + 512] = both.argmax(1)
            count[x: x + 512] = both.max(1)
        free = np.ones(len(use), bool)
        made = []
        for i in np.argsort(-count, kind="stable").tolist():
            j = int(best[i])
            if count[i] < 2:
                break
            if free[i] and free[j]:
                free[i] = free[j] = False
                made.append((int(use[i]), int(use[j])))
        if not made:
            break
        a, b = (np.array(x) for x in zip(*made))
        new = bits[a] * bits[b]
        bits[a] -= new
        bits[b] -= new
        left += a.tolist()
        right += b.tolist()
        level += [round_no] * len(made)
        bits = np.concatenate([bits, new])
        round_no += 1
    return np.array(left, np.int32), np.array(right, np.int32), np.array(level, np.int32), [np.flatnonzero(bits[:, i]) for i in range(bits.shape[1])]


def _plan(block: pa.Table) -> pa.Table:
    """One block's graph, from its rows (block, item, key)."""
    names = pc.unique(block["item"].combine_chunks())
    number = pc.index_in(block["item"].combine_chunks(), names).to_numpy()
    keys, term = np.unique(block["key"].to_numpy().view(np.uint64), return_inverse=True)
    has = np.zeros((len(keys), len(names)), bool)
    has[term, number] = True
    packed, leaf = np.unique(np.packbits(has, axis=1), axis=0, return_inverse=True)
    has = np.unpackbits(packed, axis=1, count=len(names)).astype(bool)
    left, right, level, nodes = mine(has)
    flat = np.concatenate(nodes).astype(np.int32)
    first = np.concatenate([[0], np.cumsum([len(x) for x in nodes])]).astype(np.int32)
    cells = [block["block"][0].as_py(), names, keys.view(np.int64), leaf.ravel().astype(np.int32), left, right, level, len(has), flat, first]
    as_list = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x))
    columns = [pa.array([x], pa.int32()) if isinstance(x, int) else as_list(x) for x in cells]
    return pa.Table.from_arrays(columns, names=["block", "items", "keys", "leaf", "left", "right", "level", "leaves", "nodes", "first"])


def _postings(docs: DataFrame, keys: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, tf): each document's number of terms, and those of the block that it holds."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, hashes, first in _terms(batch.column(1)):
                n = np.diff(first)
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                hit = keys[at] == hashes
                cell, times = np.unique(np.repeat(np.arange(b - a), n)[hit] * len(keys) + at[hit], return_counts=True)
                bounds = pa.array(np.searchsorted(cell, np.arange(b - a + 1) * len(keys)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array(n), pa.ListArray.from_arrays(bounds, pa.array((cell % len(keys)).astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(times))], names=["doc_id", "n", "terms", "tf"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t")).mapInArrow(rows, f"doc_id {kind}, n long, terms array<int>, tf array<long>")


class Graph:
    """A block's graph with the weights of its terms, evaluated over slices of documents."""

    def __init__(self, plan: dict, items: pa.Array, weight: np.ndarray, total: int, terms: int, k: int):
        self.items, self.weight, self.total, self.terms, self.k = items, weight, total, terms, k
        self.leaf, self.leaves = np.array(plan["leaf"], np.int64), plan["leaves"]
        self.left, self.right = np.array(plan["left"], np.int64), np.array(plan["right"], np.int64)
        level = np.array(plan["level"], np.int64)
        self.cuts = [*np.flatnonzero(np.diff(level, prepend=-1)).tolist(), len(level)]
        self.nodes, self.first = np.array(plan["nodes"], np.int64), np.array(plan["first"], np.int64)
        self.rows = max(16, CELLS // (self.leaves + len(self.left) + len(self.nodes)))

    def scores(self, n: np.ndarray, bounds: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Scores of a slice's documents (columns) for the block's items (rows)."""
        m = 100 - 90 + (90 * n * self.total) // self.terms
        row = np.repeat(np.arange(len(n)), np.diff(bounds))
        part = self.weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        sums = np.zeros((self.leaves + len(self.left), len(n)), np.int64)
        np.add.at(sums.reshape(-1), self.leaf[terms] * len(n) + row, part)
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            sums[self.leaves + a: self.leaves + b] = sums[self.left[a:b]] + sums[self.right[a:b]]
        return np.add.reduceat(sums[self.nodes], self.first[:-1], axis=0)

    def best(self, ids: pa.Array, n: np.ndarray, bounds: np.ndarray, terms: np.ndarray, tf: np.ndarray) -> pa.RecordBatch:
        """(item_id, doc_id, score) of a slice: each item's k best of score above 0, of equal ones those of the smallest ids."""
        scores = self.scores(n, bounds, terms, tf)
        place = np.empty(len(n), np.int64)
        place[pc.array_sort_indices(ids).to_numpy()] = np.arange(len(n))
        least = np.ones(len(scores), np.int64)
        if len(n) > self.k:
            least = np.maximum(least, np.partition(scores, len(n) - self.k, axis=1)[:, len(n) - self.k])
        item, doc = np.nonzero(scores >= least[:, None])
        score = scores[item, doc]
        order = np.lexsort((place[doc], -score, item))
        item, doc, score = item[order], doc[order], score[order]
        no = np.arange(len(item)) - np.searchsorted(item, item)
        item, doc, score = item[no < self.k], doc[no < self.k], score[no < self.k]
        return pa.RecordBatch.from_arrays([self.items.take(pa.array(item)), ids.take(pa.array(doc)), pa.array(score)], names=["item_id", "doc_id", "score"])


def _ranked(postings: DataFrame, graph: Graph, item_kind: str) -> DataFrame:
    """(item_id, doc_id, score): the best of every slice."""
    kind = postings.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in range(0, batch.num_rows, graph.rows):
                part = batch.slice(x, graph.rows)
                bounds = np.concatenate([[0], np.cumsum(part.column(2).value_lengths().to_numpy())])
                yield graph.best(part.column(0), part.column(1).to_numpy(), bounds, part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy())

    return postings.mapInArrow(rows, f"item_id {item_kind}, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents of score above 0, equal scores by ascending document id (null last).

    Terms are the longest runs of 0-9, A-Z, a-z and characters beyond ASCII, A-Z in lower case. With N the documents that hold a term, L all terms with their repeats,
    n a document's terms, df the documents that hold a term and tf its occurrences there: w = floor(1000 * ln((2N + 2) / (2df + 1))),
    m = 10 + 90nN div L, and a score is the sum of w * (1000000000tf div (1000tf + 8m)) over the item's terms, once each.

    Null and empty texts have no terms: such documents count for nothing, such items have no result. Every row of ``docs`` is a document, also repeated
    ones and those without an id. Rows of ``items`` with one id (null too) are one item with the terms of all. Only the named columns are read. Empty tables give
    an empty result.
    """
    spark = docs.sparkSession
    item_kind, doc_kind = items.schema[item_id].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
    wanted = written(item_terms(items, item_id, text_col), "item-terms")
    size = wanted.agg(F.count(F.lit(1)).alias("terms"), F.countDistinct(F.struct("item")).alias("items")).first()
    blocks = max(-(-size.terms // TERMS), -(-size.items // ITEMS))
    out = []
    if blocks:
        block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block")
        plans = written(wanted.select(block, "item", "key").groupBy("block").applyInArrow(_plan, _PLAN.format(item=item_kind)), "graphs")
        for number in [r.block for r in plans.select("block").orderBy("block").collect()]:
            plan = plans.where(F.col("block") == number).toArrow()
            names = plan["items"].combine_chunks().flatten()
            plan = plan.drop_columns(["items"]).to_pylist()[0]
            keys = np.array(plan["keys"], np.int64).view(np.uint64)
            postings = written(_postings(docs, keys, doc_id, text_col), "postings")
            all_docs = postings.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
            if not all_docs.terms:
                break
            held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            weight = np.zeros(len(keys), np.int64)
            w = F.floor(1000 * F.log(F.lit(2.0 * all_docs.docs + 2) / (2.0 * F.col("df") + 1)))
            for r in held.select("term", w.cast("long").alias("w")).collect():  # at most one row for each term of the block
                weight[r.term] = r.w
            out.append(_ranked(postings, Graph(plan, names, weight, all_docs.docs, all_docs.terms, k), item_kind))
    if not out:
        return spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score long")
    order = W.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, out).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
