"""Blocks of vectors: every block of queries meets every block of rows in a task of its own.

Work grows with queries times rows, as an exact search must; a task holds one block of each, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

ROWS_PER_BLOCK = 65_536
QUERIES_PER_BLOCK = 512


def usable(table: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(id, v, dim): rows with an id and a vector of finite components; ``zero``: also those that are all 0.

    Vectors that are null, empty or hold a null, NaN or infinite component are left out.
    """
    kind = table.schema[vector_col].dataType.simpleString()
    v = F.col(vector_col) if kind in ("array<float>", "array<double>") else F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where((F.size("v") > 0) & F.coalesce(fine, F.lit(False)))
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.withColumn("dim", F.size("v"))


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    """A list column of equally long lists as a matrix of doubles."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search(rows: DataFrame, queries: DataFrame, best: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple], k: int, kind: str,
           rows_per_block: int = ROWS_PER_BLOCK, queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each query, ties to the smaller id; a query's own id is never among them.

    ``rows`` and ``queries`` have (id, v, dim); only vectors of equal length meet. ``best(row ids in order, row vectors, query ids, query
    vectors)`` gives (position of the query, row id, score) of at least the k best rows of a block for each query, or all.
    Of an id that stands on several rows, every row is a candidate, and the first vector in order is the query.
    """
    asked = queries.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    counts = {r["dim"]: r for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return rows.sparkSession.createDataFrame([], f"query_id long, rank int, vec_id long, score {kind}")
    most, many = max(r["n"] for r in counts.values()), asked.count()
    row_blocks, query_blocks = max(1, -(-most // rows_per_block)), max(1, -(-many // queries_per_block))
    left = rows.select("id", "v", "dim", F.pmod(F.xxhash64("id"), F.lit(row_blocks)).cast("int").alias("rb"),
                       F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    right = asked.select("id", "v", "dim", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb"),
                         F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))
    out_kind = pa.int64() if kind == "long" else pa.float64()

    def block(a: pa.Table, b: pa.Table) -> pa.Table:
        q, i, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(a) and len(b):
            dim = a["dim"][0].as_py()
            ids, qids = a["id"].to_numpy(), b["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            at, i, s = best(ids[order], matrix(a["v"], dim)[order], qids, matrix(b["v"], dim))
            q = qids[at]
        return pa.Table.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, out_kind)], names=["query_id", "vec_id", "score"])

    keys = ["dim", "rb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(block, f"query_id long, vec_id long, score {kind}")
    first = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

