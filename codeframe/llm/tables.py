"""Small helpers that the operators share: written tables, column clashes, work sizes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeframe.sources.scratch import scratch_path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of a query that runs in here when it ends, not when the driver next happens to collect garbage."""
    was = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if was is None else spark.conf.set(_CLEANUP, was)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the folder of ``spark.checkpoint.dir``, read back.

    This cuts the lineage: a lost executor costs a re-read, not a recomputation of all that came before. Tables of texts
    stay until a later step has been written, so they are packed tighter than by default.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned. All that reads them must be written itself."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(spark: SparkSession, amount: float, each: float) -> int:
    """Into how many partitions ``amount`` of work goes if one should hold about ``each``; never fewer than Spark's own number."""
    return int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-amount // each), 1))


def running_total(df: DataFrame, group: str, order: list[str], value: str, rows_per_bucket: int, key: str) -> DataFrame:
    """``df`` with ``before``: the sum of ``value`` over earlier rows of the group, without one task per group.

    Rows fall into buckets by ``key`` (a long that is spread evenly and sorts first in ``order``); bucket totals are
    summed up on a table of buckets, and a window runs inside a bucket only. Buckets hold about ``rows_per_bucket`` rows
    however many rows a group has. ``key`` must lie in [0, 2**31).
    """
    from pyspark.sql.window import Window as W

    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("__rows"))
    cut = F.greatest(F.lit(1), F.ceil(F.col("__rows") / F.lit(rows_per_bucket))).cast("long")
    sized = counts.select(F.col(group).alias("__g"), cut.alias("__cut"))
    rows = (df.join(sized, F.col(group).eqNullSafe(F.col("__g")))
            .withColumn("__bucket", F.shiftright(F.col(key) * F.col("__cut"), 31)).drop("__g", "__cut"))
    totals = rows.groupBy(group, "__bucket").agg(F.sum(value).alias("__sum"))
    start = F.sum("__sum").over(W.partitionBy(group).orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1))
    starts = totals.select(F.col(group).alias("__g"), F.col("__bucket").alias("__b"), F.coalesce(start, F.lit(0)).alias("__start"))
    inside = F.sum(value).over(W.partitionBy(group, "__bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return (rows.join(starts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__bucket") == F.col("__b")))
            .withColumn("before", F.col("__start") + F.coalesce(inside, F.lit(0)))
            .drop("__g", "__b", "__bucket", "__start"))
