"""Files that keep arriving: running tabulations and chunked loads with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..codebook import Codebook
from ..metadata import ALL_ATTRS, all_meta, q, with_meta
from ..operators.labels import set_attributes
from ..session import tune
from ..sources.micro import cut_lines
from ..sources.scratch import scratch_path


def stream_micro(spark: SparkSession, codebook: Codebook, folder: str, files_per_trigger: int = 1000,
                 var_attrs=ALL_ATTRS) -> DataFrame:
    """Fixed-width files of a folder as a stream of labelled rows."""
    tune(spark)
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(folder)
    return set_attributes(cut_lines(lines, codebook), codebook, var_attrs)


def stream_table(spark: SparkSession, schema: T.StructType, path: str, file_format: str = "parquet",
                 files_per_trigger: int = 1000, **options) -> DataFrame:
    """Columnar or CSV files of a folder as a stream."""
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def running_tabulation(stream: DataFrame, by: Sequence[str], aggs: dict[str, Column], target: str | None = None,
                       checkpoint: str | None = None) -> DataFrame:
    """Merge the counts and sums of arriving pieces into running totals; read back the last state.

    State is one row per group; partial aggregation runs before the state's shuffle. Each
    trigger writes the totals to its own folder, which makes a replayed trigger harmless.
    Runs until all present files are taken (``availableNow``); call again on the same
    ``checkpoint`` and ``target`` to add files that came later.
    """
    spark = stream.sparkSession
    target = target or scratch_path(spark, "running")
    checkpoint = checkpoint or scratch_path(spark, "running-checkpoint")
    totals = stream.groupBy(*[q(c) for c in by]).agg(*[a.alias(n) for n, a in aggs.items()])
    schema = totals.schema

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/trigger_no={batch_id}")

    run = (totals.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
           .foreachBatch(save).trigger(availableNow=True).start())
    run.awaitTermination()
    last = spark.read.parquet(target).agg(F.max("trigger_no")).first()[0]
    state = spark.read.schema(schema).parquet(f"{target}/trigger_no={last}")
    return with_meta(state, {c: m for c, m in all_meta(stream).items() if c in by})


def load_stream(stream: DataFrame, table: str, checkpoint: str | None = None, is_path: bool = True,
                prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Load arriving pieces into a table: created by the first piece, appended to after.

    A path is written by the streaming file sink, which is exactly-once; a catalog table is
    appended to per batch.
    """
    checkpoint = checkpoint or scratch_path(stream.sparkSession, "load-checkpoint")
    out = prepare(stream) if prepare else stream
    writer = out.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if is_path:
        return writer.format("parquet").outputMode("append").start(table)
    return writer.outputMode("append").toTable(table)


def load_rows(df: DataFrame, table: str, is_path: bool = True) -> None:
    """The batch form: one distributed append, no chunks needed.

    Not for a path that a stream loads: the stream's own log decides what counts there.
    """
    writer = df.write.mode("append")
    writer.parquet(table) if is_path else writer.saveAsTable(table)
