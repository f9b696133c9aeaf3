"""Session settings that suit the library. All are ordinary Spark settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # The JVM leaves methods above 8,000 bytes of code uncompiled. Wide fixed-width cuts generate
    # such methods; with this limit Spark takes its split, compilable form instead (3 to 100 times
    # faster from about 30 columns on).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Give a session that was built elsewhere the run-time setting that wide projections need.

    Readers, type guesses and regressions call this: it only lowers the limit to what
    Spark's own documentation recommends for HotSpot.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(SETTINGS[key]):
        spark.conf.set(key, SETTINGS[key])
    return spark


def sized_settings(input_bytes: int, shuffled_share: float = 0.3, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition settings for an input: reads of at least 128 MB, shuffles in pieces of about
    ``partition_bytes`` that fit an executor's memory share. AQE merges pieces that stay small.
    """
    split = min(max(128 << 20, input_bytes // 500_000), 1 << 30)
    pieces = max(200, -(-int(input_bytes * shuffled_share) // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(min(pieces, 200_000)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }


def build_session(master: str | None = None, app: str = "codeframe", **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use "__" for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    for k, v in settings.items():
        builder = builder.config(k.replace("__", "."), str(v))
    return builder.getOrCreate()
