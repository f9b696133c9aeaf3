"""Shared scratch space for written tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}  # application id to its temporary folder


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where it is unset and Spark runs on this one machine is a temporary folder made.
    """
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="codeframe-")
    return _own[context.applicationId]


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
