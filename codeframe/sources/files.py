"""Finding data files: path fallbacks, extensions, bundle listings."""

from __future__ import annotations

import gzip
import io
import os
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..select import Selection, pick, row_condition
from . import archive
from .scratch import scratch_path

# Endings tried for a missing data file, and what bundle members count as.
FALLBACK_EXTENSIONS = (".dat.gz", ".csv", ".csv.gz")
DATA_PATTERN = r"\.(dat|csv)(\.gz)?$"
SHAPE_PATTERN = r"\.(zip|shp)$"
RASTER_PATTERN = r"\.tiff$"
TYPES = {"data": DATA_PATTERN, "shape": SHAPE_PATTERN, "raster": RASTER_PATTERN}


def file_ext(path: str) -> str:
    """Extension with its dot; ".gz" counts together with the one before it."""
    stem, ext = os.path.splitext(path)
    if ext == ".gz":
        return os.path.splitext(stem)[1] + ext
    return ext


def strip_ext(path: str) -> str:
    ext = file_ext(path)
    return path[: -len(ext)] if ext else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the path exist on whatever file system it names?"""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(jpath)


def resolve_data_file(spark: SparkSession, path: str, fallbacks=FALLBACK_EXTENSIONS) -> str:
    """The path itself or, if it is missing, the same name with another data ending."""
    path = path.rstrip("/")
    tried = [path, *[strip_ext(path) + e for e in fallbacks]]
    for p in tried:
        if path_exists(spark, p):
            return p
    raise FileNotFoundError(f"no data file at {path}, nor with another data ending")


def _zip_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members by archive, from their directories alone."""
    for pdf in batches:
        yield pd.DataFrame([(path, name) for path in pdf["path"] for name in archive.directory(path)], columns=["bundle", "file"])


def _zip_members_of_content(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(path, name)
                for path, content in zip(pdf["path"], pdf["content"])
                for name in zipfile.ZipFile(io.BytesIO(content)).namelist() if not name.endswith("/")]
        yield pd.DataFrame(rows, columns=["bundle", "file"])


def _listed(zips: DataFrame, path: str) -> DataFrame:
    """``(bundle, file)`` of archives; whole archives are read only from file systems that Spark alone can open."""
    if archive.can_open(path):
        return zips.select("path").mapInPandas(_zip_members, "bundle string, file string")
    return zips.select("path", "content").mapInPandas(_zip_members_of_content, "bundle string, file string")


def bundle_members(spark: SparkSession, path: str) -> DataFrame:
    """``(bundle, file)``: members of a zip archive or a folder of archives, or the files of a
    folder without archives (contents are not read for these)."""
    if file_ext(path) == ".zip":
        return _listed(spark.read.format("binaryFile").load(path), path)
    if file_ext(path) != "":
        raise ValueError(f"neither a folder nor a zip archive: {path}")
    names = spark.read.format("binaryFile").load(path).select("path")
    return names.select(F.lit(path).alias("bundle"), F.substring_index("path", "/", -1).alias("file"))


def archive_members(spark: SparkSession, folder: str) -> DataFrame:
    """``(bundle, file)`` for every zip archive in a folder, in one distributed pass."""
    return _listed(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder), folder)


def classify(members: DataFrame) -> DataFrame:
    """Add ``type`` (data, shape, raster); other members are dropped."""
    kind = None
    for name, pattern in TYPES.items():
        hit = F.col("file").rlike(pattern)
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    return members.withColumn("type", kind).filter(F.col("type").isNotNull()).select("type", *members.columns)


def list_files(spark: SparkSession, path: str, types: list[str] | None = None, data_layer: Selection = None,
               shape_layer: Selection = None, raster_layer: Selection = None) -> DataFrame:
    """``(type, file)`` of a bundle; only the types asked for."""
    layers = {"data": data_layer, "shape": shape_layer, "raster": raster_layer}
    found = classify(bundle_members(spark, path)).select("type", "file")
    keep = None
    for t in types or list(TYPES):
        cond = F.col("type") == t
        if layers[t] is not None:
            cond = cond & row_condition(F.col("file"), layers[t])
        keep = cond if keep is None else keep | cond
    return found.filter(keep)


def list_data(spark: SparkSession, path: str, data_layer: Selection = None) -> DataFrame:
    return list_files(spark, path, ["data"], data_layer=data_layer).select("file")


def list_shape(spark: SparkSession, path: str, shape_layer: Selection = None) -> DataFrame:
    return list_files(spark, path, ["shape"], shape_layer=shape_layer).select("file")


def list_raster(spark: SparkSession, path: str, raster_layer: Selection = None) -> DataFrame:
    return list_files(spark, path, ["raster"], raster_layer=raster_layer).select("file")


def find_files(spark: SparkSession, path: str, extension: str | None = None, selection: Selection = None,
               multiple_ok: bool = False) -> list[str]:
    """Names of the bundle members with an extension (a regular expression) and a selection."""
    names = [r["file"] for r in bundle_members(spark, path).collect()]
    if extension is not None:
        names = [n for n in names if re.search(rf"\.{extension}$", n)]
    if selection is not None:
        names = pick(names, selection)
    if not multiple_ok and len(names) > 1:
        raise ValueError("several files fit, select one: " + ", ".join(names))
    return names


def _extract(wanted: set[str] | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if name.endswith("/") or (wanted is not None and name not in wanted):
                            continue
                        with z.open(name) as member:
                            f = gzip.open(member) if name.endswith(".gz") else member
                            n = 0
                            rows: list[tuple] = []
                            for raw in f:
                                n += 1
                                rows.append((path, name, n, raw.rstrip(b"\r\n")))
                                if len(rows) >= 10_000:
                                    yield pd.DataFrame(rows, columns=["bundle", "file", "line_no", "raw"])
                                    rows = []
                            if rows:
                                yield pd.DataFrame(rows, columns=["bundle", "file", "line_no", "raw"])
    return run


def member_lines(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """``(bundle, file, line_no, raw)``: lines of archive members (None: all) as bytes, one task a member, or for several small ones.

    ``path`` is an archive or a folder of archives. On a file system that Python cannot open, Spark reads archives whole, which
    limits each to 2 GB.
    """
    if archive.can_open(path):
        found = [path] if file_ext(path) == ".zip" else [
            r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path").orderBy("path").toLocalIterator()]
        return archive.lines(spark, found, names)
    zips = spark.read.format("binaryFile").load(path).select("path", "content")
    return zips.mapInPandas(_extract(None if names is None else set(names)), "bundle string, file string, line_no bigint, raw binary")


def unpack_text(spark: SparkSession, path: str, member: str) -> str:
    """Write one text member (a codebook) of an archive to the scratch folder; returns its path.

    Its bytes stay as they are. One member is one file, written by one task as it is read.
    """
    target = scratch_path(spark, "member")
    member_lines(spark, path, [member]).select(F.col("raw").cast("string").alias("value")).write.text(target)
    return target


def is_bundle(path: str) -> bool:
    """A zip archive or a folder."""
    return file_ext(path) in (".zip", "")
