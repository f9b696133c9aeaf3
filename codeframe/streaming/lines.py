"""A sparse index of line places, and reads of line ranges by it.

One pass counts the lines of byte ranges of the files and keeps the byte offset of every ``step``-th line. With the counts summed up this is a small table
(file, offset, line number), stored as Parquet and used as long as the files are the same. A range of lines is then read by seeking: only the bytes between the
two index entries around it are read, by as many tasks as there is work for.

Lines end with LF, CR LF or CR, as for Spark's text source. Files follow each other by name. Compressed files have no places to seek to and are refused.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..sources.archive import file_system
from ..sources.scratch import scratch_path

STEP = 10_000
#: Bytes of a file that one task counts or reads; bytes held at once.
RANGE = 64 << 20
PIECE = 4 << 20
_COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")


def _starts(data: np.ndarray, after: int) -> np.ndarray:
    """Places in ``data`` after line ends; ``after`` is the byte that follows (-1: none)."""
    following = np.append(data[1:], after) if len(data) else data
    ends = (data == 10) | ((data == 13) & (following != 10))
    return np.flatnonzero(ends) + 1


def count_range(path: str, start: int, end: int, step: int) -> tuple[int, list[tuple[int, int]], bool]:
    """(line ends in a byte range, [(offset, rank)], whether its last byte ends a line): the places behind the first line end and every ``step``-th, with their number up to there."""
    system, inner = file_system(path)
    count, points, ended = 0, [], True
    with system.open_input_file(inner) as f:
        f.seek(start)
        at, data = start, f.read(min(PIECE, end - start))
        while data:
            later = f.read(min(PIECE, end - at - len(data)) or 1)  # the byte behind the range decides on a CR at its end
            places = _starts(np.frombuffer(data, np.uint8), later[0] if later else -1)
            ranks = np.arange(count + 1, count + len(places) + 1)
            keep = (ranks == 1) | (ranks % step == 0)
            points += list(zip((places[keep] + at).tolist(), ranks[keep].tolist()))
            count += len(places)
            at += len(data)
            ended = len(places) > 0 and int(places[-1]) == len(data)
            data = later if at < end else b""
    return count, points, ended


def line_batches(path: str, start: int, end: int, first: int, piece: int = PIECE) -> Iterator[pa.RecordBatch]:
    """(value, row_no) of the lines that lie in a byte range from a line's start on; the first has the number ``first``."""
    system, inner = file_system(path)
    with system.open_input_file(inner) as f:
        f.seek(start)
        left, rest = end - start, b""
        while left > 0 or rest:
            more = f.read(min(piece, left)) if left > 0 else b""
            left = left - len(more) if more else 0
            data = rest + more
            places = _starts(np.frombuffer(data, np.uint8), -1)
            if left > 0 and len(places) and places[-1] == len(data) and data[-1] == 13:
                places = places[:-1]  # an LF may follow
            cuts = places.tolist()
            if left <= 0 and (not cuts or cuts[-1] < len(data)):
                cuts.append(len(data))
            lines = [data[a:b] for a, b in zip([0, *cuts[:-1]], cuts)]
            rest = data[cuts[-1]:] if cuts else data
            if left <= 0:
                rest = b""
            if lines:
                stripped = [x[:-2] if x.endswith(b"\r\n") else x[:-1] if x[-1:] in (b"\n", b"\r") else x for x in lines]
                yield pa.RecordBatch.from_arrays([pa.array(stripped, pa.binary()), pa.array(range(first, first + len(lines)), pa.int64())], names=["value", "row_no"])
                first += len(lines)


class _Part(InputPartition):
    def __init__(self, cells: list):
        super().__init__(None)
        self.cells = cells


class _CountReader(DataSourceReader):
    def __init__(self, options):
        self.files, self.size, self.step = json.loads(options["files"]), int(options["size"]), int(options["step"])

    def partitions(self) -> list[_Part]:
        return [_Part([path, a, min(a + self.size, length), length]) for path, length in self.files for a in range(0, length, self.size)]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        cells = getattr(partition, "cells", None)
        if cells:
            path, start, end, length = cells
            n, points, ended = count_range(path, start, end, self.step)
            n += end == length and not ended  # a last line without an end
            points = [(o, r) for o, r in points if o < length]
            kind = pa.list_(pa.struct([("offset", pa.int64()), ("rank", pa.int64())]))
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([start], pa.int64()), pa.array([n], pa.int64()),
                                              pa.array([[{"offset": o, "rank": r} for o, r in points]], kind)], names=["file", "start", "n", "points"])


class LineCounts(DataSource):
    """Line ends of byte ranges of files: options ``files`` (JSON list of path and size), ``size`` and ``step``."""

    @classmethod
    def name(cls) -> str:
        return "codeframe_line_counts"

    def schema(self) -> str:
        return "file string, start bigint, n bigint, points array<struct<offset: bigint, rank: bigint>>"

    def reader(self, schema) -> DataSourceReader:
        return _CountReader(self.options)


class _RangeReader(DataSourceReader):
    def __init__(self, options):
        self.ranges = json.loads(options["ranges"])

    def partitions(self) -> list[_Part]:
        return [_Part(r) for r in self.ranges] or [_Part([])]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        cells = getattr(partition, "cells", None)
        if cells:
            yield from line_batches(*cells)


class LineRanges(DataSource):
    """Lines of byte ranges: option ``ranges``, a JSON list of (path, start, end, number of the first line)."""

    @classmethod
    def name(cls) -> str:
        return "codeframe_line_ranges"

    def schema(self) -> str:
        return "value binary, row_no bigint"

    def reader(self, schema) -> DataSourceReader:
        return _RangeReader(self.options)


def files_of(path: str | list[str]) -> list[tuple[str, int]]:
    """(path, size) of the data files at a path, by name; hidden files and those that begin with "_" are none."""
    out = []
    for p in [path] if isinstance(path, str) else path:
        system, inner = file_system(p)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(p)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True))
        prefix = p[: -len(inner)] if p.endswith(inner) else ""
        out += [(prefix + i.path, i.size) for i in found if i.type == fs.FileType.File and not any(x[:1] in ("_", ".") for x in i.path[len(inner):].split("/"))]
        if info.type == fs.FileType.File:
            out[-1] = (p, info.size)
    packed = [p for p, _ in out if p.endswith(_COMPRESSED)]
    if packed:
        raise ValueError(f"compressed files have no line places to seek to: {packed[0]}")
    return sorted(out)


def _before(df: DataFrame, value: str) -> DataFrame:
    """``df`` (file, start, value) with ``before``: the sum over all earlier rows, within each file by a window over its rows and over files by one row each."""
    inside = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    files = df.groupBy(F.col("file").alias("f")).agg(F.sum(value).alias("in_file")).select("f", F.coalesce(F.sum("in_file").over(over), F.lit(0)).alias("earlier"))
    out = df.withColumn("here", F.coalesce(F.sum(value).over(inside), F.lit(0))).join(files, F.col("file") == F.col("f"))
    return out.withColumn("before", F.col("here") + F.col("earlier")).drop("here", "earlier", "f")


@dataclass
class LineIndex:
    """Where every ``step``-th line of some files begins. ``table`` has (line_no, file, offset), by line number."""

    spark: SparkSession
    files: list[tuple[str, int]]
    step: int
    total: int
    table: DataFrame
    path: str

    def ranges(self, lo: int, hi: int, size: int = RANGE) -> list[list[Any]]:
        """Byte ranges that hold the lines ``lo`` to ``hi`` (from 1), as (path, start, end, number of the first line), of about ``size`` bytes at most."""
        lo, hi = max(lo, 1), min(hi, self.total)
        if lo > hi:
            return []
        # neighbouring entries are at most ``step`` lines apart: a pull collects about one entry for each ``step`` lines of it
        near = self.table.where(F.col("line_no").between(lo - self.step, hi + self.step)).orderBy("line_no").collect()
        sizes = dict(self.files)
        out: list[list[Any]] = []
        for a, b in zip(near, [*near[1:], None]):
            end = b.offset if b is not None and b.file == a.file else sizes[a.file]
            if (b is not None and b.line_no <= lo) or a.line_no > hi or end <= a.offset:
                continue
            last = out[-1] if out else None
            if last and last[0] == a.file and last[2] == a.offset and end - last[1] <= size:
                last[2] = end
            else:
                out.append([a.file, a.offset, end, a.line_no])
        return out

    def lines(self, lo: int, hi: int) -> DataFrame:
        """(value, row_no) of the lines ``lo`` to ``hi``; values are bytes."""
        self.spark.dataSource.register(LineRanges)
        df = self.spark.read.format("codeframe_line_ranges").option("ranges", json.dumps(self.ranges(lo, hi))).load()
        return df.where(F.col("row_no").between(lo, hi))


def build_line_index(spark: SparkSession, path: str | list[str], where: str | None = None, step: int = STEP, size: int = RANGE) -> LineIndex:
    """Index the lines of text files in one pass and store the index in the folder ``where`` (by default a scratch folder)."""
    files = files_of(path)
    spark.dataSource.register(LineCounts)
    where = where or scratch_path(spark, "lines")
    counts = spark.read.format("codeframe_line_counts").option("files", json.dumps(files)).option("size", str(size)).option("step", str(step)).load()
    counts.write.mode("errorifexists").parquet(f"{where}/counts")
    counts = spark.read.schema(counts.schema).parquet(f"{where}/counts")
    placed = _before(counts.select("file", "start", "n", "points"), "n")
    entries = placed.select("file", F.explode("points").alias("p"), "before").select((F.col("before") + F.col("p.rank") + 1).alias("line_no"), "file", F.col("p.offset").alias("offset"))
    heads = placed.where("start = 0").select((F.col("before") + 1).alias("line_no"), "file", F.lit(0).cast("bigint").alias("offset"))
    every = entries.unionByName(heads)
    every.repartitionByRange("line_no").sortWithinPartitions("line_no").write.mode("errorifexists").parquet(f"{where}/entries")
    total = counts.agg(F.sum("n")).first()[0] or 0
    head = {"files": files, "step": step, "total": total}
    spark.createDataFrame([(json.dumps(head),)], "value string").coalesce(1).write.mode("errorifexists").text(f"{where}/head")
    return open_line_index(spark, where)


def open_line_index(spark: SparkSession, where: str) -> LineIndex:
    """A stored index; an error if its files have another size now."""
    head = json.loads(spark.read.text(f"{where}/head").first()["value"])
    files = [(p, n) for p, n in head["files"]]
    for p, n in files:
        system, inner = file_system(p)
        if system.get_file_info(inner).size != n:
            raise ValueError(f"{p} changed since its lines were indexed")
    table = spark.read.schema("line_no bigint, file string, offset bigint").parquet(f"{where}/entries")
    return LineIndex(spark, files, head["step"], head["total"], table, where)


class LineReader:
    """Pull lines piece by piece, by byte ranges: ``pull(n)``, ``reset()``, ``is_done()``, ``position``, ``total``.

    ``make`` turns lines (value, row_no) into what a pull gives. Nothing is written for a pull, and it reads the bytes of its lines and of at most ``step`` lines before and after.
    """

    def __init__(self, index: LineIndex, make: Callable[[DataFrame], Any]):
        self.index, self._make = index, make
        self.total, self.position = index.total, 0

    def pull(self, n: int = STEP) -> Any:
        """The next n rows, or None when all have been read."""
        if self.is_done():
            return None
        lo, hi = self.position + 1, min(self.position + n, self.total)
        self.position = hi
        return self._make(self.index.lines(lo, hi).withColumn("value", F.col("value").cast("string")))

    def seek(self, position: int) -> None:
        """Go on after this many rows."""
        if not 0 <= position <= self.total:
            raise ValueError(f"position {position} is not within 0 and {self.total}")
        self.position = position

    def is_done(self) -> bool:
        return self.position >= self.total

    def reset(self) -> None:
        self.position = 0

    def __iter__(self) -> Iterator[Any]:
        while (part := self.pull()) is not None:
            yield part
