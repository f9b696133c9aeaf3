"""Zip archives as a source: planned from their central directory, read member by member as a stream.

A listing reads the directory at the end of an archive only. Reading makes one task for each member, which seeks to it and inflates it in pieces, so neither
the size of an archive nor that of a member is held in memory. Archives are opened by ``pyarrow.fs``, in local and shared folders and in the object stores and file systems it knows.
"""

from __future__ import annotations

import gzip
import json
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes that are inflated at once, and about the size of a batch of lines.
PIECE = 1 << 20
#: Small members whose lines go into one batch.
MOST_HELD = 1000
LINES = "bundle string, file string, line_no bigint, raw binary"
_LINES = pa.schema([("bundle", pa.string()), ("file", pa.string()), ("line_no", pa.int64()), ("raw", pa.binary())])


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it; ValueError if Python knows no such one."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    try:
        return fs.FileSystem.from_uri(path)
    except pa.ArrowInvalid as why:
        raise ValueError(f"no file system for {path}: {why}") from why


def can_open(path: str) -> bool:
    """Is there a file system for the path?"""
    try:
        file_system(path)
    except (ValueError, OSError):
        return False
    return True


def open_archive(path: str) -> zipfile.ZipFile:
    """An archive, of which only the directory is read."""
    system, inner = file_system(path)
    return zipfile.ZipFile(system.open_input_file(inner))


def directory(path: str) -> list[str]:
    """Names of an archive's members, in its order; folders are left out."""
    with open_archive(path) as z:
        return [n for n in z.namelist() if not n.endswith("/")]


def member_batches(path: str, name: str, piece: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Lines of one member as bytes, without their line ends, in batches of about ``piece`` bytes. A member that ends in ".gz" is unpacked twice."""
    with open_archive(path) as z:
        yield from _batches(z, path, name, piece)


def _batches(z: zipfile.ZipFile, path: str, name: str, piece: int) -> Iterator[pa.RecordBatch]:
    with z.open(name) as member:
        stream = gzip.open(member) if name.endswith(".gz") else member
        rest, number = [], 0
        while True:
            data = stream.read(piece)
            lines = data.split(b"\n")
            rest.append(lines[0])
            if len(lines) == 1 and data:
                continue  # a line longer than a piece
            lines[0] = b"".join(rest)
            rest = [lines.pop()] if data else []
            if not data and lines == [b""]:
                return
            lines = [x.rstrip(b"\r") for x in lines]
            if lines:
                count = len(lines)
                yield pa.RecordBatch.from_arrays([pa.array([path] * count, pa.string()), pa.array([name] * count, pa.string()),
                                                  pa.array(range(number + 1, number + count + 1), pa.int64()), pa.array(lines, pa.binary())], schema=_LINES)
                number += count
            if not data:
                return


def peek(path: str, name: str, n: int = 1) -> list[bytes]:
    """The first lines of a member; no more of it is read than they take."""
    out: list[bytes] = []
    for batch in member_batches(path, name, 1 << 14):
        out += batch.column(3).to_pylist()
        if len(out) >= n:
            break
    return out[:n]


class Members(InputPartition):
    """Some members of one archive."""

    def __init__(self, path: str, names: list[str]):
        super().__init__(None)
        self.path, self.names = path, names


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.paths = json.loads(options["paths"])
        names = json.loads(options["members"])
        self.names = None if names is None else set(names)
        self.tasks = int(options.get("tasks", "1000"))

    def partitions(self) -> list[Members]:
        found = []
        for path in self.paths:
            with open_archive(path) as z:
                found += [(path, i.filename, i.file_size) for i in z.infolist() if not i.is_dir() and (self.names is None or i.filename in self.names)]
        share = min(sum(size for *_, size in found) / self.tasks, PIECE * 64)
        out: list[Members] = []
        held = 0.0
        for path, name, size in found:
            if not out or held + size > share or out[-1].path != path:
                out.append(Members(path, []))
                held = 0
            out[-1].names.append(name)
            held += size
        return out

    def read(self, partition: Members) -> Iterator[pa.RecordBatch]:
        names = getattr(partition, "names", ())
        if not names:
            return
        # the directory is read once a task, not once a member; small members share a batch
        held, size = [], 0
        with open_archive(partition.path) as z:
            for name in names:
                for batch in _batches(z, partition.path, name, PIECE):
                    held.append(batch)
                    size += batch.nbytes
                    if size >= PIECE or len(held) >= MOST_HELD:
                        yield pa.concat_batches(held)
                        held, size = [], 0
        if held:
            yield pa.concat_batches(held)


class ArchiveLines(DataSource):
    """``spark.read.format("codeframe_archive")``: options ``paths`` and ``members`` (JSON lists of text; null: all members) and ``tasks``, about how many to make at least."""

    @classmethod
    def name(cls) -> str:
        return "codeframe_archive"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def lines(spark: SparkSession, paths: list[str], names: list[str] | None = None) -> DataFrame:
    """``(bundle, file, line_no, raw)`` of the members of these names (None: of all) in all archives. Members that an archive lacks give none.

    A member is one task's; small members of an archive share a task where there are many more than the cluster can run.
    """
    spark.dataSource.register(ArchiveLines)
    wanted = None if names is None else sorted(set(names))
    reader = spark.read.format("codeframe_archive").option("paths", json.dumps(paths)).option("members", json.dumps(wanted))
    return reader.option("tasks", str(4 * spark.sparkContext.defaultParallelism)).load()


def write_archives(members: DataFrame, folder: str) -> int:
    """Write ``(bundle, file, content)`` as one zip archive a bundle below the folder; returns how many members were written.

    Each task writes the archives of its bundles one member after the other, so it holds no more than a batch of rows. An archive gets its name when it is whole, and a
    repeated task replaces it by the same one.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        system, inner = file_system(folder)
        name, archive, sink, part, count = None, None, None, None, 0
        for batch in batches:
            for bundle, file, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bundle != name:
                    if archive is not None:
                        _close(system, archive, sink, part, f"{inner}/{name}")
                    name, part = bundle, f"{inner}/_{uuid.uuid4().hex}"
                    sink = system.open_output_stream(part)
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                archive.writestr(zipfile.ZipInfo(file), content or b"", zipfile.ZIP_DEFLATED)
                count += 1
        if archive is not None:
            _close(system, archive, sink, part, f"{inner}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["n"])

    system, inner = file_system(folder)
    system.create_dir(inner, recursive=True)
    slim = members.select("bundle", "file", members["content"].cast("binary").alias("content"))
    done = slim.repartition("bundle").sortWithinPartitions("bundle", "file").mapInArrow(rows, "n long")
    return done.groupBy().sum("n").first()[0] or 0


def _close(system: fs.FileSystem, archive: zipfile.ZipFile, sink, part: str, target: str) -> None:
    archive.close()
    sink.close()
    system.move(part, target)
