import gzip
import resource
import zipfile

import pytest
from pyspark.sql import functions as F

from codeframe.sources import archive, files


def rows_of(df):
    return sorted((r["bundle"].rsplit("/", 1)[1], r["file"], r["line_no"], bytes(r["raw"])) for r in df.collect())


def test_a_task_for_each_member(spark, tmp_path):
    path = str(tmp_path / "three.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i in range(3):
            z.writestr(f"m{i}.csv", "".join(f"{i},{j}\n" for j in range(20_000)))
        z.writestr("other.txt", "left alone\n")
    df = files.member_lines(spark, path, ["m0.csv", "m1.csv", "m2.csv", "absent.csv"])
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("file").alias("files"), F.count("*").alias("n")).collect()
    assert sorted((r["files"], r["n"]) for r in tasks) == [(1, 20_000)] * 3
    assert df.where("line_no = 20000").count() == 3


@pytest.mark.parametrize("content,lines", [
    (b"", []), (b"\n", [b""]), (b"a", [b"a"]), (b"a\nb\n", [b"a", b"b"]), (b"a\r\n\r\nb", [b"a", b"", b"b"]), (b"\n\na", [b"", b"", b"a"]),
    (b"x" * 70 + b"\n" + b"y" * 31, [b"x" * 70, b"y" * 31]), (b"caf\xe9\n\xff\n", [b"caf\xe9", b"\xff"])])
@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_lines(tmp_path, content, lines, piece):
    path = str(tmp_path / "a.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("plain.dat", content)
        z.writestr("packed.dat.gz", gzip.compress(content))
    for name in ("plain.dat", "packed.dat.gz"):
        batches = list(archive.member_batches(path, name, piece))
        assert [x for b in batches for x in b.column(3).to_pylist()] == lines
        assert [x for b in batches for x in b.column(2).to_pylist()] == list(range(1, len(lines) + 1))
    assert archive.peek(path, "plain.dat", 1) == lines[:1]


def test_memory_does_not_grow_with_a_member(tmp_path):
    path = str(tmp_path / "big.zip")
    line = b"0123456789" * 20 + b"\n"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("big.dat", "w") as out:
        for _ in range(400):
            out.write(line * 5000)  # 400 MB
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    total = sum(b.num_rows for b in archive.member_batches(path, "big.dat"))
    assert total == 2_000_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000  # kB


def test_written_by_tasks_and_read_back(spark, tmp_path):
    df = spark.range(1000).select(F.concat(F.lit("b"), F.col("id") % 7, F.lit(".zip")).alias("bundle"), F.concat(F.lit("f"), F.col("id"), F.lit(".txt")).alias("file"),
                                  F.when(F.col("id") % 10 > 0, F.concat(F.lit("line "), F.col("id"), F.lit("\nmore"))).alias("content"))
    folder = str(tmp_path / "out")
    assert archive.write_archives(df, folder) == 1000
    listed = files.archive_members(spark, folder)
    assert listed.count() == 1000 and listed.select("bundle").distinct().count() == 7
    got = rows_of(files.member_lines(spark, folder, ["f13.txt", "f20.txt", "f700.txt"]))
    assert got == [("b6.zip", "f13.txt", 1, b"line 13"), ("b6.zip", "f13.txt", 2, b"more")]
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == [f"b{i}.zip" for i in range(7)]
    every = files.member_lines(spark, folder)
    assert every.select("bundle", "file").distinct().count() == 900 and every.rdd.getNumPartitions() < 100  # empty members have no lines
    assert archive.write_archives(df.limit(0), str(tmp_path / "none")) == 0


def test_unpacked_text_is_one_file(spark, tmp_path):
    path = str(tmp_path / "c.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("book.txt", "\n".join(f"line {i}" for i in range(30_000)))
    out = files.unpack_text(spark, path, "book.txt")
    assert [r.value for r in spark.read.text(out).collect()] == [f"line {i}" for i in range(30_000)]


def test_file_systems():
    assert archive.can_open("/a/b.zip") and archive.can_open("file:///a/b.zip") and not archive.can_open("nosuch://a/b.zip")


def test_a_task_reads_the_directory_once(tmp_path, monkeypatch):
    path = str(tmp_path / "many.zip")
    with zipfile.ZipFile(path, "w") as z:
        for i in range(2500):
            z.writestr(f"m{i}.csv", f"{i}\nb{i}")
    opened = []
    plain = archive.open_archive
    monkeypatch.setattr(archive, "open_archive", lambda p: opened.append(p) or plain(p))
    reader = archive._Reader({"paths": f'["{path}"]', "members": "null", "tasks": "1"})
    parts = reader.partitions()
    opened.clear()
    batches = [b for p in parts for b in reader.read(p)]
    assert len(opened) == len(parts) and len(batches) < 10 * len(parts)
    rows = [(r["file"], r["line_no"], r["raw"]) for b in batches for r in b.to_pylist()]
    assert rows == [(f"m{i}.csv", j + 1, x.encode()) for i in range(2500) for j, x in enumerate((str(i), f"b{i}"))]
