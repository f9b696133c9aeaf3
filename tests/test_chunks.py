import pandas as pd
import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe.codebook import Codebook, Variable
from codeframe.streaming import chunks

from test_codebook import write_xml
from test_micro import hier_lines


@pytest.fixture
def lines(spark, tmp_path):
    for name, lo, hi in (("a.txt", 0, 700), ("b.txt", 700, 1000)):
        (tmp_path / name).write_text("".join(f"{i:06d}\n" for i in range(lo, hi)))
    return str(tmp_path)


def test_row_numbers_follow_files_and_lines(spark, lines):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = cf.with_row_no(spark.read.text(lines))
        assert spark.read.text(lines).rdd.getNumPartitions() > 4
        bad = df.filter(F.col("value").cast("int") + 1 != F.col("row_no")).count()
        assert bad == 0 and df.count() == 1000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_chunk_map_sees_whole_chunks_in_order(spark, lines):
    df = cf.with_meta(cf.with_row_no(spark.read.text(lines)), {"value": cf.VarMeta("Line")})

    def f(rows, pos):
        assert rows.attrs["value"]["label"] == "Line"
        assert list(rows.columns) == ["value"] and int(rows["value"].iloc[0]) == pos - 1
        return pd.DataFrame({"pos": [pos], "n": [len(rows)]})

    got = sorted(map(tuple, cf.chunk_map(df, f, "pos bigint, n bigint", 300).collect()))
    assert got == [(1, 300), (301, 300), (601, 300), (901, 100)]
    kept = cf.chunk_list(df, f, "pos bigint, n bigint", 300)
    assert sorted(map(tuple, kept.collect())) == [(0, 1, 300), (1, 301, 300), (2, 601, 300), (3, 901, 100)]


def test_side_effects_stop(spark, lines, tmp_path):
    out = tmp_path / "seen"
    out.mkdir()
    folder = str(out)
    df = cf.with_row_no(spark.read.text(lines))

    def f(rows, pos):
        import os
        open(os.path.join(folder, str(pos)), "w").close()
        return pos < 301

    assert cf.chunk_side_effect(df, f, 100, wave=1) == 4
    assert sorted(int(p.name) for p in out.iterdir()) == [1, 101, 201, 301]
    assert cf.chunk_side_effect(df, lambda rows, pos: None, 100) == 10


def test_batch_map(spark, lines):
    got = cf.batch_map(spark.read.text(lines), lambda rows, i: rows[rows["value"] > "000990"], "value string")
    assert got.count() == 9


@pytest.fixture
def book(spark, tmp_path):
    folder = tmp_path / "h"
    folder.mkdir()
    path = write_xml(folder)
    (folder / "data.dat").write_bytes("\n".join(hier_lines(40)).encode("latin-1") + b"\n")
    return cf.read_codebook(spark, path)


def text(rows):
    return sorted(map(str, rows))


def test_chunked_equals_whole(spark, book):
    whole = cf.read_micro(spark, book).filter("STATEFIP = 2")

    def f(rows, pos):
        assert rows.attrs["STATEFIP"]["val_labels"][1] == {"val": 2, "lbl": "Alaska"}
        return rows[rows["STATEFIP"] == 2][["SERIAL", "HWTSUPP"]].astype({"SERIAL": "int32"})

    got = cf.read_micro_chunked(spark, book, f, "SERIAL int, HWTSUPP double", chunk_size=7)
    assert text(map(tuple, got.collect())) == text(map(tuple, whole.select("SERIAL", "HWTSUPP").collect()))
    assert cf.read_micro_chunked(spark, book, lambda rows, pos: None, chunk_size=20) == 4


def test_list_chunked(spark, book):
    def f(parts, pos):
        assert list(parts) == ["HOUSEHOLD", "PERSON"]
        assert list(parts["PERSON"].columns) == ["YEAR", "SERIAL", "INCTOT"]
        return pd.DataFrame({"h": [len(parts["HOUSEHOLD"])], "p": [len(parts["PERSON"])]})

    got = cf.read_micro_list_chunked(spark, book, f, "h int, p int", chunk_size=9, vars=["INCTOT", "STATEFIP"])
    assert tuple(got.agg(F.sum("h"), F.sum("p")).first()) == (40, 40)


def test_pulls(spark, book):
    reader = cf.read_micro_pulled(spark, book, vars=["STATEFIP"])
    assert not reader.is_done() and reader.position == 0
    first = reader.pull(30)
    assert first.count() == 30 and reader.position == 30 and cf.is_labelled(first, "STATEFIP")
    assert "PushedFilters: [IsNotNull(row_no), GreaterThanOrEqual(row_no,1)" in first._jdf.queryExecution().executedPlan().toString()
    rest = list(reader)
    assert sum(d.count() for d in rest) == 50 and reader.is_done() and reader.pull() is None
    reader.reset()
    total = chunks.stack_pulls(reader, lambda d: d.groupBy("STATEFIP").count(), 25).groupBy("STATEFIP").agg(F.sum("count").alias("n"))
    want = cf.read_micro(spark, book).groupBy("STATEFIP").agg(F.count("*").alias("n"))
    assert text(total.collect()) == text(want.collect())


def test_list_pulls(spark, book):
    reader = cf.read_micro_list_pulled(spark, book, vars=["NAME"])
    part = reader.pull(50)
    assert list(part) == ["HOUSEHOLD", "PERSON"] and sum(d.count() for d in part.values()) == 50
    assert {r["NAME"] for r in part["PERSON"].collect()} == {"BB", "Doña"}


def test_pulls_reject_csv(spark, book, tmp_path):
    (tmp_path / "x.csv").write_text("YEAR\n1\n")
    with pytest.raises(ValueError, match="not from CSV"):
        cf.read_micro_pulled(spark, book, data_file=str(tmp_path / "x.csv"))


def test_running_tabulation_over_arriving_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    book = Codebook((Variable("S", start=1, end=1, var_type="integer", val_labels=((1, "one"), (2, "two"))),
                     Variable("W", start=2, end=4, var_type="numeric")), file_encoding="US-ASCII")
    (folder / "1.dat").write_text("1 10\n2  5\n")
    target, ck = str(tmp_path / "t"), str(tmp_path / "ck")

    def run():
        stream = cf.stream_micro(spark, book, str(folder), files_per_trigger=1)
        out = cf.running_tabulation(stream, ["S"], {"n": F.sum("W")}, target, ck)
        return {r["S"]: r["n"] for r in cf.as_factor(out, "S").collect()}

    assert run() == {"one": 10.0, "two": 5.0}
    (folder / "2.dat").write_text("1  1\n")
    (folder / "3.dat").write_text("2  1\n1  1\n")
    assert run() == {"one": 12.0, "two": 6.0}


def test_load_stream(spark, tmp_path):
    src = tmp_path / "src"
    spark.range(10).write.parquet(str(src))
    stream = cf.stream_table(spark, spark.read.parquet(str(src)).schema, str(src))
    cf.load_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    for n in (5, 7):
        cf.load_rows(spark.range(n), str(tmp_path / "batch"))
    assert spark.read.parquet(str(tmp_path / "batch")).count() == 12


def test_reduce_merges_as_a_tree(spark, lines):
    df = cf.with_row_no(spark.read.text(lines))

    def receive(rows, pos):
        return pd.DataFrame({"n": [len(rows)], "parts": [1]})

    def merge(states):
        assert len(states) <= 3
        return pd.DataFrame({"n": [states["n"].sum()], "parts": [states["parts"].sum()]})

    out = cf.chunk_reduce(df, receive, merge, "n bigint, parts bigint", 50, fan_in=3)
    assert [tuple(r) for r in out.collect()] == [(1000, 20)]
    assert cf.chunk_reduce(df.filter("row_no < 0"), receive, merge, "n bigint, parts bigint").count() == 0


def test_chunks_in_place_equal_shuffled_chunks(spark, lines):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        df = cf.with_row_no(spark.read.text(lines), blocks=True)

        def f(rows, pos):
            assert list(rows.columns) == ["value"] and rows["value"].is_monotonic_increasing
            return pd.DataFrame({"pos": [pos], "n": [len(rows)], "first": [rows["value"].iloc[0]]})

        out = cf.chunk_map(df, f, "pos bigint, n bigint, first string", 20)
        assert "MapInPandas" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, out.collect())) == [(i + 1, 20, f"{i:06d}") for i in range(0, 1000, 20)]
        odd = cf.chunk_map(df.filter("value % 7 = 0"), lambda rows, pos: pd.DataFrame({"n": [len(rows)]}), "n bigint", 20)
        assert odd.agg(F.sum("n")).first()[0] == 143
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_read_chunked_in_place(spark, book):
    f = lambda rows, pos: pd.DataFrame({"pos": [pos], "n": [len(rows)]})
    a = cf.read_micro_chunked(spark, book, f, "pos bigint, n bigint", 7, in_place=True)
    b = cf.read_micro_chunked(spark, book, f, "pos bigint, n bigint", 7)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
