"""One result at every size of a code list, row numbers on plain scans, fields and files as they are."""

import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe.metadata import VarMeta, with_meta
from codeframe.operators import labels as L
from codeframe.select import exclude, pick, row_condition, starts_with
from codeframe.sources import area, micro, sinks
from codeframe.streaming import chunks as C


@pytest.mark.parametrize("n", [10, 200, 201, 300])
def test_doubled_code(spark, n):
    pairs = [(i, f"Label {i}") for i in range(n)]
    pairs.insert(4, (3, "Again"))
    df = with_meta(spark.range(n + 5).select(F.col("id").cast("int").alias("x")), {"x": VarMeta("X", None, tuple(pairs))})
    got = [r[0] for r in L.as_factor(df, "x", levels="labels").collect()]
    assert sorted(got, key=str) == sorted([f"Label {i}" for i in range(n)] + [None] * 5, key=str)
    assert L.lbl_collapse(df, "x", "floor(val / 10)").count() == n + 5
    assert L.lbl_na_if(df, "x", "val >= 0").where("x is null").count() == n


def test_many_new_labels(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_NEW_LABELS", 50)
    df = with_meta(spark.range(200).select("id", (F.col("id") % 100).alias("x")), {"x": VarMeta("X", None, ((3, "Three"),))})
    out = L.lbl_add_vals(df, "x", lambda v: F.concat(F.lit("#"), v.cast("string")))
    text = {r.id: r.x for r in L.as_factor(out, "x").collect()}
    assert text == {i: "Three" if i % 100 == 3 else f"#{i % 100}" for i in range(200)}
    assert {r.x for r in L.as_factor(out, "x", levels="both").where("id < 2").collect()} == {"[0] #0", "[1] #1"}


def test_row_numbers(spark, tmp_path):
    spark.range(500).repartition(3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert C.with_row_no(df).columns == ["id", "row_no"]
    assert C.with_row_no(df, blocks=True).columns == ["id", "row_no", "__lo", "__hi"]
    assert C.with_row_no(df.where("id % 2 = 0")).agg(F.max("row_no"), F.countDistinct("row_no")).first() == (250, 250)
    for wrong in (df.repartition(4), df.orderBy("id"), df.groupBy("id").count(), spark.range(5)):
        with pytest.raises(ValueError, match="file scan"):
            C.with_row_no(wrong)
    reader = C.RowReader(C.with_row_no(df, blocks=True))
    first = reader.pull(7)
    assert first.columns == ["id"] and first.count() == 7 and reader.position == 7 and not reader.is_done()
    reader.reset()
    assert sorted(map(str, reader.pull(7).collect())) == sorted(map(str, first.collect()))
    seen = spark.sparkContext.accumulator(0)

    def look(rows, pos):
        seen.add(list(rows.columns) == ["id"])

    assert C.chunk_side_effect(C.with_row_no(df, blocks=True), look, 200) == 3 and seen.value == 3


def test_first_rows_read_the_files_they_need(spark, tmp_path):
    for i in range(4):
        spark.range(i * 10, i * 10 + 10).coalesce(1).write.parquet(str(tmp_path / f"t/k={i}"))
    df = spark.read.parquet(str(tmp_path / "t"))
    asked = []

    def read(paths):
        asked.append(len(paths))
        return spark.read.parquet(*paths)

    assert sorted(r.id for r in micro.first_rows(df.select("id"), 15, read).collect()) == list(range(15))
    assert asked == [1, 1, 2]


def test_numbers_are_numbers(spark):
    rows = [("12D",), ("NaN",), ("0x1p3",), (" 7.5 ",), ("",), ("-3e2",), ("Infinity",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(micro.typed_text(F.col("t"), spark.range(1).select(F.lit(1.0)).schema[0].dataType)).collect()]
    assert got == [None, None, None, 7.5, None, -300.0, None]


def test_line_breaks_stop_the_sink(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("b\nc",)], "t string")
    with pytest.raises(Exception, match="line break in t"):
        sinks.write_fixed_width(df, str(tmp_path / "f"), sinks.layout(df, {"t": 5}))


def test_text_tables_and_second_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("GISJOIN,NAME\nG1,One\nG2,Two\nG1,One\n")
    path = str(tmp_path / "a.csv")
    assert cf.read_area_table(spark, path, second_header=False).count() == 3
    with pytest.warns(UserWarning, match="second header"):
        assert cf.read_area_table(spark, path).count() == 2  # the head only, not the later row equal to it
    folder = tmp_path / "f.csv"
    folder.mkdir()
    (folder / "x.csv").write_text("k,v\nKey,Value\nG1,1\n")
    (folder / "y.csv").write_text("k,v\nCode,Number\nG2,2\n")
    with pytest.warns(UserWarning):
        out = area.read_area_table(spark, str(folder))
    assert sorted(map(tuple, out.collect())) == [("G1", 1.0), ("G2", 2.0)]


def test_exclude_takes_away(spark):
    names = ["l_tax", "l_qty", "x", "l_z"]
    assert pick(names, [starts_with("l_"), exclude("l_tax")]) == ["l_qty", "l_z"]
    assert pick(names, [exclude("l_tax"), "l_tax"]) == ["l_qty", "x", "l_z", "l_tax"] and pick(names, exclude("x")) == ["l_tax", "l_qty", "l_z"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n for r in df.where(row_condition(F.col("n"), [starts_with("l_"), exclude("l_tax")])).collect()} == {"l_qty", "l_z"}
