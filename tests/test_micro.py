import gzip

import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe.codebook import Codebook, Variable
from codeframe.metadata import all_meta
from codeframe.sources import micro, sinks

from test_codebook import write_xml

H = "H1962{s:4d}{st:02d}{w:10d}"
P = "P1962{s:4d}{inc:8d}{name:5s}"


def hier_lines(n=6):
    out = []
    for i in range(1, n + 1):
        out.append(H.format(s=i, st=1 + i % 2, w=147559 + i))
        for j in range(i % 3):
            out.append(P.format(s=i, inc=1000 * i + j, name="BB" if j else "Doña"))
    return out


@pytest.fixture
def hier(spark, tmp_path):
    path = write_xml(tmp_path)
    (tmp_path / "data.dat").write_bytes("\n".join(hier_lines()).encode("latin-1") + b"\n")
    return path


def test_long(spark, hier):
    df = cf.read_micro(spark, hier)
    rows = df.collect()
    assert len(rows) == len(hier_lines())
    assert df.columns == ["RECTYPE", "YEAR", "SERIAL", "STATEFIP", "HWTSUPP", "INCTOT", "NAME"]
    assert [r["HWTSUPP"] for r in rows if r["RECTYPE"] == "H"][:2] == [1475.60, 1475.61]
    assert all((r["STATEFIP"] is None) == (r["RECTYPE"] == "P") and (r["INCTOT"] is None) == (r["RECTYPE"] == "H") for r in rows)
    assert {r["NAME"] for r in rows} == {None, "BB", "Doña"}
    assert cf.get_meta(df, "STATEFIP").val_labels == ((1, "Alabama"), (2, "Alaska"))
    assert cf.get_meta(df, "YEAR").label == "Survey year"
    assert dict(df.dtypes)["YEAR"] == "int" and dict(df.dtypes)["HWTSUPP"] == "double"


def test_list(spark, hier, tmp_path):
    parts = cf.read_micro_list(spark, hier)
    assert list(parts) == ["HOUSEHOLD", "PERSON"]
    assert parts["HOUSEHOLD"].columns == ["RECTYPE", "YEAR", "SERIAL", "STATEFIP", "HWTSUPP"]
    assert parts["PERSON"].columns == ["RECTYPE", "YEAR", "SERIAL", "INCTOT", "NAME"]
    assert parts["HOUSEHOLD"].count() == 6 and parts["PERSON"].count() == 6
    staged = cf.read_micro_list(spark, hier, staging=str(tmp_path / "staged"))
    for k, df in parts.items():
        assert sorted(map(tuple, df.fillna("-").collect()), key=str) == sorted(map(tuple, staged[k].fillna("-").collect()), key=str)
        assert all_meta(df) == all_meta(staged[k])


def test_forced_columns(spark, hier):
    assert cf.read_micro(spark, hier, vars=["INCTOT", "STATEFIP"]).columns == ["RECTYPE", "STATEFIP", "INCTOT"]
    parts = cf.read_micro_list(spark, hier, vars=["INCTOT", "STATEFIP"])
    assert parts["HOUSEHOLD"].columns == ["YEAR", "SERIAL", "STATEFIP"] and parts["PERSON"].columns == ["YEAR", "SERIAL", "INCTOT"]


def test_lower_names(spark, hier):
    low, up = cf.read_micro(spark, hier, lower_vars=True), cf.read_micro(spark, hier)
    assert low.columns == [c.lower() for c in up.columns]
    assert sorted(map(str, map(tuple, low.collect()))) == sorted(map(str, map(tuple, up.collect())))
    with pytest.warns(UserWarning, match="ignored"):
        assert cf.read_micro(spark, cf.read_codebook(spark, hier), lower_vars=True).columns == up.columns


def test_attributes_subset(spark, hier):
    df = cf.read_micro(spark, hier, var_attrs="var_label")
    assert cf.get_meta(df, "STATEFIP") == cf.VarMeta("State")
    assert cf.get_meta(cf.read_micro(spark, hier, var_attrs=None), "STATEFIP") == cf.VarMeta()
    with pytest.raises(ValueError):
        cf.read_micro(spark, hier, var_attrs="nope")


def test_n_max_takes_first_lines(spark, hier):
    got = [(r["RECTYPE"], r["SERIAL"]) for r in cf.read_micro(spark, hier, n_max=3).collect()]
    assert sorted(got) == [("H", 1), ("H", 2), ("P", 1)]


def test_gzip_and_fallback(spark, hier, tmp_path):
    plain = sorted(map(str, cf.read_micro(spark, hier).collect()))
    with gzip.open(tmp_path / "z.dat.gz", "wb") as f:
        f.write((tmp_path / "data.dat").read_bytes())
    assert sorted(map(str, cf.read_micro(spark, hier, data_file=str(tmp_path / "z.dat")).collect())) == plain
    with pytest.raises(FileNotFoundError):
        cf.read_micro(spark, hier, data_file=str(tmp_path / "none.dat"))


def test_hierarchical_csv_is_error(spark, hier, tmp_path):
    (tmp_path / "a.csv").write_text("YEAR\n1962\n")
    with pytest.raises(ValueError, match="cannot be CSV"):
        cf.read_micro(spark, hier, data_file=str(tmp_path / "a.csv"))


def test_numeric_record_types(spark, tmp_path):
    vs = (Variable("RT", start=1, end=2, var_type="integer", val_labels=((1, "Household Record"), (2, "Person record")), rectypes=("1", "2")),
          Variable("A", start=3, end=4, var_type="integer", rectypes=("1",)), Variable("B", start=3, end=4, var_type="integer", rectypes=("2",)))
    (tmp_path / "n.dat").write_text("01 5\n02 6\n 1 7\n")
    book = Codebook(vs, "n.dat", str(tmp_path), "hierarchical", rectypes=("1", "2"), rectype_idvar="RT", keyvars={"1": (), "2": ()})
    parts = cf.read_micro_list(spark, book)
    assert list(parts) == ["HOUSEHOLD", "PERSON"]
    assert sorted(r["A"] for r in parts["HOUSEHOLD"].collect()) == [5, 7]
    assert [r["B"] for r in parts["PERSON"].collect()] == [6]


RECT = (Variable("YEAR", "Survey year", start=1, end=4, var_type="integer"),
        Variable("WT", "Weight", start=5, end=10, var_type="numeric", imp_decim=2),
        Variable("STATE", "State", start=11, end=12, var_type="integer", val_labels=((1, "Alabama"), (2, "Alaska"))),
        Variable("NAME", start=13, end=17))


@pytest.fixture
def rect(tmp_path):
    (tmp_path / "r.dat").write_bytes("1962147559 1caf\xe9 \n1962      02     \n\n1963  x  9 9   yz\n".encode("latin-1"))
    return Codebook(RECT, "r.dat", str(tmp_path))


def test_rectangular(spark, rect):
    rows = [tuple(r) for r in cf.read_micro(spark, rect).collect()]
    assert rows == [(1962, 1475.59, 1, "café"), (1962, None, 2, None), (None, None, None, None), (1963, None, 9, "yz")] or \
        rows[0] == (1962, 1475.59, 1, "café")
    assert rows[1] == (1962, None, 2, None)
    assert list(cf.read_micro_list(spark, rect)) == ["P"]


def test_csv(spark, rect, tmp_path):
    (tmp_path / "r.csv").write_text("EXTRA,STATE,YEAR,WT,NAME\nq,01,1962,1475.59, bob\nq,2,1963,NA,\n")
    from dataclasses import replace
    book = replace(rect, file_name="r.csv")
    df = cf.read_micro(spark, book)
    assert df.columns == ["YEAR", "WT", "STATE", "NAME"]
    assert [tuple(r) for r in df.collect()] == [(1962, 1475.59, 1, "bob"), (1963, None, 2, None)]
    low = cf.read_micro(spark, book.lower())
    assert low.columns == ["year", "wt", "state", "name"] and low.count() == 2
    assert cf.read_micro(spark, book, n_max=1).count() == 1
    assert list(cf.read_micro_list(spark, book)) == ["P"]


def test_collect_with_labels(spark, rect):
    df = spark.createDataFrame([(1962, 1)], "YEAR int, STATE int")
    assert cf.get_meta(cf.collect_with_labels(df.filter("YEAR > 1"), rect), "STATE").val_labels == ((1, "Alabama"), (2, "Alaska"))


def test_utf8_positions_are_characters(spark, tmp_path):
    (tmp_path / "u.dat").write_text("añb12\nxyz34\n", encoding="utf-8")
    book = Codebook((Variable("T", start=1, end=3), Variable("N", start=4, end=5, var_type="integer")), "u.dat", str(tmp_path), file_encoding="UTF-8")
    assert [tuple(r) for r in cf.read_micro(spark, book).collect()] == [("añb", 12), ("xyz", 34)]


def test_far_utf8_positions(spark, tmp_path):
    lines = ["a" * 70 + "xyz12", "ñ" * 70 + "éyz34", "", "short"]
    (tmp_path / "u.dat").write_text("\n".join(lines) + "\n", encoding="utf-8")
    book = Codebook((Variable("T", start=71, end=73), Variable("N", start=74, end=75, var_type="integer")), "u.dat", str(tmp_path), file_encoding="UTF-8")
    assert [tuple(r) for r in cf.read_micro(spark, book).collect()] == [("xyz", 12), ("éyz", 34), (None, None), (None, None)]


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 1475.59, "ab", None), (-2, None, "", 7), (3, 0.07, "ñ", 8)], "i int, w double, t string, n bigint")
    df = cf.with_meta(df, {"i": cf.VarMeta("I", None, ((1, "one"),))})
    book = sinks.write_fixed_width(df, str(tmp_path / "out"), sinks.layout(df, {"i": 5, "w": 9, "t": 3, "n": 12}, {"w": 2}))
    back = cf.read_micro(spark, book)
    assert sorted(map(tuple, back.collect())) == [(-2, None, None, 7.0), (1, 1475.59, "ab", None), (3, 0.07, "ñ", 8.0)]
    assert cf.get_meta(back, "i") == cf.VarMeta("I", None, ((1, "one"),))
    with pytest.raises(Exception, match="does not fit"):
        sinks.write_fixed_width(df.withColumn("i", F.lit(123456)), str(tmp_path / "bad"), sinks.layout(df, {"i": 5}))
    with pytest.raises(Exception, match="not ASCII"):
        sinks.write_fixed_width(df, str(tmp_path / "bad2"), sinks.layout(df, {"t": 3}), "US-ASCII")


def test_only_selected_columns_are_cut(spark, rect):
    plan = cf.read_micro(spark, rect, var_attrs=None).select("YEAR")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("substring(") == 1


def test_rectype_filter_reads_its_partition_only(spark, hier, tmp_path):
    parts = micro.read_micro_list(spark, hier, staging=str(tmp_path / "st"))
    plan = parts["PERSON"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rt" in plan or "PartitionFilters: [(rt" in plan or "rt#" in plan.split("PartitionFilters:")[1][:60]
