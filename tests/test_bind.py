import pytest

import codeframe as cf
from codeframe import VarMeta
from codeframe.operators.bind import AttributesDropped


def frames(spark, label2="A var label"):
    t1 = cf.with_meta(spark.createDataFrame([(1.0, 2), (2.0, 3), (3.0, 4)], "x double, y int"), {"x": VarMeta("A var label", None, ((1, "xyz"),))})
    t2 = cf.with_meta(spark.createDataFrame([(1.0, "a")], "x double, z string"), {"x": VarMeta(label2, None, ((1, "xyz"),))})
    return t1, t2


def test_bind(spark):
    out = cf.bind_rows(*frames(spark))
    assert out.columns == ["x", "y", "z"]
    assert sorted(r["x"] for r in out.collect()) == [1, 1, 2, 3]
    assert cf.get_meta(out, "x") == VarMeta("A var label", None, ((1, "xyz"),))


def test_mismatched_attributes(spark):
    with pytest.warns(AttributesDropped, match="x"):
        out = cf.bind_rows(list(frames(spark, "A different var label")))
    assert out.columns == ["x", "y", "z"] and cf.get_meta(out, "x") == VarMeta()


def test_unlabelled_side_counts_as_different(spark):
    t1, _ = frames(spark)
    plain = spark.createDataFrame([(9.0,)], "x double")
    for order in ([plain, t1], [t1, plain]):
        with pytest.warns(AttributesDropped):
            assert not cf.is_labelled(cf.bind_rows(order), "x")


def test_id_and_nesting(spark):
    a, b = frames(spark)
    out = cf.bind_rows({"a": a, "more": {"b": b}}, id="src")
    assert sorted(r["src"] for r in out.collect()) == ["a", "a", "a", "b"]
    assert sorted({r["n"] for r in cf.bind_rows([a, [b]], id="n").collect()}) == ["1", "2"]


def test_types(spark):
    i, d, s = (spark.createDataFrame([(v,)], f"x {t}") for v, t in ((1, "int"), (1.5, "double"), ("a", "string")))
    assert dict(cf.bind_rows(i, d).dtypes) == {"x": "double"}
    with pytest.raises(TypeError, match="in one table"):
        cf.bind_rows(i, s)


def test_layers(spark):
    a = spark.createDataFrame([("p", 1.0)], "name string, area double")
    b = spark.createDataFrame([("q", b"g")], "name string, geometry binary")
    out = cf.bind_layers({"one": a, "two": b})
    assert sorted(tuple(r) for r in out.select("name", "layer").collect()) == [("p", "one"), ("q", "two")]
    assert cf.bind_layers({"one": a}).columns == ["name", "area"]
    assert "layer" in cf.bind_layers({"one": a}, add_layer=True).columns
    with pytest.raises(TypeError, match="disagree"):
        cf.bind_layers({"one": a, "two": spark.createDataFrame([(1,)], "name int")})
    with pytest.raises(TypeError, match="not filled up"):
        cf.bind_layers({"one": a, "two": spark.createDataFrame([("x", 1)], "name string, n int")})


def test_read_boundaries(spark, tmp_path):
    a = spark.createDataFrame([("p", 1.0, b"\x01\x02")], "name string, area double, geometry binary")
    a.write.parquet(str(tmp_path / "a.parquet"))
    a.selectExpr("name", "hex(geometry) as geometry").write.option("header", True).csv(str(tmp_path / "b.csv"))
    out = cf.read_boundaries(spark, {"a": str(tmp_path / "a.parquet"), "b": str(tmp_path / "b.csv")})
    assert out.count() == 2 and {bytes(r["geometry"]) for r in out.collect()} == {b"\x01\x02"}
    assert cf.read_boundaries(spark, str(tmp_path / "a.parquet"), vars=["name"]).columns == ["name", "geometry"]
    with pytest.raises(ValueError, match="bind_multiple"):
        cf.read_boundaries(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.csv")], bind_multiple=False)
    assert cf.read_boundaries(spark, {"a": str(tmp_path / "a.parquet"), "b": "x"}, shape_layer="a").count() == 1
