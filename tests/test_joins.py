import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe import VarMeta
from codeframe.operators import joins as J


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture
def data(spark):
    df = spark.createDataFrame([("G01", 1, 5), ("G02", 2, 6), ("ABC", 3, 7), (None, 4, 8)], "GISJOIN string, D6Z001 int, test int")
    return cf.with_meta(df, {"D6Z001": VarMeta("1989 to March 1990", "Year Structure Built (D6Z)"), "GISJOIN": VarMeta("Key")})


@pytest.fixture
def shape(spark):
    df = spark.createDataFrame([("G01", "G001", 0, b"1"), ("G02", "G002", 0, b"2"), ("XYZ", "GXYZ", 0, b"3"), (None, "GNUL", 0, b"4")],
                               "GISJOIN string, GISJOIN2 string, test int, geometry binary")
    return cf.with_meta(df, {"GISJOIN": VarMeta("Shape key", "shape desc"), "GISJOIN2": VarMeta("Second")})


def keys(df, c="GISJOIN"):
    return sorted((r[c] or "-") for r in df.collect())


def test_directions(data, shape):
    want = {"inner": ["-", "G01", "G02"], "left": ["-", "ABC", "G01", "G02"], "right": ["-", "G01", "G02", "XYZ"],
            "full": ["-", "ABC", "G01", "G02", "XYZ"]}
    for how, k in want.items():
        res = J.shape_join(data, shape, "GISJOIN", how)
        assert keys(res.df) == k
        assert res.df.columns == ["GISJOIN", "D6Z001", "test", "GISJOIN2", "test_SHAPE", "geometry"]
        assert cf.get_meta(res.df, "D6Z001").label == "1989 to March 1990"
        assert cf.get_meta(res.df, "GISJOIN") == VarMeta("Key", "shape desc")
        assert cf.get_meta(res.df, "GISJOIN2").label == "Second"


def test_suffix(data, shape):
    out = cf.inner_join(data, shape, "GISJOIN", suffix=("_d", "_s")).df
    assert {"test_d", "test_s"} <= set(out.columns)


def test_failures(data, shape):
    res = cf.inner_join(data, shape, "GISJOIN")
    f = res.failures()
    assert keys(f["data"]) == ["ABC"] and keys(f["shape"]) == ["XYZ"]
    assert f["data"].columns == data.columns and f["shape"].columns == shape.columns
    assert res.counts == {"data": 1, "shape": 1}
    assert cf.full_join(data, shape, "GISJOIN").failures() is None
    assert cf.left_join(data, shape, "GISJOIN").counts == {"data": 0, "shape": 1}
    assert cf.right_join(data, shape, "GISJOIN").counts == {"data": 1, "shape": 0}


def test_missing_key(data, shape):
    with pytest.raises(ValueError, match="shape data has no column"):
        cf.inner_join(data, shape.drop("GISJOIN"), "GISJOIN")
    with pytest.raises(ValueError, match="data has no column"):
        cf.inner_join(data.drop("GISJOIN"), shape, "GISJOIN")


def test_require_geometry(data, shape):
    for how in ("left", "full"):
        with pytest.raises(ValueError, match="inner and right"):
            J.shape_join(data, shape, "GISJOIN", how, require_geometry=True)
    assert J.shape_join(data, shape, "GISJOIN", "right", require_geometry=True).df.count() == 4


def test_mixed_by(data, shape):
    d = data.filter("GISJOIN like 'G%'").withColumn("k1", F.substring("GISJOIN", 1, 1)).withColumn("k2", F.substring("GISJOIN", 2, 9).cast("double"))
    s = shape.filter("GISJOIN like 'G%'").withColumn("k1", F.substring("GISJOIN", 1, 1)).withColumn("kx", F.substring("GISJOIN", 2, 9)).drop("GISJOIN", "test")
    out = cf.inner_join(d, s, ["k1", {"k2": "kx"}]).df
    assert out.count() == 2 and "kx" not in out.columns
    assert dict(out.dtypes)["k2"] == "double"


@pytest.mark.parametrize("dkind,skind,ok", [("int", "string", True), ("string", "int", True), ("double", "string", True),
                                            ("string", "double", True), ("int", "double", True), ("bigint", "int", True)])
def test_key_types(spark, dkind, skind, ok):
    d = spark.createDataFrame([("1",), ("2",)], "id string").select(F.col("id").cast(dkind))
    s = spark.createDataFrame([("1",), ("2",)], "id_shape string").select(F.col("id_shape").cast(skind))
    res = cf.inner_join(d, s, {"id": "id_shape"})
    assert res.df.count() == 2 and res.failures() is None


def test_bad_key_text(spark):
    d = spark.createDataFrame([(1,)], "id int")
    s = spark.createDataFrame([("1",), ("x",)], "id string")
    with pytest.raises(Exception, match="id has text that is no"):
        cf.inner_join(d, s, "id").df.collect()
    with pytest.raises(ValueError, match="no number: id"):
        cf.inner_join(d, s, "id", eager_checks=True)


def test_factor_keys(spark, data, shape):
    coded = cf.with_meta(spark.createDataFrame([(1, 9)], "c int, v int"), {"c": VarMeta(None, None, ((1, "G01"),))})
    text = cf.as_factor(coded, "c")
    assert cf.inner_join(text, shape, {"c": "GISJOIN"}).df.count() == 1
    with pytest.raises(TypeError, match="factor"):
        cf.inner_join(text, spark.createDataFrame([(1,)], "k int"), {"c": "k"})


def test_area_with_boundaries(spark, data, shape):
    res = cf.area_with_boundaries(data, shape)
    assert keys(res.df) == ["-", "ABC", "G01", "G02", "XYZ"]
    assert keys(res.without_geometry()) == ["ABC"]
    assert res.df.columns == ["GISJOIN", "D6Z001", "test", "GISJOIN2", "geometry"]
    keep = cf.area_with_boundaries(data, shape, keep="boundaries")
    assert keys(keep.df) == ["-", "G01", "G02", "XYZ"] and keys(keep.unmatched_data) == ["ABC"]


def test_coded_area(spark):
    d = spark.createDataFrame([("x", "1", 5), ("y", "2", 6)], "GEOG_LABEL string, GEOG_CODE string, v int")
    s = spark.createDataFrame([(1, "sho", b"g")], "GEOID int, LABEL string, geometry binary")
    out = cf.coded_area_with_boundaries(d, s).df
    assert out.columns == ["GEOG_LABEL", "GEOG_CODE", "v", "geometry"] and out.count() == 1


def skewed(spark, n=3000):
    # two thirds of the rows share key 7, and many of those are equal in all columns
    return spark.range(n).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).cast("int").alias("k"), (F.col("id") % 2).alias("v"))


def test_hot_key_is_found_and_spread(spark, no_broadcast):
    left = skewed(spark)
    right = spark.range(60).select(F.col("id").cast("int").alias("rk"), (F.col("id") * 2).alias("w"))
    hot = J.hot_keys(left, ["k"])
    assert len(hot) == 1 and 0.6 < hot[0][1] < 0.8
    l2, r2 = J.salted(left, right, ["k"], ["rk"], hot)
    salts = [r[0] for r in l2.filter("k = 7").select("__salt").distinct().collect()]
    assert len(salts) > 1 and l2.filter("k <> 7 and __salt <> 0").count() == 0
    # only the hot key's row is repeated
    assert r2.count() == 59 + r2.filter("rk = 7").count() and set(salts) <= {r[0] for r in r2.filter("rk = 7").select("__salt").collect()}


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_skewed_joins_equal_plain_joins(spark, no_broadcast, how):
    left = skewed(spark).unionByName(spark.createDataFrame([(None, 1), (777, 1)], "k int, v bigint"))
    right = spark.createDataFrame([(i, i * 2) for i in range(5, 60)] + [(7, -1), (None, -2)], "k int, w int")
    got = J.shape_join(left, right, "k", how, skew="salt")
    r = right.withColumnRenamed("k", "rk")
    plain = left.join(r, left["k"].eqNullSafe(r["rk"]), how).select(F.coalesce("k", "rk").alias("k"), "v", "w")
    want = sorted(map(str, plain.groupBy("k", "v", "w").count().collect()))
    assert sorted(map(str, got.df.groupBy("k", "v", "w").count().collect())) == want
    if how == "inner":
        assert "__salt" in got.df._jdf.queryExecution().analyzed().toString()
        assert got.counts == {"data": 60 - 60 + left.join(r, left["k"].eqNullSafe(r["rk"]), "left_anti").count(),
                              "shape": r.join(left, left["k"].eqNullSafe(r["rk"]), "left_anti").count()}


def test_rectangularize(spark, no_broadcast):
    person = skewed(spark).withColumnRenamed("k", "SERIAL").withColumn("YEAR", F.lit(1))
    house = spark.createDataFrame([(7, 9, "hot"), (0, 9, "zero")], "SERIAL int, YEAR int, name string")
    out = cf.rectangularize(person, house, ["SERIAL"])
    assert out.columns == ["SERIAL", "v", "YEAR", "name"] and out.count() == 3000
    assert out.filter("name = 'hot'").count() == person.filter("SERIAL = 7").count()
    assert out.filter("YEAR = 9").count() == 0


def test_negative_zero_keys_meet(spark, no_broadcast):
    left = spark.createDataFrame([(-0.0,)] * 50 + [(0.0,)] * 50, "k double")
    right = spark.createDataFrame([(0.0, 1)], "k double, w int")
    assert cf.inner_join(left, right, "k").df.count() == 100


def test_lost_rows_cost_nothing_until_asked(spark, no_broadcast, monkeypatch):
    calls = []
    real = J.hot_keys
    monkeypatch.setattr(J, "hot_keys", lambda *a: calls.append(1) or real(*a))
    left = skewed(spark)
    right = spark.createDataFrame([(i, i) for i in range(60)], "k int, w int")
    assert cf.inner_join(left, right, "k").df.count() and not calls  # no job before the query by default
    res = J.shape_join(left, right, "k", "inner", skew="salt")
    assert len(calls) == 1
    assert res.unmatched_data.count() == 0 and len(calls) == 1


@pytest.mark.parametrize("how", ["right", "full"])
def test_plain_outer_join_without_hot_keys(spark, no_broadcast, how):
    left = spark.range(200).select((F.col("id") % 100 + 50).alias("k"), F.col("id").alias("v"))
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    out = J.shape_join(left, right, "k", how).df
    assert "Anti" not in out._jdf.queryExecution().analyzed().toString()
    assert out.count() == (150 if how == "right" else 250)
    assert out.filter("k is null").count() == 0


def test_bucketed_record_types_join_without_shuffle(spark, no_broadcast, tmp_path):
    p = spark.range(100).selectExpr("id % 20 as SERIAL", "id as v")
    h = spark.range(20).selectExpr("id as SERIAL", "id * 2 as w")
    from codeframe.sources.sinks import write_bucketed
    write_bucketed(p, "bucketed_p", ["SERIAL"], 4, str(tmp_path / "p"))
    write_bucketed(h, "bucketed_h", ["SERIAL"], 4, str(tmp_path / "h"))
    out = cf.rectangularize(spark.table("bucketed_p"), spark.table("bucketed_h"), ["SERIAL"], skew="aqe")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 100
    spark.sql("drop table bucketed_p")
    spark.sql("drop table bucketed_h")


def test_many_hot_keys(spark, no_broadcast):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert J.hot_limit(spark) == 500
        left = spark.range(40000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
        right = spark.range(120).select(F.col("id").alias("rk"))
        hot = J.hot_keys(left, ["k"])
        assert len(hot) == 100
        l2, r2 = J.salted(left, right, ["k"], ["rk"], hot)
        assert r2.count() == 100 * 32 + 20
        assert l2.select("__salt").distinct().count() == 32
        assert J.skew_join(left, right, ["k"], ["rk"], "inner", hot=hot).coalesce(4).count() == 40000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
