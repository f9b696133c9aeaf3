import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe import VarMeta
from codeframe.operators import tabulate as tb


@pytest.fixture
def people(spark):
    df = spark.createDataFrame([(1, 1, 2, 10.0, 5.0), (1, 2, 1, 20.0, 5.0), (2, 1, 2, 30.0, 7.0), (3, 1, 9, None, 1.0)],
                               "SERIAL int, PERNUM int, FOOD int, x double, W double")
    return cf.with_meta(df, {"FOOD": VarMeta("Food stamps", None, ((1, "No"), (2, "Yes")))})


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_frequency(people):
    assert rows(cf.weighted_frequency(people, "FOOD", "W")) == [("9", 1.0, 1 / 18), ("No", 5.0, 5 / 18), ("Yes", 12.0, 12 / 18)]
    assert rows(cf.weighted_frequency(people, "FOOD", share=None, labels=False)) == [(1, 1), (2, 2), (9, 1)]


def test_household_frequency(people):
    got = rows(cf.household_frequency(people, "SERIAL", "FOOD", "W", order=["PERNUM"]))
    assert got == [("9", 1.0, 1 / 13), ("Yes", 12.0, 12 / 13)]


def test_first_per_group_keeps_metadata(people):
    out = cf.first_per_group(people, "SERIAL", ["PERNUM"])
    assert out.count() == 3 and cf.is_labelled(out, "FOOD")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_weighted_mean(people):
    assert cf.weighted_mean(people, "x", "W").first()["mean"] is None
    assert cf.weighted_mean(people, "x", "W", skip_null=True).first()["mean"] == pytest.approx((50 + 100 + 210) / 17)
    by = dict(map(tuple, cf.weighted_mean(people, "x", "W", "FOOD").collect()))
    assert by == {"Yes": pytest.approx((50 + 210) / 12), "No": 20.0, "9": None}
    assert cf.weighted_mean(people, F.col("FOOD") == 2, "W").first()["mean"] == pytest.approx(12 / 18)


def test_counts(people):
    assert rows(cf.two_way_table(people, "FOOD", F.col("x") > 15)) == [("9", None, 1), ("No", True, 1), ("Yes", False, 1), ("Yes", True, 1)]
    assert rows(cf.share_of(people, F.col("x") > 15, "SERIAL")) == [(1, 0.5), (2, 1.0), (3, None)]
    assert rows(cf.value_counts(people, "x")) == rows(people.groupBy("x").count())
    assert cf.distinct_count(people, "SERIAL").first()[0] == 3


def test_top_and_extremes(people):
    assert [r["x"] for r in cf.top_k(people, 2, "x", ["SERIAL"]).collect()] == [30.0, 20.0]
    assert sorted(r["x"] for r in cf.rows_at_extremes(people, "x").collect()) == [10.0, 30.0]


def test_area_summary(people):
    got = rows(cf.area_summary(people, {"old": F.col("x") >= 20}, {"m": (F.col("x"), F.col("W"))}, {"f": F.col("SERIAL")}, order=F.col("SERIAL")))
    assert got == [(False, 10.0, 1), (None, None, 3), (True, pytest.approx((100 + 210) / 12), 1)]


def test_sort_labels(spark):
    df = spark.createDataFrame([("10", "a"), ("9", "b"), ("x", "c")], "val string, lbl string")
    assert [r["val"] for r in tb.sort_labels(df).collect()] == ["9", "10", "x"]


def test_share_reuses_the_aggregation(people, tmp_path):
    cf.write_parquet(people, str(tmp_path / "p"))
    df = people.sparkSession.read.parquet(str(tmp_path / "p"))
    out = cf.weighted_frequency(df, "FOOD", "W")
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()
