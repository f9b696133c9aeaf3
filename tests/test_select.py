import pytest
from pyspark.sql import functions as F

import codeframe as cf

NAMES = ["RECTYPE", "SEX", "REPWT1", "REPWT2", "AGE_X"]


@pytest.mark.parametrize("selection,want", [
    (["RECTYPE", "SEX"], ["RECTYPE", "SEX"]), (cf.starts_with("rep"), ["REPWT1", "REPWT2"]),
    (cf.starts_with("rep", ignore_case=False), []), (cf.ends_with("x"), ["SEX", "AGE_X"]), (cf.contains("wt"), ["REPWT1", "REPWT2"]),
    (cf.matches("^re.*[12]$"), ["REPWT1", "REPWT2"]), (cf.num_range("REPWT", range(2, 9)), ["REPWT2"]),
    (cf.one_of("SEX", "NOPE"), ["SEX"]), (cf.everything(), NAMES), (None, NAMES), ("SEX", ["SEX"]),
    (cf.exclude(cf.starts_with("R")), ["SEX", "AGE_X"]), (["AGE_X", cf.contains("wt")], ["AGE_X", "REPWT1", "REPWT2"])])
def test_pick_and_rows(spark, selection, want):
    assert cf.pick(NAMES, selection) == want
    df = spark.createDataFrame([(n, i) for i, n in enumerate(NAMES)], "var_name string, x int")
    got = [r["var_name"] for r in cf.select_rows(df, selection).orderBy("x").collect()]
    assert got == [n for n in NAMES if n in want]


def test_unknown_name():
    with pytest.raises(ValueError):
        cf.pick(NAMES, "NOPE")


def test_mutate_at(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a1 int, a2 int, b int")
    assert tuple(cf.mutate_at(df, cf.starts_with("a"), lambda c: c * 10).first()) == (10, 20, 3)


def test_recodes(spark):
    df = spark.createDataFrame([(15,), (25,), (26,), (90,), (10,)], "age int")
    got = [r[0] for r in df.select(cf.cut(F.col("age"), [15, 25, 35, 90], ["15-24", "25-34", "65+"], include_lowest=True)).collect()]
    assert got == ["15-24", "15-24", "25-34", "65+", None]
    assert [r[0] for r in df.select(cf.null_if(F.col("age"), [15, 90])).collect()] == [None, 25, 26, None, 10]
    assert cf.select_cases(df, "age", [25, 26]).count() == 2
