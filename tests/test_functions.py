import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeframe.functions import charset, numbers, text


def one(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.withColumn("y", f(F.col("x"))).orderBy("i").collect()]


def test_detect_replace_split(spark):
    v = ["abcdef", "xyz", "def abc"]
    assert one(spark, v, lambda c: text.detect(c, "abc")) == [True, False, True]
    assert one(spark, v, lambda c: text.detect(c, "abc", negate=True)) == [False, True, False]
    assert one(spark, ["banana"], lambda c: text.replace_first(c, "a", "o")) == ["bonana"]
    assert one(spark, ["banana"], lambda c: text.replace_all(c, "(a)n", "<\\1>")) == ["b<a><a>a"]
    assert one(spark, ["x1y22"], lambda c: text.replace_first(c, "([0-9]+)", "[\\1]")) == ["x[1]y22"]
    assert one(spark, ["a,b"], lambda c: text.split(c, ",")) == [["a", "b"]]
    assert one(spark, ["a"], lambda c: text.subset(F.array(F.lit("xa"), F.lit("b")), "a")) == [["xa"]]


@pytest.mark.parametrize("start,end,want", [(1, -1, "abcdef"), (2, 3, "bc"), (-3, -1, "def"), (1, -5, "ab"), (5, 2, "")])
def test_sub(spark, start, end, want):
    assert one(spark, ["abcdef"], lambda c: text.sub(c, start, end)) == [want]


def test_named_capture(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["this is a bike", "this is cool", "these are fine"])], "i int, s string")
    pat = "^this is( a)? (?<var>.+)$"
    assert [r["var"] for r in text.named_capture(df, "s", pat).orderBy("i").collect()] == ["bike", "cool", ""]
    assert [r["var"] for r in text.named_capture(df, "s", pat, True).orderBy("i").collect()] == ["bike", "cool"]
    two = text.named_capture(df, "s", "^(?<the_article>this) is( a)? (?<var_name>.+)$")
    assert two.columns == ["i", "s", "the_article", "var_name"]
    with pytest.raises(ValueError, match="names no group"):
        text.capture(F.col("s"), "abc")


def test_group_numbering():
    assert text.numbered_groups(r"a\(([[:alnum:]()]+)(?:x)(?<n_1>y)")[1] == {"n_1": 2}


def test_strict_numbers(spark):
    assert one(spark, ["1", " 2.5 ", None], lambda c: numbers.strict_number(c)) == [1.0, 2.5, None]
    with pytest.raises(PySparkException, match="id has text that is no integer"):
        one(spark, ["1", "abc"], lambda c: numbers.strict_number(c, "int", "id"))


def test_lenient_numbers(spark):
    assert one(spark, ["$1,234.50", "12 %", "-3", "abc", None], lambda c: numbers.lenient_number(c)) == [1234.5, 12.0, -3.0, None, None]


def test_java_only_numbers_are_text(spark):
    assert one(spark, ["1d", "0x10", "1e3", "NaN"], lambda c: numbers.to_number(c)) == [None, None, 1000.0, None]


def test_guess(spark):
    df = spark.createDataFrame(
        [("01", "1", "T", "2020-01-02", "a", "", "2020-01-02 03:04"), ("02", "2.5", "F", "NA", "1", "NA", "2021-05-06 07:08")],
        "zero string, num string, bool string, day string, txt string, none string, ts string")
    types = numbers.guess_types(df)
    assert [types[c].simpleString() for c in df.columns] == ["string", "double", "boolean", "date", "string", "boolean", "timestamp"]
    row = numbers.convert(df, types).first()
    assert row["zero"] == "01" and row["num"] == 1.0 and row["bool"] is True and row["none"] is None
    assert isinstance(numbers.convert(df, types).schema["day"].dataType, T.DateType)


def test_arithmetic(spark):
    assert one(spark, [-15, 15], lambda c: numbers.floor_div(c, 10), "int") == [-2, 1]
    assert one(spark, [1, 0, None], lambda c: numbers.ratio(F.lit(1), c), "int") == [1.0, None, None]
    assert one(spark, [1, 2, None], lambda c: numbers.is_in(c, [1]), "int") == [True, False, False]
    assert one(spark, [1, None], lambda c: numbers.is_in(c, [2, None]), "int") == [False, True]
    assert one(spark, [1, None], lambda c: numbers.row_sum(c, F.lit(2)), "int") == [3, None]


@pytest.mark.parametrize("name,raw,want", [
    ("ISO-8859-1", b"Do\xf1a", "Doña"), (None, b"Do\xf1a", "Doña"), ("windows-1252", b"\x80 \x93x\x94 \xf1", "€ “x” ñ"),
    ("UTF-8", "Doña".encode(), "Doña"), ("latin1", b"\xe9", "é"), ("ASCII", b"abc", "abc")])
def test_decode(spark, name, raw, want):
    df = spark.createDataFrame([(bytearray(raw),)], "b binary")
    assert df.select(charset.decode(F.col("b"), name)).first()[0] == want
