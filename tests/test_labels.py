"""Label algebra on small literal vectors."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import codeframe as cf
from codeframe import VarMeta, lbl
from codeframe.codebook import Variable
from codeframe.operators import labels as L

# The label vectors for which results are stated.
PAIRS = ((10, "Yes"), (11, "Yes - Logically Assigned"), (20, "No"), (30, "Maybe"), (99, "NIU"))
VALUES = [10, 10, 11, 20, 30, 99, 30, 10]


def column(spark, values, pairs=(), label="Test label", kind="double"):
    rows = [(i, float(v) if kind == "double" and v is not None else v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return cf.with_meta(df, {"x": VarMeta(label, None, tuple(pairs))})


def values(df):
    return [r["x"] for r in df.orderBy("i").collect()]


def pairs(df):
    return [(v, t) for v, t in cf.get_meta(df, "x").val_labels]


@pytest.fixture
def x(spark):
    return column(spark, VALUES, PAIRS)


@pytest.mark.parametrize("rule", [
    lambda val, lbl: (val >= 90) | lbl.isin("Maybe"),
    "val >= 90 or lbl in ('Maybe')",
    (F.lit(True) if False else None),
])
def test_na_if(x, rule):
    rule = rule if rule is not None else (F.col("val") >= 90) | (F.col("lbl") == "Maybe")
    out = L.lbl_na_if(x, "x", rule)
    assert values(out) == [10, 10, 11, 20, None, None, None, 10]
    assert pairs(out) == list(PAIRS[:3])
    assert cf.get_meta(out, "x").label == "Test label"


def test_na_if_rejects_null_and_bad_rules(x):
    with pytest.raises(ValueError, match="NULL"):
        L.lbl_na_if(x, "x", "case when val > 20 then true end")
    with pytest.raises(TypeError, match="not a list"):
        L.lbl_na_if(x, "x", [99])


def test_na_if_keeps_unlabelled(spark):
    out = L.lbl_na_if(column(spark, [1, 2, 95], [(1, "a"), (2, "b")]), "x", "val >= 2")
    assert values(out) == [1, None, 95]


def test_collapse(x):
    out = L.lbl_collapse(x, "x", "floor(val / 10) * 10")
    assert values(out) == [10, 10, 10, 20, 30, 90, 30, 10]
    assert pairs(out) == [(10, "Yes"), (20, "No"), (30, "Maybe"), (90, "NIU")]


def test_collapse_into_old_code_keeps_its_label(x):
    out = L.lbl_collapse(x, "x", lambda val, _: F.when(val == 10, 11).otherwise(val))
    assert values(out) == [11, 11, 11, 20, 30, 99, 30, 11]
    assert pairs(out) == list(PAIRS[1:])


def test_collapse_unlabelled_becomes_null(spark):
    df = column(spark, [10, 55], PAIRS)
    assert values(L.lbl_collapse(df, "x", "val")) == [10, None]
    assert values(L.lbl_collapse(df, "x", "val", keep_unlabelled=True)) == [10, 55]


def test_collapse_negative_codes_floor(spark):
    df = column(spark, [-15, -5], [(-15, "a"), (-5, "b")], kind="int")
    out = L.lbl_collapse(df, "x", "floor(val / 10)")
    assert values(out) == [-2, -1]
    assert dict(out.dtypes)["x"] == "int"


def test_collapse_to_text(spark):
    df = column(spark, [1, 2, 3], [(1, "north"), (2, "north east"), (3, "south")], kind="int")
    out = L.lbl_collapse(df, "x", lambda val, lbl: F.split(lbl, " ")[0])
    assert values(out) == ["north", "north", "south"]


def test_relabel(x):
    out = L.lbl_relabel(x, "x", (lbl(90, "Garbage codes"), lambda val, lbl: (val == 99) | (lbl == "Maybe")))
    assert values(out) == [10, 10, 11, 20, 90, 90, 90, 10]
    assert pairs(out) == [*PAIRS[:3], (90, "Garbage codes")]


def test_relabel_several_rules(x):
    out = L.lbl_relabel(x, "x", (lbl(10, "Yes/Yes-ish"), "val in (10, 11)"), (lbl(90, "???"), "val = 99 or lbl = 'Maybe'"))
    assert values(out) == [10, 10, 10, 20, 90, 90, 90, 10]
    assert pairs(out) == [(10, "Yes/Yes-ish"), (20, "No"), (90, "???")]


@pytest.mark.parametrize("target", [10, lbl("Yes"), lbl(val=10)])
def test_relabel_to_existing(x, target):
    out = L.lbl_relabel(x, "x", (target, "val = 11"))
    assert values(out) == [10, 10, 10, 20, 30, 99, 30, 10]
    assert pairs(out) == [PAIRS[0], *PAIRS[2:]]


def test_relabel_swap(x):
    out = L.lbl_relabel(x, "x", (lbl(10, "Yes - Logically Assigned"), "val = 11"), (lbl(11, "Yes"), "val = 10"))
    assert values(out) == [11, 11, 10, 20, 30, 99, 30, 11]
    assert pairs(out)[:2] == [(10, "Yes - Logically Assigned"), (11, "Yes")]


def test_relabel_errors(spark, x):
    with pytest.raises(ValueError, match="no label that"):
        L.lbl_relabel(x, "x", (lbl(val=-1), "val = 11"))
    with pytest.raises(ValueError, match="several labels"):
        L.lbl_relabel(x, "x", (lbl(10, "Yes also"), "val = 11"))
    with pytest.raises(ValueError, match="has no labels"):
        L.lbl_relabel(column(spark, [10, 12]), "x", (lbl(1, "a"), "val < 18"))


AGES = [10, 12, 16, 18, 20, 22, 25, 27]


def test_define(spark):
    df = column(spark, [*AGES, None], label=None)
    out = L.lbl_define(df, "x", (lbl(1, "Pre-college age"), lambda val, _: val < 18),
                       (lbl(2, "College age"), "val between 18 and 22"))
    assert values(out) == [1, 1, 1, 2, 2, 2, 25, 27, None]
    assert pairs(out) == [(1, "Pre-college age"), (2, "College age")]


def test_define_last_rule_wins_and_unused_label_goes(spark):
    out = L.lbl_define(column(spark, AGES), "x", (lbl(1, "low"), "val < 20"), (lbl(2, "lower"), "val < 12"), (lbl(3, "no"), "val > 90"))
    assert values(out) == [2, 1, 1, 1, 20, 22, 25, 27]
    assert pairs(out) == [(1, "low"), (2, "lower")]


def test_define_errors(spark, x):
    with pytest.raises(ValueError, match="has labels already"):
        L.lbl_define(x, "x", (lbl(3, "c"), "val > 22"))
    with pytest.raises(ValueError, match="unmatched rows"):
        L.lbl_define(column(spark, AGES), "x", (lbl(27, "odd"), "val < 18"))


def test_add(x):
    out = L.lbl_add(x, "x", lbl(90, "New Label"), lbl(91, "n2"))
    assert values(out) == VALUES
    assert pairs(out) == [*PAIRS[:4], (90, "New Label"), (91, "n2"), PAIRS[4]]
    with pytest.raises(ValueError, match="several labels"):
        L.lbl_add(x, "x", lbl(30, "New Label"))


def test_add_vals(spark):
    df = column(spark, [100, 200, 105, 990, 999, 230], [(990, "Unknown"), (999, "NIU")])
    out = L.lbl_add_vals(df, "x", lambda val: F.concat(F.lit("$"), val.cast("int").cast("string")), [100, 105])
    assert pairs(out) == [(100, "$100"), (105, "$105"), (990, "Unknown"), (999, "NIU")]
    every = L.lbl_add_vals(df, "x")
    assert pairs(every) == [(100, "100"), (105, "105"), (200, "200"), (230, "230"), (990, "Unknown"), (999, "NIU")]
    with pytest.raises(ValueError):
        L.lbl_add_vals(df, "x", None, [990])


def test_clean(spark):
    df = column(spark, [1, 2, 3] * 3, [(1, "Q1"), (2, "Q2"), (3, "Q3"), (4, "Q4")])
    assert pairs(L.lbl_clean(df)) == [(1, "Q1"), (2, "Q2"), (3, "Q3")]


def test_placeholder():
    assert lbl("a") == cf.Lbl(None, "a")
    assert lbl(val=1) == cf.Lbl(1, None)
    assert lbl(1, "a") == lbl("a", val=1) == lbl(1, lbl="a") == cf.Lbl(1, "a")
    with pytest.raises(ValueError):
        lbl(1, "a", "b")
    with pytest.raises(ValueError):
        lbl(value=1)


def test_as_factor_levels(spark):
    df = column(spark, [10, 55, None], PAIRS)
    got = {lv: values(L.as_factor(df, "x", lv)) for lv in ("default", "labels", "values", "both")}
    assert got == {"default": ["Yes", "55", None], "labels": ["Yes", None, None], "values": ["10", "55", None],
                   "both": ["[10] Yes", "55", None]}
    out = L.as_factor(df, keep_codes=True)
    assert out.columns == ["i", "x_code", "x"]
    assert cf.is_factor(out, "x") and cf.get_meta(out, "x").levels[0] == "Yes"


def test_clean_long_code_list(spark):
    df = column(spark, [5, 999, 5000], [(i, f"L{i}") for i in range(1000)])
    assert pairs(L.lbl_clean(df)) == [(5, "L5"), (999, "L999")]


def test_long_code_list_joins(spark):
    big = tuple((i, f"L{i}") for i in range(1000))
    df = column(spark, [5, 999, 5000, None], big)
    assert values(L.as_factor(df, "x")) == ["L5", "L999", "5000", None]
    assert values(L.lbl_collapse(df, "x", "floor(val / 10)")) == [0, 99, None, None]
    assert values(L.lbl_na_if(df, "x", "val < 900")) == [None, 999, 5000, None]
    assert sorted(r[0] for r in L.unlabelled_values(df, "x").collect()) == [5000]


def test_decode_with_table(spark):
    df = column(spark, [1, 2, None])
    names = spark.createDataFrame([(1.0, "one")], "val double, lbl string")
    assert values(L.decode_with_table(df, "x", names)) == ["one", "2", None]


def test_zap(x):
    assert not cf.is_labelled(cf.zap_labels(x), "x") and cf.get_meta(cf.zap_labels(x), "x").label == "Test label"
    assert cf.get_meta(cf.zap_attributes(x), "x") == VarMeta()
    assert cf.labelled_columns(x) == ["x"]


def test_set_attributes(spark):
    df = spark.createDataFrame([(1, "a")], "n int, t string")
    vs = [Variable("n", "N", "about n", ((1, "one"), (1, "the longest one"), (2, "b"), (2, "c"))), Variable("gone", "G")]
    out = cf.set_attributes(df, vs)
    meta = cf.get_meta(out, "n")
    assert meta == VarMeta("N", "about n", ((1, "the longest one"), (2, "b")))
    assert cf.get_meta(cf.set_attributes(df, vs, "var_label"), "n") == VarMeta("N")
    assert cf.get_meta(cf.set_attributes(df, vs, ["val_labels"]), "n").label is None
    assert cf.set_attributes(df, vs, None) is df
    with pytest.raises(TypeError, match="other way round"):
        cf.set_attributes(df, [Variable("t", val_labels=((1, "x"),))])


def test_duplicate_labels_keep_longest_like_five_record_types(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1), (3.0, 4.0, 4)], "RECTYPE double, REGION double, x int")
    vs = [Variable("REGION", val_labels=((1, "Northeast"), (2, "Midwest"), (3, "South"), (4, "West"), (1, "NE")))]
    assert cf.get_meta(cf.set_attributes(df, vs), "REGION").val_labels == ((1, "Northeast"), (2, "Midwest"), (3, "South"), (4, "West"))


def test_metadata_survives_parquet(spark, x, tmp_path):
    cf.write_parquet(x, str(tmp_path / "x"))
    assert pairs(spark.read.parquet(str(tmp_path / "x"))) == list(PAIRS)


codes = st.lists(st.integers(-50, 50), min_size=1, max_size=8, unique=True)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(labelled=codes, data=st.lists(st.integers(-50, 50), min_size=1, max_size=20), limit=st.integers(-50, 50))
def test_properties(spark, labelled, data, limit):
    ps = tuple((v, f"L{v}") for v in sorted(labelled))
    df = column(spark, data, ps, kind="int")
    na = values(L.lbl_na_if(df, "x", f"val > {limit}"))
    assert na == [None if v in labelled and v > limit else v for v in data]
    col = L.lbl_collapse(df, "x", "floor(val / 7) * 7")
    assert values(col) == [v // 7 * 7 if v in labelled else None for v in data]
    first = {}
    for v in sorted(labelled):
        first.setdefault(v // 7 * 7, v)
    for new in list(first):
        if new in labelled:
            first[new] = new
    assert dict(pairs(col)) == {n: f"L{v}" for n, v in first.items()}
    rel = L.lbl_relabel(df, "x", (lbl(100, "hi"), f"val > {limit}"))
    assert values(rel) == [None if v not in labelled else 100 if v > limit else v for v in data]


def test_text_codes(spark):
    df = column(spark, ["us2011", "us2012", "zz"], [("us2011", "United States 2011"), ("us2012", "United States 2012")], kind="string")
    assert values(L.lbl_collapse(df, "x", "substring(val, 1, 2)")) == ["us", "us", None]
    out = L.lbl_relabel(df, "x", (lbl("us", "Any"), "val like 'us%'"))
    assert values(out) == ["us", "us", None] and pairs(out) == [("us", "Any")]
    assert values(L.lbl_na_if(df, "x", "lbl like '%2012'")) == ["us2011", None, "zz"]
    assert values(L.as_factor(df, "x", "both")) == ["[us2011] United States 2011", "[us2012] United States 2012", "zz"]
    plain = column(spark, ["a", "b"], kind="string")
    assert values(L.lbl_define(plain, "x", (lbl("A", "First"), "val = 'a'"))) == ["A", "b"]
