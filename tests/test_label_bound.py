"""Label sets on both sides of the bound from which on they are a stored table: same results."""

import pytest
from pyspark.sql import functions as F

from codeframe import lbl
from codeframe.metadata import VarMeta, get_meta, with_meta
from codeframe.operators import labels as L


@pytest.fixture(scope="module", params=[("int", 20_000), ("int", 20_001), ("double", 20_001), ("string", 20_001)], ids=str)
def labelled(spark, request):
    kind, n = request.param
    df = with_meta(spark.range(n).select(F.col("id").cast(kind).alias("x")), {"x": VarMeta("X")})
    out = L.lbl_add_vals(df, "x", lambda v: F.concat(F.lit("#"), v.cast("bigint").cast("string")))
    assert (L.LABEL_TABLE in get_meta(out, "x").other) == (n > 20_000)
    return out, n, kind


def test_every_operator(labelled):
    df, n, kind = labelled
    assert L.unlabelled_values(df, "x").count() == 0
    group = L.lbl_collapse(df, "x", "cast(floor(val / 100) as bigint)")
    assert group.where("x IS NULL").count() == 0 and group.select("x").distinct().count() == -(-n // 100)
    assert dict(get_meta(group, "x").val_labels)[7] == "#700"
    gone = L.lbl_na_if(df, "x", "cast(val as int) % 2 = 0")
    assert gone.where("x IS NULL").count() == -(-n // 2) and {r[0] for r in L.as_factor(gone, "x", levels="labels").where("x IS NOT NULL").collect()} == {f"#{i}" for i in range(1, n, 2)}
    one = 1 if kind != "string" else "1"
    moved = L.lbl_relabel(df, "x", (lbl(one, "low"), "cast(val as int) < 5"))
    assert sorted(r[0] for r in L.as_factor(moved, "x").where("x NOT LIKE '#%'").collect()) == ["low"] * 5 and moved.where("x IS NULL").count() == 0
    used = L.lbl_clean(df.where("cast(x as int) < 30"), "x")
    assert sorted(t for _, t in get_meta(used, "x").val_labels) == sorted(f"#{i}" for i in range(30))
    more = with_meta(df.select("x").unionByName(df.sparkSession.range(n, n + 3).select(F.col("id").cast(kind).alias("x"))), {"x": get_meta(df, "x")})
    assert L.unlabelled_values(more, "x").count() == 3
    again = L.lbl_add_vals(more, "x", lambda v: F.lit("late"))
    assert L.unlabelled_values(again, "x").count() == 0 and L.as_factor(again, "x").where("x = 'late'").count() == 3
    extra = L.lbl_add(more, "x", lbl(n if kind != "string" else str(n), "added"))
    assert L.unlabelled_values(extra, "x").count() == 2 and L.as_factor(extra, "x").where("x = 'added'").count() == 1
    assert not get_meta(L.zap_labels(df, "x"), "x").labelled
    with pytest.raises(ValueError):
        L.lbl_define(df, "x", (lbl(one, "low"), "val < 5"))
    with pytest.raises(ValueError, match="labelled already"):
        L.lbl_add_vals(df, "x", None, [one])
