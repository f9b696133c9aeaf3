import json

import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe.plans import extract as ex

SPEC = dict(collection="usa", description="Test", samples=["us2017b", "us2018a"], variables=["AGE", "SEX"])


def test_define_and_validate():
    e = cf.define_extract(**SPEC)
    assert e.status == "unsubmitted" and not e.submitted and e.number is None and e.data_format == "fixed_width"
    for bad in (dict(data_structure="hierarchical"), dict(rectangular_on="H"), dict(data_format="xls"), dict(samples=[])):
        with pytest.raises(ValueError):
            cf.define_extract(**{**SPEC, **bad})
    with pytest.raises(TypeError):
        cf.define_extract(**{**SPEC, "samples": [1]})
    with pytest.raises(ValueError, match="needs: description"):
        ex.validate(ex.Extract("usa", None, ("a",), ("b",)))


def test_revise():
    e = cf.define_extract(**SPEC)
    r = cf.revise_extract(e, samples_to_add="us2019a", samples_to_remove="us2017b", vars_to_add=["RACE"], vars_to_remove=["SEX"])
    assert r.description == "Revision of (Test)" and r.samples == ("us2018a", "us2019a") and r.variables == ("AGE", "RACE")
    with pytest.warns(UserWarning, match="has already"):
        assert cf.revise_extract(e, vars_to_add=["AGE", "X"]).variables == ("AGE", "SEX", "X")
    with pytest.warns(UserWarning, match="does not have"):
        assert cf.revise_extract(e, vars_to_remove=["Q"]).variables == ("AGE", "SEX")
    assert cf.revise_extract(e, description="New", data_format="csv").description == "New"
    with pytest.raises(ValueError):
        cf.revise_extract(e, data_structure="hierarchical")


def test_json(tmp_path):
    e = cf.define_extract(**SPEC)
    path = cf.save_extract(e, str(tmp_path / "e.json"))
    assert json.load(open(path))["data_structure"] == {"rectangular": {"on": "P"}}
    assert cf.extract_from_json(path, "usa") == e
    with pytest.raises(ValueError, match="unknown collection"):
        cf.extract_from_json(path, "nope")
    with pytest.raises(ValueError, match="expected one"):
        cf.extract_from_json("[" + ex.to_json(e) + "," + ex.to_json(e) + "]", "usa")


def doc(number, status="completed", links=("data", "ddi_codebook")):
    return {"data_structure": {"rectangular": {"on": "P"}}, "data_format": "csv", "description": f"E{number}", "samples": {"s1": {}, "s2": {}},
            "variables": {"YEAR": {"preselected": True}, "AGE": {}}, "download_links": {k: {"url": f"u/{k}", "bytes": 5, "sha256": "x"} for k in links},
            "number": number, "status": status}


def test_log(spark):
    rows = [(json.dumps([doc(86), doc(85, links=())]),), (json.dumps(doc(84, "started")),), (json.dumps({k: v for k, v in doc(1).items() if k not in (
        "number", "status", "download_links")}),)]
    log = cf.extract_log(spark.createDataFrame(rows, "value string"), collection="usa")
    got = {r["description"]: r for r in log.withColumn("ready", cf.is_ready()).collect()}
    assert got["E86"]["samples"] == ["s1", "s2"] and got["E86"]["variables"] == ["YEAR", "AGE"] and got["E86"]["ready"]
    assert got["E86"]["download_links"]["data"]["url"] == "u/data"
    assert not got["E85"]["ready"] and not got["E84"]["ready"] and got["E85"]["download_links"] == {}
    assert got["E1"]["status"] == "unsubmitted" and got["E1"]["submitted"] is False and got["E1"]["number"] is None
    assert [r["number"] for r in cf.recent_extracts(log, "usa", 2).collect()] == [86, 85]
    assert cf.last_extract(log).first()["number"] == 86
    for key in ("usa:85", ("USA", 85), "usa:85.0"):
        assert cf.extract_info(log, key).first()["description"] == "E85"
    for key in ("usa", "usa:x", ("a", "b", "c"), cf.define_extract(**SPEC)):
        with pytest.raises(ValueError):
            cf.extract_info(log, key)
    back = {e.description: e for e in ex.log_to_extracts(log)}
    again = ex.extracts_to_log(spark, list(back.values()))
    assert again.columns == log.columns and {e.description: e for e in ex.log_to_extracts(again)} == back and len(back) > 0
    assert back["E86"].rectangular_on == "P" and back["E86"].samples == ("s1", "s2")


def test_run(spark, tmp_path):
    p = spark.createDataFrame([(1, 1, 30), (1, 2, 40), (2, 1, 50)], "SERIAL int, PERNUM int, AGE int")
    h = spark.createDataFrame([(1, "us2017b", 5), (2, "us1900", 6)], "SERIAL int, SAMPLE string, ROOMS int")
    e = cf.define_extract(**{**SPEC, "variables": ["AGE", "ROOMS"], "data_format": "csv"})
    out = cf.run_extract(e, p, h, keys=["SERIAL"])
    assert sorted(map(tuple, out.collect())) == [(30, 5), (40, 5)]
    assert cf.run_extract(e, p, h, keys=["SERIAL"], cases=F.col("PERNUM") == 2).count() == 1
    cf.write_extract(out, e, str(tmp_path / "o.csv"))
    assert spark.read.csv(str(tmp_path / "o.csv"), header=True).count() == 2
    book = cf.write_extract(out, cf.revise_extract(e, data_format="fixed_width"), str(tmp_path / "o"), {"AGE": 3, "ROOMS": 2})
    assert cf.read_micro(spark, book).count() == 2
    with pytest.raises(NotImplementedError):
        cf.write_extract(out, cf.revise_extract(e, data_format="stata"), str(tmp_path / "s"))
    with pytest.raises(ValueError, match="not available"):
        cf.run_extract(cf.define_extract(**{**SPEC, "variables": ["NOPE"]}), p, h, keys=["SERIAL"])


def test_collections(spark):
    assert {"usa", "cps"} <= {r["code"] for r in cf.collections(spark).collect()}
    own = {**ex.COLLECTIONS, "mine": "My collection"}
    assert ex.known_collections(own) == [*ex.known_collections(), "mine"]
    assert ("My collection", "mine") in {tuple(r) for r in cf.collections(spark, own).collect()}
    assert cf.extract_from_json(ex.to_json(cf.define_extract(**SPEC)), "mine", own).collection == "mine"
    with pytest.raises(TypeError):
        ex.COLLECTIONS["mine"] = "My collection"


def test_subsample_keeps_households_whole(spark):
    df = spark.range(3000).select((F.col("id") / 3).cast("int").alias("SERIAL"))
    out = cf.subsample(df, 0.2, ["SERIAL"])
    sizes = {r["count"] for r in out.groupBy("SERIAL").count().collect()}
    assert sizes == {3} and 400 < out.count() < 800
    assert out.count() == cf.subsample(df, 0.2, ["SERIAL"]).count()
    with pytest.raises(ValueError):
        cf.subsample(df, 2.0)
