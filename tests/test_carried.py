import random
import re

import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe.codebook import Codebook, Variable
from codeframe.metadata import all_meta
from codeframe.sources import carried, sinks

V = lambda name, a, b, types, **kw: Variable(name, name.lower(), start=a, end=b, rectypes=types, **kw)
VARS = (V("RT", 1, 1, ("H", "F", "P")), V("SERIAL", 2, 6, ("H", "F", "P"), var_type="integer"), V("HNAME", 7, 12, ("H",)),
        V("HW", 30, 37, ("H",), var_type="numeric", imp_decim=2), V("FNO", 7, 8, ("F",), var_type="integer"), V("FTYPE", 20, 21, ("F",)),
        V("PNO", 9, 14, ("P",), var_type="integer"), V("NAME", 40, 44, ("P",)))


def book(folder, types=("H", "F", "P"), charset="ISO-8859-1", keyvars=None):
    path = str(folder)
    return Codebook(variables=VARS, file_name=path.rsplit("/", 1)[1], file_path=path.rsplit("/", 1)[0], file_type="hierarchical", rectypes=types,
                    rectype_idvar="RT", keyvars=keyvars or {t: ("SERIAL",) for t in types}, file_encoding=charset)


def line(rt, serial, **fields):
    text = [" "] * 44
    for name, value in {"RT": rt, "SERIAL": f"{serial:5d}", **fields}.items():
        v = next(x for x in VARS if x.name == name)
        text[v.start - 1: v.end] = f"{value:<{v.width}}"
    return "".join(text)


def random_file(rng, families):
    """(lines, rows): the lines of a file, and each person with what stands above it."""
    lines, rows = [], []
    for serial in range(1, 60):
        h = (f"hé{serial}", serial * 125)
        lines.append(line("H", serial, HNAME=h[0], HW=f"{h[1]:8d}"))
        f, first = None, True
        for no in range(rng.choice([0, 1, 2, 3, 40 if serial % 20 == 0 else 4])):
            if families and rng.random() < 0.4:
                f = (no, rng.choice("xy"))
                lines.append(line("F", serial, FNO=f"{no:2d}", FTYPE=f[1]))
                first = True
            if rng.random() < 0.1:
                lines.append("X no such type")
            lines.append(line("P", serial, PNO=f"{no:6d}", NAME="Zoë"))
            rows.append((serial, h[0], h[1] / 100, *(f or (None, None)), no, "Zoë", first))
            first = False
    return lines, rows


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "400b")
    yield
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


@pytest.mark.parametrize("families", [False, True])
def test_like_the_lines_say(spark, tmp_path, small_splits, families):
    lines, rows = random_file(random.Random(3), families)
    (tmp_path / "data").mkdir()
    cut = [0, 7, 8, 61, 100, len(lines)]  # files that begin amid a household too
    for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
        (tmp_path / "data" / f"part-{i}.dat").write_bytes("".join(x + "\n" for x in lines[a:b]).encode("latin-1"))
    types = ("H", "F", "P") if families else ("H", "P")
    df = cf.read_micro_rectangular(spark, book(tmp_path / "data", types), unmatched="null" if families else "error", first="FIRST")
    assert df.rdd.getNumPartitions() > 10
    names = ["SERIAL", "HNAME", "HW", "FNO", "FTYPE", "PNO", "NAME", "FIRST"]
    want = rows if families else [(s, h, w, None, None, n, z, f) for s, h, w, _, _, n, z, f in rows]
    got = [tuple(r[c] if c in df.columns else None for c in names) for r in df.collect()]
    if families:  # without a family above, the household does not fit either way: only the first variables of the innermost
        want = [r for r in want]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert all_meta(df)["HNAME"].label == "hname"


def test_same_as_the_join_without_moving_persons(spark, tmp_path):
    h = spark.range(1, 3000).select(F.col("id").cast("int").alias("SERIAL"), F.concat(F.lit("h"), F.col("id")).alias("HNAME"), (F.col("id") * 1.25).alias("HW"))
    p = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 2999 + 1).cast("int").alias("SERIAL"), F.col("id").cast("int").alias("PNO"), F.lit("n").alias("NAME"))
    sinks.write_hierarchical(h, p, str(tmp_path / "data"), list(VARS), "RT", {"H": h, "P": p}, keys=["SERIAL"], order=["PNO"])
    b = book(tmp_path / "data", ("H", "P"), "US-ASCII")
    df = cf.read_micro_rectangular(spark, b, first="FIRST")
    parts = cf.read_micro_list(spark, b)
    want = cf.rectangularize(parts["P"], parts["H"], ["SERIAL"])
    cols = ["SERIAL", "HNAME", "HW", "PNO", "NAME"]
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    firsts = df.where("FIRST").select("SERIAL", "PNO")
    assert sorted(map(tuple, firsts.collect())) == sorted(map(tuple, p.groupBy("SERIAL").agg(F.min("PNO")).collect()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    above_persons = plan[: plan.index("BroadcastExchange")]
    assert "MapInArrow" in above_persons and not re.search(r"\bExchange\b", above_persons)
    # the persons' branch is the one that streams through the broadcast join
    assert plan.count("MapInArrow") == 1


def test_without_a_line_above(spark, tmp_path):
    rows = [line("P", 1, PNO="     1"), line("H", 2, HNAME="two"), line("P", 2, PNO="     2"), line("P", 3, PNO="     3"), line("H", 4, HNAME="four")]
    (tmp_path / "data.dat").write_text("\n".join(rows) + "\n")
    b = book(tmp_path / "data.dat", ("H", "P"))
    got = cf.read_micro_rectangular(spark, b, unmatched="null").select("SERIAL", "HNAME", "PNO").collect()
    assert sorted(map(tuple, got)) == [(1, None, 1), (2, "two", 2), (3, None, 3)]
    with pytest.raises(Exception, match="no line above"):
        cf.read_micro_rectangular(spark, b).collect()
    with pytest.raises(ValueError, match="unmatched"):
        cf.read_micro_rectangular(spark, b, unmatched="drop")


def test_chosen_variables_charsets_and_empty_file(spark, tmp_path):
    rows = [line("H", 2, HNAME="zwölf"), line("P", 2, PNO="     2", NAME="Ñandú")]
    for charset in ("UTF-8", "ISO-8859-1"):
        (tmp_path / charset).mkdir()
        (tmp_path / charset / "a.dat").write_text("\n".join(rows), encoding=charset)
        df = cf.read_micro_rectangular(spark, book(tmp_path / charset, ("H", "P"), charset), vars=["HNAME", "NAME"], first="F1")
        assert df.columns == ["SERIAL", "HNAME", "NAME", "F1"] and tuple(df.first()) == (2, "zwölf", "Ñandú", True)
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.dat").write_text("")
    assert cf.read_micro_rectangular(spark, book(tmp_path / "none", ("H", "P"))).count() == 0


def test_table_of_splits_that_is_too_large_to_broadcast(spark, tmp_path, small_splits, monkeypatch):
    from codeframe.streaming import chunks

    monkeypatch.setattr(chunks, "MAX_BROADCAST_SPLITS", 0)
    lines, rows = random_file(random.Random(4), False)
    (tmp_path / "data.dat").write_bytes("".join(x + "\n" for x in lines).encode("latin-1"))
    df = cf.read_micro_rectangular(spark, book(tmp_path / "data.dat", ("H", "P")), first="FIRST")
    got = df.select("SERIAL", "HNAME", "PNO", "FIRST").collect()
    assert sorted(map(tuple, got)) == sorted((r[0], r[1], r[5], r[7]) for r in rows)


def test_compact_lines(spark):
    variables = [VARS[3], VARS[0], VARS[1], VARS[7]]
    text = line("H", 7, HW="    1234")
    raw, moved = carried.compact(F.col("value"), variables, "ISO-8859-1")
    cut = spark.createDataFrame([(text,), (text[:33],), ("",)], "value string").select(raw.cast("string").alias("c")).collect()
    assert cut[0].c == text[0:6] + text[29:37] + text[39:44] and cut[1].c == text[0:6] + text[29:33] and cut[2].c == ""
    assert [(v.name, v.start, v.end) for v in moved] == [("HW", 7, 14), ("RT", 1, 1), ("SERIAL", 2, 6), ("NAME", 15, 19)]
