import re
from collections import Counter, defaultdict

import pytest
from brute import WORD

from codeframe.llm import mixing as M


def water_fill(sizes, weights, share=1.5, most=2):
    """Targets by repeated resharing."""
    full, left = set(), share * sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in full]
        w = sum(weights[s] for s in open_)
        goal = {s: left * weights[s] / w for s in open_} if w else {}
        over = [s for s in open_ if goal[s] > most * sizes[s]]
        if not over:
            return {**goal, **{s: most * sizes[s] for s in full}}
        for s in over:
            full.add(s)
            left -= most * sizes[s]


def test_targets_and_words(docs):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), f"s{'abcdefg'[i % 7]}" if i % 11 else None) for i in range(400)]
    rows += [(1000, None, "sa"), (1001, "", "sb"), (1002, " \n", None), (5, "w w w", "sa"), (5, "w w w", "sa"), (None, "w " * 9, "sc"), (1003, "w " * 20_000, "sd"), (1004, "", "empty")]
    got = M.mix_sources(docs(rows), [5, 2, 1], block=64).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    goal = water_fill(sizes, weights)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 1 for s in goal)
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len(WORD.findall(t or ""))) for i, t, _ in rows)
    again = M.mix_sources(docs(rows[::-1]).repartition(7), [5, 2, 1], block=64).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert M.mix_sources(docs([]), [5, 2, 1]).count() == 0


def test_every_stretch_of_the_schedule_has_the_weights(spark):
    goals = spark.createDataFrame([("a", 0, 5000 * 8), ("b", 1, 2000 * 8), ("c", 2, 1000 * 8), ("d", 3, 3)], "source string, s int, quota long")
    rows = sorted((r.slot, r.s, r["rank"]) for r in M.schedule(goals, 8).collect())
    assert len(rows) == 8001 and len({r[0] for r in rows}) == 8001
    for s, n in ((0, 5000), (1, 2000), (2, 1000), (3, 1)):
        assert sorted(r[2] for r in rows if r[1] == s) == list(range(n))
    for start in range(0, 7500, 500):
        part = [r[1] for r in rows[start: start + 500]]
        assert abs(part.count(0) - 312.5) < 8 and abs(part.count(1) - 125) < 8
    for s in (0, 1, 2):  # ranks follow the slots, but for the few that are put behind
        ranks = [r[2] for r in rows if r[1] == s]
        assert ranks == sorted(ranks)


def test_mixed_documents(docs):
    rows = [(i, "".join(f"w{j} \n" for j in range(1 + i % 30)), f"s{i % 3}") for i in range(200)] + [(900, "", "s1"), (901, None, "s0"), (7, "one two", "s2")]
    df = docs(rows)
    per = {(r.doc_id, r.size): r.taken for r in M.mix_sources(df, [5, 2, 1]).collect()}
    out = M.mixed_documents(df, [5, 2, 1])
    assert out.columns == df.columns
    got = defaultdict(int)
    texts = {(i, len(WORD.findall(t or ""))): t for i, t, _ in rows}
    for r in out.collect():
        n = len(WORD.findall(r.text or ""))
        fit = [k for k in texts if k[0] == r.doc_id and (texts[k] or "").startswith(r.text or "")]
        assert fit
        got[fit[0]] += n
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in per.items() if v}
    assert {r.doc_id for r in out.where("doc_id >= 900").collect()} == {900, 901}
    assert M.mixed_documents(docs([]), [5, 2, 1]).count() == 0


def test_mixed_documents_hold_no_schedule_in_their_plan(docs):
    """Schedule and words taken are jobs of their own, so that the last job holds few stages and broadcasts at once."""
    out = M.mixed_documents(docs([(i, "some words here " * i, f"s{i % 3}") for i in range(12)]), [5, 2, 1], block=4)
    assert "Range (" not in out._jdf.queryExecution().toString()


def test_mixed_documents_move_texts_once(spark, docs):
    """The window that tells equal rows apart and the join with the words taken share one shuffle."""
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = M.mixed_documents(docs([(i, "some words here " * (1 + i), f"s{i % 3}") for i in range(12)]), [5, 2, 1], block=4)
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        moved = re.findall(r"\) Exchange\s+Input \[\d+\]: \[([^\]]*)\]", out._jdf.queryExecution().explainString(mode))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert sum("text#" in x for x in moved) == 1


def test_mixed_documents_of_equal_and_nameless_rows(docs):
    """Rows equal in id, source and size get their words by turn: none is lost, none comes more often than epochs take it."""
    rows = [(3, "a b c d", "s0"), (3, "a b c d", "s0"), (3, "w x y z", "s0"), (3, "q r", "s0"), (3, "a b c d", "s1"), (3, "a b c d", None), (None, "a b c d", "s0"),
            (None, "a b c d", "s0"), (None, "a b c d", None), (None, None, "s0"), (4, "", None), (5, " ".join(f"v{i}" for i in range(50)), "s1")]
    words = lambda t: len(WORD.findall(t or ""))
    taken = Counter()
    for r in M.mix_sources(docs(rows), [5, 2, 1], block=3).collect():
        taken[r.doc_id, r.source, r.size] += r.taken
    got, times = Counter(), Counter()
    for r in M.mixed_documents(docs(rows), [5, 2, 1], block=3).collect():
        fit = [x for x in rows if x[0] == r.doc_id and x[2] == r.source and (x[1] or "").startswith(r.text or "")]
        assert fit
        got[r.doc_id, r.source, min(words(x[1]) for x in fit)] += words(r.text)
        times[r.doc_id, r.source, r.text] += 1
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in taken.items() if v}
    assert times[None, "s0", None] == times[4, None, ""] == 1
    assert all(n <= 2 * sum(x[0] == i and x[2] == s and (x[1] or "").startswith(t or "") for x in rows) for (i, s, t), n in times.items())
