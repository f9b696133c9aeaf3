import json

import duckdb

from codeframe.llm import tool_calls as C
from codeframe.llm.queries import TOOLS, op2_tool_call_linking

SCHEMAS = {"add": {"properties": {"a": {"type": "integer", "minimum": 0, "maximum": 10}, "b": {"type": "number"}, "mode": {"type": "string", "enum": ["x", "y"]}}, "required": ["a"]},
           "ping": {}}


def frames(spark, calls, results):
    return (spark.createDataFrame([(*c, "extra", 1) for c in calls], "conv_id long, turn long, call_id string, name string, arguments string, parent string, content string, level int"),
            spark.createDataFrame([(*r, "extra") for r in results], "call_id string, turn long, content string, name string"))


def run(spark, calls, results):
    return {r.call_id: r for r in C.link_tool_calls(*frames(spark, calls, results), SCHEMAS).collect()}


def test_links_and_errors(spark):
    calls = [(1, 0, "r", "add", '{"b": 1.5,  "a":3}', None), (1, 2, "s", "add", '{"a": 11, "zz": 1}', "r"), (1, 4, "t", "add", '{"a": "3", "mode": "q"}', "s"),
             (1, 6, "u", "ping", "{}", "t"), (1, 8, "v", "none", "{}", "gone"), (1, 9, "w", "add", "no json", None), (2, 0, "x", "add", "[1]", "y"), (2, 1, "y", "ping", "{}", "x"),
             (2, 2, "z", "ping", None, None), (3, 0, "dup", "ping", "{}", None), (3, 0, "dup", "ping", "{}", None), (3, 1, None, "ping", "{}", None), (None, None, "n", None, None, None),
             (4, 0, "long", "add", '{"a":1,"mode":"' + "x" * 100_000 + '"}', None)]
    results = [("r", 1, 'say "hi"\n'), ("r", 3, "again"), ("s", 3, None), ("orphan", 1, "lost"), (None, 1, "no id"), ("u", 7, ""), ("dup", 1, "d"), ("long", 1, "l")]
    got = run(spark, calls, results)
    assert {k: r.level for k, r in got.items()} == {"r": 0, "s": 1, "t": 2, "u": 3, "v": 0, "w": 0, "x": None, "y": None, "z": 0, "dup": 0, "n": 0, "long": 0, "orphan": None}
    assert {k: r.errors for k, r in got.items()} == {
        "r": None, "s": "a too large; unknown: zz", "t": "mode not allowed; no result; type of a", "u": None, "v": "missing parent; no result; unknown tool",
        "w": "arguments are no JSON; no result", "x": "arguments are no object; circle; no result", "y": "circle; no result", "z": "arguments are no JSON; no result",
        "dup": "id used again", "n": "arguments are no JSON; no result; unknown tool", "long": "mode not allowed", "orphan": "result without call"}
    assert got["r"].arguments == '{"a":3,"b":1.5}' and got["r"].n_results == 2
    for r in got.values():
        m = json.loads(r.message)
        assert list(m) == sorted(m) and json.dumps(m["arguments"], separators=(",", ":"), sort_keys=True) == (r.arguments or "null")
    assert json.loads(got["r"].message)["content"] == 'say "hi"\n' and json.loads(got["s"].message)["content"] is None
    assert run(spark, [], []) == {}


def test_long_chain(spark):
    n = 300
    got = run(spark, [(1, i, f"c{i}", "ping", "{}", f"c{i - 1}" if i else None) for i in range(n)], [])
    assert all(got[f"c{i}"].level == i for i in range(n))


def test_whole_table(spark, sf):
    chats = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf}/conversations.parquet'").fetchall()
    users = {(c, t): x for c, t, r, x in chats if r == "user"}
    answers = {(c, t - 1): x for c, t, r, x in chats if r == "assistant"}
    rows = {(r.conv_id, r.turn): r for r in op2_tool_call_linking(spark, sf).collect() if r.conv_id is not None}
    assert rows.keys() == users.keys()

    def level(k):
        up = (k[0], k[1] - 2)
        return 1 + level(up) if k[1] >= 2 and up in users else 0

    for k, text in users.items():
        m = json.loads(rows[k].message)
        assert m["arguments"] == {"query": text or "", "limit": k[1]} and m["content"] == answers.get(k) and m["level"] == level(k)
        name = ["search", "translate", "lookup"][len(text or "") % 3]
        wrong = ["unknown tool"] if name not in TOOLS else []
        rule = TOOLS.get(name, {}).get("properties", {}).get("limit", {})
        wrong += ["limit too small"] * (k[1] < rule.get("minimum", 0)) + ["limit too large"] * (k[1] > rule.get("maximum", 99))
        wrong += ["query too long"] * (name == "search" and len(text or "") > 400) + ["no result"] * (k not in answers)
        wrong += ["missing parent"] * (k[1] >= 2 and (k[0], k[1] - 2) not in users)
        assert m["errors"] == ("; ".join(sorted(wrong)) or None)
