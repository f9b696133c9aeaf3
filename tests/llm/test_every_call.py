import json

from codeframe.llm import tool_calls as C

SCHEMAS = {"ping": {}}


def frames(spark, calls, results):
    return (spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string, parent string"),
            spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string"))


def test_ids_numbered_in_each_conversation(spark):
    calls = [(c, 2 * k, f"call_{k}", "ping", "{}", f"call_{k - 1}" if k else None) for c in range(30) for k in range(3)]
    calls += [(None, 0, "call_0", "ping", "{}", None), (None, 2, "call_1", "ping", "{}", "call_0"), (99, 0, "call_1", "ping", "{}", "call_0")]
    results = [(c, f"call_{k}", 2 * k + 1, f"{c}/{k}") for c in [*range(30), None] for k in range(2)]
    got = {(r.conv_id, r.call_id): r for r in C.link_tool_calls(*frames(spark, calls, results), SCHEMAS).collect()}
    assert len(got) == len(calls)
    for c, _, i, *_ in calls:
        r, k = got[c, i], int(i[-1])
        if c == 99:
            assert (r.level, r.errors) == (0, "missing parent; no result")
        else:
            assert r.level == k and json.loads(r.message)["content"] == (f"{c}/{k}" if k < 2 else None)
            assert r.errors == (None if k < 2 else "no result")


def test_every_row_comes_out(spark):
    n = 500
    calls = [(1, i, "hot", "ping", "{}", "root" if i == 7 else None) for i in range(n)] + [(1, 0, "root", "ping", "{}", None)]
    calls += [(1, 5, None, "ping", "{}", "root"), (1, 6, None, "ping", "{}", None)]
    results = [(1, "hot", 1000 + i, str(i)) for i in range(n + 20)] + [(1, "root", 1, "x"), (1, "root", 1, "x"), (2, "hot", 1, "lost"), (None, None, 4, "no id")]
    got = C.link_every_call(*frames(spark, calls, results), SCHEMAS).collect()
    assert sum(r.is_call for r in got) == len(calls) and sum(r.result_turn is not None for r in got) == len(results)
    hot = sorted((r for r in got if (r.conv_id, r.call_id) == (1, "hot")), key=lambda r: r.no)
    assert [r.no for r in hot] == list(range(1, n + 21)) and {r.n_results for r in hot} == {n + 20}
    assert all(r.turn == i and r.errors == "id used again" and json.loads(r.message)["content"] == str(i) for i, r in enumerate(hot[:n]))
    assert all(r.turn is None and r.errors == "result again" and json.loads(r.message)["content"] == str(n + i) for i, r in enumerate(hot[n:]))
    assert hot[7].level == 1 and hot[8].level == 0
    other = sorted((r.conv_id or 0, r.call_id or "", r.no or 0, r.level if r.is_call else -1, r.errors or "") for r in got if (r.conv_id, r.call_id) != (1, "hot"))
    assert other == [(0, "", 0, -1, "no call id; result without call"), (1, "", 0, 0, "no call id; no result"), (1, "", 0, 1, "no call id; no result"),
                     (1, "root", 1, 0, ""), (1, "root", 2, -1, "result again"), (2, "hot", 1, -1, "result without call")]
