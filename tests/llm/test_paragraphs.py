import random

import pyarrow.parquet as pq
from brute import WORD, groups, lower, shingle_set

from codeframe.llm import paragraphs as P


def run(df, **kw):
    return sorted((r.doc_id, r.line, r.first_doc_id, r.first_line, r.removed) for r in P.repeated_paragraphs(df, **kw).collect())


def expected(rows, min_words):
    sets = {(i, j): shingle_set(line) for i, t in rows if i is not None for j, line in enumerate((t or "").split("\n")) if len(WORD.findall(line)) >= min_words}
    root = groups(sets)
    size = {}
    for k in root.values():
        size[k] = size.get(k, 0) + 1
    return sorted((*k, *r, k != r) for k, r in root.items() if size[r] > 1)


def test_against_all_pairs(docs):
    rng = random.Random(5)
    passages = [[f"p{k}_{i}" for i in range(60)] for k in range(6)]
    rows = []
    for i in range(60):
        lines = [" ".join(f"d{i}_{j}_{k}" for k in range(rng.randint(1, 40))) for j in range(4)]
        for p in rng.sample(passages, 2):
            w = list(p)
            if rng.random() < 0.5:
                w[rng.randrange(60)] = "other"
            lines.insert(rng.randrange(5), " ".join(w))
        rows.append((i, "\n".join(lines)))
    assert run(docs(rows), recall=0.9999, group=4) == expected(rows, 20)


def test_odd_rows(docs):
    line = " ".join(f"w{i}" for i in range(30))
    long = "\n".join(" ".join(f"z{i}_{j}" for j in range(25)) for i in range(2000))
    rows = [(1, None), (2, ""), (3, "\n\n" + line + "\n"), (4, "é\n" + line.upper()), (5, "short line"), (6, "short line"), (7, line + "\n" + line), (8, long), (9, long),
            (10, line), (10, line), (None, line)]
    got = run(docs(rows))
    assert [g for g in got if g[0] < 8] == [(3, 2, 3, 2, False), (4, 1, 3, 2, True), (7, 0, 3, 2, True), (7, 1, 3, 2, True)]
    assert sum(g[0] == 9 and g[4] for g in got) == 2000 and not any(g[4] for g in got if g[0] == 8)
    assert [g for g in got if g[0] == 10] == [(10, 0, 3, 2, True)] * 2
    places = {(r.doc_id, r.line): (r.start, r.end) for r in P.repeated_paragraphs(docs(rows)).collect()}
    assert rows[3][1].encode()[slice(*places[4, 1])].decode() == line.upper()
    kept = {r.doc_id: r.text for r in P.without_repeats(docs(rows)).collect()}
    assert kept[1] is None and kept[2] == "" and kept[4] == "é" and 7 not in kept and 9 not in kept and kept[8] == long and kept[None] == line
    assert P.without_repeats(docs(rows)).columns == docs([]).columns
    assert run(docs([])) == [] and P.without_repeats(docs([])).count() == 0


def test_whole_table(spark, sf):
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    rows = list(zip(t["doc_id"], t["text"]))
    want, got = set(expected(rows, 20)), set(run(spark.read.parquet(f"{sf}/documents.parquet")))
    assert len(want & got) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(want) + 2


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.999):
        bands, rows = P.tune_bands(0.75, recall)
        assert 1 - (1 - 0.75 ** rows) ** bands >= recall and bands * rows <= 64
    assert lower("ÀZa") == "Àza"
