import random

import pyarrow.parquet as pq
from brute import WORD, lower

from codeframe.llm import paragraphs as P


def brute(rows, n=50):
    """{(id, start, end, words)}: stretches of words in runs of n words that stood before."""
    seen, out = set(), set()
    for i, t in sorted({(i, t or "") for i, t in rows if i is not None}):
        at, marks = [], []
        words = [(m.start(), m.end(), m.group()) for m in WORD.finditer(lower(t))]
        byte = lambda k: len(t[:k].encode())
        for p in range(len(words) - n + 1):
            key = tuple(w for *_, w in words[p: p + n])
            if key in seen:
                marks.append(p)
            seen.add(key)
        for p in marks:
            if at and p <= at[-1][1] + n:
                at[-1][1] = p
            else:
                at.append([p, p])
        out |= {(i, byte(words[a][0]), byte(words[b + n - 1][1]), b - a + n) for a, b in at}
    return out


def found(df):
    return sorted((r.doc_id, r.start, r.end, r.words) for r in P.repeated_passages(df).collect())


def test_passage_inside_longer_lines(docs):
    shared = " ".join(f"s{i}" for i in range(51))
    line = lambda k, n: " ".join(f"{k}_{i}" for i in range(n))
    rows = [(1, f"{line('a', 20)} {shared} {line('b', 100)}"), (2, f"é {line('c', 9)}\n{line('d', 12)} {shared.upper()} {line('e', 12)}"),
            (3, line("f", 5) + " " + shared.replace(" ", "\n") + "\n" + line("g", 30)), (4, " ".join(shared.split()[:49])), (None, shared), (1, f"{line('a', 20)} {shared} {line('b', 100)}")]
    got = P.repeated_passages(docs(rows)).orderBy("doc_id").collect()
    assert [(r.doc_id, r.line, r.words, r.first_doc_id, r.first_line, r.removed) for r in got] == [(2, 1, 51, 1, 0, True), (3, 0, 51, 1, 0, True)]
    assert rows[1][1].encode()[got[0].start: got[0].end].decode() == shared.upper()
    assert not [r for r in P.repeated_paragraphs(docs(rows)).collect() if r.removed]


def test_against_brute_force(docs):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(400)]
    texts = [[rng.choice(pool) for _ in range(rng.randint(0, 300))] for _ in range(40)]
    for _ in range(60):
        a, b, n = rng.choice(texts), rng.choice(texts), rng.randint(45, 120)
        k = rng.randint(0, max(0, len(a) - n))
        b[(j := rng.randint(0, len(b))): j] = a[k: k + n]
    rows = [(i, "".join(w + rng.choice([" ", " ", "\n", "  "]) for w in t)) for i, t in enumerate(texts)]
    rows += [(100, None), (101, ""), (102, "again " * 200)]
    want = brute(rows)
    assert found(docs(rows)) == sorted(want) and len(want) > 20
    assert found(docs([])) == []


def test_whole_table(spark, sf):
    from codeframe.llm.queries import op5_paragraph_dedup
    rows = list(zip(*pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))
    got = sorted((r.doc_id, r.start, r.end, r.words) for r in op5_paragraph_dedup(spark, sf).where("kind = 'passage'").collect())
    assert got == sorted(brute(rows)) and got


def test_much_held_passage(spark, docs, monkeypatch):
    """A passage of most documents, in pieces of several lengths, next to whole copies and to a repeated row."""
    monkeypatch.setattr(P, "LEAST_HOT", 5)
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(5000)]
    shared = [f"s{i}" for i in range(90)]
    rows = []
    for i in range(300):
        n = rng.randint(48, 90)
        k = rng.randint(0, 90 - n)
        rows.append((i, " ".join(rng.choices(pool, k=rng.randint(0, 40)) + shared[k: k + n] + rng.choices(pool, k=rng.randint(0, 40)))))
    rows += [(400 + i, rows[7][1]) for i in range(30)] + [rows[11], rows[450 - 400]]
    want = brute(rows)
    calls = []
    kept = P._much_held
    monkeypatch.setattr(P, "_much_held", lambda *a: calls.append(len(a[1])) or kept(*a))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert found(docs(rows)) == sorted(want) and len(want) > 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert calls and 0 < calls[0] < 4 * 64
