import re
from collections import Counter

import corpus_pipeline as P
import pyarrow.parquet as pq
from brute import WORD, groups, lower, shingle_set
from test_passages import brute as brute_passages

from codeframe.llm import paragraphs
from codeframe.llm.tables import written


def assert_cut(before, after):
    """No run of 50 words stands twice any more."""
    def runs(texts):
        return Counter(tuple(w[p: p + 50]) for w in (WORD.findall(lower(t)) for t in texts) for p in range(len(w) - 49))

    was, now = runs(r.text for r in before.values()), runs(after.values())
    assert max(now.values()) == 1 and max(was.values()) > 1


def test_stages_one_by_one(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    labels = dict(zip(*pq.read_table(f"{sf}/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values()))
    stages = dict(P.STAGES)

    good = written(stages["quality classifier"](spark, docs, sf), "good")
    kept = {r.doc_id: r for r in good.collect()}
    assert good.columns == docs.columns and all(before[i] == r for i, r in kept.items())
    assert sum(labels[i] == (i in kept) for i in labels) >= 0.95 * len(labels)

    one = written(stages["n-gram Jaccard join"](spark, good, sf), "one")
    root = groups({i: shingle_set(r.text) for i, r in kept.items()})
    left = {r.doc_id: r for r in one.collect()}
    assert left == {i: r for i, r in kept.items() if root[i] == i} and one.columns == docs.columns

    cut = written(stages["substring dedup"](spark, one, sf), "cut")
    assert_cut(left, {r.doc_id: r.text for r in cut.collect()})
    assert cut.columns == docs.columns
    got = {r.doc_id: r.text for r in cut.collect()}

    # lines first
    lines = {(i, j): x for i, r in left.items() for j, x in enumerate(r.text.split("\n")) if len(WORD.findall(x)) >= 20}
    first = groups({k: shingle_set(x) for k, x in lines.items()})
    want = {}
    for i, r in left.items():
        text = "\n".join(x for j, x in enumerate(r.text.split("\n")) if first.get((i, j), (i, j)) == (i, j))
        if text == r.text or WORD.search(text):
            want[i] = text
    lines_cut = {r.doc_id: r.text for r in paragraphs.without_lines(one).collect()}
    assert sum(lines_cut[i] == t for i, t in want.items()) >= 0.99 * len(want)

    # then passages: every run of 50 words that stood before, and the blanks behind it
    spans = {}
    for i, a, b, _ in brute_passages(list(lines_cut.items())):
        spans.setdefault(i, []).append((a, b))
    want = {}
    for i, t in lines_cut.items():
        raw, at, out = t.encode(), 0, b""
        for a, b in sorted(spans.get(i, [])):
            out += raw[at:a]
            at = b + len(re.match(rb"[\x20\x09-\x0D]*", raw[b:]).group())
        text = (out + raw[at:]).decode()
        if text == left[i].text or WORD.search(text):
            want[i] = text
    assert got == want and spans

    mixed = written(stages["mixing sources"](spark, cut, sf), "mixed")
    assert mixed.columns == docs.columns
    rows = mixed.collect()
    assert all(got[r.doc_id].startswith(r.text) for r in rows) and max(Counter(r.doc_id for r in rows).values()) <= 2
    words = sum(len(WORD.findall(t)) for t in got.values())
    assert abs(sum(len(WORD.findall(r.text)) for r in rows) - 1.5 * words) <= len({r.source for r in rows}) + 1
    assert all(r.n_chars == len(r.text) for r in rows if r.text != before[r.doc_id].text)

    ids = written(stages["byte-level BPE"](spark, mixed, sf), "ids").collect()
    assert len(ids) == len(rows) and all(len(r.ids) == r.n_tokens for r in ids)


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, sf), "empty")
        assert docs.count() == 0
