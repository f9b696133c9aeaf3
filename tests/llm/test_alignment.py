import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from codeframe.llm import alignment as L


@pytest.fixture(scope="module")
def pair():
    return L.byte_level(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN), L.pieces(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def by_hand(texts, pair, libraries):
    """The result rows of all texts, with the libraries' own encoders and plain loops."""
    linked, out = [], []
    for t in texts:
        x, y = (libraries[0].encode(" " + t, add_special_tokens=False).ids, libraries[1].encode(t)) if t else ([], [])
        spans = []
        for ids, side in ((x, pair[0]), (y, pair[1])):
            at, own = 0, []
            for i in ids:
                own.append((i, at, at + len(side.token_bytes[i])))
                at = own[-1][2]
            spans.append(own)
        if not t or any(b"".join(side.token_bytes[i] for i, _, _ in own) != b" " + t.encode() for own, side in zip(spans, pair)):
            linked.append(Counter())
            out.append([0, 0, 0, ""])
            continue
        common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        start, groups = 0, []
        for end in common:
            groups.append("|".join(",".join(str(i) for i, p, q in own if start <= p and q <= end) for own in spans) if len(t) < 400 else None)
            start = end
        i = j = 0
        c = Counter()
        while i < len(x) and j < len(y):
            c[x[i], y[j]] += 1
            p, q = spans[0][i][2], spans[1][j][2]
            i, j = i + (p <= q), j + (q <= p)
        linked.append(c)
        out.append([len(x), len(y), len(common), hashlib.sha256(";".join(groups).encode()).hexdigest() if len(t) < 400 else None])
    held = Counter(p for c in linked for p in c)
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    for row, c in zip(out, linked):
        row[3:3] = [sum(c.values()), sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items())]
    return [tuple(r) for r in out]


def values(rows, want):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256 if w[6] is not None else None) for r, w in zip(rows, want)]


def odd_texts():
    rng = random.Random(8)
    fixed = [None, "", " ", "a", "  two  blanks", "line\nbreak\t", "don't <s> </s> <unk> <|endoftext|> <0x41>", "漢字かな交じり文 😀😀 é é ﬁ", "▁x", "\x00\x01", "a" * 300, "ab" * 150, "x y　z"]
    return fixed + ["".join(rng.choice(["the ", "ing", "é", "漢", "\n", "1.", "Ñ", "😀", "qu", " ", "x"]) for _ in range(rng.randint(1, 70))) for _ in range(150)]


@pytest.mark.parametrize("size,fan,entries", [(L.RANGE, L.FAN, L.ENTRIES), (9, 2, 40), (16, 3, 900)])
def test_like_by_hand(spark, docs, pair, libraries, size, fan, entries):
    texts = odd_texts()
    want = by_hand(texts, pair, libraries)
    rows = sorted(L.align(docs(list(enumerate(texts))), *pair, size, fan, entries).collect(), key=lambda r: r.doc_id)
    assert values(rows, want) == want
    assert sum(w[0] > 0 for w in want) > 120


def test_composition_is_associative(pair):
    tables = L.Tables(*pair)
    rng = random.Random(2)
    for _ in range(60):
        text = "".join(rng.choice(["the", " and", "ing", "é", "漢字", "\n", " "]) for _ in range(rng.randint(3, 60)))
        (a,), (b,) = (np.array(x, np.int64) for x in (tables.encode_a([text]), tables.encode_b([text])))
        a_end, b_end = np.cumsum(tables.a_length[a]), np.cumsum(tables.b_length[b])
        if a_end[-1] != b_end[-1]:
            continue
        edges = np.array([0, *sorted(rng.sample(range(1, a_end[-1]), min(a_end[-1] - 1, 7))), a_end[-1]])
        parts = []
        for lo, hi in zip(edges[:-1], edges[1:]):
            p, q = (slice(*np.searchsorted(e, [lo, hi], "right")) for e in (a_end, b_end))
            parts.append(L.fragment(a[p], a_end[p], b[q], b_end[q], tables))
        plain = L.whole(L.compose(parts, tables), tables)
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i: i + 2] = [L.compose(parts[i: i + 2], tables)]
        other = L.whole(parts[0], tables)
        one = L.whole(L.fragment(a, a_end, b, b_end, tables), tables)
        for x in (plain, other):
            assert (x.text, x.groups, x.pairs.tolist(), x.times.tolist()) == (one.text, one.groups, one.pairs.tolist(), one.times.tolist())
        assert all(not len(x) for x in one.suffix)


def test_odd_rows(spark, docs, pair):
    long = "word and more words " * 20_000
    rows = L.align(docs([(1, "same text"), (1, "same text"), (None, "same text"), (1, "other"), (2, long), (2, long), (None, None)]), *pair).collect()
    assert len(rows) == 7 and len({r for r in rows if r.n_a == 2 and r.doc_id == 1}) == 1
    assert sorted((r.doc_id or 0, r.n_a > 0) for r in rows) == [(0, False), (0, True), (1, True), (1, True), (1, True), (2, True), (2, True)]
    twins = [r for r in rows if r.doc_id == 2]
    assert twins[0] == twins[1] and twins[0].n_links == twins[0].n_a + twins[0].n_b - twins[0].n_groups
    assert L.align(docs([]), *pair).count() == 0


def test_whole_table(spark, sf, pair, libraries):
    t = pq.read_table(f"{sf}/documents.parquet").sort_by("doc_id").to_pydict()
    want = by_hand(t["text"], pair, libraries)
    rows = sorted(L.align(spark.read.parquet(f"{sf}/documents.parquet"), *pair, 2000, 4, 5000).collect(), key=lambda r: r.doc_id)
    assert values(rows, want) == want
