import hashlib
import random

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

from codeframe.llm import bpe as B

FILES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


@pytest.fixture(scope="module", params=FILES)
def ranks(request):
    return B.read_ranks(None, public_tokenizers.path(request.param))


def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(4)
    fixed = ["", " ", "  a  b", "a \nb", "\x85 z", "a\x1c b", "don't we'll 123abc", "漢字かな交じり文 😀😀 é", "a" * 5000, "ab" * 3000, "<|endoftext|>", "x　 y  "]
    return fixed + ["".join(rng.choice(" \n\tabcdeé'漢😀1.") for _ in range(rng.randint(1, 60))) for _ in range(400)] + [
        "".join(rng.choice("abehint") for _ in range(rng.randint(1, 80))) for _ in range(400)]


def test_like_the_library(spark, ranks):
    texts = odd_texts()
    rows = {r.doc_id: r for r in B.encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ranks, public_tokenizers.PATTERN, True).collect()}
    enc = library(ranks)
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t)
        assert rows[i].ids == ids and rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_strings_encode_to_themselves(ranks):
    assert B.Vocabulary(ranks).check()


def test_words_by_higher_order_functions(spark):
    ranks = B.read_ranks(None, public_tokenizers.path(FILES[0]))
    rng = random.Random(1)
    words = ["", "a", " the", " quelle", "ción", "漢字", "\n\n", " 😀", "zzzzzzz"] + ["".join(rng.choice("abehintr é") for _ in range(rng.randint(1, 14))) for _ in range(60)]
    words = [w for w in words if w.isalpha() or w.strip() != w or not w or len(w) < 3]
    enc = library(ranks)
    got = {r.word: r.ids for r in B.encode_words(spark.createDataFrame([(w,) for w in words] + [(None,)], "word string"), ranks).collect()}
    assert got.pop(None) is None
    for w in got:
        assert got[w] == (enc._encode_single_piece(w) if w else [])


def test_odd_rows(spark, docs):
    ranks = B.read_ranks(None, public_tokenizers.path(FILES[0]))
    df = docs([(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (4, "long " * 50_000)]).withColumnRenamed("n", "n_tokens")
    out = B.encoded(df, ranks, public_tokenizers.PATTERN)
    assert out.columns == [c for c in df.columns if c not in ("text", "n_tokens")] + ["n_tokens", "ids_sha256", "decoded_sha256"]
    rows = out.collect()
    none = hashlib.sha256(b"").hexdigest()
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows if r.doc_id in (1, 2)] == [(0, none, none)] * 2
    assert len(rows) == 6 and len({r.ids_sha256 for r in rows if r.doc_id == 3}) == 1
    assert B.encoded(docs([]), ranks, public_tokenizers.PATTERN).count() == 0


def test_bounded_dictionary(monkeypatch):
    ranks = B.read_ranks(None, public_tokenizers.path(FILES[0]))
    monkeypatch.setattr(B, "REMEMBERED", 10)
    e, enc = B.Encoder(B.Vocabulary(ranks), public_tokenizers.PATTERN), library(ranks)
    for _ in range(3):
        texts = ["many different words here " + str(i) for i in range(30)]
        assert e.encode(texts) == [",".join(map(str, enc.encode_ordinary(t))) for t in texts]


def test_whole_table(spark, sf):
    ranks = B.read_ranks(None, public_tokenizers.path(FILES[0]))
    t = pq.read_table(f"{sf}/documents.parquet").to_pydict()
    enc = library(ranks)
    rows = {r.doc_id: r for r in B.encoded(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), ranks, public_tokenizers.PATTERN).collect()}
    for i, x in zip(t["doc_id"], t["text"]):
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, enc.encode_ordinary(x or ""))).encode()).hexdigest()
