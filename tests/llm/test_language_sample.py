import random

import numpy as np
import pyarrow as pa

from codeframe.llm import lang_crf as L
from codeframe.llm import text as T

SCHEMA = "doc_id long, text string, lang string"


def made(rng, letters, n):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n))


def test_elements_cover_every_byte():
    texts = ["", "short words only", "漢字仮名" * 30, "a" * 100, "é" * 9 + " x " + "𝄞" * 20, " \n "]
    for _, _, data, offsets in T.blocks(pa.array(texts, pa.large_string())):
        starts, ends, first = L.elements(data, offsets)
        assert (ends > starts).all() and (ends - starts).max() <= 16
        for i, t in enumerate(texts):
            parts = [data[a:b].tobytes().decode() for a, b in zip(starts[first[i]: first[i + 1]], ends[first[i]: first[i + 1]])]
            assert "".join(parts) == "".join(t.split())
        assert len(T.word_hashes(data, starts)) == len(starts) and np.all(np.diff(starts) > 0)


def test_rare_language_scripts_without_blanks_and_late_switch(spark):
    rng = random.Random(4)
    rows = [(i, made(rng, "abcdefgh", 40), "aa") for i in range(3000)]
    rows += [(10_000 + i, made(rng, "stuvwxyz", 40), "ss") for i in range(6)]
    rows += [(20_000 + i, "".join(rng.choices("漢字仮名文書語", k=300)), "hh") for i in range(30)]
    rows += [(30_000 + i, "".join(rng.choices("가나다라마바사", k=300)), "kk") for i in range(30)]
    # a language that stands only behind a long head of digits
    rows += [(40_000 + i, "1234 " * 600 + made(rng, "ijklmnop", 600), "ii") for i in range(30)]
    rows += [(50_000, None, "aa"), (50_001, "", "aa"), (None, "abc", "aa"), (50_002, "abc", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = L.learn(df, sample=100)
    assert model.labels == ["aa", "hh", "ii", "kk", "ss"]
    fresh = [(1, made(rng, "stuvwxyz", 30), "ss"), (2, "".join(rng.choices("漢字仮名文書語", k=200)), "hh"), (3, "".join(rng.choices("가나다라마바사", k=200)), "kk"),
             (4, made(rng, "ijklmnop", 30), "ii"), (5, made(rng, "abcdefgh", 30), "aa")]
    got = {r.doc_id: r.lang_pred for r in L.languages(spark.createDataFrame(fresh, SCHEMA), model).collect()}
    assert got == {i: lang for i, _, lang in fresh}
