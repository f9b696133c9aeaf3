import random
import re

import pytest

from codeframe.llm import license_scan as L

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(text):
    w = words(text)
    places = [(i, label) for label, phrase in BASE.items() for i in range(len(w)) if w[i: i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def random_texts(n):
    rng = random.Random(3)
    parts = ["MIT", "license", "Apache", "General", "public", "PUBLIC", "general", "the", "é", "mit-license", "x1", "License.", "Kit", "lİcense", "Kit"]
    return ["".join(rng.choice(parts) + rng.choice([" ", "\n", ", ", "\x00", "-"]) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_base_places(spark, docs):
    texts = [None, "", " ", "...", "mit", "MIT LICENSE", "the MIT\nLicense MIT license", "general public public license", "a " * 50_000 + "Apache License",
             "mit license " * 30_000, "general public license general public license"] + random_texts(400)
    got = {r.doc_id: r for r in L.license_scan(docs(list(enumerate(texts)))).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == by_hand(t)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and r.score == (1.0 if r.n_base else r.score)


def test_notices_with_changed_words(spark, docs):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    w = notice.split()
    changed = {1: notice, 2: " ".join(w[:6] + ["indeed"] + w[6:]), 3: " ".join(w[:9] + w[10:]), 4: " ".join(w[:7]), 5: " ".join(reversed(w)),
               6: "Licensed under CC BY-NC 4.0.", 7: "x " * 70 + notice + " y" * 9}
    got = {r.doc_id: (r.labels, r.score) for r in L.license_scan(docs(list(changed.items()))).collect()}
    assert got[1] == got[7] == ("mit-text", 1.0) and got[4] == got[5] == ("", 0.0) and got[6] == ("cc-by", 1.0)
    assert got[2][0] == got[3][0] == "mit-text" and 0.75 <= got[3][1] < 1.0
    assert got[2][1] == 1.0  # an added word moves the rest to a neighbouring diagonal


def test_long_template_and_one_word(spark, docs):
    long = " ".join(f"w{i}" for i in range(150))
    got = {r.doc_id: r for r in L.license_scan(docs([(1, long + " sole"), (2, long[: len(long) // 2]), (3, "sole sole")]),
                                               [L.Template("one", "sole")], [L.Template("long", long, 0.9)]).collect()}
    assert (got[1].labels, got[1].score, got[1].n_base, got[1].first_word) == ("long,one", 1.0, 1, 150)
    assert got[2].labels == "" and (got[3].n_base, got[3].first_word, got[3].last_word) == (2, 0, 1)


def test_odd_rows(spark, docs):
    t = "under the MIT license"
    rows = L.license_scan(docs([(1, t), (1, t), (None, t), (None, None), (2, t), (1, "other")])).collect()
    assert sorted((r.doc_id or 0, r.n_base, r.n_words) for r in rows) == [(0, 0, 0), (0, 1, 4), (1, 0, 1), (1, 1, 4), (1, 1, 4), (2, 1, 4)]
    assert L.license_scan(docs([])).count() == 0
    with pytest.raises(ValueError):
        L.license_scan(docs([(1, t)]), [], [])
