"""License scans by diagonal voting: rolling word k-grams joined to template positions, votes by offset diagonal.

A place p of a text whose k words equal those at place q of a template votes for the diagonal p - q: if the template stands in the text from word d
on, all its k-grams vote for d. Missing or added words move the rest to a neighbouring diagonal, so neighbouring diagonals of a template are merged before
the span is verified: it must hold at least the template's share of the template's words. Only DataFrame functions are used.

The table of template places is the only broadcast: its size is the number of words in the templates, whatever the data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from codeframe.llm.tables import written

#: Longest k-gram of a template; shorter templates are one k-gram of their whole length.
K = 3
#: A mask column covers so many words of a template.
BITS = 62
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words that stand for a license.

    ``share``: the part of its words that a span must hold; ``drift``: how far apart two diagonals are that count as neighbours.
    """

    label: str
    text: str
    share: float = 1.0
    drift: int = 0

    @property
    def words(self) -> list[str]:
        return [w for w in re.split(SEPARATORS, self.text.translate(str.maketrans(_UPPER, _LOWER))) if w]


#: The names that the base counts: whole and in a row.
PHRASES = [Template("mit", "mit license"), Template("apache", "apache license"), Template("gpl", "general public license")]
#: Opening sentences of public license notices, found also where some words differ.
NOTICES = [Template(label, text, 0.75, 4) for label, text in [
    ("apache-notice", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution"),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-notice", "this source code form is subject to the terms of the mozilla public license"),
]] + [Template("cc-by", "licensed under cc by"), Template("proprietary", "all rights reserved")]


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case: runs of 0-9, a-z and characters beyond ASCII. Null has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), SEPARATORS), "")


def gram_length(template: Template) -> int:
    return min(K, len(template.words))


def places(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(k, grams, hits): for each distinct k-gram of the templates its (template, q, mask of the words it covers) everywhere it stands."""
    blocks = -(-max((len(t.words) for t in templates), default=1) // BITS)
    hits: dict[tuple[str, ...], list] = {}
    for number, t in enumerate(templates):
        if not t.words:
            raise ValueError(f"the template {t.label!r} has no words")
        for q in range(len(t.words) - gram_length(t) + 1):
            covered = sum(1 << i for i in range(q, q + gram_length(t)))
            masks = [covered >> (b * BITS) & ((1 << BITS) - 1) for b in range(blocks)]
            hits.setdefault(tuple(t.words[q: q + gram_length(t)]), []).append((number, q, masks))
    rows = [(len(gram), list(gram), found) for gram, found in hits.items()]
    return spark.createDataFrame(rows, "k int, gram array<string>, hits array<struct<template int, q int, masks array<long>>>")


def _votes(texts: DataFrame, templates: list[Template]) -> DataFrame:
    """(doc_id, tid, n_words, hits): a row for each text with its number of words, and one for each place that votes, with ``hits``."""
    table = places(texts.sparkSession, templates)
    ks = sorted({gram_length(t) for t in templates})
    names = [f"w{i}" for i in range(ks[-1])]
    # the row after the last word stands for the text itself
    ahead = [F.concat("__words", F.array(F.lit(None).cast("string"))).alias("w0"), *[F.slice("__words", i + 1, 1 << 30).alias(n) for i, n in enumerate(names) if i]]
    out = texts.select("doc_id", "tid", F.posexplode(F.arrays_zip(*ahead)).alias("p", "g"))
    out = out.select("doc_id", "tid", "p", *[F.col(f"g.{n}").alias(n) for n in names])
    for k in ks:
        side = table.where(F.col("k") == k).select(F.xxhash64(*[F.col("gram")[i] for i in range(k)]).alias(f"h{k}"), F.col("gram").alias(f"gram{k}"), F.col("hits").alias(f"hits{k}"))
        out = out.join(F.broadcast(side), F.col(f"h{k}") == F.xxhash64(*names[:k]), "left")
    # equal hashes are verified word by word
    verified = [F.when(F.col(f"gram{k}") == F.array(*names[:k]), F.col(f"hits{k}")) for k in ks]
    found = F.flatten(F.array_compact(F.array(*verified)))
    last = F.col("w0").isNull()
    any_hit = F.coalesce(*[F.col(f"hits{k}") for k in ks]).isNotNull()
    return out.where(last | any_hit).select("doc_id", "tid", F.col("p").cast("long").alias("p"), last.alias("text"), F.when(~last, found).alias("hits"))


def _spans(votes: DataFrame, templates: list[Template]) -> DataFrame:
    """(tid, template, start, share): the verified spans of each distinct text."""
    spark = votes.sparkSession
    size = spark.createDataFrame([(i, len(t.words), t.share, t.drift, t.label) for i, t in enumerate(templates)],
                                 "template int, words int, least double, drift int, label string")
    blocks = -(-max((len(t.words) for t in templates), default=1) // BITS)
    masks = [f"m{b}" for b in range(blocks)]
    hits = votes.where("NOT text").select("tid", "p", F.explode("hits").alias("h"))
    hits = hits.select("tid", "h.template", (F.col("p") - F.col("h.q")).alias("diagonal"), "p", *[F.col("h.masks")[b].alias(m) for b, m in enumerate(masks)])
    # equal texts vote alike: or-ing masks counts them once
    merged = [F.bit_or(m).alias(m) for m in masks]
    lines = hits.groupBy("tid", "template", "diagonal").agg(F.min("p").alias("start"), *merged).join(F.broadcast(size), "template")
    order = W.partitionBy("tid", "template").orderBy("diagonal")
    fresh = F.coalesce(F.col("diagonal") > F.lag("diagonal").over(order) + F.col("drift"), F.lit(True)).cast("int")
    lines = lines.withColumn("__fresh", fresh).withColumn("run", F.sum("__fresh").over(order))
    runs = lines.groupBy("tid", "template", "run", "words", "least", "label").agg(F.min("start").alias("start"), *merged)
    held = sum((F.bit_count(m) for m in masks), F.lit(0))
    return runs.withColumn("share", held.cast("double") / F.col("words")).where(F.col("share") >= F.col("least")).select("tid", "template", "label", "start", "share")


def license_scan(docs: DataFrame, base: list[Template] = PHRASES, more: list[Template] = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for every row of ``docs``.

    ``n_base`` counts the places where a phrase of ``base`` stands whole and in a row; ``first_word`` and ``last_word`` are the smallest and largest word at which one
    begins (null without any). ``base_labels`` are its labels, ``labels`` those of all verified spans, distinct, sorted and joined by commas ('' if none).
    ``score`` is the largest share of a template's words held by a verified span; 0 without one.

    Null and empty texts have no words. Equal texts get equal results, repeated rows and rows without an id come back as they are. Only the two named columns
    are read, so further columns, whatever their names, do no harm. An empty table gives none. Templates of equal words are told apart by their
    place in the lists; without any template there is nothing to scan for, which is an error. A text's words are an array in one row, as the text itself is; nothing else of a text comes together.
    """
    templates = [*base, *more]
    if not templates:
        raise ValueError("no templates")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))).alias("tid"), words_of(F.col(text_col)).alias("__words"))
    votes = written(_votes(texts, templates), "votes")
    is_base = F.col("template") < len(base)
    names = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = _spans(votes, templates).groupBy("tid").agg(
        F.count_if(is_base).alias("n_base"), F.min(F.when(is_base, F.col("start"))).alias("first_word"), F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        names(F.when(is_base, F.col("label"))).alias("base_labels"), names("label").alias("labels"), F.max("share").alias("score"))
    every = votes.where("text").select("doc_id", F.col("tid").alias("__tid"), F.col("p").alias("n_words"))
    return every.join(found, F.col("__tid") == F.col("tid"), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"), F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
