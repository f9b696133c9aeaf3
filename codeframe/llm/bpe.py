"""Byte-level BPE encoding and decoding with a public vocabulary of ranked byte strings.

A text is cut by the vocabulary's pattern; in each piece the adjacent pair whose joined bytes have the lowest rank is
merged, again and again. Merges are folded over the byte arrays of distinct pieces; decoding concatenates the ids' byte strings.

Two forms of the same fold:
* ``encode_words``: Spark higher-order functions over a table of distinct words, with the ranks as a literal. Good for vocabularies
  of words; bringing its result back to every place of every text takes a join over all words (see the README for figures).
* ``encoded``: whole texts in one pass without a shuffle. Each task folds the distinct pieces of a block of rows at once, in numpy, and
  keeps what it has seen in a dictionary of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of a task's dictionary; beyond, it starts anew. It bounds memory and changes no result.
REMEMBERED = 600_000
#: Rows of a batch that are encoded together.
BLOCK_ROWS = 512


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """The rank file (a line holds base64 of the bytes, and the rank), wherever Spark or the driver can read it."""
    import os

    if os.path.exists(path):
        with open(path, "rb") as lines:
            rows = [line.split() for line in lines if line.strip()]
    else:
        rows = [r.value.split() for r in spark.read.text(path).collect() if r.value.strip()]
    return {base64.b64decode(a): int(b) for a, b in rows}


class Vocabulary:
    """Ranked byte strings as arrays: which two ids join to which, and each id's bytes.

    All ids from 0 to the largest must be given, the 256 single bytes among them (byte_bpe files are so). Merging every place of the lowest
    rank at once equals merging them one by one if each string of the vocabulary, encoded alone, gives itself; ``check`` tests
    that.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        ordered = [b""] * self.size
        for text, rank in ranks.items():
            ordered[rank] = text
        left, right, made = [], [], []
        for text, rank in ranks.items():
            for i in range(1, len(text)):
                a, b = ranks.get(text[:i]), ranks.get(text[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        key = np.array(left, np.int64) * self.size + np.array(right, np.int64)
        order = np.argsort(key)
        self.pairs, self.made = key[order], np.array(made, np.int64)[order]
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.ends = np.cumsum([len(x) for x in ordered])
        self.starts = self.ends - np.array([len(x) for x in ordered])

    def check(self) -> bool:
        """Does every string of the vocabulary encode to itself?"""
        words = [self.bytes[a:b].tobytes() for a, b in zip(self.starts.tolist(), self.ends.tolist()) if a < b]
        ids, bounds = self.fold(words)
        return len(ids) == len(words) and [self.bytes[self.starts[i]: self.ends[i]].tobytes() for i in ids.tolist()] == words

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all byte strings, none of them empty, and where each one's begin (and, last, the end)."""
        sizes = np.array([len(w) for w in words], np.int64)
        made = np.zeros(len(words), np.int64)
        ids = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        place = np.concatenate([[0], np.cumsum(sizes)])[:-1]  # a word's ids stay at the front of its own bytes' places
        done = np.zeros(len(ids), np.int64)
        of = np.arange(len(words))
        while len(of):
            word = np.repeat(np.arange(len(of)), sizes)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            rank = np.full(len(ids), self.size, np.int64)  # of the pair that begins here
            inner = np.flatnonzero(word[:-1] == word[1:])
            key = ids[inner] * self.size + ids[inner + 1]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank[inner] = np.where(self.pairs[at] == key, self.made[at], self.size)
            lowest = np.minimum.reduceat(rank, bounds[:-1])
            going = lowest < self.size
            ended = ~going[word]
            to = place[of[word[ended]]] + (np.arange(len(ids)) - bounds[word])[ended]
            done[to] = ids[ended]
            made[of[~going]] = sizes[~going]
            merge = (rank == lowest[word]) & ~ended
            # of places in a row (as in "aaaa") every second one, from the left
            head = merge.copy()
            head[1:] &= ~(merge[:-1] & (word[1:] == word[:-1]))
            run, places = np.flatnonzero(head), np.flatnonzero(merge)
            if len(places):
                places = places[(places - run[np.searchsorted(run, places, "right") - 1]) % 2 == 0]
            ids[places] = rank[places]
            keep = ~ended
            keep[places + 1] = False
            ids = ids[keep]
            sizes = (sizes - np.bincount(word[places], minlength=len(of)))[going]
            of = of[going]
        bounds = np.concatenate([[0], np.cumsum(made)])
        return done[np.repeat(place, made) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], made)], bounds

    def decode(self, ids: np.ndarray) -> bytes:
        """The ids' byte strings, one after the other."""
        a, n = self.starts[ids], self.ends[ids] - self.starts[ids]
        if not len(ids):
            return b""
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.bytes[at].tobytes()


class Encoder:
    """Encodes texts with a dictionary of the pieces seen so far."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.known: dict[str, str] = {}

    def encode(self, texts: list[str]) -> list[str]:
        """The decimal ids of each text, joined by commas."""
        cut = [self.pattern.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = list(set().union(*cut).difference(self.known))
        ids, bounds = self.vocabulary.fold([p.encode() for p in new])
        text = list(map(str, ids.tolist()))
        self.known.update(zip(new, (",".join(text[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()))))
        known = self.known
        return [",".join([known[p] for p in pieces]) for pieces in cut]


_encoders: dict[str, Encoder] = {}


def _encoder(ranks: dict[bytes, int], pattern: str, name: str) -> Encoder:
    """This Python worker's encoder; a worker runs many tasks of a stage."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(Vocabulary(ranks), pattern)
    return _encoders[name]


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, with_ids: bool = False) -> DataFrame:
    """(columns of ``docs`` but text, n_tokens, ids_sha256, decoded_sha256): every whole text encoded, and its ids decoded again.

    ``with_ids`` adds ``ids``, an array of the token ids. A null text is encoded as an empty one: no ids, digests of nothing. Other columns pass through
    (those named as a result column are replaced); repeated rows come back repeated; an empty table gives none. What is sent to the tasks is the
    rank table, whose size does not depend on the data.
    """
    name = hashlib.sha256(pattern.encode() + b"".join(b"%d %b " % (r, t) for t, r in ranks.items())).hexdigest()
    new = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids
    kept = [c for c in docs.columns if c != "text" and c not in new]
    rows_in = docs.select(*[F.col(f"`{c}`") for c in kept], F.col("text").cast("string").alias("text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows_in.schema if f.name != "text"),
                        "n_tokens long, ids_sha256 string, decoded_sha256 string", *["ids array<int>"] * with_ids])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks, pattern, name)
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
                joined = encoder.encode(texts)
                ids = [np.fromstring(j, np.int32, sep=",") for j in joined]
                sha = [[hashlib.sha256(x).hexdigest() for x in xs] for xs in ((j.encode() for j in joined), (encoder.vocabulary.decode(i) for i in ids))]
                columns = [*batch.columns[:-1], pa.array([len(i) for i in ids], pa.int64()), pa.array(sha[0], pa.string()), pa.array(sha[1], pa.string())]
                if with_ids:
                    bounds = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids))))
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *new])

    return rows_in.mapInArrow(rows, schema)


def rank_lookup(ranks: dict[bytes, int], buckets: int = 4096) -> Column:
    """The ranks as a literal: an array of small maps, so that a look-up reads one short map instead of the whole vocabulary.

    Keys are byte strings written as text of one character (U+0000 to U+00FF) a byte. Use it as ``find(lookup, key)``.
    """
    import json
    import zlib

    maps: list[dict[str, int]] = [{} for _ in range(buckets)]
    for text, rank in ranks.items():
        maps[zlib.crc32(text) % buckets][text.decode("latin-1")] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def find(lookup: Column, key: Column, buckets: int = 4096) -> Column:
    """The rank of a byte string, or null."""
    return F.try_element_at(F.get(lookup, (F.crc32(F.encode(key, "ISO-8859-1")) % buckets).cast("int")), key)


def encode_words(words: DataFrame, ranks: dict[bytes, int], column: str = "word") -> DataFrame:
    """``words`` with ``ids``: the token ids of each word (one piece of the pattern), folded by higher-order functions.

    The state is the array of byte strings still apart, at first single bytes. Each step of the fold looks up the rank of every
    adjacent pair and joins the first pair of the lowest rank; a word of n bytes takes n - 1 steps at most. Meant for distinct words
    of ordinary length: time grows with the cube of a word's length. Null gives null, an empty word no ids.
    """
    lookup = rank_lookup(ranks)
    raw = F.decode(F.encode(F.col(column), "UTF-8"), "ISO-8859-1")
    parts = F.filter(F.split(raw, ""), lambda c: F.length(c) > 0)

    def step(parts: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.struct(
            F.coalesce(find(lookup, F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))), F.lit(1 << 30)).alias("rank"), i.alias("i")))
        best = F.when(F.size(parts) > 1, F.array_min(pairs))
        i = best["i"]
        joined = F.concat(F.slice(parts, F.lit(1), i - 1), F.array(F.concat(F.element_at(parts, i), F.element_at(parts, i + 1))),
                          F.slice(parts, i + 2, F.size(parts)))
        return F.when((F.size(parts) > 1) & (best["rank"] < (1 << 30)), joined).otherwise(parts)

    steps = F.when(F.length(raw) > 1, F.sequence(F.lit(2), F.length(raw))).otherwise(F.array().cast("array<int>"))
    return words.withColumn("ids", F.transform(F.aggregate(steps, parts, step), lambda p: find(lookup, p)))
