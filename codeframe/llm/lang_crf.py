"""Language identification by a linear-chain conditional random field.

A text is a chain of words (words of more than 16 bytes, and texts in scripts without blanks, are cut into several elements); a word's label is a language. Its score is a sum of weights of its features (affixes, byte n-grams and,
for words of a learned lexicon, the word itself) plus a learned transition weight between neighbours' labels. Forward-backward gives each word's
label probabilities, also where a text switches language; the document's language is the one with the most probability in all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from codeframe.llm import text as T
from codeframe.llm.quality import fold

#: Bounds of the fit: documents (an equal share for each language, the first in the order of a hash of the id), words, buckets of hashed features, length of training chains.
SAMPLE = 1200
SAMPLE_WORDS = 200_000
BUCKETS = 1 << 16
CHAIN = 48
#: A longer text gives the fit this many stretches, evenly spaced from its start to its end.
STRETCHES = 8
_MOST_BYTES = 16
_CUT_BYTES = 12
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def elements(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the elements of each text's chain, and where each text's begin (one more entry than texts).

    An element is a word; one of more than 16 bytes is cut, between characters, into elements of 6 to 15, so that no byte stays unseen.
    """
    starts, ends, first = T.words(data, offsets)
    size = ends - starts
    many = np.where(size > _MOST_BYTES, -(-size // _CUT_BYTES), 1)
    if not (many > 1).any():
        return starts, ends, first
    upto = np.concatenate([[0], np.cumsum(many)])
    word = np.repeat(np.arange(len(starts)), many)
    nth = np.arange(upto[-1]) - upto[word]
    at = starts[word] + nth * size[word] // many[word]
    for _ in range(3):  # back to the first byte of a character
        at = at - ((data[at] & 0xC0) == 0x80) * (nth > 0)
    return at, np.where(nth + 1 < many[word], np.append(at[1:], 0), ends[word]), upto[first]


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each feature, is it there) for each element: prefixes and suffixes of 2 to 4 bytes, all runs of 2 and 3 bytes (elements have 16 at most),
    and the whole element (the lexicon). Letters A-Z count as a-z in all but the whole word's hash, which the caller lowers.
    """
    n = len(starts)
    length = ends - starts
    head = np.minimum(length, 12)
    at = np.arange(12)
    chars = np.zeros((n, _MOST_BYTES + 2), np.uint64)
    chars[:, 0] = 1  # before the word
    inside = at < head[:, None]
    chars[:, 1:13] = np.where(inside, data[np.minimum(starts[:, None] + at, len(data) - 1)].astype(np.uint64) + np.uint64(2), np.uint64(0))
    tail = np.minimum(length - head, 4)
    back = np.arange(4)
    chars[:, 13:17] = np.where(back < tail[:, None], data[np.maximum(ends[:, None] - tail[:, None] + back, 0) % max(len(data), 1)].astype(np.uint64) + np.uint64(2), np.uint64(0))
    two = chars[:, :-1] * np.uint64(512) + chars[:, 1:]
    three = two[:, :-1] * np.uint64(512) + chars[:, 2:]
    last = [data[np.maximum(ends - 1 - j, starts)].astype(np.uint64) for j in range(4)]
    first = [data[np.minimum(starts + j, ends - 1)].astype(np.uint64) for j in range(4)]
    affix, there = [], []
    for size in (2, 3, 4):
        for k, part in enumerate((first, last)):
            key = np.full(n, 7 + size * 2 + k, np.uint64)
            for j in range(size):
                key = key * np.uint64(257) + part[j]
            affix.append(T.mix(key))
            there.append(length >= size)
    grams = np.concatenate([T.mix(two[:, 1:12] + np.uint64(1 << 40)), T.mix(three[:, :14] + np.uint64(1 << 50))], 1)
    has = np.concatenate([(chars[:, 1:12] > 0) & (chars[:, 2:13] > 0), (chars[:, 1:15] > 0) & (chars[:, 2:16] > 0)], 1)
    keys = np.concatenate([np.stack(affix, 1), grams, T.mix(hashes ^ np.uint64(0xA5A5))[:, None]], 1)
    return (keys % np.uint64(BUCKETS)).astype(np.int32), np.concatenate([np.stack(there, 1), has, np.ones((n, 1), bool)], 1)


def forward_backward(emit: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Each word's label probabilities. ``emit`` has a row of scores a word, ``first`` the bounds of the chains, ``trans`` the transition scores.

    Chains run side by side, the longest first, so that a step is one operation on all chains still going.
    """
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    if not len(order):
        return emit.copy()
    start, size = first[:-1][order], n[order]
    e = np.exp(emit - emit.max(1, keepdims=True))
    t = np.exp(trans - trans.max())
    ahead, behind = np.empty_like(e), np.empty_like(e)
    going = np.searchsorted(-size, -np.arange(size[0]), "left")  # chains longer than step i
    a = e[start]
    a /= a.sum(1, keepdims=True)
    ahead[start] = a
    for i in range(1, size[0]):
        k = going[i]
        a = (a[:k] @ t) * e[start[:k] + i]
        a /= a.sum(1, keepdims=True)
        ahead[start[:k] + i] = a
    b = np.ones((0, e.shape[1]))
    for i in range(size[0] - 1, -1, -1):
        k = going[i]
        fresh = np.ones((k, e.shape[1]))
        m = len(b)
        if m:
            x = (b * e[start[:m] + i + 1]) @ t.T
            fresh[:m] = x / x.sum(1, keepdims=True)
        behind[start[:k] + i] = fresh
        b = fresh
    p = ahead * behind
    return p / p.sum(1, keepdims=True)


@dataclass(frozen=True)
class Chain:
    """A fitted field: labels in order, feature weights (bucket by label) and transition weights."""

    labels: list[str]
    weights: np.ndarray
    trans: np.ndarray

    def posteriors(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(label probabilities of all words, bounds of each text's words)."""
        data = T.LOWER[data]
        starts, ends, first = elements(data, offsets)
        if not len(starts):
            return np.zeros((0, len(self.labels))), first
        hashes = T.word_hashes(data, starts)
        _, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        scores = np.zeros((len(one), len(self.labels)))
        for x in range(0, len(one), 1 << 15):
            some = one[x: x + (1 << 15)]
            bucket, there = word_features(data, starts[some], ends[some], hashes[some])
            bucket[~there] = BUCKETS  # an empty row of weights
            scores[x: x + len(some)] = _emissions(self.weights, bucket)
        return forward_backward(scores[back], first, self.trans), first


def _emissions(weights: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Sums of the feature weights of each word, some rows at a time."""
    out = np.zeros((len(bucket), weights.shape[1]))
    for x in range(0, len(bucket), 1 << 14):
        out[x: x + (1 << 14)] = weights[bucket[x: x + (1 << 14)]].sum(1)
    return out


def fit(texts: list[str], langs: list[str], steps: int = 30, rate: float = 0.3, penalty: float = 1e-4) -> Chain | None:
    """Adaptive gradient steps on the conditional log-likelihood of chains of ``CHAIN`` words; None without texts.

    A word's label is its document's. Stretches of 4 to 24 words of different documents are strung together, so that the
    transition weights learn how labels follow each other in text that switches.
    """
    labels = sorted(set(langs), key=lambda s: s.encode())
    draw = np.random.default_rng(3)
    buckets, hashes, truth = [], [], []
    for a, b, data, offsets in T.blocks(pa.array(texts, pa.large_string())):
        data = T.LOWER[data]
        starts, ends, first = elements(data, offsets)
        if not len(starts):
            continue
        h = T.word_hashes(data, starts)
        kinds, one = np.unique(h, return_index=True)
        bucket, there = word_features(data, starts[one], ends[one], kinds)
        bucket[~there] = BUCKETS
        buckets.append(bucket)
        hashes.append((kinds, h))
        truth.append(np.repeat([labels.index(x) for x in langs[a:b]], np.diff(first)))
    if not truth:
        return None
    kinds, one = np.unique(np.concatenate([k for k, _ in hashes]), return_index=True)
    bucket, truth = np.concatenate(buckets)[one], np.concatenate(truth)
    back = np.searchsorted(kinds, np.concatenate([h for _, h in hashes]))
    cuts = np.unique(np.append(np.concatenate([[0], np.cumsum(draw.integers(4, 25, len(truth)))]).clip(max=len(truth)), len(truth)))
    stretch = draw.permutation(len(cuts) - 1)[: max(1, SAMPLE_WORDS // 14)]
    words = np.concatenate([np.arange(cuts[s], cuts[s + 1]) for s in stretch])
    back, truth = back[words], truth[words]
    first = np.append(np.arange(0, len(words), CHAIN), len(words))
    inner = np.ones(len(words), bool)
    inner[first[:-1]] = False
    second = np.flatnonzero(inner)
    k = len(labels)
    w, trans = np.zeros((BUCKETS + 1, k)), np.zeros((k, k))
    gw, gt = np.full_like(w, 1e-6), np.full_like(trans, 1e-6)
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[second - 1], truth[second]), 1)
    sure = np.eye(k)[truth]
    flat = bucket.ravel()
    for _ in range(steps):
        p = forward_backward(_emissions(w, bucket)[back], first, trans)
        wrong = sure - p
        up = np.empty_like(w)
        for j in range(k):
            by_word = np.bincount(back, weights=wrong[:, j], minlength=len(bucket))
            up[:, j] = np.bincount(flat, weights=np.repeat(by_word, bucket.shape[1]), minlength=BUCKETS + 1)
        up = up / len(words) - penalty * w
        up[BUCKETS] = 0
        # expected transitions, from neighbours' probabilities and the current weights
        pair = p[second - 1][:, :, None] * p[second][:, None, :] * np.exp(trans - trans.max())
        pair /= pair.sum((1, 2), keepdims=True)
        turn = (seen - pair.sum(0)) / len(words) - penalty * trans
        gw += up ** 2
        gt += turn ** 2
        w += rate * up / np.sqrt(gw)
        trans += rate * turn / np.sqrt(gt)
    return Chain(labels, w, trans)


def learn(docs: DataFrame, sample: int = SAMPLE) -> Chain | None:
    """Fits the field to about ``sample`` documents with a language whose fold is not held out: each language gives an equal share of them, one at
    least, the first in the order of a hash of the id, however rare it is.

    The bound is a parameter of the fit; ids are chosen first, so that only their texts are read and brought to the driver. A text of more than
    ``8 * SAMPLE_WORDS / sample`` characters gives ``STRETCHES`` pieces of as many in all, spread evenly over the whole of it; words cut at their edges are left out.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).where(fold(F.col("doc_id"), 5) != 0)
    known = known.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = known.select("doc_id", "lang").distinct()
    share = max(1, sample // max(1, known.select("lang").distinct().count()))
    nth = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = ids.withColumn("nth", nth).where(F.col("nth") <= share).select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"))
    rows = known.join(F.broadcast(chosen), (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang")))
    most = 8 * SAMPLE_WORDS // max(sample, 1)
    size = max(most // STRETCHES, 1)
    start = lambda i: F.floor(i * (F.char_length("text") - size) / (STRETCHES - 1)) + 1
    piece = lambda i: F.regexp_replace(F.substring(F.col("text"), start(i).cast("int"), F.lit(size)), r"^[^\x20\x09-\x0D]*[\x20\x09-\x0D]|[\x20\x09-\x0D][^\x20\x09-\x0D]*$", "")
    spread = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(STRETCHES - 1)), piece), " ")
    # training stretches may be cut anywhere; what is predicted never is
    rows = rows.select("doc_id", "lang", F.when(F.char_length("text") > most, spread).otherwise(F.col("text")).alias("text")).orderBy("doc_id", "lang", "text").collect()
    return fit([r.text for r in rows], [r.lang for r in rows]) if rows else None


def languages(docs: DataFrame, model: Chain | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every whole text: the language with the most probability over its words, and its mean probability.

    A text without a letter, or null, is ``und`` with score 0, and so is every text if nothing could be learned. Of languages equally probable
    the first by code point is taken. Other columns are not read. No shuffle; repeated rows come back repeated.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*(model.labels if model else []), UNKNOWN], object)
        for batch in batches:
            for a, b, data, offsets in T.blocks(batch.column(1)):
                pred, score = np.full(b - a, len(names) - 1), np.zeros(b - a)
                if model:
                    p, first = model.posteriors(data, offsets)
                    many = np.diff(first)
                    total = np.stack([np.concatenate([[0], np.cumsum(p[:, j])]) for j in range(p.shape[1])], 1)
                    total = total[first[1:]] - total[first[:-1]]
                    ascii_ = np.concatenate([[0], np.cumsum((T.LOWER[data] >= 97) & (T.LOWER[data] <= 122))])
                    letter = ascii_[offsets[1:]] > ascii_[offsets[:-1]]
                    for i in np.flatnonzero(~letter & (many > 0)).tolist():
                        letter[i] = bool(_LETTER.search(data[offsets[i]: offsets[i + 1]].tobytes().decode("utf-8", "replace")))
                    pred[letter] = total[letter].argmax(1)
                    score[letter] = (total[letter].max(1) / many[letter]).clip(0, 1)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(names[pred].tolist(), pa.string()), pa.array(score)],
                                                 names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(rows, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): the field learned from labelled documents that are not held out, applied to all."""
    out = languages(docs, learn(docs))
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")
