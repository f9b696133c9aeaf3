"""Cross-entropy difference of documents under matched n-gram models of a target and a background.

Tokens are the bytes of a text and a mark for its end. Both models have the same order (4), the same smoothing (each order is mixed with
the next shorter one by a Dirichlet prior) and one vocabulary: the tokens that occur in the background, which contains the
target. A document's score is its mean loss under the target less that under the background; low scores look like the target.

All documents are counted. Counts are a table, spread by n-gram; nothing of the model is sent to all tasks. Documents are
dealt to chunks by a hash of the id; a chunk asks only for the losses of its own distinct n-grams, by a join, and
scores its texts with them. What is moved is the texts and, for each chunk, its distinct n-grams: both grow as the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codeframe.llm import text as T
from codeframe.llm.tables import pieces, written

ORDER = 4
PRIOR = 8.0
CHUNK_BYTES = 8 << 20
#: Bytes that no UTF-8 text holds: before the first token, and the end mark.
_BEFORE, _END = 0xFF, 0xFE


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each token of each text, as a number of 4 bytes, and the bounds of the texts' tokens (one more than bytes)."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    first = offsets[:-1] + np.arange(n) * ORDER  # each text gets 3 marks before it and one behind
    flat = np.full(len(data) + n * ORDER, _BEFORE, np.uint32)
    text = np.repeat(np.arange(n), size)
    flat[np.arange(len(data)) + text * ORDER + ORDER - 1] = data
    flat[first + ORDER - 1 + size] = _END
    code = (flat[:-3] << 24) | (flat[1:-2] << 16) | (flat[2:-1] << 8) | flat[3:] if len(flat) > 3 else np.zeros(0, np.uint32)
    row = np.repeat(np.arange(n), size + 1)
    bounds = np.concatenate([[0], np.cumsum(size + 1)])
    return code[first[row] + np.arange(bounds[-1]) - bounds[row]], bounds


def _counted(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums up (gram, target count, background count) pieces."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    gram, t, b = (np.concatenate([p[i] for p in parts]) for i in range(3))
    order = np.argsort(gram, kind="stable")
    gram, t, b = gram[order], t[order], b[order]
    heads = np.flatnonzero(np.diff(gram, prepend=-1))
    return gram[heads], np.add.reduceat(t, heads), np.add.reduceat(b, heads)


def _count_chunk(key: tuple, docs: pa.Table, targets: pa.Table) -> pa.Table:
    wanted = np.sort(targets["id"].to_numpy())
    ids = docs["id"].to_pylist()
    parts = []
    for a, b, data, offsets in T.blocks(docs["text"]):
        code, bounds = grams(data, offsets)
        one = np.fromiter((i is not None and (p := np.searchsorted(wanted, i)) < len(wanted) and wanted[p] == i for i in ids[a:b]), bool)
        of_target = np.repeat(one, np.diff(bounds))
        gram, back = np.unique(code.astype(np.int64) * 2 + of_target, return_counts=True)
        t = np.where(gram & 1, back, 0)
        parts.append(_counted([(gram >> 1, t, back)]))
    gram, t, b = _counted(parts)
    chunk = pa.array(np.full(len(gram), key[0].as_py()), pa.int32())
    return pa.Table.from_arrays([chunk, pa.array(gram), pa.array(t), pa.array(b)], names=["chunk", "gram", "t", "b"])


def losses(counted: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(gram, lt, lb): the loss (negative natural logarithm) of the last token of each n-gram after the others, in both models.

    ``counted`` has (gram, t, b): how often the n-gram ends at a token of the target and of the background. Counts of shorter grams
    and of contexts are sums over it. Every distinct n-gram of the background has a row, so no document meets an unknown one.
    """
    out = counted
    total = counted.agg(F.sum("t"), F.sum("b"), F.countDistinct(F.col("gram") % 256)).first()
    n, size = {"t": total[0] or 0, "b": total[1] or 0}, total[2] or 1
    p = {}
    for k in range(1, ORDER + 1):
        key = F.col("gram") % (1 << 8 * k)
        short = out if k == ORDER else counted.groupBy(key.alias(f"k{k}")).agg(*(F.sum(c).alias(f"{c}{k}") for c in "tb"))
        if k == ORDER:
            out = out.withColumn(f"k{k}", F.col("gram")).withColumn(f"t{k}", F.col("t")).withColumn(f"b{k}", F.col("b"))
        else:
            out = out.withColumn(f"k{k}", key).join(short, f"k{k}")
        if k > 1:
            context = counted.groupBy(F.shiftright(key, 8).alias(f"c{k}")).agg(*(F.sum(c).alias(f"n{c}{k}") for c in "tb"))
            out = out.withColumn(f"c{k}", F.shiftright(key, 8)).join(context, f"c{k}")
    for c in "tb":
        p[c] = (F.col(f"{c}1") + 1.0) / (n[c] + size)
        for k in range(2, ORDER + 1):
            p[c] = (F.col(f"{c}{k}") + prior * p[c]) / (F.col(f"n{c}{k}") + prior)
    return out.select("gram", (-F.log(p["t"])).alias("lt"), (-F.log(p["b"])).alias("lb"))


def _score_chunk(docs: pa.Table, model: pa.Table) -> pa.Table:
    gram, lt, lb = (model[c].to_numpy() for c in ("gram", "lt", "lb"))
    order = np.argsort(gram)
    gram, both = gram[order].astype(np.uint32), np.stack([lt, lb], 1)[order]
    out = []
    for _, _, data, offsets in T.blocks(docs["text"]):
        code, bounds = grams(data, offsets)
        kinds, back = np.unique(code, return_inverse=True)
        loss = both[np.searchsorted(gram, kinds)][back]
        out.append(np.column_stack([np.diff(bounds), np.add.reduceat(loss, bounds[:-1])]))
    x = np.concatenate(out) if out else np.zeros((0, 3))
    mean = x[:, 1:] / x[:, :1]
    return pa.Table.from_arrays([docs["id"], pa.array(x[:, 0].astype(np.int64)), pa.array(mean[:, 0]), pa.array(mean[:, 1])],
                                names=["doc_id", "n_tokens", "target_loss", "background_loss"])


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, chunk_bytes: int = CHUNK_BYTES, prior: float = PRIOR) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for every document: mean losses a token, and their difference.

    The target is the documents whose id is in ``targets`` (doc_id; repeated and null ids do no harm), the background all
    documents. Whole texts are counted and scored. Null and empty texts have one token, the end. Rows without an id are background and are
    scored; repeated rows count as often as they stand and have equal scores. Only doc_id and text of ``docs`` are read. Without any target
    the target model knows the vocabulary's size alone. An empty table gives none.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chunks = pieces(spark, texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0, chunk_bytes)
    # rows without an id would all meet in one chunk: they are dealt by their text
    place = F.pmod(F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id")), F.lit(chunks))
    dealt = texts.withColumn("chunk", place.cast("int"))
    kind = texts.schema["id"].dataType.simpleString()
    wanted = targets.where("doc_id IS NOT NULL").select(F.col("doc_id").cast(kind).alias("id")).distinct()
    wanted = wanted.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
    counted = written(dealt.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(_count_chunk, "chunk int, gram long, t long, b long"), "grams")
    sums = written(counted.groupBy("gram").agg(F.sum("t").alias("t"), F.sum("b").alias("b")), "counts")
    model = losses(sums, prior)
    asked = counted.select("chunk", "gram").join(model, "gram")
    scored = dealt.groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(
        _score_chunk, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double")
    return scored.withColumn("score", F.col("target_loss") - F.col("background_loss"))
