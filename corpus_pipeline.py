"""A corpus pipeline over ``documents``: five operators of ``codeframe.llm`` in a row, each on all that its predecessor kept.

Each stage takes (spark, documents, folder of tables) and gives a table that is written as Parquet and read as the next one's
documents. All but the last give the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeframe.llm import bpe, mixing, paragraphs, parity_join, quality
from codeframe.llm.tables import table, written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WEIGHTS = [5, 2, 1]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that score below the threshold go. It is learned from the labels that are not held out."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    plain = docs.withColumn("text", F.col("text").cast("string"))
    return quality.scored(plain, model).where(F.col("score") >= quality.THRESHOLD).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of linked documents exactly one row stays, that of the smallest id. Documents without words all stay."""
    return parity_join.one_of_each(docs)


def without_repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Substring dedup: long paragraphs, and runs of 50 words wherever they lie, that stood before are cut out; documents of which nothing is left go."""
    return paragraphs.without_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: documents as often as the mix takes them, a source's last one cut to the words taken."""
    return mixing.mixed_documents(docs, WEIGHTS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: token ids of every text, with digests of the ids and of the decoded bytes."""
    ranks = bpe.read_ranks(spark, public_tokenizers.path(VOCABULARY))
    return bpe.encoded(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", without_repeated_paragraphs),
    ("mixing sources", mixed_sources),
    ("byte-level BPE", token_ids),
]

#: SQL cannot express the learned classifier; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
