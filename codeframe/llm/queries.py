"""Registered queries of this package, as ``f(spark, folder_of_tables)``, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codeframe.llm import alignment, bpe, cross_entropy, hamming_index, lang_crf, license_scan, mixing, paragraphs, parity_join, quality, shared_search, tool_calls
from codeframe.llm.bit_sliced import top_products
from codeframe.llm.tables import table


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights 5, 2, 1 by source, 150 % of all words, no source more than twice."""
    return mixing.mix_sources(table(spark, sf_dir, "documents"), [5, 2, 1], 150, 2).select("doc_id", "size", "source_size", "target", "taken", "source")


#: Tools that the turns of ``conversations`` are read as calls of.
TOOLS = {
    "search": {"properties": {"query": {"type": "string", "maxLength": 400}, "limit": {"type": "integer", "minimum": 1, "maximum": 8}}, "required": ["query"]},
    "translate": {"properties": {"query": {"type": "string"}, "limit": {"type": "integer", "maximum": 6}}, "required": ["query", "limit"]},
}


def tool_turns(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of a chat: each user turn asks for a tool by an id of its own and depends on the user turn before; the turn that follows answers it."""
    name_of = lambda turn: F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string")))
    text = F.coalesce("text", F.lit(""))
    tool = F.when(F.length(text) % 3 == 0, "search").when(F.length(text) % 3 == 1, "translate").otherwise("lookup")
    arguments = F.concat(F.lit('{ "query": '), tool_calls.quoted(text), F.lit(', "limit": '), F.col("turn").cast("string"), F.lit(" }"))
    parent = F.when(F.col("turn") >= 2, name_of(F.col("turn") - 2))
    calls = chats.where("role = 'user'").select("conv_id", "turn", name_of(F.col("turn")).alias("call_id"), tool.alias("name"),
                                                arguments.alias("arguments"), parent.alias("parent"))
    results = chats.where("role = 'assistant'").select("conv_id", name_of(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def op2_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn as a call and every assistant turn as a result, linked, ordered, validated and serialised."""
    calls, results = tool_turns(table(spark, sf_dir, "conversations"))
    return tool_calls.link_every_call(calls, results, TOOLS)


def op3_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_index.nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0", 20)


def op4_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as good and not toxic; background: all."""
    good = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    return cross_entropy.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op5_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that occur again, equal or nearly so, and passages of 50 words and more that occur again anywhere."""
    docs = table(spark, sf_dir, "documents")
    lines = paragraphs.repeated_paragraphs(docs).withColumn("kind", F.lit("paragraph"))
    return lines.unionByName(paragraphs.repeated_passages(docs).withColumn("kind", F.lit("passage")))


def op6_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_crf.identify(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return parity_join.similar_groups(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op8_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"), "id % 50 = 0", 5)


def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks, public_tokenizers.PATTERN)


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License names and notices in every document."""
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op12_shared_term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return shared_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and sentence-piece tokens of every document, aligned."""
    first = alignment.byte_level(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return alignment.align(table(spark, sf_dir, "documents"), first, alignment.pieces(public_tokenizers.path("piece_bpe_32k.model")))


QUERIES = {f.__name__: f for f in (op1_source_mixing, op2_tool_call_linking, op3_multi_index_hashing, op4_cross_entropy_difference, op5_paragraph_dedup,
                                   op6_language_crf, op7_ngram_jaccard_join, op8_pairwise_quality, op9_bit_sliced_top_k, op10_byte_level_bpe, op11_license_scan,
                                   op12_shared_term_search, op13_token_alignment)}

ORACLES = {
    "op7_ngram_jaccard_join": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM d),
        x AS (SELECT doc_id, unnest(s) AS h FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM x a JOIN x b USING (h) WHERE a.doc_id < b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b WHERE 100 * n >= 75 * (len(sa.s) + len(sb.s) - n)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r AS (SELECT a AS doc_id, a AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.c, s.doc_id)) AS component_id
        FROM s LEFT JOIN (SELECT doc_id, min(other) AS c FROM r GROUP BY doc_id) m ON m.doc_id = s.doc_id""",
    "op1_source_mixing": r"""
        WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                     md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
        p AS (SELECT source, sum(size) AS z, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM d GROUP BY source),
        w AS (SELECT *, CASE s % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * z AS cap, sum(z) OVER () AS total FROM p),
        o AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                sum(w) OVER (ORDER BY cap / w, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
        f AS (SELECT *, cap * open * 100 <= (total * 150 - before * 100) * w AS f FROM o),
        g AS (SELECT source, CAST(z AS BIGINT) AS z, CASE WHEN f THEN CAST(cap AS DOUBLE) ELSE (CAST(total AS DOUBLE) * 1.5
                - CAST(coalesce(sum(CASE WHEN f THEN cap END) OVER (), 0) AS DOUBLE)) / CAST(sum(CASE WHEN NOT f THEN w END) OVER () AS DOUBLE) * w END AS target FROM f),
        q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM g),
        r AS (SELECT d.*, q.z, q.target, q.quota, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
        SELECT doc_id, source, CAST(size AS BIGINT) AS size, z AS source_size, target,
          CAST(greatest(0, least(pos + size, quota) - pos) + greatest(0, least(pos + z + size, quota) - pos - z) AS BIGINT) AS taken FROM r""",
    "op9_bit_sliced_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
                   WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        QUALIFY rank <= 5""",
    "op11_license_scan": r"""
        WITH t AS (SELECT * FROM (VALUES {templates}) v(template, label, k, words, least, drift)),
        g AS (SELECT template, k, q - 1 AS q, words[q:q + k - 1] AS gram FROM (SELECT template, k, words, unnest(range(1, len(words) - k + 2)) AS q FROM t)),
        d AS (SELECT row_number() OVER () AS r, doc_id,
                list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
                            lambda w: w <> '') AS w FROM documents),
        p AS (SELECT r, k, p - 1 AS p, w[p:p + k - 1] AS gram FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM t))),
        h AS (SELECT r, template, p - q AS diagonal, min(p) AS start, list(DISTINCT q) AS qs FROM p JOIN g USING (k, gram) GROUP BY ALL),
        o AS (SELECT h.*, CASE WHEN diagonal <= lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) + drift THEN 0 ELSE 1 END AS fresh FROM h JOIN t USING (template)),
        n AS (SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal) AS run FROM o),
        s AS (SELECT r, template, run, min(start) AS start, flatten(list(qs)) AS qs FROM n GROUP BY ALL),
        v AS (SELECT r, template, label, start, least, CAST(len(list_distinct(flatten(list_transform(qs, lambda q: range(q, q + k))))) AS DOUBLE) / len(words) AS share
              FROM s JOIN t USING (template)),
        f AS (SELECT r, count(*) FILTER (template < {base}) AS n_base, min(start) FILTER (template < {base}) AS first_word, max(start) FILTER (template < {base}) AS last_word,
                array_to_string(list_sort(list_distinct(list(label) FILTER (template < {base}))), ',') AS base_labels, array_to_string(list_sort(list_distinct(list(label))), ',') AS labels,
                max(share) AS score FROM v WHERE share >= least GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
          CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
        FROM d LEFT JOIN f USING (r)""".format(base=len(license_scan.PHRASES), templates=", ".join(
            f"({i}, '{t.label}', {license_scan.gram_length(t)}, {t.words}, CAST({t.share} AS DOUBLE), {t.drift})" for i, t in enumerate([*license_scan.PHRASES, *license_scan.NOTICES]))),
    "op12_shared_term_search": r"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        z AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d),
        i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark),
        x AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
        q AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM x, z GROUP BY t, docs),
        s AS (SELECT item_id, r, CAST(sum(q.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.w) * docs) // terms)))) AS BIGINT) AS score
              FROM i JOIN q USING (t) JOIN x USING (t) JOIN d USING (r), z GROUP BY item_id, r)
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s JOIN d USING (r)
        WHERE score > 0 QUALIFY rank <= 10""",
}
