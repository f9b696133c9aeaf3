import os
import re
import time

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from codeframe.llm import paragraphs as P
from codeframe.llm.tables import dropped, written
from codeframe.sources.scratch import scratch_root


def tables(spark):
    """The tables in the scratch folder."""
    root = scratch_root(spark).removeprefix("file://")
    return set(os.listdir(root)) if os.path.isdir(root) else set()


def tags(names):
    return sorted(re.sub("-[0-9a-f]{12}$", "", n) for n in names)


def shuffle_files(spark):
    found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    was = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    out = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(40):  # executors remove them on their own time
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == was
    assert sorted(r["count"] for r in out.collect()) == [142, 143, 143, 143, 143, 143, 143]
    assert os.path.basename(out.scratch) in tables(spark)
    dropped(out)
    assert os.path.basename(out.scratch) not in tables(spark)


def test_repeats_leave_only_their_results(spark, docs):
    line = lambda k, n: " ".join(f"{k}_{i}" for i in range(n))
    rows = [(1, f"{line('a', 30)}\n{line('s', 60)} {line('b', 9)}"), (2, f"{line('c', 7)} {line('s', 60)} {line('d', 40)}"), (3, line("a", 30)), (4, f"{line('a', 29)} z"), (5, None)]
    table = docs(rows)
    before = tables(spark)
    lines, passages = P.repeated_paragraphs(table), P.repeated_passages(table)
    assert tags(tables(spark) - before) == ["passages", "repeated"]
    for _ in range(2):  # and they can be read again
        assert sorted((r.doc_id, r.line, r.removed) for r in lines.collect()) == [(1, 0, False), (3, 0, True), (4, 0, True)]
        assert [(r.doc_id, r.words, r.first_doc_id, r.first_line) for r in passages.collect()] == [(2, 60, 1, 1)]


def test_pipeline_stages_leave_no_large_tables(spark, docs):
    from codeframe.llm.parity_join import one_of_each

    line = lambda k, n: " ".join(f"{k}_{i}" for i in range(n))
    rows = [(i, f"{line('a', 80)} {line(i, 3)}") for i in range(20)] + [(30, f"{line('c', 7)} {line('s', 60)}"), (31, f"{line('d', 70)} {line('s', 60)}"), (32, None)]
    before = tables(spark)
    one = one_of_each(docs(rows))
    assert not {"words", "whole", "pairs", "hot", "more", "stars"} & set(tags(tables(spark) - before))
    assert sorted(r.doc_id for r in one.collect()) == [0, 30, 31, 32]
    before = tables(spark)
    cut = P.without_repeats(one)
    assert tags(tables(spark) - before) == ["lines-cut", "passages", "repeated"]
    assert {r.doc_id: r.text for r in cut.collect()} == {0: rows[0][1], 30: rows[20][1], 31: f"{line('d', 70)} ", 32: None}


def test_written_tables_are_packed_with_zstd(spark):
    out = written(spark.range(10), "ids")
    parts = [f"{out.scratch.removeprefix('file://')}/{x}" for x in os.listdir(out.scratch.removeprefix("file://")) if x.endswith(".parquet")]
    packed = {pq.ParquetFile(x).metadata.row_group(0).column(0).compression for x in parts if pq.ParquetFile(x).metadata.num_row_groups}
    assert packed == {"ZSTD"}
    dropped(out)
