"""Row numbers, chunks, chunk functions and resumable pulls over large files.

Most chunked work is an aggregate and needs none of this: Spark aggregates partially per
task anyway. What is here serves functions that must see a fixed run of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codebook import Codebook
from ..functions.charset import canonical
from ..metadata import ALL_ATTRS, VarMeta, all_meta, q, with_meta
from ..operators.bind import bind_rows
from ..operators.joins import plan_bytes
from ..operators.labels import set_attributes
from ..select import Selection
from ..sources.scratch import scratch_path
from .lines import LineIndex, LineReader, files_of

CHUNK_SIZE = 10_000
MAX_BROADCAST_SPLITS = 500_000  # about 100 bytes each


# ---------------------------------------------------------------- row numbers

def with_row_no(df: DataFrame, name: str = "row_no", blocks: bool = False) -> DataFrame:
    """Number the rows of a file scan 1, 2, ... in file and line order, without a sort.

    Each block of a file (path, start offset) is one run of consecutive ids. A table of block
    sizes, one row per input split, gives every block its offset; it is broadcast if the
    number of splits is known to be small enough. If the two scans were split differently
    (another cluster size between them), the query stops instead of numbering wrongly;
    ``spark.sql.files.minPartitionNum`` pins the splits.

    ``blocks`` also keeps the row range of the block (``__lo``, ``__hi``), which lets
    :func:`chunk_map` run most chunks where they lie. Without it the table gains the number only.

    ``df`` must be a scan, with columns chosen or rows filtered at most: after a shuffle, a sort or a join
    rows have no place in a file any more, and the call is refused.
    """
    meta = all_meta(df)
    if not _is_plain_scan(df):
        raise ValueError("rows are numbered on a file scan; write the table to files first")
    tagged = df.select(
        *[q(c) for c in df.columns], F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"), F.col("_metadata.file_block_length").alias("__len"),
        F.monotonically_increasing_id().alias("__id"))
    sizes = (
        df.select(F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
                  F.col("_metadata.file_block_length").alias("__len"), F.monotonically_increasing_id().alias("__id"))
        .groupBy("__file", "__start", "__len").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    )
    # Sums before each block: over the blocks of its file, and over files, of which each gives one row.
    inside = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("__in").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.groupBy(F.col("__file").alias("__in")).agg(F.sum("__n").alias("__rows")).select("__in", F.coalesce(F.sum("__rows").over(over), F.lit(0)).alias("__earlier"))
    offsets = sizes.withColumn("__here", F.coalesce(F.sum("__n").over(inside), F.lit(0))).join(files, F.col("__file") == F.col("__in")).select(
        F.col("__file").alias("__bfile"), F.col("__start").alias("__bstart"), F.col("__len").alias("__blen"),
        "__first", "__n", (F.col("__here") + F.col("__earlier")).alias("__offset"))
    small = _split_bound(df) <= MAX_BROADCAST_SPLITS
    joined = tagged.join(
        F.broadcast(offsets) if small else offsets,
        (F.col("__file") == F.col("__bfile")) & (F.col("__start") == F.col("__bstart")) & (F.col("__len") == F.col("__blen")),
        "left")
    number = F.col("__offset") + (F.col("__id") - F.col("__first")) + 1
    inside = F.col("__first").isNotNull() & (F.col("__id") - F.col("__first") < F.col("__n"))
    checked = F.when(inside, number).otherwise(
        F.raise_error(F.lit("the file was split differently in two scans; set spark.sql.files.minPartitionNum")).cast("bigint"))
    cols = [*[q(c) for c in df.columns], checked.alias(name)]
    if blocks:  # without the broadcast, rows do not stay in their block
        where = F.lit(small)
        cols += [F.when(where, F.col("__offset") + 1).alias("__lo"),
                 F.when(where, F.col("__offset") + F.col("__n")).alias("__hi")]
    return with_meta(joined.select(*cols), meta)


def _is_plain_scan(df: DataFrame) -> bool:
    """Is the plan one file scan under projections and filters only?"""
    if not df.inputFiles():
        return False
    plan = df._jdf.queryExecution().analyzed()
    while plan.children().size() == 1:
        if plan.nodeName() not in ("Project", "Filter", "SubqueryAlias", "View"):
            return False
        plan = plan.children().head()
    return plan.children().isEmpty()


def _split_bound(df: DataFrame) -> int:
    """Upper bound of the number of input splits: one per file and one per full split."""
    split = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return len(df.inputFiles()) + (plan_bytes(df) or 0) // max(int(split), 1) * 2 + 1024


def with_chunk_id(df: DataFrame, chunk_size: int = CHUNK_SIZE, row_no: str = "row_no", name: str = "chunk_id") -> DataFrame:
    """Chunk number (from 0) out of the row number."""
    return df.withColumn(name, F.floor((q(row_no) - 1) / F.lit(chunk_size)).cast("bigint"))


def chunk_position(chunk_id: int, chunk_size: int = CHUNK_SIZE) -> int:
    """Line at which a chunk starts, from 1."""
    return chunk_id * chunk_size + 1


# ---------------------------------------------------------------- functions per chunk

def _labels_of(df: DataFrame) -> dict[str, dict]:
    return {c: m.to_dict() for c, m in all_meta(df).items() if m != VarMeta()}


def _call(f: Callable, pdf: pd.DataFrame, chunk_size: int, row_no: str, meta: dict[str, dict], keep: list[str]):
    pdf = pdf.sort_values(row_no, kind="stable")
    chunk = int(pdf["__chunk"].iloc[0])
    data = pdf[keep].reset_index(drop=True)
    data.attrs.update(meta)
    return chunk, f(data, chunk_position(chunk, chunk_size))


def chunk_map(df: DataFrame, f: Callable[[pd.DataFrame, int], pd.DataFrame], schema: str | T.StructType,
              chunk_size: int = CHUNK_SIZE, row_no: str = "row_no", keep_chunk: bool = False) -> DataFrame:
    """Run ``f(rows, position)`` on every chunk and stack the results.

    ``df`` carries ``row_no`` (see :func:`with_row_no`). The chunk's column metadata is in
    ``rows.attrs``. Chunks have equal size, so no group is larger than ``chunk_size`` rows.
    With ``keep_chunk`` the results stay apart: a leading ``chunk_id`` column says which.

    Chunks are brought together by a shuffle. If the rows were numbered with ``blocks``, only
    the chunks that cross the border of an input split are; all others run in place, at the
    price of a second scan for the border rows.
    """
    meta, keep = _labels_of(df), [c for c in df.columns if c not in (row_no, "__lo", "__hi")]
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    if keep_chunk:
        out = T.StructType([T.StructField("chunk_id", T.LongType()), *out.fields])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        chunk, res = _call(f, pdf, chunk_size, row_no, meta, keep)
        if keep_chunk:
            res = res.copy()
            res.insert(0, "chunk_id", chunk)
        return res

    def run_in_place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows of a block arrive in order, and a chunk lies in one block
        held: list[pd.DataFrame] = []
        done: set[int] = set()
        for pdf in batches:
            for chunk, piece in pdf.groupby("__chunk", sort=False):
                if held and int(held[0]["__chunk"].iloc[0]) != chunk:
                    done.add(int(held[0]["__chunk"].iloc[0]))
                    yield run(pd.concat(held, ignore_index=True))
                    held = []
                if chunk in done:
                    raise RuntimeError("rows of a chunk are not together")
                held.append(piece)
        if held:
            yield run(pd.concat(held, ignore_index=True))

    tagged = with_chunk_id(df, chunk_size, row_no, "__chunk")
    if "__lo" not in df.columns:
        return tagged.groupBy("__chunk").applyInPandas(run, out)
    start = F.col("__chunk") * chunk_size + 1
    whole = F.coalesce((start >= F.col("__lo")) & (start + (chunk_size - 1) <= F.col("__hi")), F.lit(False))
    inside = tagged.filter(whole).drop("__lo", "__hi").mapInPandas(run_in_place, out)
    border = tagged.filter(~whole).drop("__lo", "__hi").groupBy("__chunk").applyInPandas(run, out)
    return inside.unionByName(border)


def chunk_list(df: DataFrame, f, schema, chunk_size: int = CHUNK_SIZE, row_no: str = "row_no") -> DataFrame:
    """:func:`chunk_map` with the results of the chunks kept apart by ``chunk_id``."""
    return chunk_map(df, f, schema, chunk_size, row_no, keep_chunk=True)


def batch_map(df: DataFrame, f: Callable[[pd.DataFrame, int], pd.DataFrame], schema: str | T.StructType) -> DataFrame:
    """Run ``f`` on Arrow batches where they lie, without a shuffle, when the chunk bounds do
    not matter. The second argument is the batch's number within its task."""
    meta = _labels_of(df)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for i, pdf in enumerate(batches):
            pdf.attrs.update(meta)
            yield f(pdf, i)

    return df.mapInPandas(run, schema)


def chunk_reduce(df: DataFrame, receive: Callable[[pd.DataFrame, int], pd.DataFrame],
                 merge: Callable[[pd.DataFrame], pd.DataFrame], schema: str | T.StructType,
                 chunk_size: int = CHUNK_SIZE, row_no: str = "row_no", fan_in: int = 1000) -> DataFrame:
    """A user's own accumulator: ``receive`` turns a chunk into a small state table, ``merge``
    turns stacked states into one state. Merging must not depend on grouping or order.

    States are merged as a tree: no task ever gets more than ``fan_in`` of them.
    """
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    last = df.agg(F.max(q(row_no))).first()[0]
    chunks = 0 if last is None else (last - 1) // chunk_size + 1
    states = chunk_map(df, receive, out, chunk_size, row_no, keep_chunk=True)
    tagged = T.StructType([T.StructField("chunk_id", T.LongType()), *out.fields])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["chunk_id"].iloc[0]) // fan_in
        res = merge(pdf.drop(columns="chunk_id")).copy()
        res.insert(0, "chunk_id", group)
        return res

    while chunks > 1:
        groups = F.floor(F.col("chunk_id") / fan_in)
        states = states.groupBy(groups).applyInPandas(fold, tagged)
        chunks = -(-chunks // fan_in)
    return states.drop("chunk_id")


def chunk_side_effect(df: DataFrame, f: Callable[[pd.DataFrame, int], Any], chunk_size: int = CHUNK_SIZE,
                      row_no: str = "row_no", wave: int | None = None) -> int:
    """Run ``f(rows, position)`` on the executors for its side effects; False stops the run.

    Chunks run in waves of ``wave`` chunks, in order, so chunks of the same wave may still run
    after one said stop; ``wave=1`` is strictly one by one. Returns the number of chunks run.
    A chunk may run again when its executor is lost: side effects must allow it. Use a stored
    table (a :class:`RowReader` writes one) so that a wave reads only its rows.
    """
    meta, keep = _labels_of(df), [c for c in df.columns if c not in (row_no, "__lo", "__hi")]
    last = df.agg(F.max(q(row_no))).first()[0]
    if last is None:
        return 0
    chunks = (last - 1) // chunk_size + 1
    step = wave or 4 * df.sparkSession.sparkContext.defaultParallelism

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, res = _call(f, pdf, chunk_size, row_no, meta, keep)
        return pd.DataFrame({"stop": [res is False]})

    done = 0
    for first in range(0, chunks, step):
        rows = df.filter(q(row_no).between(first * chunk_size + 1, (first + step) * chunk_size))
        stops = (with_chunk_id(rows, chunk_size, row_no, "__chunk").groupBy("__chunk")
                 .applyInPandas(run, "stop boolean").agg(F.bool_or("stop").alias("s")).first()["s"])
        done = min(first + step, chunks)
        if stops:
            break
    return done


# ---------------------------------------------------------------- readers

def read_micro_chunked(spark: SparkSession, codebook, f, schema=None, chunk_size: int = CHUNK_SIZE, vars: Selection = None,
                       data_file=None, var_attrs=ALL_ATTRS, lower_vars: bool = False, keep_chunk: bool = False,
                       wave: int | None = None, in_place: bool = False):
    """Read microdata and run ``f(rows, position)`` per chunk.

    With an output ``schema`` the results are stacked (or kept apart, ``keep_chunk``); without
    one ``f`` runs for its side effects and the number of chunks run is returned.
    """
    df = _numbered_micro(spark, codebook, vars, data_file, var_attrs, lower_vars, in_place and schema is not None)
    if schema is None:
        reader = RowReader(df)
        return chunk_side_effect(reader.stored, f, chunk_size, wave=wave)
    return chunk_map(df, f, schema, chunk_size, keep_chunk=keep_chunk)


def read_micro_list_chunked(spark: SparkSession, codebook, f: Callable[[dict[str, pd.DataFrame], int], pd.DataFrame],
                            schema, chunk_size: int = CHUNK_SIZE, vars: Selection = None, data_file=None,
                            var_attrs=ALL_ATTRS, lower_vars: bool = False, keep_chunk: bool = False) -> DataFrame:
    """Per chunk, ``f`` gets one pandas table per record type, named from the record-type labels.

    A variable that is not labelled for a record type does not appear in that type's table.
    """
    from ..sources.micro import _book, _data_path, _is_csv, _same_code, cut_variable, rectype_expr
    book = _book(spark, codebook, lower_vars)
    path = _data_path(spark, book, data_file)
    small = book.prune(vars, "list")
    if _is_csv(path) or not book.hierarchical:
        df = _numbered_micro(spark, book, vars, data_file, var_attrs, False)
        return chunk_map(df, lambda pdf, pos: f({"P": pdf}, pos), schema, chunk_size, keep_chunk=keep_chunk)
    codes = list(dict.fromkeys(r for v in small.variables for r in (v.rectypes or ())))
    names = dict(zip(codes, book.rectype_names(codes)))
    members = {names[c]: [v.name for v in small.variables if v.rectypes and c in v.rectypes] for c in codes}
    rt = rectype_expr(F.col("value"), book)
    width = book.variable(book.rectype_idvar).width
    which = None
    for c in codes:
        hit = _same_code(rt, [c], width)
        which = F.when(hit, names[c]) if which is None else which.when(hit, names[c])
    lines = with_row_no(spark.read.text(path))
    df = lines.select(which.alias("__type"), *[cut_variable(F.col("value"), v, book.file_encoding).alias(v.name)
                                                for v in small.variables], "row_no")
    df = set_attributes(df, small, var_attrs)

    def split(pdf: pd.DataFrame, pos: int) -> pd.DataFrame:
        parts = {}
        for name, cols in members.items():
            part = pdf.loc[pdf["__type"] == name, cols].reset_index(drop=True)
            part.attrs.update({c: m for c, m in pdf.attrs.items() if c in cols})
            parts[name] = part
        return f(parts, pos)

    return chunk_map(df, split, schema, chunk_size, keep_chunk=keep_chunk)


def _numbered_micro(spark, codebook, vars, data_file, var_attrs, lower_vars, blocks: bool = False) -> DataFrame:
    from ..sources.micro import _book, _data_path, _is_csv, cut_lines
    book = _book(spark, codebook, lower_vars)
    path = _data_path(spark, book, data_file)
    small = book.prune(vars, "long")
    if _is_csv(path):
        csv = spark.read.csv(path, header=True, nullValue="NA", encoding=canonical(book.file_encoding))
        return set_attributes(_csv_columns(with_row_no(csv, blocks=blocks), small), small, var_attrs)
    lines = with_row_no(spark.read.text(path), blocks=blocks)
    extra = ("row_no", "__lo", "__hi") if blocks else ("row_no",)
    return set_attributes(cut_lines(lines, small, book, keep=extra), small, var_attrs)


def _csv_columns(raw: DataFrame, book: Codebook) -> DataFrame:
    from ..sources.micro import _SPARK_TYPE, typed_text
    if book.hierarchical:
        raise ValueError("a file of several record types cannot be CSV")
    have = {c.upper(): c for c in raw.columns}
    cols = []
    for v in book.variables:
        if v.name.upper() in have:
            dt = _SPARK_TYPE.get(v.var_type, T.StringType())
            c = q(have[v.name.upper()])
            cols.append(typed_text(c, dt).alias(v.name))
    return raw.select(*[c for c in ("row_no", "__lo", "__hi") if c in raw.columns], *cols)


# ---------------------------------------------------------------- resumable pulls

class RowReader:
    """Pull a table piece by piece: ``pull(n)``, ``reset()``, ``is_done()``, ``position``, ``total``.

    The numbered rows are written once as Parquet to the shared folder. Files hold runs of
    consecutive row numbers, so a pull reads only the row groups of its range.
    """

    def __init__(self, numbered: DataFrame, row_no: str = "row_no", path: str | None = None):
        spark = numbered.sparkSession
        self._row_no = row_no
        self._meta = all_meta(numbered)
        where = path or scratch_path(spark, "rows")
        numbered.write.mode("errorifexists").parquet(where)
        self.path = where
        self.stored = with_meta(spark.read.schema(numbered.schema).parquet(where), self._meta)
        self.total = self.stored.agg(F.max(q(row_no))).first()[0] or 0
        self.position = 0

    def pull(self, n: int = CHUNK_SIZE) -> DataFrame | None:
        """The next n rows, or None when all have been read."""
        if self.is_done():
            return None
        lo, hi = self.position + 1, min(self.position + n, self.total)
        self.position = hi
        return self.stored.filter(q(self._row_no).between(lo, hi)).drop(self._row_no, "__lo", "__hi")

    def is_done(self) -> bool:
        return self.position >= self.total

    def reset(self) -> None:
        self.position = 0

    def __iter__(self) -> Iterator[DataFrame]:
        while (part := self.pull()) is not None:
            yield part


class ListRowReader(RowReader):
    """:class:`RowReader` over raw lines of a hierarchical file: a pull gives one table per
    record type."""

    def __init__(self, spark: SparkSession, codebook, vars: Selection = None, data_file=None, var_attrs=ALL_ATTRS,
                 lower_vars: bool = False):
        from ..sources.micro import _book, _data_path
        self._book = _book(spark, codebook, lower_vars)
        self._small = self._book.prune(vars, "list")
        self._attrs = var_attrs
        path = _data_path(spark, self._book, data_file)
        _no_csv(path)
        # raw lines are kept as bytes, whatever their charset
        lines = with_row_no(spark.read.text(path)).withColumn("value", F.col("value").cast("binary"))
        super().__init__(lines)

    def pull(self, n: int = CHUNK_SIZE):
        from ..sources.micro import cut_lines, split_rectypes
        part = super().pull(n)
        if part is None:
            return None
        lines = part.withColumn("value", F.col("value").cast("string"))
        if not self._book.hierarchical:
            return {"P": set_attributes(cut_lines(lines, self._small), self._small, self._attrs)}
        return split_rectypes(lines, self._book, self._small, self._attrs)


def _no_csv(path) -> None:
    from ..sources.micro import _is_csv
    if _is_csv(path):
        raise ValueError("rows are pulled from fixed-width files, not from CSV")


def read_micro_pulled(spark: SparkSession, codebook, vars: Selection = None, data_file=None, var_attrs=ALL_ATTRS,
                      lower_vars: bool = False, index: LineIndex | None = None) -> RowReader | LineReader:
    """Resumable reader of a fixed-width file, record types mixed.

    With a line index of the file (:func:`build_line_index`) a pull reads the bytes of its lines only; without one the rows are written once as Parquet.
    """
    from ..sources.micro import _book, _data_path, cut_lines
    book = _book(spark, codebook, lower_vars)
    path = _data_path(spark, book, data_file)
    _no_csv(path)
    if index is not None:
        small = book.prune(vars, "long")
        return LineReader(_same_files(index, path), lambda lines: set_attributes(cut_lines(lines, small, book), small, var_attrs))
    return RowReader(_numbered_micro(spark, book, vars, data_file, var_attrs, False))


def read_micro_list_pulled(spark: SparkSession, codebook, index: LineIndex | None = None, **kw) -> ListRowReader | LineReader:
    """Resumable reader of a fixed-width file, one table per record type; with a line index by byte ranges, as :func:`read_micro_pulled`."""
    if index is None:
        return ListRowReader(spark, codebook, **kw)
    return _ranged_list(spark, codebook, index, **kw)


def _ranged_list(spark, codebook, index, vars: Selection = None, data_file=None, var_attrs=ALL_ATTRS, lower_vars: bool = False) -> LineReader:
    from ..sources.micro import _book, _data_path, cut_lines, split_rectypes
    book = _book(spark, codebook, lower_vars)
    path = _data_path(spark, book, data_file)
    _no_csv(path)
    small = book.prune(vars, "list")
    if not book.hierarchical:
        return LineReader(_same_files(index, path), lambda lines: {"P": set_attributes(cut_lines(lines, small), small, var_attrs)})
    return LineReader(_same_files(index, path), lambda lines: split_rectypes(lines, book, small, var_attrs))


def _same_files(index: LineIndex, path) -> LineIndex:
    if files_of(path) != index.files:
        raise ValueError("the index is of other files, or they changed since")
    return index


def stack_pulls(reader: RowReader, f: Callable[[DataFrame], DataFrame], n: int = CHUNK_SIZE) -> DataFrame:
    """Apply a DataFrame function to every pull and stack the (lazy) results."""
    parts = []
    while (part := reader.pull(n)) is not None:
        parts.append(f(part))
    return bind_rows(parts)
