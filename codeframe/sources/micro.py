"""Microdata: fixed-width and CSV files described by a codebook.

One text scan and one projection: each selected variable becomes a ``substring`` + cast, so
columns that a query does not use are pruned before they are cut. Record types share the
scan; a variable is NULL on rows of record types it does not belong to.
"""

from __future__ import annotations

import os
import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codebook import Codebook, Variable
from ..functions.charset import canonical, slice_field
from ..functions.numbers import to_number
from ..metadata import ALL_ATTRS, is_integral, q
from ..operators.labels import set_attributes
from ..select import Selection
from ..session import tune
from .ddi import read_codebook
from .files import file_ext, resolve_data_file

_SPARK_TYPE = {"integer": T.IntegerType(), "numeric": T.DoubleType(), "character": T.StringType()}


def column_type(v: Variable) -> T.DataType:
    """Spark type of a fixed-width variable; implied decimals make a number a double."""
    if v.var_type == "integer" and not v.imp_decim:
        return T.IntegerType()
    return T.StringType() if v.var_type not in ("integer", "numeric") else T.DoubleType()


def cut_variable(line: Column, v: Variable, charset: str | None) -> Column:
    """One variable of a fixed-width line: cut, trimmed, typed, decimals put in place.

    Blank or unparsable numbers and blank texts are NULL.
    """
    dt = column_type(v)
    if isinstance(dt, T.StringType):
        text = F.trim(slice_field(line, v.start, v.width, charset, as_text=True))
        return F.when(text != "", text)
    number = typed_text(slice_field(line, v.start, v.width, charset, as_text=False), dt)
    return number / F.lit(10.0 ** v.imp_decim) if v.imp_decim else number


def typed_text(text: Column, dt: T.DataType) -> Column:
    """A field's text as its type; what is no number is NULL, Java's own forms ("12D", "NaN", "0x1p3") included."""
    if isinstance(dt, T.StringType):
        return F.trim(text)
    return text.try_cast(dt) if is_integral(dt) else to_number(text, dt.simpleString())


def rectype_expr(line: Column, book: Codebook) -> Column:
    """Record-type code of a line, as text. Codes are ASCII, so their bytes need no decoding."""
    ids = [v for v in book.variables if v.name == book.rectype_idvar]
    if len(ids) != 1:
        raise ValueError("the codebook must hold exactly one record-type id variable")
    return F.trim(slice_field(line, ids[0].start, ids[0].width, book.file_encoding, as_text=False))


def _same_code(rt: Column, codes, width: int) -> Column:
    """Record-type test; "01" and "1" are one code, so every zero-padded form is listed."""
    forms: dict[str, None] = {}
    for c in (str(c).strip() for c in codes):
        forms[c] = None
        if c.isdigit():
            digits = c.lstrip("0") or "0"
            forms.update(dict.fromkeys(digits.zfill(n) for n in range(len(digits), width + 1)))
    return rt.isin(list(forms))


def cut_lines(lines: DataFrame, book: Codebook, rectype_book: Codebook | None = None, keep=()) -> DataFrame:
    """Project a text table ``(value, ...)`` onto the variables of a codebook (long form)."""
    line = F.col("value")
    id_book = rectype_book or book
    rt = rectype_expr(line, id_book) if book.hierarchical else None
    cols = []
    for v in book.variables:
        c = cut_variable(line, v, book.file_encoding)
        if book.hierarchical and v.rectypes is not None and set(v.rectypes) != set(book.rectypes or ()):
            c = F.when(_same_code(rt, v.rectypes, id_book.variable(id_book.rectype_idvar).width), c)
        cols.append(c.alias(v.name))
    return lines.select(*[q(k) for k in keep], *cols)


def _book(spark: SparkSession, codebook, lower_vars: bool) -> Codebook:
    tune(spark)
    if isinstance(codebook, Codebook):
        if lower_vars:
            warnings.warn("lower_vars has been ignored because the codebook is already loaded; "
                          "lower its names with Codebook.lower().", stacklevel=3)
        return codebook
    return read_codebook(spark, codebook, lower_vars)


def _data_path(spark: SparkSession, book: Codebook, data_file) -> str | list[str]:
    if isinstance(data_file, (list, tuple)):
        return [str(p) for p in data_file]
    path = data_file or os.path.join(book.file_path or "", book.file_name or "")
    return resolve_data_file(spark, path)


def _is_csv(path) -> bool:
    return file_ext(path if isinstance(path, str) else path[0]) in (".csv", ".csv.gz")


def read_lines(spark: SparkSession, path, n_max: int | None = None, spread_gzip: bool = True) -> DataFrame:
    """Raw lines. ``n_max`` takes the first lines in file order, the same ones every time.

    A gzip file cannot be split: one task reads it, and its lines are then dealt out by line
    number (a value, so a repeated task deals them the same way).
    """
    lines = spark.read.text(path)
    if n_max is not None:
        return first_rows(lines, n_max, spark.read.text)
    return _spread(lines) if spread_gzip and _few_gzip_files(lines) else lines


def first_rows(df: DataFrame, n: int, read: Callable[[list[str]], DataFrame]) -> DataFrame:
    """The first n rows of a scan, in file and line order; only the files that hold them are read.

    ``read`` makes the same scan of a list of files. Each file is asked for no more rows than are still missing.
    """
    from ..streaming.chunks import with_row_no
    used, missing = [], n
    for path in sorted(df.inputFiles()):
        used.append(path)
        missing -= read([path]).limit(missing).count()
        if missing <= 0:
            break
    if not used:
        return df.limit(0)
    return with_row_no(read(used), "__no").filter(F.col("__no") <= n).drop("__no")


def _few_gzip_files(df: DataFrame) -> bool:
    """Only gzip files, and fewer of them than tasks can run."""
    files = df.inputFiles()
    return 0 < len(files) < df.sparkSession.sparkContext.defaultParallelism and all(f.endswith(".gz") for f in files)


def _spread(df: DataFrame) -> DataFrame:
    """Deal the rows of an unsplittable file out over the cluster, by their number."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    return df.withColumn("__seq", F.monotonically_increasing_id()).repartition(n, "__seq").drop("__seq")


def _read_csv(spark: SparkSession, path, book: Codebook, n_max: int | None, spread_gzip: bool = True) -> DataFrame:
    """Listed columns of a CSV with codebook types; the header is matched in upper case.
    CSV numbers carry their decimal point, so implied decimals do not apply."""
    if book.hierarchical:
        raise ValueError("a file of several record types cannot be CSV")
    raw = spark.read.csv(path, header=True, encoding=canonical(book.file_encoding), nullValue="NA")
    if n_max is not None:
        raw = first_rows(raw, n_max, lambda files: spark.read.schema(raw.schema).csv(
            files, header=True, encoding=canonical(book.file_encoding), nullValue="NA"))
    elif spread_gzip and _few_gzip_files(raw):
        wanted = {v.name.upper() for v in book.variables}
        raw = _spread(raw.select(*[q(c) for c in raw.columns if c.upper() in wanted]))
    have = {c.upper(): c for c in raw.columns}
    cols = []
    for v in book.variables:
        if v.name.upper() not in have:
            warnings.warn(f"the file has no column {v.name}", stacklevel=4)
            continue
        c = q(have[v.name.upper()])
        dt = _SPARK_TYPE.get(v.var_type, T.StringType())
        cols.append(typed_text(c, dt).alias(v.name))
    return raw.select(*cols)


def read_micro(spark: SparkSession, codebook: Codebook | str, vars: Selection = None, n_max: int | None = None,
               data_file=None, var_attrs=ALL_ATTRS, lower_vars: bool = False, spread_gzip: bool = True) -> DataFrame:
    """Microdata as one labelled table (record types mixed, if the file is hierarchical)."""
    book = _book(spark, codebook, lower_vars)
    path = _data_path(spark, book, data_file)
    small = book.prune(vars, "long")
    if _is_csv(path):
        out = _read_csv(spark, path, small, n_max, spread_gzip)
    else:
        out = cut_lines(read_lines(spark, path, n_max, spread_gzip), small, book)
    return set_attributes(out, small, var_attrs)


def split_rectypes(lines: DataFrame, book: Codebook, small: Codebook, var_attrs=ALL_ATTRS) -> dict[str, DataFrame]:
    """One table per record type out of raw lines, with that type's variables only."""
    rt = rectype_expr(F.col("value"), book)
    width = book.variable(book.rectype_idvar).width
    codes = list(dict.fromkeys(r for v in small.variables for r in (v.rectypes or ())))
    out = {}
    for code, name in zip(codes, book.rectype_names(codes)):
        mine = [v for v in small.variables if v.rectypes and code in v.rectypes]
        df = lines.filter(_same_code(rt, [code], width)).select(
            *[cut_variable(F.col("value"), v, book.file_encoding).alias(v.name) for v in mine])
        out[name] = set_attributes(df, mine, var_attrs)
    return out


def read_micro_list(spark: SparkSession, codebook: Codebook | str, vars: Selection = None, n_max: int | None = None,
                    data_file=None, var_attrs=ALL_ATTRS, lower_vars: bool = False, staging: str | None = None,
                    spread_gzip: bool = True) -> dict[str, DataFrame]:
    """Microdata as one table per record type, named from the record-type labels.

    A rectangular file is the single table "P". Each table filters the lines on its record
    type before cutting any column. With ``staging`` (a shared folder) the lines are written
    once, partitioned by record type, and each table reads its own partition only.
    """
    book = _book(spark, codebook, lower_vars)
    path = _data_path(spark, book, data_file)
    small = book.prune(vars, "list")
    if _is_csv(path):
        return {"P": set_attributes(_read_csv(spark, path, small, n_max, spread_gzip), small, var_attrs)}
    lines = read_lines(spark, path, n_max, spread_gzip)
    if not book.hierarchical:
        return {"P": set_attributes(cut_lines(lines, small), small, var_attrs)}
    if staging is None:
        return split_rectypes(lines, book, small, var_attrs)
    tagged = lines.withColumn("rt", rectype_expr(F.col("value"), book))
    tagged.write.mode("errorifexists").partitionBy("rt").parquet(staging)
    codes = list(dict.fromkeys(r for v in small.variables for r in (v.rectypes or ())))
    stored = spark.read.schema("value string, rt string").parquet(staging)
    out = {}
    for code, name in zip(codes, book.rectype_names(codes)):
        part = stored.filter(_same_code(F.col("rt"), [code], book.variable(book.rectype_idvar).width))
        mine = [v for v in small.variables if v.rectypes and code in v.rectypes]
        df = part.select(*[cut_variable(F.col("value"), v, book.file_encoding).alias(v.name) for v in mine])
        out[name] = set_attributes(df, mine, var_attrs)
    return out


def collect_with_labels(df: DataFrame, codebook: Codebook, var_attrs=ALL_ATTRS) -> DataFrame:
    """Attach codebook metadata to a table that comes from a database or a catalog.

    ``spark.read.jdbc(...)`` or ``spark.table(...)`` stay lazy: nothing needs collecting.
    """
    return set_attributes(df, codebook, var_attrs)
