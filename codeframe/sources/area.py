"""Area tables and loosely described microdata in CSV form.

Columns are read as text and typed on all their values (one aggregate over the file, see
``functions.numbers.guess_types``). Pass ``types`` to skip that pass when they are known.
"""

from __future__ import annotations

import csv
import warnings
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codebook import Codebook
from ..functions.charset import canonical
from ..functions.numbers import BOOLEAN, DATE, NUMBER, TIMESTAMP, convert, guess_types, lenient_number, na_to_null, to_number
from ..metadata import ALL_ATTRS, q
from ..operators.labels import set_attributes
from ..select import Selection
from ..streaming.chunks import _is_plain_scan
from .archive import can_open, peek
from .ddi import read_codebook
from .files import file_ext, find_files, is_bundle, member_lines, path_exists
from .textbook import codebook_path_for, read_text_codebook


def _text_csv(spark: SparkSession, path: str, member: Selection, charset: str, **options) -> DataFrame:
    """A CSV as text columns, from a path, a folder (one CSV chosen) or a zip member."""
    ext = file_ext(path)
    if ext == ".zip":
        names = find_files(spark, path, r"(csv|gz)", member)
        if not names:
            raise FileNotFoundError(f"no csv in {path}")
        lines = member_lines(spark, path, names)
        text = lines.select("line_no", F.col("raw").cast("string").alias("value") if canonical(charset) == "UTF-8"
                            else F.decode("raw", canonical(charset)).alias("value"))
        header = peek(path, names[0])[0].decode(canonical(charset)) if can_open(path) else text.filter("line_no = 1").first()["value"]
        cols = next(csv.reader([header.lstrip("\ufeff")]))
        ddl = ", ".join("`" + c.replace("`", "``") + "` string" for c in cols)
        parsed = text.filter("line_no > 1 and value != ''").select(F.from_csv("value", ddl, options).alias("r"))
        return parsed.select(*[F.col("r").getField(c).alias(c) for c in cols])
    if ext == "":
        names = find_files(spark, path, r"(csv|gz)", member)
        path = f"{path.rstrip('/')}/{names[0]}"
    return spark.read.csv(path, header=True, encoding=canonical(charset), **options)


def _optional(read):
    """A codebook if there is one; one that cannot be read or chosen is left out with a warning."""
    try:
        return read()
    except FileNotFoundError:
        return None
    except ValueError as why:
        warnings.warn(f"no labels: {why}", stacklevel=3)
        return None


def drop_second_header(df: DataFrame, second_header: bool | None = None) -> DataFrame:
    """Remove descriptive second header rows: the first data row of each file, never a later one.

    With None, a first row is taken for a header if it holds text and none of its values converts to anything else, and a warning tells
    when rows go; True drops the first row of every file, False none. Rows that did not come
    straight from files (archive members) have one file's head only.
    """
    if second_header is False or not df.columns:
        return df
    plain = _is_plain_scan(df)
    first = df.first() if second_header is None or not plain else None
    if second_header is None:
        if first is None:
            return df
        alone = df.sparkSession.createDataFrame([tuple(first)], df.schema)
        if not all(isinstance(t, T.StringType) for t in guess_types(alone).values()):
            return df
        warnings.warn("a first data row without any number is taken for a second header and left out; "
                      "second_header=False keeps it", stacklevel=3)
    if not plain:
        if first is None:
            return df
        same = reduce(and_, [q(c).eqNullSafe(F.lit(first[c])) for c in df.columns])
        return df.filter(~same)
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__start"),
             F.monotonically_increasing_id().alias("__id")]
    heads = (df.select(*place).filter("__start = 0").groupBy(F.col("__file").alias("__head_file"))
             .agg(F.min("__id").alias("__head")))
    text_only = F.lit(True)
    if second_header is None:
        for c in df.columns:
            text_only = text_only & (q(c).isNull() | ~F.trim(q(c)).rlike(f"{NUMBER}|{BOOLEAN}|{DATE}|{TIMESTAMP}"))
    tagged = df.select(*[q(c) for c in df.columns], *place)
    is_head = (F.col("__start") == 0) & (F.col("__id") == F.col("__head")) & text_only
    out = tagged.join(heads, F.col("__file") == F.col("__head_file"), "left").filter(~F.coalesce(is_head, F.lit(False)))
    return out.select(*[q(c) for c in df.columns])


def _typed(df: DataFrame, types: dict[str, T.DataType] | None) -> DataFrame:
    known = types or {}
    rest = [c for c in df.columns if c not in known]
    return convert(df, {**(guess_types(df, rest) if rest else {}), **known})


def read_area_table(spark: SparkSession, data_file: str, data_layer: Selection = None, codebook=None,
                    var_attrs=ALL_ATTRS, encoding: str | None = None, types: dict[str, T.DataType] | None = None,
                    csv_options: dict | None = None, second_header: bool | None = None) -> DataFrame:
    """Area-level CSV: optional second header row, guessed types, labels from the codebook.

    ``codebook`` is a :class:`Codebook` or a path; by default it is looked for in the same
    archive or folder, or as ``x_codebook.txt`` next to ``x.csv``. Without a codebook the
    table has no labels. ``csv_options`` go to Spark's CSV source, for example
    ``{"multiLine": True}`` for texts with line breaks (such a file is read by one task).
    ``second_header``: see :func:`drop_second_header`.
    """
    book = codebook
    if isinstance(codebook, str):
        book = read_text_codebook(spark, codebook, None)
    elif codebook is None:
        path = data_file if is_bundle(data_file) else codebook_path_for(data_file)
        if path != data_file or is_bundle(data_file):
            book = _optional(lambda: read_text_codebook(spark, path, data_layer) if path_exists(spark, path) else None)
    raw = _text_csv(spark, data_file, data_layer, encoding or "ISO-8859-1", **(csv_options or {}))
    out = _typed(drop_second_header(raw, second_header), types)
    return set_attributes(out, book, var_attrs) if book is not None else out


def read_area_utf8(spark: SparkSession, data_file: str, data_layer: Selection = None, ddi=None, codebook=None,
                   var_attrs=ALL_ATTRS, types: dict[str, T.DataType] | None = None,
                   csv_options: dict | None = None) -> tuple[DataFrame, Codebook | None]:
    """Area CSV in UTF-8 described by an XML codebook (terms) and a text codebook (variables).

    Where both are given, the variables and the project name are the text codebook's. Both are
    looked for in the archive or folder of the data unless given. Returns the table and the
    combined codebook.
    """
    bundle = is_bundle(data_file)
    xml = read_codebook(spark, ddi) if isinstance(ddi, str) else ddi
    if xml is None and bundle:
        xml = _optional(lambda: read_codebook(spark, data_file))
    text = read_text_codebook(spark, codebook, data_layer) if isinstance(codebook, str) else codebook
    if text is None and bundle:
        text = _optional(lambda: read_text_codebook(spark, data_file, data_layer))
    book = xml or text
    if xml is not None and text is not None:
        book = replace(xml, variables=text.variables, project=text.project)
    out = _typed(_text_csv(spark, data_file, data_layer, "UTF-8", **(csv_options or {})), types)
    return (set_attributes(out, book, var_attrs) if book is not None else out), book


def read_mixed_micro(spark: SparkSession, data_file: str, ddi=None, data_layer: Selection = None,
                     n_max: int | None = None, var_attrs=ALL_ATTRS, encoding: str | None = None,
                     csv_options: dict | None = None) -> DataFrame:
    """CSV microdata whose codebook covers only part of the columns.

    The missing-value token is ``null``. Declared numbers are read leniently (symbols and
    grouping commas dropped), declared integers and texts as such, all other columns guessed.
    A variable that the codebook repeats counts once.
    """
    book = read_codebook(spark, ddi) if isinstance(ddi, str) else ddi
    if book is None and is_bundle(data_file):
        book = _optional(lambda: read_codebook(spark, data_file))
    charset = encoding or (book.file_encoding if book is not None else None) or "ISO-8859-1"
    raw = _text_csv(spark, data_file, data_layer, charset, nullValue="null", **(csv_options or {}))
    if n_max is not None:
        from ..streaming.chunks import with_row_no
        raw = with_row_no(raw, "__no").filter(F.col("__no") <= n_max).drop("__no")
    declared: dict[str, str] = {}
    for v in (book.variables if book is not None else ()):
        if v.name in raw.columns:
            declared.setdefault(v.name, v.var_type)
    cols = []
    for c in raw.columns:
        kind = declared.get(c)
        if kind == "numeric":
            cols.append(lenient_number(q(c)).alias(c))
        elif kind == "integer":
            cols.append(to_number(na_to_null(q(c)), "int").alias(c))
        else:
            cols.append(q(c))
    out = raw.select(*cols)
    # Only numbers are final after the declared parse; declared texts are typed like the rest.
    texts = [c for c in out.columns if declared.get(c) not in ("numeric", "integer")]
    out = convert(out, guess_types(out, texts))
    if book is None:
        return out
    fits = [v for v in book.variables if v.name in out.columns]
    return set_attributes(out, fits, var_attrs)
