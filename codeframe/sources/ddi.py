"""XML codebooks (DDI) to metadata tables.

A file, or a folder of any number of codebooks, is read by Spark's XML source, one pass per
element kind. The schemas are explicit: inference would turn the code "01" into 1. Every
element that may repeat is declared an array, the first one counts.
"""

from __future__ import annotations

import os
import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..codebook import Codebook, CodebookTables
from ..select import Selection
from .files import file_ext, find_files, is_bundle, unpack_text

_VAR = (
    "_name string, _dcml string, _intrvl string, _rectype string, "
    "location array<struct<_StartPos: string, _EndPos: string, _width: string>>, "
    "labl array<string>, txt array<string>, codInstr array<string>, "
    "varFormat array<struct<_type: string>>, catgry array<struct<catValu: array<string>, labl: array<string>>>"
)
_STUDY = (
    "citation array<struct<prodStmt: array<struct<prodDate: array<struct<_date: string>>>>, "
    "serStmt: array<struct<serName: array<string>>>>>, "
    "dataAccs array<struct<useStmt: array<struct<conditions: array<string>, citReq: array<string>>>>>, "
    "notes array<string>"
)
_FILE = (
    "fileTxt array<struct<fileName: array<string>, fileStrc: array<struct<_type: string, "
    "recGrp: array<struct<_rectype: string, _recidvar: string, _keyvar: string, labl: array<string>>>>>, "
    "fileType: array<struct<_charset: string>>>>"
)

# Fixed patterns: "code label" lines in coding instructions, for number and for text codes.
NUMERIC_LABEL = r"^(-?[0-9.,]+)(?:(?:\p{Blank}\p{Punct}|\p{Punct}\p{Blank}|\p{Blank}|=)+)(.+?)$"
TEXT_LABEL = r"^(\p{Graph}+)(?:(?:\p{Blank}+[\p{Punct}|=]+\p{Blank})+)(.+)$"


def _read(spark: SparkSession, path, tag: str, schema: str) -> DataFrame:
    """Elements of one kind with their codebook and their order in it."""
    return (
        spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", True).option("mode", "FAILFAST")
        .schema(schema).load(path)
        .select("*", F.col("_metadata.file_path").alias("codebook_id"), F.monotonically_increasing_id().alias("__seq"))
    )


def _first(col: str | Column) -> Column:
    return F.try_element_at(F.col(col) if isinstance(col, str) else col, F.lit(1))


def _first_row(df: DataFrame, key: str = "codebook_id") -> DataFrame:
    w = Window.partitionBy(key).orderBy("__seq")
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def var_type(declared: Column, interval: Column, width: Column) -> Column:
    """Whole numbers of at most nine digits are integers, other numbers are doubles,
    everything else is text."""
    return (
        F.when((declared == "numeric") & (interval == "discrete") & (width < 10), "integer")
        .when(declared == "numeric", "numeric")
        .otherwise("character")
    )


def labels_from_instructions(df: DataFrame, text: str, is_numeric: Column) -> DataFrame:
    """Rows ``(..., pos, val, val_num, lbl)`` for the "code label" lines of a text column.

    Commas in numbers are dropped; lines without a label are passed over.
    """
    lines = df.select("*", is_numeric.alias("__num"), F.posexplode(F.split(F.col(text), "\n")).alias("pos", "__line"))
    code = F.when(F.col("__num"), F.regexp_extract("__line", NUMERIC_LABEL, 1)).otherwise(
        F.regexp_extract("__line", TEXT_LABEL, 1))
    label = F.when(F.col("__num"), F.regexp_extract("__line", NUMERIC_LABEL, 2)).otherwise(
        F.regexp_extract("__line", TEXT_LABEL, 2))
    return (
        lines.select(*df.columns, "pos", "__num", code.alias("val"), label.alias("lbl"))
        .filter("val != ''")
        .withColumn("val_num", F.when(F.col("__num"), F.replace("val", F.lit(","), F.lit("")).try_cast("double")))
        .drop("__num")
    )


def category_labels(cats: DataFrame, is_numeric: Column) -> DataFrame:
    """Category rows ``(..., val, lbl)`` without labels that only repeat the value
    ("01" = "1" for numbers)."""
    lnum = F.col("lbl").try_cast("double")
    vnum = F.col("val").try_cast("double")
    keep = F.when(is_numeric, lnum.isNull() | (vnum != lnum)).otherwise(F.col("val") != F.col("lbl"))
    return cats.withColumn("val_num", F.when(is_numeric, vnum)).filter(keep)


def read_codebook_tables(spark: SparkSession, path, lower_vars: bool = False) -> CodebookTables:
    """Metadata tables of one XML codebook or a folder of them. ``codebook_id`` is the path."""
    study = _first_row(_read(spark, path, "stdyDscr", _STUDY))
    files = _first_row(_read(spark, path, "fileDscr", _FILE))
    cit = _first("citation")
    use = _first(_first("dataAccs")["useStmt"])
    study = study.select(
        "codebook_id",
        _first(_first(cit["serStmt"])["serName"]).alias("project"),
        _first(_first(cit["prodStmt"])["prodDate"])["_date"].try_cast("date").alias("extract_date"),
        F.concat_ws("\n\n", "notes").alias("extract_notes"),
        _first(use["conditions"]).alias("conditions"),
        _first(use["citReq"]).alias("citation"),
    )
    txt = _first("fileTxt")
    struct = _first(txt["fileStrc"])
    groups = F.when(struct["_type"] == "hierarchical", struct["recGrp"])
    files = files.select(
        "codebook_id",
        _first(txt["fileName"]).alias("file_name"),
        struct["_type"].alias("file_type"),
        _first(txt["fileType"])["_charset"].alias("file_encoding"),
        groups.alias("groups"),
        F.try_element_at(groups["_recidvar"], F.lit(-1)).alias("rectype_idvar"),
    )
    file_info = study.join(files.drop("groups"), "codebook_id", "full").select(
        "codebook_id", "file_name", "file_type", "project", "extract_date", "extract_notes", "conditions", "citation",
        "file_encoding", "rectype_idvar")
    record_types = files.select("codebook_id", F.explode("groups").alias("g")).select(
        "codebook_id", F.col("g._rectype").alias("rectype"), _first("g.labl").alias("label"),
        F.filter(F.split(F.coalesce("g._keyvar", F.lit("")), r"\s+"), lambda x: x != "").alias("keyvars"))

    raw = _read(spark, path, "var", _VAR)
    loc = _first("location")
    order = Window.partitionBy("codebook_id").orderBy("__seq")
    variables = raw.select(
        "codebook_id", (F.row_number().over(order) - 1).alias("pos"), F.col("_name").alias("var_name"),
        _first("labl").alias("var_label"), _first("txt").alias("var_desc"), _first("codInstr").alias("code_instr"),
        loc["_StartPos"].try_cast("int").alias("start"), loc["_EndPos"].try_cast("int").alias("end"),
        F.col("_dcml").try_cast("int").alias("imp_decim"),
        var_type(_first("varFormat")["_type"], F.col("_intrvl"), loc["_width"].try_cast("double")).alias("var_type"),
        "_rectype", "catgry",
    ).join(files.select("codebook_id", "file_type", "rectype_idvar"), "codebook_id", "left")
    number = F.col("var_type").isin("numeric", "integer")
    is_id = (F.col("file_type") == "hierarchical") & (F.col("var_name") == F.col("rectype_idvar"))

    base = variables.select("codebook_id", "var_name", "var_type", is_id.alias("is_id"), "code_instr", "catgry")
    cats = category_labels(
        base.select("codebook_id", "var_name", "var_type", F.explode("catgry").alias("c")).select(
            "codebook_id", "var_name", "var_type", _first("c.catValu").alias("val"), _first("c.labl").alias("lbl")), number)
    typed = labels_from_instructions(
        base.filter("not coalesce(is_id, false)").select("codebook_id", "var_name", "var_type", "code_instr"),
        "code_instr", number)
    # The record-type id takes its labels from the file structure.
    ids = base.filter("is_id").select("codebook_id", "var_name", "var_type").join(
        record_types.select("codebook_id", F.col("rectype").alias("val"), F.col("label").alias("lbl")), "codebook_id")
    ids = ids.withColumn("val_num", F.when(number, F.col("val").try_cast("double"))).filter(
        F.when(number, F.col("val_num").isNotNull()).otherwise(F.col("val").isNotNull()))
    cols = ["codebook_id", "var_name", "val", "val_num", "lbl"]
    labels = cats.select(*cols).unionByName(typed.select(*cols)).unionByName(ids.select(*cols))
    by_value = Window.partitionBy("codebook_id", "var_name").orderBy("val_num", "val", "lbl")
    value_labels = labels.withColumn("pos", F.row_number().over(by_value) - 1).select(
        "codebook_id", "var_name", "pos", "val", "val_num", "lbl")
    variables = variables.select(
        "codebook_id", "pos", "var_name", "var_label", "var_desc", "code_instr", "start", "end", "imp_decim", "var_type",
        F.when(F.col("file_type") == "hierarchical", F.split("_rectype", " ")).alias("rectypes"))
    out = CodebookTables(file_info, record_types, variables, value_labels)
    return out.lower() if lower_vars else out


def read_codebook(spark: SparkSession, path: str, lower_vars: bool = False, data_layer: Selection = None) -> Codebook:
    """One XML codebook as the driver-side object that the readers take.

    ``path`` may be a zip archive or a folder with one ``.xml`` in it (``data_layer`` chooses
    among several). Only the first file description is used; more than one gives a warning.
    """
    home = os.path.dirname(path)
    if is_bundle(path):
        names = find_files(spark, path, "xml", data_layer)
        if not names:
            raise FileNotFoundError(f"no xml codebook in {path}")
        home = path if file_ext(path) == "" else home
        path = unpack_text(spark, path, names[0]) if file_ext(path) == ".zip" else f"{path.rstrip('/')}/{names[0]}"
    n = _read(spark, path, "fileDscr", _FILE).count()
    if n > 1:
        warnings.warn("the codebook describes several files; the first one counts", stacklevel=2)
    book = read_codebook_tables(spark, path).codebook(file_path=home)
    return book.lower() if lower_vars else book
