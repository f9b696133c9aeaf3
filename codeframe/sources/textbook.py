"""Text codebooks to variable rows.

A text codebook has sections whose titles stand between two lines of dashes. Its data
dictionary comes in three layouts: variables per data file, context fields plus tables with
a code line, and tables of a time series. Files are lines with a running section number;
headers are carried forward with ``last(..., ignorenulls)``. Windows run per codebook file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..codebook import Codebook, Variable
from ..functions.text import capture, detect
from ..select import Selection, pick
from .files import file_ext, find_files, is_bundle, unpack_text

# Fixed patterns of the text codebook format.
MARKER = r"^[-]{5,}$"
DICTIONARY = r"^Data Dictionary$"
TERMS = r"^Citation and Use of .+ Data"
DATA_FILE = r"^Data File: (?<data_file>.+)"
CONTEXT = r"^Context Fields\s*$"
BLANK = r"^[[:blank:]]*$"
TABLE = r"^[[:blank:]]*Table [0-9]+:"
TABLE_NAME = r"^[[:blank:]]*Table .+?:[[:blank:]]+(?<name>.+)$"
TABLE_CODED = r"^[[:blank:]]*Table .+?:[[:blank:]]+\((?<code>.+?)\)[[:blank:]]+(?<name>.+)$"
TABLE_CODE = r"^[[:blank:]]*[[:alnum:]]+ code:[[:blank:]]+(?<code>.+)$"
SERIES_LINE = r"^Time series layout:[[:blank:]]+.+$"
SERIES_HEADER = r"^[[:blank:]]+Time series"
FIELD = r"(?<var_name>[[:alnum:]|[:punct:]]+):[[:blank:]]+(?<var_label>.+)$"
TABLE_HEADER_LINES = 4  # title, universe, source code, table code


def read_lines(spark: SparkSession, path) -> DataFrame:
    """``(codebook_id, line_no, line)`` of text files, read whole so that line numbers hold."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("codebook_id"), "value")
    lines = text.select("codebook_id", F.posexplode(F.split("value", r"\r?\n")).alias("p", "line"))
    return lines.select("codebook_id", (F.col("p") + 1).alias("line_no"), "line")


def with_sections(lines: DataFrame) -> DataFrame:
    """Add the section title of every line, and whether its codebook describes a time series.

    A title is a line with marker lines on both sides; its section runs to the next marker.
    """
    w = Window.partitionBy("codebook_id").orderBy("line_no")
    up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mark = detect(F.col("line"), MARKER)
    flagged = lines.withColumn("mark", mark).withColumn(
        "title", ~F.col("mark") & F.coalesce(F.lag("mark").over(w), F.lit(False)) & F.coalesce(F.lead("mark").over(w), F.lit(False)))
    flagged = flagged.withColumn("series", F.max(detect(F.col("line"), SERIES_LINE)).over(Window.partitionBy("codebook_id")))
    # A marker that closes a title opens its section; any other marker ends one.
    opener = F.coalesce(F.lag("title").over(w), F.lit(False)) & F.col("mark")
    start = F.when(opener, F.lag("line").over(w)).when(F.col("mark"), F.lit(""))
    return (
        flagged.withColumn("section", F.last(start, ignorenulls=True).over(up_to))
        .filter(~F.col("mark") & ~F.col("title") & F.col("section").isNotNull() & (F.col("section") != ""))
        .select("codebook_id", "line_no", "line", "section", "series")
    )


def layouts(lines: DataFrame) -> DataFrame:
    """``(codebook_id, layout)``: "files", "tables" or "series"; no row when it is none."""
    return _dictionary(lines).select("codebook_id", "layout").distinct()


def _dictionary(lines: DataFrame) -> DataFrame:
    """Data dictionary lines with the codebook's layout. All windows run per codebook, so the
    lines are shuffled once."""
    book = Window.partitionBy("codebook_id")
    body = with_sections(lines).filter(detect(F.col("section"), DICTIONARY)).drop("section")
    context = F.max(detect(F.col("line"), CONTEXT)).over(book)
    of_files = F.max(capture(F.col("line"), DATA_FILE)["data_file"] != "").over(book)
    layout = F.when(context & F.col("series"), "series").when(context, "tables").when(of_files, "files")
    return body.withColumn("layout", layout).drop("series").filter("layout is not null")


def textbook_variables(lines: DataFrame) -> DataFrame:
    """``(codebook_id, layout, data_file, pos, var_name, var_label, var_desc)`` of text codebooks.

    Context fields have an empty description, table fields get "table name (code)".
    """
    w = Window.partitionBy("codebook_id").orderBy("line_no")
    up_to = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    body = _dictionary(lines)
    line = F.col("line")
    is_table = detect(line, TABLE) & (F.col("layout") != "files")
    file_name = capture(line, DATA_FILE)["data_file"]
    body = body.select(
        "*",
        F.last(F.when((F.col("layout") == "files") & (file_name != ""), file_name), ignorenulls=True).over(up_to).alias("data_file"),
        F.sum(is_table.cast("int")).over(up_to).alias("table_no"),
        F.last(F.when(detect(line, CONTEXT), F.col("line_no")), ignorenulls=True).over(up_to).alias("ctx"),
        is_table.alias("is_table"),
        (file_name != "").alias("is_file"),
    )
    in_table = Window.partitionBy("codebook_id", "table_no").orderBy("line_no")
    # Context fields end at the first blank line after at least one field.
    blank = detect(line, BLANK) & F.col("ctx").isNotNull() & (F.col("line_no") > F.col("ctx") + 1)
    body = body.select(
        "*",
        F.row_number().over(in_table).alias("nth"),
        F.first(F.when(F.col("is_table"), line)).over(in_table).alias("title"),
        F.coalesce(F.sum(blank.cast("int")).over(up_to), F.lit(0)).alias("blanks"),
    )
    code = F.when(F.col("nth") == TABLE_HEADER_LINES, capture(line, TABLE_CODE)["code"])
    body = body.withColumn("code_line", F.max(code).over(Window.partitionBy("codebook_id", "table_no")))
    coded = capture(F.col("title"), TABLE_CODED)
    desc = F.when(F.col("layout") == "series", F.concat(coded["name"], F.lit(" ("), coded["code"], F.lit(")"))).when(
        F.col("layout") == "tables",
        F.concat(capture(F.col("title"), TABLE_NAME)["name"], F.lit(" ("), F.col("code_line"), F.lit(")")))
    in_context = (F.col("layout") != "files") & F.col("ctx").isNotNull() & (F.col("line_no") > F.col("ctx")) \
        & (F.col("table_no") == 0) & (F.col("blanks") == 0)
    in_tables = (F.col("layout") != "files") & (F.col("table_no") > 0) & F.when(
        F.col("layout") == "series", (F.col("nth") > 1) & ~detect(line, SERIES_HEADER)
    ).otherwise(F.col("nth") > TABLE_HEADER_LINES)
    in_file = (F.col("layout") == "files") & F.col("data_file").isNotNull() & ~F.col("is_file")
    found = capture(line, FIELD)
    return (
        body.select("codebook_id", "layout", "data_file", "line_no", found["var_name"].alias("var_name"),
                    found["var_label"].alias("var_label"), F.when(in_tables, desc).otherwise(F.lit("")).alias("var_desc"),
                    (in_context | in_tables | in_file).alias("__keep"))
        .filter("__keep and var_name != ''").drop("__keep")
        .withColumn("pos", F.row_number().over(w) - 1).drop("line_no")
    )


def textbook_terms(lines: DataFrame) -> DataFrame:
    """``(codebook_id, conditions)``: the citation and use section as one text."""
    return (
        with_sections(lines).filter(detect(F.col("section"), TERMS))
        .groupBy("codebook_id").agg(F.array_join(F.transform(
            F.sort_array(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("conditions"))
    )


def read_text_codebook(spark: SparkSession, path: str, data_layer: Selection = None,
                       line2_markers: dict[str, str] | None = None) -> Codebook:
    """One text codebook. Of several data files, ``data_layer`` picks the one to describe.

    ``path`` may be a zip archive or a folder; a text file whose name ends in "info.txt" is not
    the codebook, and of several others ``data_layer`` picks one. The layout is found from the structure of the data dictionary. ``line2_markers`` (text to
    project name) asks in addition that line 2 holds one of the texts, and names the project.
    """
    given = path
    if is_bundle(path):
        names = find_files(spark, path, "txt", multiple_ok=True)
        if len(names) > 1:
            names = [n for n in names if not n.endswith("info.txt")]
        layer = data_layer
        if len(names) > 1:
            names, layer = pick(names, data_layer), None
        if len(names) != 1:
            raise FileNotFoundError(f"expected one text codebook in {path}, found {len(names)}")
        given = names[0]
        path = unpack_text(spark, path, given) if file_ext(path) == ".zip" else f"{path.rstrip('/')}/{given}"
        data_layer = layer
    lines = read_lines(spark, path)
    project = None
    if line2_markers:
        second = lines.filter("line_no = 2").first()
        project = next((p for m, p in line2_markers.items() if second and m in second["line"]), None)
        if project is None:
            raise ValueError("not a known text codebook layout")
    layout = layouts(lines).first()
    if layout is None:
        raise ValueError("not a known text codebook layout")
    rows = textbook_variables(lines).orderBy("pos").collect()
    if layout["layout"] == "files":
        files = list(dict.fromkeys(r["data_file"] for r in rows))
        wanted = pick(files, data_layer)
        if len(wanted) > 1:
            raise ValueError("the codebook describes several data files; choose one with data_layer")
        rows = [r for r in rows if r["data_file"] in wanted]
    terms = textbook_terms(lines).first()
    return Codebook(
        variables=tuple(Variable(name=r["var_name"], label=r["var_label"], desc=r["var_desc"], var_type="") for r in rows),
        file_name=given.rsplit("/", 1)[-1], file_path=given.rsplit("/", 1)[0] if "/" in given else "",
        project=project, conditions=terms["conditions"] if terms else "",
    )


def codebook_path_for(data_file: str) -> str:
    """Where the codebook of an area CSV lies: ``x.csv`` has ``x_codebook.txt``."""
    return data_file[:-4] + "_codebook.txt" if data_file.endswith(".csv") else data_file


