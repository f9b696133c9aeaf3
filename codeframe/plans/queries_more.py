"""More registered queries: charsets, codebook tables and look-ups, labels in callbacks, listings, row numbers and pulls."""

from __future__ import annotations

import warnings

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..codebook import Codebook, Variable, label_table, val_labels, var_desc, var_info, var_label
from ..metadata import VarMeta, is_labelled, with_meta
from ..operators import joins, labels, models, tabulate
from ..sources import archive, area, carried, ddi, files, micro, sinks, textbook
from ..sources.scratch import scratch_path
from ..streaming import chunks
from ..streaming.lines import build_line_index
from . import extract as ex
from .queries import FLAG_LABELS, FLAG_SQL, HIER_VARS, STATUS_SQL, _hier_file, hier_book, persons, query, sizes, table

# ---------------------------------------------------------------- label sets of any length


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 320 = 7 THEN 'Part 7' WHEN p_partkey % 320 < 300 THEN 'Part ' || p_partkey % 320 END AS label,
           CASE WHEN p_partkey % 320 < 300 THEN p_partkey % 320 // 100 END AS group_code FROM part""")
def decode_duplicate_codes(spark, sf):
    """300 codes of which one stands twice: the first label counts and no row is repeated."""
    pairs = [(i, f"Part {i}") for i in range(300)]
    pairs.insert(9, (7, "Seven again"))
    df = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 320).alias("code"))
    df = with_meta(df, {"code": VarMeta("Code", None, tuple(pairs))})
    text = labels.as_factor(df, "code", levels="labels")
    group = labels.lbl_collapse(df, "code", "floor(val / 100)")
    return text.select("p_partkey", F.col("code").alias("label")).join(
        group.select("p_partkey", F.col("code").cast("bigint").alias("group_code")), "p_partkey")


@query("SELECT l_orderkey, l_linenumber, 'Order ' || l_orderkey AS label FROM lineitem")
def label_every_value(spark, sf):
    """More new labels than column metadata should hold: the same call keeps them as a table."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("label"))
    out = labels.lbl_add_vals(df, "label", lambda val: F.concat(F.lit("Order "), val.cast("string")))
    return labels.as_factor(out, "label")


@query(f"""
    SELECT l_returnflag AS code, {FLAG_SQL} AS label, n, true AS labelled, false AS labelled_after, 'Return flag' AS var_label, CAST(NULL AS VARCHAR) AS label_after
    FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)""")
def strip_labels(spark, sf):
    df = persons(spark, sf)
    bare, plain = labels.zap_labels(df, "l_returnflag"), labels.zap_attributes(df, "l_returnflag")
    counts = tabulate.weighted_frequency(bare, "l_returnflag", share=None).select(F.col("l_returnflag").alias("code"), "n")
    texts = label_table(df, ["l_returnflag"]).select(F.col("val").alias("code"), F.col("lbl").alias("label"))
    return counts.join(texts, "code").select(
        "code", "label", "n", F.lit(is_labelled(df, "l_returnflag")).alias("labelled"), F.lit(is_labelled(bare, "l_returnflag")).alias("labelled_after"),
        F.lit(var_label(bare, "l_returnflag")).alias("var_label"), F.lit(var_label(plain, "l_returnflag")).cast("string").alias("label_after"))


@query(f"SELECT {FLAG_SQL} AS label, 'What became of the line' AS about, count(*) AS n FROM lineitem GROUP BY 1")
def callback_labels(spark, sf):
    """A chunk function reads the labels and the description of a column from the table it gets."""
    import pandas as pd
    numbered = chunks.with_row_no(persons(spark, sf).select("l_returnflag"))

    def count(rows, pos):
        meta = rows.attrs["l_returnflag"]
        names = {p["val"]: p["lbl"] for p in meta["val_labels"]}
        n = rows["l_returnflag"].map(names).value_counts()
        return pd.DataFrame({"label": n.index, "about": meta["var_desc"], "n": n.to_numpy()})

    return chunks.chunk_map(numbered, count, "label string, about string, n bigint").groupBy("label", "about").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- row numbers and pulls

@query("SELECT row_number() OVER () AS row_no, l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def row_numbers(spark, sf):
    return chunks.with_row_no(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice"))


@query("""
    WITH n AS (SELECT row_number() OVER () AS row_no, o_orderkey, o_totalprice FROM orders)
    SELECT 1 AS pull, o_orderkey, o_totalprice FROM n WHERE row_no <= 700
    UNION ALL SELECT 2, o_orderkey, o_totalprice FROM n WHERE row_no BETWEEN 701 AND 1100
    UNION ALL SELECT 3, o_orderkey, o_totalprice FROM n WHERE row_no <= 50""")
def pull_rows(spark, sf):
    """Three pulls, the third after a reset; the rows themselves."""
    reader = chunks.RowReader(chunks.with_row_no(table(spark, sf, "orders").select("o_orderkey", "o_totalprice")))
    first, second = reader.pull(700), reader.pull(400)
    reader.reset()
    third = reader.pull(50)
    return first.select(F.lit(1).alias("pull"), "*").unionByName(second.select(F.lit(2).alias("pull"), "*")).unionByName(
        third.select(F.lit(3).alias("pull"), "*"))


@query("""
    SELECT 'HOUSEHOLD' AS record_type, count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS done FROM orders
    UNION ALL SELECT 'PERSON', count(*), round(sum(l_quantity), 2), true FROM lineitem""")
def pull_record_types(spark, sf):
    """All pulls of a file with two record types, a table of each type at a time."""
    reader = chunks.read_micro_list_pulled(spark, _hier_file(spark, sf, "hier"), vars=["PRICE", "QTY"])
    size = max(chunks.CHUNK_SIZE, -(-reader.total // 6))
    out = None
    reader.pull(size)
    reader.reset()  # from the start again
    while (part := reader.pull(size)) is not None:
        both = [part[t].agg(F.lit(t).alias("record_type"), F.count("*").alias("n"), F.sum(c).alias("total"))
                for t, c in (("HOUSEHOLD", "PRICE"), ("PERSON", "QTY"))]
        for p in both:
            out = p if out is None else out.unionByName(p)
    return out.groupBy("record_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total")).withColumn("done", F.lit(reader.is_done()))


# ---------------------------------------------------------------- charsets and odd fields

_ACCENTS = {"ISO-8859-1": "é ß ñ ÿ", "WINDOWS-1252": "é … € Œ", "UTF-8": "é ł 漢 😀"}


@query("""
    SELECT e.charset, p_partkey AS id, p_name || ' ' || e.accents AS name, p_type || ' ' || e.accents AS kind, p_size AS size
    FROM part, (VALUES ('ISO-8859-1', 'é ß ñ ÿ'), ('WINDOWS-1252', 'é … € Œ'), ('UTF-8', 'é ł 漢 😀')) AS e(charset, accents)""")
def charset_fields(spark, sf):
    """The same lines in three charsets, with accents before later fields and fields far behind the start of the line."""
    widths = (("id", 10, "integer"), ("name", 70, "character"), ("kind", 50, "character"), ("size", 4, "integer"))
    out = None
    for charset, accents in _ACCENTS.items():
        if charset == "WINDOWS-1252":  # written as Latin-1 characters with the same bytes
            accents = accents.encode("cp1252").decode("latin-1")
        p = table(spark, sf, "part")
        text = [F.lpad(F.col("p_partkey").cast("string"), 10, " "), F.rpad(F.concat("p_name", F.lit(" " + accents)), 70, " "),
                F.rpad(F.concat("p_type", F.lit(" " + accents)), 50, " "), F.lpad(F.col("p_size").cast("string"), 4, " ")]
        path = scratch_path(spark, "charset")
        lines = p.select(F.concat(*text).alias("value"))
        (lines.write.option("encoding", "UTF-8" if charset == "UTF-8" else "ISO-8859-1").option("quote", "\u0000").option("sep", "\u0001").option("escape", "\u0000")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
        variables, at = [], 1
        for name, width, kind in widths:
            variables.append(Variable(name, start=at, end=at + width - 1, var_type=kind))
            at += width
        base, name = path.rsplit("/", 1)
        book = Codebook(variables=tuple(variables), file_name=name, file_path=base, file_type="rectangular", file_encoding=charset)
        part = micro.read_micro(spark, book).select(F.lit(charset).alias("charset"), F.col("id").cast("bigint").alias("id"), "name", "kind", "size")
        out = part if out is None else out.unionByName(part)
    return out


@query("""
    SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN p_retailprice WHEN 5 THEN p_size END AS number FROM part""")
def odd_numbers(spark, sf):
    """Fields such as 12D, NaN, 0x1p3 and blanks are missing; plain numbers are read."""
    p = table(spark, sf, "part")
    k, size = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    text = (F.when(k == 0, F.col("p_retailprice").cast("string")).when(k == 1, F.concat(size, F.lit("D"))).when(k == 2, F.lit("NaN"))
            .when(k == 3, F.lit("")).when(k == 4, F.lit("0x1p3")).otherwise(size))
    path = scratch_path(spark, "odd")
    p.select(F.concat(F.lpad(F.col("p_partkey").cast("string"), 10, " "), F.lpad(text, 14, " ")).alias("value")).write.text(path)
    base, name = path.rsplit("/", 1)
    book = Codebook(variables=(Variable("id", start=1, end=10, var_type="numeric"), Variable("number", start=11, end=24, var_type="numeric")),
                    file_name=name, file_path=base, file_type="rectangular", file_encoding="US-ASCII")
    return micro.read_micro(spark, book).select(F.col("id").cast("bigint").alias("id"), "number")


@query("""
    SELECT 'A' || CAST(c_custkey AS VARCHAR) AS code, c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), s_name, s_acctbal FROM supplier""")
def second_headers(spark, sf):
    """Two sets of files of one folder whose second header rows differ: each file loses its own."""
    path = scratch_path(spark, "heads") + ".csv"
    c = table(spark, sf, "customer").select(F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("code"), F.col("c_name").alias("name"),
                                            F.col("c_acctbal").cast("string").alias("balance"))
    s = table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("code"), F.col("s_name").alias("name"),
                                            F.col("s_acctbal").cast("string").alias("balance"))
    for i, (df, about) in enumerate(((c, "Customer"), (s, "Supplier"))):
        names = df.columns

        def with_head(batches, about=about, names=names):
            import pandas as pd
            yield pd.DataFrame([[f"{about} code", f"{about} name", f"{about} balance"]], columns=names)
            yield from batches

        df.mapInPandas(with_head, df.schema).write.mode("append" if i else "errorifexists").option("header", True).csv(path)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return area.read_area_table(spark, path)


@query("""
    SELECT c_custkey AS code, c_name || ' é 漢' AS name, c_acctbal AS balance, 'Kundenname' AS name_label, 'Terms é' AS terms FROM customer""")
def area_utf8(spark, sf):
    """A UTF-8 area file described by two codebooks: terms from one, variables from the other."""
    path = scratch_path(spark, "utf8") + ".csv"
    table(spark, sf, "customer").select(F.col("c_custkey").alias("code"), F.concat("c_name", F.lit(" é 漢")).alias("name"),
                                        F.col("c_acctbal").alias("balance")).write.option("header", True).csv(path)
    terms = Codebook(conditions="Terms é", variables=(Variable("name", "Other label"),))
    variables = Codebook(project="Areas", variables=(Variable("name", "Kundenname"), Variable("balance", "Balance")))
    df, book = area.read_area_utf8(spark, path, ddi=terms, codebook=variables)
    return df.select(F.col("code").cast("bigint").alias("code"), "name", "balance", F.lit(var_label(df, "name")).alias("name_label"),
                     F.lit(book.conditions).alias("terms"))


# ---------------------------------------------------------------- codebooks

def _xml_of_parts(spark: SparkSession, sf: str) -> str:
    """A folder of codebooks, written by tasks: one for each block of part keys, with a variable for each part, record types from order states, study data from the table's own names."""
    p = table(spark, sf, "part")
    states = table(spark, sf, "orders").select("o_orderstatus").distinct()
    groups = states.select(F.concat(F.lit('<recGrp recidvar="RECTYPE" rectype="'), "o_orderstatus", F.lit('" keyvar="SERIAL YEAR"><labl>Status '),
                                    "o_orderstatus", F.lit("</labl></recGrp>")).alias("g")).agg(F.concat_ws("", F.sort_array(F.collect_list("g"))).alias("g"))
    head = groups.select(F.concat(
        F.lit("<stdyDscr><citation><prodStmt><prodDate date=\"2020-02-03\"/></prodStmt><serStmt><serName>Parts</serName></serStmt></citation>"
              "<dataAccs><useStmt><conditions>Use it</conditions><citReq>Cite it</citReq></useStmt></dataAccs><notes>First</notes><notes>Second</notes></stdyDscr>"
              "<fileDscr><fileTxt><fileName>parts.dat</fileName><fileStrc type=\"hierarchical\">"), "g",
        F.lit('</fileStrc><fileType charset="UTF-8"/></fileTxt></fileDscr>'
              '<var name="RECTYPE" dcml="0" intrvl="discrete" rectype="F O P"><location StartPos="1" EndPos="1" width="1"/><labl>Type</labl>'
              '<varFormat type="character"/></var>')).alias("value"))
    size = F.col("p_size").cast("string")
    var = F.concat(
        F.lit('<var name="P'), F.col("p_partkey").cast("string"), F.lit('" dcml="'), (F.col("p_size") % 3).cast("string"), F.lit('" intrvl="'),
        F.when(F.col("p_size") % 2 == 0, "contin").otherwise("discrete"), F.lit('" rectype="'), F.when(F.col("p_size") % 4 == 0, "F O").otherwise("P"),
        F.lit('"><location StartPos="2" EndPos="'), (F.col("p_size") + 1).cast("string"), F.lit('" width="'), size, F.lit('"/><labl>'), "p_name",
        F.lit("</labl><txt>"), "p_type", F.lit('</txt><varFormat type="'), F.when(F.col("p_size") % 5 == 0, "character").otherwise("numeric"), F.lit('"/></var>'))
    path = scratch_path(spark, "xml")
    book = F.expr("p_partkey div 200").alias("book")
    body = p.select(book, (F.col("p_partkey") + 2).alias("k"), var.alias("value"))
    books = p.select(book).distinct()
    ends = books.select("book", F.explode(F.map_from_arrays(F.array(F.lit(0).cast("bigint"), F.lit(1 << 60)), F.array(F.lit("<codeBook>"), F.lit("</codeBook>")))).alias("k", "value"))
    # the file description is one row
    heads = books.withColumn("k", F.lit(1).cast("bigint")).join(F.broadcast(head.withColumn("k", F.lit(1).cast("bigint"))), "k").select("book", "k", "value")
    every = body.unionByName(ends).unionByName(heads)
    every.repartition("book").sortWithinPartitions("book", "k").drop("k").write.partitionBy("book").text(path)
    return f"{path}/book=*"


@query("""
    SELECT 'p' || p_partkey AS var_name, p_name AS var_label, p_type AS var_desc, 2 AS "start", p_size + 1 AS "end", p_size % 3 AS imp_decim,
           CASE WHEN p_size % 5 = 0 THEN 'character' WHEN p_size % 2 = 1 AND p_size < 10 THEN 'integer' ELSE 'numeric' END AS var_type,
           CASE WHEN p_size % 4 = 0 THEN 'F O' ELSE 'P' END AS rectypes FROM part
    UNION ALL SELECT 'rectype', 'Type', NULL, 1, 1, 0, 'character', 'F O P'""")
def codebook_variable_rows(spark, sf):
    """The variables of a folder of codebooks, with lower-case names; those that several codebooks describe alike stand once."""
    rows = ddi.read_codebook_tables(spark, _xml_of_parts(spark, sf), lower_vars=True).variables
    return rows.select("var_name", "var_label", "var_desc", "start", "end", "imp_decim", "var_type", F.array_join("rectypes", " ").alias("rectypes")).distinct()


@query("""
    SELECT DISTINCT o_orderstatus AS rectype, 'Status ' || o_orderstatus AS label, 'serial year' AS keyvars, 'rectype' AS idvar, 'Status ' || o_orderstatus AS id_label FROM orders""")
def codebook_record_types(spark, sf):
    """Record types, their key variables, and the labels that the record-type id takes from them."""
    tables = ddi.read_codebook_tables(spark, _xml_of_parts(spark, sf), lower_vars=True)
    ids = tables.value_labels.filter("var_name = 'rectype'").select("codebook_id", F.col("val").alias("rectype"), F.col("lbl").alias("id_label"))
    idvar = tables.file_info.select("codebook_id", F.col("rectype_idvar").alias("idvar"))
    return tables.record_types.join(ids, ["codebook_id", "rectype"]).join(idvar, "codebook_id").select(
        "rectype", "label", F.array_join("keyvars", " ").alias("keyvars"), "idvar", "id_label").distinct()


@query("""
    SELECT 'Parts' AS project, '2020-02-03' AS extract_date, 'First' || chr(10) || chr(10) || 'Second' AS extract_notes, 'parts.dat' AS file_name, 'UTF-8' AS file_encoding,
           'Use it' || chr(10) || chr(10) || 'Cite it' || chr(10) || chr(10) AS terms, count(*) + 1 AS variables FROM part""")
def codebook_file_terms(spark, sf):
    """File-level information of a folder of codebooks and their conditions of use, with the number of variables that those of the same information describe."""
    tables = ddi.read_codebook_tables(spark, _xml_of_parts(spark, sf))
    info = tables.file_info.join(tables.terms(), "codebook_id").withColumn("extract_date", F.col("extract_date").cast("string"))
    described = tables.variables.select("codebook_id", "var_name").join(info, "codebook_id")
    return described.groupBy("project", "extract_date", "extract_notes", "file_name", "file_encoding", "terms").agg(F.count_distinct("var_name").alias("variables"))


@query(f"""
    SELECT 'l_returnflag' AS var_name, 'Return flag' AS var_label, 'What became of the line' AS var_desc, l_returnflag AS val, {FLAG_SQL} AS lbl, count(*) AS n
    FROM lineitem GROUP BY l_returnflag""")
def variable_lookups(spark, sf):
    """The variable table of a labelled table, its label sets opened, and the single look-ups beside it."""
    df = persons(spark, sf)
    info = var_info(df, ["l_returnflag"], spark)
    rows = info.select("var_name", "var_label", F.explode("val_labels").alias("p")).select("var_name", "var_label", "p.val", "p.lbl")
    assert [tuple(p) for p in val_labels(df, "l_returnflag")] == list(FLAG_LABELS)
    rows = rows.withColumn("var_desc", F.lit(var_desc(df, "l_returnflag")))
    counts = tabulate.value_counts(table(spark, sf, "lineitem"), "l_returnflag").withColumnRenamed("l_returnflag", "val")
    return rows.join(counts, "val").select("var_name", "var_label", "var_desc", "val", "lbl", "n")


@query("""
    SELECT 'parts.csv' AS data_file, 'F' || p_partkey AS var_name, p_name AS var_label, 'files' AS layout FROM part""")
def codebook_text_files(spark, sf):
    """Text codebooks that list the columns of data files, one for each block of part keys."""
    book = F.expr("p_partkey div 200").cast("string").alias("codebook_id")
    p = table(spark, sf, "part")
    lines = p.select(book, (F.col("p_partkey") + 100).alias("line_no"), F.concat(F.lit("    F"), F.col("p_partkey").cast("string"), F.lit(":   "), "p_name").alias("line"))
    dashes = "-" * 20
    texts = F.array(*map(F.lit, ["Codebook", "Area data", dashes, "Data Dictionary", dashes, "Data File: parts.csv", ""]))
    head = p.select(book).distinct().select("codebook_id", F.posexplode(texts).alias("at", "line")).select("codebook_id", (F.col("at") + 1).cast("bigint").alias("line_no"), "line")
    rows = textbook.textbook_variables(head.unionByName(lines))
    return rows.select("data_file", "var_name", "var_label", "layout")


@query("""
    SELECT p_partkey AS id, p_name || 'x' AS val, 'Label ' || p_size AS lbl FROM part WHERE p_name NOT LIKE '% %'
    UNION ALL SELECT p_partkey, replace(p_name, ' ', '-') || 'x', 'Label ' || p_size FROM part WHERE p_name LIKE '% %'""")
def codebook_text_code_labels(spark, sf):
    """"code = label" lines of instructions for text codes."""
    p = table(spark, sf, "part")
    code = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), F.lit("x"))
    notes = p.select(F.col("p_partkey").alias("id"), F.concat(F.lit("Codes\n"), code, F.lit(" = Label "), F.col("p_size").cast("string")).alias("instr"))
    return ddi.labels_from_instructions(notes, "instr", F.lit(False)).select("id", "val", "lbl")


# ---------------------------------------------------------------- listings, checks, collections

def _archives(spark, sf, tag):
    """A folder of archives, written by tasks: parts by size, each archive with data, boundary, raster and other members."""
    p = table(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    ending = F.element_at(F.array(*map(F.lit, (".csv", "_shape.zip", ".tiff", ".txt"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    member = F.concat(F.lit("p"), key, ending)
    folder = scratch_path(spark, tag)
    archive.write_archives(p.select(F.concat(F.lit("size"), F.col("p_size").cast("string"), F.lit(".zip")).alias("bundle"), member.alias("file"), key.alias("content")), folder)
    return folder


@query("""
    SELECT 'size' || p_size || '.zip' AS bundle, CASE p_partkey % 4 WHEN 0 THEN 'data' WHEN 1 THEN 'shape' WHEN 2 THEN 'raster' END AS type,
           'p' || p_partkey || CASE p_partkey % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '_shape.zip' WHEN 2 THEN '.tiff' END AS file FROM part WHERE p_partkey % 4 < 3""")
def bundle_listing(spark, sf):
    """Members of many archives by type, from the archives' directories."""
    found = files.classify(files.archive_members(spark, _archives(spark, sf, "bundles")))
    return found.select(F.substring_index("bundle", "/", -1).alias("bundle"), "type", "file")


@query("""
    SELECT 'size' || p_size || '.zip' AS bundle, 'rows' || p_partkey // 200 || '.csv' AS file,
           row_number() OVER (PARTITION BY p_size, p_partkey // 200 ORDER BY p_partkey) AS line_no, p_partkey || ',' || p_name AS line FROM part""")
def archive_lines(spark, sf):
    """Lines of all members of every archive in a folder, each member read as a stream. A member holds 200 part keys at most."""
    p = table(spark, sf, "part")
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), "p_name")
    listed = F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line"))))
    members = p.groupBy(F.concat(F.lit("size"), F.col("p_size").cast("string"), F.lit(".zip")).alias("bundle"),
                        F.concat(F.lit("rows"), F.expr("p_partkey div 200").cast("string"), F.lit(".csv")).alias("file"))
    members = members.agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("content"))
    folder = scratch_path(spark, "archives")
    archive.write_archives(members, folder)
    return files.member_lines(spark, folder).select(F.substring_index("bundle", "/", -1).alias("bundle"), "file", "line_no", F.col("raw").cast("string").alias("line"))


def _refused(f, kind) -> bool:
    try:
        f()
    except kind:
        return True
    return False


@query("""
    SELECT 'missing key column' AS test, true AS refused, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'text labels on numbers', true, count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'unknown text codebook', true, count(*) FROM nation""")
def refusals(spark, sf):
    """Wrong key names, label types and codebook layouts are refused; the right forms beside them are not."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    joined = joins.inner_join(c, n, {"c_nationkey": "n_nationkey"}).df
    missing = _refused(lambda: joins.inner_join(c, n, {"c_nation": "n_nationkey"}), ValueError)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    wrong = _refused(lambda: labels.set_attributes(orders, [Variable("o_orderkey", val_labels=(("F", "Filled"),))]), TypeError)
    right = labels.set_attributes(orders, [Variable("o_orderstatus", val_labels=(("F", "Filled"),))])
    filled = labels.as_factor(right, "o_orderstatus", levels="labels").where("o_orderstatus = 'Filled'")
    path = scratch_path(spark, "nobook")
    n.select("n_name").coalesce(1).write.text(path)
    unknown = _refused(lambda: textbook.read_text_codebook(spark, f"{path}/*.txt"), ValueError)
    rows = [(joined, "missing key column", missing), (filled, "text labels on numbers", wrong), (n, "unknown text codebook", unknown)]
    parts = [df.agg(F.lit(t).alias("test"), F.lit(r).alias("refused"), F.count("*").alias("n")) for df, t, r in rows]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
    SELECT code, count(*) AS n FROM (SELECT (['usa', 'cps', 'ahtus', 'mtus', 'atus', 'dhs', 'highered', 'meps', 'nhis', 'pma', 'own'])[o_orderkey % 11 + 1] AS code FROM orders) GROUP BY 1""")
def collection_codes(spark, sf):
    """Collection codes, one added, joined to orders by position."""
    registry = {**ex.COLLECTIONS, "own": "A collection of one's own"}
    codes = ex.known_collections(registry)
    known = ex.collections(spark, registry)
    place = F.element_at(F.array(*map(F.lit, codes)), (F.col("o_orderkey") % 11 + 1).cast("int"))
    return table(spark, sf, "orders").select(place.alias("code")).join(known, "code").groupBy("code").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- models in full

@query("""
    WITH s AS (SELECT regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
                      regr_sxy(l_extendedprice, l_quantity) AS sxy, count(*) AS n, avg(l_quantity) AS mx FROM lineitem),
         r AS (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM s)
    SELECT '(Intercept)' AS term1, '(Intercept)' AS term2, round(s2 * (1.0 / n + mx * mx / sxx), 4) AS cov FROM r
    UNION ALL SELECT '(Intercept)', 'l_quantity', round(-s2 * mx / sxx, 4) FROM r
    UNION ALL SELECT 'l_quantity', '(Intercept)', round(-s2 * mx / sxx, 4) FROM r
    UNION ALL SELECT 'l_quantity', 'l_quantity', round(s2 / sxx, 4) FROM r""")
def ols_vcov(spark, sf):
    fit = models.linear_model(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])
    return fit.vcov_table(spark).withColumn("cov", F.round("cov", 4))


@query("""
    WITH g AS (SELECT l_linestatus = 'O' AS x, sum(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0 END) AS a,
                      sum(CASE WHEN l_discount > 0.05 THEN 0.0 ELSE 1 END) AS b FROM lineitem GROUP BY 1),
         f AS (SELECT * FROM g WHERE NOT x), o AS (SELECT * FROM g WHERE x)
    SELECT '(Intercept)' AS term, round(ln(f.a / f.b), 5) AS estimate, round(sqrt(1 / f.a + 1 / f.b), 5) AS std_error FROM f
    UNION ALL SELECT 'x', round(ln(o.a / o.b) - ln(f.a / f.b), 5), round(sqrt(1 / f.a + 1 / f.b + 1 / o.a + 1 / o.b), 5) FROM f, o""")
def logit_std_errors(spark, sf):
    df = table(spark, sf, "lineitem").select((F.col("l_discount") > 0.05).cast("double").alias("y"), (F.col("l_linestatus") == "O").cast("double").alias("x"))
    out = models.generalized_model(df, "y", ["x"], stage=True)
    return out.select("term", F.round("estimate", 5).alias("estimate"), F.round("std_error", 5).alias("std_error"))


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER () AS k FROM lineitem) WHERE k <= 5000""")
def first_lines_themselves(spark, sf):
    """The first 5,000 rows of a file, in its order."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return micro.first_rows(df, 5000, lambda paths: spark.read.schema(df.schema).parquet(*paths))


@query("SELECT p_partkey, p_size AS code FROM part")
def sizes_kept(spark, sf):
    """Label sets of 40 codes leave the data as they are when labels are stripped."""
    return labels.zap_labels(sizes(spark, sf)).select("p_partkey", F.col("p_size").alias("code"))


# ---------------------------------------------------------------- record types merged by line order

def _ordered_hier_file(spark, sf, tag):
    h = table(spark, sf, "orders").select(F.col("o_orderkey").alias("SERIAL"), F.col("o_orderstatus").alias("STATUS"), F.col("o_totalprice").alias("PRICE"))
    p = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("SERIAL"), F.col("l_linenumber").alias("LINE"),
                                            F.col("l_quantity").alias("QTY"), F.col("l_returnflag").alias("FLAG"))
    path = scratch_path(spark, tag)
    sinks.write_hierarchical(h, p, path, list(HIER_VARS), "RECTYPE", keys=["SERIAL"], order=["LINE", "QTY", "FLAG"])
    return hier_book(path)


@query("""
    SELECT CAST(l_orderkey AS DOUBLE) AS SERIAL, l_linenumber AS LINE, l_quantity AS QTY, l_returnflag AS FLAG,
           o_orderstatus AS STATUS, o_totalprice AS PRICE
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def rectangularize_by_line_order(spark, sf):
    """Household variables on person rows, carried down the file."""
    return carried.read_micro_rectangular(spark, _ordered_hier_file(spark, sf, "hier")).drop("RECTYPE")


@query(f"""
    WITH f AS (SELECT o_orderstatus, sum(o_totalprice) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1)
    SELECT {STATUS_SQL} AS "STATUS", round(n, 2) AS n, round(n / sum(n) OVER (), 9) AS share FROM f""")
def household_frequency_by_line_order(spark, sf):
    """Households by status, from the first person of each, as the file has them."""
    rows = carried.read_micro_rectangular(spark, _ordered_hier_file(spark, sf, "hier"), vars=["STATUS", "PRICE"], first="FIRST")
    out = tabulate.weighted_frequency(rows.where("FIRST"), "STATUS", "PRICE")
    return out.select("STATUS", F.round("n", 2).alias("n"), F.round("share", 9).alias("share"))


@query("""
    WITH n AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS row_no, o_orderkey, o_totalprice FROM orders), t AS (SELECT count(*) AS total FROM orders)
    SELECT 1 AS pull, o_orderkey, o_totalprice FROM n WHERE row_no <= 400
    UNION ALL SELECT 2, o_orderkey, o_totalprice FROM n, t WHERE row_no > total // 2 AND row_no <= total // 2 + 300
    UNION ALL SELECT 3, o_orderkey, o_totalprice FROM n, t WHERE row_no > total - 50""")
def pull_by_ranges(spark, sf):
    """Three pulls out of a fixed-width file by its line index: at its head, in its middle, at its end."""
    path = scratch_path(spark, "ordered")
    fields = (("o_orderkey", 12, 0), ("o_totalprice", 14, 2))
    layout, at = [], 1
    for name, width, decimals in fields:
        layout.append(Variable(name, start=at, end=at + width - 1, var_type="numeric", imp_decim=decimals))
        at += width
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice").repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
    fixed = sinks.write_fixed_width(rows, path, layout, "US-ASCII")
    index = build_line_index(spark, path, step=1000)
    reader = chunks.read_micro_pulled(spark, fixed, index=index)
    out = [reader.pull(400)]
    reader.seek(reader.total // 2)
    out.append(reader.pull(300))
    reader.seek(reader.total - 50)
    out.append(reader.pull(300))
    parts = [p.select(F.lit(i).alias("pull"), F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_totalprice") for i, p in enumerate(out, 1)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
    WITH c AS (SELECT l_extendedprice AS y, l_quantity AS a, CAST(l_linenumber AS DOUBLE) AS b FROM lineitem),
         s AS (SELECT covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS cy FROM c)
    SELECT 'both' AS part, round((ay * bb - cy * ab) / (aa * bb - ab * ab), 2) AS slope FROM s
    UNION ALL SELECT 'shift', round((cy * aa - ay * ab) / (aa * bb - ab * ab), 2) FROM s""")
def ols_collinear(spark, sf):
    """Quantity, and quantity moved by a ten-millionth of the line number: the slopes of 1e7 that the fit finds are those of a well-posed model, put differently."""
    df = table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity", (F.col("l_quantity") + F.col("l_linenumber") * 1e-7).alias("moved"))
    fit = models.linear_model(df, "l_extendedprice", ["l_quantity", "moved"])
    both, shift = float(fit.coef[1] + fit.coef[2]), float(fit.coef[2] * 1e-7)
    return spark.createDataFrame([("both", both), ("shift", shift)], "part string, slope double").withColumn("slope", F.round("slope", 2))
