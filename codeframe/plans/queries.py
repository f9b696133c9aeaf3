"""Registered queries: one or more per operator, over whole tables, each with its SQL twin.

Roles of the tables: ``orders`` are households, ``lineitem`` are persons with weight
``l_quantity``, ``part`` has coded columns, ``customer`` and ``supplier`` are area data,
``nation`` and ``region`` are boundaries, ``events`` arrive as a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..codebook import Codebook, Variable, first_by_name, label_table, sorted_labels
from ..functions import numbers, text
from ..metadata import VarMeta, lbl, q, with_meta
from ..operators import bind, joins, labels, models, recode, tabulate
from ..select import ends_with, matches, mutate_at, one_of, pick, select_rows, starts_with
from ..sources import area, boundary, ddi, files, micro, sinks, textbook
from ..sources.scratch import scratch_path
from ..streaming import chunks, running
from . import extract as ex

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


FLAG_LABELS = (("A", "Accepted"), ("N", "Not returned"), ("R", "Returned"))
FLAG_SQL = "CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'Not returned' WHEN 'R' THEN 'Returned' END"
STATUS_LABELS = (("F", "Filled"), ("O", "Open"), ("P", "Partly filled"))
STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partly filled' END"


def persons(spark, sf):
    return with_meta(table(spark, sf, "lineitem"), {
        "l_returnflag": VarMeta("Return flag", "What became of the line", FLAG_LABELS),
        "l_quantity": VarMeta("Person weight"),
    })


def households(spark, sf):
    return with_meta(table(spark, sf, "orders"), {"o_orderstatus": VarMeta("Status", None, STATUS_LABELS)})


def sizes(spark, sf, top: int = 40):
    """Parts whose size code is labelled up to ``top``; larger sizes have no label."""
    return with_meta(table(spark, sf, "part").select("p_partkey", "p_size"),
                     {"p_size": VarMeta("Size", None, tuple((i, f"Size {i}") for i in range(1, top + 1)))})


def decoded(df: DataFrame, levels: str = "labels") -> DataFrame:
    """(p_partkey, code, label)"""
    return labels.as_factor(df, "p_size", levels=levels, keep_codes=True).select(
        "p_partkey", F.col("p_size_code").alias("code"), F.col("p_size").alias("label"))


# ---------------------------------------------------------------- tabulations

@query(f"""
    SELECT {FLAG_SQL} AS l_returnflag, sum(l_quantity) AS n,
           sum(l_quantity) / sum(sum(l_quantity)) OVER () AS share
    FROM lineitem GROUP BY l_returnflag""")
def weighted_frequency(spark, sf):
    return tabulate.weighted_frequency(persons(spark, sf), "l_returnflag", "l_quantity")


@query("""
    SELECT CASE WHEN l_returnflag IN ('A', 'R') THEN 'Came back' ELSE 'Stayed' END AS l_returnflag, count(*) AS n
    FROM lineitem GROUP BY 1""")
def frequency_shared_label(spark, sf):
    df = with_meta(table(spark, sf, "lineitem"), {
        "l_returnflag": VarMeta(None, None, (("A", "Came back"), ("N", "Stayed"), ("R", "Came back")))})
    return tabulate.weighted_frequency(df, "l_returnflag", share=None)


@query(f"""
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey,
                   l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem),
         f AS (SELECT o_orderstatus, sum(o_totalprice) AS n FROM p JOIN orders ON l_orderkey = o_orderkey
               WHERE rn = 1 GROUP BY 1)
    SELECT {STATUS_SQL} AS o_orderstatus, round(n, 2) AS n, round(n / sum(n) OVER (), 9) AS share FROM f""")
def household_frequency(spark, sf):
    # the first person is picked before the join, which then reuses the shuffle by household
    p = tabulate.first_per_group(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", ["l_linenumber"])
    h = households(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_totalprice")
    out = tabulate.weighted_frequency(joins.rectangularize(p, h, ["l_orderkey"]), "o_orderstatus", "o_totalprice")
    return out.select("o_orderstatus", F.round("n", 2).alias("n"), F.round("share", 9).alias("share"))


@query(f"""
    WITH f AS (SELECT l_returnflag, sum(l_quantity) AS n FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_returnflag) AS rn
        FROM lineitem) WHERE rn = 1 GROUP BY 1)
    SELECT {FLAG_SQL} AS l_returnflag, n, n / sum(n) OVER () AS share FROM f""")
def household_frequency_of_persons(spark, sf):
    return tabulate.household_frequency(persons(spark, sf), "l_orderkey", "l_returnflag", "l_quantity",
                                        order=["l_linenumber", "l_partkey", "l_quantity", "l_returnflag"])


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)
            AS rn FROM lineitem) WHERE rn = 1""")
def first_person_per_household(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return tabulate.first_per_group(df, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]).drop("l_suppkey")


@query(f"""
    SELECT {FLAG_SQL} AS l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS mean
    FROM lineitem GROUP BY l_returnflag""")
def weighted_mean_by_label(spark, sf):
    out = tabulate.weighted_mean(persons(spark, sf), "l_extendedprice", "l_quantity", "l_returnflag")
    return out.withColumn("mean", F.round("mean", 4))


@query(f"""
    SELECT {FLAG_SQL} AS l_returnflag,
           round(sum(CASE WHEN l_discount > 0.05 THEN l_quantity ELSE 0 END) / sum(l_quantity), 9) AS pct
    FROM lineitem WHERE l_linenumber >= 2 GROUP BY l_returnflag""")
def weighted_share_in_universe(spark, sf):
    universe = persons(spark, sf).filter("l_linenumber >= 2")
    out = tabulate.weighted_mean(universe, F.col("l_discount") > 0.05, "l_quantity", "l_returnflag", name="pct")
    return out.withColumn("pct", F.round("pct", 9))


@query("""
    WITH x AS (SELECT l_linestatus, l_quantity AS w,
                      CASE WHEN l_linestatus = 'F' OR l_discount > 0.02 THEN l_extendedprice END AS v FROM lineitem)
    SELECT l_linestatus,
           CASE WHEN count(v) = count(*) THEN round(sum(v * w) / sum(w), 4) END AS strict_mean,
           round(sum(v * w) / sum(CASE WHEN v IS NOT NULL THEN w END), 4) AS known_mean
    FROM x GROUP BY 1""")
def weighted_mean_missing(spark, sf):
    df = table(spark, sf, "lineitem").withColumn(
        "v", F.when((F.col("l_linestatus") == "F") | (F.col("l_discount") > 0.02), F.col("l_extendedprice")))
    return df.groupBy("l_linestatus").agg(
        F.round(tabulate.weighted_mean_expr(F.col("v"), F.col("l_quantity")), 4).alias("strict_mean"),
        F.round(tabulate.weighted_mean_expr(F.col("v"), F.col("l_quantity"), skip_null=True), 4).alias("known_mean"))


@query(f"SELECT {FLAG_SQL} AS l_returnflag, l_discount >= 0.05 AS flag, count(*) AS n FROM lineitem GROUP BY l_returnflag, 2")
def two_way_table(spark, sf):
    return tabulate.two_way_table(persons(spark, sf), "l_returnflag", F.col("l_discount") >= 0.05)


@query("""
    SELECT l_suppkey, round(avg(CASE WHEN l_tax = 0 THEN NULL WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END), 9) AS share
    FROM lineitem GROUP BY 1""")
def share_of_condition(spark, sf):
    cond = F.when(F.col("l_tax") != 0, F.col("l_discount") > 0.05)
    return tabulate.share_of(table(spark, sf, "lineitem"), cond, "l_suppkey").withColumn("share", F.round("share", 9))


@query("""
    WITH b AS (SELECT CASE WHEN p_size >= 1 AND p_size <= 10 THEN '1-10' WHEN p_size > 10 AND p_size <= 20 THEN '11-20'
                      WHEN p_size > 20 AND p_size <= 35 THEN '21-35' WHEN p_size > 35 AND p_size <= 50 THEN '36+' END AS size_bin,
               p_retailprice, p_size FROM part)
    SELECT size_bin, count(*) AS n, round(sum(p_retailprice * p_size) / sum(p_size), 4) AS mean_price FROM b GROUP BY 1""")
def age_bins(spark, sf):
    size_bin = recode.cut(F.col("p_size"), [1, 10, 20, 35, 50], ["1-10", "11-20", "21-35", "36+"], include_lowest=True)
    return table(spark, sf, "part").groupBy(size_bin.alias("size_bin")).agg(
        F.count("*").alias("n"),
        F.round(tabulate.weighted_mean_expr(F.col("p_retailprice"), F.col("p_size")), 4).alias("mean_price"))


@query("""
    SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1 ORDER BY sum(o_totalprice) DESC, 1 LIMIT 5""")
def top5(spark, sf):
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    return tabulate.top_k(totals, 5, "total", ["o_custkey"])


@query("""
    WITH s AS (SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity) AS pct
               FROM lineitem GROUP BY 1)
    SELECT l_suppkey, round(pct, 9) AS pct FROM s
    WHERE pct = (SELECT min(pct) FROM s) OR pct = (SELECT max(pct) FROM s)""")
def min_max_rows(spark, sf):
    s = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(numbers.ratio(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)), F.sum("l_quantity")).alias("pct"))
    return tabulate.rows_at_extremes(s, "pct").withColumn("pct", F.round("pct", 9))


@query("SELECT nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority, count(*) AS n FROM orders GROUP BY 1")
def value_counts_with_null(spark, sf):
    df = table(spark, sf, "orders").select(recode.null_if(F.col("o_orderpriority"), ["4-NOT SPECIFIED"]).alias("priority"))
    return tabulate.value_counts(df, "priority")


@query("SELECT count(DISTINCT l_partkey) AS n_distinct FROM lineitem")
def distinct_count(spark, sf):
    return tabulate.distinct_count(table(spark, sf, "lineitem"), "l_partkey")


@query("""
    WITH x AS (SELECT c_nationkey AS area, CASE WHEN c_acctbal >= 5000 THEN 'High' ELSE 'Low' END AS grp,
                      CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END AS v, c_acctbal + 1000 AS w,
                      c_name, c_custkey FROM customer)
    SELECT area, grp, round(sum(v * w) / sum(w), 9) AS building, arg_min(c_name, c_custkey) AS first_name FROM x GROUP BY 1, 2""")
def area_summary(spark, sf):
    c = table(spark, sf, "customer")
    out = tabulate.area_summary(
        c, {"area": F.col("c_nationkey"), "grp": F.when(F.col("c_acctbal") >= 5000, "High").otherwise("Low")},
        {"building": (F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1000)},
        {"first_name": F.col("c_name")}, order=F.col("c_custkey"))
    return out.withColumn("building", F.round("building", 9))


# ---------------------------------------------------------------- label algebra

@query("""
    SELECT p_partkey, CASE WHEN p_size <= 40 AND (p_size >= 30 OR p_size = 7) THEN NULL ELSE p_size END AS code,
           CASE WHEN p_size < 30 AND p_size <> 7 THEN 'Size ' || p_size END AS label FROM part""")
def lbl_na_if(spark, sf):
    return decoded(labels.lbl_na_if(sizes(spark, sf), "p_size", lambda val, lbl: (val >= 30) | (lbl == "Size 7")))


@query("""
    SELECT p_partkey, CASE WHEN p_size <= 40 THEN CAST(floor(p_size / 10) * 10 AS INTEGER) END AS code,
           CASE WHEN p_size < 10 THEN 'Size 1' WHEN p_size <= 40 THEN 'Size ' || CAST(floor(p_size / 10) * 10 AS INTEGER) END AS label
    FROM part""")
def lbl_collapse(spark, sf):
    return decoded(labels.lbl_collapse(sizes(spark, sf), "p_size", "floor(val / 10) * 10"))


@query("""
    WITH n AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN NULL WHEN p_size = 1 THEN 2 WHEN p_size = 2 THEN 1
                      WHEN p_size >= 20 AND p_size < 30 THEN 90 WHEN p_size = 5 THEN 6 ELSE p_size END AS code FROM part)
    SELECT p_partkey, code, CASE code WHEN 2 THEN 'Size 1' WHEN 1 THEN 'Size 2' WHEN 90 THEN 'Twenties' ELSE 'Size ' || code END AS label
    FROM n""")
def lbl_relabel(spark, sf):
    return decoded(labels.lbl_relabel(
        sizes(spark, sf), "p_size",
        (lbl(1, "Size 2"), lambda val, lbl: val == 2), (lbl(2, "Size 1"), lambda val, lbl: val == 1),
        (lbl(90, "Twenties"), "val between 20 and 29"), (6, "lbl = 'Size 5'")))


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN -2 WHEN c_acctbal < 1000 THEN -1 ELSE c_acctbal END AS code,
           CASE WHEN c_acctbal < 0 THEN 'Debt' WHEN c_acctbal < 1000 THEN 'Low' END AS label FROM customer""")
def lbl_define(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    out = labels.lbl_define(df, "c_acctbal", (lbl(-1, "Low"), lambda val, _: val < 1000), (lbl(-2, "Debt"), "val < 0"))
    return labels.as_factor(out, "c_acctbal", levels="labels", keep_codes=True).select(
        "c_custkey", F.col("c_acctbal_code").alias("code"), F.col("c_acctbal").alias("label"))


@query("""
    SELECT p_partkey, p_size AS code, CASE WHEN p_size <= 40 THEN 'Size ' || p_size WHEN p_size = 50 THEN 'Largest' END AS label
    FROM part""")
def lbl_add(spark, sf):
    return decoded(labels.lbl_add(sizes(spark, sf), "p_size", lbl(50, "Largest"), lbl(99, "Unknown")))


@query("""
    SELECT p_partkey, p_size AS code, CASE WHEN p_size <= 40 THEN 'Size ' || p_size ELSE '$' || p_size END AS label FROM part""")
def lbl_add_vals(spark, sf):
    return decoded(labels.lbl_add_vals(sizes(spark, sf), "p_size", lambda val: F.concat(F.lit("$"), val.cast("string"))))


@query("SELECT DISTINCT p_size AS val, 'Size ' || p_size AS lbl FROM part WHERE p_size <= 80")
def lbl_clean(spark, sf):
    out = labels.lbl_clean(sizes(spark, sf, top=80), "p_size")
    return label_table(out, ["p_size"]).select(F.col("val_num").cast("int").alias("val"), "lbl")


@query("""
    SELECT p_partkey, CASE WHEN p_size <= 40 THEN 'Size ' || p_size ELSE CAST(p_size AS VARCHAR) END AS by_default,
           CASE WHEN p_size <= 40 THEN '[' || p_size || '] Size ' || p_size ELSE CAST(p_size AS VARCHAR) END AS both,
           CAST(p_size AS VARCHAR) AS vals, CASE WHEN p_size <= 40 THEN 'Size ' || p_size END AS lbls FROM part""")
def as_factor_levels(spark, sf):
    df = sizes(spark, sf)
    return df.select("p_partkey", labels.label_expr(df, "p_size").alias("by_default"),
                     labels.label_expr(df, "p_size", "both").alias("both"),
                     labels.label_expr(df, "p_size", "values").alias("vals"),
                     labels.label_expr(df, "p_size", "labels").alias("lbls"))


@query("""
    SELECT coalesce(p_name, CAST(l_partkey AS VARCHAR)) AS label, count(*) AS n
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def decode_large_code_list(spark, sf):
    names = table(spark, sf, "part").select(F.col("p_partkey").alias("val"), F.col("p_name").alias("lbl"))
    counts = tabulate.value_counts(table(spark, sf, "lineitem"), "l_partkey")
    out = labels.decode_with_table(counts, "l_partkey", names, out="label")
    return out.groupBy("label").agg(F.sum("n").alias("n"))


@query("""
    SELECT p_size AS val, p_name AS lbl FROM (
        SELECT p_size, p_name, row_number() OVER (PARTITION BY p_size ORDER BY length(p_name) DESC, p_partkey) AS rn FROM part)
    WHERE rn = 1""")
def label_set_dedupe(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_size").alias("val"), F.col("p_name").alias("lbl"), F.col("p_partkey").alias("pos"))
    return labels.longest_labels(rows, ["val"], ["pos"]).drop("pos")


@query("""
    SELECT DISTINCT p_brand AS val, p_type AS lbl FROM part
    WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1)""")
def duplicate_label_report(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_brand").alias("val"), F.col("p_type").alias("lbl"))
    return labels.duplicate_labels(rows, ["val"])


# ---------------------------------------------------------------- selection, recodes, functions

@query("""
    SELECT l_orderkey, l_discount * 100 AS l_discount, l_tax * 100 AS l_tax FROM lineitem""")
def apply_to_many_columns(spark, sf):
    df = table(spark, sf, "lineitem")
    df = df.select(*[q(c) for c in pick(df.columns, ["l_orderkey", one_of("l_discount", "l_tax", "l_none")])])
    return mutate_at(df, [ends_with("_DISCOUNT"), starts_with("l_t")], lambda c: c * 100)


@query("""
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'first' WHEN o_totalprice > 200000 THEN 'large'
           ELSE 'other' END AS cls, nullif(o_orderstatus, 'P') AS status,
           o_orderpriority IN ('5-LOW') AS low FROM orders WHERE o_orderstatus IN ('O', 'P')""")
def conditional_recode(spark, sf):
    o = recode.select_cases(table(spark, sf, "orders"), "o_orderstatus", ["O", "P"])
    pr = F.col("o_orderpriority")
    return o.select(
        "o_orderkey",
        recode.case_when((pr.isin("1-URGENT", "2-HIGH"), "first"), (F.col("o_totalprice") > 200000, "large"),
                         otherwise="other").alias("cls"),
        recode.null_if(F.col("o_orderstatus"), ["P"]).alias("status"), numbers.is_in(pr, ["5-LOW"]).alias("low"))


@query("""
    SELECT c_custkey, regexp_replace(c_name, '0', 'x') AS first_zero, regexp_replace(c_name, '0+', '-', 'g') AS zeros,
           c_name[-4:-2] AS tail, regexp_extract(c_name, '^([A-Z][a-z]+)#0*([0-9]+)$', 1) AS word,
           regexp_extract(c_name, '^([A-Z][a-z]+)#0*([0-9]+)$', 2) AS digits, NOT regexp_matches(c_name, '7') AS no_seven,
           upper(c_mktsegment) || '/' || lower(c_name) AS pasted, len(string_split(c_name, '0')) AS pieces
    FROM customer""")
def text_functions(spark, sf):
    df = table(spark, sf, "customer")
    n = F.col("c_name")
    got = text.capture(n, r"^(?<the_word>[[:upper:]][[:lower:]]+)#0*(?<the_digits>[[:digit:]]+)$")
    return df.select(
        "c_custkey", text.replace_first(n, "0", "x").alias("first_zero"), text.replace_all(n, "0+", "-").alias("zeros"),
        text.sub(n, -4, -2).alias("tail"), got["the_word"].alias("word"), got["the_digits"].alias("digits"),
        text.detect(n, "7", negate=True).alias("no_seven"),
        F.concat_ws("/", F.upper("c_mktsegment"), F.lower(n)).alias("pasted"),
        F.size(text.split(n, "0")).cast("bigint").alias("pieces"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS strict, l_extendedprice AS lenient,
           CAST(floor((l_linenumber - 5) / 3) AS BIGINT) AS fl,
           CASE WHEN l_tax = 0 THEN NULL ELSE round(l_discount / l_tax, 9) END AS ratio,
           l_quantity + l_discount + l_tax AS total FROM lineitem""")
def number_functions(spark, sf):
    df = table(spark, sf, "lineitem")
    price = F.col("l_extendedprice")
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        numbers.strict_number(price.cast("string"), "double", "price").alias("strict"),
        numbers.lenient_number(F.concat(F.lit("$ "), F.format_number(price, 2), F.lit(" USD"))).alias("lenient"),
        numbers.floor_div(F.col("l_linenumber") - 5, 3).alias("fl"),
        F.round(numbers.ratio(F.col("l_discount"), F.col("l_tax")), 9).alias("ratio"),
        numbers.row_sum(F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")).alias("total"))


# ---------------------------------------------------------------- files: write, read back

RECT_WIDTHS = {"l_orderkey": 12, "l_partkey": 12, "l_linenumber": 3, "l_quantity": 8, "l_extendedprice": 14,
               "l_discount": 6, "l_returnflag": 1, "l_linestatus": 1}
RECT_DECIMALS = {"l_quantity": 2, "l_extendedprice": 2, "l_discount": 4}


def _rect_file(spark, sf, tag, compression="none"):
    df = persons(spark, sf).select(*RECT_WIDTHS)
    path = scratch_path(spark, tag)
    book = sinks.write_fixed_width(df, path, sinks.layout(df, RECT_WIDTHS, RECT_DECIMALS), "US-ASCII", compression)
    return book


@query("""
    SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey, l_linenumber, l_quantity,
           l_extendedprice, l_discount, l_returnflag, l_linestatus FROM lineitem""")
def fwf_rect_roundtrip(spark, sf):
    return micro.read_micro(spark, _rect_file(spark, sf, "rect"))


@query(f"""
    SELECT {FLAG_SQL} AS l_returnflag, sum(l_quantity) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY l_returnflag""")
def fwf_gzip_tabulation(spark, sf):
    book = _rect_file(spark, sf, "rectgz", "gzip")
    df = micro.read_micro(spark, book, vars=["l_returnflag", "l_quantity", "l_linestatus"])
    return tabulate.weighted_frequency(df.filter("l_linestatus = 'O'"), "l_returnflag", "l_quantity", share=None)


HIER_VARS = (
    Variable("RECTYPE", "Record type", val_labels=(("H", "Household Record"), ("P", "Person Record")), start=1, end=1,
             rectypes=("H", "P")),
    Variable("SERIAL", "Household number", start=2, end=13, var_type="numeric", rectypes=("H", "P")),
    Variable("STATUS", "Status", val_labels=STATUS_LABELS, start=14, end=14, rectypes=("H",)),
    Variable("PRICE", "Total price", start=15, end=28, imp_decim=2, var_type="numeric", rectypes=("H",)),
    Variable("LINE", "Line", start=14, end=16, var_type="integer", rectypes=("P",)),
    Variable("QTY", "Weight", start=17, end=24, imp_decim=2, var_type="numeric", rectypes=("P",)),
    Variable("FLAG", "Return flag", val_labels=FLAG_LABELS, start=25, end=25, rectypes=("P",)),
)


def _hier_file(spark, sf, tag) -> Codebook:
    h = table(spark, sf, "orders").select(F.col("o_orderkey").alias("SERIAL"), F.col("o_orderstatus").alias("STATUS"),
                                          F.col("o_totalprice").alias("PRICE"))
    p = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("SERIAL"), F.col("l_linenumber").alias("LINE"),
                                            F.col("l_quantity").alias("QTY"), F.col("l_returnflag").alias("FLAG"))
    path = scratch_path(spark, tag)
    sinks.write_hierarchical(h, p, path, list(HIER_VARS), "RECTYPE")
    return hier_book(path)


def hier_book(path: str) -> Codebook:
    base, name = path.rsplit("/", 1)
    return Codebook(variables=HIER_VARS, file_name=name, file_path=base, file_type="hierarchical", rectypes=("H", "P"),
                    rectype_idvar="RECTYPE", rectype_labels=(("H", "Household Record"), ("P", "Person Record")),
                    keyvars={"H": ("SERIAL",), "P": ("SERIAL",)}, file_encoding="US-ASCII")


@query("""
    SELECT 'H' AS RECTYPE, CAST(o_orderkey AS DOUBLE) AS SERIAL, o_orderstatus AS STATUS, o_totalprice AS PRICE,
           CAST(NULL AS INTEGER) AS LINE, CAST(NULL AS DOUBLE) AS QTY, CAST(NULL AS VARCHAR) AS FLAG FROM orders
    UNION ALL
    SELECT 'P', CAST(l_orderkey AS DOUBLE), NULL, NULL, l_linenumber, l_quantity, l_returnflag FROM lineitem""")
def hier_long(spark, sf):
    return micro.read_micro(spark, _hier_file(spark, sf, "hier"))


@query("""SELECT CAST(l_orderkey AS DOUBLE) AS SERIAL, l_quantity AS QTY FROM lineitem""")
def hier_list_person(spark, sf):
    return micro.read_micro_list(spark, _hier_file(spark, sf, "hier"), vars=["QTY", "PRICE"])["PERSON"]


@query("""
    SELECT CAST(l_orderkey AS DOUBLE) AS SERIAL, l_linenumber AS LINE, l_quantity AS QTY, l_returnflag AS FLAG,
           o_orderstatus AS STATUS, o_totalprice AS PRICE
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def rectangularize(spark, sf):
    parts = micro.read_micro_list(spark, _hier_file(spark, sf, "hier"), staging=scratch_path(spark, "types"))
    out = joins.rectangularize(parts["PERSON"], parts["HOUSEHOLD"], ["SERIAL"])
    return out.drop("RECTYPE")


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def csv_typed(spark, sf):
    path = scratch_path(spark, "orders") + ".csv"
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_custkey"]
    sinks.write_csv(table(spark, sf, "orders").select(*[q(c).alias(c.upper()) for c in cols]), path)
    book = Codebook(variables=(
        Variable("o_orderkey", var_type="integer"), Variable("o_orderstatus", val_labels=STATUS_LABELS),
        Variable("o_totalprice", var_type="numeric", imp_decim=2), Variable("o_orderpriority")),
        file_name=path.rsplit("/", 1)[1], file_path=path.rsplit("/", 1)[0])
    return micro.read_micro(spark, book)


@query("""
    SELECT 'G' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS GISJOIN, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS STATEA,
           c_mktsegment AS SEGMENT, c_acctbal AS ABO001, CAST(c_nationkey AS DOUBLE) AS ABO002 FROM customer""")
def area_table_inferred(spark, sf):
    path = scratch_path(spark, "area") + ".csv"
    c = table(spark, sf, "customer")
    rows = c.select(
        F.concat(F.lit("G"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("GISJOIN"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("STATEA"), F.col("c_mktsegment").alias("SEGMENT"),
        F.col("c_acctbal").cast("string").alias("ABO001"), F.col("c_nationkey").cast("string").alias("ABO002"))
    names = rows.columns

    def with_second_header(batches):  # every file starts with a descriptive row, as enhanced area files do
        import pandas as pd
        yield pd.DataFrame([["GIS Join Match Code", "State Code", "Segment", "Account: Balance", "Nation: Key"]], columns=names)
        yield from batches

    rows.mapInPandas(with_second_header, rows.schema).write.option("header", True).csv(path)
    return area.read_area_table(spark, path)


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price,
           o_orderpriority AS priority, CAST(o_custkey AS DOUBLE) AS guessed FROM orders""")
def mixed_micro(spark, sf):
    path = scratch_path(spark, "mixed") + ".csv"
    o = table(spark, sf, "orders")
    o.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("$"), F.format_number("o_totalprice", 2))).alias("price"),
             F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("guessed")
             ).write.option("header", True).option("nullValue", "null").csv(path)
    book = Codebook(variables=(Variable("o_orderkey", var_type="integer"), Variable("price", var_type="numeric"),
                               Variable("price", var_type="numeric"), Variable("priority"), Variable("absent")))
    return area.read_mixed_micro(spark, path, book)


@query("SELECT least(5000, count(*)) AS n FROM lineitem")
def first_lines(spark, sf):
    return micro.read_micro(spark, _rect_file(spark, sf, "rect"), vars="l_linenumber", n_max=5000).agg(F.count("*").alias("n"))


@query(f"""
    SELECT {STATUS_SQL} AS o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus""")
def labels_on_catalog_table(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("codeframe_orders")
    book = Codebook(variables=(Variable("o_orderstatus", "Status", val_labels=(*STATUS_LABELS, ("O", "Op"), ("Z", "Unused"))),))
    df = micro.collect_with_labels(spark.table("codeframe_orders").filter("o_totalprice > 100000"), book)
    return tabulate.weighted_frequency(df, "o_orderstatus", share=None)


# ---------------------------------------------------------------- codebooks

def _part_blocks(spark, sf):
    """Parts in blocks of 50 keys: a block is one variable of a codebook."""
    return table(spark, sf, "part").select(
        F.floor(F.col("p_partkey") / 50).alias("block"), F.col("p_partkey"), "p_name", "p_size", "p_type")


@query("""
    SELECT 'V' || lpad(CAST(p_partkey // 50 AS VARCHAR), 8, '0') AS var_name, CAST(p_partkey AS DOUBLE) AS val_num,
           CASE WHEN p_size > 25 THEN p_name ELSE 'n. ' || p_partkey END AS lbl
    FROM part WHERE p_partkey % 7 <> 0
    UNION ALL
    SELECT DISTINCT 'V' || lpad(CAST(p_partkey // 50 AS VARCHAR), 8, '0'), -1.0, 'Not known' FROM part""")
def codebook_xml_labels(spark, sf):
    label = F.when(F.col("p_partkey") % 7 == 0, F.concat(F.lit("0"), F.col("p_partkey").cast("string"))).when(
        F.col("p_size") > 25, F.col("p_name")).otherwise(F.concat(F.lit("n. "), F.col("p_partkey").cast("string")))
    cat = F.concat(F.lit("<catgry><catValu>"), F.lpad(F.col("p_partkey").cast("string"), 10, "0"), F.lit("</catValu><labl>"),
                   label, F.lit("</labl></catgry>"))
    name = F.concat(F.lit("V"), F.lpad(F.col("block").cast("string"), 8, "0"))
    var = F.concat(
        F.lit('<var name="'), name, F.lit('" dcml="0" intrvl="contin"><location StartPos="1" EndPos="10" width="10"/><labl>Block '),
        F.col("block").cast("string"), F.lit("</labl>"), F.concat_ws("", F.sort_array(F.collect_list("cat"))),
        F.lit("<codInstr>Codes\n-1 = Not known\nno code here</codInstr>"),
        F.lit('<varFormat type="numeric"/></var>'))
    path = scratch_path(spark, "xml")

    def with_root(batches):  # every file is one document
        import pandas as pd
        yield pd.DataFrame({"value": ["<codeBook><dataDscr>"]})
        yield from batches
        yield pd.DataFrame({"value": ["</dataDscr></codeBook>"]})

    elements = _part_blocks(spark, sf).withColumn("cat", cat).groupBy("block").agg(var.alias("value")).select("value")
    elements.mapInPandas(with_root, "value string").write.text(path)
    return ddi.read_codebook_tables(spark, path).value_labels.select("var_name", "val_num", "lbl")


@query("""
    SELECT p_partkey // 50 AS block, CAST(p_partkey AS DOUBLE) AS val_num, p_name AS lbl FROM part""")
def codebook_instruction_labels(spark, sf):
    line = F.concat(F.format_number("p_partkey", 0), F.lit(" = "), F.col("p_name"))
    notes = _part_blocks(spark, sf).groupBy("block").agg(
        F.concat_ws("\n", F.lit("Codes are as follows"), F.sort_array(F.collect_list(line)), F.lit("1962-1975 none")).alias("instr"))
    return ddi.labels_from_instructions(notes, "instr", F.lit(True)).select("block", "val_num", "lbl")


@query("""
    SELECT p_partkey // 50 AS block, p_type AS val, p_name AS lbl FROM part WHERE p_name <> p_type""")
def codebook_category_labels(spark, sf):
    cats = _part_blocks(spark, sf).select("block", F.col("p_type").alias("val"), F.col("p_name").alias("lbl"))
    return ddi.category_labels(cats, F.lit(False)).select("block", "val", "lbl")


@query("""
    SELECT 'book' || p_partkey // 50 AS codebook_id, 'F' || p_partkey AS var_name, p_name AS var_label,
           'Parts of ' || p_type || ' (' || upper(left(p_type, 3)) || ')' AS var_desc FROM part
    UNION ALL SELECT DISTINCT 'book' || p_partkey // 50, 'GISJOIN', 'Join code', '' FROM part""")
def codebook_text_variables(spark, sf):
    p = _part_blocks(spark, sf).withColumn("codebook_id", F.concat(F.lit("book"), F.col("block").cast("string")))

    def lines(df, at, *texts):
        return df.select("codebook_id", F.explode(F.array(*[
            F.struct(F.concat(F.lit(at), F.lit(f"{i:02d}")).alias("k"), t.alias("line")) for i, t in enumerate(texts)])).alias("x")
        ).select("codebook_id", "x.k", "x.line")

    dashes = F.lit("--------------------")
    books = p.select("codebook_id").distinct()
    head = lines(books, "a", F.lit("Codebook"), F.lit("Area data"), dashes, F.lit("Data Dictionary"), dashes, F.lit("Context Fields "),
                 F.lit("    GISJOIN:     Join code"), F.lit(" "))
    tables = p.select("codebook_id", "p_type").distinct()
    title = tables.select("codebook_id", F.explode(F.array(*[
        F.struct(F.concat(F.lit("b"), F.col("p_type"), F.lit(f"a{i}")).alias("k"), t.alias("line")) for i, t in enumerate([
            F.concat(F.lit("Table 1:     Parts of "), F.col("p_type")), F.lit("Universe:    All"), F.lit("Source code: S1"),
            F.concat(F.lit("Area code:   "), F.upper(F.substring("p_type", 1, 3)))])])).alias("x")).select("codebook_id", "x.k", "x.line")
    fields = p.select("codebook_id", F.concat(F.lit("b"), F.col("p_type"), F.lit("z"), F.lpad(F.col("p_partkey").cast("string"), 12, "0")).alias("k"),
                      F.concat(F.lit("    F"), F.col("p_partkey").cast("string"), F.lit(":   "), F.col("p_name")).alias("line"))
    tail = lines(books, "c", dashes, F.lit("Citation and Use of Area Data"), dashes, F.lit("Cite: it"))
    from pyspark.sql import Window
    every = head.unionByName(title).unionByName(fields).unionByName(tail)
    numbered = every.select("codebook_id", F.row_number().over(Window.partitionBy("codebook_id").orderBy("k")).alias("line_no"), "line")
    return textbook.textbook_variables(numbered).select("codebook_id", "var_name", "var_label", "var_desc")


@query("""
    SELECT p_partkey // 50 AS block, min(p_size) AS first_val, arg_min(p_name, (p_size, p_name)) AS first_lbl, count(*) AS n
    FROM part GROUP BY 1""")
def label_sets_sorted(spark, sf):
    sets = _part_blocks(spark, sf).groupBy("block").agg(F.collect_list(F.struct(
        F.col("p_size").cast("string").alias("val"), F.col("p_name").alias("lbl"))).alias("val_labels"))
    s = sorted_labels("val_labels")
    return sets.select("block", s[0]["val"].cast("int").alias("first_val"), s[0]["lbl"].alias("first_lbl"),
                       F.size("val_labels").cast("bigint").alias("n"))


@query("""
    SELECT lower(p_name) AS var_name, p_type AS var_label FROM (
        SELECT *, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) AS rn FROM part)
    WHERE rn = 1 AND (lower(p_name) LIKE 'red%' OR lower(p_name) LIKE '%gear' OR regexp_matches(lower(p_name), '^[hs].*bolt$'))""")
def first_variable_by_name(spark, sf):
    rows = table(spark, sf, "part").select(F.lower("p_name").alias("var_name"), F.col("p_partkey").alias("pos"), F.col("p_type").alias("var_label"))
    chosen = select_rows(rows, [starts_with("RED"), ends_with("Gear"), matches("^[hs].*bolt$")])
    return first_by_name(chosen).select("var_name", "var_label")


@query("SELECT DISTINCT p_size AS val, '#' || p_size AS lbl FROM part WHERE p_size > 40")
def unlabelled_values(spark, sf):
    return labels.label_table_for_values(sizes(spark, sf), "p_size", lambda val: F.concat(F.lit("#"), val.cast("string")))


@query("""
    SELECT p_name AS lbl, CAST(p_partkey AS VARCHAR) AS val FROM part ORDER BY p_partkey LIMIT 20""")
def smallest_label_codes(spark, sf):
    rows = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("val"), F.col("p_name").alias("lbl"))
    return tabulate.sort_labels(rows).limit(20)


# ---------------------------------------------------------------- bundles

@query("""
    SELECT CASE WHEN s <= 2 THEN 'data' WHEN s <= 4 THEN 'shape' ELSE 'raster' END AS type, count(*) AS n
    FROM (SELECT p_size % 7 AS s FROM part) WHERE s < 6 GROUP BY 1""")
def bundle_types(spark, sf):
    kinds = ["dat", "csv", "dat.gz", "zip", "shp", "tiff", "txt"]
    ext = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("p_size") % 7 + 1))
    members = table(spark, sf, "part").select(
        F.lit("bundle.zip").alias("bundle"), F.concat(F.lit("x_"), F.col("p_partkey").cast("string"), F.lit("."), ext).alias("file"))
    return tabulate.value_counts(files.classify(members), "type")


# ---------------------------------------------------------------- joins with boundaries

def _boundaries(spark, sf):
    """Nations with a text key shifted by five, so that each side has rows the other lacks."""
    return table(spark, sf, "nation").select(
        (F.col("n_nationkey") + 5).cast("string").alias("area"), F.col("n_name").alias("c_name"),
        F.unhex(F.lpad(F.hex("n_nationkey"), 8, "0")).alias("geometry"))


def _join_sql(kind):
    return f"""
    SELECT c_custkey, coalesce(c_nationkey, n_nationkey + 5) AS c_nationkey, c_name, n_name AS c_name_SHAPE,
           geometry IS NOT NULL AS has_geometry
    FROM customer {kind} JOIN (SELECT *, 1 AS geometry FROM nation) n
      ON CAST(c_nationkey AS VARCHAR) = CAST(n_nationkey + 5 AS VARCHAR)"""


def _shape_join(spark, sf, how):
    data = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_name")
    out = joins.shape_join(data, _boundaries(spark, sf), {"c_nationkey": "area"}, how).df
    return out.select("c_custkey", "c_nationkey", "c_name", "c_name_SHAPE", F.col("geometry").isNotNull().alias("has_geometry"))


@query(_join_sql("INNER"))
def boundary_inner(spark, sf):
    return _shape_join(spark, sf, "inner")


@query(_join_sql("LEFT"))
def boundary_left(spark, sf):
    return _shape_join(spark, sf, "left")


@query(_join_sql("RIGHT"))
def boundary_right(spark, sf):
    return _shape_join(spark, sf, "right")


@query(_join_sql("FULL"))
def boundary_full(spark, sf):
    return _shape_join(spark, sf, "full")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def join_failures(spark, sf):
    data = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    shape = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return joins.inner_join(data, shape, {"l_orderkey": "o_orderkey"}).unmatched_shape


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey + 5 FROM nation)")
def join_failures_data(spark, sf):
    data = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return joins.inner_join(data, _boundaries(spark, sf), {"c_nationkey": "area"}).unmatched_data


def _areas(spark, sf):
    return table(spark, sf, "customer").groupBy(F.concat(F.lit("G"), F.col("c_nationkey").cast("string")).alias("GISJOIN")).agg(
        F.count("*").alias("n"), F.lit("x").alias("layer"))


def _area_shapes(spark, sf):
    return table(spark, sf, "nation").select(
        F.concat(F.lit("G"), (F.col("n_nationkey") + 3).cast("string")).alias("GISJOIN"), F.col("n_name").alias("layer"),
        F.col("n_regionkey").alias("region"), F.unhex(F.hex("n_nationkey")).alias("geometry"))


@query("""
    WITH a AS (SELECT 'G' || c_nationkey AS g, count(*) AS n FROM customer GROUP BY 1)
    SELECT coalesce(g, 'G' || (n_nationkey + 3)) AS GISJOIN, n, n_regionkey AS region, n_nationkey IS NULL AS lost
    FROM a FULL JOIN nation ON g = 'G' || (n_nationkey + 3)""")
def area_with_boundaries(spark, sf):
    out = joins.area_with_boundaries(_areas(spark, sf), _area_shapes(spark, sf))
    return out.df.select("GISJOIN", "n", "region", F.col("geometry").isNull().alias("lost"))


@query("""
    WITH a AS (SELECT 'G' || c_nationkey AS g, count(*) AS n FROM customer GROUP BY 1)
    SELECT 'G' || (n_nationkey + 3) AS GISJOIN, n, n_regionkey AS region FROM a RIGHT JOIN nation ON g = 'G' || (n_nationkey + 3)""")
def area_keep_boundaries(spark, sf):
    out = joins.area_with_boundaries(_areas(spark, sf), _area_shapes(spark, sf), keep="boundaries", require_geometry=True)
    return out.df.select("GISJOIN", "n", "region")


@query("""
    SELECT c_nationkey AS GEO_CODE, c_custkey, n_name AS title FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def coded_area_join(spark, sf):
    data = table(spark, sf, "customer").select(
        F.lit("unreliable").alias("GEO_CODE_LABEL"), F.col("c_nationkey").alias("GEO_CODE"), "c_custkey")
    shape = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("string").alias("GEOID"), F.lit("cut sho").alias("LABEL"), F.col("n_name").alias("title"),
        F.unhex(F.hex("n_nationkey")).alias("geometry"))
    return joins.coded_area_with_boundaries(data, shape).df.select("GEO_CODE", "c_custkey", "title")


# ---------------------------------------------------------------- unions

@query("""
    SELECT 'customer' AS source, c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS INTEGER) AS nation
    FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier""")
def bind_rows(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return bind.bind_rows({"customer": c, "supplier": s}, id="source")


@query("""
    SELECT 'c' AS layer, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 's', s_name, s_acctbal, NULL FROM supplier""")
def bind_layers(spark, sf):
    root = scratch_path(spark, "layers")
    sinks.write_parquet(table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")), f"{root}/c.parquet")
    sinks.write_parquet(table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")), f"{root}/s.parquet")
    return boundary.read_boundaries(spark, {"c": f"{root}/c.parquet", "s": f"{root}/s.parquet"})


@query("""
    SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""")
def union_renamed(spark, sf):
    c = recode.harmonise(table(spark, sf, "customer"), {"nation": "c_nationkey", "balance": "c_acctbal"})
    s = recode.harmonise(table(spark, sf, "supplier"), {"nation": "s_nationkey", "balance": "s_acctbal"})
    return bind.bind_rows(c, s)


# ---------------------------------------------------------------- chunks and streams

@query("""
    WITH c AS (SELECT count(*) AS n FROM lineitem)
    SELECT k * 10000 + 1 AS pos, least(10000, n - k * 10000) AS n FROM c, (SELECT unnest(range(0, (n + 9999) // 10000)) AS k FROM c)""")
def chunk_positions(spark, sf):
    numbered = chunks.with_row_no(table(spark, sf, "lineitem").select("l_orderkey"))
    return chunks.with_chunk_id(numbered).groupBy((F.col("chunk_id") * 10000 + 1).alias("pos")).agg(F.count("*").alias("n"))


@query("SELECT l_returnflag, l_discount >= 0.05 AS high, count(*) AS n FROM lineitem GROUP BY 1, 2")
def chunk_tabulate(spark, sf):
    numbered = chunks.with_row_no(table(spark, sf, "lineitem").select("l_returnflag", "l_discount"), blocks=True)

    def count(rows, pos):
        return rows.assign(high=rows["l_discount"] >= 0.05).groupby(["l_returnflag", "high"]).size().reset_index(name="n")

    parts = chunks.chunk_map(numbered, count, "l_returnflag string, high boolean, n bigint")
    return parts.groupBy("l_returnflag", "high").agg(F.sum("n").alias("n"))


@query("SELECT l_returnflag, count(*) AS n, max(l_extendedprice) AS top FROM lineitem GROUP BY 1")
def chunk_accumulator(spark, sf):
    numbered = chunks.with_row_no(table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice"))

    def receive(rows, pos):
        return rows.groupby("l_returnflag")["l_extendedprice"].agg(n="count", top="max").reset_index()

    def merge(states):
        return states.groupby("l_returnflag").agg(n=("n", "sum"), top=("top", "max")).reset_index()

    return chunks.chunk_reduce(numbered, receive, merge, "l_returnflag string, n bigint, top double")


@query("""
    WITH c AS (SELECT count(*) AS n FROM lineitem)
    SELECT k AS chunk_id, k * 10000 + 1 AS pos, least(10000, n - k * 10000) AS n
    FROM c, (SELECT unnest(range(0, (n + 9999) // 10000)) AS k FROM c)""")
def chunk_results_apart(spark, sf):
    import pandas as pd
    numbered = chunks.with_row_no(table(spark, sf, "lineitem").select("l_quantity"))
    return chunks.chunk_list(numbered, lambda rows, pos: pd.DataFrame({"pos": [pos], "n": [len(rows)]}), "pos bigint, n bigint")


@query("SELECT (count(*) + 9999) // 10000 AS chunks FROM lineitem")
def chunk_side_effects(spark, sf):
    stored = chunks.RowReader(chunks.with_row_no(table(spark, sf, "lineitem").select("l_quantity"))).stored
    run = chunks.chunk_side_effect(stored, lambda rows, pos: len(rows) <= 10000)
    return spark.createDataFrame([(run,)], "chunks bigint")


@query("SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.09")
def chunk_select_cases(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag", "l_discount")

    def pick_rows(rows, i):
        return rows.loc[(rows["l_returnflag"] == "R") & (rows["l_discount"] > 0.09), ["l_orderkey", "l_extendedprice"]]

    return chunks.batch_map(df, pick_rows, "l_orderkey bigint, l_extendedprice double")


@query("""
    SELECT 'HOUSEHOLD' AS record_type, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
    UNION ALL SELECT 'PERSON', count(*), round(sum(l_quantity), 2) FROM lineitem""")
def chunk_list_tabulate(spark, sf):
    import pandas as pd

    def totals(parts, pos):
        return pd.DataFrame({"record_type": ["HOUSEHOLD", "PERSON"], "n": [len(parts["HOUSEHOLD"]), len(parts["PERSON"])],
                             "total": [parts["HOUSEHOLD"]["PRICE"].sum(), parts["PERSON"]["QTY"].sum()]})

    rows = chunks.read_micro_list_chunked(spark, _hier_file(spark, sf, "hier"), totals, "record_type string, n bigint, total double",
                                          vars=["PRICE", "QTY"])
    return rows.groupBy("record_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@query("SELECT l_linestatus, sum(l_quantity) AS n FROM lineitem GROUP BY 1")
def pull_tabulate(spark, sf):
    reader = chunks.RowReader(chunks.with_row_no(table(spark, sf, "lineitem").select("l_linestatus", "l_quantity")))
    size = max(chunks.CHUNK_SIZE, -(-reader.total // 8))
    parts = chunks.stack_pulls(reader, lambda p: p.groupBy("l_linestatus").agg(F.sum("l_quantity").alias("n")), size)
    return parts.groupBy("l_linestatus").agg(F.sum("n").alias("n"))


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def stream_running_count(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = running.stream_table(spark, schema, sf, pathGlobFilter="events.parquet")
    out = running.running_tabulation(stream, ["event_type"], {"n": F.count("*"), "total": F.sum("value")})
    return out.withColumn("total", F.round("total", 2))


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_load(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = running.stream_table(spark, schema, sf, pathGlobFilter="events.parquet")
    target = scratch_path(spark, "loaded")
    running.load_stream(stream, target, prepare=lambda d: d.select("event_id", "user_id", "event_type", "value")).awaitTermination()
    return spark.read.parquet(target)


@query(f"""
    SELECT CASE STATUS WHEN 'F' THEN 'Filled' WHEN 'O' THEN 'Open' ELSE 'Partly filled' END AS STATUS, n, total FROM (
        SELECT o_orderstatus AS STATUS, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1)""")
def stream_fixed_width(spark, sf):
    book = _hier_file(spark, sf, "hier")
    stream = running.stream_micro(spark, book, f"{book.file_path}/{book.file_name}")
    homes = stream.filter("RECTYPE = 'H'")
    out = running.running_tabulation(homes, ["STATUS"], {"n": F.count("*"), "total": F.sum("PRICE")})
    return labels.as_factor(out, "STATUS").withColumn("total", F.round("total", 2))


# ---------------------------------------------------------------- models

@query("""
    WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a,
                      regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_syy(l_extendedprice, l_quantity) AS syy,
                      regr_sxy(l_extendedprice, l_quantity) AS sxy, count(*) AS n, avg(l_quantity) AS mx FROM lineitem),
         r AS (SELECT *, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM s)
    SELECT '(Intercept)' AS term, round(a, 4) AS estimate, round(sqrt(s2 * (1.0 / n + mx * mx / sxx)), 4) AS std_error FROM r
    UNION ALL SELECT 'l_quantity', round(b, 4), round(sqrt(s2 / sxx), 4) FROM r""")
def ols_coef(spark, sf):
    fit = models.linear_model(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"])
    return fit.table(spark).select("term", F.round("estimate", 4).alias("estimate"), F.round("std_error", 4).alias("std_error"))


@query("""
    WITH g AS (SELECT l_returnflag AS f, count(*) AS n, avg(l_extendedprice) AS m, var_samp(l_extendedprice) * (count(*) - 1) AS ss
               FROM lineitem GROUP BY 1),
         s AS (SELECT sum(ss) / (sum(n) - 3) AS s2, max(CASE WHEN f = 'A' THEN m END) AS ma, max(CASE WHEN f = 'A' THEN n END) AS na FROM g)
    SELECT CASE f WHEN 'A' THEN '(Intercept)' WHEN 'N' THEN 'l_returnflagNot returned' ELSE 'l_returnflagReturned' END AS term,
           round(CASE WHEN f = 'A' THEN m ELSE m - ma END, 4) AS estimate,
           round(sqrt(s2 * (1.0 / na + CASE WHEN f = 'A' THEN 0 ELSE 1.0 / n END)), 4) AS std_error FROM g, s""")
def ols_factor(spark, sf):
    fit = models.linear_model(persons(spark, sf), "l_extendedprice", [models.Factor("l_returnflag")])
    return fit.table(spark).select("term", F.round("estimate", 4).alias("estimate"), F.round("std_error", 4).alias("std_error"))


@query("""
    WITH t AS (SELECT l_quantity AS x, l_linenumber AS z, l_extendedprice AS y FROM lineitem),
         m AS (SELECT covar_pop(x, x) AS xx, covar_pop(x, z) AS xz, covar_pop(z, z) AS zz, covar_pop(x, y) AS xy,
                      covar_pop(z, y) AS zy, avg(x) AS mx, avg(z) AS mz, avg(y) AS my FROM t),
         b AS (SELECT *, (zz * xy - xz * zy) / (xx * zz - xz * xz) AS b1, (xx * zy - xz * xy) / (xx * zz - xz * xz) AS b2 FROM m)
    SELECT '(Intercept)' AS term, round(my - b1 * mx - b2 * mz, 3) AS estimate FROM b
    UNION ALL SELECT 'l_quantity', round(b1, 3) FROM b UNION ALL SELECT 'l_linenumber', round(b2, 3) FROM b""")
def ols_two_terms(spark, sf):
    fit = models.linear_model(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_linenumber"])
    return fit.table(spark).select("term", F.round("estimate", 3).alias("estimate"))


@query("""
    WITH g AS (SELECT l_linestatus AS f, avg(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END) AS p FROM lineitem GROUP BY 1),
         s AS (SELECT max(CASE WHEN f = 'F' THEN ln(p / (1 - p)) END) AS lf, max(CASE WHEN f = 'O' THEN ln(p / (1 - p)) END) AS lo FROM g)
    SELECT '(Intercept)' AS term, round(lf, 5) AS estimate FROM s UNION ALL SELECT 'l_linestatusO', round(lo - lf, 5) FROM s""")
def logit(spark, sf):
    df = table(spark, sf, "lineitem").select("l_linestatus", (F.col("l_discount") > 0.05).alias("high"))
    fit = models.generalized_model(df, "high", [models.Factor("l_linestatus", ("F", "O"))])
    return fit.select("term", F.round("estimate", 5).alias("estimate"))


# ---------------------------------------------------------------- extracts

@query("""
    SELECT l_quantity, l_returnflag, o_totalprice, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND l_linenumber > 1""")
def extract_job(spark, sf):
    spec = ex.define_extract("usa", "Two samples", ["1-URGENT", "5-LOW"], ["l_quantity", "l_returnflag", "o_totalprice", "o_orderstatus"])
    h = households(spark, sf).withColumnRenamed("o_orderkey", "l_orderkey")
    return ex.run_extract(spec, persons(spark, sf), h, "o_orderpriority", ["l_orderkey"], cases=F.col("l_linenumber") > 1)


@query("""
    SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1""")
def extract_revised(spark, sf):
    spec = ex.define_extract("usa", "One sample", "1-URGENT", ["o_orderpriority", "o_orderkey"])
    spec = ex.revise_extract(spec, samples_to_add="5-LOW", vars_to_remove="o_orderkey")
    spec = ex.extract_from_json(ex.to_json(spec), "usa")
    return tabulate.value_counts(ex.run_extract(spec, table(spark, sf, "orders"), sample="o_orderpriority"), "o_orderpriority")


def _documents(spark, sf):
    o = table(spark, sf, "orders")
    link = F.struct(F.concat(F.lit("file:/x/"), F.col("o_orderkey").cast("string")).alias("url"), F.lit(10).alias("bytes"))
    doc = F.to_json(F.struct(
        F.struct(F.struct(F.lit("P").alias("on")).alias("rectangular")).alias("data_structure"),
        F.lit("csv").alias("data_format"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("description"),
        F.create_map(F.col("o_orderpriority"), F.create_map().cast("map<string,string>")).alias("samples"),
        F.create_map(F.lit("YEAR"), F.map_from_arrays(F.array(F.lit("preselected")), F.array(F.lit("true"))),
                     F.col("o_orderstatus"), F.create_map().cast("map<string,string>")).alias("variables"),
        F.when(F.col("o_orderstatus") != "O", F.create_map(
            F.lit("data"), link, F.when(F.col("o_orderkey") % 2 == 0, "ddi_codebook").otherwise("other"), link)).alias("download_links"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("number"),
        F.when(F.col("o_orderkey") % 5 != 0, F.when(F.col("o_orderstatus") == "F", "completed").otherwise("started")).alias("status")))
    return o.select(doc.alias("value"))


@query("""
    SELECT 'Order ' || o_orderkey AS description, 'rectangular' AS data_structure, 'P' AS rectangular_on, o_orderpriority AS sample,
           'YEAR,' || o_orderstatus AS variables, o_orderkey % 5 <> 0 AS submitted,
           CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS number,
           CASE WHEN o_orderkey % 5 = 0 THEN 'unsubmitted' WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'started' END AS status,
           o_orderkey % 5 <> 0 AND o_orderstatus = 'F' AND o_orderkey % 2 = 0 AS ready FROM orders""")
def extract_log(spark, sf):
    log = ex.extract_log(_documents(spark, sf), collection="usa")
    return log.select("description", "data_structure", "rectangular_on", F.array_join("samples", ",").alias("sample"),
                      F.array_join("variables", ",").alias("variables"), "submitted", "number", "status", ex.is_ready().alias("ready"))


@query("""
    SELECT o_orderkey AS number, 'Order ' || o_orderkey AS description FROM orders WHERE o_orderkey % 5 <> 0
    ORDER BY o_orderkey DESC LIMIT 10""")
def extract_log_recent(spark, sf):
    return ex.recent_extracts(ex.extract_log(_documents(spark, sf), collection="usa"), "usa").select("number", "description")


@query("""
    SELECT o_orderkey AS number, o_orderstatus = 'F' AND o_orderkey % 2 = 0 AS ready FROM orders
    WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders WHERE o_orderkey % 5 <> 0)""")
def extract_log_last(spark, sf):
    log = ex.extract_log(_documents(spark, sf), collection="usa")
    return ex.last_extract(log, "usa").select("number", ex.is_ready().alias("ready"))


@query("SELECT true AS households_whole, true AS about_a_tenth FROM lineitem HAVING count(*) > 0")
def subsample_households(spark, sf):
    df = table(spark, sf, "lineitem")
    kept = ex.subsample(df, 0.1, ["l_orderkey"]).groupBy("l_orderkey").agg(F.count("*").alias("n_kept"))
    both = df.groupBy("l_orderkey").agg(F.count("*").alias("n_all")).join(kept, "l_orderkey", "left")
    share = F.count("n_kept") / F.count("*")
    return both.agg(F.bool_and(F.coalesce(F.col("n_kept") == F.col("n_all"), F.lit(True))).alias("households_whole"),
                    share.between(0.05, 0.15).alias("about_a_tenth"))


