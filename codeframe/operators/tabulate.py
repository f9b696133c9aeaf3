"""Weighted tabulations.

Every aggregate groups by the *code* and decodes the few result rows, so the label text
never travels through the shuffle. Totals come from scalar subqueries over the aggregated
table instead of a window without partitions or a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..metadata import all_meta, is_labelled, q, with_meta
from ..sources.scratch import scratch_path
from .labels import as_factor


def _cols(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def _decode(out: DataFrame, df: DataFrame, by: list[str], labels: bool) -> tuple[DataFrame, bool]:
    named = [c for c in by if labels and is_labelled(df, c)]
    if not named:
        return out, False
    out = with_meta(out, {c: m for c, m in all_meta(df).items() if c in by})
    merges = False
    for c in named:
        texts = [t for _, t in all_meta(df)[c].val_labels]
        merges = merges or len(set(texts)) < len(texts)
    return as_factor(out, named), merges


def weighted_frequency(df: DataFrame, by: str | Sequence[str], weight: str | Column | None = None,
                       n: str = "n", share: str | None = "share", labels: bool = True) -> DataFrame:
    """Sum of weights (or count of rows) per category and its share of the total."""
    keys = _cols(by)
    w = F.lit(1) if weight is None else q(weight) if isinstance(weight, str) else weight
    freq = df.select(*[q(k) for k in keys], w.alias("__w")).groupBy(*[q(k) for k in keys]).agg(F.sum("__w").alias(n))
    out, merges = _decode(freq, df, keys, labels)
    if merges:  # two codes with one label are one category
        out = out.groupBy(*[q(k) for k in keys]).agg(F.sum(q(n)).alias(n))
    return with_share(out, n, share, totals=freq) if share else out


def with_share(freq: DataFrame, n: str = "n", share: str = "share", totals: DataFrame | None = None) -> DataFrame:
    """Add each row's share of the column total (one-row scalar subquery)."""
    total = (freq if totals is None else totals).agg(F.sum(q(n))).scalar()
    return freq.withColumn(share, F.try_divide(q(n).cast("double"), total.cast("double")))


def first_per_group(df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """The first row of each group in the given order (all other columns by default).

    ``row_number() = 1`` is cut to one row per key and task before the shuffle, so a group of
    any size costs one row per map task.
    """
    ks = _cols(keys)
    cols = order if order is not None else [c for c in df.columns if c not in ks]
    by = [q(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]
    w = Window.partitionBy(*[q(k) for k in ks]).orderBy(*(by or [F.lit(0)]))
    out = df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    return with_meta(out, all_meta(df))


def household_frequency(df: DataFrame, household: str | Sequence[str], by: str | Sequence[str], weight: str,
                        order: Sequence[str | Column] | None = None, **kw) -> DataFrame:
    """Weighted frequency over one row per household."""
    need = list(dict.fromkeys([*_cols(household), *_cols(by), weight, *[c for c in (order or []) if isinstance(c, str)]]))
    slim = df.select(*[q(c) for c in need]) if order is None or all(isinstance(c, str) for c in order) else df
    return weighted_frequency(first_per_group(slim, household, order), by, weight, **kw)


def weighted_mean_expr(x: Column, w: Column, skip_null: bool = False) -> Column:
    """Sum of x*w over sum of w.

    A NULL x makes the mean NULL; with ``skip_null`` such rows leave both sums.
    """
    x = x.cast("double")
    mean = F.try_divide(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))
    if skip_null:
        return mean
    return F.when(F.count(F.when(x.isNull(), 1)) == 0, mean)


def weighted_mean(df: DataFrame, x: str | Column, weight: str | Column, by: str | Sequence[str] | None = None,
                  name: str = "mean", skip_null: bool = False, labels: bool = True) -> DataFrame:
    """Weighted mean of a number or of a condition, overall or per category."""
    xc = q(x) if isinstance(x, str) else x
    wc = q(weight) if isinstance(weight, str) else weight
    keys = [] if by is None else _cols(by)
    slim = df.select(*[q(k) for k in keys], xc.cast("double").alias("__x"), wc.cast("double").alias("__w"))
    sums = slim.groupBy(*[q(k) for k in keys]).agg(
        F.sum(F.col("__x") * F.col("__w")).alias("__xw"),
        F.sum(F.when(F.col("__x").isNotNull(), F.col("__w"))).alias("__sw"),
        F.count(F.when(F.col("__x").isNull(), 1)).alias("__miss"),
    )
    out, merges = _decode(sums, df, keys, labels)
    if merges:
        out = out.groupBy(*[q(k) for k in keys]).agg(*[F.sum(c).alias(c) for c in ("__xw", "__sw", "__miss")])
    mean = F.try_divide(F.col("__xw"), F.col("__sw"))
    if not skip_null:
        mean = F.when(F.col("__miss") == 0, mean)
    return out.select(*[q(k) for k in keys], mean.alias(name))


def two_way_table(df: DataFrame, row: str, col: str | Column, col_name: str = "flag", n: str = "n",
                  labels: bool = True) -> DataFrame:
    """Counts of a category against another category or a derived flag."""
    other = q(col) if isinstance(col, str) else col
    name = col if isinstance(col, str) else col_name
    slim = df.select(q(row), other.alias(name))
    counts = slim.groupBy(q(row), q(name)).agg(F.count("*").alias(n))
    keys = [row, name]
    out, merges = _decode(counts, df, [k for k in keys if k in df.columns], labels)
    if merges:
        out = out.groupBy(*[q(k) for k in keys]).agg(F.sum(q(n)).alias(n))
    return out


def share_of(df: DataFrame, condition: Column, by: str | Sequence[str], name: str = "share") -> DataFrame:
    """Share of rows per group that meet a condition; NULL conditions are left out."""
    keys = _cols(by)
    return (
        df.select(*[q(k) for k in keys], condition.cast("double").alias("__c"))
        .groupBy(*[q(k) for k in keys]).agg(F.avg("__c").alias(name))
    )


def value_counts(df: DataFrame, col: str | Sequence[str], n: str = "n") -> DataFrame:
    """Rows per value; NULL is a value of its own."""
    keys = _cols(col)
    return with_meta(df.groupBy(*[q(k) for k in keys]).agg(F.count("*").alias(n)),
                     {c: m for c, m in all_meta(df).items() if c in keys})


def distinct_count(df: DataFrame, col: str, name: str = "n_distinct") -> DataFrame:
    """Number of distinct values, by distinct and count (both with partial aggregation)."""
    return df.select(q(col)).distinct().agg(F.count(q(col)).alias(name))


def area_summary(df: DataFrame, by: dict[str, Column], measures: dict[str, tuple[Column, Column]],
                 first: dict[str, Column] | None = None, order: Column | None = None,
                 skip_null: bool = False) -> DataFrame:
    """Group by expressions; weighted means plus the first value of columns constant in a group.

    ``measures`` maps a name to (x, weight). ``first`` needs ``order`` to be deterministic.
    """
    keys = df.select(
        *[e.alias(k) for k, e in by.items()],
        *[c.alias(f"__x{i}") for i, (c, _) in enumerate(measures.values())],
        *[c.alias(f"__w{i}") for i, (_, c) in enumerate(measures.values())],
        *[c.alias(f"__f{i}") for i, c in enumerate((first or {}).values())],
        *([order.alias("__o")] if order is not None else []),
    )
    aggs = [weighted_mean_expr(F.col(f"__x{i}"), F.col(f"__w{i}"), skip_null).alias(name)
            for i, name in enumerate(measures)]
    for i, name in enumerate(first or {}):
        aggs.append((F.min_by(f"__f{i}", "__o") if order is not None else F.first(f"__f{i}")).alias(name))
    return keys.groupBy(*by).agg(*aggs)


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest value; ``ties`` makes the choice unique."""
    return df.orderBy(q(by).desc_nulls_last(), *[q(t) for t in ties]).limit(k)


def rows_at_extremes(df: DataFrame, col: str) -> DataFrame:
    """Rows where the column is at its overall minimum or maximum.

    A floating-point aggregate may come out one bit different when it is computed again, so
    such a table is written to the scratch folder first and compared with itself.
    """
    if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)) and _aggregates(df):
        path = scratch_path(df.sparkSession, "extremes")
        df.write.parquet(path)
        df = with_meta(df.sparkSession.read.schema(df.schema).parquet(path), all_meta(df))
    low, high = df.agg(F.min(q(col))).scalar(), df.agg(F.max(q(col))).scalar()
    return df.filter((q(col) == low) | (q(col) == high))


def _aggregates(df: DataFrame) -> bool:
    return "Aggregate [" in df._jdf.queryExecution().optimizedPlan().toString()


def sort_labels(label_table: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Label rows by value; codes that are numbers sort as numbers, before text codes."""
    v = F.col("val").cast("string")
    return label_table.orderBy(*[q(k) for k in keys], v.try_cast("double").asc_nulls_last(), v)
