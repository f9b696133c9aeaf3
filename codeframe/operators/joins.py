"""Equi-joins of data with boundaries (or persons with households) that survive hot keys.

Plan of every join:

* A boundary side below Spark's own broadcast threshold is left to Spark, which broadcasts
  it; the data side is not moved.
* Otherwise the data side is checked for hot keys with one mergeable frequent-items sketch
  (``approx_top_k`` over key hashes: no shuffle, at most ``MAX_HOT_KEYS`` longs come back).
  Rows of a hot key are spread over a number of salts that grows with the key's share, and only
  the boundary rows of those keys are repeated, once per salt.
* Without hot keys, right and full joins are Spark's own. With hot keys, or with a boundary
  side that can be broadcast, they are an inner or left join plus the boundary rows whose key
  does not occur in the data (an anti join against pre-aggregated keys): the data side is
  then never the side that a skewed or broadcast outer join cannot handle.

Which keys count as hot changes only the speed, never the result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import count_not_numeric, strict_number
from ..metadata import VarMeta, all_meta, get_meta, is_factor, is_integral, q, with_meta

MIN_HOT_KEYS, MAX_HOT_KEYS = 64, 100_000  # the latter is what one sketch can report; it is reached at 400,000 shuffle partitions


# ---------------------------------------------------------------- sizes and hot keys

def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, None where it is not available."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # no JVM plan at hand (Spark Connect)
        return None


def broadcast_limit(spark: SparkSession) -> int:
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    m = re.fullmatch(r"(-?\d+)([kmgt]?)b?", raw)
    if not m:
        return 10 << 20
    return int(m.group(1)) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[m.group(2)]


def fits_broadcast(df: DataFrame) -> bool:
    size = plan_bytes(df)
    return size is not None and 0 <= size <= broadcast_limit(df.sparkSession)


def _key_hash(cols: Sequence[Column], types: Sequence[T.DataType]) -> Column:
    # -0.0 and 0.0 join, so they must hash alike
    return F.xxhash64(*[c + F.lit(0.0) if isinstance(t, (T.DoubleType, T.FloatType)) else c
                        for c, t in zip(cols, types)])


def hot_limit(spark: SparkSession) -> int:
    """A key is hot if it holds more than 1/limit of the rows: about four shuffle partitions'
    worth. There can be no more than that many hot keys."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return min(max(parts // 4, MIN_HOT_KEYS), MAX_HOT_KEYS)


def hot_keys(df: DataFrame, keys: Sequence[str]) -> list[tuple[int, float]]:
    """(key hash, share of rows) of the hot keys."""
    types = [df.schema[k].dataType for k in keys]
    limit = hot_limit(df.sparkSession)
    tracked = max(10_000, 8 * limit)
    row = (
        df.select(_key_hash([q(k) for k in keys], types).alias("h"))
        .agg(F.expr(f"approx_top_k(h, {limit}, {tracked})").alias("top"), F.count("*").alias("n"))
        .first()
    )
    if not row["n"]:
        return []
    return [(t["item"], t["count"] / row["n"]) for t in row["top"] if t["count"] * limit > row["n"]]


def _salt_counts(h: Column, hot: list[tuple[int, float]], partitions: int) -> Column:
    """Number of salts of a key: its share in shuffle partitions, as a power of two. Keys of
    one number share one hashed set, so the test stays cheap with thousands of hot keys."""
    classes: dict[int, list[int]] = {}
    for item, share in hot:
        n = 1 << max(1, math.ceil(math.log2(max(share * partitions, 2))))
        classes.setdefault(n, []).append(item)
    expr = F.when(~h.isin([item for item, _ in hot]), F.lit(1))
    for n, items in sorted(classes.items(), reverse=True):
        expr = expr.when(h.isin(items), F.lit(n))
    return expr.otherwise(F.lit(1))


def salted(left: DataFrame, right: DataFrame, lkeys: Sequence[str], rkeys: Sequence[str],
           hot: list[tuple[int, float]]) -> tuple[DataFrame, DataFrame]:
    """Add ``__salt`` to both sides: spread on the left, repeated on the right.

    The salt depends on the row's values and its task's partition only, so a task that is
    run again after a lost executor writes the same salts whatever order its rows come in.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    lt, rt = [left.schema[k].dataType for k in lkeys], [right.schema[k].dataType for k in rkeys]
    ln = _salt_counts(_key_hash([q(k) for k in lkeys], lt), hot, parts)
    rn = _salt_counts(_key_hash([q(k) for k in rkeys], rt), hot, parts)
    row = F.xxhash64(*[q(f.name) for f in left.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    spread = F.pmod(F.xxhash64(row, F.spark_partition_id()), ln.cast("bigint")).cast("int")
    return (
        left.withColumn("__salt", spread),
        right.withColumn("__salt", F.explode(F.sequence(F.lit(0), rn - 1))),
    )


def needs_salt_check(left: DataFrame, right: DataFrame, skew: str) -> bool:
    """Is this a join that shuffles both sides (neither can be broadcast)?"""
    if skew not in ("salt", "aqe"):
        raise ValueError("skew must be 'salt' or 'aqe'")
    return skew == "salt" and not fits_broadcast(right) and not fits_broadcast(left)


def skew_join(left: DataFrame, right: DataFrame, lkeys: Sequence[str], rkeys: Sequence[str], how: str,
              skew: str = "aqe", hot: list[tuple[int, float]] | None = None, null_safe: bool = True) -> DataFrame:
    """Equi-join that may keep left rows (inner, left, left_semi, left_anti).

    The two sides must share no column name. With ``null_safe`` a NULL key meets a NULL key;
    without it, a partitioning or bucketing on the keys can be used again. ``skew="aqe"`` leaves hot keys to Spark's
    run-time skew handling, which these join types allow, and runs no job. ``skew="salt"`` sketches the keys first and spreads
    the rows of hot ones by all their columns: choose the columns before. ``hot`` gives the hot keys if they are known.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported: {how}")
    cond = [q(a).eqNullSafe(q(b)) if null_safe else q(a) == q(b) for a, b in zip(lkeys, rkeys)]
    if hot is None:
        hot = hot_keys(left, lkeys) if needs_salt_check(left, right, skew) else []
    if hot:
        left, right = salted(left, right, lkeys, rkeys, hot)
        right = right.withColumnRenamed("__salt", "__rsalt")
        cond.append(q("__salt") == q("__rsalt"))
        return left.join(right, reduce(and_, cond), how).drop("__salt", "__rsalt")
    return left.join(right, reduce(and_, cond), how)


# ---------------------------------------------------------------- keys

def parse_by(by) -> list[tuple[str, str]]:
    """``"ID"``, ``["ID", ...]``, ``{"data_key": "shape_key"}`` or a mixed list of these."""
    if isinstance(by, str):
        return [(by, by)]
    if isinstance(by, dict):
        return list(by.items())
    return [p for part in by for p in ([tuple(part)] if isinstance(part, tuple) else parse_by(part))]


def check_names(names: Sequence[str], df: DataFrame, what: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{what} has no column {', '.join(missing)}")


def _kind(df: DataFrame, c: str) -> str:
    dt = df.schema[c].dataType
    if isinstance(dt, T.StringType):
        return "factor" if is_factor(df, c) else "text"
    if is_integral(dt):
        return "integer"
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "double"
    return dt.simpleString()


def align_keys(data: DataFrame, shape: DataFrame, by: list[tuple[str, str]], eager: bool = False):
    """Give each key pair one type.

    Text against number: the text side is parsed, and text that is no number stops the
    query (inside the same scan; ``eager`` tests it now, with one aggregate per side).
    Factor against text is text; factor against number is an error; integer against double
    is double. Key metadata is merged, the data side wins.
    """
    parse: tuple[dict[str, str], dict[str, str]] = ({}, {})  # data, shape
    casts: tuple[dict[str, str], dict[str, str]] = ({}, {})
    for d, s in by:
        dk, sk = _kind(data, d), _kind(shape, s)
        if dk == sk:
            if dk == "factor":
                continue
            dt, st = data.schema[d].dataType, shape.schema[s].dataType
            if dt != st:
                wide = "bigint" if dk == "integer" else "double" if dk == "double" else None
                if wide is None:
                    raise TypeError(f"Cannot join {d} ({dt.simpleString()}) to {s} ({st.simpleString()})")
                casts[0][d] = casts[1][s] = wide
        elif {dk, sk} == {"text", "factor"}:
            continue
        elif "factor" in (dk, sk):
            raise TypeError(f"a factor key joins text only: {d} is {dk}, {s} is {sk}")
        elif sk == "text" and dk in ("double", "integer"):
            parse[1][s] = data.schema[d].dataType.simpleString()
        elif dk == "text" and sk in ("double", "integer"):
            parse[0][d] = shape.schema[s].dataType.simpleString()
        elif {dk, sk} == {"integer", "double"}:
            casts[0][d] = casts[1][s] = "double"
        else:
            raise TypeError(f"Cannot join {d} ({dk}) to {s} ({sk})")
    if eager:
        for df, todo in ((data, parse[0]), (shape, parse[1])):
            bad = {c: n for c, n in count_not_numeric(df, todo).items() if n}
            if bad:
                raise ValueError("key columns with text that is no number: " + ", ".join(bad))
    out = []
    for side, df, p, c in ((0, data, parse[0], casts[0]), (1, shape, parse[1], casts[1])):
        metas = all_meta(df)
        if p or c:
            df = df.select(*[
                strict_number(q(n), p[n], n).alias(n) if n in p else q(n).cast(c[n]).alias(n) if n in c else q(n)
                for n in df.columns
            ])
        for pair in by:
            metas[pair[side]] = replace(metas[pair[side]], levels=None)
        out.append(with_meta(df, metas))
    merged = {}
    for d, s in by:
        a, b = get_meta(out[0], d), get_meta(out[1], s)
        merged[d] = VarMeta(
            label=a.label if a.label is not None else b.label,
            var_desc=a.var_desc if a.var_desc is not None else b.var_desc,
            val_labels=a.val_labels or b.val_labels,
            other={**b.other, **a.other},
        )
    return out[0], out[1], merged


# ---------------------------------------------------------------- audited join

class JoinResult:
    """Joined table ``df`` plus the rows each side lost.

    The lost rows are planned only when asked for, so a plain join pays nothing for them.
    """

    def __init__(self, df: DataFrame, data: Callable[[], DataFrame], shape: Callable[[], DataFrame],
                 geometry: str | None = None):
        self.df = df
        self._data, self._shape = data, shape
        self.geometry = geometry

    @cached_property
    def unmatched_data(self) -> DataFrame:
        return self._data()

    @cached_property
    def unmatched_shape(self) -> DataFrame:
        return self._shape()

    @cached_property
    def counts(self) -> dict[str, int]:
        """Rows lost on each side (runs the anti joins once)."""
        return {"data": self.unmatched_data.count(), "shape": self.unmatched_shape.count()}

    def failures(self) -> dict[str, DataFrame] | None:
        """Lost rows of both sides, or None if nothing was lost."""
        if not any(self.counts.values()):
            return None
        return {"shape": self.unmatched_shape, "data": self.unmatched_data}

    def without_geometry(self) -> DataFrame:
        """Rows that have data but no boundary."""
        if self.geometry is None:
            raise ValueError("the boundary table has no geometry column")
        return self.df.filter(q(self.geometry).isNull())


def shape_join(data: DataFrame, shape: DataFrame, by, how: str = "inner", suffix: tuple[str, str] = ("", "_SHAPE"),
               require_geometry: bool = False, skew: str | None = None, eager_checks: bool = False,
               geometry: str = "geometry") -> JoinResult:
    """Join data to boundaries on aligned keys; data columns come first.

    NULL keys match NULL keys. ``how`` is inner, left (all data), right (all boundaries) or
    full. With ``require_geometry`` only inner and right are allowed. Non-key columns with
    the same name get the suffixes. Summarise the data before joining large geometries. By default (``skew=None``) inner
    and left joins leave hot keys to Spark's run-time splitting; right and full joins, which it cannot split, sketch the keys first.
    """
    skew = skew or ("aqe" if how in ("inner", "left") else "salt")
    if how not in ("inner", "left", "right", "full"):
        raise ValueError("how must be one of inner, left, right, full")
    if require_geometry and how in ("left", "full"):
        raise ValueError("require_geometry allows inner and right joins: in the others, unmatched data rows "
                         "have no geometry")
    pairs = parse_by(by)
    dkeys, skeys = [d for d, _ in pairs], [s for _, s in pairs]
    check_names(skeys, shape, "shape data")
    check_names(dkeys, data, "data")
    taken = [c for c in shape.columns if c in dkeys and c not in skeys]
    if taken:
        raise ValueError(f"shape data already has other columns named {', '.join(taken)}")
    data, shape, key_meta = align_keys(data, shape, pairs, eager_checks)

    # Internal names keep the two sides apart.
    k = {s: f"__k{i}" for i, s in enumerate(skeys)}
    rest = [c for c in shape.columns if c not in skeys]
    inner_names = {c: f"__s{i}" for i, c in enumerate(rest)}
    right = shape.select(*[q(s).alias(k[s]) for s in skeys], *[q(c).alias(inner_names[c]) for c in rest])
    rkeys = [k[s] for s in skeys]
    clash = {c for c in rest if c in data.columns}
    d_out = {c: c + suffix[0] if c in clash else c for c in data.columns}
    s_out = {c: c + suffix[1] if c in clash else c for c in rest}

    def finish(df: DataFrame) -> DataFrame:
        return df.select(*[q(c).alias(d_out[c]) for c in data.columns], *[q(inner_names[c]).alias(s_out[c]) for c in rest])

    # One sketch of the data keys serves the join and both reports.
    hot = hot_keys(data, dkeys) if needs_salt_check(data, right, skew) else []
    shape_is_small = fits_broadcast(right)
    if how in ("right", "full") and not hot and not shape_is_small:
        cond = reduce(and_, [q(a).eqNullSafe(q(b)) for a, b in zip(dkeys, rkeys)])
        tagged = data.withColumn("__in_data", F.lit(True))
        both = tagged.join(right, cond, how)
        main = finish(both.select(
            *[F.when(F.col("__in_data"), q(c)).otherwise(q(rkeys[dkeys.index(c)])).alias(c) if c in dkeys else q(c)
              for c in data.columns],
            *[q(inner_names[c]) for c in rest]))
    else:
        main = finish(skew_join(data, right, dkeys, rkeys, "left" if how in ("left", "full") else "inner", skew, hot))
        if how in ("right", "full"):
            back = dict(zip(dkeys, rkeys))
            extra = _absent(right, rkeys, data, dkeys, hot, shape_is_small).select(
                *[(q(back[c]) if c in back else F.lit(None).cast(data.schema[c].dataType)).alias(c) for c in data.columns],
                *[q(inner_names[c]) for c in rest])
            main = main.unionByName(finish(extra))
    metas = {d_out[c]: m for c, m in all_meta(data).items()}
    metas.update({s_out[c]: m for c, m in all_meta(shape).items() if c in s_out})
    metas.update({d_out[c]: m for c, m in key_meta.items()})

    def lost_data() -> DataFrame:
        if how in ("left", "full"):
            return data.limit(0)
        seen = right.select(*rkeys).distinct()
        return with_meta(skew_join(data, seen, dkeys, rkeys, "left_anti", skew, hot), all_meta(data))

    def lost_shape() -> DataFrame:
        if how in ("right", "full"):
            return shape.limit(0)
        inside = {**k, **inner_names}
        alone = _absent(right, rkeys, data, dkeys, hot, shape_is_small)
        return with_meta(alone.select(*[q(inside[c]).alias(c) for c in shape.columns]), all_meta(shape))

    return JoinResult(with_meta(main, metas), lost_data, lost_shape, s_out.get(geometry))


def _absent(right: DataFrame, rkeys: list[str], data: DataFrame, dkeys: list[str], hot: list, right_is_small: bool) -> DataFrame:
    """Rows of ``right`` whose key does not occur in ``data``.

    Data keys are made distinct before the shuffle, so no key is hot any more on that side.
    If ``right`` is small, only keys that occur in it are kept first: the anti join's other
    side is then no larger than ``right``.
    """
    keys = data.select(*[q(d).alias(f"__d{i}") for i, d in enumerate(dkeys)])
    names = keys.columns
    if right_is_small:
        keys = skew_join(keys, right.select(*rkeys).distinct(), names, rkeys, "left_semi", hot=[])
    keys = keys.distinct()
    # Boundary rows are checked for hot keys of their own only if both sides must be shuffled.
    return skew_join(right, keys, rkeys, names, "left_anti", hot=[] if right_is_small else None)


def inner_join(data, shape, by, **kw) -> JoinResult:
    return shape_join(data, shape, by, "inner", **kw)


def left_join(data, shape, by, **kw) -> JoinResult:
    return shape_join(data, shape, by, "left", **kw)


def right_join(data, shape, by, **kw) -> JoinResult:
    return shape_join(data, shape, by, "right", **kw)


def full_join(data, shape, by, **kw) -> JoinResult:
    return shape_join(data, shape, by, "full", **kw)


# ---------------------------------------------------------------- ready-made key choices

def area_with_boundaries(data: DataFrame, shape: DataFrame, key_pattern: str = "GISJOIN.*",
                         keep: str = "all", **kw) -> JoinResult:
    """Area table with its boundaries: the key is every common column matching the pattern;
    other common columns are dropped from the boundary side.

    ``keep="all"`` is a full join, ``keep="boundaries"`` keeps every boundary and reports the
    data rows without one.
    """
    common = [c for c in data.columns if c in shape.columns]
    keys = [c for c in common if re.search(key_pattern, c)]
    if not keys:
        raise ValueError(f"no common column matches {key_pattern}")
    shape = shape.drop(*[c for c in common if c not in keys])
    return shape_join(data, shape, keys, {"all": "full", "boundaries": "right"}[keep], **kw)


def coded_area_with_boundaries(data: DataFrame, shape: DataFrame, shape_key: str = "GEOID",
                               label: str = "LABEL", **kw) -> JoinResult:
    """Inner join on the first ``GEO*`` column of the data that is not a label column. The
    boundary side's own label is unreliable and dropped."""
    geo = [c for c in data.columns if c.upper().startswith("GEO") and not c.upper().endswith("LABEL")]
    if not geo:
        raise ValueError("data has no GEO* key column")
    return shape_join(data, shape.drop(label), {geo[0]: shape_key}, "inner", **kw)


def rectangularize(person: DataFrame, household: DataFrame, keys: Sequence[str], skew: str = "aqe") -> DataFrame:
    """Put the household variables on every person row (persons without household are kept).

    Columns that both have stay as the person's. A NULL key belongs to no household.
    """
    keys = list(keys)
    rest = [c for c in household.columns if c not in person.columns]
    right = household.select(*[q(c).alias(f"__h{i}") for i, c in enumerate(keys)], *[q(c) for c in rest])
    out = skew_join(person, right, keys, [f"__h{i}" for i in range(len(keys))], "left", skew, null_safe=False)
    out = out.select(*[q(c) for c in person.columns], *[q(c) for c in rest])
    return with_meta(out, {**{c: m for c, m in all_meta(household).items() if c in rest}, **all_meta(person)})
