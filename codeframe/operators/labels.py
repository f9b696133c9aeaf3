"""Label algebra: rewrite a coded column together with its label set.

A label set is metadata, so rules run over the set (as Spark expressions on a local
relation, no cluster job) and the data sees one projection: a lookup in a literal map for
ordinary code lists, a broadcast join of the code list above ``INLINE_CODES`` entries.
Nothing runs row by row in Python.

A rule is a function of the columns ``(val, lbl)``, a column expression over ``val`` and
``lbl``, or SQL text over them::

    lbl_na_if(df, "INCTOT", lambda val, lbl: (val >= 90) | (lbl == "Maybe"))
    lbl_na_if(df, "INCTOT", "val >= 90 or lbl = 'Maybe'")
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from typing import Any, Union

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..metadata import (
    ALL_ATTRS, LABEL_TABLE, Lbl, VarMeta, all_meta, fill_lbl, get_meta, is_integral, is_numeric, labelled_columns, q, with_meta,
)
from ..sources.scratch import scratch_path

INLINE_CODES = 200  # longer code lists are joined instead of inlined; results are the same
BROADCAST_CODES = 100_000  # code lists up to this length (a few MB) are broadcast; Spark decides about longer ones
MAX_NEW_LABELS = 20_000  # new labels kept in column metadata; more are kept as a table that the metadata names

Rule = Union[Callable[[Column, Column], Column], Column, str]


# ---------------------------------------------------------------- rules over label sets

def _rule_column(rule: Rule, val: Column, lbl: Column) -> Column:
    if isinstance(rule, Column):
        return rule
    if isinstance(rule, str):
        return F.expr(rule)
    if callable(rule):
        out = rule(val, lbl)
        return out if isinstance(out, Column) else F.lit(out)
    raise TypeError(f"a rule is a function of columns, a column or SQL text, not a {type(rule).__name__}")


def _plain(v: Any) -> Any:
    """10.0 and 10 are the same code; keep whole numbers as int."""
    if isinstance(v, bool):
        return v
    if isinstance(v, float) and v.is_integer():
        return int(v)
    return v


def apply_rule(df: DataFrame, pairs, rule: Rule) -> list[Any]:
    """Value of ``rule`` for every (val, lbl) of a label set, in order."""
    column = _rule_column(rule, F.col("val"), F.col("lbl"))
    if not pairs:
        return []
    vals = [v for v, _ in pairs]
    if all(isinstance(v, str) for v in vals):
        kind: pa.DataType = pa.string()
    elif all(isinstance(v, int) for v in vals):
        kind = pa.int64()
    else:
        kind, vals = pa.float64(), [float(v) for v in vals]
    table = pa.table({"val": pa.array(vals, kind), "lbl": pa.array([t for _, t in pairs], pa.string())})
    rows = df.sparkSession.createDataFrame(table).select(column.alias("r")).collect()
    return [r["r"] for r in rows]


def _code(v: Any, dt: T.DataType) -> Any:
    """A label value as the Python value that compares with a column of type ``dt``."""
    if isinstance(dt, T.StringType):
        return v if isinstance(v, str) else str(_plain(v))
    if is_integral(dt):
        return _plain(v)
    return float(v)


def _out_type(old: T.DataType, new_vals: list[Any]) -> T.DataType:
    """Type of a recoded column: unchanged if the new codes fit it."""
    present = [_plain(v) for v in new_vals if v is not None]
    if any(isinstance(v, str) for v in present):
        return T.StringType()
    if present and all(isinstance(v, bool) for v in present):
        return T.BooleanType()
    if is_integral(old) and any(isinstance(v, float) for v in present):
        return T.DoubleType()
    if isinstance(old, T.StringType) and present:
        return T.DoubleType() if any(isinstance(v, float) for v in present) else T.LongType()
    return old


def _sort_key(pair):
    v = pair[0]
    return (isinstance(v, str), v)


def one_per_code(pairs) -> list[tuple[Any, Any]]:
    """The first pair of each code, in order. Every form of a lookup starts here, so a code that stands twice gives the
    same value whatever the length of the list."""
    first: dict[Any, Any] = {}
    for a, b in pairs:
        first.setdefault(a, b)
    return list(first.items())


def _code_frame(df: DataFrame, table: pa.Table) -> DataFrame:
    """A code list, which sits on the driver already, as a table; broadcast if its length is within the bound."""
    frame = df.sparkSession.createDataFrame(table)
    return F.broadcast(frame) if table.num_rows <= BROADCAST_CODES else frame


DENSE_CODES = 2_000  # widest span of whole-number codes that is looked up by position


def lookup(x: Column, dt: T.DataType, pairs, out_type: T.DataType) -> Column:
    """Value of a short code list, NULL outside it.

    Whole-number codes that lie close together are positions in a literal array, found in one step. Others are a literal
    map, whose code does not grow with the list, unlike a CASE chain, which soon
    makes a generated method too large for the JVM to compile.
    """
    known = dict(one_per_code(pairs))
    if known and is_integral(dt) and max(known) - min(known) < min(DENSE_CODES, 8 * len(known) + 8):
        low = min(known)
        cells = [F.lit(known.get(c)).cast(out_type) for c in range(low, max(known) + 1)]
        at = F.when((x >= low) & (x <= max(known)), (x - low).cast("int"))
        return F.get(F.array(*cells), at)
    cells = [c for a, b in known.items() for c in (F.lit(a).cast(dt), F.lit(b).cast(out_type))]
    return F.try_element_at(F.create_map(*cells), x)


def recode(df: DataFrame, col: str, mapping: list[tuple[Any, Any]], out_type: T.DataType,
           other: str = "null", out: str | None = None) -> DataFrame:
    """Replace codes by ``mapping``; values outside become NULL or, with ``other="keep"``, stay.

    ``out`` names a new column instead of replacing ``col``.
    """
    dt = df.schema[col].dataType
    target = out or col
    x = q(col)
    rest = x.cast(out_type) if other == "keep" else F.lit(None).cast(out_type)
    pairs = one_per_code((_code(a, dt), None if b is None else (_code(b, out_type) if not isinstance(out_type, T.BooleanType) else b))
                         for a, b in mapping)
    names = df.columns if target in df.columns else [*df.columns, target]
    if len(pairs) <= INLINE_CODES:
        same = [a for a, b in pairs if a == b and type(a) is type(b)]
        gone = [a for a, b in pairs if b is None]
        moved = [(a, b) for a, b in pairs if b is not None and a not in same]
        expr = rest
        if moved:
            expr = F.coalesce(lookup(x, dt, moved, out_type), rest) if other == "keep" else lookup(x, dt, moved, out_type)
        if same and other != "keep":
            expr = F.when(x.isin(same), x.cast(out_type)).otherwise(expr)
        if gone and other == "keep":
            expr = F.when(~F.coalesce(x.isin(gone), F.lit(False)), expr)
        return df.select(*[expr.alias(target) if c == target else q(c) for c in names])
    kind = pa.string() if isinstance(dt, T.StringType) else pa.int64() if is_integral(dt) else pa.float64()
    value_kind = (pa.string() if isinstance(out_type, T.StringType) else pa.bool_() if isinstance(out_type, T.BooleanType)
                  else pa.int64() if is_integral(out_type) else pa.float64())
    codes = _code_frame(df, pa.table({
        "__code": pa.array([a for a, _ in pairs], kind),
        "__new": pa.array([b for _, b in pairs], value_kind),
        "__hit": pa.array([True] * len(pairs)),
    }))
    joined = df.join(codes, x == F.col("__code"), "left")
    expr = F.when(F.col("__hit"), F.col("__new").cast(out_type)).otherwise(rest)
    return joined.select(*[expr.alias(target) if c == target else q(c) for c in names])


def _finish(df: DataFrame, before: DataFrame, col: str, meta: VarMeta) -> DataFrame:
    metas = {c: m for c, m in all_meta(before).items() if c in df.columns}
    metas[col] = meta
    return with_meta(df, metas)


def _unique_or_fail(pairs) -> list[tuple[Any, str]]:
    distinct = list(dict.fromkeys(pairs))
    seen: dict[Any, list[str]] = {}
    for v, t in distinct:
        seen.setdefault(v, []).append(t)
    double = {v: ts for v, ts in seen.items() if len(ts) > 1}
    if double:
        lines = ", ".join(f"{v} -> " + ", ".join(f"'{t}'" for t in ts) for v, ts in double.items())
        raise ValueError(f"values with several labels: {lines}")
    return sorted(distinct, key=_sort_key)


# ---------------------------------------------------------------- label sets with a stored table

def label_rows(df: DataFrame, col: str) -> DataFrame:
    """The whole label set of a column as a table ``(val, lbl)``: its metadata and the stored table that they name."""
    meta, dt = get_meta(df, col), df.schema[col].dataType
    kind = pa.string() if isinstance(dt, T.StringType) else pa.int64() if is_integral(dt) else pa.float64()
    pairs = one_per_code((_code(v, dt), t) for v, t in meta.val_labels)
    wide = "string" if isinstance(dt, T.StringType) else "bigint" if is_integral(dt) else "double"
    own = _code_frame(df, pa.table({"val": pa.array([v for v, _ in pairs], kind), "lbl": pa.array([t for _, t in pairs], pa.string())}))
    if LABEL_TABLE not in meta.other:
        return own
    stored = df.sparkSession.read.parquet(meta.other[LABEL_TABLE]).select(F.col("val").cast(wide).alias("val"), "lbl")
    return stored.join(own.select("val"), "val", "left_anti").select("val", "lbl").unionByName(own)


def _unstored(meta: VarMeta) -> VarMeta:
    return replace(meta, other={k: v for k, v in meta.other.items() if k != LABEL_TABLE})


def _with_rows(out: DataFrame, before: DataFrame, col: str, meta: VarMeta, rows: DataFrame) -> DataFrame:
    """``out`` with the label set ``rows`` (val, lbl) for ``col``: metadata up to MAX_NEW_LABELS entries, else a stored table."""
    path = scratch_path(before.sparkSession, "labels")
    rows.select("val", "lbl").write.parquet(path)
    stored = before.sparkSession.read.schema(rows.select("val", "lbl").schema).parquet(path)
    few = stored.limit(MAX_NEW_LABELS + 1).collect()
    if len(few) <= MAX_NEW_LABELS:
        pairs = sorted(((_plain(r["val"]), r["lbl"]) for r in few), key=_sort_key)
        return _finish(out, before, col, _unstored(meta).with_labels(pairs))
    return _finish(out, before, col, replace(meta, val_labels=(), other={**meta.other, LABEL_TABLE: path}))


def _for_rules(df: DataFrame, col: str) -> DataFrame:
    """``label_rows`` with ``__key``, the code as the data have it; whole codes of a set are whole numbers to a rule, as in ``apply_rule``."""
    rows = label_rows(df, col).withColumn("__key", F.col("val"))
    if dict(rows.dtypes)["val"] == "double" and rows.where("val <> floor(val)").isEmpty():
        rows = rows.withColumn("val", F.col("val").cast("bigint"))
    return rows


def _rows_type(old: T.DataType, rows: DataFrame, c: str) -> T.DataType:
    """``_out_type`` of a column of new codes."""
    kind = rows.schema[c].dataType
    present = rows.where(F.col(c).isNotNull())
    if isinstance(kind, T.StringType):
        sample: list[Any] = [] if present.isEmpty() else ["text"]
    elif isinstance(kind, T.BooleanType):
        sample = [] if present.isEmpty() else [True]
    else:
        broken = not present.where(F.col(c) != F.floor(c)).isEmpty()
        sample = [0.5] if broken else [] if present.isEmpty() else [1]
    return _out_type(old, sample)


def _recode_by_rows(df: DataFrame, col: str, rows: DataFrame, out_type: T.DataType, other: str = "null") -> DataFrame:
    """``recode`` by a table ``(__key, __new)`` of distinct codes."""
    mapping = rows.select(F.col("__key").alias("__code"), F.col("__new"), F.lit(True).alias("__hit"))
    joined = df.join(mapping, q(col) == F.col("__code"), "left")
    rest = q(col).cast(out_type) if other == "keep" else F.lit(None).cast(out_type)
    kind = dict(mapping.dtypes)["__new"]
    new = value_text(F.col("__new"), T.DoubleType()) if isinstance(out_type, T.StringType) and kind in ("double", "float") else F.col("__new").cast(out_type)
    expr = F.when(F.col("__hit"), new).otherwise(rest)
    return joined.select(*[expr.alias(c) if c == col else q(c) for c in df.columns])


def _known(df: DataFrame, col: str, target: Any) -> list[tuple[Any, str]]:
    """The labels of a set that ``target`` (a Lbl or a value) names by value or text, in order: what ``fill_lbl`` needs of it."""
    goal = target if isinstance(target, Lbl) else Lbl(val=target)
    rows, dt = label_rows(df, col), df.schema[col].dataType
    hit = F.lit(False)
    if goal.val is not None and isinstance(goal.val, str) == isinstance(dt, T.StringType):
        hit = hit | (F.col("val") == F.lit(_code(goal.val, dt)))
    if goal.val is None and goal.lbl is not None:
        hit = hit | (F.col("lbl") == goal.lbl)
    return [(_plain(r["val"]), r["lbl"]) for r in rows.where(hit).orderBy("val").limit(1).collect()]


def _stored_set(df: DataFrame, col: str) -> bool:
    return LABEL_TABLE in get_meta(df, col).other


# ---------------------------------------------------------------- operators

def lbl_na_if(df: DataFrame, col: str, rule: Rule) -> DataFrame:
    """Values whose label row satisfies the rule become NULL and lose their label.

    Only labelled values are looked at; values without a label stay.
    """
    meta = get_meta(df, col)
    if _stored_set(df, col):
        rows = _for_rules(df, col)
        rows = rows.withColumn("__hit", _rule_column(rule, F.col("val"), F.col("lbl")).cast("boolean"))
        if not rows.where("__hit IS NULL").isEmpty():
            raise ValueError("the rule is NULL for some labels")
        dt = df.schema[col].dataType
        gone = rows.where("__hit").select("__key", F.lit(None).cast(dt).alias("__new"))
        return _with_rows(_recode_by_rows(df, col, gone, dt, other="keep"), df, col, meta, rows.where("NOT __hit").select(F.col("__key").alias("val"), "lbl"))
    hits = apply_rule(df, meta.val_labels, rule)
    if any(h is None for h in hits):
        raise ValueError("the rule is NULL for some labels")
    dt = df.schema[col].dataType
    zap = [_code(v, dt) for (v, _), h in zip(meta.val_labels, hits) if h]
    kept = [p for p, h in zip(meta.val_labels, hits) if not h]
    if not zap:
        return df
    if len(zap) > INLINE_CODES:
        out = recode(df, col, [(v, None) for v in zap], dt, other="keep")
    else:
        x = q(col)
        out = df.select(*[F.when(~x.isin(zap), x).alias(c) if c == col else q(c) for c in df.columns])
    return _finish(out, df, col, meta.with_labels(kept))


def lbl_collapse(df: DataFrame, col: str, rule: Rule, keep_unlabelled: bool = False) -> DataFrame:
    """New code = rule(val, lbl).

    A new code keeps the label it had before, if it had one; otherwise it takes the label of
    the smallest old code that moved into it. Values without a label become NULL (or stay,
    with ``keep_unlabelled``).
    """
    meta = get_meta(df, col)
    if _stored_set(df, col):
        rows = _for_rules(df, col)
        rows = rows.withColumn("__new", _rule_column(rule, F.col("val"), F.col("lbl")))
        dt = _rows_type(df.schema[col].dataType, rows, "__new")
        kinds = dict(rows.dtypes)
        new = F.col("__new").cast("int") if kinds["__new"] == "boolean" else F.col("__new")
        moved = F.col("__key") != new if (kinds["__key"] == "string") == (kinds["__new"] == "string") else F.lit(True)
        best = rows.where("__new IS NOT NULL").groupBy(F.col("__new").alias("val")).agg(F.min(F.struct(moved.alias("m"), "__key", "lbl")).alias("b"))
        return _with_rows(_recode_by_rows(df, col, rows, dt, other="keep" if keep_unlabelled else "null"), df, col, meta, best.select("val", F.col("b.lbl").alias("lbl")))
    new = [_plain(v) for v in apply_rule(df, meta.val_labels, rule)]
    dt = _out_type(df.schema[col].dataType, new)
    best: dict[Any, tuple] = {}
    for (v, text), n in zip(meta.val_labels, new):
        if n is None:
            continue
        rank = (v != n, *_sort_key((v,)))
        if n not in best or rank < best[n][0]:
            best[n] = (rank, text)
    labels = sorted(((n, text) for n, (_, text) in best.items()), key=_sort_key)
    mapping = [(v, n) for (v, _), n in zip(meta.val_labels, new)]
    out = recode(df, col, mapping, dt, other="keep" if keep_unlabelled else "null")
    return _finish(out, df, col, meta.with_labels(labels))


def lbl_relabel(df: DataFrame, col: str, *rules: tuple[Any, Rule]) -> DataFrame:
    """Ordered rules ``(target, predicate)``; every predicate sees the original codes and
    labels, the last match wins. Values without a label become NULL.
    """
    meta = get_meta(df, col)
    if not meta.labelled:
        raise ValueError("the column has no labels; lbl_define() gives it some")
    if _stored_set(df, col):
        rows = _for_rules(df, col)
        goals = [fill_lbl(target, _known(df, col, target)) for target, _ in rules]
        text = any(isinstance(g.val, str) for g in goals) or dict(rows.dtypes)["val"] == "string"
        shown = value_text(F.col("val"), rows.schema["val"].dataType) if text else F.col("val")
        value, lbl = shown, F.col("lbl")
        for goal, (_, rule) in zip(goals, rules):
            hit = F.coalesce(_rule_column(rule, F.col("val"), F.col("lbl")).cast("boolean"), F.lit(False))
            value = F.when(hit, F.lit(str(_plain(goal.val)) if text else _plain(goal.val))).otherwise(value)
            lbl = F.when(hit, F.lit(goal.lbl)).otherwise(lbl)
        rows = rows.select("__key", value.alias("__new"), lbl.alias("__lbl"))
        labels = rows.select(F.col("__new").alias("val"), F.col("__lbl").alias("lbl")).distinct()
        double = labels.groupBy("val").agg(F.min("lbl").alias("lo"), F.max("lbl").alias("hi")).where("lo <> hi").limit(10).collect()
        if double:
            raise ValueError("values with several labels: " + ", ".join(f"{_plain(r['val'])} -> '{r['lo']}', '{r['hi']}'" for r in double))
        dt = _rows_type(df.schema[col].dataType, rows, "__new")
        return _with_rows(_recode_by_rows(df, col, rows, dt), df, col, meta, labels)
    old = list(meta.val_labels)
    new: list[tuple[Any, str]] = list(old)
    for target, rule in rules:
        goal = fill_lbl(target, old)
        for i, hit in enumerate(apply_rule(df, old, rule)):
            if hit:
                new[i] = (_plain(goal.val), goal.lbl)
    labels = _unique_or_fail([(_plain(v), t) for v, t in new])
    dt = _out_type(df.schema[col].dataType, [v for v, _ in new])
    out = recode(df, col, [(o[0], n[0]) for o, n in zip(old, new)], dt)
    return _finish(out, df, col, meta.with_labels(labels))


def lbl_define(df: DataFrame, col: str, *rules: tuple[Any, Rule]) -> DataFrame:
    """Make a labelled column out of a plain one; values that no rule matches are kept.

    Predicates run on the data column itself. One aggregate finds the rules that matched at
    all and target codes that collide with an unmatched value (an error: that code would
    have both a label and none).
    """
    meta = get_meta(df, col)
    if meta.labelled:
        raise ValueError("the column has labels already; lbl_relabel() changes them")
    goals = []
    for target, _ in rules:
        goal = target if isinstance(target, Lbl) else Lbl(val=target)
        if goal.val is None:
            raise ValueError(f"the target {goal.lbl!r} needs a value")
        goals.append(goal)
    old_type = df.schema[col].dataType
    x = q(col)
    view = df.select(x.alias("val"), F.lit(None).cast("string").alias("lbl"))
    which = None
    for i in reversed(range(len(rules))):
        hit = _rule_column(rules[i][1], F.col("val"), F.col("lbl"))
        which = F.when(hit, F.lit(i)) if which is None else which.when(hit, F.lit(i))
    if which is None:
        return df
    same_kind = [g.val for g in goals if isinstance(g.val, str) == isinstance(old_type, T.StringType)]
    codes = [_code(v, old_type) for v in same_kind]
    clash = F.col("__which").isNull() & F.col("val").isin(codes) if codes else F.lit(False)
    found = (
        view.select("val", which.alias("__which"))
        .agg(F.collect_set("__which").alias("used"), F.collect_set(F.when(clash, F.col("val"))).alias("clash"))
        .first()
    )
    if found["clash"]:
        raise ValueError("target codes that unmatched rows hold as plain values: "
                         + ", ".join(str(_plain(v)) for v in sorted(found["clash"])))
    used = [goals[i] for i in sorted(found["used"])]
    labels = [p for p in _unique_or_fail([(_plain(g.val), g.lbl) for g in used]) if p[1] is not None]
    dt = T.StringType() if isinstance(old_type, T.StringType) else _out_type(old_type, [g.val for g in goals])
    # ``val`` and ``lbl`` are bound next to the other columns, so all rule forms work alike.
    names = [f"__c{i}" for i in range(len(df.columns))]
    bound = df.select(*[q(c).alias(n) for c, n in zip(df.columns, names)],
                      x.alias("val"), F.lit(None).cast("string").alias("lbl"))
    expr = None
    for i in reversed(range(len(rules))):
        hit = _rule_column(rules[i][1], F.col("val"), F.col("lbl"))
        value = F.lit(_code(goals[i].val, dt)).cast(dt)
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    if isinstance(dt, T.StringType):
        keep = value_text(F.col("val"), old_type)
    else:
        keep = F.col("val").cast(dt)
    new = F.when(F.col("val").isNotNull(), expr.otherwise(keep))
    out = bound.select(*[new.alias(c) if c == col else F.col(n).alias(c) for c, n in zip(df.columns, names)])
    return _finish(out, df, col, meta.with_labels(labels))


def lbl_add(df: DataFrame, col: str, *labels: Any) -> DataFrame:
    """Add labels for given values; the data stay as they are."""
    meta = get_meta(df, col)
    if _stored_set(df, col):
        goals = [fill_lbl(new, _known(df, col, new)) for new in labels]
        added = _unique_or_fail([p for g in goals for p in [*_known(df, col, g.val), (_plain(g.val), g.lbl)]])
        return _with_rows(df, df, col, meta, label_rows(with_meta(df, {col: meta.with_labels([*meta.val_labels, *added])}), col))
    current = list(meta.val_labels)
    for new in labels:
        goal = fill_lbl(new, current)
        current = _unique_or_fail([(_plain(v), t) for v, t in current] + [(_plain(goal.val), goal.lbl)])
    return with_meta(df, {col: meta.with_labels(current)})


def value_text(x: Column, dt: T.DataType) -> Column:
    """A code as text; whole doubles without the ".0"."""
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        whole = (x == F.floor(x)) & (F.abs(x) < 1e15)
        return F.when(whole, x.cast("bigint").cast("string")).otherwise(x.cast("string"))
    return x.cast("string")


def _as_labeller(labeller, dt: T.DataType):
    if labeller is None:
        return value_text(F.col("val"), dt)
    if isinstance(labeller, str):
        return F.expr(labeller)
    return labeller(F.col("val"))


def unlabelled_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of the column that have no label, as a table ``(val)``."""
    dt = df.schema[col].dataType
    known = [_code(v, dt) for v, _ in get_meta(df, col).val_labels]
    vals = df.select(q(col).alias("val")).filter(F.col("val").isNotNull())
    if _stored_set(df, col):
        return vals.distinct().join(label_rows(df, col).select("val"), "val", "left_anti").select(F.col("val").cast(dt).alias("val"))
    if 0 < len(known) <= INLINE_CODES:
        return vals.filter(~F.col("val").isin(known)).distinct()
    if known:
        return vals.join(_code_table(df, col, get_meta(df, col)), "val", "left_anti").distinct()
    return vals.distinct()


def label_table_for_values(df: DataFrame, col: str, labeller=None) -> DataFrame:
    """``(val, lbl)`` for all unlabelled values as a table: the form for sets too large for
    metadata. Use with :func:`decode_with_table`."""
    dt = df.schema[col].dataType
    return unlabelled_values(df, col).select("val", _as_labeller(labeller, dt).alias("lbl"))


def lbl_add_vals(df: DataFrame, col: str, labeller=None, vals: list | None = None) -> DataFrame:
    """Label values that have none: the given ones, or all distinct unlabelled values.

    ``labeller`` maps the column ``val`` to text (a function of a column, or SQL text). Up to MAX_NEW_LABELS new labels join the
    column's metadata. More are written as a table to the shared folder and the metadata name it; all operators
    here read both (:func:`label_rows`), so any number of values can be labelled.
    """
    meta = get_meta(df, col)
    dt = df.schema[col].dataType
    old = [(_plain(v), t) for v, t in meta.val_labels]
    if vals is None:
        table = label_table_for_values(df, col, labeller)
        if _stored_set(df, col):
            have = label_rows(df, col)
            return _with_rows(df, df, col, meta, have.unionByName(table.withColumn("val", F.col("val").cast(dict(have.dtypes)["val"]))))
        rows = table.limit(MAX_NEW_LABELS + 1).collect()
        if len(rows) > MAX_NEW_LABELS:
            path = scratch_path(df.sparkSession, "labels")
            table.write.parquet(path)
            return with_meta(df, {col: replace(meta, other={**meta.other, LABEL_TABLE: path})})
        new = [(_plain(r["val"]), r["lbl"]) for r in rows]
    else:
        known = {v for v, _ in old}
        wanted = [_plain(v) for v in vals]
        if any(v in known or _stored_set(df, col) and _known(df, col, v) for v in wanted):
            raise ValueError("some of the values are labelled already")
        kind = pa.string() if isinstance(dt, T.StringType) else pa.float64() if not is_integral(dt) else pa.int64()
        table = pa.table({"val": pa.array([_code(v, dt) for v in wanted], kind)})
        frame = df.sparkSession.createDataFrame(table).select("val", _as_labeller(labeller, dt).alias("lbl"))
        new = [(_plain(r["val"]), r["lbl"]) for r in frame.collect()]
        if _stored_set(df, col):
            return _with_rows(df, df, col, meta, label_rows(df, col).unionByName(frame))
    return with_meta(df, {col: meta.with_labels(sorted(old + new, key=_sort_key))})


def lbl_clean(df: DataFrame, cols: str | list[str] | None = None) -> DataFrame:
    """Drop labels whose value does not occur; all ordinary columns in one aggregate.

    Each collected set holds at most the labels of its column. Columns with long code lists
    are joined with their list instead.
    """
    wanted = [cols] if isinstance(cols, str) else cols if cols is not None else labelled_columns(df)
    metas = {c: get_meta(df, c) for c in wanted}
    stored = [c for c, m in metas.items() if LABEL_TABLE in m.other]
    for c in stored:
        used_rows = label_rows(df, c).join(df.select(q(c).alias("val")).distinct(), "val", "left_semi")
        df = _with_rows(df, df, c, metas[c], used_rows)
    metas = {c: m for c, m in metas.items() if m.labelled and c not in stored}
    used: dict[str, set] = {}
    short = [c for c, m in metas.items() if len(m.val_labels) <= INLINE_CODES]
    if short:
        aggs = []
        for i, c in enumerate(short):
            known = [_code(v, df.schema[c].dataType) for v, _ in metas[c].val_labels]
            aggs.append(F.collect_set(F.when(q(c).isin(known), q(c))).alias(f"s{i}"))
        row = df.agg(*aggs).first()
        used = {c: {_plain(v) for v in row[f"s{i}"]} for i, c in enumerate(short)}
    for c, m in metas.items():
        if c not in used:
            found = df.select(q(c).alias("val")).join(_code_table(df, c, m), "val", "left_semi").distinct()
            used[c] = {_plain(r["val"]) for r in found.collect()}
    return with_meta(df, {c: m.with_labels([p for p in m.val_labels if _plain(p[0]) in used[c]]) for c, m in metas.items()})


def _code_table(df: DataFrame, col: str, meta: VarMeta) -> DataFrame:
    """The codes of a label set as a table ``(val)``; as large as the metadata it comes from."""
    dt = df.schema[col].dataType
    kind = pa.string() if isinstance(dt, T.StringType) else pa.int64() if is_integral(dt) else pa.float64()
    codes = list(dict.fromkeys(_code(v, dt) for v, _ in meta.val_labels))
    return _code_frame(df, pa.table({"val": pa.array(codes, kind)}))


# ---------------------------------------------------------------- decoding and stripping

def _texts(meta: VarMeta, levels: str) -> list[tuple[Any, str]]:
    if levels == "both":
        return [(v, f"[{_plain(v)}] {t}") for v, t in meta.val_labels]
    if levels == "values":
        return [(v, str(_plain(v))) for v, _ in meta.val_labels]
    return list(meta.val_labels)


def label_expr(df: DataFrame, col: str, levels: str = "default") -> Column:
    """Label text of a coded column as an expression (short code lists)."""
    dt = df.schema[col].dataType
    meta = get_meta(df, col)
    x = q(col)
    rest = F.lit(None).cast("string") if levels == "labels" else value_text(x, dt)
    if LABEL_TABLE in meta.other and levels != "values":
        raise ValueError(f"the labels of {col} are a table: as_factor() joins it")
    if levels == "values" or not meta.val_labels:
        return rest
    text = lookup(x, dt, [(_code(v, dt), t) for v, t in _texts(meta, levels)], T.StringType())
    return text if levels == "labels" else F.coalesce(text, rest)


def as_factor(df: DataFrame, cols: str | list[str] | None = None, levels: str = "default",
              keep_codes: bool = False) -> DataFrame:
    """Codes to label text, for the given or all labelled columns.

    ``levels``: "default" (label, else the value), "labels" (else NULL), "values", "both"
    ("[1] Yes"). The level order is kept in the metadata; ``keep_codes`` also keeps the code
    as ``<col>_code`` to order by.
    """
    if levels not in ("default", "labels", "values", "both"):
        raise ValueError("levels must be one of default, labels, values, both")
    wanted = [cols] if isinstance(cols, str) else cols if cols is not None else labelled_columns(df)
    metas = all_meta(df)
    new_meta = dict(metas)
    out = df
    exprs: dict[str, Column] = {}
    for c in wanted:
        meta = metas[c]
        ordered = sorted(_texts(meta, levels), key=_sort_key)
        new_meta[c] = replace(meta, val_labels=(), levels=tuple(dict.fromkeys(t for _, t in ordered)))
        if LABEL_TABLE in meta.other and levels != "values":
            new_meta[c] = replace(new_meta[c], other={k: v for k, v in meta.other.items() if k != LABEL_TABLE})
            out, exprs[c] = _decode_by_stored(df, out, c, meta, levels)
            continue
        if len(meta.val_labels) <= INLINE_CODES or levels == "values":
            exprs[c] = label_expr(df, c, levels)
            continue
        out = recode(out, c, _texts(meta, levels), T.StringType(), out=f"__lbl_{c}")
        rest = F.lit(None).cast("string") if levels == "labels" else value_text(q(c), df.schema[c].dataType)
        exprs[c] = F.coalesce(q(f"__lbl_{c}"), rest)
    select = []
    for c in df.columns:
        if c in exprs:
            if keep_codes:
                select.append(q(c).alias(f"{c}_code"))
            select.append(exprs[c].alias(c))
        else:
            select.append(q(c))
    return with_meta(out.select(*select), new_meta)


def _decode_by_stored(df: DataFrame, out: DataFrame, c: str, meta: VarMeta, levels: str) -> tuple[DataFrame, Column]:
    """Label text of a column whose further labels are a stored table; its own labels come first."""
    dt = df.schema[c].dataType
    text = value_text(q(c), dt)
    out = recode(out, c, list(meta.val_labels), T.StringType(), out=f"__own_{c}")
    stored = df.sparkSession.read.parquet(meta.other[LABEL_TABLE]).select(F.col("val").alias(f"__val_{c}"), F.col("lbl").alias(f"__more_{c}"))
    out = out.join(stored, q(c) == q(f"__val_{c}"), "left").drop(f"__val_{c}")
    found = F.coalesce(q(f"__own_{c}"), q(f"__more_{c}"))
    if levels == "both":
        found = F.concat(F.lit("["), text, F.lit("] "), found)
    return out, found if levels == "labels" else F.coalesce(found, text)


def decode_with_table(df: DataFrame, col: str, label_table: DataFrame, out: str | None = None) -> DataFrame:
    """Label text by joining a ``(val, lbl)`` table of any size.

    Left without a hint: Spark broadcasts the table when its statistics allow and sorts and
    merges otherwise (left joins are split on skewed codes at run time).
    """
    target = out or col
    dt = df.schema[col].dataType
    table = label_table.select(F.col("val").alias("__val"), F.col("lbl").alias("__lbl"))
    joined = df.join(table, q(col) == F.col("__val"), "left")
    expr = F.coalesce(F.col("__lbl"), value_text(q(col), dt))
    names = df.columns if target in df.columns else [*df.columns, target]
    return with_meta(joined.select(*[expr.alias(target) if c == target else q(c) for c in names]),
                     {c: m for c, m in all_meta(df).items() if c != target})


def zap_labels(df: DataFrame, cols: str | list[str] | None = None) -> DataFrame:
    """Remove value labels (variable label and description stay)."""
    wanted = [cols] if isinstance(cols, str) else cols if cols is not None else df.columns
    return with_meta(df, {c: _unstored(get_meta(df, c)).with_labels(()) for c in wanted})


def zap_attributes(df: DataFrame, cols: str | list[str] | None = None) -> DataFrame:
    """Remove value labels, variable label and description."""
    wanted = [cols] if isinstance(cols, str) else cols if cols is not None else df.columns
    return with_meta(df, {c: VarMeta(other=_unstored(get_meta(df, c)).other) for c in wanted})


# ---------------------------------------------------------------- attaching codebook metadata

def longest_labels(label_table: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One label per key: the longest, the first in ``order`` on ties.

    ``row_number() = 1`` is cut to one row per key before the shuffle, so a value with very
    many labels does not pile up in one task.
    """
    w = Window.partitionBy(*keys).orderBy(F.length("lbl").desc(), *[F.col(c) for c in order])
    return label_table.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def duplicate_labels(label_table: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, lbl)`` of every key that has more than one distinct label, one row per label.

    Such keys have different smallest and largest labels, which aggregates partially; no
    list of labels is built, so a key may have any number of them.
    """
    from .joins import skew_join
    rows = label_table.select(*keys, "lbl").distinct()
    many = label_table.groupBy(*keys).agg(F.min("lbl").alias("lo"), F.max("lbl").alias("hi")).filter("lo <> hi")
    many = many.select(*[q(k).alias(f"__{k}") for k in keys])
    return skew_join(rows, many, keys, [f"__{k}" for k in keys], "left_semi")


def _longest_per_value(pairs) -> list[tuple[Any, str]]:
    out: dict[Any, str] = {}
    for v, text in pairs:
        v = _plain(v)
        if v not in out or len(text) > len(out[v]):
            out[v] = text
    return list(out.items())


def set_attributes(df: DataFrame, variables, var_attrs=ALL_ATTRS) -> DataFrame:
    """Attach labels and descriptions of a codebook (or list of variables) to a table.

    Variables that the table lacks are skipped. Text labels on a number column (or the other
    way round) are an error. A value with several labels keeps the longest. Labels that the
    table has already stay where the codebook gives none.
    """
    variables = getattr(variables, "variables", variables)
    if not variables or not var_attrs:
        return df
    attrs = (var_attrs,) if isinstance(var_attrs, str) else tuple(var_attrs)
    unknown = set(attrs) - set(ALL_ATTRS)
    if unknown:
        raise ValueError(f"Unknown attributes: {sorted(unknown)}; expected some of {ALL_ATTRS}")
    present = [v for v in variables if v.name in df.columns]
    bad = []
    if "val_labels" in attrs:
        for v in present:
            if v.val_labels:
                label_is_num = not any(isinstance(a, str) for a, _ in v.val_labels)
                if label_is_num != is_numeric(df.schema[v.name].dataType):
                    bad.append(v.name)
    if bad:
        raise TypeError("text labels for number columns, or the other way round: " + ", ".join(dict.fromkeys(bad)))
    new = {}
    for v in present:
        old = new.get(v.name) or get_meta(df, v.name)
        new[v.name] = VarMeta(
            label=v.label if "var_label" in attrs else None,
            var_desc=v.desc if "var_desc" in attrs else None,
            val_labels=tuple(_longest_per_value(v.val_labels)) if "val_labels" in attrs and v.val_labels else old.val_labels,
            other=old.other,
        )
    return with_meta(df, new)
