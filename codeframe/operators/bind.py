"""Unions that look after column metadata and column types."""

from __future__ import annotations

import warnings
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..metadata import VarMeta, all_meta, is_integral, is_numeric, q, with_meta


class AttributesDropped(UserWarning):
    """Columns lost their metadata because the bound tables disagree on it."""


def _flatten(frames) -> list[tuple[str | None, DataFrame]]:
    out: list[tuple[str | None, DataFrame]] = []
    if isinstance(frames, dict):
        for k, v in frames.items():
            if isinstance(v, DataFrame):
                out.append((k, v))
            else:
                out.extend(_flatten(v))
        return out
    for f in frames:
        if isinstance(f, DataFrame):
            out.append((None, f))
        elif isinstance(f, (dict, Iterable)):
            out.extend(_flatten(f))
        else:
            raise TypeError(f"cannot bind a {type(f).__name__}")
    return out


def _common_type(a: T.DataType, b: T.DataType, col: str) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if is_integral(a) and is_integral(b):
        return T.LongType()
    if is_numeric(a) and is_numeric(b):
        return T.DoubleType()
    raise TypeError(f"column {col} is {a.simpleString()} in one table and {b.simpleString()} in another")


def bind_rows(*frames, id: str | None = None) -> DataFrame:
    """Stack tables by column name; missing columns are NULL.

    A column keeps its metadata only if all tables that have it agree; otherwise it is
    dropped with a warning. Lists and dicts of tables may be nested. ``id`` names a source
    column holding the dict key or the position (as text).
    """
    parts = _flatten(frames)
    if not parts:
        raise ValueError("nothing to bind")
    names = list(dict.fromkeys(c for _, f in parts for c in f.columns))
    types: dict[str, T.DataType] = {}
    metas: dict[str, VarMeta | None] = {}
    for _, f in parts:
        for c, m in all_meta(f).items():
            dt = f.schema[c].dataType
            types[c] = _common_type(types[c], dt, c) if c in types else dt
            if c not in metas:
                metas[c] = m
            elif metas[c] is not None and metas[c] != m:
                metas[c] = None
    lost = [c for c, m in metas.items() if m is None]
    if lost:
        warnings.warn(
            "metadata dropped where the tables disagree on it: " + ", ".join(lost),
            AttributesDropped, stacklevel=2)
    plain = []
    for i, (key, f) in enumerate(parts):
        cols = [q(c).cast(types[c]).alias(c, metadata={}) if c in f.columns else F.lit(None).cast(types[c]).alias(c)
                for c in names]
        if id is not None:
            cols.insert(0, F.lit(key if key is not None else str(i + 1)).alias(id))
        plain.append(f.select(*cols))
    return with_meta(_union(plain), {c: m for c, m in metas.items() if m is not None})


def bind_layers(layers: dict[str, DataFrame], add_layer: bool | None = None) -> DataFrame:
    """Stack boundary layers: a column must have one type in all layers that have it.

    Missing text, double and geometry columns become NULL; other missing types are an error.
    The layer name is added as ``layer``, by default when there is more than one layer.
    """
    if not layers:
        raise ValueError("no layers")
    add = len(layers) > 1 if add_layer is None else add_layer
    types: dict[str, set[str]] = {}
    for f in layers.values():
        for fld in f.schema.fields:
            types.setdefault(fld.name, set()).add(fld.dataType.simpleString())
    if any(len(t) > 1 for t in types.values()):
        bad = ", ".join(sorted(c for c, t in types.items() if len(t) > 1))
        raise TypeError(f"layers disagree on the type of {bad}")
    for c, t in types.items():
        if any(c not in f.columns for f in layers.values()) and next(iter(t)) not in ("string", "double", "binary"):
            raise TypeError(f"a layer lacks {c}, and {next(iter(t))} columns are not filled up")
    tagged = [f.withColumn("layer", F.lit(k)) if add else f for k, f in layers.items()]
    if len(tagged) == 1:
        return tagged[0]
    metas: dict[str, VarMeta] = {}
    for f in tagged:
        for c, m in all_meta(f).items():
            metas.setdefault(c, m)
    return with_meta(_union(tagged), metas)


def _union(frames: list[DataFrame]) -> DataFrame:
    """Union by name, built as a balanced tree so that the plan of many tables stays shallow."""
    while len(frames) > 1:
        pairs = [frames[i:i + 2] for i in range(0, len(frames), 2)]
        frames = [p[0].unionByName(p[1], allowMissingColumns=True) if len(p) == 2 else p[0] for p in pairs]
    return frames[0]
