"""Column metadata: variable label, description, value labels, factor levels.

Values are stored unlabelled; what they mean travels in ``StructField.metadata``:

    {"label": str, "var_desc": str,
     "val_labels": [{"val": 10, "lbl": "Yes"}, ...], "levels": ["Yes", ...]}

Expressions, full joins and some unions lose field metadata, so every operator of this
package sets it in its last projection through :func:`with_meta`.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The three attribute groups a reader can attach.
ALL_ATTRS = ("val_labels", "var_label", "var_desc")
_KEYS = ("label", "var_desc", "val_labels", "levels")


@dataclass(frozen=True)
class Lbl:
    """A (value, label) pair where one half may be left open (see :func:`fill_lbl`)."""

    val: Any = None
    lbl: str | None = None


def lbl(*args: Any, **kwargs: Any) -> Lbl:
    """``lbl(label)``, ``lbl(val=value)`` or ``lbl(value, label)``.

    With two arguments of which one is named, the other one takes the free place.
    """
    unknown = set(kwargs) - {"val", "lbl"}
    if unknown:
        raise ValueError("lbl() knows the names `val` and `lbl` only")
    total = len(args) + len(kwargs)
    if total not in (1, 2):
        raise ValueError("lbl() takes one or two arguments")
    if total == 1:
        return Lbl(val=kwargs.get("val"), lbl=kwargs["lbl"] if "lbl" in kwargs else (args[0] if args else None))
    if not kwargs:
        return Lbl(val=args[0], lbl=args[1])
    if "val" in kwargs:
        return Lbl(val=kwargs["val"], lbl=kwargs.get("lbl", args[0] if args else None))
    return Lbl(val=args[0], lbl=kwargs["lbl"])


def fill_lbl(target: Any, labels: list[tuple[Any, str]]) -> Lbl:
    """Complete an open half of ``target`` from an existing label set."""
    target = target if isinstance(target, Lbl) else Lbl(val=target)
    if target.val is None and target.lbl is None:
        raise ValueError("a target needs a value or a label")
    if target.lbl is None:
        for v, text in labels:
            if v == target.val:
                return Lbl(target.val, text)
        raise ValueError(f"value {target.val} has no label that could be taken over")
    if target.val is None:
        for v, text in labels:
            if text == target.lbl:
                return Lbl(v, target.lbl)
        raise ValueError(f"no value is labelled {target.lbl!r}")
    return target


LABEL_TABLE = "label_table"  # metadata key of the path of labels that are too many for metadata


@dataclass(frozen=True)
class VarMeta:
    """Everything known about one column besides its values."""

    label: str | None = None
    var_desc: str | None = None
    val_labels: tuple[tuple[Any, str], ...] = ()
    levels: tuple[str, ...] | None = None
    other: dict = field(default_factory=dict, compare=False)

    @property
    def labelled(self) -> bool:
        return len(self.val_labels) > 0 or LABEL_TABLE in self.other

    def with_labels(self, pairs) -> VarMeta:
        return replace(self, val_labels=tuple(pairs))

    def to_dict(self) -> dict:
        out = dict(self.other)
        if self.label is not None:
            out["label"] = self.label
        if self.var_desc is not None:
            out["var_desc"] = self.var_desc
        if self.val_labels:
            out["val_labels"] = [{"val": v, "lbl": t} for v, t in self.val_labels]
        if self.levels is not None:
            out["levels"] = list(self.levels)
        return out

    @staticmethod
    def from_dict(d: dict) -> VarMeta:
        return VarMeta(
            label=d.get("label"),
            var_desc=d.get("var_desc"),
            val_labels=tuple((p["val"], p["lbl"]) for p in d.get("val_labels", [])),
            levels=tuple(d["levels"]) if "levels" in d else None,
            other={k: v for k, v in d.items() if k not in _KEYS},
        )


def get_meta(df: DataFrame, col: str) -> VarMeta:
    return VarMeta.from_dict(df.schema[col].metadata or {})


def all_meta(df: DataFrame) -> dict[str, VarMeta]:
    return {f.name: VarMeta.from_dict(f.metadata or {}) for f in df.schema.fields}


def q(name: str) -> Column:
    """Column by exact name, also when it holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_meta(df: DataFrame, metas: dict[str, VarMeta]) -> DataFrame:
    """Set the metadata of the named columns in one projection."""
    hit = {c: m for c, m in metas.items() if c in df.columns}
    if not hit:
        return df
    return df.select(
        *[q(c).alias(c, metadata=hit[c].to_dict()) if c in hit else q(c) for c in df.columns]
    )


def is_labelled(df: DataFrame, col: str) -> bool:
    """Does the column carry value labels?"""
    return get_meta(df, col).labelled


def labelled_columns(df: DataFrame) -> list[str]:
    return [c for c, m in all_meta(df).items() if m.labelled]


def is_factor(df: DataFrame, col: str) -> bool:
    """Was the column made by decoding labels (text with ordered levels)?"""
    return get_meta(df, col).levels is not None


def is_integral(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def is_numeric(dt: T.DataType) -> bool:
    return is_integral(dt) or isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType))


def meta_json(df: DataFrame) -> str:
    """All column metadata as JSON text (for logs and for tests)."""
    return json.dumps({c: m.to_dict() for c, m in all_meta(df).items()}, default=str, sort_keys=True)
