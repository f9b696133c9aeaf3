"""Case selection, conditional recodes and binning."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import is_in
from ..metadata import get_meta, q, with_meta


def select_cases(df: DataFrame, col: str, codes: list) -> DataFrame:
    """Rows whose code is listed; a plain filter, pushed down to columnar sources."""
    return df.filter(q(col).isin(codes))


def case_when(*branches: tuple[Column, Any], otherwise: Any = None) -> Column:
    """First true branch wins."""
    expr = None
    for cond, value in branches:
        value = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


def null_if(x: Column, values: list) -> Column:
    """Listed values become NULL."""
    return F.when(~is_in(x, values), x)


def cut(x: Column, breaks: list[float], labels: list[str] | None = None, include_lowest: bool = False) -> Column:
    """Bin into right-closed intervals ``(a, b]``; with ``include_lowest`` the first is ``[a, b]``."""
    edges = sorted(breaks)
    names = labels or [f"({a},{b}]" for a, b in zip(edges, edges[1:])]
    if len(names) != len(edges) - 1:
        raise ValueError("need one label per interval")
    expr = None
    for i, (a, b, name) in enumerate(zip(edges, edges[1:], names)):
        low = (x >= a) if i == 0 and include_lowest else (x > a)
        expr = F.when(low & (x <= b), name) if expr is None else expr.when(low & (x <= b), name)
    return expr


def harmonise(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select columns under new names (``{new: old}``), keeping their metadata."""
    metas = {new: get_meta(df, old) for new, old in columns.items()}
    return with_meta(df.select(*[q(old).alias(new) for new, old in columns.items()]), metas)
