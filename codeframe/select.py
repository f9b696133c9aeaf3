"""Name selection: lists of names and matchers such as ``starts_with("WT")``.

A selection is a name, a matcher, or a (nested) list of them; ``exclude`` drops names from what
stands before it, or from all. Matching ignores case unless told otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .metadata import all_meta, q, with_meta


@dataclass(frozen=True)
class Matcher:
    """Chooses among names on the driver, or among rows of a name column on the cluster."""

    names: Callable[[Sequence[str]], list[str]]
    rows: Callable[[Column], Column]
    minus: Selection = None  # what an exclusion takes away

    def __call__(self, names: Sequence[str]) -> list[str]:
        return self.names(names)


Selection = Union[None, str, Matcher, Iterable]


def _by_test(test: Callable[[str], bool], rows: Callable[[Column], Column]) -> Matcher:
    return Matcher(lambda names: [n for n in names if test(n)], rows)


def _fold(s: str, ignore_case: bool) -> str:
    return s.lower() if ignore_case else s


def _fold_col(c: Column, ignore_case: bool) -> Column:
    return F.lower(c) if ignore_case else c


def starts_with(*prefixes: str, ignore_case: bool = True) -> Matcher:
    want = tuple(_fold(p, ignore_case) for p in prefixes)
    return _by_test(lambda n: _fold(n, ignore_case).startswith(want),
                    lambda c: reduce(or_, [_fold_col(c, ignore_case).startswith(p) for p in want]))


def ends_with(*suffixes: str, ignore_case: bool = True) -> Matcher:
    want = tuple(_fold(p, ignore_case) for p in suffixes)
    return _by_test(lambda n: _fold(n, ignore_case).endswith(want),
                    lambda c: reduce(or_, [_fold_col(c, ignore_case).endswith(p) for p in want]))


def contains(*parts: str, ignore_case: bool = True) -> Matcher:
    want = [_fold(p, ignore_case) for p in parts]
    return _by_test(lambda n: any(p in _fold(n, ignore_case) for p in want),
                    lambda c: reduce(or_, [_fold_col(c, ignore_case).contains(p) for p in want]))


def matches(pattern: str, ignore_case: bool = True) -> Matcher:
    rx = re.compile(pattern, re.IGNORECASE if ignore_case else 0)
    return _by_test(lambda n: rx.search(n) is not None, lambda c: c.rlike(("(?i)" if ignore_case else "") + pattern))


def num_range(prefix: str, numbers: Iterable[int], width: int | None = None) -> Matcher:
    want = [prefix + (str(i).zfill(width) if width else str(i)) for i in numbers]
    return Matcher(lambda names: [n for n in want if n in set(names)], lambda c: c.isin(want))


def one_of(*wanted) -> Matcher:
    """The names that exist; unknown ones are passed over."""
    flat = [x for w in wanted for x in ([w] if isinstance(w, str) else w)]
    return Matcher(lambda names: [n for n in flat if n in names], lambda c: c.isin(flat))


def everything() -> Matcher:
    return _by_test(lambda n: True, lambda c: F.lit(True))


def exclude(selection: Selection) -> Matcher:
    """All names but those selected; behind another part of a list, takes them away from what that part chose."""
    return Matcher(lambda names: [n for n in names if n not in set(pick(names, selection))],
                   lambda c: ~row_condition(c, selection), selection)


def row_condition(c: Column, selection: Selection) -> Column:
    """A selection as a filter on a column of names; nothing is collected."""
    if selection is None:
        return F.lit(True)
    if isinstance(selection, str):
        return c == selection
    if isinstance(selection, Matcher):
        return selection.rows(c)
    out = None
    for part in selection:
        hit = row_condition(c, part)
        taken_away = isinstance(part, Matcher) and part.minus is not None
        out = hit if out is None else out & hit if taken_away else out | hit
    return F.lit(False) if out is None else out


def pick(names: Sequence[str], selection: Selection) -> list[str]:
    """Names chosen by a selection, in selection order, without repeats."""
    if selection is None:
        return list(names)
    if isinstance(selection, str):
        if selection not in names:
            raise ValueError(f"no such name: {selection}")
        return [selection]
    if isinstance(selection, Matcher):
        return list(dict.fromkeys(selection(names)))
    out: dict[str, None] = {}
    for i, part in enumerate(selection):
        chosen = pick(names, part)
        if i and isinstance(part, Matcher) and part.minus is not None:
            out = {n: None for n in out if n in chosen}
        else:
            out.update(dict.fromkeys(chosen))
    return list(out)


def select_rows(df: DataFrame, selection: Selection, column: str = "var_name") -> DataFrame:
    """Rows of a metadata table whose name is selected; table order is kept."""
    return df if selection is None else df.filter(row_condition(q(column), selection))


def mutate_at(df: DataFrame, selection: Selection, f: Callable[[Column], Column]) -> DataFrame:
    """Apply a column function to every selected column in one projection."""
    chosen = set(pick(df.columns, selection))
    metas = {c: m for c, m in all_meta(df).items() if c not in chosen}
    return with_meta(df.select(*[f(q(c)).alias(c) if c in chosen else q(c) for c in df.columns]), metas)
