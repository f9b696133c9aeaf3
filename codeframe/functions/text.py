"""Text functions as Catalyst expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..metadata import q

# POSIX class names and what Java calls them.
_POSIX = {
    "alnum": r"\p{Alnum}", "alpha": r"\p{Alpha}", "blank": r"\p{Blank}", "cntrl": r"\p{Cntrl}",
    "digit": r"\p{Digit}", "graph": r"\p{Graph}", "lower": r"\p{Lower}", "print": r"\p{Print}",
    "punct": r"\p{Punct}", "space": r"\s", "upper": r"\p{Upper}", "xdigit": r"\p{XDigit}",
}
_GROUP = re.compile(r"\\.|\[(?:\\.|\[:\w+:\]|[^\]\\])*\]|\((\?(?:P?<([A-Za-z_]\w*)>)?)?")


def java_regex(pattern: str) -> str:
    """POSIX bracket classes silently mis-parse in Java; write them as ``\\p{..}``."""
    return re.sub(r"\[:(\w+):\]", lambda m: _POSIX[m.group(1)], pattern)


def numbered_groups(pattern: str) -> tuple[str, dict[str, int]]:
    """Turn named groups into numbered ones (Java names allow no underscore)."""
    names: dict[str, int] = {}
    count = 0

    def visit(m: re.Match) -> str:
        nonlocal count
        token = m.group(0)
        if not token.startswith("("):
            return token
        if m.group(2):
            count += 1
            names[m.group(2)] = count
            return "("
        if not m.group(1):
            count += 1
        return token

    return java_regex(_GROUP.sub(visit, pattern)), names


def replace_all(col: Column, pattern: str, repl: str) -> Column:
    """Replace every match; back-references are written ``\\1``."""
    return F.regexp_replace(col, java_regex(pattern), re.sub(r"\\(\d)", r"$\1", repl))


def replace_first(col: Column, pattern: str, repl: str) -> Column:
    """Replace the first match only: the text before it is captured and put back."""
    shifted = re.sub(r"\\(\d)", lambda m: "$" + str(int(m.group(1)) + 1), repl)
    return F.regexp_replace(col, "(?s)^(.*?)(?:" + java_regex(pattern) + ")", "$1" + shifted)


def detect(col: Column, pattern: str, negate: bool = False) -> Column:
    hit = col.rlike(java_regex(pattern))
    return ~hit if negate else hit


def subset(array: Column, pattern: str, negate: bool = False) -> Column:
    """Elements of a text array that match (or do not match)."""
    return F.filter(array, lambda x: detect(x, pattern, negate))


def split(col: Column, pattern: str) -> Column:
    return F.split(col, java_regex(pattern))


def sub(col: Column, start: int = 1, end: int = -1) -> Column:
    """Characters ``start..end`` (1-based, inclusive); negative counts from the end."""
    n = F.length(col)
    s = F.lit(start) if start >= 0 else n + F.lit(start + 1)
    e = F.lit(end) if end >= 0 else n + F.lit(end + 1)
    first = F.greatest(s, F.lit(1))
    return F.substring(col, first, F.greatest(e - first + 1, F.lit(0)))


def capture(col: Column, pattern: str) -> dict[str, Column]:
    """One column per named group; text without a match gives ''."""
    java, names = numbered_groups(pattern)
    if not names:
        raise ValueError("the pattern names no group")
    return {name: F.regexp_extract(col, java, i) for name, i in names.items()}


def named_capture(df: DataFrame, col: str, pattern: str, only_matches: bool = False) -> DataFrame:
    """Add one column per named group; optionally drop rows whose first group is empty."""
    groups = capture(q(col), pattern)
    out = df.withColumns(groups)
    return out.filter(q(next(iter(groups))) != "") if only_matches else out
