"""Numbers from text, whole-column type guesses, and arithmetic with stated NULL rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..metadata import all_meta, q, with_meta
from ..session import tune

# Fixed patterns of the type guess.
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
LEADING_ZERO = r"^[+-]?0[0-9]"
BOOLEAN = r"^(T|F|TRUE|FALSE|true|false|True|False)$"
DATE = r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}$"
TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?Z?$"
NA_TOKENS = ("", "NA")


def to_number(col: Column, as_type: str = "double") -> Column:
    """Text to number, NULL when it is none. Java's own extras ("1d", "0x1p3") do not count."""
    return F.when(F.trim(col).rlike(NUMBER), col.try_cast(as_type))


def strict_number(col: Column, as_type: str = "double", name: str = "variable") -> Column:
    """Text to number that stops the query on the first text that is none.

    The test runs inside the same scan that uses the value, so it costs no extra pass.
    """
    parsed = to_number(col, as_type)
    kind = "integer" if as_type in ("int", "bigint") else "number"
    return F.when(col.isNull(), F.lit(None).cast(as_type)).when(parsed.isNotNull(), parsed).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} has text that is no {kind}: "), col)).cast(as_type)
    )


def count_not_numeric(df: DataFrame, cols: dict[str, str]) -> dict[str, int]:
    """Texts of each column that are no number of the wanted type: one aggregate for all."""
    if not cols:
        return {}
    row = df.agg(
        *[F.count_if(q(c).isNotNull() & to_number(q(c), t).isNull()).alias(f"n{i}")
          for i, (c, t) in enumerate(cols.items())]
    ).first()
    return {c: row[f"n{i}"] for i, c in enumerate(cols)}


def lenient_number(col: Column) -> Column:
    """First number in the text; grouping commas, currency signs and units are dropped."""
    found = F.regexp_extract(col, r"(-?[0-9][0-9,]*(?:\.[0-9]+)?|-?\.[0-9]+)", 1)
    return F.regexp_replace(found, ",", "").try_cast("double")


def guess_types(df: DataFrame, cols: list[str] | None = None) -> dict[str, T.DataType]:
    """Type of each text column, judged on all its values in one aggregate.

    Order: boolean, number, date, timestamp, text. A number with a leading zero keeps the
    column text ("01" is a code). A column without any value becomes boolean.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    names = [c for c in names if cols is None or c in cols]
    if not names:
        return {}
    tune(df.sparkSession)
    aggs = []
    for i, c in enumerate(names):
        v = na_to_null(q(c))
        aggs += [
            # a missing value speaks neither for nor against a type
            F.bool_and(F.when(v.isNotNull(), test)).alias(f"{k}{i}")
            for k, test in (
                ("b", v.rlike(BOOLEAN)),
                ("n", v.rlike(NUMBER) & ~v.rlike(LEADING_ZERO)),
                ("d", v.rlike(DATE) & _to_date(v).isNotNull()),
                ("t", v.rlike(TIMESTAMP) & v.try_cast("timestamp").isNotNull()),
            )
        ]
    row = df.agg(*aggs).first()
    out: dict[str, T.DataType] = {}
    for i, c in enumerate(names):
        if row[f"b{i}"] is None or row[f"b{i}"]:
            out[c] = T.BooleanType()
        elif row[f"n{i}"]:
            out[c] = T.DoubleType()
        elif row[f"d{i}"]:
            out[c] = T.DateType()
        elif row[f"t{i}"]:
            out[c] = T.TimestampType()
        else:
            out[c] = T.StringType()
    return out


def _to_date(col: Column) -> Column:
    return F.replace(col, F.lit("/"), F.lit("-")).try_cast("date")


def na_to_null(col: Column) -> Column:
    """Trimmed text with the missing-value tokens turned into NULL."""
    t = F.trim(col)
    return F.when(~t.isin(*NA_TOKENS), t)


def convert(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """Cast the named text columns to their guessed types, keeping column metadata."""
    if not types:
        return df
    cols = []
    for c in df.columns:
        if c not in types:
            cols.append(q(c))
            continue
        v = na_to_null(q(c))
        dt = types[c]
        if isinstance(dt, T.StringType):
            out = v
        elif isinstance(dt, T.BooleanType):
            out = F.when(v.isNotNull(), F.upper(v).isin("T", "TRUE"))
        elif isinstance(dt, T.DateType):
            out = _to_date(v)
        else:
            out = v.try_cast(dt)
        cols.append(out.alias(c))
    return with_meta(df.select(*cols), all_meta(df))


def guess_and_convert(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return convert(df, guess_types(df, cols))


def floor_div(x: Column, n: Column | float) -> Column:
    """Integer division that rounds down (SQL ``div`` truncates towards zero)."""
    return F.floor(x / n)


def ratio(x: Column, y: Column) -> Column:
    """Division that gives NULL instead of an error for a zero divisor."""
    return F.try_divide(x.cast("double"), y.cast("double"))


def is_in(x: Column, values: list) -> Column:
    """Membership that is never NULL: a NULL is simply not in the list."""
    present = [v for v in values if v is not None]
    hit = F.coalesce(x.isin(present), F.lit(False)) if present else F.lit(False)
    return hit | x.isNull() if len(present) < len(values) else hit


def row_sum(*cols: Column) -> Column:
    """Sum across columns; any NULL makes it NULL."""
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out
