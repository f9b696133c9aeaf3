"""Writing tables: fixed width (with the codebook that reads it back), CSV, Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codebook import Codebook, Variable
from ..functions.charset import canonical, is_one_byte
from ..metadata import all_meta, is_integral, q
from ..session import tune


def layout(df: DataFrame, widths: dict[str, int], decimals: dict[str, int] | None = None,
           record_types: dict[str, list[str]] | None = None, start: int = 1) -> list[Variable]:
    """Positions for the columns of a table, one after another."""
    out, pos = [], start
    metas = all_meta(df)
    for c, w in widths.items():
        dt = df.schema[c].dataType
        d = (decimals or {}).get(c, 0)
        kind = "character" if isinstance(dt, T.StringType) else "integer" if is_integral(dt) and w < 10 else "numeric"
        out.append(Variable(name=c, label=metas[c].label, desc=metas[c].var_desc, val_labels=metas[c].val_labels,
                            start=pos, end=pos + w - 1, imp_decim=d, var_type=kind,
                            rectypes=tuple(record_types[c]) if record_types and c in record_types else None))
        pos += w
    return out


def _field(c: Column, v: Variable, dt: T.DataType) -> Column:
    """One field of exactly ``v.width`` characters; a value that does not fit, or breaks the line, stops the job."""
    if isinstance(dt, T.StringType):
        broken = F.raise_error(F.concat(F.lit(f"line break in {v.name}: "), c)).cast("string")
        text, pad = F.coalesce(F.when(c.contains("\n") | c.contains("\r"), broken).otherwise(c), F.lit("")), F.rpad
    else:
        # Scale to whole units; round() undoes binary noise such as 1475.59 * 100.
        units = F.round(c.cast("double") * F.lit(10.0 ** v.imp_decim)).cast("bigint") if not is_integral(dt) else (
            c * F.lit(10 ** v.imp_decim) if v.imp_decim else c)
        text, pad = F.coalesce(units.cast("string"), F.lit("")), F.lpad
    return F.when(F.length(text) <= v.width, pad(text, F.lit(v.width), F.lit(" "))).otherwise(
        F.raise_error(F.concat(F.lit(f"value does not fit into {v.width} columns of {v.name}: "), text)).cast("string"))


def to_lines(df: DataFrame, variables: list[Variable], total_width: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Fixed-width lines ``(value)`` of a table, with the columns to keep; gaps between fields are blanks."""
    parts, pos = [], 1
    for v in sorted(variables, key=lambda v: v.start):
        if v.start > pos:
            parts.append(F.lit(" " * (v.start - pos)))
        parts.append(_field(q(v.name), v, df.schema[v.name].dataType))
        pos = v.end + 1
    if total_width and total_width >= pos:
        parts.append(F.lit(" " * (total_width - pos + 1)))
    return df.select(F.concat(*parts).alias("value"), *[q(c) for c in keep])


def write_fixed_width(df: DataFrame, path: str, variables: list[Variable], file_encoding: str = "UTF-8",
                      compression: str = "none", mode: str = "errorifexists", **info) -> Codebook:
    """Write fixed-width text and return the codebook that reads it back.

    Spark writes UTF-8. A one-byte ``file_encoding`` lets readers cut fields from bytes, which
    is faster; it is allowed for ASCII content only, anything else stops the job.
    """
    tune(df.sparkSession)
    lines = to_lines(df, variables)
    if is_one_byte(file_encoding):
        lines = lines.select(F.when(F.octet_length("value") == F.length("value"), F.col("value")).otherwise(
            F.raise_error(F.concat(F.lit("line is not ASCII: "), F.col("value"))).cast("string")).alias("value"))
    lines.write.mode(mode).option("compression", compression).text(path)
    base, name = path.rstrip("/").rsplit("/", 1) if "/" in path else ("", path)
    return replace(Codebook(variables=tuple(variables), file_name=name, file_path=base, file_type="rectangular",
                            file_encoding=canonical(file_encoding)), **info)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """CSV with a header; missing values are empty."""
    df.write.mode(mode).option("header", True).option("compression", compression).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    """Parquet keeps the column metadata. Partitioning by a low-cardinality code (a year, a
    sample) lets later readers skip whole folders; rows are not shuffled for it."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None,
                   mode: str = "errorifexists") -> None:
    """Catalog table bucketed and sorted by the key variables.

    Record types stored with the same keys and bucket count are joined, and households
    picked out, without a shuffle.
    """
    writer = df.write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_hierarchical(household: DataFrame, person: DataFrame, path: str, variables: list[Variable], idvar: str,
                       rectypes: dict[str, DataFrame] | None = None, mode: str = "errorifexists",
                       keys: Sequence[str] = (), order: Sequence[str] = ()) -> None:
    """Write record types into one file of mixed lines.

    Every record type's lines are cut to the same layout; ``variables`` say which types they
    belong to. With ``keys``, which all types have, the lines of one key stand together: types in the
    order given, lines of a type by ``order`` (columns that a type lacks count as NULL). Files follow each other by name, and
    a key with very many lines may run over several. Without keys, lines of one household are not placed next
    to each other and readers link record types by the key variables.
    """
    parts = rectypes or {"H": household, "P": person}
    lines = None
    width = max(v.end for v in variables)
    places = [*[f"__k{i}" for i in range(len(keys))], *(["__type"] if keys else []), *[f"__o{i}" for i in range(len(order) if keys else 0)]]
    kinds = {c: df.schema[c].dataType for df in parts.values() for c in order if c in df.columns}
    for number, (code, df) in enumerate(parts.items()):
        mine = [v for v in variables if v.rectypes is None or code in v.rectypes]
        frame = df if idvar in df.columns else df.withColumn(idvar, F.lit(code))
        if keys:
            by = [q(c) if c in df.columns else F.lit(None).cast(kinds[c]) for c in order]
            frame = frame.select("*", *[c.alias(n) for c, n in zip([*map(q, keys), F.lit(number), *by], places)])
        part = to_lines(frame, mine, width, keep=places)
        lines = part if lines is None else lines.unionByName(part)
    if keys:
        lines = lines.repartitionByRange(*places).sortWithinPartitions(*places).select("value")
    lines.write.mode(mode).text(path)
