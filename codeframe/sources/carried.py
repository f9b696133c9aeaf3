"""Hierarchical files read as rectangular ones, by the order of their lines.

In a hierarchical extract each household stands right before its persons. One pass carries the last household line on to the persons that follow,
inside each input split; only persons at the head of a split, whose household ended the split before, are completed from a table with one row for
each split. Person rows are neither shuffled nor sorted, however many there are of one household.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..codebook import Codebook, Variable
from ..functions.charset import is_one_byte
from ..metadata import ALL_ATTRS
from ..operators.labels import set_attributes
from ..select import Selection
from .micro import _book, _data_path, _is_csv, _same_code, cut_variable, rectype_expr


def compact(line: Column, variables: Sequence[Variable], charset: str | None) -> tuple[Column, list[Variable]]:
    """The bytes of a line that the variables need, and the variables with their places in them.

    Charsets of several bytes a character keep the whole line, as places are counted in characters there.
    """
    if not is_one_byte(charset) or not variables:
        return line.cast("binary"), list(variables)
    spans: list[list[int]] = []
    for v in sorted(variables, key=lambda v: v.start):
        if spans and v.start <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], v.end)
        else:
            spans.append([v.start, v.end])
    moved, at = {}, 1
    for a, b in spans:
        moved.update({v.name: replace(v, start=v.start - a + at, end=v.end - a + at) for v in variables if a <= v.start <= b})
        at += b - a + 1
    raw = line.cast("binary")
    return F.concat(*[F.substring(raw, a, b - a + 1) for a, b in spans]), [moved[v.name] for v in variables]


class _Carry:
    """What a pass over lines knows at a line: for each level the last line of it, that there is none, or nothing yet (``open``)."""

    def __init__(self, levels: int):
        self.levels = levels
        self.split: int | None = None
        self.reset()

    def reset(self) -> None:
        self.line: list[pa.Scalar | None] = [None] * self.levels
        self.open = [True] * self.levels
        self.first: bool | None = None  # would a child now be the first of its parent? None: not known in this split

    def run(self, kinds: np.ndarray, lines: pa.Array) -> list[pa.Array]:
        """(parent lines and whether they are open, by level; first; whether that is open) of the child lines of one run of a split."""
        n = len(kinds)
        at = np.arange(n)
        child = np.flatnonzero(kinds == 0)
        out = []
        for level in range(1, self.levels + 1):
            own = np.maximum.accumulate(np.where(kinds == level, at, -1))
            outer = np.maximum.accumulate(np.where((kinds > 0) & (kinds < level), at, -1))
            place = np.where(own > outer, own, -1)[child]
            fresh = (own < 0) & (outer < 0)  # neither in this run
            known = pa.array([None if self.line[level - 1] is None else self.line[level - 1].as_py()], pa.binary())
            index = np.where(place >= 0, place, n)  # the last entry is what was known before
            taken = pa.concat_arrays([lines, known]).take(pa.array(index, mask=(place < 0) & ~fresh[child]))
            out += [taken, pa.array(fresh[child] & self.open[level - 1])]
            if not fresh[-1]:
                self.open[level - 1] = False
                self.line[level - 1] = lines[int(own[-1])] if own[-1] > outer[-1] else None
        last_parent = np.maximum.accumulate(np.where(kinds > 0, at, -1))
        before = np.concatenate([[-1], np.maximum.accumulate(np.where(kinds == 0, at, -1))[:-1]])  # the last child before each line
        unknown = (last_parent < 0) & (before < 0)
        first = np.where(unknown, self.first is not False, last_parent > before)
        out += [pa.array(first[child]), pa.array((unknown & (self.first is None))[child])]
        if n:
            self.first = bool(kinds[-1] > 0)
        return out


def _carried(lines: DataFrame, levels: int) -> DataFrame:
    """Child lines with the lines above them: (value, p1, o1, ..., first, open_first, split)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Carry(levels)
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds, splits, values = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(0)
            cuts = [0, *(np.flatnonzero(np.diff(splits)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if splits[a] != state.split:
                    state.reset()
                    state.split = int(splits[a])
                own = kinds[a:b]
                cells = state.run(own, values.slice(a, b - a))
                child = pa.array(np.flatnonzero(own == 0))
                yield pa.RecordBatch.from_arrays([values.slice(a, b - a).take(child), *cells, pa.array(np.full(len(child), splits[a]))], names=names)

    names = ["value", *[f"{c}{i}" for i in range(1, levels + 1) for c in "po"], "first", "open_first", "split"]
    schema = "value binary, " + "".join(f"p{i} binary, o{i} boolean, " for i in range(1, levels + 1)) + "first boolean, open_first boolean, split long"
    return lines.select("line", "kind", "split").mapInArrow(rows, schema)


def _heads(lines: DataFrame, levels: int) -> DataFrame:
    """(h_split, b1, ..., child_before) for every input split: the lines of each level in force where it begins, from all splits before it.

    Splits are ordered by file and offset. Within a file the rows of its splits are looked at together, over files one row for each file.
    """
    place = [F.col("file"), F.col("start"), F.col("id")]
    last = [F.max(F.when(F.col("kind") == i, F.struct(*place, F.col("line")))).alias(f"l{i}") for i in range(1, levels + 1)]
    last.append(F.max(F.when(F.col("kind") == 0, F.struct(*place))).alias("l0"))
    splits = lines.groupBy("split", "file", "start").agg(*last)
    names = [f"l{i}" for i in range(levels + 1)]
    inside = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = splits.groupBy("file").agg(*[F.max(c).alias(c) for c in names])
    files = files.select(F.col("file").alias("f"), *[F.max(c).over(over).alias(f"f{c}") for c in names])
    both = splits.select("split", "file", *[F.max(c).over(inside).alias(c) for c in names]).join(files, F.col("file") == F.col("f"))
    both = both.select("split", *[F.coalesce(c, f"f{c}").alias(c) for c in names])
    when = lambda c: F.struct(f"{c}.file", f"{c}.start", f"{c}.id")
    out = []
    for i in range(1, levels + 1):
        # an outer line after it ends an inner one
        ended = [F.coalesce(when(f"l{j}") > when(f"l{i}"), F.lit(False)) for j in range(1, i)]
        alive = F.lit(True)
        for e in ended:
            alive = alive & ~e
        out.append(F.when(alive, F.col(f"l{i}.line")).alias(f"b{i}"))
    parents = F.greatest(*[F.when(F.col(f"l{i}").isNotNull(), when(f"l{i}")) for i in range(1, levels + 1)]) if levels > 1 else F.when(F.col("l1").isNotNull(), when("l1"))
    child = F.col("l0").isNotNull() & F.coalesce(F.col("l0") > parents, F.lit(True))
    return both.select(F.col("split").alias("h_split"), *out, child.alias("child_before"))


def read_micro_rectangular(spark: SparkSession, codebook: Codebook | str, vars: Selection = None, data_file=None, child: str | None = None,
                           parents: Sequence[str] | None = None, var_attrs=ALL_ATTRS, lower_vars: bool = False, unmatched: str = "error",
                           first: str | None = None) -> DataFrame:
    """The rows of one record type with the variables of the types above them, by line order.

    ``parents`` are record-type codes from the outermost inwards, ``child`` the code of the rows that come out; by default the codebook's last type is the child of all
    the others. A line of an outer type ends the inner ones before it. Variables that several types have come from the innermost. ``first`` names a column that says
    whether a row is the first child after a parent's line.

    Where types share key variables, a child's keys must equal those of the line above; a child whose keys differ, or that has no such line, stops the query, or with
    ``unmatched="null"`` gets NULLs, as in a left join. Files of a folder follow each other by name. Lines of other record types play no part. An empty file gives no rows.
    """
    from ..streaming.chunks import MAX_BROADCAST_SPLITS, _split_bound

    if unmatched not in ("error", "null"):
        raise ValueError('unmatched must be "error" or "null"')
    book = _book(spark, codebook, lower_vars)
    path = _data_path(spark, book, data_file)
    if _is_csv(path) or not book.hierarchical:
        raise ValueError("only fixed-width files of several record types have lines above others")
    child = child or book.rectypes[-1]
    parents = list(parents or [c for c in book.rectypes if c != child])
    small = book.prune(vars, "list")
    of = lambda code: [v for v in small.variables if v.rectypes and code in v.rectypes]
    rt, width = rectype_expr(F.col("value"), book), book.variable(book.rectype_idvar).width
    kind, line = F.lit(-1), F.lit(None).cast("binary")
    moved: dict[str, list[Variable]] = {}
    for number, code in enumerate([child, *parents]):
        hit = _same_code(rt, [code], width)
        bytes_of, moved[code] = compact(F.col("value"), of(code), book.file_encoding)
        kind, line = F.when(hit, number).otherwise(kind), F.when(hit, bytes_of).otherwise(line)
    text = spark.read.text(path)
    file, start = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    raw = text.select(line.alias("line"), kind.cast("byte").alias("kind"), F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.file_block_start")).alias("split"),
                      file, start, F.monotonically_increasing_id().alias("id"))
    rows = _carried(raw.where("kind >= 0"), len(parents))
    heads = _heads(raw, len(parents))
    anew = [f"o{i}" for i in range(1, len(parents) + 1)] + ["open_first"]
    needs = F.greatest(*anew)
    joined = _with_heads(rows, heads, needs, _split_bound(text) <= MAX_BROADCAST_SPLITS)
    wrong = F.lit(False)
    found: dict[str, Column] = {}
    own = {v.name: cut_variable(F.col("value").cast("string"), v, book.file_encoding) for v in moved[child]}
    cells: list[tuple[str, Column]] = []
    for i, code in enumerate(parents, 1):
        above = F.when(F.col(f"o{i}"), F.col(f"b{i}")).otherwise(F.col(f"p{i}"))
        cut = {v.name: cut_variable(above.cast("string"), v, book.file_encoding) for v in moved[code]}
        keys = [k for k in book.keyvars.get(code, ()) if k in cut and k in own]
        fits = above.isNotNull()
        for k in keys:
            fits = fits & own[k].eqNullSafe(cut[k])
        wrong = wrong | ~fits
        found.update({name: F.when(fits, c) for name, c in cut.items()})
    found.update(own)
    order = [v.name for v in small.variables if v.name in found]
    cells = [(name, found[name]) for name in order]
    if unmatched == "error" and order:
        stop = F.raise_error(F.lit("a line has no line above it that its keys fit; read the record types apart and join them"))
        name, value = cells[0]
        cells[0] = (name, F.when(wrong, stop.cast(joined.select(value).schema[0].dataType)).otherwise(value))
    if first:
        cells.append((first, F.when(F.col("open_first"), F.col("first") & ~F.col("child_before")).otherwise(F.col("first"))))
    return set_attributes(joined.select(*[c.alias(n) for n, c in cells]), [v for v in small.variables if v.name in found], var_attrs)


def _with_heads(rows: DataFrame, heads: DataFrame, needs: Column, small: bool) -> DataFrame:
    """Rows with what was in force at the head of their split, for those that need it. The table of splits is broadcast if their number is known to be small enough."""
    missing = F.raise_error(F.lit("the file was split differently in two scans; set spark.sql.files.minPartitionNum"))
    if small:
        out = rows.join(F.broadcast(heads), F.when(needs, F.col("split")) == F.col("h_split"), "left")
        lost = needs & F.col("h_split").isNull()
        return out.withColumn("child_before", F.when(lost, missing.cast("boolean")).otherwise(F.col("child_before")))
    # few rows need it: one household's persons a split
    rest = rows.where(~needs)
    for f in heads.schema:
        rest = rest.withColumn(f.name, F.lit(None).cast(f.dataType))
    asked = rows.where(needs).join(heads, F.col("split") == F.col("h_split"), "left")
    return rest.unionByName(asked.withColumn("child_before", F.when(F.col("h_split").isNull(), missing.cast("boolean")).otherwise(F.col("child_before"))))
