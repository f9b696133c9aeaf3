"""Codebook: the schema and the labels of a data file.

Many codebooks live in four metadata tables (see :class:`CodebookTables`). A reader needs
one codebook, which like any schema is driver-side: :class:`Codebook`.
"""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .metadata import VarMeta, all_meta, q
from .select import Selection, pick, select_rows

FILE_INFO = ("codebook_id string, file_name string, file_type string, project string, extract_date date, "
             "extract_notes string, conditions string, citation string, file_encoding string, rectype_idvar string")
RECORD_TYPES = "codebook_id string, rectype string, label string, keyvars array<string>"
VARIABLES = ("codebook_id string, pos int, var_name string, var_label string, var_desc string, code_instr string, "
             "`start` int, `end` int, imp_decim int, var_type string, rectypes array<string>")
VALUE_LABELS = "codebook_id string, var_name string, pos int, val string, val_num double, lbl string"


@dataclass(frozen=True)
class Variable:
    name: str
    label: str | None = None
    desc: str | None = None
    val_labels: tuple[tuple[Any, str], ...] = ()
    code_instr: str | None = None
    start: int | None = None
    end: int | None = None
    imp_decim: int = 0
    var_type: str = "character"  # "integer", "numeric" or "character"
    rectypes: tuple[str, ...] | None = None

    @property
    def width(self) -> int:
        return self.end - self.start + 1


@dataclass(frozen=True)
class Codebook:
    variables: tuple[Variable, ...] = ()
    file_name: str | None = None
    file_path: str | None = None
    file_type: str = "rectangular"
    project: str | None = None
    extract_date: dt.date | None = None
    extract_notes: str | None = None
    rectypes: tuple[str, ...] | None = None
    rectype_idvar: str | None = None
    rectype_labels: tuple[tuple[str, str | None], ...] = ()
    keyvars: dict[str, tuple[str, ...]] = field(default_factory=dict)
    conditions: str | None = None
    citation: str | None = None
    file_encoding: str | None = None

    @property
    def names(self) -> list[str]:
        return [v.name for v in self.variables]

    @property
    def hierarchical(self) -> bool:
        return self.file_type == "hierarchical"

    def variable(self, name: str) -> Variable:
        return next(v for v in self.variables if v.name == name)

    def lower(self) -> Codebook:
        """The codebook with lower-case variable, key and record-type id names."""
        return replace(
            self,
            variables=tuple(replace(v, name=v.name.lower()) for v in self.variables),
            rectype_idvar=self.rectype_idvar and self.rectype_idvar.lower(),
            keyvars={r: tuple(k.lower() for k in ks) for r, ks in self.keyvars.items()},
        )

    @property
    def has_lower_names(self) -> bool:
        return all(v.name == v.name.lower() for v in self.variables)

    def prune(self, selection: Selection, form: str) -> Codebook:
        """Keep the selected variables, in file order. For hierarchical files the list form
        adds the key variables and the long form the record-type id."""
        if selection is None:
            return self
        chosen = set(pick(self.names, selection))
        if self.hierarchical and form == "list":
            chosen |= {k for ks in self.keyvars.values() for k in ks}
        elif self.hierarchical and self.rectype_idvar:
            chosen.add(self.rectype_idvar)
        return replace(self, variables=tuple(v for v in self.variables if v.name in chosen))

    def rectype_names(self, codes: Iterable[str]) -> list[str]:
        """Table names for record types: the upper-case label without " RECORD", blanks as
        "_". If any type has no label, the codes stay."""
        codes = list(codes)
        labels = {}
        if self.rectype_idvar in self.names:
            labels = {_key(v): t for v, t in self.variable(self.rectype_idvar).val_labels}
        found = [labels.get(_key(c)) for c in codes]
        if any(t is None for t in found):
            return codes
        names = []
        for t in found:
            t = t.upper()
            t = t[: -len(" RECORD")] if t.endswith(" RECORD") else t
            names.append(t.replace(" ", "_").replace("\t", "_"))
        return names

    # ------------------------------------------------------------ file level information

    def file_info(self, item: str | None = None):
        """One item by name, or the five usual ones."""
        if item is not None:
            return getattr(self, item)
        return {k: getattr(self, k) for k in ("project", "extract_date", "extract_notes", "conditions", "citation")}

    def terms(self) -> str:
        """Conditions of use followed by the citation request."""
        out = (self.conditions or "") + "\n\n"
        return out + self.citation + "\n\n" if self.citation else out

    def to_tables(self, spark: SparkSession, codebook_id: str = "codebook") -> CodebookTables:
        """This codebook as metadata tables."""
        labels = [(codebook_id, v.name, i, str(a), float(a) if not isinstance(a, str) else None, t)
                  for v in self.variables for i, (a, t) in enumerate(v.val_labels)]
        return CodebookTables(
            spark.createDataFrame([(codebook_id, self.file_name, self.file_type, self.project, self.extract_date,
                                    self.extract_notes, self.conditions, self.citation, self.file_encoding,
                                    self.rectype_idvar)], FILE_INFO),
            spark.createDataFrame([(codebook_id, r, dict(self.rectype_labels).get(r), list(self.keyvars.get(r, ())))
                                   for r in self.rectypes or ()], RECORD_TYPES),
            spark.createDataFrame([(codebook_id, i, v.name, v.label, v.desc, v.code_instr, v.start, v.end, v.imp_decim,
                                    v.var_type, None if v.rectypes is None else list(v.rectypes))
                                   for i, v in enumerate(self.variables)], VARIABLES),
            spark.createDataFrame(labels, VALUE_LABELS),
        )


def _key(v: Any) -> str:
    """Record-type codes compare as numbers when they are numbers ("01" = 1)."""
    try:
        f = float(v)
        return str(int(f)) if f.is_integer() else str(f)
    except (TypeError, ValueError):
        return str(v)


@dataclass(frozen=True)
class CodebookTables:
    """Metadata of any number of codebooks as four tables keyed by ``codebook_id``."""

    file_info: DataFrame
    record_types: DataFrame
    variables: DataFrame
    value_labels: DataFrame

    def ids(self) -> list[str]:
        return [r[0] for r in self.file_info.select("codebook_id").distinct().orderBy("codebook_id").collect()]

    def terms(self) -> DataFrame:
        """``(codebook_id, terms)``: conditions of use followed by the citation request, as :meth:`Codebook.terms` for each codebook."""
        blank = F.lit("\n\n")
        cited = F.when(F.coalesce("citation", F.lit("")) != "", F.concat("citation", blank)).otherwise(F.lit(""))
        return self.file_info.select("codebook_id", F.concat(F.coalesce("conditions", F.lit("")), blank, cited).alias("terms"))

    def lower(self) -> CodebookTables:
        low = lambda c: F.lower(F.col(c))
        return CodebookTables(
            self.file_info.withColumn("rectype_idvar", low("rectype_idvar")),
            self.record_types.withColumn("keyvars", F.transform("keyvars", F.lower)),
            self.variables.withColumn("var_name", low("var_name")),
            self.value_labels.withColumn("var_name", low("var_name")),
        )

    def codebook(self, codebook_id: str | None = None, file_path: str | None = None) -> Codebook:
        """One codebook, brought to the driver as a schema is (only its own rows)."""
        def mine(df: DataFrame) -> DataFrame:
            return df if codebook_id is None else df.filter(F.col("codebook_id") == codebook_id)

        infos = mine(self.file_info).limit(2).collect()
        if len(infos) != 1:
            raise ValueError("expected exactly one codebook; give its codebook_id")
        info = infos[0]
        labels: dict[str, list[tuple[Any, str]]] = {}
        for r in mine(self.value_labels).orderBy("var_name", "pos").collect():
            labels.setdefault(r["var_name"], []).append((_code_value(r), r["lbl"]))
        variables = [
            Variable(
                name=r["var_name"], label=r["var_label"], desc=r["var_desc"], code_instr=r["code_instr"],
                val_labels=tuple(labels.get(r["var_name"], ())), start=r["start"], end=r["end"],
                imp_decim=r["imp_decim"] or 0, var_type=r["var_type"] or "character",
                rectypes=None if r["rectypes"] is None else tuple(r["rectypes"]),
            )
            for r in mine(self.variables).orderBy("pos").collect()
        ]
        types = mine(self.record_types).collect()
        return Codebook(
            variables=tuple(variables), file_name=info["file_name"], file_path=file_path, file_type=info["file_type"],
            project=info["project"], extract_date=info["extract_date"], extract_notes=info["extract_notes"],
            rectypes=tuple(r["rectype"] for r in types) or None, rectype_idvar=info["rectype_idvar"],
            rectype_labels=tuple((r["rectype"], r["label"]) for r in types),
            keyvars={r["rectype"]: tuple(r["keyvars"] or ()) for r in types},
            conditions=info["conditions"], citation=info["citation"], file_encoding=info["file_encoding"],
        )


def _code_value(row) -> Any:
    if row["val_num"] is None:
        return row["val"]
    return int(row["val_num"]) if float(row["val_num"]).is_integer() else row["val_num"]


# ---------------------------------------------------------------- questions about variables

_INFO = "var_name string, var_label string, var_desc string, val_labels array<struct<val: string, lbl: string>>"


def _info_rows(obj) -> list[tuple]:
    def pairs(labels):
        return [(str(v), t) for v, t in labels]

    if isinstance(obj, Codebook):
        return [(v.name, v.label, v.desc, pairs(v.val_labels)) for v in obj.variables]
    if isinstance(obj, DataFrame):
        return [(c, m.label, m.var_desc, pairs(m.val_labels)) for c, m in all_meta(obj).items()]
    if isinstance(obj, dict):
        rows: dict[str, tuple] = {}
        for part in obj.values():
            for r in _info_rows(part):
                rows.setdefault(r[0], r)
        return list(rows.values())
    raise TypeError(f"no variable information in a {type(obj).__name__}")


def var_info(obj, selection: Selection = None, spark: SparkSession | None = None) -> DataFrame:
    """Variable table of a codebook, a labelled table, a dict of tables (first one wins by
    name), or of :class:`CodebookTables`."""
    if isinstance(obj, CodebookTables):
        sets = obj.value_labels.groupBy("codebook_id", "var_name").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("pos", "val", "lbl"))),
                        lambda x: F.struct(x["val"].alias("val"), x["lbl"].alias("lbl"))).alias("val_labels"))
        out = obj.variables.join(sets, ["codebook_id", "var_name"], "left")
        return select_rows(out, selection)
    rows = _info_rows(obj)
    keep = set(pick([r[0] for r in rows], selection))
    session = spark or SparkSession.getActiveSession()
    return session.createDataFrame([r for r in rows if r[0] in keep], _INFO)


def first_by_name(variables: DataFrame, order: str = "pos") -> DataFrame:
    """One row per variable name: the first one."""
    w = Window.partitionBy("var_name").orderBy(order)
    return variables.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def _metas(obj) -> dict[str, VarMeta]:
    if isinstance(obj, Codebook):
        out: dict[str, VarMeta] = {}
        for v in obj.variables:
            out.setdefault(v.name, VarMeta(v.label, v.desc, tuple(v.val_labels)))
        return out
    if isinstance(obj, DataFrame):
        return all_meta(obj)
    if isinstance(obj, dict):
        merged: dict[str, VarMeta] = {}
        for part in obj.values():
            for c, m in all_meta(part).items():
                merged.setdefault(c, m)
        return merged
    raise TypeError(f"no variable information in a {type(obj).__name__}")


def _single(obj, selection: Selection, what: str) -> VarMeta:
    metas = _metas(obj)
    names = pick(list(metas), selection)
    if not names:
        raise ValueError("no variable selected")
    if len(names) > 1:
        warnings.warn(f"several variables selected; this is the {what} of the first", stacklevel=3)
        names = [n for n in metas if n in names]
    return metas[names[0]]


def var_label(obj, selection: Selection = None) -> str | None:
    return _single(obj, selection, "variable label").label


def var_desc(obj, selection: Selection = None) -> str | None:
    return _single(obj, selection, "variable description").var_desc


def val_labels(obj, selection: Selection = None) -> list[tuple[Any, str]]:
    return list(_single(obj, selection, "value labels").val_labels)


def label_table(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Value labels of a table's columns as rows ``(var_name, pos, val, val_num, lbl)``."""
    rows = [(c, i, str(v), None if isinstance(v, str) else float(v), t)
            for c, m in all_meta(df).items() if cols is None or c in cols
            for i, (v, t) in enumerate(m.val_labels)]
    return df.sparkSession.createDataFrame(rows, "var_name string, pos int, val string, val_num double, lbl string")


def sorted_labels(col: Column | str = "val_labels") -> Column:
    """An array of ``{val, lbl}`` sorted by value, numbers as numbers."""
    c = q(col) if isinstance(col, str) else col
    keyed = F.transform(c, lambda x: F.struct(
        F.coalesce(x["val"].try_cast("double"), F.lit(float("inf"))).alias("n"), x["val"].alias("val"), x["lbl"].alias("lbl")))
    return F.transform(F.sort_array(keyed), lambda x: F.struct(x["val"].alias("val"), x["lbl"].alias("lbl")))
