"""Extract definitions: what to select, run as a Spark job, kept as JSON, logged as a table."""

from __future__ import annotations

import json
import warnings
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from types import MappingProxyType
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..metadata import all_meta, q, with_meta
from ..operators.joins import rectangularize

# Allowed formats, structures and units.
DATA_FORMATS = ("fixed_width", "csv", "stata", "spss", "sas9")
SINK_FORMATS = ("fixed_width", "csv", "parquet")
RECTANGULAR_ON = ("P",)

# Collection codes of public surveys. A registry of more is a dict of one's own: {**COLLECTIONS, "own": "..."}.
COLLECTIONS: Mapping[str, str] = MappingProxyType({
    "usa": "US Census and American Community Survey",
    "cps": "Current Population Survey",
    "ahtus": "American Heritage Time Use Study",
    "mtus": "Multinational Time Use Study",
    "atus": "American Time Use Survey",
    "dhs": "Demographic and Health Surveys",
    "highered": "Higher Education surveys",
    "meps": "Medical Expenditure Panel Survey",
    "nhis": "National Health Interview Survey",
    "pma": "Performance Monitoring for Action",
})


def collections(spark: SparkSession, registry: Mapping[str, str] = COLLECTIONS) -> DataFrame:
    """``(collection_name, code)`` of the collections of a registry."""
    return spark.createDataFrame([(n, c) for c, n in registry.items()], "collection_name string, code string")


def known_collections(registry: Mapping[str, str] = COLLECTIONS) -> list[str]:
    return list(registry)


@dataclass(frozen=True)
class Extract:
    collection: str | None = None
    description: str | None = None
    samples: tuple[str, ...] | None = None
    variables: tuple[str, ...] | None = None
    data_format: str | None = "fixed_width"
    data_structure: str | None = "rectangular"
    rectangular_on: str | None = "P"
    submitted: bool = False
    download_links: dict[str, dict[str, Any]] = field(default_factory=dict)
    number: int | None = None
    status: str = "unsubmitted"


def _texts(x, what: str) -> tuple[str, ...]:
    items = (x,) if isinstance(x, str) else tuple(x)
    if not all(isinstance(i, str) for i in items):
        raise TypeError(f"{what} must be text")
    return items


def validate(extract: Extract) -> Extract:
    """Required fields present, format, structure and unit allowed."""
    missing = [k for k in ("collection", "description", "data_structure", "data_format", "samples", "variables")
               if getattr(extract, k) is None or (isinstance(getattr(extract, k), tuple) and not getattr(extract, k))]
    if missing:
        raise ValueError("an extract needs: " + ", ".join(missing))
    if extract.data_format not in (*DATA_FORMATS, "parquet"):
        raise ValueError(f"data_format must be one of {', '.join(DATA_FORMATS)}")
    if extract.data_structure != "rectangular":
        raise ValueError("data_structure must be rectangular")
    if extract.rectangular_on not in RECTANGULAR_ON:
        raise ValueError("rectangular_on must be P")
    return extract


def define_extract(collection: str, description: str, samples, variables, data_format: str = "fixed_width",
                   data_structure: str = "rectangular", rectangular_on: str = "P") -> Extract:
    for name, value in (("collection", collection), ("description", description), ("data_format", data_format)):
        if not isinstance(value, str):
            raise TypeError(f"{name} must be text")
    return validate(Extract(collection, description, _texts(samples, "samples"), _texts(variables, "variables"),
                            data_format, data_structure, rectangular_on))


def _add(extract: Extract, what: str, names) -> Extract:
    if names is None:
        return extract
    names = _texts(names, what)
    have = getattr(extract, what) or ()
    twice = [n for n in names if n in have]
    if twice:
        warnings.warn(f"{what} that the extract has already: {', '.join(twice)}", stacklevel=3)
    return replace(extract, **{what: (*have, *[n for n in dict.fromkeys(names) if n not in have])})


def _remove(extract: Extract, what: str, names) -> Extract:
    if names is None:
        return extract
    names = _texts(names, what)
    have = getattr(extract, what) or ()
    absent = [n for n in names if n not in have]
    if absent:
        warnings.warn(f"{what} that the extract does not have: {', '.join(absent)}", stacklevel=3)
    return replace(extract, **{what: tuple(n for n in have if n not in names)})


def revise_extract(extract: Extract, description: str | None = None, samples_to_add=None, samples_to_remove=None,
                   vars_to_add=None, vars_to_remove=None, data_format: str | None = None,
                   data_structure: str | None = None, rectangular_on: str | None = None) -> Extract:
    """An unsubmitted copy with changes; described as a revision unless told otherwise."""
    out = replace(extract, submitted=False, download_links={}, number=None, status="unsubmitted",
                  description=description or f"Revision of ({extract.description})")
    out = _remove(_add(out, "samples", samples_to_add), "samples", samples_to_remove)
    out = _remove(_add(out, "variables", vars_to_add), "variables", vars_to_remove)
    if data_format is not None:
        out = replace(out, data_format=data_format)
    if data_structure is not None:
        out = replace(out, data_structure=data_structure)
    if rectangular_on is not None:
        out = replace(out, rectangular_on=rectangular_on)
    return validate(out)


# ---------------------------------------------------------------- JSON

def to_json(extract: Extract) -> str:
    """The request form: names as keys of empty objects."""
    structure: dict[str, Any] = {}
    if extract.data_structure == "rectangular":
        structure = {"rectangular": {"on": extract.rectangular_on}}
    elif extract.data_structure == "hierarchical":
        structure = {"hierarchical": {}}
    return json.dumps({
        "description": extract.description or "",
        "data_structure": structure,
        "data_format": extract.data_format or "",
        "samples": {s: {} for s in extract.samples or ()},
        "variables": {v: {} for v in extract.variables or ()},
    }, indent=2)


def save_extract(extract: Extract, path: str) -> str:
    with open(path, "w", encoding="utf-8") as f:
        f.write(to_json(extract) + "\n")
    return path


def _from_dict(d: dict, collection: str) -> Extract:
    structure = next(iter(d.get("data_structure") or {}), None)
    on = d["data_structure"][structure].get("on") if structure == "rectangular" else None
    return Extract(
        collection=collection, description=d.get("description"), samples=tuple(d.get("samples") or {}),
        variables=tuple(d.get("variables") or {}), data_format=d.get("data_format"), data_structure=structure,
        rectangular_on=on, submitted="number" in d, download_links=d.get("download_links") or {},
        number=d.get("number"), status=d.get("status", "unsubmitted"))


def extract_from_json(source: str, collection: str, registry: Mapping[str, str] = COLLECTIONS) -> Extract:
    """Exactly one definition, from JSON text or from a file path."""
    if collection not in registry:
        raise ValueError(f"unknown collection {collection}; known_collections() lists the codes")
    text = source
    if not source.lstrip().startswith(("{", "[")):
        with open(source, encoding="utf-8") as f:
            text = f.read()
    found = json.loads(text)
    found = found if isinstance(found, list) else [found]
    if len(found) != 1:
        raise ValueError(f"expected one extract definition, found {len(found)}")
    return validate(_from_dict(found[0], collection))


# ---------------------------------------------------------------- the extract log

def extract_log(documents: DataFrame, json_col: str = "value", collection: str | Column | None = None) -> DataFrame:
    """One row per extract out of JSON documents: one object, or an array of them, per row.

    Sample and variable names are the keys of their objects. What is missing gets the default
    of an unsubmitted extract.
    """
    text = q(json_col)
    # from_json reads a single object where an array is declared as a one-element array
    rows = documents.select(
        *([collection.alias("collection")] if isinstance(collection, Column) else [F.lit(collection).alias("collection")]),
        F.explode(F.from_json(text, f"array<struct<{_struct_fields()}>>")).alias("e"))
    e = F.col("e")
    structure = F.when(e["data_structure"]["rectangular"].isNotNull(), "rectangular").when(
        e["data_structure"]["hierarchical"].isNotNull(), "hierarchical")
    return rows.select(
        "collection",
        e["description"].alias("description"),
        structure.alias("data_structure"),
        e["data_structure"]["rectangular"]["on"].alias("rectangular_on"),
        e["data_format"].alias("data_format"),
        F.map_keys(e["samples"]).alias("samples"),
        F.map_keys(e["variables"]).alias("variables"),
        e["number"].isNotNull().alias("submitted"),
        F.coalesce(e["download_links"], F.map_from_arrays(
            F.array().cast("array<string>"), F.array().cast("array<struct<url:string,bytes:bigint,sha256:string>>"))
        ).alias("download_links"),
        e["number"].alias("number"),
        F.coalesce(e["status"], F.lit("unsubmitted")).alias("status"),
    )


def _struct_fields() -> str:
    return ("data_structure: struct<rectangular: struct<`on`: string>, hierarchical: map<string, string>>, "
            "data_format: string, description: string, samples: map<string, string>, variables: map<string, string>, "
            "download_links: map<string, struct<url: string, bytes: bigint, sha256: string>>, number: bigint, "
            "status: string")


def parse_extract_id(extract) -> tuple[str, int]:
    """(collection, number) from an :class:`Extract`, a pair, or "collection:number"."""
    if isinstance(extract, Extract):
        if extract.number is None:
            raise ValueError("an extract that was not submitted has no number")
        return extract.collection.lower(), extract.number
    parts = extract.split(":") if isinstance(extract, str) else list(extract)
    if len(parts) != 2:
        raise ValueError("name an extract as Extract, (collection, number) or 'collection:number'")
    try:
        return str(parts[0]).lower(), int(float(parts[1]))
    except ValueError as err:
        raise ValueError(f"not an extract number: {parts[1]}") from err


def extract_info(log: DataFrame, extract) -> DataFrame:
    """Log row of one extract."""
    collection, number = parse_extract_id(extract)
    return log.filter((F.lower("collection") == collection) & (F.col("number") == number))


def recent_extracts(log: DataFrame, collection: str | None = None, how_many: int = 10) -> DataFrame:
    """The most recent extracts, highest number first."""
    mine = log if collection is None else log.filter(F.col("collection") == collection)
    return mine.orderBy(F.col("number").desc_nulls_last()).limit(how_many)


def last_extract(log: DataFrame, collection: str | None = None) -> DataFrame:
    return recent_extracts(log, collection, 1)


def is_ready(links: Column | str = "download_links", status: Column | str = "status") -> Column:
    """Completed, with links to both the codebook and the data."""
    links = q(links) if isinstance(links, str) else links
    status = q(status) if isinstance(status, str) else status
    has = lambda k: F.coalesce(F.try_element_at(links, F.lit(k))["url"].isNotNull(), F.lit(False))
    return F.coalesce(status == "completed", F.lit(False)) & has("ddi_codebook") & has("data")


def extracts_to_log(spark: SparkSession, extracts: Sequence[Extract]) -> DataFrame:
    """Extract definitions as rows of a log."""
    schema = (
        "collection string, description string, data_structure string, rectangular_on string, data_format string, "
        "samples array<string>, variables array<string>, submitted boolean, "
        "download_links map<string, struct<url: string, bytes: bigint, sha256: string>>, number bigint, status string")
    rows = [(e.collection, e.description, e.data_structure, e.rectangular_on, e.data_format, list(e.samples or ()),
             list(e.variables or ()), e.submitted,
             {k: (v.get("url"), v.get("bytes"), v.get("sha256")) for k, v in e.download_links.items()}, e.number, e.status)
            for e in extracts]
    return spark.createDataFrame(rows, schema)


def log_to_extracts(log: DataFrame) -> Iterator[Extract]:
    """The rows of a log as extract definitions, fetched partition by partition."""
    for r in log.toLocalIterator():
        links = {k: v.asDict() for k, v in (r["download_links"] or {}).items()}
        yield Extract(r["collection"], r["description"], tuple(r["samples"] or ()), tuple(r["variables"] or ()), r["data_format"],
                      r["data_structure"], r["rectangular_on"], r["submitted"], links, r["number"], r["status"])


# ---------------------------------------------------------------- running an extract

def run_extract(extract: Extract, person: DataFrame, household: DataFrame | None = None, sample: str = "SAMPLE",
                keys: Sequence[str] = (), cases: Column | None = None, skew: str = "aqe") -> DataFrame:
    """Select samples and variables and put household variables on person rows.

    Sample and case filters are applied before the join and reach a columnar source; only
    wanted columns and keys are read. With ``sample`` on the household side only, households
    are filtered and persons kept by their key.
    """
    validate(extract)
    wanted = list(extract.variables)
    chosen = list(extract.samples)
    p_names = person.columns
    h_names = household.columns if household is not None else []
    unknown = [v for v in wanted if v not in p_names and v not in h_names]
    if unknown:
        raise ValueError("Variables not available: " + ", ".join(unknown))
    p, h = person, household
    by_household = sample not in p_names
    if not by_household:
        p = p.filter(q(sample).isin(chosen))
    elif household is None or sample not in h_names:
        raise ValueError(f"no sample column {sample}")
    from_h = [v for v in wanted if v not in p_names]
    if h is not None and sample in h_names:
        h = h.filter(q(sample).isin(chosen))
    if h is not None and (from_h or by_household):
        mark = ["__in"] if by_household else []
        slim_h = h.select(*dict.fromkeys([*keys, *from_h]))
        if by_household:
            slim_h = slim_h.withColumn("__in", F.lit(True))
        need = [c for c in p_names if c in {*keys, *wanted} or (cases is not None)]
        p = rectangularize(p.select(*[q(c) for c in need]), slim_h, list(keys), skew)
        if by_household:
            p = p.filter(F.col("__in"))
        metas = {**all_meta(person), **(all_meta(household) if household is not None else {}), **all_meta(p)}
        p = with_meta(p.drop(*mark), {c: metas[c] for c in p.columns if c in metas})
    if cases is not None:
        p = p.filter(cases)
    return p.select(*[q(v) for v in wanted])


def write_extract(df: DataFrame, extract: Extract, path: str, widths: dict[str, int] | None = None,
                  decimals: dict[str, int] | None = None):
    """Write the result in the extract's format; fixed width returns the codebook for it."""
    from ..sources import sinks
    if extract.data_format == "fixed_width":
        if not widths:
            raise ValueError("fixed width needs the width of every variable")
        return sinks.write_fixed_width(df, path, sinks.layout(df, {c: widths[c] for c in df.columns}, decimals))
    if extract.data_format == "csv":
        return sinks.write_csv(df, path)
    if extract.data_format == "parquet":
        return sinks.write_parquet(df, path)
    raise NotImplementedError(f"{extract.data_format} is a foreign statistical format; use one of {SINK_FORMATS}")


def subsample(df: DataFrame, fraction: float, keys: Sequence[str] | None = None, seed: int = 42) -> DataFrame:
    """Random part of the rows, or, with ``keys``, of whole groups (households).

    The keyed form decides by a hash of the key: the same groups every time, no shuffle.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    if keys is None:
        return df.sample(withReplacement=False, fraction=fraction, seed=seed)
    buckets = 1_000_000
    h = F.pmod(F.xxhash64(*[q(k) for k in keys], F.lit(seed)), F.lit(buckets))
    return df.filter(h < F.lit(int(round(fraction * buckets))))
