"""Boundary layers: tables with a WKB ``geometry`` column in Parquet or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.charset import canonical
from ..metadata import q
from ..operators.bind import bind_layers
from ..select import Selection, pick
from .files import file_ext, find_files

GEOMETRY = "geometry"


def _layer_name(path: str) -> str:
    base = path.rstrip("/").rsplit("/", 1)[-1]
    return base.split(".", 1)[0]


def read_layer(spark: SparkSession, path: str, vars: Selection = None, encoding: str | None = None,
               geometry: str = GEOMETRY) -> DataFrame:
    """One layer. CSV layers hold the geometry as hexadecimal WKB."""
    if file_ext(path) in (".csv", ".csv.gz"):
        df = spark.read.csv(path, header=True, encoding=canonical(encoding))
        if geometry in df.columns:
            df = df.withColumn(geometry, F.unhex(q(geometry)))
    else:
        df = spark.read.parquet(path)
    if vars is None:
        return df
    names = pick(df.columns, vars)
    if geometry in df.columns and geometry not in names:
        names.append(geometry)  # the geometry always comes along
    return df.select(*[q(c) for c in names])


def read_boundaries(spark: SparkSession, source, shape_layer: Selection = None, vars: Selection = None,
                    encoding: str | None = None, bind_multiple: bool = True, add_layer: bool | None = None,
                    geometry: str = GEOMETRY) -> DataFrame:
    """One or several layers as one table.

    ``source`` is a path, a list of paths or ``{layer: path}``. A folder of layer files is
    taken as its layers. Several layers are bound (an error with ``bind_multiple=False``)
    and get a ``layer`` column.
    """
    if isinstance(source, str):
        layers = {_layer_name(source): source}
        if file_ext(source) == "":
            names = find_files(spark, source, r"(parquet|csv|csv\.gz)", None, multiple_ok=True)
            inside = [n for n in names if not n.startswith(("part-", "_", "."))]
            if inside:
                layers = {_layer_name(n): f"{source.rstrip('/')}/{n}" for n in inside}
    elif isinstance(source, dict):
        layers = dict(source)
    else:
        layers = {_layer_name(p): p for p in source}
    if shape_layer is not None:
        keep = pick(list(layers), shape_layer)
        layers = {k: layers[k] for k in keep}
    if not layers:
        raise ValueError("no layer found; check the `shape_layer` argument")
    if len(layers) > 1 and not bind_multiple:
        raise ValueError("several layers; select one with shape_layer or allow bind_multiple: " + ", ".join(layers))
    frames = {k: read_layer(spark, p, vars, encoding, geometry) for k, p in layers.items()}
    return bind_layers(frames, add_layer)


def is_geometry(df: DataFrame, col: str = GEOMETRY) -> bool:
    return col in df.columns and isinstance(df.schema[col].dataType, T.BinaryType)
