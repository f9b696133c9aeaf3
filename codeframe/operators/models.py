"""Regressions over tables of any size.

Least squares needs two passes: the means, then the moments of the shifted model matrix, both sums computed JVM-side
with partial aggregation; only the k x k system is solved on the driver. The shift does not change
the result but keeps the sums well conditioned. Terms that are close to collinear lose half their digits in moments; they are fitted by
triangular factors instead, one for each task, merged as a tree. Generalised models use Spark ML's iterative fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..metadata import get_meta, is_numeric, q
from ..session import tune
from ..sources.scratch import scratch_path

MAX_LEVELS = 1000  # default bound of the levels of a factor; a parameter of the fits
FAN = 32  # factors that one task merges
MOST_CONDITION = 1e6  # of the scaled design, up to which moments keep at least four digits more than needed for 1e-6
DEPENDENT = 1e-12  # part of a column's length that the columns before it leave, from which it counts as their combination


@dataclass(frozen=True)
class Factor:
    """A categorical term: one 0/1 column per level but the first.

    ``levels`` fixes them; by default they are the label texts' order or the sorted values.
    """

    col: str
    levels: tuple | None = None


def _number(v: float) -> float | None:
    return None if np.isnan(v) else float(v)


@dataclass
class LinearFit:
    """Coefficients and covariance of a least-squares fit."""

    names: list[str]
    coef: np.ndarray
    vcov: np.ndarray
    sigma2: float
    n: int
    df_residual: int
    r_squared: float

    def table(self, spark) -> DataFrame:
        se = np.sqrt(np.diag(self.vcov))
        rows = [(t, _number(b), _number(s), float(b / s) if s > 0 else None) for t, b, s in zip(self.names, self.coef, se)]
        return spark.createDataFrame(rows, "term string, estimate double, std_error double, t_value double")

    def vcov_table(self, spark) -> DataFrame:
        rows = [(a, b, _number(self.vcov[i, j])) for i, a in enumerate(self.names) for j, b in enumerate(self.names)]
        return spark.createDataFrame(rows, "term1 string, term2 string, cov double")


def factor_levels(df: DataFrame, f: Factor, max_levels: int = MAX_LEVELS) -> list:
    """Levels of a factor term, in order. More than ``max_levels`` is an error: the driver solves a k x k system, and the
    caller says how large a one it may be."""
    if f.levels is not None:
        return list(f.levels)
    meta = get_meta(df, f.col)
    present = [r[0] for r in df.select(q(f.col)).filter(q(f.col).isNotNull()).distinct().limit(max_levels + 1).collect()]
    if len(present) > max_levels:
        raise ValueError(f"{f.col} has more than {max_levels} levels; max_levels allows more")
    if meta.levels is not None:
        rest = sorted(v for v in present if v not in meta.levels)
        return [v for v in meta.levels if v in present] + rest
    return sorted(present)


def _design(df: DataFrame, terms: Sequence, max_levels: int) -> tuple[list[str], list[Column]]:
    names: list[str] = []
    cols: list[Column] = []
    for i, t in enumerate(terms):
        if isinstance(t, str) and not is_numeric(df.schema[t].dataType) and not isinstance(df.schema[t].dataType, T.BooleanType):
            t = Factor(t)
        if isinstance(t, Factor):
            levels = factor_levels(df, t, max_levels)
            meta = dict(get_meta(df, t.col).val_labels)
            for level in levels[1:]:
                names.append(f"{t.col}{meta.get(level, level)}")
                cols.append((q(t.col) == F.lit(level)).cast("double"))
        elif isinstance(t, str):
            names.append(t)
            cols.append(q(t).cast("double"))
        elif isinstance(t, tuple):
            names.append(t[0])
            cols.append(t[1].cast("double"))
        else:
            raise TypeError("a term is a column name, (name, column) or Factor")
    return names, cols


def _independent(a: np.ndarray, tol: float = 1e-10) -> list[int]:
    """Columns that are no linear combination of earlier ones (``a`` has unit diagonal)."""
    used: list[int] = []
    for j in range(len(a)):
        left = a[j, j]
        if used:
            left -= a[j, used] @ np.linalg.solve(a[np.ix_(used, used)], a[used, j])
        if left > tol:
            used.append(j)
    return used


def triangular_factor(frame: DataFrame, cols: Sequence[str], intercept: bool) -> tuple[np.ndarray, int]:
    """(R, rows) of the matrix (1, ``cols``, y), its rows scaled by the root of w: the upper triangle with R'R = X'X.

    Each task keeps the factor of the rows it has seen and takes up a batch by factoring both together; the factors of the tasks are merged ``FAN`` at a time in the same
    way. A task holds a batch and a triangle, and one triangle comes to the driver.
    """
    size = len(cols) + 1 + intercept

    def stacked(parts: list[np.ndarray]) -> np.ndarray:
        r = np.linalg.qr(np.concatenate(parts), mode="r")
        return np.concatenate([r, np.zeros((size - len(r), size))]) if len(r) < size else r

    def row(number: int, n: int, r: np.ndarray) -> list[pa.Array]:
        return [pa.array([number], pa.int64()), pa.array([n], pa.int64()), pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())]

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r, n = np.zeros((0, size)), 0
        for batch in batches:
            if batch.num_rows:
                x = np.column_stack([c.to_numpy() for c in batch.columns[:-1]])
                x = np.column_stack([np.ones(len(x)), x]) if intercept else x
                r = stacked([r, x * np.sqrt(batch.columns[-1].to_numpy())[:, None]])
                n += batch.num_rows
        if n:
            yield pa.RecordBatch.from_arrays(row(TaskContext.get().partitionId(), n, r), names=["id", "n", "r"])

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        parts = [np.frombuffer(x).reshape(size, size) for x in table["r"].to_pylist()]
        return pa.Table.from_arrays(row(table["id"][0].as_py() // FAN, sum(table["n"].to_pylist()), stacked(parts)), names=["id", "n", "r"])

    schema = "id long, n long, r binary"
    spark = frame.sparkSession
    path = scratch_path(spark, "factors")
    frame.select(*cols, "y", "w").mapInArrow(factor, schema).write.parquet(path)
    factors = spark.read.schema(schema).parquet(path)
    most = factors.agg(F.max("id")).first()[0]
    if most is None:
        return np.zeros((size, size)), 0
    while most > 0:
        factors = factors.groupBy(F.expr(f"id div {FAN}")).applyInArrow(merge, schema)
        most //= FAN
    last = factors.first()
    return np.frombuffer(bytes(last["r"])).reshape(size, size), last["n"]


def _independent_columns(r: np.ndarray) -> list[int]:
    """Columns that are no combination of earlier ones, by what an orthogonal basis of those leaves of them (projected twice, so that rounding does not hide it)."""
    basis, used = np.zeros((len(r), 0)), []
    for j in range(r.shape[1]):
        length = np.linalg.norm(r[:, j])
        if not length:
            continue
        left = r[:, j] / length
        for _ in range(2):
            left = left - basis @ (basis.T @ left)
        size = np.linalg.norm(left)
        if size > DEPENDENT * np.sqrt(len(used) + 1):
            basis, used = np.column_stack([basis, left / size]), [*used, j]
    return used


def _fit_by_factor(frame: DataFrame, cols: list[str], names: list[str], intercept: bool) -> LinearFit:
    r, n = triangular_factor(frame, cols, intercept)
    k = len(cols) + intercept
    if n < k:
        raise ValueError(f"{n} complete rows for {k} coefficients")
    used = _independent_columns(r[:, :k])
    q_, t = np.linalg.qr(r[:, used])
    inverse = np.linalg.solve(t, np.eye(len(used)))
    coef, cov = np.full(k, np.nan), np.full((k, k), np.nan)
    coef[used] = inverse @ (q_.T @ r[:, k])
    cov[np.ix_(used, used)] = inverse @ inverse.T
    rest = r[:, k] - q_ @ (q_.T @ r[:, k])
    rss, tss = float(rest @ rest), float(r[int(intercept):, k] @ r[int(intercept):, k])
    dof = n - len(used)
    sigma2 = rss / dof if dof > 0 else float("nan")
    return LinearFit(["(Intercept)", *names] if intercept else names, coef, cov * sigma2, sigma2, int(n), int(dof), 1.0 - rss / tss if tss > 0 else float("nan"))


def linear_model(df: DataFrame, response: str | Column, terms: Sequence, weights: str | Column | None = None,
                 intercept: bool = True, max_levels: int = MAX_LEVELS, method: str = "auto") -> LinearFit:
    """(Weighted) least squares. Rows with a NULL in any used column are left out.

    ``terms``: column names, ``(name, column)`` pairs such as ``("AGE^2", F.col("AGE")**2)``,
    and :class:`Factor`. Text columns count as factors. A term that is a combination of
    earlier ones gets NaN.

    ``method``: "moments", "qr" (:func:`triangular_factor`), or "auto": moments, and the factor where the moments show terms so close to collinear that it matters.
    """
    if method not in ("auto", "moments", "qr"):
        raise ValueError('method must be "auto", "moments" or "qr"')
    tune(df.sparkSession)
    names, xs = _design(df, terms, max_levels)
    y = (q(response) if isinstance(response, str) else response).cast("double")
    w = F.lit(1.0) if weights is None else (q(weights) if isinstance(weights, str) else weights).cast("double")
    k = len(xs)
    cols = [f"x{i}" for i in range(k)]
    frame = df.select(*[c.alias(n) for c, n in zip(xs, cols)], y.alias("y"), w.alias("w")).dropna()
    if weights is not None:
        frame = frame.filter("w > 0")
    if method == "qr":
        return _fit_by_factor(frame, cols, names, intercept)
    vars_ = [*cols, "y"]
    # Any centre is exact; the means of all rows keep the sums small and depend on no row order.
    centre = frame.agg(*[F.avg(c).alias(c) for c in vars_]).first() if intercept else None
    c0 = np.array([(centre[v] or 0.0) if centre is not None else 0.0 for v in vars_])
    shifted = frame.select(*[(F.col(v) - F.lit(float(c))).alias(v) for v, c in zip(vars_, c0)], "w")
    aggs = [F.count("*").alias("n"), F.sum("w").alias("sw")]
    aggs += [F.sum(F.col("w") * F.col(v)).alias(f"s_{i}") for i, v in enumerate(vars_)]
    aggs += [F.sum(F.col("w") * F.col(vars_[i]) * F.col(vars_[j])).alias(f"s_{i}_{j}")
             for i in range(k + 1) for j in range(i + 1)]
    m = shifted.agg(*aggs).first()
    n = m["n"]
    if n < k + (1 if intercept else 0):
        raise ValueError(f"{n} complete rows for {k + (1 if intercept else 0)} coefficients")
    s = np.array([m[f"s_{i}"] for i in range(k + 1)])
    full = np.zeros((k + 1, k + 1))
    for i in range(k + 1):
        for j in range(i + 1):
            full[i, j] = full[j, i] = m[f"s_{i}_{j}"]
    sw = m["sw"]
    if intercept:
        full = full - np.outer(s, s) / sw
    mean = s / sw + c0 if intercept else np.zeros(k + 1)
    a, b, yy = full[:k, :k], full[:k, k], full[k, k]
    # Scaling to unit diagonal keeps terms such as AGE and AGE^2 solvable together.
    d = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
    used = _independent(a / np.outer(d, d))
    close = len(used) < k or (k > 1 and np.linalg.cond(a / np.outer(d, d)) > MOST_CONDITION ** 2)
    if method == "auto" and close:
        return _fit_by_factor(frame, cols, names, intercept)
    p = len(used) + (1 if intercept else 0)
    sub, du = np.ix_(used, used), d[used]
    inv = np.full((k, k), np.nan)
    slope = np.full(k, np.nan)
    inv_used = np.linalg.inv(a[sub] / np.outer(du, du)) / np.outer(du, du)
    inv[sub] = inv_used
    slope[used] = inv_used @ b[used]
    rss = float(max(yy - slope[used] @ b[used], 0.0))
    dof = n - p
    sigma2 = rss / dof if dof > 0 else float("nan")
    if intercept:
        xm = mean[:k]
        coef = np.concatenate([[mean[k] - xm[used] @ slope[used]], slope])
        cov = np.full((k + 1, k + 1), np.nan)
        cov[1:, 1:] = inv
        across = np.full(k, np.nan)
        across[used] = -(inv_used @ xm[used])
        cov[0, 1:] = cov[1:, 0] = across
        cov[0, 0] = 1.0 / sw + xm[used] @ inv_used @ xm[used]
        names = ["(Intercept)", *names]
    else:
        coef, cov = slope, inv
    tss = float(yy)
    return LinearFit(names, coef, cov * sigma2, sigma2, int(n), int(dof), 1.0 - rss / tss if tss > 0 else float("nan"))


def generalized_model(df: DataFrame, response: str, terms: Sequence, family: str = "binomial", link: str | None = "logit",
                      weights: str | None = None, max_iter: int = 25, tol: float = 1e-8, stage: bool = True,
                      max_levels: int = MAX_LEVELS) -> DataFrame:
    """Generalised linear model by iteratively reweighted least squares (several passes).

    Returns ``(term, estimate, std_error)``. Rows with a NULL in any used column are left out.
    ``stage`` writes the model columns once to the shared folder, so that the passes do not
    parse or join the source again. A binomial or Poisson model of factors only is fitted to the counts of its design
    cells: one pass over the rows, and the passes of the fit see one row a cell.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    names, xs = _design(df, terms, max_levels)
    cols = [f"x{i}" for i in range(len(xs))]
    keep = [q(response).cast("double").alias("y"), *[c.alias(n) for c, n in zip(xs, cols)]]
    if weights:
        keep.append(q(weights).cast("double").alias("w"))
    frame = df.select(*keep).dropna()
    factors = all(isinstance(t, Factor) or (isinstance(t, str) and not is_numeric(df.schema[t].dataType)) for t in terms)
    if factors and family in ("binomial", "poisson"):
        times = F.sum("w") if weights else F.count("*").cast("double")
        frame, weights = frame.groupBy("y", *cols).agg(times.alias("w")), "w"
        stage = True
    if stage:
        path = scratch_path(df.sparkSession, "model")
        frame.write.parquet(path)
        frame = df.sparkSession.read.schema(frame.schema).parquet(path)
    frame = VectorAssembler(inputCols=cols, outputCol="features").transform(frame)
    glr = GeneralizedLinearRegression(family=family, labelCol="y", featuresCol="features", maxIter=max_iter, tol=tol)
    if link:
        glr = glr.setLink(link)
    if weights:
        glr = glr.setWeightCol("w")
    model = glr.fit(frame)
    se = list(model.summary.coefficientStandardErrors)
    rows = list(zip([*names, "(Intercept)"], [*[float(c) for c in model.coefficients], float(model.intercept)],
                    [float(s) for s in se]))
    return df.sparkSession.createDataFrame(rows, "term string, estimate double, std_error double")


