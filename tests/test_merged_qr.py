import numpy as np
import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe.operators import models


def by_qr(x, y, w=None):
    """Coefficients and covariance by one QR in double precision."""
    w = np.ones(len(x)) if w is None else w
    x, y = x * np.sqrt(w)[:, None], y * np.sqrt(w)
    q, r = np.linalg.qr(x)
    coef = np.linalg.solve(r, q.T @ y)
    inv = np.linalg.solve(r, np.eye(len(r)))
    rest = y - x @ coef
    return coef, inv @ inv.T * (rest @ rest) / (len(x) - x.shape[1])


def frame(spark, seed=1, n=5000, parts=70):
    rng = np.random.default_rng(seed)
    a, z, e = rng.normal(50, 10, n), rng.normal(0, 1, n), rng.normal(0, 1e-3, n)
    b = a + 1e-7 * z
    y = 3 + 2 * a - 5 * b + 0.5 * z + e
    w = rng.uniform(0.5, 2, n)
    rows = [tuple(map(float, r)) for r in zip(a, b, y, w)]
    return spark.createDataFrame(rows, "a double, b double, y double, w double").repartition(parts), np.column_stack([np.ones(n), a, b]), y, w


def test_close_to_collinear(spark):
    df, x, y, w = frame(spark)
    assert np.linalg.cond(x) > 1e9
    for weights, given in ((None, None), ("w", w)):
        coef, cov = by_qr(x, y, given)
        fit = cf.linear_model(df, "y", ["a", "b"], weights)
        error = np.sqrt(np.diag(cov))
        assert np.allclose(fit.coef, coef, rtol=1e-6, atol=0)
        # in units of the standard errors; one double QR differs from exact arithmetic by up to 1e-6 here, merged ones by up to 6e-6, moments in all digits
        assert np.abs((fit.vcov - cov) / np.outer(error, error)).max() < 1e-5
        assert fit.n == 5000 and fit.df_residual == 4997
    moments = cf.linear_model(df, "y", ["a", "b"], method="moments")
    assert np.isnan(moments.coef).any() or not np.allclose(moments.coef, by_qr(x, y)[0], rtol=1e-6)


def test_both_ways_agree_on_plain_designs(spark):
    df, *_ = frame(spark, 2, 500, 40)
    df = df.withColumn("c", F.when(F.col("a") > 50, "u").when(F.col("a") > 45, "v").otherwise("w")).withColumn("a2", F.col("a") ** 2)
    for intercept in (True, False):
        one, two = (cf.linear_model(df, "y", ["a", "a2", "c"], "w", intercept, method=m) for m in ("qr", "moments"))
        assert one.names == two.names and np.allclose(one.coef, two.coef, rtol=1e-7) and np.allclose(one.vcov, two.vcov, rtol=1e-5)
        assert np.isclose(one.r_squared, two.r_squared) and np.isclose(one.sigma2, two.sigma2) and one.df_residual == two.df_residual


def test_combinations_of_earlier_terms(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") * 3.0 + F.sin("id")).alias("y"))
    terms = ["a", ("twice", 2 * F.col("a") + 1), "b", ("sum", F.col("a") + F.col("b")), ("zero", F.lit(0.0))]
    fit = cf.linear_model(df, "y", terms, method="qr")
    assert np.isnan(fit.coef).tolist() == [False, False, True, False, True, True]
    plain = cf.linear_model(df, "y", ["a", "b"], method="moments")
    assert np.allclose(fit.coef[[0, 1, 3]], plain.coef) and fit.df_residual == plain.df_residual and np.isclose(fit.sigma2, plain.sigma2)
    assert np.allclose(fit.vcov[np.ix_([0, 1, 3], [0, 1, 3])], plain.vcov)


def test_few_rows_nulls_and_empty_parts(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.5), (3.0, 5.5), (None, 1.0), (4.0, None)], "a double, y double").repartition(20)
    fit = cf.linear_model(df, "y", ["a"], method="qr")
    assert fit.n == 3 and np.allclose(fit.coef, [0.5, 1.75])
    with pytest.raises(ValueError, match="complete rows"):
        cf.linear_model(df.limit(0), "y", ["a"], method="qr")
    with pytest.raises(ValueError, match="method"):
        cf.linear_model(df, "y", ["a"], method="svd")


def test_factor_of_many_tasks_is_one_factor(spark):
    df, x, y, w = frame(spark, 3, 4000, 1500)
    r, n = models.triangular_factor(df.select("a", "b", "y", "w"), ["a", "b"], True)
    full = np.column_stack([x, y]) * np.sqrt(w)[:, None]
    assert n == 4000 and np.allclose(r.T @ r, full.T @ full) and np.allclose(np.tril(r, -1), 0)
