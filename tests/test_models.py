import numpy as np
import pytest
from pyspark.sql import functions as F

import codeframe as cf
from codeframe import Factor, VarMeta


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(7)
    n = 2000
    age = rng.integers(15, 99, n)
    health = rng.integers(1, 6, n)
    y = 30000 + 900 * age - 8 * age**2 + np.array([0, 500, -2000, -7000, -12000])[health - 1] + rng.normal(0, 5000, n)
    return age, health, y


@pytest.fixture(scope="module")
def frame(spark, sample):
    age, health, y = sample
    df = spark.createDataFrame([(float(c), int(a), int(h)) for a, h, c in zip(age, health, y)], "INCTOT double, AGE int, HEALTH int")
    return cf.with_meta(df, {"HEALTH": VarMeta(None, None, tuple((i, f"h{i}") for i in range(1, 6)))})


def ols(x, y, w=None):
    w = np.ones(len(y)) if w is None else w
    a = x.T @ (x * w[:, None])
    b = np.linalg.solve(a, x.T @ (w * y))
    s2 = float(w @ (y - x @ b) ** 2) / (len(y) - x.shape[1])
    return b, s2 * np.linalg.inv(a)


def design(age, health):
    return np.column_stack([np.ones(len(age)), age, age.astype(float) ** 2, *[(health == k).astype(float) for k in range(2, 6)]])


def test_coefficients_and_covariance(spark, frame, sample):
    age, health, y = sample
    fit = cf.linear_model(frame, "INCTOT", ["AGE", ("AGE^2", F.col("AGE") ** 2), Factor("HEALTH")])
    b, v = ols(design(age, health), y)
    assert fit.names == ["(Intercept)", "AGE", "AGE^2", "HEALTHh2", "HEALTHh3", "HEALTHh4", "HEALTHh5"]
    np.testing.assert_allclose(fit.coef, b, rtol=1e-8)
    np.testing.assert_allclose(fit.vcov, v, rtol=1e-6)
    assert fit.n == 2000 and fit.df_residual == 1993
    assert fit.vcov_table(spark).count() == 49


def test_weights_nulls_and_no_intercept(spark, frame, sample):
    age, health, y = sample
    more = frame.unionByName(spark.createDataFrame([(None, 30, 1), (5.0, None, 2)], "INCTOT double, AGE int, HEALTH int"))
    fit = cf.linear_model(more, "INCTOT", ["AGE"], weights=F.col("AGE") * 1.0)
    b, v = ols(np.column_stack([np.ones(len(y)), age]), y, age.astype(float))
    np.testing.assert_allclose(fit.coef, b, rtol=1e-8)
    np.testing.assert_allclose(fit.vcov, v, rtol=1e-6)
    fit = cf.linear_model(frame, "INCTOT", ["AGE"], intercept=False)
    b, v = ols(age[:, None].astype(float), y)
    np.testing.assert_allclose(fit.coef, b, rtol=1e-8)
    np.testing.assert_allclose(fit.vcov, v, rtol=1e-6)


def test_text_terms_are_factors(spark, frame, sample):
    age, health, y = sample
    text = cf.as_factor(frame, "HEALTH")
    fit = cf.linear_model(text, "INCTOT", ["AGE", "HEALTH"])
    x = np.delete(design(age, health), 2, axis=1)
    np.testing.assert_allclose(fit.coef, ols(x, y)[0], rtol=1e-8)


def test_too_few_rows(spark):
    with pytest.raises(ValueError, match="complete rows"):
        cf.linear_model(spark.createDataFrame([(1.0, 2.0)], "y double, x double"), "y", ["x"])


@pytest.mark.parametrize("stage", [False, True])
def test_logit(spark, frame, sample, stage):
    age, health, _ = sample
    df = frame.withColumn("high", (F.col("HEALTH") >= 3) & (F.pmod(F.hash("AGE", "HEALTH", "INCTOT"), F.lit(10)) > F.col("AGE") / 12))
    got = {r["term"]: r["estimate"] for r in cf.generalized_model(df, "high", ["AGE"], stage=stage).collect()}
    y = np.array([float(r[0]) for r in df.select(F.col("high").cast("double")).collect()])
    x = np.column_stack([np.ones(len(y)), [r[0] for r in df.select("AGE").collect()]]).astype(float)
    b = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]), x.T @ (y - p))
    assert got["(Intercept)"] == pytest.approx(b[0], rel=1e-5) and got["AGE"] == pytest.approx(b[1], rel=1e-5)


def test_aliased_terms(spark, frame, sample):
    age, _, y = sample
    fit = cf.linear_model(frame, "INCTOT", ["AGE", ("twice", F.col("AGE") * 2 + 1), ("none", F.lit(0.0)), ("sq", F.col("AGE") ** 2)])
    x = np.column_stack([np.ones(len(y)), age, age.astype(float) ** 2])
    b, v = ols(x, y)
    np.testing.assert_allclose(fit.coef[[0, 1, 4]], b, rtol=1e-7)
    np.testing.assert_allclose(fit.vcov[np.ix_([0, 1, 4], [0, 1, 4])], v, rtol=1e-5)
    assert np.isnan(fit.coef[[2, 3]]).all() and fit.df_residual == 1997
    assert fit.table(spark).filter("estimate is null").count() == 2


def test_intercept_only(frame, sample):
    fit = cf.linear_model(frame, "INCTOT", [])
    assert fit.coef[0] == pytest.approx(sample[2].mean()) and fit.vcov[0, 0] == pytest.approx(sample[2].var(ddof=1) / 2000)
