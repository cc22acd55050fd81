"""Least-squares models per item from one aggregation (ML15).

A linear model needs no pass over its rows beyond their means and covariances.  One
aggregation gives them for every item at once (``covar_pop`` merges without cancellation,
partial aggregation keeps a hot item cheap): p features are p * (p + 3) / 2 numbers per item,
whatever its rows.  A small solve per item follows on those rows, in Arrow batches.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: features are collinear when the smallest singular value of their correlation matrix is below this share of the largest
SINGULAR = 1e-10


def moments(df: DataFrame, by: list[str], features: list[str], target: str) -> DataFrame:
    """(by, n, means, target_mean, cov, target_cov, target_var): per group, over rows without a null or NaN.

    ``cov`` is the upper triangle, row by row, of the features' covariance matrix.
    """
    x = [F.col(f"`{f}`").cast("double") for f in features]
    y = F.col(f"`{target}`").cast("double")
    whole = reduce(lambda a, b: a & b, [c.isNotNull() & ~F.isnan(c) for c in [*x, y]])
    rows = df.where(whole).select(*by, *[c.alias(f"__x{i}") for i, c in enumerate(x)], y.alias("__y"))
    names = [f"__x{i}" for i in range(len(x))]
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in names]).alias("means"), F.avg("__y").alias("target_mean"),
        F.array(*[F.covar_pop(a, b) for i, a in enumerate(names) for b in names[i:]]).alias("cov"),
        F.array(*[F.covar_pop(c, "__y") for c in names]).alias("target_cov"), F.var_pop("__y").alias("target_var"))


def solve(p: int, cov: list[float], target_cov: list[float]) -> np.ndarray | None:
    """Coefficients from the covariances; None where they are not determined."""
    full = np.zeros((p, p))
    full[np.triu_indices(p)] = cov
    full = full + np.triu(full, 1).T
    scale = np.sqrt(np.diag(full))
    if not np.all(np.isfinite(scale)) or not np.all(scale > 0):
        return None
    corr = full / np.outer(scale, scale)
    values = np.linalg.svd(corr, compute_uv=False)
    if values[-1] < SINGULAR * values[0]:
        return None
    return np.linalg.solve(corr, np.asarray(target_cov) / scale) / scale


def fit_items(df: DataFrame, by: list[str], features: list[str], target: str, min_rows: int = 20) -> DataFrame:
    """(by, n, mode, coefficients, intercept, r2), one row per group of ``df``.

    ``mode`` is ``model``, or ``rule`` with null coefficients where the group has fewer than
    ``min_rows`` whole rows or its features do not determine a model (constant or collinear).
    Null group keys are a group.
    """
    p = len(features)

    @F.pandas_udf("array<double>")
    def coefficients(n: pd.Series, cov: pd.Series, target_cov: pd.Series) -> pd.Series:
        return pd.Series([None if k < max(min_rows, p + 1) else None if (b := solve(p, c, t)) is None else b.tolist()
                          for k, c, t in zip(n, cov, target_cov)], dtype=object)

    m = moments(df, by, features, target).withColumn("b", coefficients("n", "cov", "target_cov"))
    dot = lambda values: F.aggregate(F.arrays_zip(F.col("b").alias("b"), F.col(values).alias("v")), F.lit(0.0), lambda a, z: a + z["b"] * z["v"])
    fitted = m.select(*by, F.when(F.col("b").isNull(), "rule").otherwise("model").alias("mode"), F.col("b").alias("coefficients"),
                      (F.col("target_mean") - dot("means")).alias("intercept"), F.try_divide(dot("target_cov"), F.col("target_var")).alias("r2"), "n")
    groups = df.select(*by).distinct()
    join = reduce(lambda a, b: a & b, [groups[c].eqNullSafe(fitted[c]) for c in by])
    return groups.join(fitted, join, "left").select(*[groups[c] for c in by], F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("mode", F.lit("rule")).alias("mode"),
                                                    "coefficients", "intercept", "r2")


def predicted(features: list[Column]) -> Column:
    """The model's value for the given feature columns, beside the columns of ``fit_items``; null in rule mode."""
    return reduce(lambda a, b: a + b, [F.get("coefficients", F.lit(i)) * x for i, x in enumerate(features)], F.col("intercept"))
