"""Hypothesis tests (A51 Welch t, A52 chi-square) and funnels.

The test statistics are aggregations in Spark (group n / mean / variance,
contingency counts).  Only the p-value needs a special function (regularised
incomplete beta / gamma); it is evaluated by a small Arrow (pandas) UDF on the
one-row result, so the query stays lazy and nothing is collected.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- special functions (plain Python)


def _log_half_step(x: float) -> float:
    """ln(Gamma(x + 1/2) / Gamma(x)); its asymptotic series where the two logarithms would cancel."""
    if x < 200.0:
        return math.lgamma(x + 0.5) - math.lgamma(x)
    return 0.5 * math.log(x) - 1 / (8 * x) + 1 / (192 * x ** 3) - 1 / (640 * x ** 5)


def t_two_sided_p(t: float, dof: float) -> float:
    """P(|T| > |t|) of Student's t, dof >= 1, by quadrature.

    With u = sqrt(dof) tan(angle) the tail is 2 c times the integral of cos(angle)^(dof - 1)
    from atan(|t| / sqrt(dof)) to pi / 2: a smooth bounded integrand, summed by
    Gauss-Legendre panels in z = angle sqrt(dof), where it falls like exp(-z^2 / 2).
    """
    if t is None or dof is None or math.isnan(t) or math.isnan(dof) or dof <= 0:
        return float("nan")
    if dof < 1:
        raise ValueError("the quadrature needs dof >= 1")
    root = math.sqrt(dof)
    lo, hi = math.atan(abs(t) / root) * root, math.pi / 2 * root
    hi = min(hi, lo + 40.0) if dof > 2 else hi
    nodes, weights = np.polynomial.legendre.leggauss(64)
    edges = np.linspace(lo, hi, 81)
    half = (edges[1:] - edges[:-1]) / 2
    z = (edges[:-1] + half)[:, None] + half[:, None] * nodes[None, :]
    log_cos = 0.5 * np.log1p(-np.minimum(np.sin(z / root) ** 2, 1 - 1e-300))
    integral = float((np.exp((dof - 1) * log_cos) * weights[None, :] * half[:, None]).sum())
    return min(1.0, 2 * math.exp(_log_half_step(dof / 2)) / math.sqrt(math.pi * dof) * integral)


def chi2_sf(x: float, dof: float) -> float:
    """P(X > x) of chi-square with a whole number of degrees of freedom, as its finite sum.

    Even dof: exp(-h) sum over k < dof/2 of h^k / k!, with h = x / 2.  Odd dof: erfc(sqrt(h)) plus
    exp(-h) times the sum of h^(k - 1/2) / Gamma(k + 1/2) for k from 1 to (dof - 1) / 2.
    """
    if x is None or dof is None or math.isnan(x) or math.isnan(dof) or dof <= 0:
        return float("nan")
    if dof != int(dof):
        raise ValueError("dof must be a whole number")
    if x <= 0:
        return 1.0
    h, n = x / 2.0, int(dof)
    power = (k for k in range(n // 2)) if n % 2 == 0 else (k - 0.5 for k in range(1, (n - 1) // 2 + 1))
    logs = [e * math.log(h) - math.lgamma(e + 1) - h for e in power]
    return min(1.0, math.fsum(map(math.exp, logs)) + (math.erfc(math.sqrt(h)) if n % 2 else 0.0))


@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(t, dof)],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def chi2_pvalue_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(a, b) if pd.notna(a) and pd.notna(b) else None for a, b in zip(x, dof)],
                     dtype="float64")


# ---------------------------------------------------------------- Welch t


def welch_t(df: DataFrame, value: str, group: Column, a_label="a", b_label="b", with_p: bool = False) -> DataFrame:
    """Welch's unequal-variance t test of ``value`` between group == a and group == b.

    One aggregation computes n, mean and sample variance of both groups
    (conditional aggregates); t and the Welch-Satterthwaite df are column
    arithmetic.  t follows the argument order: mean(a) - mean(b).
    """
    x = F.col(value).cast("double")
    in_a, in_b = group == F.lit(a_label), group == F.lit(b_label)
    s = df.agg(F.count(F.when(in_a, x)).alias("n_a"), F.count(F.when(in_b, x)).alias("n_b"),
               F.avg(F.when(in_a, x)).alias("mean_a"), F.avg(F.when(in_b, x)).alias("mean_b"),
               F.var_samp(F.when(in_a, x)).alias("var_a"), F.var_samp(F.when(in_b, x)).alias("var_b"))
    se2_a, se2_b = F.col("var_a") / F.col("n_a"), F.col("var_b") / F.col("n_b")
    t = F.try_divide(F.col("mean_a") - F.col("mean_b"), F.sqrt(se2_a + se2_b))
    dof = F.try_divide((se2_a + se2_b) * (se2_a + se2_b),
                       se2_a * se2_a / (F.col("n_a") - 1) + se2_b * se2_b / (F.col("n_b") - 1))
    out = s.select("n_a", "n_b", "mean_a", "mean_b", "var_a", "var_b", t.alias("t"), dof.alias("dof"))
    if with_p:
        out = out.withColumn("p_value", t_pvalue_udf("t", "dof"))
    return out


# ---------------------------------------------------------------- chi-square


def contingency(df: DataFrame, row: str, col: str) -> DataFrame:
    """Observed counts for every (row, col) cell over the values that occur, zero cells included.

    Null keys are left out.  The missing cells are the row values times the column values of
    the counted table, which has one row per occurring cell.
    """
    seen = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(F.count(F.lit(1)).alias("observed"))
    columns = seen.agg(F.collect_set(col)).scalar()
    cells = seen.select(row).distinct().select(row, F.explode(columns).alias(col))
    return cells.join(seen, [row, col], "left").select(row, col, F.coalesce("observed", F.lit(0).cast("long")).alias("observed"))


def chi_square(df: DataFrame, row: str, col: str, yates: bool = True, with_p: bool = False) -> DataFrame:
    """Chi-square test of independence over all categories; Yates' correction when dof = 1.

    Totals come from the counted cells, dof from the numbers of categories that occur; the
    correction follows scipy: |O - E| is reduced by min(0.5, |O - E|).
    """
    cells = contingency(df, row, col)
    rt = F.sum("observed").over(Window.partitionBy(row))
    ct = F.sum("observed").over(Window.partitionBy(col))
    n = cells.agg(F.sum("observed")).scalar()
    e = cells.select(row, col, "observed", (rt * ct / n).alias("expected"))
    plain = F.abs(F.col("observed") - F.col("expected"))
    stat = e.agg(F.count_distinct(row).alias("r"), F.count_distinct(col).alias("c"), F.sum("observed").alias("n"),
                 F.sum(F.try_divide(plain * plain, F.col("expected"))).alias("plain"),
                 F.sum(F.try_divide(F.pow(plain - F.least(F.lit(0.5), plain), F.lit(2)), F.col("expected"))).alias("yates"))
    dof = ((F.col("r") - 1) * (F.col("c") - 1)).cast("int")
    out = stat.select(F.when(F.lit(yates) & (dof == 1), F.col("yates")).otherwise(F.col("plain")).alias("chi2"), dof.alias("dof"), "n")
    if with_p:
        out = out.withColumn("p_value", chi2_pvalue_udf("chi2", F.col("dof").cast("double")))
    return out


# ---------------------------------------------------------------- funnels


def funnel(per_unit: DataFrame, steps: list[tuple[str, Column]], by: list[str] | None = None) -> DataFrame:
    """Nested-predicate funnel: step k counts units meeting predicates 1..k.

    One pass of conditional counts; the counts are stacked into rows and the
    step-to-step rate uses ``lag`` over the (tiny) step list.
    """
    by = by or []
    cond, aggs = None, []
    for i, (name, pred) in enumerate(steps):
        cond = pred if cond is None else (cond & pred)
        aggs.append(F.count_if(cond).alias(f"s{i}"))
    g = (per_unit.groupBy(*by) if by else per_unit).agg(F.count(F.lit(1)).alias("__all"), *aggs)
    arr = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(name).alias("step_name"), F.col(f"s{i}").alias("n"))
                    for i, (name, _) in enumerate(steps)])
    long = g.select(*by, "__all", F.explode(arr).alias("s")).select(*by, "__all", "s.*")
    w = Window.partitionBy(*by).orderBy("step")
    prev = F.lag("n").over(w)
    return long.select(*by, "step", "step_name", "n",
                       F.try_divide(F.col("n") * 100.0, F.col("__all")).alias("pct_all"),
                       F.try_divide(F.col("n") * 100.0, F.coalesce(prev, F.col("__all"))).alias("pct_prev"))
