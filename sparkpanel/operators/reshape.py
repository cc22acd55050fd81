"""Crosstabs, pivots, unpivots and set operations.

Pivots take an explicit value list (no extra distinct job, a stable output schema) and
fail on a value outside it; ``crosstab_wide`` can also derive its columns.  Margins come from ``cube``/``rollup`` with ``grouping_id`` so
that a margin is never confused with a real NULL key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOTAL = "__total__"


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts for every (row, col) cell plus both margins and the grand total.

    Output: row, col, n, is_row_total, is_col_total.  Keys are NOT NULL filtered
    first (pandas drops null keys), so NULL in the output always means "margin".
    """
    src = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return src.cube(row, col).agg(F.count(F.lit(1)).alias("n"),
                                  F.grouping(col).cast("boolean").alias("is_row_total"),
                                  F.grouping(row).cast("boolean").alias("is_col_total"))


def listed(col: str, values: list) -> Column:
    """The column, failing the query on a value outside ``values``: a fixed column list never drops rows silently."""
    c = F.col(col)
    known = F.assert_true(c.isNull() | c.isin(values), F.concat(F.lit(f"category of {col} without a column: "), c.cast("string")))
    return F.when(known.isNull(), c)


def categories(df: DataFrame, col: str) -> list:
    """The values that occur, sorted (one small job: the schema depends on them)."""
    return sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().collect())


def crosstab_wide(df: DataFrame, row: str, col: str, values: list[str] | None = None, total_label: str = "Total",
                  safe_names: dict | None = None) -> DataFrame:
    """Crosstab with margins, one column per value (``pd.crosstab(margins=True)``, A18).

    The grand-total row carries ``total_label`` in the row column.  Output columns
    are ``row, <value>..., total`` with zero fill.  Without ``values`` every category that
    occurs gets a column; with them, another category fails the query.
    """
    safe_names = safe_names or {}
    src = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    values = categories(src, col) if values is None else values
    src = src.select(row, listed(col, values).alias(col))
    aggs = [F.count_if(F.col(col) == F.lit(v)).alias(safe_names.get(v, v)) for v in values]
    g = src.rollup(row).agg(*aggs, F.count(F.lit(1)).alias("total"),
                            F.grouping(row).alias("__g"))
    return g.select(F.when(F.col("__g") == 1, F.lit(total_label)).otherwise(F.col(row).cast("string")).alias(row),
                    *[safe_names.get(v, v) for v in values], "total")


def row_percent(df: DataFrame, row: str, col: str, scale: float = 100.0) -> DataFrame:
    """Crosstab normalised by row (``normalize='index'`` x 100, A19/W8)."""
    c = df.where(F.col(row).isNotNull() & F.col(col).isNotNull()).groupBy(row, col).agg(
        F.count(F.lit(1)).alias("n"))
    tot = c.groupBy(row).agg(F.sum("n").alias("__rt"))
    return c.join(tot, row).select(row, col, "n", (F.col("n") * scale / F.col("__rt")).alias("pct"))


def pivot_unique(df: DataFrame, index: str, column: str, value: str, values: list[str],
                 suffix: str = "") -> DataFrame:
    """Long -> wide with a uniqueness guarantee.

    pandas ``pivot`` raises on a duplicate (index, column) pair.  Here the check
    runs inside the same job: ``assert_true`` fails the query when any cell
    holds more than one row.
    """
    cnt = df.withColumn(column, listed(column, values)).groupBy(index, column).agg(F.count(F.lit(1)).alias("__n"), F.first(value).alias("__v"))
    # the value depends on the assertion, so the check cannot be pruned away
    ok = F.assert_true(F.col("__n") <= 1, F.lit("duplicate entries in pivot"))
    checked = cnt.select(index, column, F.when(ok.isNull(), F.col("__v")).alias("__v"))
    wide = checked.groupBy(index).pivot(column, values).agg(F.first("__v"))
    return wide.select(index, *[F.col(f"`{v}`").alias(f"{v}{suffix}") for v in values])


def unpivot_measures(df: DataFrame, ids: list[str], measures: list[str], var: str = "variable",
                     val: str = "value") -> DataFrame:
    """Wide -> long (``melt``, A23)."""
    return df.unpivot(ids, measures, var, val)


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def hierarchical_counts(df: DataFrame, levels: list[str]) -> DataFrame:
    """Counts at every prefix of the level list (sunburst path, A41)."""
    g = df.rollup(*levels).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("level_id"))
    return g
