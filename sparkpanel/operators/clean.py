"""Projection, filtering and cleaning operators.

All are narrow transformations (no shuffle) except the samplers, which rank
rows by a reproducible md5 key.  The per-group sampler ranks inside salted
sub-groups first so that a hot group is split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.functions.columns import md5_order


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Give columns their real meaning."""
    return df.withColumnsRenamed(mapping)


# ---------------------------------------------------------------- schema repair / role inference

def header_shift_report(df: DataFrame, col: str, threshold: float = 10_000_000) -> DataFrame:
    """One aggregate telling whether a time/code column holds values above ``threshold``.

    A shifted header puts large ids (dates, codes) into a small-valued column.
    """
    return df.agg(F.lit(col).alias("column_name"), F.max(F.col(col)).alias("max_value"),
                  (F.max(F.col(col)) > F.lit(threshold)).alias("is_shifted"))


def repair_header_shift(df: DataFrame, col: str, threshold: float = 10_000_000) -> DataFrame:
    """Shift column names left by one when the report says so (driver reads one row).

    This is one of the documented places where a library call runs a small job:
    the decision changes the schema, which must be known before planning.
    """
    shifted = header_shift_report(df, col, threshold).first()["is_shifted"]
    if not shifted:
        return df
    names = df.columns[1:] + ["_extra"]
    return df.toDF(*names)


def infer_roles(df: DataFrame, cols: list[str], hour_range=(0, 23), code_range=(11_000_000, 12_000_000)) -> DataFrame:
    """Classify numeric columns by value range in ONE aggregation.

    hour: integral values within 0..23 (at most 24 distinct values follows from
    integrality, so no distinct count is needed); code: integral values within the
    code range; else measure.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column_name"), F.min(x).alias("min_value"), F.max(x).alias("max_value"),
                             (F.count_if(x != F.floor(x)) == 0).alias("is_integral")).alias(c))
    row = df.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in cols])))
    role = (F.when(F.col("is_integral") & (F.col("min_value") >= hour_range[0]) & (F.col("max_value") <= hour_range[1]), "hour")
            .when(F.col("is_integral") & (F.col("min_value") >= code_range[0]) & (F.col("max_value") <= code_range[1]), "region_code")
            .otherwise("measure"))
    return row.withColumn("role", role)


def roles_by_name(df: DataFrame, rules: dict[str, list[str]]) -> dict[str, str]:
    """Column roles from name substrings (metadata only, no job)."""
    out = {}
    for f in df.schema.fields:
        for role, subs in rules.items():
            if any(s in f.name for s in subs):
                out.setdefault(role, f.name)
    return out


# ---------------------------------------------------------------- filters

def filter_in(df: DataFrame, col: str, values) -> DataFrame:
    """Membership filter; a DataFrame of values becomes a left-semi join."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias(col)), col, "left_semi")
    return df.where(F.col(col).isin(list(values)))


def regex_match(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """Case-insensitive regex row match; NULL counts as no match."""
    return df.where(F.coalesce(F.col(col), F.lit("")).rlike(f"(?i){pattern}"))


def local_date(ts: Column, tz: str) -> Column:
    """UTC wall time -> local calendar date in ``tz``."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts))


def temporal_split(date_col: Column, train_until_year: int, test_year: int, test_months) -> Column:
    """P14: 'train' up to a year, 'test' for a month list of a later year, else NULL."""
    return (F.when(F.year(date_col) <= train_until_year, "train")
            .when((F.year(date_col) == test_year) & F.month(date_col).isin(list(test_months)), "test"))


# ---------------------------------------------------------------- sampling

def hash_sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """P25: exactly n rows, reproducible: the n smallest md5(key || seed)."""
    return df.orderBy(md5_order(key, seed), F.col(key)).limit(n)


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    salt_buckets: int = 64, salt_key: Column | None = None) -> DataFrame:
    """Keep the first n rows of every group under ``order`` (skew-safe).

    Stage 1 ranks inside (group, salt) sub-groups, so a group holding a third
    of all rows is spread over ``salt_buckets`` tasks and each keeps at most n
    rows; stage 2 ranks the <= n * salt_buckets survivors per group.
    """
    salt = F.pmod(F.xxhash64(salt_key if salt_key is not None else F.struct(*df.columns)), F.lit(salt_buckets))
    s = df.withColumn("__salt", salt)
    w1 = Window.partitionBy(*group, "__salt").orderBy(*order)
    s = s.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= n)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return s.withColumn("__rank", F.row_number().over(w2)).where(F.col("__rank") <= n).drop("__salt", "__r1")


def group_sample_n(df: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows per group by md5 order (salted two-stage top-n)."""
    order = [md5_order(key, seed), F.col(key)]
    return top_n_per_group(df, [group], order, n, salt_key=F.col(key)).withColumnRenamed("__rank", "sample_rank")


# ---------------------------------------------------------------- parsing helpers

def split_author_line(text: Column, sep: str = " ") -> tuple[Column, Column, Column]:
    """3 parts -> author, publisher, date; 2 -> author, publisher; 1 -> author."""
    parts = F.split(F.trim(text), sep)
    n = F.size(parts)
    author = F.trim(F.element_at(parts, 1))
    publisher = F.when(n >= 2, F.trim(F.element_at(parts, 2)))
    date = F.when(n >= 3, F.trim(F.element_at(parts, 3)))
    return author, publisher, date


def url_tail(url: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(url, "/"), -1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)


def absolute_url(link: Column, host: Column) -> Column:
    """Relative link -> absolute using the page host."""
    return (F.when(link.startswith("http://") | link.startswith("https://"), link)
            .when(link.startswith("/"), F.concat(host, link))
            .otherwise(F.concat(host, F.lit("/"), link)))
