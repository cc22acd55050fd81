"""Daily panels and window operators (J3, J4, W1-W10, A25, D6f).

Rule used throughout: raw rows are first reduced to one row per (series, day)
with a partial aggregation; windows are then partitioned by series and ordered
by day, so a window partition holds at most one row per calendar day of one
series (bounded by the date range, not by the data volume or key skew).

``running_totals`` / ``rank_within_groups`` are the ordered computations over
a whole table (ROC/PR curves, rank sums, splits).  They never funnel rows into a
single task and run nothing while the plan is built: rows fall into buckets that
are a monotone function of the order key, each bucket is scanned locally, and the
totals of buckets, of blocks of buckets and of blocks of blocks supply the offsets
(a prefix scan of three levels, each partitioned by the one above it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpanel.functions.columns import value_bucket

#: parts of a coarse value bucket; the bucket of nulls (they sort first); coarse buckets in a block
FINE, LOWEST, BLOCK = 4096, -(10 ** 15), 1024
#: texts of one coarse bucket are told apart after what they share, looked for in so many leading bytes
SHARED = 256


def daily(df: DataFrame, ts: str, series: list[str], aggs: list[Column], day: str = "day") -> DataFrame:
    """Reduce raw rows to one row per (series, day)."""
    return df.groupBy(*series, F.to_date(F.col(ts)).alias(day)).agg(*aggs)


def date_spine(df: DataFrame, day: str, series: list[str]) -> DataFrame:
    """Every calendar day between each series' first and last day (D6f).

    One generator row per series (no join with a calendar table).
    """
    span = df.groupBy(*series).agg(F.min(day).alias("__lo"), F.max(day).alias("__hi"))
    return span.select(*series, F.explode(F.sequence("__lo", "__hi", F.expr("interval 1 day"))).alias(day))


def on_spine(df: DataFrame, day: str, series: list[str]) -> DataFrame:
    """Left join a sparse daily series onto its full date spine (missing days -> NULL)."""
    return date_spine(df, day, series).join(df, [*series, day], "left")


def rolling(df: DataFrame, series: list[str], order: str, cols: list[str], n: int = 30,
            fns=("sum", "avg")) -> DataFrame:
    """Trailing n-row window per series, ``min_periods=1``."""
    w = Window.partitionBy(*series).orderBy(order).rowsBetween(-(n - 1), 0)
    out = df
    for c in cols:
        for fn in fns:
            out = out.withColumn(f"{c}_{fn}{n}", getattr(F, fn)(F.col(c)).over(w))
    return out


def ffill_bfill(df: DataFrame, series: list[str], order: str, col: str, out: str | None = None) -> DataFrame:
    """Forward fill, then back fill the leading gap."""
    out = out or f"{col}_filled"
    fw = Window.partitionBy(*series).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    bw = Window.partitionBy(*series).orderBy(order).rowsBetween(0, Window.unboundedFollowing)
    return df.withColumn(out, F.coalesce(F.last(col, True).over(fw), F.first(col, True).over(bw)))


def interpolate_linear(df: DataFrame, series: list[str], order: str, col: str, out: str | None = None) -> DataFrame:
    """Linear interpolation by row position (pandas ``interpolate()``, W4).

    Gaps between two known values are filled linearly; trailing gaps repeat the
    last known value; leading gaps stay NULL.
    """
    out = out or f"{col}_interp"
    base = Window.partitionBy(*series).orderBy(order)
    fw = base.rowsBetween(Window.unboundedPreceding, 0)
    bw = base.rowsBetween(0, Window.unboundedFollowing)
    known_rn = F.when(F.col(col).isNotNull(), F.col("__rn"))
    d = (df.withColumn("__rn", F.row_number().over(base))
         .withColumn("__pv", F.last(col, True).over(fw)).withColumn("__pr", F.last(known_rn, True).over(fw))
         .withColumn("__nv", F.first(col, True).over(bw)).withColumn("__nr", F.first(known_rn, True).over(bw)))
    interp = (F.when(F.col("__pv").isNull(), F.lit(None))
              .when(F.col("__nv").isNull() | (F.col("__nr") == F.col("__pr")), F.col("__pv"))
              .otherwise(F.col("__pv") + (F.col("__nv") - F.col("__pv")) * (F.col("__rn") - F.col("__pr"))
                         / (F.col("__nr") - F.col("__pr"))))
    return d.withColumn(out, interp).drop("__rn", "__pv", "__pr", "__nv", "__nr")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Deterministic ``drop_duplicates(keep='first')`` under a caller-given order.

    ``min_by`` is a partial aggregate: a key holding a third of all rows is
    pre-reduced inside every map task, never gathered in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    # the remaining columns break ties, so the kept row never depends on file order
    total_order = list(order) + [c for c in rest if c not in order]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*total_order)).alias("__r"))
    return first.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def last_n(df: DataFrame, series: list[str], order: str, col: str, n: int = 7, out: str = "last_values") -> DataFrame:
    """The last n values of each series as an array, oldest first."""
    from sparkpanel.operators.clean import top_n_per_group

    top = top_n_per_group(df.select(*series, order, col), series, [F.desc(order)], n, salt_key=F.col(order))
    g = top.groupBy(*series).agg(F.array_sort(F.collect_list(F.struct(order, col))).alias("__a"))
    return g.select(*series, F.transform("__a", lambda s: s[col]).alias(out))


def last_vs_previous(df: DataFrame, series: list[str], order: str, col: str) -> DataFrame:
    """Last value, previous value, change and % change per series.

    Rows are reduced to one per (series, order) first, so the window holds one row per day.
    """
    d = df.groupBy(*series, order).agg(F.max(col).alias(col))
    d = d.withColumn("previous", F.lag(col).over(Window.partitionBy(*series).orderBy(order)))
    g = d.groupBy(*series).agg(F.max_by(F.struct(order, col, "previous"), order).alias("__last"))
    last, previous = F.col(f"__last.{col}"), F.col("__last.previous")
    return g.select(*series, F.col(f"__last.{order}").alias(f"last_{order}"), last.alias("last"), previous.alias("previous"),
                    (last - previous).alias("change"), F.try_divide((last - previous) * 100.0, previous).alias("change_pct"))


def _number(df: DataFrame, column: str) -> Column | None:
    """A double that never runs against the order of ``column``; None for texts."""
    kind, c = df.schema[column].dataType.typeName(), F.col(column)
    if kind == "string":
        return None
    if kind == "date":
        return F.unix_date(c).cast("double")
    if kind == "timestamp":
        return F.unix_micros(c) / 1e6
    if kind == "timestamp_ntz":  # from its parts: the session's time zone has no say
        return F.unix_date(F.to_date(c)) * 86400.0 + F.hour(c) * 3600.0 + F.minute(c) * 60.0 + F.extract(F.lit("SECOND"), c).cast("double")
    return c.cast("double")


def _shared_bytes(lo: Column, hi: Column) -> Column:
    """Length of the common start of two texts in bytes, at most SHARED."""
    a, b = F.encode(lo, "UTF-8"), F.encode(hi, "UTF-8")
    most = F.least(F.octet_length(lo), F.octet_length(hi), F.lit(SHARED))
    same = F.filter(F.sequence(F.lit(1), most), lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i))
    return F.when(most > 0, F.size(same)).otherwise(0)


def _six_bytes(text: Column, skip: Column) -> Column:
    """The six bytes after ``skip`` bytes as a number (exact in a double); missing bytes count as zero."""
    part = F.hex(F.substr(F.encode(text, "UTF-8"), skip + 1, F.lit(6)))
    return F.conv(F.rpad(part, 12, "0"), 16, 10).cast("double")


def _attach(rows: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """Join per-key totals back to the rows they were made from; null keys match."""
    other = totals.withColumnsRenamed({k: f"__k{i}" for i, k in enumerate(keys)})
    return rows.join(other, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])


def _bucketed(df: DataFrame, groups: list[str], column: str) -> DataFrame:
    """``df`` plus __s, __b and __f: block, coarse bucket and one of FINE equal parts between the
    smallest and the largest value of the coarse bucket.

    Numbers, dates and times: ``value_bucket``, BLOCK of them to a block (fewer than 1,500
    blocks over all doubles).  Texts: the first four characters, a block being the first two;
    parts are cut by the six bytes after what all texts of the bucket share, so keys with a
    common start spread as well.  All three only depend on values, so nothing has to be
    pinned by a checkpoint.  Rows with equal values share a bucket.
    """
    x = _number(df, column)
    if x is None:
        d = df.withColumn("__b", F.coalesce(F.substring(column, 1, 4), F.lit("")))
        ends = d.groupBy(*groups, "__b").agg(F.min(column).alias("__l"), F.max(column).alias("__h"))
        ends = ends.withColumn("__p", F.coalesce(_shared_bytes(F.col("__l"), F.col("__h")), F.lit(0)))
        ends = ends.select(*groups, "__b", "__p", _six_bytes(F.col("__l"), F.col("__p")).alias("__lo"), _six_bytes(F.col("__h"), F.col("__p")).alias("__hi"))
        x, block = _six_bytes(F.col(column), F.col("__p")), F.substring("__b", 1, 2)
    else:
        d = df.withColumn("__b", F.coalesce(value_bucket(x), F.lit(LOWEST)))
        ends = d.groupBy(*groups, "__b").agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
        block = F.floor(F.col("__b") / BLOCK)
    part = F.floor((x - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * FINE).cast("int")
    fine = F.coalesce(F.when(F.col("__hi") > F.col("__lo"), F.least(part, F.lit(FINE - 1))), F.lit(0))
    return _attach(d, ends, [*groups, "__b"]).select(*d.columns, block.alias("__s"), fine.alias("__f"))


def _offsets(totals: DataFrame, groups: list[str], values: list[str], descending: bool) -> DataFrame:
    """Per bucket (groups, __b, __f) the sums of ``values`` over all buckets before it, as __o_<value>.

    Three levels: parts inside a coarse bucket, coarse buckets inside a block, blocks.  Only the
    last one, a row per block, runs over a whole group.
    """
    way = F.desc if descending else F.asc

    def level(df: DataFrame, inside: list[str], order: str, name: str) -> DataFrame:
        w = Window.partitionBy(*groups, *inside).orderBy(way(order)).rowsBetween(Window.unboundedPreceding, -1)
        return df.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"__{name}_{v}") for v in values])

    sums = [F.sum(v).alias(v) for v in values]
    middle = totals.groupBy(*groups, "__s", "__b").agg(*sums)
    top = level(middle.groupBy(*groups, "__s").agg(*sums), [], "__s", "top").drop(*values)
    middle = _attach(level(middle, ["__s"], "__b", "mid").drop(*values), top, [*groups, "__s"])
    middle = middle.select(*groups, "__b", *[(F.col(f"__mid_{v}") + F.col(f"__top_{v}")).alias(f"__up_{v}") for v in values])
    low = level(totals, ["__b"], "__f", "low")
    return _attach(low, middle, [*groups, "__b"]).select(
        *groups, "__b", "__f", *[(F.col(f"__low_{v}") + F.col(f"__up_{v}")).alias(f"__o_{v}") for v in values])


def running_totals(df: DataFrame, order: str, cols: list[str], descending: bool = True) -> DataFrame:
    """Cumulative sums of ``cols`` in ``order`` over a whole table, distributed and lazy.

    Sums per value bucket, a prefix scan over the buckets, and a local running sum inside each
    bucket plus the bucket's offset.  Rows with equal ``order`` values get sums in no fixed
    order: group by it first.  Output adds ``cum_<col>`` for every col.
    """
    b = _bucketed(df, [], order)
    way = F.desc if descending else F.asc
    totals = b.groupBy("__s", "__b", "__f").agg(*[F.sum(c).alias(f"__t_{c}") for c in cols])
    offsets = _offsets(totals, [], [f"__t_{c}" for c in cols], descending)
    local = Window.partitionBy("__b", "__f").orderBy(way(order)).rowsBetween(Window.unboundedPreceding, 0)
    j = _attach(b.select("*", *[F.sum(c).over(local).alias(f"__l_{c}") for c in cols]), offsets, ["__b", "__f"])
    return j.select(*df.columns, *[(F.col(f"__l_{c}") + F.col(f"__o___t_{c}")).alias(f"cum_{c}") for c in cols])


def curve_points(scored: DataFrame, score: str, label: str) -> DataFrame:
    """ROC / PR points: one point per distinct score, thresholds descending (W9/ML10).

    Rows are grouped by score first (partial aggregation), so the ordered step
    sees one row per distinct score.
    """
    g = scored.groupBy(score).agg(F.sum(F.col(label).cast("bigint")).alias("pos"),
                                  F.sum((1 - F.col(label)).cast("bigint")).alias("neg"))
    tot_p = scored.agg(F.sum(F.col(label).cast("bigint"))).scalar()
    tot_n = scored.agg(F.sum((1 - F.col(label)).cast("bigint"))).scalar()
    c = running_totals(g, score, ["pos", "neg"], descending=True)
    return c.select(F.col(score).alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                    F.try_divide(F.col("cum_pos"), tot_p).alias("tpr"), F.try_divide(F.col("cum_neg"), tot_n).alias("fpr"),
                    F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"))


def rank_within_groups(df: DataFrame, groups: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Exact 1-based rank of every row inside its group under a total ``order``, lazy.

    A per-group ``row_number`` window would put a whole group (possibly a third of the
    table) into one task.  Instead each group is cut into buckets of the first order column,
    rows are numbered inside a bucket, and shifted by the size of the group's earlier
    buckets (one row per group and bucket).  ``order`` must be a total order (end it with a
    unique key).  Nulls form a group of their own and sort first.  Rows with equal values in
    the first order column share a bucket: put a column with many values, a hash say, first.
    """
    b = _bucketed(df, groups, order[0])
    keys = [*groups, "__b", "__f"]
    counts = b.groupBy(*groups, "__s", "__b", "__f").agg(F.count(F.lit(1)).alias("__c"))
    offsets = _offsets(counts, groups, ["__c"], descending=False)
    local = b.withColumn("__lr", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return _attach(local, offsets, keys).select(*df.columns, (F.col("__lr") + F.col("__o___c")).alias(name))
