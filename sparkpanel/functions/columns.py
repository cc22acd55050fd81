"""Column builders: native Spark expressions for the scalar and aggregate helpers.

Everything here returns a ``Column`` and stays inside whole-stage codegen; no
Python UDF is involved.  Division is always ``try_divide`` (ANSI raises on x/0).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def try_cast(x, to: str) -> Column:
    """CAST that yields NULL instead of raising (ANSI) on bad input."""
    return _c(x).try_cast(to)


# ---------------------------------------------------------------- arithmetic

def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (pandas would give inf / NaN)."""
    return F.try_divide(_c(num), _c(den))


def pct_change(new, base) -> Column:
    """(new - base) * 100 / base with a zero-base guard."""
    return F.try_divide((_c(new) - _c(base)) * F.lit(100.0), _c(base))


def round_half_away(x, digits: int = 0) -> Column:
    """Round the binary double half away from zero (the C / numpy / DuckDB rule).

    Spark's ``round`` rounds the shortest decimal text of a double, so 212463.48625
    (stored as 212463.486249999...) becomes .4863; pandas and DuckDB give .4862.
    Double-only arithmetic (t - fmod(t, 1) instead of ``floor``, which returns a
    bigint) keeps very large values from overflowing.
    """
    m = F.lit(float(10 ** digits))
    c = _c(x).cast("double")
    t = F.abs(c) * m + F.lit(0.5)
    return F.signum(c) * (t - t % F.lit(1.0)) / m


def clamp(x, lo, hi) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


def nan_to_null(x) -> Column:
    """Spark orders NaN above every number; missing values are NULL here."""
    return F.nanvl(_c(x), F.lit(None).cast("double"))


def flag_at_least(x, threshold) -> Column:
    """0/1 flag, NULL input counts as 0."""
    return F.coalesce((_c(x) >= F.lit(threshold)).cast("int"), F.lit(0))


# ---------------------------------------------------------------- aggregates

def pairwise(x, y):
    """Null out both sides when either is NULL (pairwise-complete rows)."""
    x, y = _c(x), _c(y)
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x.cast("double")), F.when(both, y.cast("double"))


def safe_corr(x, y) -> Column:
    """Pearson r over pairwise-complete rows; NULL for a constant side.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI on a constant column, so the
    coefficient is composed from population covariance and deviations.
    """
    px, py = pairwise(x, y)
    return F.try_divide(F.covar_pop(px, py), F.stddev_pop(px) * F.stddev_pop(py))


def skew_sample(x) -> Column:
    """Bias-corrected sample skewness (the pandas ``skew``); NULL when n < 3."""
    x = _c(x).cast("double")
    n = F.count(x).cast("double")
    g1 = F.skewness(x)
    return F.when(n >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def kurt_sample(x) -> Column:
    """Bias-corrected excess kurtosis (the pandas ``kurt``); NULL when n < 4."""
    x = _c(x).cast("double")
    n = F.count(x).cast("double")
    g2 = F.kurtosis(x)
    return F.when(n >= 4, ((n - 1) * ((n + 1) * g2 + 6)) / ((n - 2) * (n - 3)))


def skew_guarded(x) -> Column:
    """Skewness with the dashboard guards: n < 3 -> 0, zero spread -> 0."""
    return F.coalesce(skew_sample(x), F.lit(0.0))


def kurt_guarded(x) -> Column:
    """Excess kurtosis with guards: n < 4 -> 0, zero spread -> 0."""
    return F.coalesce(kurt_sample(x), F.lit(0.0))


def cv(x) -> Column:
    """Coefficient of variation: sample std / |mean|."""
    return F.try_divide(F.stddev_samp(_c(x)), F.abs(F.avg(_c(x))))


# ---------------------------------------------------------------- binning

def equal_width_bin(x, lo, hi, n_bins: int) -> Column:
    """1-based equal-width bin: floor((x - lo) * n / (hi - lo)) + 1.

    The upper edge falls in the last bin and lo == hi puts everything in bin 1
    (``width_bucket`` gives n+1 / NULL there).
    """
    x, lo, hi = _c(x), _c(lo), _c(hi)
    raw = F.floor(F.try_divide((x - lo) * F.lit(n_bins), hi - lo)) + 1
    # coalesce BEFORE least: least() skips NULLs, which would send lo == hi to the last bin
    return F.when(x.isNull(), None).otherwise(F.least(F.coalesce(raw, F.lit(1)), F.lit(n_bins)).cast("int"))


# ---------------------------------------------------------------- fixed values
# The 16 compass points, clockwise from north, in 22.5-degree steps.
COMPASS_16 = ["N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
              "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW"]


def degree_to_point(deg, missing_label: str = "calm") -> Column:
    """Degrees -> one of 16 compass points (sector centred on each point)."""
    idx = F.floor(F.pmod(_c(deg) + F.lit(11.25), F.lit(360.0)) / F.lit(22.5)).cast("int")
    labels = F.array(*[F.lit(s) for s in COMPASS_16])
    return F.when(_c(deg).isNull(), F.lit(missing_label)).otherwise(F.element_at(labels, idx + 1))


# ---------------------------------------------------------------- dates

def cycle_sin(date_col, period: float = 365.25) -> Column:
    return F.sin(F.lit(2 * math.pi) * F.dayofyear(_c(date_col)) / F.lit(period))


def cycle_cos(date_col, period: float = 365.25) -> Column:
    return F.cos(F.lit(2 * math.pi) * F.dayofyear(_c(date_col)) / F.lit(period))


def parse_compact_date(text) -> Column:
    """``yyyyMMdd`` text -> date; anything else -> NULL."""
    t = _c(text)
    return F.when(t.rlike(r"^[0-9]{8}$"), F.to_date(F.try_to_timestamp(t, F.lit("yyyyMMdd"))))


_MICROS_PER_DAY = 86_400_000_000


def instant_to_utc_ntz(ts) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding its UTC wall time.

    Built from epoch micro-seconds and the unix date, so the result does not depend
    on ``spark.sql.session.timeZone`` (a plain cast would).
    """
    m = F.unix_micros(_c(ts))
    d = F.floor(m / F.lit(_MICROS_PER_DAY))
    rest = m - d * F.lit(_MICROS_PER_DAY)
    return F.date_from_unix_date(d.cast("int")).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (rest / F.lit(1_000_000)).cast("decimal(18,6)"))


def ntz_as_utc_instant(ts) -> Column:
    """TIMESTAMP_NTZ wall time read as UTC -> TIMESTAMP (session-zone independent)."""
    c = _c(ts)
    day_micros = F.unix_date(F.to_date(c)).cast("bigint") * F.lit(_MICROS_PER_DAY)
    tod = (F.hour(c).cast("bigint") * 3_600_000_000 + F.minute(c).cast("bigint") * 60_000_000
           + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint"))
    return F.timestamp_micros(day_micros + tod)


def parse_rfc1123(text) -> Column:
    """``Mon, 08 Jun 2026 10:00:00 +0900`` -> UTC wall time (TIMESTAMP_NTZ); bad text -> NULL.

    Spark 3+ rejects the day-name letter ``E`` in parse patterns, so the day name
    is cut off first; the zone offset in the text fixes the instant.
    """
    t = F.trim(_c(text))
    body = F.regexp_replace(t, r"^[A-Za-z]{3},\s*", "")
    return instant_to_utc_ntz(F.try_to_timestamp(body, F.lit("dd MMM yyyy HH:mm:ss Z")))


# ---------------------------------------------------------------- text

def strip_tags(x) -> Column:
    return F.regexp_replace(_c(x), r"<[^>]+>", "")


def keep_word_chars(x) -> Column:
    """Drop everything but letters (Hangul, Latin and other scripts), digits and blanks."""
    return F.regexp_replace(_c(x), r"[^\p{L}\p{N}\s]", "")


def squash_name(x) -> Column:
    """lower case, no blanks, no underscores (for alias matching)."""
    return F.regexp_replace(F.lower(F.trim(_c(x))), r"[\s_]+", "")


def truncate_text(x, n: int = 100) -> Column:
    x = _c(x)
    return F.when(F.length(x) > n, F.concat(F.left(x, F.lit(n)), F.lit("..."))).otherwise(x)


def money_text_to_long(x) -> Column:
    """'12,300' -> 12300; empty / non-numeric -> 0."""
    return F.coalesce(try_cast(F.regexp_replace(F.trim(_c(x)), ",", ""), "bigint"), F.lit(0).cast("bigint"))


def safe_double(x) -> Column:
    """blank / text / null -> NULL, else the number."""
    return try_cast(F.nullif(F.trim(_c(x).cast("string")), F.lit("")), "double")


def md5_order(key, seed) -> Column:
    """Deterministic pseudo-random order key, reproducible in other engines."""
    return F.md5(F.concat(_c(key).cast("string"), F.lit(str(seed))))


def value_bucket(x: Column) -> Column:
    """A bucket number that never decreases with the double ``x`` and depends on x alone.

    1,024 buckets per unit of ln(1 + |x|): about a thousandth of a value's size.  NaN sorts last.
    """
    big = 10 ** 9
    inside = F.floor(F.signum(x) * F.log1p(F.abs(x)) * F.lit(1024.0)).cast("long")
    return (F.when(F.isnan(x), F.lit(big + 1)).when(x == float("inf"), F.lit(big)).when(x == float("-inf"), F.lit(-big))
            .otherwise(inside).cast("long"))
