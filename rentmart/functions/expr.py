"""Column-level building blocks (projections, predicates, conditional aggregates).

All of them are plain ``pyspark.sql.functions`` expressions, so they stay inside
whole-stage codegen and aggregate map-side before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The NULL tokens of the listing and census CSV feeds.
NULL_TOKENS = ["\\N", "NULL", "NUL", ""]

# Fixed value: id of the "unknown" suburb member.
UNKNOWN_SUBURB_ID = 99999999
UNKNOWN = "unknown"


def as_column(c) -> Column:
    """A column by its name, or the column itself."""
    return F.col(c) if isinstance(c, str) else c


# ---- projections / scalar functions -----------------------------------------

def null_tokens(c) -> Column:
    """NULL for any of the feed's NULL tokens, the value otherwise (S3)."""
    c = as_column(c)
    return F.when(~c.isin(*NULL_TOKENS), c)


def month_floor(d) -> Column:
    """First day of the month of a date or timestamp, as a DATE."""
    return F.trunc(as_column(d).cast("date"), "month")


def month_text(d) -> Column:
    """Date rendered as 'yyyy-MM' (P5)."""
    return F.date_format(as_column(d), "yyyy-MM")


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to DATE with a pattern (P6); ``parse_date(month_text(d), "yyyy-MM")`` is
    the warehouse's two-step month floor, which ``month_floor`` does in one."""
    return F.to_date(as_column(c), fmt)


def substr_prefix(c, n: int = 3) -> Column:
    """Drop an n-character prefix: substr(c, n + 1)."""
    return F.substring(as_column(c), n + 1, 1 << 30)


def to_long(c) -> Column:
    """Text to bigint that also takes '93.0' (ANSI cast of such text to an integer raises)."""
    return F.round(as_column(c).cast("decimal(38,6)")).cast("bigint")


def stays(availability_30) -> Column:
    """30 - availability_30."""
    return F.lit(30) - as_column(availability_30)


def revenue(price, availability_30) -> Column:
    """price * (30 - availability_30), bigint."""
    return as_column(price) * stays(availability_30)


def ratio_pct(num, den) -> Column:
    """num / nullif(den, 0) * 100 as double."""
    return as_column(num).cast("double") / F.nullif(as_column(den), F.lit(0)) * 100


def ratio(num, den) -> Column:
    """num / nullif(den, 0) as double (A10)."""
    return as_column(num).cast("double") / F.nullif(as_column(den), F.lit(0))


def ratio_decimal(num, den, scale: int = 6) -> Column:
    """Exact quotient rounded to ``scale`` places, decimal(38, scale) (the exported form)."""
    q = as_column(num).cast("decimal(38,0)") / F.nullif(as_column(den), F.lit(0)).cast("decimal(38,0)")
    return F.round(q, scale).cast(f"decimal(38,{scale})")


# ---- conditional aggregates --------------------------------------------------

def count_if(cond) -> Column:
    """count(case when cond then 1 end) (A1): NULL conditions do not count."""
    return F.count(F.when(as_column(cond), F.lit(1)))


def min_if(cond, x) -> Column:
    return F.min(F.when(as_column(cond), as_column(x)))


def max_if(cond, x) -> Column:
    return F.max(F.when(as_column(cond), as_column(x)))


def sum_if(cond, x) -> Column:
    return F.sum(F.when(as_column(cond), as_column(x)))


def avg_if(cond, x) -> Column:
    return F.avg(F.when(as_column(cond), as_column(x)))


def median_if(cond, x) -> Column:
    """Exact interpolated median of x over rows where cond holds, double (A3).

    Spark's percentile keeps a value->count map per group and merges it
    map-side; with prices capped below 2000 that map is bounded.
    """
    return F.median(F.when(as_column(cond), as_column(x))).cast("double")


def approx_median_if(cond, x, accuracy: int = 10000) -> Column:
    """approx_percentile(x, 0.5) over rows where cond holds (A3, opt-in)."""
    return F.percentile_approx(F.when(as_column(cond), as_column(x)), 0.5, accuracy)


def count_distinct_if(cond, x) -> Column:
    """count(distinct case when cond then x end) (A5)."""
    return F.count_distinct(F.when(as_column(cond), as_column(x)))
