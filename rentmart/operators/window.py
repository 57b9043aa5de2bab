"""Period-over-period operators over already aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rentmart.functions.expr import as_column


def lag_over(x, w: WindowSpec) -> Column:
    """Value of x in the previous *present* row of the window (W2); gaps are not filled."""
    return F.lag(as_column(x)).over(w)


def pct_change(x, w: WindowSpec) -> Column:
    """(x - lag(x)) / nullif(lag(x), 0) * 100 as double (W3); NULL for the first row."""
    prev = lag_over(x, w)
    return (as_column(x) - prev).cast("double") / F.nullif(prev, F.lit(0)) * 100


def monthly_lag(df: DataFrame, keys: list[str], x: str, month: str = "year_month",
                out: str | None = None) -> DataFrame:
    """Add ``lag(x)`` per ``keys`` ordered by ``month`` to an aggregated frame."""
    w = Window.partitionBy(*keys).orderBy(F.col(month).asc_nulls_first())
    return df.withColumn(out or f"prev_{x}", lag_over(x, w))


def monthly_pct_change(df: DataFrame, keys: list[str], x: str, month: str = "year_month",
                       out: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(month).asc_nulls_first())
    return df.withColumn(out or f"pct_change_{x}", pct_change(x, w))
