"""Large rows in slices: one slice is shuffled and written at a time, and its shuffle files go before the next.

A shuffle of all listings takes several times the disk of the listings as they are stored, and Spark keeps its files until the
driver collects the plan as garbage. Where the stored listings are larger than ``SLICE_BYTES``, few steps over
them run at once and each writes its table slice by slice, so that at any time few slices' shuffles are on disk.
Below that, steps run together and write whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: stored bytes of a slice; the most slices, as each slice of the fact reads and shuffles the dimensions anew; and the
#: steps in slices that run at once
SLICE_BYTES, MOST_SLICES, MOST_STEPS = 512 << 20, 6, 2


def slice_count(size: int | None) -> int:
    """Slices of rows that take ``size`` bytes; one where the size is not known."""
    return min(MOST_SLICES, max(1, -(-(size or 0) // SLICE_BYTES)))


def _dealt(rows: DataFrame, n: int, number: Column) -> list[DataFrame]:
    return [rows] if n <= 1 else [rows.filter(F.pmod(number, F.lit(n)) == i) for i in range(n)]


def by_month(rows: DataFrame, n: int, month: str = "year_month") -> list[DataFrame]:
    """``n`` slices of whole months, dealt in turn; rows without a month are in the first.

    Of a table partitioned by month a slice opens its own months alone.
    """
    return _dealt(rows, n, F.coalesce(F.year(month) * 12 + F.month(month), F.lit(0)))


def by_key(rows: DataFrame, n: int, key: str) -> list[DataFrame]:
    """``n`` slices by the hash of a column: rows of one key share a slice."""
    return _dealt(rows, n, F.xxhash64(key))
