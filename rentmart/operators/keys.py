"""Dense surrogate keys: ``row_number() over (order by k1, .., kn)`` without one task.

A window with an ORDER BY and no PARTITION BY runs in a single task, which does
not survive a dimension the size of the fact table. Here the rows are range
partitioned on the key (sampled bounds, so a hot leading column still spreads
over several ranges), sorted inside each range, and numbered locally; a
per-range row count gives each range its offset. The ranged rows are checkpointed
to the shared checkpoint folder so partition contents and local positions stay
fixed if a task is retried or an executor is lost.

The only non-distributed step sums one count per range (as many rows as there
are partitions), and that table is what gets broadcast. The number of ranges
follows the bytes Spark expects of the input (file sizes of stored tables), and
``numbered`` also tells how many rows got an id, so that a later append can go on
from there without looking at the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentmart.session import ensure_checkpoint_dir

_PID, _POS, _N, _OFF = "__range_id", "__pos", "__range_rows", "__range_offset"
#: input bytes of a range, and the most ranges of one numbering
RANGE_BYTES, MOST_RANGES = 128 << 20, 100_000


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the tables that ``df`` reads, None where Spark does not know them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size if size < 1 << 62 else None


def range_count(df: DataFrame) -> int:
    """Ranges for ``df`` by the bytes of the tables it reads; the shuffle width where Spark does not know them.

    The estimate of the whole plan would not do: without column statistics a join counts as the product of its sides.
    """
    size = input_bytes(df)
    if size is None:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_RANGES, max(1, -(-size // RANGE_BYTES)))


def _order(cols: list[str]) -> list[Column]:
    # ascending, NULLs first: Spark's default, spelled out so oracles can match it
    return [F.col(c).asc_nulls_first() for c in cols]


def dense_surrogate_key(df: DataFrame, order_cols: list[str], id_col: str,
                        num_ranges: int | None = None, method: str = "range",
                        start: Column | int = 1) -> DataFrame:
    """Add ``id_col`` = 1-based position of each row in ``order_cols`` order.

    ``order_cols`` should make rows unique (the dimensions order by their whole
    tuple) so the ids are reproducible. ``method="window"`` is the single-task
    global window, kept for the month dimension (bounded by the calendar) and checks.
    ``start`` shifts the numbering (used to append new members after ``max(id)``).
    Both methods give the same ids.
    """
    start_col = start if isinstance(start, Column) else F.lit(start)
    if method == "window":
        w = Window.orderBy(*_order(order_cols))
        return df.withColumn(id_col, (F.row_number().over(w) - 1 + start_col).cast("bigint"))
    if method != "range":
        raise ValueError(f"unknown method {method!r}")

    out, counts = _ranged(df, order_cols, num_ranges)
    return _with_ids(out, counts, start_col, id_col)


def numbered(df: DataFrame, order_cols: list[str], id_col: str, num_ranges: int | None = None,
             start: int = 1) -> tuple[DataFrame, int]:
    """``dense_surrogate_key`` by ranges, and the number of rows it numbered (a sum over one row per range)."""
    out, counts = _ranged(df, order_cols, num_ranges)
    n = counts.agg(F.coalesce(F.sum(_N), F.lit(0))).first()[0]
    return _with_ids(out, counts, F.lit(start), id_col), int(n)


def _ranged(df: DataFrame, order_cols: list[str], num_ranges: int | None) -> tuple[DataFrame, DataFrame]:
    """The rows in sorted ranges, checkpointed, with their range and place; and the rows of each range."""
    ensure_checkpoint_dir(df.sparkSession)
    n = num_ranges or range_count(df)
    ranged = (df.repartitionByRange(n, *_order(order_cols))
              .sortWithinPartitions(*_order(order_cols))
              .withColumn(_PID, F.spark_partition_id())
              # position inside the range: the low 33 bits of the monotonic id
              .withColumn(_POS, F.monotonically_increasing_id() - (F.col(_PID).cast("bigint") * (1 << 33))))
    ranged = ranged.checkpoint(eager=True)
    return ranged, ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))


def _with_ids(ranged: DataFrame, counts: DataFrame, start_col: Column, id_col: str) -> DataFrame:
    offsets = counts.select(
        _PID,
        F.coalesce(F.sum(_N).over(Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias(_OFF))
    # one row per range: bounded by the partition count, safe to broadcast
    out = ranged.join(F.broadcast(offsets), _PID, "inner")
    return (out.withColumn(id_col, (F.col(_OFF) + F.col(_POS) + start_col).cast("bigint"))
            .drop(_PID, _POS, _OFF))
