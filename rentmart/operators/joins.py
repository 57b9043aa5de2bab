"""Join shapes the warehouse uses (J1-J7), as DataFrame compositions.

All of them are equi-joins, so Spark keeps the hash / sort-merge strategies.
A side is broadcast only when its size is known to be small: with a structural
bound (``bounded=True``: months of the data, a fixed lookup), or by Spark's own
check of its bytes (the file sizes of a stored table, the shuffle sizes AQE sees
at run time) against ``spark.sql.autoBroadcastJoinThreshold``; above it the join
stays a shuffle join. The rebuild stores the reference dimensions before anything
joins them, so their real sizes are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_of(conds: list[Column]) -> Column:
    """AND of conditions."""
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def key_match(pairs: list[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """AND of equalities; NULL never matches unless ``null_safe``."""
    return all_of([a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])


def left_join(df: DataFrame, dim: DataFrame, on: Column, bounded: bool = False) -> DataFrame:
    """LEFT OUTER join; ``bounded`` marks a dimension whose size has a fixed bound."""
    return df.join(F.broadcast(dim) if bounded else dim, on, "left")


NULL_SPREAD = 1024


def composite_left_join(df: DataFrame, dim: DataFrame, pairs: list[tuple[str, str]],
                        null_safe: bool = False, bounded: bool = False,
                        spread_nulls: bool = True, spread_by: list[str] | None = None) -> DataFrame:
    """LEFT join on several (left column, dim column) pairs.

    With NULL-never-matches semantics a left row with a NULL key part cannot
    find a partner, yet in a shuffle join all such rows hash to one partition
    (a NULL review count or availability can be a large share of the rows).
    ``spread_nulls`` adds one more key: 0 on both sides for complete keys, and
    for incomplete left keys a value in 1..1024 from a hash of ``spread_by``
    (columns the query reads anyway, so the scan stays pruned; default: the key
    columns). The result is unchanged (those rows matched nothing before and
    still match nothing), but they spread over the partitions instead of piling
    into one.
    """
    on = key_match([(F.col(l), F.col(r)) for l, r in pairs], null_safe)
    if null_safe or not spread_nulls:
        return left_join(df, dim, on, bounded)
    complete = all_of([F.col(l).isNotNull() for l, _ in pairs])
    spread = F.when(complete, F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*[F.col(c) for c in (spread_by or [l for l, _ in pairs])]),
               F.lit(NULL_SPREAD)) + 1)
    j = left_join(df.withColumn("__spread", spread), dim.withColumn("__spread_d", F.lit(0)),
                  on & (F.col("__spread") == F.col("__spread_d")), bounded)
    return j.drop("__spread", "__spread_d")


def case_insensitive_left_join(df: DataFrame, dim: DataFrame, left: str, right: str,
                               bounded: bool = False, spread_nulls: bool = True,
                               spread_by: list[str] | None = None) -> DataFrame:
    """LEFT join on lower(left) = lower(right); stays an equi-join.

    The lowered keys are computed as columns first so the join keys are plain
    attributes that hash- or range-partition. NULL left keys are spread as in
    ``composite_left_join`` (they match nothing either way).
    """
    lk, rk = f"__lk_{left}", f"__rk_{right}"
    j = composite_left_join(df.withColumn(lk, F.lower(left)), dim.withColumn(rk, F.lower(right)),
                            [(lk, rk)], bounded=bounded, spread_nulls=spread_nulls, spread_by=spread_by)
    return j.drop(lk, rk)


def lookup_with_default(df: DataFrame, dim: DataFrame, on: Column, id_col: str, out_col: str,
                        default, bounded: bool = False) -> DataFrame:
    """LEFT join, then ``coalesce(id, default)`` for rows without a match."""
    j = left_join(df, dim, on, bounded)
    return j.withColumn(out_col, F.coalesce(F.col(id_col), F.lit(default)))
