"""The range-partitioned surrogate key equals the global row_number window."""
from pyspark.sql import functions as F

from rentmart.operators.keys import dense_surrogate_key
from rentmart.plans import dims as D
from rentmart.sources import testmap
from helpers import SF_SMALL, rows


def test_range_equals_window_on_listing_tuples(spark):
    t = D.listing_tuples(D.load_listings(testmap.listings(spark, SF_SMALL)))
    a = dense_surrogate_key(t, D.LISTING_TUPLE, "id", method="range", num_ranges=7)
    b = dense_surrogate_key(t, D.LISTING_TUPLE, "id", method="window")
    assert rows(a) == rows(b)
    ids = [r[0] for r in a.select("id").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_range_key_with_hot_leading_value_and_nulls(spark):
    # a third of the rows share one leading key; NULLs sort first
    hot = spark.range(0, 3000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("v"))
    rest = spark.range(0, 6000).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    nulls = spark.range(0, 10).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    df = hot.unionByName(rest).unionByName(nulls)
    a = dense_surrogate_key(df, ["k", "v"], "id", method="range", num_ranges=8)
    b = dense_surrogate_key(df, ["k", "v"], "id", method="window")
    assert rows(a) == rows(b)
    first = a.filter(F.col("id") == 1).first()
    assert first.k is None and first.v == 0


def test_start_offset(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    out = dense_surrogate_key(df, ["s"], "id", method="range", start=101)
    assert rows(out, ["s", "id"]) == [("a", 101), ("b", 102), ("c", 103)]


def test_null_key_spreading_keeps_the_join_result(spark):
    from rentmart.operators.joins import composite_left_join
    # a third of the left rows carry a NULL key part
    left = spark.range(0, 3000).select(
        (F.col("id") % 40).alias("a"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 7).alias("b"),
        F.col("id").alias("v"))
    dim = spark.range(0, 280).select((F.col("id") % 40).alias("da"), (F.col("id") % 7).alias("db"),
                                     F.col("id").alias("dim_id")).dropDuplicates(["da", "db"])
    pairs = [("a", "da"), ("b", "db")]
    spread = composite_left_join(left, dim, pairs, spread_nulls=True)
    plain = composite_left_join(left, dim, pairs, spread_nulls=False)
    assert spread.columns == plain.columns
    assert rows(spread) == rows(plain)
    assert spread.filter(F.col("b").isNull() & F.col("dim_id").isNotNull()).count() == 0
