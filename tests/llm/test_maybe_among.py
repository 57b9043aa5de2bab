"""Wide rows that a join does not want are left out before its shuffle."""

from pyspark.sql import functions as F

from rentmart.llm.common import maybe_among


def test_maybe_among_keeps_what_is_wanted_and_little_else(spark):
    # numbers as monotonically_increasing_id deals them out: the partition in the upper bits, the same lower ones
    rows = spark.range(20_000).select((F.col("id") % 40 * (1 << 33) + F.floor(F.col("id") / 40)).alias("doc"), F.lit("text").alias("text"))
    wanted = rows.filter("doc < 1L << 33 and doc % 5 = 0").select("doc")
    out = maybe_among(rows, wanted.unionByName(wanted), "doc")
    assert out.columns == ["doc", "text"]
    assert wanted.join(out, "doc", "left_anti").isEmpty()
    assert wanted.count() <= out.count() <= wanted.count() + 50
    assert out.select("doc").distinct().count() == out.count()


def test_maybe_among_of_nothing(spark):
    rows = spark.range(10).select(F.col("id").alias("doc"))
    assert maybe_among(rows, rows.limit(0), "doc").isEmpty()
    assert maybe_among(rows.limit(0), rows, "doc").isEmpty()
