"""Document fingerprints: a threshold-scaled sketch, in DataFrame operations alone.

A text's shingles are its runs of five words (white-space separated; a shorter text is one shingle). Of their
64-bit hashes the sketch retains every one in the lowest 1/``SCALE`` of the hash range. The threshold is the same for
all texts, so sketches of texts of any length compare, intersect and merge: the union of two sketches is the
sketch of both texts together. The sketch of a text of n distinct shingles has n / ``SCALE`` hashes on average, and a
likeness from m of them has a standard error of at most 1 / (2 sqrt(m)); a text of very few shingles may retain none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentmart.llm.common import pick

SHINGLE, SCALE = 5, 2
_LIMIT = -(1 << 63) + (1 << 64) // SCALE  # hashes are signed: the lowest part starts at -2^63


def with_sketch(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: array<long> of the retained hashes, ascending. No words (or null): none."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = df.withColumn("_w", F.transform(words, lambda w: F.xxhash64(w)))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (SHINGLE - 1), F.lit(1)))
    shingles = F.transform(starts, lambda i: F.xxhash64(F.slice(F.col("_w"), i, F.lit(SHINGLE))))
    low = F.array_sort(F.array_distinct(F.filter(shingles, lambda x: x < F.lit(_LIMIT))))
    none = F.array().cast("array<bigint>")
    return df.withColumn(name, F.when(F.size("_w") == 0, none).otherwise(low)).drop("_w")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two texts from their sketches; 0.0 where neither retains a hash."""
    both, any_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(any_ == 0, F.lit(0.0)).otherwise(both / any_)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has; null where ``a`` retains no hash."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts together."""
    return F.array_sort(F.array_union(a, b))


def as_text(sketch: Column) -> Column:
    """The fingerprint as a string: 16 hexadecimal digits for each hash in ascending signed order."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(df: DataFrame, *columns: str) -> DataFrame:
    """Adds ``next_<column>``: the value of the next row in descending doc_id (null last; ties by text), after the
    last row that of the first.

    Rows are dealt into ranges of doc_id, as many as shuffle partitions; each range also gets a copy of the first row
    of the range behind it, so that one shuffle of the rows is enough. Only the range bounds reach the driver.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / n for i in range(1, n)]
    bounds = sorted(set(df.agg(F.percentile_approx("doc_id", steps, 20 * n)).first()[0] or [])) if steps else []
    # range 0 holds the largest ids; null ids go with the smallest
    lower = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<bigint>"), lambda b: b < F.col("doc_id")))
    df = df.withColumn("_range", F.lit(len(bounds)) - F.when(F.col("doc_id").isNull(), 0).otherwise(lower))
    tops = df.groupBy("_range").agg(F.max("doc_id").alias("_top"))  # a row for each range
    around = Window.orderBy("_range")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = tops.select(F.coalesce(F.lag("_range").over(around), F.last("_range").over(whole)).alias("_to"), F.col("_range").alias("_from"), "_top")
    first = df.join(F.broadcast(tops), (F.col("_range") == F.col("_from")) & F.col("doc_id").eqNullSafe(F.col("_top")))
    data = [c for c in df.columns if c != "_range"]
    first = first.groupBy("_to").agg(F.min(F.struct("text", *[c for c in data if c != "text"])).alias("_r"))
    first = first.select(F.col("_to").alias("_range"), F.lit(1).alias("_end"), *[F.col(f"_r.{c}").alias(c) for c in data])
    both = df.withColumn("_end", F.lit(0)).unionByName(first)
    w = Window.partitionBy("_range").orderBy("_end", F.col("doc_id").desc_nulls_last(), "text")
    both = both.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})
    return both.filter("_end = 0").drop("_range", "_end")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, contained_in_edited.

    ``docs``: doc_id, text; other columns are ignored, a null text is empty. The edited text has its last
    floor(n_chars / 3) code points replaced by the first as many, or all, of the next document's (descending doc_id;
    a single row is its own next). Equal texts have a likeness of 1. Rows that share a doc_id are ordered by text. An
    empty table gives no row.
    """
    d = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    d = with_next(with_sketch(d, "text", "sketch"), "text", "sketch")
    d = d.withColumn("n_chars", F.char_length("text").cast("long"))
    k = F.floor(F.col("n_chars") / 3).cast("int")
    d = d.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - k).cast("int")), F.substring("next_text", F.lit(1), k)
    ))
    d = d.withColumns({"same_edited": F.col("text") == F.col("edited"), "same_next": F.col("text") == F.col("next_text")}).drop("text", "next_text")
    d = with_sketch(d, "edited", "edited_sketch")
    return d.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        F.when(F.col("same_edited"), 1.0).otherwise(likeness(F.col("sketch"), F.col("edited_sketch"))).alias("near_edited"),
        F.when(F.col("same_next"), 1.0).otherwise(likeness(F.col("sketch"), F.col("next_sketch"))).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("contained_in_edited"),
    )
