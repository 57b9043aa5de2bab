"""Mixing sources to target weights, in DataFrame operations alone.

Every row gets a hash-random key. The rows of a source are cut into equal ranges of that key, so that a source of any
size is spread over them; sums per range and their running totals give every range its offset, and a sort
inside the range gives every row the words before it. Rows meet their source's figures by source and range, never by
source alone. A source with budget T and size S is taken T div S times
whole, and the rows whose running total lies below the remainder once more; the row on the edge gives only the
words that are missing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentmart.llm.common import cut_lineage, pick

#: runs of anything but white space
WORD = r"[^\x20\x09-\x0D]+"
#: parts of the key range that every source is cut into; a source has at most so many rows of sums
RANGES = 4_096


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Adds ``target`` (double) to one row per source (source, source_size).

    Weights repeat over the sources in code-point order, null last, and share the words of all sources. No target
    exceeds ``most`` times its source; what lies above is shared again by weight. In ascending order of
    cap / weight the first source whose share stays below its cap fixes the share for it and all after it.
    The table has one row per source; it is sorted in one task.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    s = sources.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("_cap", F.lit(most) * F.col("source_size")).withColumn("_level", F.col("_cap") / F.col("_w"))
    order = Window.orderBy("_level", F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    s = s.withColumn("_share", left / F.sum("_w").over(onward))
    first = F.min(F.when(F.col("_share") < F.col("_level"), F.struct("_level", "_share"))).over(Window.partitionBy())
    s = s.withColumn("_first", first.getField("_share"))
    open_ = F.col("_first").isNotNull() & (F.col("_level") > F.col("_first"))
    target = F.when(open_, F.col("_w") * F.col("_first")).otherwise(F.col("_cap").cast("double"))
    return s.withColumn("target", target).drop("_w", "_cap", "_level", "_share", "_first")


def mix(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: str = "mix") -> DataFrame:
    """``keep`` columns of every row of ``docs``, and size, source_size, target, taken.

    ``docs``: doc_id, source, text. Size is the number of words (null text: 0); null is a source like any other.
    ``taken`` is the words the mix takes of the row, repeats counted, never above ``most`` times its size; the
    sum over a source is the floor of its target. The order of rows follows a hash of doc_id, then size: reruns agree,
    and rows that share both are alike. Rows without words take part with 0. An empty table gives no row.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    need = dict.fromkeys((*keep, "doc_id", "source", "text"))
    rows = pick(docs, *need)
    rows = rows.select(
        *[F.col(c).alias(f"k_{c}") for c in keep], "source", "doc_id", size.alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))).alias("_key"),
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source")).alias("_source"),
    )
    if set(keep) <= {"doc_id", "source"}:
        rows = cut_lineage(rows)  # narrow: the words are counted once
    spot = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("_range", F.shiftright(spot * RANGES, 32))
    cells = rows.groupBy("_source", "source", "_range").agg(F.sum("size").alias("_sum"))
    per = cells.groupBy("_source", "source").agg(F.sum("_sum").alias("source_size"))
    per = cut_lineage(targets(per, weights, most)).drop("source")
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("_source", "_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset")).join(per, "_source")
    inside = Window.partitionBy("_source", "_range").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.drop("source").join(cells, ["_source", "_range"]).withColumn(
        "_before", F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - whole * F.col("source_size")
    once_more = F.least("size", F.greatest(rest - F.col("_before"), F.lit(0)))
    return placed.select(
        *[F.col(f"k_{c}").alias(c) for c in keep], "size", "source_size", "target", (whole * F.col("size") + once_more).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole taking of a document and one with its first
    words, joined by blanks, for a partial taking. Rows from which nothing is taken are gone."""
    cols = docs.columns
    m = mix(docs, keep=tuple(cols), **options).filter("taken > 0")
    part = F.col("taken") % F.col("size")
    copies = F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))
    m = m.withColumn("_copy", F.explode(copies))
    cut = (F.col("_copy") * F.col("size") > F.col("taken")) & (part > 0)
    few = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), part.cast("int")), " ")
    m = m.withColumn("text", F.when(cut, few).otherwise(F.col("text")))
    if "n_chars" in cols:
        m = m.withColumn("n_chars", F.when(cut, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return m.select(*cols)
