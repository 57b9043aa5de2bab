"""Spark helpers shared by the operators: checkpoints, Arrow batch bounds, running totals, components."""

from __future__ import annotations

import functools
import gc
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: bounds of one Arrow batch handed to Python
BATCH_ROWS, BATCH_BYTES = 2_000, 4 << 20
_SHIPPED: list = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    set_by_hand = spark.sparkContext.getCheckpointDir()
    if conf or set_by_hand:
        return conf or set_by_hand
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-checkpoints-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: computed once, kept in the shared folder, read again by whatever comes after."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let_go(spark: SparkSession) -> None:
    """Asks for the files of plans that are done with.

    Spark removes the shuffle files of a plan, and its checkpoints where the session says so, once the driver has collected it
    as garbage, which it cannot while Python still holds one of its frames.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a compressed table in the shared folder, computed once: for wide rows. Their plan is let go."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    let_go(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per context, unless they find it by the PYTHONPATH of the driver."""
    package = Path(__file__).resolve().parents[1]
    if str(package.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or spark.sparkContext in _SHIPPED:
        return
    archive = f"{tempfile.mkdtemp(prefix='llm-package-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in package.rglob("*.py"):
            z.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.append(spark.sparkContext)


def small_batches(spark: SparkSession) -> None:
    """Bounds what one Arrow batch holds, so that a Python worker's memory does not follow the table."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns alone: further columns, whatever their names, do not reach the operator."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def running_total(df: DataFrame, part: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds to each row the sum of ``value`` over all rows before it, by ``part`` and then by ``order``.

    Parts are sorted each on its own; one row per part meets in one task to get the offsets, and these rows
    (as many as partitions or files) are broadcast.
    """
    sums = df.groupBy(part).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(part, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.join(F.broadcast(offsets), part)
    return out.withColumn(name, (F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("long")).drop("_offset")


def range_parts(df: DataFrame, order: list[Column], part: str = "_part") -> DataFrame:
    """Range partitions by ``order``, numbered in a column and fixed by a checkpoint."""
    return cut_lineage(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))


#: bits of a filter of keys, whatever their number: one megabyte
FILTER_BITS = 1 << 23


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """(_bucket, _bits): a bitmap of the keys (long) by their lowest bits, of a size that does not depend on them."""
    spot = F.pmod(F.col(key), F.lit(FILTER_BITS)) + 1
    spots = keys.select(F.bitmap_bucket_number(spot).alias("_bucket"), F.bitmap_bit_position(spot).alias("_at"))
    return spots.groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits"))


def with_maybe(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """Adds ``name``: false for rows whose key is certainly not among those of ``key_filter``.

    It spares rows a shuffle; a full bitmap spares none and changes nothing else.
    """
    spot = F.pmod(F.col(key), F.lit(FILTER_BITS)) + 1
    df = df.withColumn("_bucket", F.bitmap_bucket_number(spot)).withColumn("_at", F.bitmap_bit_position(spot))
    df = df.join(F.broadcast(keys), "_bucket", "left")
    byte = "cast(conv(hex(substring(_bits, cast(_at div 8 as int) + 1, 1)), 16, 10) as int)"
    bit = F.expr(f"shiftright({byte}, cast(_at % 8 as int)) & 1 = 1")
    return df.withColumn(name, F.coalesce(bit, F.lit(False))).drop("_bucket", "_at", "_bits")


def maybe_among(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` but for most of those whose ``key`` is not in ``keys``: wide rows are spared the shuffle of a join.

    The bitmap goes by a hash of the key: numbers dealt out by partition agree in their lowest bits.
    """
    bits = cut_lineage(key_filter(keys.select(F.xxhash64(key).alias("_key")), "_key"))
    return with_maybe(df.withColumn("_key", F.xxhash64(key)), "_key", bits, "_maybe").filter("_maybe").drop("_key", "_maybe")


def roots(pointers: DataFrame) -> DataFrame:
    """(node, root): the pointers of (node, root), one per node and no cycle, followed to the last node.

    Every round looks twice as far, so rounds follow the logarithm of the longest path.
    """
    steps = pointers.select("node", "root")
    while True:
        onward = steps.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        further = cut_lineage(steps.join(onward, "root", "left"))
        if further.filter("_next is not null").isEmpty():
            return steps
        steps = further.select("node", F.coalesce("_next", "root").alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` (a, b; any order) reaches.

    Alternating large-star and small-star rounds: every node hands its larger neighbours to its smallest one, then
    its smaller neighbours. Each round only groups and joins by node (pre-aggregated minima), so a hub of any size
    is never held by one task; rounds follow the logarithm of the longest path. Lineage is cut every round.
    """
    def small(e: DataFrame) -> DataFrame:
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        up = e.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return up.unionByName(least.select("u", F.col("m").alias("v"))).distinct()

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()

    e = cut_lineage(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        # settled: every node points to one node, which points nowhere
        unsettled = e.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u").unionByName(
            e.select("u").join(e.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        )
        if unsettled.isEmpty():
            break
        e = cut_lineage(small(large(e)))
    tops = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        tops.select("node", F.col("node").alias("component"))
    )


def schema_of(df: DataFrame, extra: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [extra])


union_all = functools.partial(functools.reduce, DataFrame.unionByName)
