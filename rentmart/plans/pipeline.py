"""The full rebuild (R1): feeds -> staging -> warehouse -> dimensions -> fact -> marts.

Each step reads the tables the previous step stored, which cuts lineage and lets
Spark plan each step from real file statistics (so the broadcast of the small
dimensions is decided on their actual size). Order: staging; warehouse copies
and listings with ``year_month``; ``dim_lga``, ``dim_host``, ``dim_listing``,
``dim_date``; ``dim_suburb`` (needs ``dim_lga``); the fact; the three marts.
Steps over large listings run in slices, few at once (``sources.slices``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmart.operators.keys import dense_surrogate_key, numbered
from rentmart.plans import dims as D
from rentmart.plans import fact as FT
from rentmart.plans import marts as M
from rentmart.plans import sketches as SK
from rentmart.plans.concurrent import run_together
from rentmart.session import let_go
from rentmart.sources import csv_feed, files
from rentmart.sources.slices import MOST_STEPS, by_month, slice_count
from rentmart.sources.tables import Warehouse, export_csv

STAGING_TABLES = ["listings", "census_1", "census_2", "lga_code", "lga_suburb"]
WAREHOUSE_TABLES = ["census_1", "census_2", "lga_code", "lga_suburb", "listings",
                    "dim_lga", "dim_suburb", "dim_host", "dim_listing", "dim_date", "fact",
                    "dm_listing_neighbourhood_base", "dm_property_type_base",
                    "dm_listing_neighbourhood_months", "dm_property_type_months",
                    "dm_listing_neighbourhood_sketch", "taken_files"]
MART_TABLES = ["dm_listing_neighbourhood", "dm_property_type", "dm_host_neighbourhood"]


BATCH, REBUILT, MONTH = "batch_id", -1, ["year_month"]


def listing_checkpoint(target: str, stream: str) -> str:
    return f"{target.rstrip('/')}/_checkpoints/listings-{stream}"


def register_files(spark: SparkSession, source_dir: str, checkpoint: str) -> int:
    """Make a listing stream take every file of the folder without opening one: its batches are never looked at.

    A rebuild does this before it reads the folder, so the stream's next run starts behind files that the rebuild is
    sure to load. Returns the time before the folder was listed, by the clock of the target's file system:
    a file written since may be loaded and not registered, and the rebuild's ledger (``taken_files``) names those.
    """
    marker = f"{checkpoint}-registered"
    files.write_new(spark, marker, source_dir)
    q = (csv_feed.options(spark.readStream, "listings").csv(source_dir)
         .writeStream.foreachBatch(lambda batch, epoch_id: None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return files.modified(spark, marker)


def write_dim(wh: Warehouse, name: str, listings: DataFrame, key_method: str = "range") -> DataFrame:
    """A large dimension by buckets of its natural key; the next free id and the number of buckets become notes."""
    id_col, cols, _ = D.LARGE[name]
    tuples = (D.host_tuples if name == "dim_host" else D.listing_tuples)(listings)
    if key_method == "range":
        keyed, n = numbered(tuples, cols, id_col)
    else:
        keyed = dense_surrogate_key(tuples, cols, id_col, method=key_method)
        n = keyed.count()
    buckets = max(1, -(-n // D.BUCKET_ROWS))
    if buckets > 1:
        let_go(wh.spark)    # the numbered rows are checkpointed
    wh.note(**{f"{name}.next_id": n + 1, f"{name}.buckets": buckets})
    return wh.write(D.in_buckets(keyed.select(id_col, *cols), name, buckets), "warehouse", name, [D.BUCKET])


def write_months(wh: Warehouse, name: str, keys: list[str], months: DataFrame) -> DataFrame:
    """The month index of a mart: per group its present months, in order."""
    return wh.write(M.group_months(months, keys), "warehouse", f"{name}_months")


def build_marts(listings: DataFrame, dim_lga: DataFrame, dim_suburb: DataFrame,
                property_divisor: str = "active", null_safe: bool = False) -> dict[str, DataFrame]:
    star = FT.mart_input_direct(listings, dim_lga, dim_suburb, null_safe=null_safe)
    return {
        "dm_listing_neighbourhood": M.dm_listing_neighbourhood(star),
        "dm_property_type": M.dm_property_type(star, property_divisor),
        "dm_host_neighbourhood": M.dm_host_neighbourhood(star),
    }


def run_pipeline(spark: SparkSession, target: str, feed_dirs: dict[str, str] | None = None,
                 staging: dict[str, DataFrame] | None = None, export_dir: str | None = None,
                 property_divisor: str = "active", key_method: str = "range",
                 null_safe: bool = False, concurrency: int = 4,
                 write_staging: bool = True, on_error: str = "raise") -> dict[str, DataFrame]:
    """Rebuild every layer under ``target``; returns the stored marts.

    Inputs are either CSV feed folders (``feed_dirs``) or typed staging frames.
    Independent steps (the four dimensions; the fact and the three marts) are
    submitted as concurrent jobs, up to ``concurrency`` at a time, unless the listings
    are so large that their shuffles together would fill the disks (``sources.slices``).
    ``write_staging=False`` skips storing the staging layer (a typed copy of the
    feeds) and writes the warehouse tables straight from the typed feeds: one
    full write of the listings instead of two. ``on_error`` applies to the CSV
    feeds: a bad field value fails the rebuild ("raise"), loads as NULL ("null",
    see ``csv_feed.rejects`` to list such rows), or its row is set aside with its
    reason and file in the pass that stages the feed ("reject", see ``stage_feed``).

    All tables are switched together at the end: a rebuild that fails midway leaves
    the tables of the last one as they were.
    """
    if (feed_dirs is None) == (staging is None):
        raise ValueError("give exactly one of feed_dirs or staging")
    wh = Warehouse(spark, target)
    stream = uuid.uuid4().hex
    since = 0
    if feed_dirs is not None:
        since = register_files(spark, feed_dirs["listings"], listing_checkpoint(target, stream))
    with wh.rebuild():
        marts = _rebuild(wh, feed_dirs, staging, property_divisor, key_method, null_safe, concurrency, write_staging, on_error, since)
        # last: what a refresh starts from (a new stream, behind the files taken here)
        wh.note(stream=stream, divisor=property_divisor, null_safe=null_safe)
    wh.vacuum()
    if export_dir:
        for name, df in marts.items():
            export_csv(df, M.MART_ORDER[name], f"{export_dir.rstrip('/')}/{name}")
    return marts


def _rebuild(wh: Warehouse, feed_dirs: dict[str, str] | None, staging: dict[str, DataFrame] | None, property_divisor: str,
             key_method: str, null_safe: bool, concurrency: int, write_staging: bool, on_error: str, since: int) -> dict[str, DataFrame]:
    spark = wh.spark

    def run(steps: dict) -> dict:
        """At once, or few of them where the listings (``slices`` of them) are large."""
        if slices == 1:
            return run_together(steps, concurrency)
        return run_together(steps, min(concurrency, MOST_STEPS), lambda: let_go(spark))

    first = "listings" if write_staging else None       # the staging table that holds the listings
    if feed_dirs is None:
        src = {**staging, "listings": staging["listings"].withColumns({
            csv_feed.SOURCE_FILE: F.lit(None).cast("string"), csv_feed.SOURCE_TIME: F.lit(None).cast("timestamp")})}
    elif on_error == "reject":
        # read once: staged and rejected rows are written in one pass, in the place of the staging tables
        src = run_together({n: (lambda n=n, p=p: csv_feed.stage_feed(wh, p, n)[0]) for n, p in feed_dirs.items()}, concurrency)
        src = {n: df if n == "listings" else df.drop(*csv_feed.SOURCE) for n, df in src.items()}
        write_staging, first = False, "listings_rows"
    else:
        src = csv_feed.build_staging(spark, feed_dirs, on_error)
        raw = csv_feed.with_source(csv_feed.read_raw(spark, feed_dirs["listings"], "listings"))
        src["listings"] = csv_feed.positional_projection(raw, "listings", on_error)

    # Staging layer
    if write_staging:
        st = run_together({name: (lambda n=name: wh.write(src[n], "staging", n)) for name in STAGING_TABLES},
                          concurrency)
    else:
        st = dict(src)
    slices = slice_count(wh.size("staging", first)) if first else 1
    if slices > 1:
        let_go(spark)
    # Warehouse copies, listings with year_month (partitioned by month)
    copies = {name: (lambda n=name: wh.write(st[n], "warehouse", n)) for name in STAGING_TABLES if name != "listings"}
    # the layout the refresh goes on with: months, and in them the batch that brought the rows
    loaded = D.load_listings(st["listings"]).withColumn(BATCH, F.lit(REBUILT))
    copies["listings"] = lambda: wh.write(by_month(loaded, slices), "warehouse", "listings", ["year_month", BATCH])
    w = run(copies)
    listings = w["listings"].drop(BATCH)
    slices = slice_count(wh.size("warehouse", "listings"))
    # D3, D5-D7 (independent), then D4 (needs dim_lga); the ledger of the files the rows came from
    steps = {
        "dim_listing": lambda: write_dim(wh, "dim_listing", listings, key_method),
        "dim_host": lambda: write_dim(wh, "dim_host", listings, key_method),
        "dim_lga": lambda: wh.write(D.dim_lga(w["census_1"], w["census_2"], w["lga_code"]), "warehouse", "dim_lga"),
        "dim_date": lambda: wh.write(D.dim_date(listings), "warehouse", "dim_date"),
        "taken_files": lambda: wh.write(
            listings.filter(F.col(csv_feed.SOURCE_TIME) >= F.timestamp_millis(F.lit(since)))
            .select(F.col(csv_feed.SOURCE_FILE).alias("path")).distinct(), "warehouse", "taken_files"),
    }
    dims = run(steps)
    lga = dims["dim_lga"]
    dims["dim_suburb"] = suburb = wh.write(D.dim_suburb(w["lga_suburb"], lga), "warehouse", "dim_suburb")
    # D8 and M1-M3 (the marts read the listings and the two reference dimensions only)
    months = by_month(listings, slices)
    stars = [FT.mart_input_direct(rows, lga, suburb, null_safe=null_safe) for rows in months]
    steps = {"fact": lambda: wh.write([FT.build_fact(rows, dims, null_safe=null_safe, month=True) for rows in months],
                                      "warehouse", "fact", MONTH),
             "dm_host_neighbourhood": lambda: wh.write([M.dm_host_neighbourhood(star) for star in stars], "datamart",
                                                       "dm_host_neighbourhood", MONTH)}
    for name, keys in M.LISTING_MARTS.items():
        steps[f"{name}_base"] = lambda n=name, k=keys: wh.write([M.listing_kpi_base(star, k) for star in stars], "warehouse",
                                                                f"{n}_base", MONTH)
    for name, keys in SK.SKETCHED.items():
        steps[f"{name}_sketch"] = lambda n=name, k=keys: wh.write([SK.month_sketches(star, k) for star in stars], "warehouse",
                                                                  f"{n}_sketch", MONTH)
    done = run(steps)
    kpis: dict = {}
    for name, keys in M.LISTING_MARTS.items():
        base = done[f"{name}_base"]
        kpis[name] = lambda n=name, k=keys, b=base: wh.write(
            M.listing_kpis(b, k, M.divisor_of(n, property_divisor)), "datamart", n, MONTH)
        kpis[f"{name}_months"] = lambda n=name, k=keys, b=base: write_months(wh, n, k, b)
    done |= run(kpis)
    return {name: done[name] for name in MART_TABLES}


def register_catalog(spark: SparkSession, target: str, prefix: str = "") -> None:
    """Expose every stored layer table as ``<prefix><layer>.<table>``."""
    Warehouse(spark, target).register_catalog(
        {"staging": STAGING_TABLES, "warehouse": WAREHOUSE_TABLES, "datamart": MART_TABLES}, prefix)


def truncate_all(spark: SparkSession, target: str) -> None:
    """Empty every staging, warehouse and mart table, keeping schemas (S9), all at once for whoever reads.

    The next refresh loads every file again: its stream is a new one, the ledger is empty and ids start anew.
    """
    wh = Warehouse(spark, target)
    divisor, null_safe = wh.noted("divisor", "active"), wh.noted("null_safe", False)
    with wh.rebuild():
        wh.truncate_all({"staging": STAGING_TABLES + [f"{n}_rows" for n in STAGING_TABLES], "warehouse": WAREHOUSE_TABLES, "datamart": MART_TABLES})
        wh.note(stream=uuid.uuid4().hex, divisor=divisor, null_safe=null_safe, **{f"{n}.next_id": 1 for n in D.LARGE})
