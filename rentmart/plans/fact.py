"""The fact table (D8) and the star view the marts read.

``build_wide_fact`` performs the warehouse's five left joins once and keeps, next
to the fact's ids and measures, the dimension attributes those joins already
bring along. ``fact_table`` projects the fact proper (ids + measures only);
``mart_input`` hands the attributes to the marts, so building all three marts
costs no further join with the two large dimensions. ``star_view`` is the
reference path (fact joined back to the dimensions by surrogate key); both give
the same rows.

Join strategy: ``price < cap`` is applied before the joins (it only reads the
left side, so the result is the same as filtering after them, and it reaches the
Parquet scan). ``dim_date`` is bounded by the calendar and broadcast; ``dim_lga``
and ``dim_suburb`` are reference tables, broadcast by Spark when their stored size
is below its threshold; ``dim_listing`` and ``dim_host`` grow with the data and
are joined by shuffle, with AQE splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmart.functions.expr import UNKNOWN, UNKNOWN_SUBURB_ID, revenue, stays
from rentmart.operators.keys import range_count
from rentmart.operators.joins import all_of, case_insensitive_left_join, composite_left_join, left_join
from rentmart.session import let_go

# columns every fact / mart row reads anyway: they spread NULL-key rows in shuffle joins
SPREAD_BY = ["listing_id", "host_id", "scraped_date", "price"]

FACT_COLUMNS = ["listing_idf", "date_id", "host_idf", "host_neighf", "listing_neigh_idf",
                "price", "stays", "revenue", "review_scores_rating"]

MART_COLUMNS = ["year_month", "listing_neighbourhood", "host_neighbourhood_lga", "list_orig_id",
                "property_type", "room_type", "accommodates", "has_availability",
                "host_orig_id", "host_is_superhost", "price", "stays", "revenue",
                "review_scores_rating"]


def build_wide_fact(listings: DataFrame, dims: dict[str, DataFrame], price_cap: int = 2000,
                    null_safe: bool = False) -> DataFrame:
    """Fact rows with ids, measures and the joined dimension attributes."""
    f = listings.filter(F.col("price") < price_cap)

    attrs = ["property_type", "room_type", "accommodates", "has_availability", "number_of_reviews"]
    dl = dims["dim_listing"].select(F.col("listing_id").alias("listing_idf"), F.col("list_orig_id"),
                                    *[F.col(c).alias(f"dl_{c}") for c in attrs])
    host_attrs = ["host_name", "host_since", "host_is_superhost"]
    dh = dims["dim_host"].select(F.col("hosts_id").alias("host_idf"), F.col("host_orig_id"),
                                 *[F.col(c).alias(f"dh_{c}") for c in host_attrs])
    ds = dims["dim_suburb"].select(
        "suburb_id", F.col("suburb_name").alias("ds_suburb_name"), F.col("lga_name").alias("ds_lga_name"))
    dg = dims["dim_lga"].select(F.col("lga_code_2016").alias("listing_neigh_idf"),
                                                   F.col("lga_name").alias("dg_lga_name"))
    dd = dims["dim_date"].select("date_id", F.col("year_month").alias("dd_year_month"))

    j = composite_left_join(f, dl, [("listing_id", "list_orig_id")] + [(c, f"dl_{c}") for c in attrs],
                            null_safe, spread_by=SPREAD_BY)
    j = composite_left_join(j, dh, [("host_id", "host_orig_id")] + [(c, f"dh_{c}") for c in host_attrs],
                            null_safe, spread_by=SPREAD_BY)
    j = case_insensitive_left_join(j, ds, "host_neighbourhood", "ds_suburb_name", spread_by=SPREAD_BY)
    j = left_join(j, dg, F.col("dg_lga_name") == F.col("listing_neighbourhood"))
    # months of the data: bounded by the calendar
    j = left_join(j, dd, F.col("dd_year_month") == F.col("year_month"), bounded=True)

    return j.select(
        "listing_idf", "date_id", "host_idf",
        F.coalesce("suburb_id", F.lit(UNKNOWN_SUBURB_ID)).cast("bigint").alias("host_neighf"),
        "listing_neigh_idf", "price",
        stays("availability_30").alias("stays"),
        revenue("price", "availability_30").alias("revenue"),
        "review_scores_rating",
        # attributes as the marts would find them through the surrogate keys
        F.col("dd_year_month").alias("year_month"),
        F.col("dg_lga_name").alias("listing_neighbourhood"),
        F.when(F.col("suburb_id").isNull(), F.lit(UNKNOWN)).otherwise(F.col("ds_lga_name"))
        .alias("host_neighbourhood_lga"),
        F.when(F.col("listing_idf").isNotNull(), F.col("list_orig_id")).alias("list_orig_id"),
        F.col("dl_property_type").alias("property_type"),
        F.col("dl_room_type").alias("room_type"),
        F.col("dl_accommodates").alias("accommodates"),
        F.col("dl_has_availability").alias("has_availability"),
        F.when(F.col("host_idf").isNotNull(), F.col("host_orig_id")).alias("host_orig_id"),
        F.col("dh_host_is_superhost").alias("host_is_superhost"),
    )


def fact_table(wide: DataFrame) -> DataFrame:
    """The fact proper: five foreign keys and the measures."""
    return wide.select(*FACT_COLUMNS)


def mart_input(wide: DataFrame) -> DataFrame:
    return wide.select(*MART_COLUMNS)


def build_fact(listings: DataFrame, dims: dict[str, DataFrame], price_cap: int = 2000,
               null_safe: bool = False, month: bool = False) -> DataFrame:
    """The fact; with ``month`` also ``year_month``, by which the stored table is partitioned (ids change on a rebuild)."""
    wide = build_wide_fact(listings, dims, price_cap, null_safe)
    return wide.select(*FACT_COLUMNS, "year_month") if month else fact_table(wide)


def mart_input_direct(listings: DataFrame, dim_lga: DataFrame, dim_suburb: DataFrame,
                      price_cap: int = 2000, null_safe: bool = False) -> DataFrame:
    """The star view computed without the two large dimension joins.

    ``dim_listing`` and ``dim_host`` are the distinct tuples of these very
    listings, so a listing row finds its own tuple exactly when no key column is
    NULL, and the attributes it gets back are its own. The marts therefore read
    the listings directly (one scan, broadcast lookups of the two reference
    dimensions) and give the same rows as ``star_view`` over the built fact,
    given ``dim_lga`` is unique on its code, the key the warehouse declares and
    ``quality.check_unique`` verifies (with duplicate codes the star's code
    lookup would fan out differently from the name lookup used here).
    With ``null_safe=True`` (the fact's NULL-safe key option) every row matches.
    ``dim_suburb`` is needed by name only, so ``dims.suburb_rows`` (not numbered) will do.
    """
    if null_safe:
        listing_ok = host_ok = F.lit(True)
    else:
        listing_ok = all_of([F.col(c).isNotNull() for c in
                           ["listing_id", "property_type", "room_type", "accommodates",
                            "has_availability", "number_of_reviews"]])
        host_ok = all_of([F.col(c).isNotNull() for c in
                        ["host_id", "host_name", "host_since", "host_is_superhost"]])
    ds = dim_suburb.select(F.col("suburb_name").alias("ds_suburb_name"),
                                              F.col("lga_name").alias("ds_lga_name"))
    dg = dim_lga.select(F.col("lga_name").alias("dg_lga_name"))
    j = case_insensitive_left_join(listings.filter(F.col("price") < price_cap), ds,
                                   "host_neighbourhood", "ds_suburb_name", spread_by=SPREAD_BY)
    j = left_join(j, dg, F.col("dg_lga_name") == F.col("listing_neighbourhood"))
    return j.select(
        "year_month",
        F.col("dg_lga_name").alias("listing_neighbourhood"),
        F.when(F.col("ds_suburb_name").isNull(), F.lit(UNKNOWN)).otherwise(F.col("ds_lga_name"))
        .alias("host_neighbourhood_lga"),
        *[F.when(listing_ok, F.col(src)).alias(dst) for src, dst in
          [("listing_id", "list_orig_id"), ("property_type", "property_type"),
           ("room_type", "room_type"), ("accommodates", "accommodates"),
           ("has_availability", "has_availability")]],
        F.when(host_ok, F.col("host_id")).alias("host_orig_id"),
        F.when(host_ok, F.col("host_is_superhost")).alias("host_is_superhost"),
        "price",
        stays("availability_30").alias("stays"),
        revenue("price", "availability_30").alias("revenue"),
        "review_scores_rating",
    )


def star_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact joined back to its dimensions by surrogate key (the reference path)."""
    dd = F.broadcast(dims["dim_date"].select(F.col("date_id").alias("__d"), "year_month"))
    dg = dims["dim_lga"].select(F.col("lga_code_2016").alias("__g"),
                                                   F.col("lga_name").alias("listing_neighbourhood"))
    dl = dims["dim_listing"].select(F.col("listing_id").alias("__l"), "list_orig_id", "property_type",
                                    "room_type", "accommodates", "has_availability")
    dh = dims["dim_host"].select(F.col("hosts_id").alias("__h"), "host_orig_id", "host_is_superhost")
    ds = dims["dim_suburb"].select(F.col("suburb_id").alias("__s"),
                                                      F.col("lga_name").alias("host_neighbourhood_lga"))
    # the listings first: a fact bucketed by their id is joined where it lies
    j = (fact.select(*FACT_COLUMNS).join(dl, F.col("__l") == F.col("listing_idf"), "left")
         .join(dd, F.col("__d") == F.col("date_id"), "left")
         .join(dg, F.col("__g") == F.col("listing_neigh_idf"), "left")
         .join(dh, F.col("__h") == F.col("host_idf"), "left")
         .join(ds, F.col("__s") == F.col("host_neighf"), "left"))
    return j.select(*MART_COLUMNS)


def store_bucketed(spark: SparkSession, fact: DataFrame, dims: dict[str, DataFrame], path: str, prefix: str,
                   buckets: int | None = None) -> dict[str, DataFrame]:
    """The star as catalog tables under ``path``, the two large dimensions and the fact in buckets of surrogate keys.

    The fact is bucketed and sorted by its listing id, the key of the largest dimension: that join needs no exchange on
    either side. The host dimension is bucketed by its id, so its join exchanges the fact's rows alone. The
    number of buckets follows the fact's bytes.
    """
    n = buckets or max(1, range_count(fact))
    keys = {"fact": "listing_idf", "dim_listing": "listing_id", "dim_host": "hosts_id"}
    out = dict(dims)
    for name, key in keys.items():
        df = fact if name == "fact" else dims[name]
        table = f"{prefix}{name}"
        spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        # one task per bucket writes one file
        (df.repartition(n, key).write.mode("overwrite").option("path", f"{path}/{name}")
         .bucketBy(n, key).sortBy(key).saveAsTable(table))
        if n > 1:
            let_go(spark)
        out[name] = spark.table(table)
    return out


def bucketed_star_view(tables: dict[str, DataFrame]) -> DataFrame:
    """``star_view`` of ``store_bucketed``'s tables: its joins by surrogate key use their buckets."""
    return star_view(tables["fact"], tables)
