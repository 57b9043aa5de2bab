"""Warehouse load and the five dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentmart.functions.expr import UNKNOWN, UNKNOWN_SUBURB_ID, month_floor, substr_prefix
from rentmart.operators.keys import dense_surrogate_key
from rentmart.sources.tables import append_member

HOST_TUPLE = ["host_orig_id", "host_name", "host_since", "host_is_superhost"]
LISTING_TUPLE = ["list_orig_id", "property_type", "room_type", "accommodates",
                 "has_availability", "number_of_reviews"]


def load_listings(staging_listings: DataFrame) -> DataFrame:
    """Warehouse listings: every staging column plus ``year_month``."""
    return staging_listings.withColumn("year_month", month_floor("scraped_date"))


def dim_lga(census_1: DataFrame, census_2: DataFrame, lga_code: DataFrame) -> DataFrame:
    """census_1 LEFT census_2 LEFT lga_code on the code without its 3-char prefix (D3)."""
    c1 = census_1.withColumn("__code", substr_prefix("lga_code_2016"))
    c2 = census_2.withColumnRenamed("lga_code_2016", "__c2_code")
    j = (c1.join(c2, c1.lga_code_2016 == c2.__c2_code, "left")
         .join(lga_code, F.col("__code") == lga_code.lga_code, "left"))
    return j.select(
        F.col("__code").alias("lga_code_2016"), "lga_name",
        "tot_p_m", "tot_p_f", "tot_p_p",
        "median_age_persons", "median_mortgage_repay_monthly", "median_tot_prsnl_inc_weekly",
        "median_rent_weekly", "median_tot_fam_inc_weekly", "average_num_psns_per_bedroom",
        "median_tot_hhd_inc_weekly", "average_household_size")


def _suburbs(lga_suburb: DataFrame, dim_lga_df: DataFrame) -> DataFrame:
    lga = dim_lga_df.select(F.col("lga_code_2016").alias("lga_code"),
                            F.col("lga_name").alias("__lga_name"),
                            F.lower("lga_name").alias("__lga_key"))
    return (lga_suburb.withColumn("__sub_key", F.lower("lga_name"))
            .join(lga, F.col("__sub_key") == F.col("__lga_key"), "left")
            .select("suburb_name", "lga_code", F.col("__lga_name").alias("lga_name")))


def suburb_rows(lga_suburb: DataFrame, dim_lga_df: DataFrame) -> DataFrame:
    """``dim_suburb`` without its ids: what joins by name need. No job runs to plan it."""
    return append_member(_suburbs(lga_suburb, dim_lga_df), (UNKNOWN, UNKNOWN, UNKNOWN),
                         "suburb_name string, lga_code string, lga_name string")


def dim_suburb(lga_suburb: DataFrame, dim_lga_df: DataFrame, key_method: str = "range") -> DataFrame:
    """Suburbs with their LGA, matched ignoring case, plus the unknown member.

    The suburb list is a reference table, but nothing bounds its size, so it is
    numbered by range partitions like the large dimensions.
    """
    keyed = dense_surrogate_key(_suburbs(lga_suburb, dim_lga_df), ["suburb_name", "lga_code", "lga_name"],
                                "suburb_id", method=key_method)
    return append_member(keyed.select("suburb_id", "suburb_name", "lga_code", "lga_name"),
                         (UNKNOWN_SUBURB_ID, UNKNOWN, UNKNOWN, UNKNOWN),
                         "suburb_id bigint, suburb_name string, lga_code string, lga_name string")


def host_tuples(listings: DataFrame) -> DataFrame:
    """DISTINCT (host, name, since, superhost): the whole tuple, not the host."""
    return listings.select(F.col("host_id").alias("host_orig_id"), "host_name", "host_since",
                           "host_is_superhost").distinct()


def listing_tuples(listings: DataFrame) -> DataFrame:
    return listings.select(F.col("listing_id").alias("list_orig_id"), "property_type", "room_type",
                           "accommodates", "has_availability", "number_of_reviews").distinct()


def month_tuples(listings: DataFrame) -> DataFrame:
    """GROUP BY year_month without aggregates."""
    return listings.select("year_month").distinct()


def dim_host(listings: DataFrame, key_method: str = "range") -> DataFrame:
    """Distinct host tuples numbered in tuple order."""
    keyed = dense_surrogate_key(host_tuples(listings), HOST_TUPLE, "hosts_id", method=key_method)
    return keyed.select("hosts_id", *HOST_TUPLE)


def dim_listing(listings: DataFrame, key_method: str = "range") -> DataFrame:
    """Distinct listing tuples numbered in tuple order."""
    keyed = dense_surrogate_key(listing_tuples(listings), LISTING_TUPLE, "listing_id", method=key_method)
    return keyed.select("listing_id", *LISTING_TUPLE)


def dim_date(listings: DataFrame) -> DataFrame:
    """Distinct months numbered in order (D7); bounded by the calendar, so one window."""
    keyed = dense_surrogate_key(month_tuples(listings), ["year_month"], "date_id", method="window")
    return keyed.select("date_id", "year_month")


#: rows of a bucket of a dimension that a rebuild stores; buckets of one that starts with a refresh, of unknown size
BUCKET_ROWS, FIRST_BUCKETS = 2_000_000, 16
BUCKET = "bucket"
#: the large dimensions: key, tuple, and the natural key whose hash deals the tuples into buckets
LARGE = {"dim_host": ("hosts_id", HOST_TUPLE, "host_orig_id"), "dim_listing": ("listing_id", LISTING_TUPLE, "list_orig_id")}

#: where the listings hold that natural key
FEED_KEY = {"dim_host": "host_id", "dim_listing": "listing_id"}


def in_buckets(dim: DataFrame, name: str, buckets: int, key: str | None = None) -> DataFrame:
    """``dim`` (or rows with the natural key in ``key``) with the bucket of each row.

    All tuples of one host or listing share a bucket, so a batch finds out which of its tuples are new, and which ids
    they have, in the buckets of its own hosts and listings alone.
    """
    return dim.withColumn(BUCKET, F.pmod(F.xxhash64(key or LARGE[name][2]), F.lit(buckets)).cast("int"))


def build_dims(staging: dict[str, DataFrame], key_method: str = "range") -> dict[str, DataFrame]:
    """All dimensions from the staging feeds; ``listings`` is the warehouse listings."""
    listings = load_listings(staging["listings"])
    lga = dim_lga(staging["census_1"], staging["census_2"], staging["lga_code"])
    return {
        "listings": listings,
        "dim_lga": lga,
        "dim_suburb": dim_suburb(staging["lga_suburb"], lga),
        "dim_host": dim_host(listings, key_method),
        "dim_listing": dim_listing(listings, key_method),
        "dim_date": dim_date(listings),
    }
