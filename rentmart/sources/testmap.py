"""Mapping of the driver's TPC-H-style tables onto the five listing/census feeds.

No rental data ships with the test tables, so the staging feeds are derived from
them; every registered query therefore scales with ``lineitem``. The mapping
deliberately produces the awkward cases the marts must handle: NULL in composite
dimension keys, prices at and above the 2000 cap, host neighbourhoods that only
match a suburb ignoring case, unknown suburbs, and a listing neighbourhood with
no LGA. The same mapping is written as SQL for the DuckDB oracle
(``rentmart.oracle``).

| feed column            | derived from                                              |
|------------------------|-----------------------------------------------------------|
| listing_id             | l_partkey                                                 |
| scraped_date           | l_shipdate as date                                        |
| host_id / host_name    | l_orderkey / the order's c_name                           |
| host_since             | 2008-01-01 + (o_custkey % 3650) days, as text             |
| host_is_superhost      | (o_totalprice > 250000) xor (year(l_shipdate) >= 1999)    |
| host_neighbourhood     | 'SUBURB_<customer nation>', NULL for '4-NOT SPECIFIED'    |
| listing_neighbourhood  | supplier's n_name                                         |
| property/room/accomm.  | p_type, p_brand, p_size                                   |
| price                  | floor(l_extendedprice / 40)                               |
| has_availability       | l_linestatus = 'O', NULL when returnflag R and line 7     |
| availability_30        | floor(l_quantity) % 31                                    |
| number_of_reviews      | l_linenumber                                              |
| review_scores_rating   | round(l_discount * 100), NULL when returnflag A           |
| census / lga feeds     | one LGA per nation: code 10000 + n_nationkey              |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentmart import schemas

# Fixed values of the mapping (kept identical in the oracle SQL).
SUPERHOST_TOTALPRICE = 250000
SUPERHOST_FLIP_YEAR = 1999
HOST_SINCE_BASE = "2008-01-01"
HOST_SINCE_SPAN_DAYS = 3650
NO_NEIGHBOURHOOD_PRIORITY = "4-NOT SPECIFIED"
PRICE_DIVISOR = 40
LGA_CODE_BASE = 10000
LGA_CODE_PREFIX = "LGA"
LGA_NAMED_BELOW = 24      # nations >= 24 have census rows but no LGA name
SUBURB_LISTED_BELOW = 23  # nations >= 23 have no suburb entry


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed staging listings (the 21 kept columns of the listing feed)."""
    # each table hands on only what the feed shows of it: rows stay narrow in the shuffles by order and part
    qty = F.floor("l_quantity").cast("bigint")
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", qty.alias("qty"),
        F.col("l_shipdate").cast("date").alias("scraped_date"),
        F.floor(F.col("l_extendedprice") / PRICE_DIVISOR).cast("bigint").alias("price"),
        F.when(~((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)),
               F.col("l_linestatus") == "O").alias("has_availability"),
        F.when(F.col("l_returnflag") != "A",
               F.round(F.col("l_discount") * 100).cast("bigint")).alias("review_scores_rating"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("review_scores_accuracy"))
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    # the customers meet the orders, of which there are fewer than line items
    o = (read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
         .join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select(
             "o_orderkey", F.col("c_name").alias("host_name"),
             (F.col("o_custkey") % HOST_SINCE_SPAN_DAYS).cast("int").alias("since_days"),
             (F.col("o_totalprice") > SUPERHOST_TOTALPRICE).alias("dear"),
             F.when(F.col("o_orderpriority") != NO_NEIGHBOURHOOD_PRIORITY,
                    F.concat(F.lit("SUBURB_"), F.col("c_nationkey").cast("string"))).alias("host_neighbourhood")))
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation is a fixed 25-row table: a bounded broadcast.
    sn = F.broadcast(read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("s_nation")))
    p = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand", "p_size")

    j = (li.join(o, li.l_orderkey == o.o_orderkey, "left")
         .join(s, F.col("l_suppkey") == F.col("s_suppkey"), "left")
         .join(sn, "s_nationkey", "left")
         .join(p, F.col("l_partkey") == F.col("p_partkey"), "left"))

    return j.select(
        F.col("l_partkey").cast("bigint").alias("listing_id"),
        "scraped_date",
        F.col("l_orderkey").cast("bigint").alias("host_id"),
        "host_name",
        F.date_add(F.lit(HOST_SINCE_BASE).cast("date"), F.col("since_days")).cast("string").alias("host_since"),
        (F.col("dear") != (F.year("scraped_date") >= SUPERHOST_FLIP_YEAR)).alias("host_is_superhost"),
        "host_neighbourhood",
        F.col("s_nation").alias("listing_neighbourhood"),
        F.col("p_type").alias("property_type"),
        F.col("p_brand").alias("room_type"),
        F.col("p_size").cast("bigint").alias("accommodates"),
        "price",
        "has_availability",
        (F.col("qty") % 31).alias("availability_30"),
        F.col("l_linenumber").cast("bigint").alias("number_of_reviews"),
        "review_scores_rating",
        "review_scores_accuracy",
        (F.col("l_linenumber") + 3).cast("bigint").alias("review_scores_cleanliness"),
        (F.col("qty") % 10).alias("review_scores_checkin"),
        (F.col("l_linenumber") * 10).cast("bigint").alias("review_scores_communication"),
        (F.col("qty") % 7 + 4).alias("review_scores_value"),
    )


def _nation_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = (read(spark, sf_dir, "customer")
            .groupBy("c_nationkey")
            .agg(F.count(F.when(F.col("c_custkey") % 2 == 0, 1)).alias("n_m"),
                 F.count(F.when(F.col("c_custkey") % 2 == 1, 1)).alias("n_f"),
                 F.count(F.lit(1)).alias("n_p"),
                 F.median("c_acctbal").alias("med_bal"),
                 F.max("c_acctbal").alias("max_bal"),
                 F.min("c_acctbal").alias("min_bal")))
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return nation.join(cust, nation.n_nationkey == cust.c_nationkey, "left")


def _code(prefix: bool) -> F.Column:
    code = (F.col("n_nationkey") + LGA_CODE_BASE).cast("string")
    return F.concat(F.lit(LGA_CODE_PREFIX), code) if prefix else code


def census_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    np_ = _nation_people(spark, sf_dir)
    return np_.select(
        _code(True).alias("lga_code_2016"),
        F.coalesce("n_m", F.lit(0)).cast("bigint").alias("tot_p_m"),
        F.coalesce("n_f", F.lit(0)).cast("bigint").alias("tot_p_f"),
        F.coalesce("n_p", F.lit(0)).cast("bigint").alias("tot_p_p"))


def census_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    np_ = _nation_people(spark, sf_dir)
    nk = F.col("n_nationkey")
    return np_.select(
        _code(True).alias("lga_code_2016"),
        (nk + 30).cast("bigint").alias("median_age_persons"),
        F.floor("med_bal").cast("bigint").alias("median_mortgage_repay_monthly"),
        F.floor(F.col("max_bal") / 10).cast("bigint").alias("median_tot_prsnl_inc_weekly"),
        F.floor(F.col("min_bal") / 10).cast("bigint").alias("median_rent_weekly"),
        (nk * 7 + 1000).cast("bigint").alias("median_tot_fam_inc_weekly"),
        (nk.cast("double") / 10 + 1).alias("average_num_psns_per_bedroom"),
        (nk * 9 + 1200).cast("bigint").alias("median_tot_hhd_inc_weekly"),
        (nk.cast("double") / 20 + 2).alias("average_household_size"))


def lga_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.filter(F.col("n_nationkey") < LGA_NAMED_BELOW).select(
        _code(False).alias("lga_code"), F.col("n_name").alias("lga_name"))


def lga_suburb(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.filter(F.col("n_nationkey") < SUBURB_LISTED_BELOW).select(
        F.lower("n_name").alias("lga_name"),
        F.concat(F.lit("Suburb_"), F.col("n_nationkey").cast("string")).alias("suburb_name"))


FEED_BUILDERS = {
    "listings": listings,
    "census_1": census_1,
    "census_2": census_2,
    "lga_code": lga_code,
    "lga_suburb": lga_suburb,
}


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five typed staging feeds, as lazy DataFrames."""
    out = {name: fn(spark, sf_dir) for name, fn in FEED_BUILDERS.items()}
    for name, df in out.items():
        assert df.columns == schemas.columns(name), (name, df.columns)
    return out
