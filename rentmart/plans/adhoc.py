"""The four ad-hoc market questions (Q1-Q4) over the star view.

"Last N months" means the N calendar months ending at the latest month of
``dim_date``, found with a scalar subquery over that small table, which Spark
runs first: the bound then prunes the months of the listings before they are
read, and each question reads the listings once. Revenue per active listing is
the M1 measure: all revenue over the count of active rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentmart.functions.expr import count_if, ratio, ratio_pct
from rentmart.plans.marts import active


PROFILE = ["tot_p_m", "tot_p_f", "tot_p_p", "median_age_persons", "median_mortgage_repay_monthly",
           "median_tot_prsnl_inc_weekly", "median_rent_weekly", "median_tot_fam_inc_weekly",
           "average_num_psns_per_bedroom", "median_tot_hhd_inc_weekly", "average_household_size"]


def last_months(dim_date: DataFrame, months: int) -> Column:
    """Predicate: year_month within the ``months`` months ending at the latest month of ``dim_date``."""
    latest = dim_date.select(F.max("year_month")).scalar()
    return F.col("year_month") > F.add_months(latest, -months)


def revenue_per_active(star: DataFrame) -> DataFrame:
    """Per listing neighbourhood: revenue, active rows, revenue per active listing."""
    return (star.filter(F.col("listing_neighbourhood").isNotNull())
            .groupBy("listing_neighbourhood")
            .agg(F.sum("revenue").alias("estimated_revenue"),
                 count_if(active()).alias("n_active_listings"))
            .withColumn("revenue_per_active_listing",
                        ratio("estimated_revenue", "n_active_listings")))


def best_worst_population(star: DataFrame, dim_lga: DataFrame, dim_date: DataFrame, months: int = 12) -> DataFrame:
    """Best and worst neighbourhood by revenue per active listing over the last
    ``months`` months, each with its census profile, plus a ``best_minus_worst``
    row with the difference of every metric (Q1).

    One aggregate by neighbourhood gives both ends: the extreme of
    (revenue per active listing, neighbourhood) each way. The three rows follow from these two.
    """
    per = revenue_per_active(star.filter(last_months(dim_date, months))) \
        .filter(F.col("revenue_per_active_listing").isNotNull())
    value = ["listing_neighbourhood", "n_active_listings"]
    revenue = F.col("revenue_per_active_listing")
    # ties: the first name is the best, and the worst
    ends = per.agg(F.min(F.struct((-revenue).alias("order"), *value)).alias("best"),
                   F.min(F.struct(revenue.alias("order"), *value)).alias("worst"))
    lga = dim_lga.select(F.col("lga_name").alias("listing_neighbourhood"), *PROFILE,
                         ratio_pct("tot_p_m", "tot_p_p").alias("male_share_pct"))
    both = ends.select(F.explode(F.array(
        F.struct(F.lit("best").alias("performance"), F.col("best").alias("v")),
        F.struct(F.lit("worst").alias("performance"), F.col("worst").alias("v")))).alias("e")) \
        .select("e.performance", *[F.col(f"e.v.{c}").alias(c) for c in value],
                F.when(F.col("e.performance") == "best", -F.col("e.v.order")).otherwise(F.col("e.v.order"))
                .alias("revenue_per_active_listing"))
    both = both.join(lga, "listing_neighbourhood", "left")
    metrics = ["revenue_per_active_listing", "n_active_listings", *PROFILE, "male_share_pct"]
    row = ["performance", "listing_neighbourhood", *metrics]
    # a grouping set for each end and one for both: the difference is the answer to "main differences"
    sets = both.select(F.explode(F.array("performance", F.lit("best_minus_worst"))).alias("__row"), *row)
    sign = F.when(F.col("performance") == "best", F.lit(1)).otherwise(F.lit(-1))
    own = F.col("__row") == F.col("performance")
    return (sets.groupBy(F.col("__row").alias("performance")).agg(
        F.max(F.when(own, F.col("listing_neighbourhood"))).alias("listing_neighbourhood"),
        *[F.when(F.max(own), F.max(m)).when(F.count(m) == 2, F.sum(sign * F.col(m))).cast(both.schema[m].dataType).alias(m) for m in metrics])
        .filter(F.col("listing_neighbourhood").isNotNull() | (F.col("performance") == "best_minus_worst")))


def best_listing_type(star: DataFrame, k: int = 5) -> DataFrame:
    """For the top ``k`` neighbourhoods by revenue per active listing, the property
    type, room type and accommodates with the most stays of active listings (Q2)."""
    top = (revenue_per_active(star)
           .filter(F.col("revenue_per_active_listing").isNotNull())
           .orderBy(F.desc("revenue_per_active_listing"), F.asc("listing_neighbourhood"))
           .limit(k))
    # k rows: a bounded broadcast
    top = F.broadcast(top.select("listing_neighbourhood", "revenue_per_active_listing"))
    types = (star.filter(active() & F.col("listing_neighbourhood").isNotNull())
             .join(top.select("listing_neighbourhood"), "listing_neighbourhood", "left_semi")
             .groupBy("listing_neighbourhood", "property_type", "room_type", "accommodates")
             .agg(F.sum("stays").alias("total_stays")))
    w = Window.partitionBy("listing_neighbourhood").orderBy(
        F.desc_nulls_last("total_stays"), F.asc_nulls_first("property_type"),
        F.asc_nulls_first("room_type"), F.asc_nulls_first("accommodates"))
    best = types.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    rank_w = Window.orderBy(F.desc("revenue_per_active_listing"), F.asc("listing_neighbourhood"))
    ranked = top.withColumn("lga_rank", F.row_number().over(rank_w))  # over k rows
    return (ranked.join(best, "listing_neighbourhood", "left")
            .select("lga_rank", "listing_neighbourhood", "revenue_per_active_listing",
                    "property_type", "room_type", "accommodates", "total_stays"))


def multi_host_same_lga(star: DataFrame) -> DataFrame:
    """Share of listings located in the host's own LGA, for hosts with several
    listings against hosts with one (Q3).

    A listing counts once however often it was scraped, and as located there if
    any of its snapshots is. Hosts whose listings all lack a key part have no
    listing to count and form a group of their own.
    """
    same = F.coalesce(F.col("listing_neighbourhood") == F.col("host_neighbourhood_lga"), F.lit(False))
    per_listing = (star.filter(F.col("host_orig_id").isNotNull())
                   .groupBy("host_orig_id", "list_orig_id").agg(F.max(same).alias("same")))
    per_host = per_listing.groupBy("host_orig_id").agg(
        F.count("list_orig_id").alias("n_listings"),
        count_if(F.col("same") & F.col("list_orig_id").isNotNull()).alias("n_same"))
    return (per_host
            .withColumn("host_category", F.when(F.col("n_listings") > 1, "multiple")
                        .when(F.col("n_listings") == 1, "single").otherwise("no countable listing"))
            .groupBy("host_category")
            .agg(F.count(F.lit(1)).alias("n_hosts"),
                 F.sum("n_listings").alias("n_listings"),
                 F.sum("n_same").alias("n_same_lga_listings"))
            .withColumn("same_lga_pct", ratio_pct("n_same_lga_listings", "n_listings")))


def mortgage_coverage(star: DataFrame, dim_lga: DataFrame, dim_date: DataFrame, months: int = 12) -> DataFrame:
    """For hosts with a single listing: does their revenue over the last ``months``
    months cover 12 x the monthly median mortgage of the listing's neighbourhood?
    One row per neighbourhood and one overall row (NULL neighbourhood) (Q4).

    A host counts once, in the neighbourhood of its latest month within those
    months that has one (the last by name within a month), with all its revenue
    of those months; a host without a known neighbourhood in them is left out.
    """
    recent = last_months(dim_date, months)
    place = F.struct("year_month", "listing_neighbourhood")
    # one aggregate per (host, listing), then per host: no join back to the star
    per_listing = (star.filter(F.col("host_orig_id").isNotNull())
                   .groupBy("host_orig_id", "list_orig_id")
                   .agg(F.sum(F.when(recent, F.col("revenue"))).alias("revenue_12m"),
                        F.max(F.when(recent & F.col("listing_neighbourhood").isNotNull(), place)).alias("place")))
    single = (per_listing.groupBy("host_orig_id")
              .agg(F.count("list_orig_id").alias("n"), F.sum("revenue_12m").alias("revenue_12m"),
                   F.max("place").alias("place"))
              .filter((F.col("n") == 1) & F.col("place").isNotNull())
              .select("revenue_12m", F.col("place.listing_neighbourhood").alias("listing_neighbourhood")))
    lga = dim_lga.select(F.col("lga_name").alias("listing_neighbourhood"),
                         (F.col("median_mortgage_repay_monthly") * 12).alias("annual_mortgage"))
    per = single.join(lga, "listing_neighbourhood", "left")
    covers = F.col("revenue_12m") >= F.col("annual_mortgage")
    # one aggregate for the neighbourhoods and the overall row; a row that counts for nothing makes sure of the latter
    nothing = star.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("revenue_12m"),
                                                F.lit(None).cast("string").alias("listing_neighbourhood"),
                                                F.lit(None).cast("bigint").alias("annual_mortgage"), F.lit(0).alias("counts"))
    every = per.withColumn("counts", F.lit(1)).select(*nothing.columns).unionByName(nothing)
    total = (every.groupingSets([["listing_neighbourhood", "annual_mortgage"], []], "listing_neighbourhood", "annual_mortgage")
             .agg(F.grouping_id().alias("level"), F.sum("counts").alias("n_hosts"), count_if(covers).alias("n_hosts_covering"),
                  F.sum("revenue_12m").alias("revenue_12m")))
    return (total.filter((F.col("level") > 0) | (F.col("n_hosts") > 0))
            .select("listing_neighbourhood", "annual_mortgage", "n_hosts", "n_hosts_covering", "revenue_12m",
                    ratio_pct("n_hosts_covering", "n_hosts").alias("covering_pct")))
