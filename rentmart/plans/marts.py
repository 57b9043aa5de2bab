"""The three KPI marts (M1-M3).

Input: the star view (``fact.mart_input`` or ``fact.star_view``) with columns
``fact.MART_COLUMNS``. Each mart is built from pre-aggregated rows (partial
aggregation map-side, so a group holding a third of the rows only costs one
partial buffer per task), and the period-over-period changes are a window over
the *aggregated* rows: it sorts one row per group and month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentmart.functions.expr import count_if, max_if, min_if, ratio, ratio_decimal, ratio_pct, sum_if
from rentmart.operators.window import pct_change


def active():
    """CASE has_availability WHEN TRUE."""
    return F.col("has_availability")


def inactive():
    """CASE has_availability WHEN FALSE."""
    return ~F.col("has_availability")


def known():
    """CASE has_availability WHEN FALSE THEN 1 WHEN TRUE THEN 1."""
    return F.col("has_availability").isNotNull()


KPI_COLUMNS = ["active_listings_rate", "min_price_act", "max_price_act", "median_price_act",
               "number_of_distinct_hosts", "super_host_rate", "avg_rev_score_act",
               "percentage_change_for_active_listings", "percentage_change_for_inactive_listings",
               "total_number_of_stays", "average_estimated_revenue_per_active_listings"]


def _histogram(star: DataFrame, g: list[str]) -> DataFrame:
    """Per group and price of the active rows: how many."""
    return star.filter(active()).groupBy(*g, F.col("price").alias("__price")).agg(F.count(F.lit(1)).alias("__freq"))


def _kpi_sums_exact(star: DataFrame, g: list[str]) -> DataFrame:
    """Host level, then group level: exact distinct host and superhost counts, as a hash aggregate."""
    per_host = star.groupBy(*g, "host_orig_id").agg(
        count_if(active()).alias("n_active"),
        count_if(inactive()).alias("n_inactive"),
        count_if(known()).alias("n_known"),
        F.count(F.lit(1)).alias("n_rows"),
        min_if(active(), "price").alias("min_price_act"),
        max_if(active(), "price").alias("max_price_act"),
        sum_if(active(), "review_scores_rating").alias("sum_score_act"),
        count_if(active() & F.col("review_scores_rating").isNotNull()).alias("n_score_act"),
        sum_if(active(), "stays").alias("total_number_of_stays"),
        F.sum("revenue").alias("sum_revenue"),
        F.max("host_is_superhost").alias("is_superhost"))
    return per_host.groupBy(*g).agg(
        F.sum("n_active").alias("n_active"),
        F.sum("n_inactive").alias("n_inactive"),
        F.sum("n_known").alias("n_known"),
        F.sum("n_rows").alias("n_rows"),
        F.min("min_price_act").alias("min_price_act"),
        F.max("max_price_act").alias("max_price_act"),
        F.count("host_orig_id").alias("number_of_distinct_hosts"),
        count_if(F.col("is_superhost") & F.col("host_orig_id").isNotNull()).alias("n_superhosts"),
        ratio(F.sum("sum_score_act"), F.sum("n_score_act")).alias("avg_rev_score_act"),
        F.sum("total_number_of_stays").alias("total_number_of_stays"),
        F.sum("sum_revenue").alias("sum_revenue"))


def _kpi_sums_approx(star: DataFrame, g: list[str], rsd: float = 0.05) -> DataFrame:
    """One aggregate; the two distinct counts as HyperLogLog++ sketches."""
    return star.groupBy(*g).agg(
        count_if(active()).alias("n_active"),
        count_if(inactive()).alias("n_inactive"),
        count_if(known()).alias("n_known"),
        F.count(F.lit(1)).alias("n_rows"),
        min_if(active(), "price").alias("min_price_act"),
        max_if(active(), "price").alias("max_price_act"),
        F.approx_count_distinct("host_orig_id", rsd).alias("number_of_distinct_hosts"),
        F.approx_count_distinct(F.when(F.col("host_is_superhost"), F.col("host_orig_id")), rsd)
        .alias("n_superhosts"),
        ratio(sum_if(active(), "review_scores_rating"),
              count_if(active() & F.col("review_scores_rating").isNotNull())).alias("avg_rev_score_act"),
        sum_if(active(), "stays").alias("total_number_of_stays"),
        F.sum("revenue").alias("sum_revenue"))


def listing_kpi_base(star: DataFrame, keys: list[str], median: str = "exact",
                     distinct: str = "exact") -> DataFrame:
    """Per (keys, year_month): the inputs of the 11 listing KPIs.

    Planned as two aggregations instead of one with two DISTINCT counts (which
    Spark expands to three copies of every row, each carrying a percentile
    buffer):

    1. per (keys, month, host): counts, sums, price range and ``max(superhost)``;
       a hot group is spread over its hosts, and partial aggregation runs
       map-side;
    2. per (keys, month): sums of those; the distinct hosts are now the non-NULL
       host rows, the distinct superhosts those whose flag is set.

    The exact median comes from a price histogram of the active rows,
    ``percentile(price, 0.5, frequency)``, which holds at most one entry per
    distinct price of a group. It has an aggregate of its own, so that step 2 stays
    a hash aggregate over all host-level rows; the two results, one row per group
    each, meet in a last small aggregate. ``median="approx"`` uses
    ``percentile_approx`` over the active rows instead, as the warehouse did.
    ``distinct="approx"`` counts hosts and superhosts with HyperLogLog++ sketches
    in a single aggregate: no host-level shuffle, ~5% relative error. It pays off
    for few groups with many hosts each (M1); with many small groups (M2) the
    """
    if median not in ("exact", "approx"):
        raise ValueError("median must be 'exact' or 'approx'")
    if distinct not in ("exact", "approx"):
        raise ValueError("distinct must be 'exact' or 'approx'")
    g = [*keys, "year_month"]
    out = [*g, "n_active", "n_inactive", "n_known", "n_rows", "min_price_act", "max_price_act",
           "median_price_act", "number_of_distinct_hosts", "n_superhosts", "avg_rev_score_act",
           "total_number_of_stays", "sum_revenue"]
    base = _kpi_sums_exact(star, g) if distinct == "exact" else _kpi_sums_approx(star, g)
    if median == "exact":
        med = _histogram(star, g).groupBy(*g).agg(
            F.percentile("__price", 0.5, F.col("__freq")).cast("double").alias("median_price_act"))
    else:
        med = star.filter(active()).groupBy(*g).agg(
            F.percentile_approx("price", 0.5, 10000).cast("double").alias("median_price_act"))
    # one row of each kind per group at most: max() takes the value that is there
    both = base.unionByName(med, allowMissingColumns=True)
    return both.groupBy(*g).agg(*[F.max(c).alias(c) for c in out if c not in g]).select(*out)


def listing_kpis(base: DataFrame, keys: list[str], divisor: str = "active") -> DataFrame:
    """The 11 KPIs from ``listing_kpi_base`` output (W2/W3 run on aggregated rows)."""
    if divisor not in ("active", "all"):
        raise ValueError("divisor must be 'active' or 'all'")
    w = Window.partitionBy(*keys).orderBy(F.col("year_month").asc_nulls_first())
    per = F.col("n_active") if divisor == "active" else F.col("n_rows")
    return base.select(
        *keys, "year_month",
        ratio_pct("n_active", "n_known").alias("active_listings_rate"),
        "min_price_act", "max_price_act", "median_price_act", "number_of_distinct_hosts",
        ratio_pct("n_superhosts", "number_of_distinct_hosts").alias("super_host_rate"),
        "avg_rev_score_act",
        pct_change("n_active", w).alias("percentage_change_for_active_listings"),
        pct_change("n_inactive", w).alias("percentage_change_for_inactive_listings"),
        "total_number_of_stays",
        ratio("sum_revenue", per).alias("average_estimated_revenue_per_active_listings"),
    )


def dm_listing_neighbourhood(star: DataFrame, median: str = "exact", distinct: str = "exact") -> DataFrame:
    """11 KPIs per listing neighbourhood (LGA name) and month (M1)."""
    keys = ["listing_neighbourhood"]
    return listing_kpis(listing_kpi_base(star, keys, median, distinct), keys, "active")


PROPERTY_KEYS = ["property_type", "room_type", "accommodates"]


def dm_property_type(star: DataFrame, divisor: str = "active", median: str = "exact",
                     distinct: str = "exact") -> DataFrame:
    """11 KPIs per property type, room type, accommodates and month (M2).

    ``divisor="all"`` divides revenue by every joined row, as the warehouse's
    ``count(CASE .. THEN 1 ELSE 0 END)`` does; the default divides by active rows.
    """
    return listing_kpis(listing_kpi_base(star, PROPERTY_KEYS, median, distinct), PROPERTY_KEYS, divisor)


def dm_host_neighbourhood(star: DataFrame, exact: bool = False, distinct: str = "exact") -> DataFrame:
    """Distinct hosts, revenue and active revenue per distinct host by host LGA and month (M3).

    ``exact=True`` gives the per-host figure as decimal(38,6), the exported form.
    ``distinct="approx"`` counts hosts with ``approx_count_distinct`` (HyperLogLog++,
    fixed-size sketch per group) instead of the exact two-phase distinct count.
    """
    if distinct not in ("exact", "approx"):
        raise ValueError("distinct must be 'exact' or 'approx'")
    hosts = (F.count_distinct("host_orig_id") if distinct == "exact"
             else F.approx_count_distinct("host_orig_id", 0.05))
    g = star.groupBy("host_neighbourhood_lga", "year_month").agg(
        hosts.alias("number_of_distinct_hosts"),
        F.sum("revenue").alias("estimated_revenue"),
        sum_if(active(), "revenue").alias("__active_revenue"))
    per_host = (ratio_decimal if exact else ratio)("__active_revenue", "number_of_distinct_hosts")
    return g.select("host_neighbourhood_lga", "year_month", "number_of_distinct_hosts",
                    "estimated_revenue", per_host.alias("estimated_revenue_per_host_distinct"))


#: stands for the NULL month (rows without a date), which comes before all others
NO_MONTH = "0001-01-01"


def group_months(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the months that ``rows`` (keys, year_month) hold of it, in order: as many as the calendar has."""
    month = F.coalesce("year_month", F.lit(NO_MONTH).cast("date"))
    return rows.groupBy(*keys).agg(F.sort_array(F.collect_set(month)).alias("months"))


def merged_months(index: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The index with the months of ``rows`` added."""
    both = index.unionByName(group_months(rows, keys))
    return both.groupBy(*keys).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("months")))).alias("months"))


def month_steps(index: DataFrame) -> list[tuple]:
    """Every (month, next present month) that some group has: at most the square of the calendar."""
    pairs = F.arrays_zip(F.expr("slice(months, 1, size(months) - 1)").alias("a"), F.expr("slice(months, 2, size(months) - 1)").alias("b"))
    found = index.filter(F.size("months") > 1).select(F.explode(pairs).alias("p")).select("p.a", "p.b").distinct()
    return [tuple(r) for r in found.collect()]


#: the marts kept as one aggregate table by group and month, from which their KPIs follow
LISTING_MARTS = {"dm_listing_neighbourhood": ["listing_neighbourhood"], "dm_property_type": PROPERTY_KEYS}


def divisor_of(name: str, property_divisor: str) -> str:
    """The revenue divisor of a listing mart: only M2 has the choice."""
    return property_divisor if name == "dm_property_type" else "active"


MART_ORDER = {
    "dm_listing_neighbourhood": ["listing_neighbourhood", "year_month"],
    "dm_property_type": PROPERTY_KEYS + ["year_month"],
    "dm_host_neighbourhood": ["host_neighbourhood_lga", "year_month"],
}
