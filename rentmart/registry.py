"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through ``sources.testmap`` (so its work
grows with them) and runs the library's operators; ``rentmart.oracle`` holds the
SQL twin of each one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentmart.functions import expr as X
from rentmart.operators import joins as J
from rentmart.operators import quality as Q
from rentmart.operators.keys import dense_surrogate_key, input_bytes
from rentmart.operators.window import pct_change
from rentmart.plans import adhoc as A
from rentmart.plans import dims as D
from rentmart.plans import fact as FT
from rentmart.plans import marts as M
from rentmart.plans.marts import active
from rentmart.plans import sketches as SK
from rentmart.plans.pipeline import register_catalog, run_pipeline, truncate_all, write_dim
from rentmart.session import let_go, scratch_path
from rentmart import schemas
from rentmart.sources import csv_feed, testmap
from rentmart.sources.slices import by_key, slice_count
from rentmart.sources.tables import Warehouse, export_csv, read_export
from rentmart.streaming.incremental import IncrementalMarts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---- shared inputs -------------------------------------------------------------

def _staging(spark, sf_dir) -> dict[str, DataFrame]:
    return testmap.staging(spark, sf_dir)


def _listings(spark, sf_dir) -> DataFrame:
    return D.load_listings(testmap.listings(spark, sf_dir))


def _lga(spark, sf_dir) -> DataFrame:
    return D.dim_lga(testmap.census_1(spark, sf_dir), testmap.census_2(spark, sf_dir),
                     testmap.lga_code(spark, sf_dir))


def _suburb(spark, sf_dir) -> DataFrame:
    return D.dim_suburb(testmap.lga_suburb(spark, sf_dir), _lga(spark, sf_dir))


def _mart_input(spark, sf_dir) -> DataFrame:
    lga = _lga(spark, sf_dir)
    return FT.mart_input_direct(_listings(spark, sf_dir), lga,
                                D.suburb_rows(testmap.lga_suburb(spark, sf_dir), lga))


def _dims(spark, sf_dir) -> dict[str, DataFrame]:
    return D.build_dims(_staging(spark, sf_dir))


# ---- sources / projections -------------------------------------------------------

@register("parse_date")
def q_parse_date(spark, sf_dir):
    """The warehouse's month floor in two steps: the date as 'yyyy-MM' text, and that text as a date."""
    li = testmap.listings(spark, sf_dir)
    return li.select("listing_id", "host_id", "scraped_date", X.parse_date(X.month_text("scraped_date"), "yyyy-MM").alias("year_month"),
                     X.parse_date("host_since").alias("host_since_date"))


@register("month_floor")
def q_month_floor(spark, sf_dir):
    li = testmap.listings(spark, sf_dir)
    return li.select("listing_id", "host_id", "scraped_date",
                     X.month_floor("scraped_date").alias("year_month"),
                     X.month_text("scraped_date").alias("year_month_text"))


def _write_feeds(spark, sf_dir, root: str, listings=None) -> dict[str, str]:
    """Write the five mapped feeds as CSV folders under ``root`` (of the listings those that meet a condition);
    returns their paths."""
    paths = {}
    for name, df in _staging(spark, sf_dir).items():
        paths[name] = f"{root}/{name}" if listings is None or name != "listings" else f"{root}/{name}/first"
        df = df if listings is None or name != "listings" else df.filter(listings)
        csv_feed.write_feed(df, name, paths[name], salt=F.xxhash64(*df.columns[:3]), key="host_id" if name == "listings" else None)
        paths[name] = f"{root}/{name}"
    return paths


@register("positional_projection")
def q_positional_projection(spark, sf_dir):
    """Listings written as CSV text (NULL tokens, '93.0' integers, skipped field), read back typed."""
    path = scratch_path(spark, "listings-feed")
    li = testmap.listings(spark, sf_dir)
    csv_feed.write_feed(li, "listings", path, salt=F.xxhash64("host_id", "listing_id", "scraped_date"))
    return csv_feed.read_feed(spark, path, "listings")


@register("csv_null_tokens")
def q_csv_null_tokens(spark, sf_dir):
    """Per-column NULL counts and ranges of the listings after the CSV round trip."""
    return Q.table_profile(q_positional_projection(spark, sf_dir))


@register("csv_rebuild_dm_host_neighbourhood")
def q_csv_rebuild(spark, sf_dir):
    """The full rebuild from CSV feed folders through every layer; returns the stored M3."""
    root = scratch_path(spark, "rebuild")
    marts = run_pipeline(spark, f"{root}/warehouse", feed_dirs=_write_feeds(spark, sf_dir, f"{root}/feeds"))
    return marts["dm_host_neighbourhood"]


@register("incremental_marts")
def q_incremental_marts(spark, sf_dir):
    """Listings arriving as four CSV drops (the last two going back to months already
    loaded); after each drop the stream refreshes only the touched months. Returns
    the listing-neighbourhood mart, which must equal the full rebuild."""
    root = scratch_path(spark, "incremental")
    st = _staging(spark, sf_dir)
    inc = IncrementalMarts(spark, f"{root}/source", f"{root}/target")
    inc.bootstrap(st)
    d = F.col("scraped_date")
    early, late = F.lit("1999-01-01").cast("date"), F.lit("1999-06-01").cast("date")
    mid = (d >= early) & (d < late)
    west = F.col("listing_neighbourhood") < "NATION_5"
    drops = [d < early, d >= late, mid & west, mid & ~F.coalesce(west, F.lit(False))]
    li = st["listings"]
    for i, cond in enumerate(drops):
        csv_feed.write_feed(li.filter(cond), "listings", f"{root}/source/drop_{i}",
                            salt=F.xxhash64("host_id", "listing_id", "scraped_date"), key="host_id")
        inc.run_once()
    return inc.mart("dm_listing_neighbourhood")


def _salt():
    return F.xxhash64("host_id", "listing_id", "scraped_date")


def _rebuild_and_refresh(spark, sf_dir, name: str) -> IncrementalMarts:
    """A rebuild from CSV feeds that hold the listings before 1998; then two more files, the later months first, each
    taken by a refresh that registers nothing but them."""
    root = scratch_path(spark, name)
    st = _staging(spark, sf_dir)
    first, second = (F.lit(x).cast("date") for x in ("1998-01-01", "1998-03-15"))
    d = F.col("scraped_date")
    feeds = _write_feeds(spark, sf_dir, f"{root}/feeds", d < first)
    run_pipeline(spark, f"{root}/warehouse", feed_dirs=feeds)
    inc = IncrementalMarts(spark, feeds["listings"], f"{root}/warehouse")
    for i, cond in enumerate([d >= second, (d >= first) & (d < second)]):
        csv_feed.write_feed(st["listings"].filter(cond), "listings", f"{feeds['listings']}/drop_{i}", salt=_salt(), key="host_id")
        inc.run_once()
    return inc


@register("rebuild_then_refresh")
def q_rebuild_then_refresh(spark, sf_dir):
    """M2 after a rebuild and two refreshes equals M2 of all listings."""
    return _rebuild_and_refresh(spark, sf_dir, "rebuild-refresh").mart("dm_property_type")


@register("refreshed_fact")
def q_refreshed_fact(spark, sf_dir):
    """The fact after a rebuild and two refreshes, joined back to its dimensions: the star by its natural keys."""
    wh = _rebuild_and_refresh(spark, sf_dir, "refreshed-fact").wh
    return FT.star_view(wh.read("warehouse", "fact"), {n: wh.read("warehouse", n) for n in
                                                       ["dim_lga", "dim_suburb", "dim_host", "dim_listing", "dim_date"]})


@register("rebuild_replaces_months")
def q_rebuild_replaces_months(spark, sf_dir):
    """A rebuild over fewer months leaves nothing of the months it lacks: M1 of the second rebuild."""
    root = scratch_path(spark, "replace")
    st = _staging(spark, sf_dir)
    run_pipeline(spark, root, staging=st)
    less = {**st, "listings": st["listings"].filter(F.col("scraped_date") < F.lit("1996-01-01").cast("date"))}
    return run_pipeline(spark, root, staging=less)["dm_listing_neighbourhood"]


@register("truncate_then_refresh")
def q_truncate_then_refresh(spark, sf_dir):
    """After truncate, a refresh loads every file again: M3 of all listings."""
    root = scratch_path(spark, "truncate-refresh")
    feeds = _write_feeds(spark, sf_dir, f"{root}/feeds")
    run_pipeline(spark, f"{root}/warehouse", feed_dirs=feeds)
    truncate_all(spark, f"{root}/warehouse")
    inc = IncrementalMarts(spark, feeds["listings"], f"{root}/warehouse")
    inc.bootstrap({n: csv_feed.read_feed(spark, p, n) for n, p in feeds.items() if n != "listings"})
    inc.run_once()
    return inc.mart("dm_host_neighbourhood")


@register("truncate_layers")
def q_truncate_layers(spark, sf_dir):
    """Rows of every warehouse table before and after truncate (S9), and whether its columns are the same."""
    root = scratch_path(spark, "truncate")
    run_pipeline(spark, root, staging=_staging(spark, sf_dir))
    names = ["census_1", "census_2", "lga_code", "lga_suburb", "listings", "dim_lga", "dim_suburb", "dim_host", "dim_listing",
             "dim_date", "fact"]
    wh = Warehouse(spark, root, register_views=False)

    def counted():
        return {n: wh.read("warehouse", n) for n in names}

    before = counted()
    truncate_all(spark, root)       # the tables read before are in folders of their own and stay
    after = counted()
    return Q.union_all([
        before[n].agg(F.count(F.lit(1)).alias("rows_before")).crossJoin(after[n].agg(F.count(F.lit(1)).alias("rows_after")))
        .select(F.lit(n).alias("table_name"), "rows_before", "rows_after",
                F.lit(sorted(before[n].columns) == sorted(after[n].columns)).alias("same_columns")) for n in names])


@register("catalog_layers")
def q_catalog_layers(spark, sf_dir):
    """One catalog database per layer (S11): M3 read back by its catalog name."""
    root = scratch_path(spark, "catalog")
    run_pipeline(spark, root, staging=_staging(spark, sf_dir))
    prefix = f"rm_{root.rsplit('-', 1)[1]}_"
    register_catalog(spark, root, prefix)
    return spark.table(f"{prefix}datamart.dm_host_neighbourhood")


@register("ordered_export")
def q_ordered_export(spark, sf_dir):
    """M3 exported in order as CSV (S10, O2) and read back, with each row's place in the files."""
    path = scratch_path(spark, "export")
    mart = M.dm_host_neighbourhood(_mart_input(spark, sf_dir), exact=True)
    export_csv(mart, M.MART_ORDER["dm_host_neighbourhood"], path)
    return read_export(spark, path, mart.schema.simpleString()[7:-1].replace(":", " "))


@register("csv_rejects")
def q_csv_rejects(spark, sf_dir):
    """Listings written as CSV, one in 97 with a price that is no number, staged and rejected in one pass: per month and
    outcome the rows, the sum of the prices, and the rejected rows that name their column and file."""
    root = scratch_path(spark, "rejects")
    li = testmap.listings(spark, sf_dir)
    text = csv_feed.to_feed_text(li, "listings", F.xxhash64("host_id", "listing_id", "scraped_date"))
    position = {name: pos for pos, name, _ in schemas.FEEDS["listings"]}
    wrong = F.col(f"c{position['listing_id']}").cast("double") % 97 == 0
    text = text.withColumn(f"c{position['price']}", F.when(wrong, F.lit("n/a")).otherwise(F.col(f"c{position['price']}")))
    text.write.option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(f"{root}/feed")
    staged, rejected = csv_feed.stage_feed(Warehouse(spark, f"{root}/wh", register_views=False), f"{root}/feed", "listings")
    date = F.col("fields")[position["scraped_date"] - 1].cast("date")
    told = (F.col("bad_columns") == F.array(F.lit("price"))) & F.col("source_file").endswith(".csv")
    both = staged.select("scraped_date", "price", F.lit("staged").alias("outcome"), F.lit(0).alias("told")).unionByName(
        rejected.select(date.alias("scraped_date"), F.lit(None).cast("bigint").alias("price"), F.lit("rejected").alias("outcome"),
                        told.cast("int").alias("told")))
    return both.groupBy(X.month_floor("scraped_date").alias("year_month"), "outcome").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("price").alias("sum_price"), F.sum("told").alias("n_told"))


# ---- joins -----------------------------------------------------------------------

@register("substr_prefix_join")
def q_substr_prefix_join(spark, sf_dir):
    c1 = testmap.census_1(spark, sf_dir).withColumn("__code", X.substr_prefix("lga_code_2016"))
    j = J.left_join(c1, testmap.lga_code(spark, sf_dir), F.col("__code") == F.col("lga_code"))
    return j.select(F.col("__code").alias("lga_code_2016"), "lga_name", "tot_p_p")


@register("case_insensitive_join")
def q_case_insensitive_join(spark, sf_dir):
    lga = _lga(spark, sf_dir).select(F.col("lga_code_2016").alias("lga_code"),
                                     F.col("lga_name").alias("dim_lga_name"))
    j = J.case_insensitive_left_join(testmap.lga_suburb(spark, sf_dir), lga, "lga_name", "dim_lga_name")
    return j.select("suburb_name", F.col("lga_name").alias("suburb_lga_name"), "lga_code", "dim_lga_name")


@register("lookup_with_default")
def q_lookup_with_default(spark, sf_dir):
    li = testmap.listings(spark, sf_dir)
    sub = _suburb(spark, sf_dir).select("suburb_id", F.lower("suburb_name").alias("__sk"))
    j = J.lookup_with_default(li.withColumn("__hk", F.lower("host_neighbourhood")), sub,
                              F.col("__hk") == F.col("__sk"), "suburb_id", "host_neighf",
                              X.UNKNOWN_SUBURB_ID)
    return j.select("listing_id", "host_id", "scraped_date", "host_neighbourhood",
                    F.col("host_neighf").cast("bigint").alias("host_neighf"))


def _composite(spark, sf_dir, null_safe: bool):
    li = _listings(spark, sf_dir)
    dl = D.dim_listing(li).select(F.col("listing_id").alias("listing_idf"), "list_orig_id",
                                  *[F.col(c).alias(f"d_{c}") for c in D.LISTING_TUPLE[1:]])
    j = J.composite_left_join(li, dl, [("listing_id", "list_orig_id")] +
                              [(c, f"d_{c}") for c in D.LISTING_TUPLE[1:]], null_safe)
    return j.select("listing_id", "host_id", "scraped_date", "has_availability", "listing_idf")


@register("composite_key_join")
def q_composite_key_join(spark, sf_dir):
    return _composite(spark, sf_dir, False)


@register("composite_key_join_null_safe")
def q_composite_key_join_null_safe(spark, sf_dir):
    return _composite(spark, sf_dir, True)


@register("price_cap_left_join")
def q_price_cap_left_join(spark, sf_dir):
    li = _listings(spark, sf_dir).filter(F.col("price") < 2000)
    lga = _lga(spark, sf_dir).select(F.col("lga_code_2016").alias("listing_neigh_idf"),
                                     F.col("lga_name").alias("__lga_name"))
    j = J.left_join(li, lga, F.col("__lga_name") == F.col("listing_neighbourhood"))
    return j.select("listing_id", "host_id", "scraped_date", "price", "listing_neigh_idf")


# ---- distinct, keys, union ----------------------------------------------------------

@register("distinct_tuple")
def q_distinct_tuple(spark, sf_dir):
    li = testmap.listings(spark, sf_dir)
    return li.select(F.col("host_id").alias("host_orig_id"), "host_name", "host_since",
                     "host_is_superhost").distinct()


@register("dense_surrogate_key")
def q_dense_surrogate_key(spark, sf_dir):
    li = _listings(spark, sf_dir)
    t = li.select("host_id", "listing_id", "year_month").distinct()
    return dense_surrogate_key(t, ["host_id", "listing_id", "year_month"], "row_id", method="range")


@register("union_member")
def q_union_member(spark, sf_dir):
    # the suburb list with the appended 'unknown' member (U1 / S8), key included
    return _suburb(spark, sf_dir)


# ---- dimensions and fact --------------------------------------------------------------

@register("dim_lga")
def q_dim_lga(spark, sf_dir):
    return _lga(spark, sf_dir)


@register("dim_suburb")
def q_dim_suburb(spark, sf_dir):
    return _suburb(spark, sf_dir)


@register("dim_host")
def q_dim_host(spark, sf_dir):
    return D.dim_host(_listings(spark, sf_dir))


@register("dim_listing")
def q_dim_listing(spark, sf_dir):
    return D.dim_listing(_listings(spark, sf_dir))


@register("dim_date")
def q_dim_date(spark, sf_dir):
    return D.dim_date(_listings(spark, sf_dir))


@register("fact")
def q_fact(spark, sf_dir):
    dims = _dims(spark, sf_dir)
    return FT.build_fact(dims["listings"], dims)


# ---- aggregates ------------------------------------------------------------------------

@register("count_if")
def q_count_if(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    return s.groupBy("listing_neighbourhood", "year_month").agg(
        X.count_if(active()).alias("n_active"), X.count_if(~active()).alias("n_inactive"),
        X.count_if(active().isNotNull()).alias("n_known"))


@register("min_max_if")
def q_min_max_if(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    return s.groupBy("property_type", "year_month").agg(
        X.min_if(active(), "price").alias("min_price_act"), X.max_if(active(), "price").alias("max_price_act"))


@register("median_if")
def q_median_if(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    return s.groupBy("listing_neighbourhood", "year_month").agg(
        X.median_if(active(), "price").alias("median_price_act"))


@register("approx_median_if")
def q_approx_median_if(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    return s.groupBy("listing_neighbourhood", "year_month").agg(
        X.approx_median_if(active(), "price").alias("approx_median_price_act"))


@register("count_distinct_if")
def q_count_distinct_if(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    return s.groupBy("host_neighbourhood_lga", "year_month").agg(
        F.count_distinct("host_orig_id").alias("n_hosts"),
        X.count_distinct_if("host_is_superhost", "host_orig_id").alias("n_superhosts"))


@register("rate_of_counts")
def q_rate_of_counts(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    g = s.groupBy("listing_neighbourhood").agg(
        X.count_if(active()).alias("__a"), X.count_if(active().isNotNull()).alias("__k"),
        X.count_distinct_if("host_is_superhost", "host_orig_id").alias("__s"),
        F.count_distinct("host_orig_id").alias("__h"))
    return g.select("listing_neighbourhood", X.ratio_pct("__a", "__k").alias("active_listings_rate"),
                    X.ratio_pct("__s", "__h").alias("super_host_rate"))


@register("sum_if")
def q_sum_if(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    return s.groupBy("room_type", "year_month").agg(
        X.sum_if(active(), "stays").alias("stays_act"), X.sum_if(active(), "revenue").alias("revenue_act"),
        F.sum("revenue").alias("revenue_all"))


@register("lag_over_aggregate")
def q_lag_over_aggregate(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    g = s.groupBy("listing_neighbourhood", "year_month").agg(X.count_if(active()).alias("n_active"))
    w = Window.partitionBy("listing_neighbourhood").orderBy(F.col("year_month").asc_nulls_first())
    return g.withColumn("prev_n_active", F.lag("n_active").over(w))


@register("pct_change")
def q_pct_change(spark, sf_dir):
    s = _mart_input(spark, sf_dir)
    g = s.groupBy("property_type", "year_month").agg(X.count_if(~active()).alias("n_inactive"))
    w = Window.partitionBy("property_type").orderBy(F.col("year_month").asc_nulls_first())
    return g.withColumn("pct_change_inactive", pct_change("n_inactive", w))


@register("top_k")
def q_top_k(spark, sf_dir):
    m1 = M.dm_listing_neighbourhood(_mart_input(spark, sf_dir))
    return (m1.filter(F.col("average_estimated_revenue_per_active_listings").isNotNull())
            .orderBy(F.desc("average_estimated_revenue_per_active_listings"),
                     F.asc_nulls_first("listing_neighbourhood"), F.asc("year_month"))
            .limit(10)
            .select("listing_neighbourhood", "year_month", "average_estimated_revenue_per_active_listings"))


# ---- quality ---------------------------------------------------------------------------

@register("check_unique")
def q_check_unique(spark, sf_dir):
    d = _dims(spark, sf_dir)
    return Q.union_all([
        Q.check_unique(d["dim_date"], "date_id", "dim_date"),
        Q.check_unique(d["dim_host"], "hosts_id", "dim_host"),
        Q.check_unique(d["dim_lga"], "lga_code_2016", "dim_lga"),
        Q.check_unique(d["dim_listing"], "listing_id", "dim_listing"),
        Q.check_unique(d["dim_suburb"], "suburb_id", "dim_suburb"),
        Q.check_unique(d["dim_suburb"], F.lower("suburb_name"), "dim_suburb", "lower(suburb_name)"),
    ])


def _stored_star(spark, sf_dir, name: str) -> dict[str, DataFrame]:
    """The dimensions and the fact as a rebuild stores them, under the scratch folder."""
    wh = Warehouse(spark, scratch_path(spark, name), register_views=False)
    li = _listings(spark, sf_dir)
    li = wh.write(by_key(li, slice_count(input_bytes(li)), "host_id"), "warehouse", "listings")
    n = slice_count(wh.size("warehouse", "listings"))
    st = {n: wh.write(df, "warehouse", n) for n, df in _staging(spark, sf_dir).items() if n != "listings"}
    d = {"dim_lga": wh.write(D.dim_lga(st["census_1"], st["census_2"], st["lga_code"]), "warehouse", "dim_lga"),
         "dim_date": wh.write(D.dim_date(li), "warehouse", "dim_date")}
    d |= {n: write_dim(wh, n, li).drop(D.BUCKET) for n in D.LARGE}
    d["dim_suburb"] = wh.write(D.dim_suburb(st["lga_suburb"], d["dim_lga"]), "warehouse", "dim_suburb")
    if n > 1:
        let_go(spark)
    # a slice takes its part of the listing dimension along: the joins are by listing id, among others
    d["fact"] = wh.write([FT.build_fact(rows, d) for rows in by_key(li, n, "listing_id")], "warehouse", "fact")
    return d


@register("check_foreign_key")
def q_check_foreign_key(spark, sf_dir):
    d = _stored_star(spark, sf_dir, "foreign-keys")
    return Q.check_foreign_keys(d["fact"], [
        ("date_id", d["dim_date"], "date_id", "fk_dim_date"),
        ("host_idf", d["dim_host"], "hosts_id", "fk_dim_host"),
        ("listing_neigh_idf", d["dim_lga"], "lga_code_2016", "fk_dim_lga"),
        ("listing_idf", d["dim_listing"], "listing_id", "fk_dim_listing"),
        ("host_neighf", d["dim_suburb"], "suburb_id", "fk_dim_suburb"),
    ])


@register("table_profile")
def q_table_profile(spark, sf_dir):
    d = _dims(spark, sf_dir)
    return Q.table_profile(FT.build_fact(d["listings"], d))


# ---- marts -----------------------------------------------------------------------------

@register("dm_listing_neighbourhood")
def q_dm_listing_neighbourhood(spark, sf_dir):
    return M.dm_listing_neighbourhood(_mart_input(spark, sf_dir))


@register("dm_listing_neighbourhood_star")
def q_dm_listing_neighbourhood_star(spark, sf_dir):
    """M1 over the star as it is stored: one plan of all its joins would hold every shuffle on disk until its end."""
    d = _stored_star(spark, sf_dir, "star-m1")
    return M.dm_listing_neighbourhood(FT.star_view(d["fact"], d))


@register("dm_property_type")
def q_dm_property_type(spark, sf_dir):
    return M.dm_property_type(_mart_input(spark, sf_dir), divisor="active")


@register("dm_property_type_all_divisor")
def q_dm_property_type_all_divisor(spark, sf_dir):
    return M.dm_property_type(_mart_input(spark, sf_dir), divisor="all")


@register("dm_host_neighbourhood")
def q_dm_host_neighbourhood(spark, sf_dir):
    return M.dm_host_neighbourhood(_mart_input(spark, sf_dir))


@register("dm_host_neighbourhood_decimal")
def q_dm_host_neighbourhood_decimal(spark, sf_dir):
    """M3 with the exact quotient of six places, as it is exported."""
    return M.dm_host_neighbourhood(_mart_input(spark, sf_dir), exact=True)


def _bucketed(spark, sf_dir, name: str) -> DataFrame:
    d = _stored_star(spark, sf_dir, name)
    return FT.bucketed_star_view(FT.store_bucketed(spark, d["fact"], d, scratch_path(spark, name), f"{name.replace('-', '_')}_"))


@register("dm_property_type_star")
def q_dm_property_type_star(spark, sf_dir):
    """M2 over the star whose fact and large dimensions are stored in buckets of their surrogate keys."""
    return M.dm_property_type(_bucketed(spark, sf_dir, "star-m2"))


@register("dm_host_neighbourhood_star")
def q_dm_host_neighbourhood_star(spark, sf_dir):
    """M3 over the bucketed star."""
    return M.dm_host_neighbourhood(_bucketed(spark, sf_dir, "star-m3"))


def _sketches(spark, sf_dir, name: str) -> DataFrame:
    """The month sketches of M1, stored."""
    wh = Warehouse(spark, scratch_path(spark, name), register_views=False)
    return wh.write(SK.month_sketches(_mart_input(spark, sf_dir), M.LISTING_MARTS["dm_listing_neighbourhood"]), "warehouse",
                    "dm_listing_neighbourhood_sketch", ["year_month"])


@register("distinct_hosts_rollup")
def q_distinct_hosts_rollup(spark, sf_dir):
    """Distinct hosts and superhosts by neighbourhood over the last 12 months, from stored month sketches alone
    (exact while a group has no more hosts than a sketch has entries)."""
    return SK.rolled_up(_sketches(spark, sf_dir, "rollup-12"), ["listing_neighbourhood"], 12).select(
        "listing_neighbourhood", "number_of_distinct_hosts", "number_of_superhosts", "super_host_rate")


@register("median_price_rollup")
def q_median_price_rollup(spark, sf_dir):
    """The median price of active rows by neighbourhood over all months, from merged price sketches: how far its rank in
    all the prices lies from the middle, and whether that is within the sketch's bound."""
    star = _mart_input(spark, sf_dir)
    median = SK.rolled_up(_sketches(spark, sf_dir, "rollup-median"), ["listing_neighbourhood"])
    median = median.select("listing_neighbourhood", F.col("median_price_act").alias("m"))
    prices = star.filter(active()).groupBy("listing_neighbourhood", "price").agg(F.count(F.lit(1)).alias("n"))
    ranks = prices.join(median, prices.listing_neighbourhood.eqNullSafe(median.listing_neighbourhood)).groupBy(prices.listing_neighbourhood).agg(
        F.sum("n").alias("n_active"), F.sum(F.when(F.col("price") < F.col("m"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("price") <= F.col("m"), F.col("n")).otherwise(0)).alias("upto"))
    # the true median's rank lies between the two, give or take the bound
    slack = F.ceil(F.col("n_active") * SK.RANK_ERROR) + 1
    near = (F.col("below") - slack <= F.col("n_active") / 2) & (F.col("upto") + slack >= F.col("n_active") / 2)
    return ranks.select("listing_neighbourhood", "n_active", near.alias("within_bound"))


# ---- ad-hoc ----------------------------------------------------------------------------

@register("best_worst_population")
def q_best_worst_population(spark, sf_dir):
    return A.best_worst_population(_mart_input(spark, sf_dir), _lga(spark, sf_dir), D.dim_date(_listings(spark, sf_dir)), 12)


@register("best_listing_type")
def q_best_listing_type(spark, sf_dir):
    return A.best_listing_type(_mart_input(spark, sf_dir), 5)


@register("multi_host_same_lga")
def q_multi_host_same_lga(spark, sf_dir):
    return A.multi_host_same_lga(_mart_input(spark, sf_dir))


@register("mortgage_coverage")
def q_mortgage_coverage(spark, sf_dir):
    return A.mortgage_coverage(_mart_input(spark, sf_dir), _lga(spark, sf_dir), D.dim_date(_listings(spark, sf_dir)), 12)
