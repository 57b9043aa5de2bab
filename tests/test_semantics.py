"""The warehouse's semantics on the hand-made feeds."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from rentmart.operators import quality as Q
from rentmart.plans import dims as D
from rentmart.plans import fact as FT
from rentmart.plans import marts as M
from rentmart.plans.pipeline import run_pipeline
from rentmart.sources import csv_feed
from rentmart.sources.tables import Warehouse
from fixtures import write_fixture
from helpers import rows

JAN, FEB, MAR = dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("fixture")
    paths = write_fixture(str(root / "feeds"))
    staging = csv_feed.build_staging(spark, paths)
    dims = D.build_dims(staging)
    wide = FT.build_wide_fact(dims["listings"], dims)
    return {"paths": paths, "staging": staging, "dims": dims, "wide": wide, "root": root}


def test_price_cap_and_fanout(built):
    fact = FT.fact_table(built["wide"])
    # 9 rows; price 2000 and NULL dropped -> 7; the BONDI row doubles -> 8
    assert fact.count() == 8
    assert sorted(r.price for r in fact.collect()) == [100, 120, 150, 150, 200, 200, 300, 1999]


def test_null_composite_keys_do_not_match(built, spark):
    wide = built["wide"]
    r5 = wide.filter(F.col("price") == 150).filter(F.col("date_id") == 1).first()
    assert r5.listing_idf is None and r5.host_idf is None
    safe = FT.build_wide_fact(built["dims"]["listings"], built["dims"], null_safe=True)
    r5s = safe.filter(F.col("price") == 150).filter(F.col("date_id") == 1).first()
    assert r5s.listing_idf is not None and r5s.host_idf is not None


def test_unknown_suburb_and_case(built):
    fact = FT.fact_table(built["wide"])
    assert fact.filter(F.col("host_neighf") == 99999999).count() == 1      # Atlantis
    star = FT.mart_input(built["wide"])
    # 'sydney' (case differs) finds no LGA; suburbs match ignoring case
    assert star.filter(F.col("listing_neighbourhood").isNull()).count() == 1
    assert star.filter(F.col("host_neighbourhood_lga") == "Waverley").count() == 4


def test_m1_values(built):
    m1 = M.dm_listing_neighbourhood(FT.mart_input(built["wide"]))
    w = {r.year_month: r for r in m1.filter("listing_neighbourhood = 'Waverley'").collect()}
    jan, feb = w[JAN], w[FEB]
    assert abs(jan.active_listings_rate - 100 / 3) < 1e-9
    assert (jan.min_price_act, jan.max_price_act, jan.median_price_act) == (100, 100, 100.0)
    assert jan.number_of_distinct_hosts == 2 and jan.super_host_rate == 100.0
    assert jan.total_number_of_stays == 20
    assert jan.average_estimated_revenue_per_active_listings == 8000.0   # 2000 + 2 x 3000
    assert jan.percentage_change_for_active_listings is None            # first month
    assert feb.percentage_change_for_active_listings == 100.0
    assert feb.percentage_change_for_inactive_listings == -100.0
    s = {r.year_month: r for r in m1.filter("listing_neighbourhood = 'Sydney'").collect()}
    assert set(s) == {JAN, MAR}                                          # gap: no February row
    assert s[MAR].min_price_act is None                                  # no active row
    assert s[MAR].percentage_change_for_active_listings is None          # previous count 0
    # January's only row has a NULL composite key: it leaves the availability counts
    assert s[JAN].active_listings_rate is None and s[JAN].number_of_distinct_hosts == 0
    assert s[MAR].percentage_change_for_inactive_listings is None        # previous count 0
    assert m1.filter(F.col("listing_neighbourhood").isNull()).count() == 1


def test_m2_divisors(built):
    star = FT.mart_input(built["wide"])
    act = M.dm_property_type(star, "active").filter("property_type = 'Apartment'").first()
    allr = M.dm_property_type(star, "all").filter("property_type = 'Apartment'").first()
    # Apartment/Entire/3 in January: two inactive fan-out rows, revenue 6000
    assert act.average_estimated_revenue_per_active_listings is None
    assert allr.average_estimated_revenue_per_active_listings == 3000.0


def test_m3_per_host_uses_active_revenue(built):
    m3 = M.dm_host_neighbourhood(FT.mart_input(built["wide"]), exact=True)
    r = m3.filter("host_neighbourhood_lga = 'Waverley' and year_month = '2020-01-01'").first()
    # rows: r1 (active, 2000) and r8 (inactive, 3000): total 5000, active 2000, 2 hosts
    assert r.number_of_distinct_hosts == 2 and r.estimated_revenue == 5000
    assert float(r.estimated_revenue_per_host_distinct) == 1000.0
    for x in m3.collect():
        if x.number_of_distinct_hosts and x.estimated_revenue_per_host_distinct is not None:
            assert float(x.estimated_revenue_per_host_distinct) <= x.estimated_revenue / x.number_of_distinct_hosts + 1e-6


def test_star_path_equals_direct_path(built):
    d = built["dims"]
    star = FT.star_view(FT.fact_table(built["wide"]), d)
    direct = FT.mart_input_direct(d["listings"], d["dim_lga"], d["dim_suburb"])
    assert rows(star) == rows(direct.select(*star.columns))


def test_star_path_equals_direct_path_null_safe(built):
    d = built["dims"]
    fact = FT.build_fact(d["listings"], d, null_safe=True)
    star = FT.star_view(fact, d)
    direct = FT.mart_input_direct(d["listings"], d["dim_lga"], d["dim_suburb"], null_safe=True)
    assert rows(star) == rows(direct.select(*star.columns))


def test_keys_and_foreign_keys(built):
    d = built["dims"]
    u = rows(Q.check_unique(d["dim_suburb"], F.lower("suburb_name"), "dim_suburb", "lower"))
    assert u[0][5] == 1                         # 'bondi' under two LGAs is reported
    fk = Q.check_foreign_key(FT.fact_table(built["wide"]), "listing_idf", d["dim_listing"],
                             "listing_id", "fk").first()
    assert fk.n_orphans == 0 and fk.n_null_fk == 1


def test_dim_lga_prefix_and_missing_parts(built):
    lga = {r.lga_code_2016: r for r in built["dims"]["dim_lga"].collect()}
    assert set(lga) == {"10001", "10002", "10003"}
    assert lga["10003"].lga_name is None and lga["10003"].median_age_persons is None


def test_pipeline_idempotent_truncate_and_export(spark, built):
    from rentmart.plans.pipeline import truncate_all
    target = str(built["root"] / "wh")
    first = {k: rows(v) for k, v in run_pipeline(spark, target, feed_dirs=built["paths"],
                                                 export_dir=str(built["root"] / "out")).items()}
    second = {k: rows(v) for k, v in run_pipeline(spark, target, feed_dirs=built["paths"]).items()}
    assert first == second
    exported = spark.read.option("header", True).csv(str(built["root"] / "out" / "dm_host_neighbourhood"))
    keys = [(r[0] or "", r[1]) for r in exported.collect()]
    assert keys == sorted(keys)
    from rentmart.plans.pipeline import register_catalog
    register_catalog(spark, target, prefix="fx_")
    assert spark.sql("SELECT count(*) AS n FROM fx_warehouse.fact").first().n == 8
    assert spark.table("fx_datamart.dm_host_neighbourhood").count() == len(first["dm_host_neighbourhood"])
    assert spark.table("fx_warehouse.listings").count() == 9          # month-partitioned table
    lean = {k: rows(v) for k, v in run_pipeline(spark, str(built["root"] / "wh_lean"), feed_dirs=built["paths"],
                                                 write_staging=False).items()}
    assert lean == first
    truncate_all(spark, target)
    fact = Warehouse(spark, target).read("warehouse", "fact")
    assert fact.count() == 0 and "host_neighf" in fact.columns


def test_approx_median_option(built):
    star = FT.mart_input(built["wide"])
    exact = {(r.listing_neighbourhood, r.year_month): r.median_price_act
             for r in M.dm_listing_neighbourhood(star).collect()}
    approx = {(r.listing_neighbourhood, r.year_month): r.median_price_act
              for r in M.dm_listing_neighbourhood(star, median="approx").collect()}
    assert exact.keys() == approx.keys()
    # one active price per group here: both forms agree
    assert all(exact[k] == approx[k] for k in exact if exact[k] is not None and k[1] == JAN)


def test_approx_distinct_option(built):
    star = FT.mart_input(built["wide"])
    exact = rows(M.dm_host_neighbourhood(star).select("host_neighbourhood_lga", "year_month",
                                                      "number_of_distinct_hosts"))
    approx = rows(M.dm_host_neighbourhood(star, distinct="approx").select(
        "host_neighbourhood_lga", "year_month", "number_of_distinct_hosts"))
    assert exact == approx          # tiny groups: the sketch is exact


def test_cli_rebuild_and_refresh(spark, built, tmp_path):
    from rentmart.__main__ import main
    feeds = str(built["root"] / "feeds")
    assert main(["rebuild", "--feeds", feeds, "--target", str(tmp_path / "wh"), "--catalog-prefix", "cli_"]) == 0
    assert spark.table("cli_datamart.dm_host_neighbourhood").count() > 0
    # the refresh command watches the same listings folder: the first run takes every file
    assert main(["refresh", "--feeds", feeds, "--target", str(tmp_path / "inc"),
                 "--export", str(tmp_path / "out")]) == 0
    exported = spark.read.option("header", True).csv(str(tmp_path / "out" / "dm_property_type"))
    assert exported.count() == spark.table("cli_datamart.dm_property_type").count()
    got = Warehouse(spark, str(tmp_path / "inc")).read("datamart", "dm_listing_neighbourhood")
    want = spark.table("cli_datamart.dm_listing_neighbourhood")
    assert rows(got.select(*want.columns)) == rows(want)
    assert main(["truncate", "--target", str(tmp_path / "wh")]) == 0
    fact = Warehouse(spark, str(tmp_path / "wh")).read("warehouse", "fact")
    assert fact.count() == 0 and "listing_idf" in fact.columns


def test_empty_input(built):
    from rentmart.plans import adhoc as A
    star = FT.mart_input(built["wide"]).limit(0)
    lga = built["dims"]["dim_lga"]
    for df in (M.dm_listing_neighbourhood(star), M.dm_property_type(star), M.dm_host_neighbourhood(star),
               A.best_listing_type(star), A.multi_host_same_lga(star)):
        assert df.count() == 0
    q1 = A.best_worst_population(star, lga, built["dims"]["dim_date"]).collect()
    assert [r.performance for r in q1] == ["best_minus_worst"] and q1[0].revenue_per_active_listing is None
    q4 = A.mortgage_coverage(star, lga, built["dims"]["dim_date"]).collect()
    assert len(q4) == 1 and q4[0].n_hosts == 0 and q4[0].covering_pct is None
