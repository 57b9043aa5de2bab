"""Foreign keys in one pass, the bucketed star, sketches, rejects, ordered export, and what the questions read."""
import random

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from rentmart.functions import expr as X
from rentmart.operators import quality as Q
from rentmart.plans import adhoc as A
from rentmart.plans import dims as D
from rentmart.plans import fact as FT
from rentmart.plans import marts as M
from rentmart.plans import sketches as SK
from rentmart.session import scratch_path
from rentmart.sources import csv_feed, testmap
from rentmart.sources.tables import Warehouse, export_csv, read_export
from test_plans import plan


def operators(df) -> list[str]:
    """The operators of a formatted plan, each with its details."""
    return [b.strip() for b in plan(df).split("\n\n") if b.strip().startswith("(")]


@pytest.fixture(scope="module")
def star(spark):
    root = scratch_path(spark, "reports")
    wh = Warehouse(spark, root, register_views=False)
    st = {n: wh.write(df, "staging", n) for n, df in testmap.staging(spark, SF_SMALL).items()}
    li = wh.write(D.load_listings(st["listings"]), "warehouse", "listings", ["year_month"])
    d = {"dim_lga": wh.write(D.dim_lga(st["census_1"], st["census_2"], st["lga_code"]), "warehouse", "dim_lga"),
         "dim_host": wh.write(D.dim_host(li), "warehouse", "dim_host"), "dim_listing": wh.write(D.dim_listing(li), "warehouse", "dim_listing"),
         "dim_date": wh.write(D.dim_date(li), "warehouse", "dim_date")}
    d["dim_suburb"] = wh.write(D.dim_suburb(st["lga_suburb"], d["dim_lga"]), "warehouse", "dim_suburb")
    d["fact"] = wh.write(FT.build_fact(li, d), "warehouse", "fact")
    return {"dims": d, "direct": FT.mart_input_direct(li, d["dim_lga"], d["dim_suburb"]), "root": root}


KEYS = [("date_id", "dim_date", "date_id"), ("host_idf", "dim_host", "hosts_id"), ("listing_idf", "dim_listing", "listing_id"),
        ("listing_neigh_idf", "dim_lga", "lga_code_2016"), ("host_neighf", "dim_suburb", "suburb_id")]


def test_foreign_keys_in_one_pass(spark, star):
    d = star["dims"]
    lame = {**d, "dim_host": d["dim_host"].filter("hosts_id % 3 > 0"), "dim_date": d["dim_date"].limit(0)}
    for dims in (d, lame):
        one = Q.check_foreign_keys(d["fact"], [(fk, dims[t], pk, f"fk_{t}") for fk, t, pk in KEYS])
        each = Q.union_all([Q.check_foreign_key(d["fact"], fk, dims[t], pk, f"fk_{t}") for fk, t, pk in KEYS])
        assert rows(one) == rows(each)
        assert sum("Scan parquet" in b and "listing_neigh_idf" in b for b in operators(one)) == 1
    none = Q.check_foreign_keys(d["fact"].limit(0), [(fk, d[t], pk, f"fk_{t}") for fk, t, pk in KEYS])
    assert sorted(tuple(r)[1:] for r in none.collect()) == [(0, 0, 0)] * 5


def test_bucketed_star_joins_without_exchanging_the_dimensions(spark, star):
    d = star["dims"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tables = FT.store_bucketed(spark, d["fact"], d, f"{star['root']}/bucketed", "rep_", buckets=8)
        view = FT.bucketed_star_view(tables)
        assert rows(view) == rows(FT.star_view(d["fact"], d))
        exchanges = [b for b in operators(view) if "Exchange" in b.split("\n")[0]]
        assert exchanges
        # neither large dimension goes through an exchange; the fact goes through one for its hosts, none for its listings
        for name in ("list_orig_id", "host_orig_id"):
            first = [e for e in exchanges if name in e.split("Arguments:")[0] and "revenue" not in e]
            assert not first, (name, first)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sketches_roll_up_over_months(spark):
    r = random.Random(4)
    rows_ = [("g" if i % 3 else "h", m, r.randrange(9_000), r.random() < 0.3, True, int(r.gauss(500, 90))) for m in range(1, 13) for i in range(4_000)]
    df = spark.createDataFrame(rows_, "listing_neighbourhood string, m int, host_orig_id long, host_is_superhost boolean, has_availability boolean, price long")
    df = df.withColumn("year_month", F.make_date(F.lit(2020), "m", F.lit(1))).repartition(6)
    merged = SK.rolled_up(SK.month_sketches(df, ["listing_neighbourhood"]), ["listing_neighbourhood"])
    for g in merged.collect():
        own = [x for x in rows_ if x[0] == g.listing_neighbourhood]
        hosts = len({x[2] for x in own})
        assert abs(g.number_of_distinct_hosts - hosts) <= 0.03 * hosts
        prices = sorted(x[5] for x in own)
        below, upto = sum(p < g.median_price_act for p in prices), sum(p <= g.median_price_act for p in prices)
        slack = SK.RANK_ERROR * len(prices) + 1
        assert below - slack <= len(prices) / 2 <= upto + slack
    last = SK.rolled_up(SK.month_sketches(df, ["listing_neighbourhood"]), ["listing_neighbourhood"], 2)
    want = {g: len({x[2] for x in rows_ if x[0] == g and x[1] > 10}) for g in "gh"}
    assert {x.listing_neighbourhood: x.number_of_distinct_hosts for x in last.collect()} == want   # below the sketch's size: exact
    empty = SK.rolled_up(SK.month_sketches(df.filter("price < 0 and m = 99"), ["listing_neighbourhood"]), ["listing_neighbourhood"])
    assert empty.count() == 0
    idle = SK.rolled_up(SK.month_sketches(df.withColumn("has_availability", F.lit(False)), ["listing_neighbourhood"]), ["listing_neighbourhood"])
    assert {x.median_price_act for x in idle.collect()} == {None}


def test_rejected_rows_are_staged_apart_in_one_pass(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.csv").write_text("a,b,c,d\nLGA1,ten,2,3\nLGA2,1,2,3\nLGA3,\\N,x,3.0\n")
    (feed / "b.csv").write_text("a,b,c,d\nLGA4,1,2,93.0\nLGA5,y,z,1\n")
    staged, rejected = csv_feed.stage_feed(Warehouse(spark, str(tmp_path / "wh"), register_views=False), str(feed), "census_1")
    assert rows(staged.drop(*csv_feed.SOURCE)) == [("LGA2", 1, 2, 3), ("LGA4", 1, 2, 93)]
    got = {r.fields[0]: (r.bad_columns, r.fields, r.source_file.rsplit("/", 1)[1]) for r in rejected.collect()}
    assert got == {"LGA1": (["tot_p_m"], ["LGA1", "ten", "2", "3"], "a.csv"), "LGA3": (["tot_p_f"], ["LGA3", "\\N", "x", "3.0"], "a.csv"),
                   "LGA5": (["tot_p_m", "tot_p_f"], ["LGA5", "y", "z", "1"], "b.csv")}


def test_rebuild_sets_rejected_rows_aside(spark, tmp_path):
    from fixtures import write_fixture
    from rentmart.plans.pipeline import run_pipeline
    paths = write_fixture(str(tmp_path / "feeds"))
    good = {n: rows(df) for n, df in run_pipeline(spark, str(tmp_path / "good"), feed_dirs=paths).items()}
    bad = tmp_path / "feeds" / "listings" / "bad.csv"
    lines = next(p for p in (tmp_path / "feeds" / "listings").rglob("*.csv")).read_text().splitlines()
    bad.write_text(lines[0] + "\n" + lines[1].replace("2020", "notayear") + "\n")
    got = run_pipeline(spark, str(tmp_path / "bad"), feed_dirs=paths, on_error="reject")
    assert {n: rows(df) for n, df in got.items()} == good
    kept = Warehouse(spark, str(tmp_path / "bad"), register_views=False).read("staging", "listings_rows")
    assert kept.filter("status = 'rejected'").count() == 1 and kept.filter("status = 'staged'").count() == 9


def test_export_is_in_order_over_its_files(spark, tmp_path):
    r = random.Random(8)
    data = [(r.choice([None, "a", "b", "é"]), i) for i in range(5_000)]
    r.shuffle(data)
    df = spark.createDataFrame(data, "k string, v long").repartition(7)
    export_csv(df, ["k", "v"], str(tmp_path / "out"))
    back = read_export(spark, str(tmp_path / "out"), "k string, v long")
    got = [(x.k, x.v) for x in sorted(back.collect(), key=lambda x: x.row_number)]
    assert got == sorted(data, key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert sorted(x.row_number for x in back.collect()) == list(range(1, 5_001))


def test_questions_read_the_listings_once(spark, star):
    d = star["dims"]
    for df in (A.best_worst_population(star["direct"], d["dim_lga"], d["dim_date"]), A.mortgage_coverage(star["direct"], d["dim_lga"], d["dim_date"])):
        scans = [b for b in operators(df) if "Scan parquet" in b and "host_neighbourhood" in b]
        assert len(scans) == 1, scans
    # the bound of the last months prunes the listings' months
    asked = A.best_worst_population(star["direct"], d["dim_lga"], d["dim_date"])
    scans = [b for b in operators(asked) if "Scan parquet" in b and "host_neighbourhood" in b]
    assert "PartitionFilters" in scans[0] and "year_month" in scans[0].split("PartitionFilters")[1].split("]")[0]


def test_approx_median_is_the_discrete_one(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 7), ("c", None)], "g string, v long")
    got = df.groupBy("g").agg(X.approx_median_if(F.lit(True), "v").alias("m"))
    assert {r.g: r.m for r in got.collect()} == {"a": 2, "b": 7, "c": None}
    assert "dm_listing_neighbourhood" in M.LISTING_MARTS and set(SK.SKETCHED) <= set(M.LISTING_MARTS)
