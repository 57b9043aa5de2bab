"""Large listings: steps over them in slices, whose rows are those of the steps at once; old folders go after a truncate."""
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from rentmart.plans import dims as D
from rentmart.plans import fact as FT
from rentmart.plans.concurrent import run_together
from rentmart.plans.pipeline import build_marts, run_pipeline, truncate_all
from rentmart.registry import QUERIES
from rentmart.session import scratch_path
from rentmart.sources import csv_feed, files, slices, testmap
from rentmart.sources.tables import Warehouse
from rentmart.streaming.incremental import IncrementalMarts
from test_plans import plan


@pytest.fixture
def large(monkeypatch):
    """Every table counts as large; tells how many slices of each table were written."""
    monkeypatch.setattr(slices, "SLICE_BYTES", 20_000)
    monkeypatch.setattr(slices, "MOST_SLICES", 2)
    put, told = Warehouse.put, {}

    def spied(self, df, layer, name, *a, **b):
        told[f"{layer}/{name}"] = len(df) if isinstance(df, list) else 1
        return put(self, df, layer, name, *a, **b)

    monkeypatch.setattr(Warehouse, "put", spied)
    return told


SLICED = ["warehouse/listings", "warehouse/fact", "warehouse/dm_listing_neighbourhood_base", "warehouse/dm_property_type_base",
          "warehouse/dm_listing_neighbourhood_sketch", "datamart/dm_host_neighbourhood"]


def _staging(spark):
    """The feeds, with rows that have no date, some of them twice."""
    st = testmap.staging(spark, SF_SMALL)
    undated = st["listings"].filter("listing_id % 50 = 0").withColumn("scraped_date", F.lit(None).cast("date"))
    return {**st, "listings": st["listings"].unionByName(undated).unionByName(undated)}


def _whole(st):
    """The marts and the star of all listings, as one plan each."""
    lga = D.dim_lga(st["census_1"], st["census_2"], st["lga_code"])
    suburb = D.dim_suburb(st["lga_suburb"], lga)
    listings = D.load_listings(st["listings"])
    return build_marts(listings, lga, suburb), FT.mart_input_direct(listings, lga, suburb)


def _same_as_whole(spark, wh: Warehouse, st) -> None:
    marts, direct = _whole(st)
    for name, df in marts.items():
        assert rows(wh.read("datamart", name).select(*df.columns)) == rows(df), name
    dims = {n: wh.read("warehouse", n) for n in ["dim_lga", "dim_suburb", "dim_host", "dim_listing", "dim_date"]}
    star = FT.star_view(wh.read("warehouse", "fact"), dims)
    assert rows(star) == rows(direct.select(*star.columns))


def test_rebuild_in_slices(spark, large):
    root = scratch_path(spark, "slices-rebuild")
    st = _staging(spark)
    run_pipeline(spark, root, staging=st)
    assert {n: large[n] for n in SLICED} == dict.fromkeys(SLICED, 2)
    _same_as_whole(spark, Warehouse(spark, root, register_views=False), st)


def test_refresh_in_slices(spark, large):
    root = scratch_path(spark, "slices-refresh")
    st = _staging(spark)
    inc = IncrementalMarts(spark, f"{root}/source", f"{root}/inc")
    inc.bootstrap(st)
    late = F.coalesce(F.col("scraped_date") >= dt.date(1996, 6, 15), F.lit(True))
    for i, cond in enumerate([~late, late]):
        csv_feed.write_feed(st["listings"].filter(cond), "listings", f"{root}/source/drop_{i}",
                            salt=F.xxhash64("host_id", "listing_id", "scraped_date"), key="host_id")
        inc.run_once()
    assert {n: large[n] for n in SLICED} == dict.fromkeys(SLICED, 2)
    assert files.names(spark, f"{root}/inc/_batches") == []
    _same_as_whole(spark, inc.wh, st)


def test_feed_in_slices(spark, large, tmp_path):
    li = _staging(spark)["listings"]
    li = li.unionByName(li.limit(20).withColumn("host_id", F.lit(None).cast("bigint")))
    for name, key in (("whole", None), ("sliced", "host_id")):
        csv_feed.write_feed(li, "listings", f"{tmp_path}/{name}", salt=F.xxhash64("host_id", "listing_id"), key=key)
    whole, sliced = (csv_feed.read_raw(spark, f"{tmp_path}/{n}", "listings") for n in ("whole", "sliced"))
    assert rows(whole) == rows(sliced) and whole.count() == li.count()


def test_old_rows_go_when_a_refresh_starts_anew(spark):
    root = scratch_path(spark, "slices-truncate")
    st = testmap.staging(spark, SF_SMALL)
    run_pipeline(spark, root, staging=st)
    wh = Warehouse(spark, root, register_views=False)
    old = [wh.path("warehouse", n) for n in ("listings", "fact", "dim_host")] + [wh.path("staging", "listings")]
    truncate_all(spark, root)
    assert all(files.names(spark, p) for p in old)
    IncrementalMarts(spark, f"{root}/source", root).bootstrap(st)
    assert not any(files.names(spark, p) for p in old)
    assert wh.read("warehouse", "listings").count() == 0 and wh.read("warehouse", "dim_lga").count() == 25


def test_star_is_stored_in_slices(spark, large):
    df = QUERIES["dm_listing_neighbourhood_star"](spark, SF_SMALL)
    assert "lineitem" not in plan(df)       # the joins of the fact are behind, their shuffles gone
    assert (large["warehouse/listings"], large["warehouse/fact"]) == (2, 2)


def test_a_step_is_cleared_when_it_is_done():
    told, lock = [], threading.Lock()

    def step(i):
        with lock:
            told.append(i)
        return i

    steps = {str(i): (lambda i=i: step(i)) for i in range(4)}
    assert run_together(steps, 1, lambda: told.append("gone")) == {str(i): i for i in range(4)}
    assert told == [0, "gone", 1, "gone", 2, "gone", 3, "gone"]
    assert run_together(steps, 2, lambda: step("gone")) == {str(i): i for i in range(4)}
    assert told.count("gone") == 8


def test_slices_hold_every_row_once(spark):
    df = spark.createDataFrame([(i, dt.date(1990 + i % 3, 1 + i % 12, 1) if i % 7 else None) for i in range(200)],
                               "k bigint, year_month date")
    for parts in (slices.by_month(df, 5), slices.by_key(df, 5, "year_month"), slices.by_key(df, 1, "k")):
        held = [{r["year_month"] for r in p.select("year_month").distinct().collect()} for p in parts]
        assert sum(map(len, held)) == len(set.union(*held))
        assert sorted(r["k"] for p in parts for r in p.collect()) == list(range(200))
    assert [slices.slice_count(x) for x in (None, 0, 1, slices.SLICE_BYTES, slices.SLICE_BYTES + 1, 1 << 50)] == \
        [1, 1, 1, 1, 2, slices.MOST_SLICES]
