"""Versions behind a manifest, truncate, file registration, buckets and the month index."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import LISTINGS, LISTINGS_HEADER, write_fixture
from helpers import SF_SMALL, rows
from rentmart.plans import dims as D
from rentmart.plans import marts as M
from rentmart.plans import pipeline as P
from rentmart.session import scratch_path
from rentmart.sources import csv_feed, files, testmap
from rentmart.sources.tables import Warehouse
from rentmart.streaming import incremental as I
from test_plans import plan

MARTS = P.MART_TABLES


def test_a_table_is_switched_whole(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), register_views=False)
    assert wh.path("datamart", "t") is None and not wh.exists("datamart", "t")
    wh.write(spark.range(3), "datamart", "t")
    old = wh.read("datamart", "t")
    wh.write(spark.range(5), "datamart", "t")
    assert wh.read("datamart", "t").count() == 5 and old.count() == 3      # a reader keeps its version
    with pytest.raises(RuntimeError):
        with wh.rebuild():
            wh.write(spark.range(7), "datamart", "t")
            wh.note(color="red")
            assert wh.read("datamart", "t").count() == 7                   # inside, the new one
            raise RuntimeError
    assert wh.read("datamart", "t").count() == 5 and wh.noted("color") is None
    with wh.rebuild():
        wh.write(spark.range(7), "datamart", "t")
        wh.note(color="red")
    other = Warehouse(spark, str(tmp_path / "wh"), register_views=False)
    assert other.read("datamart", "t").count() == 7 and other.noted("color") == "red"


def test_two_writers_keep_each_others_tables(spark, tmp_path):
    a, b = (Warehouse(spark, str(tmp_path / "wh"), register_views=False) for _ in range(2))
    with a.rebuild():
        a.write(spark.range(1), "staging", "x")
        b.write(spark.range(2), "staging", "y")
    assert {n: b.read("staging", n).count() for n in "xy"} == {"x": 1, "y": 2}


def test_vacuum_removes_what_only_old_manifests_name(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), register_views=False)
    paths = []
    for n in range(4):
        wh.write(spark.range(n + 1), "staging", "x")
        paths.append(wh.path("staging", "x"))
    wh.write(spark.range(9), "staging", "y")
    wh.vacuum(keep=1)
    assert [bool(files.names(spark, p)) for p in paths] == [False, False, False, True]
    assert wh.read("staging", "x").count() == 4 and wh.read("staging", "y").count() == 9


def test_partitions_are_not_written_beside_a_truncated_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), register_views=False)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v long, k string")
    wh.write(df, "warehouse", "t", ["k"])
    wh.truncate("warehouse", "t")
    empty = wh.read("warehouse", "t")
    assert empty.count() == 0 and sorted(empty.columns) == ["k", "v"]
    wh.write(df.filter("k = 'a'"), "warehouse", "t", ["k"], "partitions")
    wh.write(spark.createDataFrame([(3, "c"), (4, "a")], "v long, k string"), "warehouse", "t", ["k"], "partitions")
    assert rows(wh.read("warehouse", "t"), ["v", "k"]) == [(3, "c"), (4, "a")]


def test_a_rebuild_that_fails_leaves_the_old_marts(spark, tmp_path, monkeypatch):
    paths = write_fixture(str(tmp_path / "feeds"))
    target = str(tmp_path / "wh")
    P.run_pipeline(spark, target, feed_dirs=paths)
    wh = Warehouse(spark, target, register_views=False)
    before = {n: rows(wh.read("datamart", n)) for n in MARTS}
    noted = wh.noted("stream")
    (tmp_path / "feeds" / "listings" / "more.csv").write_text(LISTINGS_HEADER + "\n" + LISTINGS[0] + "\n")

    def dies(*args, **kwargs):
        raise RuntimeError("killed between the layers")

    for module, name in ((M, "dm_host_neighbourhood"), (D, "dim_suburb")):
        with monkeypatch.context() as m:
            m.setattr(module, name, dies)
            with pytest.raises(RuntimeError):
                P.run_pipeline(spark, target, feed_dirs=paths)
        assert {n: rows(wh.read("datamart", n)) for n in MARTS} == before
        assert wh.read("warehouse", "fact").count() == 8 and wh.noted("stream") == noted
    P.run_pipeline(spark, target, feed_dirs=paths)
    assert wh.read("warehouse", "listings").count() == 10


def _taken_rows(monkeypatch, inc):
    """Rows that reach the batches of a refresh."""
    seen = []
    apply = inc._apply_batch
    monkeypatch.setattr(inc, "_apply_batch", lambda batch, epoch: (seen.append(batch.count()), apply(batch, epoch)))
    return seen


def test_refresh_after_a_rebuild_takes_new_files_only(spark, tmp_path, monkeypatch):
    paths = write_fixture(str(tmp_path / "feeds"))
    target, drops = str(tmp_path / "wh"), tmp_path / "feeds" / "listings"
    register = P.register_files

    def late_file(spark_, source, checkpoint):
        # a file that comes between the registration and the load: loaded, not registered
        since = register(spark_, source, checkpoint)
        (drops / "late.csv").write_text(LISTINGS_HEADER + "\n" + LISTINGS[1] + "\n")
        return since

    with monkeypatch.context() as m:
        m.setattr(P, "register_files", late_file)
        P.run_pipeline(spark, target, feed_dirs=paths)
    wh = Warehouse(spark, target, register_views=False)
    assert wh.read("warehouse", "listings").count() == 10
    assert [r.path.rsplit("/", 1)[1] for r in wh.read("warehouse", "taken_files").collect()] == ["late.csv"]
    inc = I.IncrementalMarts(spark, paths["listings"], target)
    seen = _taken_rows(monkeypatch, inc)
    inc.run_once()
    assert sum(seen) == 0 and wh.read("warehouse", "listings").count() == 10
    (drops / "deep").mkdir()
    (drops / "deep" / "new file.csv").write_text("\n".join([LISTINGS_HEADER, *LISTINGS[:2]]) + "\n")
    inc.run_once()
    inc.run_once()
    assert sum(seen) == 2 and wh.read("warehouse", "listings").count() == 12
    fresh = {n: rows(df) for n, df in P.run_pipeline(spark, str(tmp_path / "fresh"), feed_dirs=paths).items()}
    assert {n: rows(inc.mart(n).select(*Warehouse(spark, str(tmp_path / "fresh")).read("datamart", n).columns)) for n in MARTS} == fresh


def test_truncate_then_refresh_loads_everything(spark, tmp_path):
    paths = write_fixture(str(tmp_path / "feeds"))
    target = str(tmp_path / "wh")
    before = {n: rows(df) for n, df in P.run_pipeline(spark, target, feed_dirs=paths, property_divisor="all").items()}
    P.truncate_all(spark, target)
    wh = Warehouse(spark, target, register_views=False)
    assert all(wh.read("datamart", n).count() == 0 for n in MARTS)
    inc = I.IncrementalMarts(spark, paths["listings"], target)
    assert inc.divisor == "all"
    inc.bootstrap({n: csv_feed.read_feed(spark, p, n) for n, p in paths.items() if n != "listings"})
    inc.run_once()
    assert {n: rows(inc.mart(n).select(*inc.mart(n).columns)) for n in MARTS} == {
        n: sorted(r, key=lambda t: tuple((x is None, str(x)) for x in t)) for n, r in before.items()}
    host = wh.read("warehouse", "dim_host")
    assert sorted(r[0] for r in host.select("hosts_id").collect()) == list(range(1, host.count() + 1))


@pytest.fixture(scope="module")
def bucketed(spark):
    """A warehouse whose dimensions have many buckets, refreshed with one small drop."""
    root = scratch_path(spark, "buckets")
    st = testmap.staging(spark, SF_SMALL)
    feeds = {n: f"{root}/feeds/{n}" for n in st}
    salt = F.xxhash64("host_id", "listing_id", "scraped_date")
    late = F.col("scraped_date") >= F.lit("1998-07-01").cast("date")
    for n, df in st.items():
        csv_feed.write_feed(df.filter(~late) if n == "listings" else df, n, f"{feeds[n]}/first", salt=salt if n == "listings" else None)
    size = D.BUCKET_ROWS
    D.BUCKET_ROWS = 50
    try:
        P.run_pipeline(spark, f"{root}/wh", feed_dirs=feeds)
    finally:
        D.BUCKET_ROWS = size
    inc = I.IncrementalMarts(spark, feeds["listings"], f"{root}/wh")
    few = st["listings"].filter(late).filter("listing_id % 50 = 1")
    before = inc.wh.noted("dim_listing.next_id")
    csv_feed.write_feed(few, "listings", f"{feeds['listings']}/drop", salt=salt)
    inc.run_once()
    return {"inc": inc, "before": before, "few": few, "all": st["listings"].filter(~late).unionByName(few), "st": st}


def test_a_batch_reads_its_own_buckets(spark, bucketed):
    inc = bucketed["inc"]
    n = inc._buckets("dim_listing")
    assert n > 30
    dim = inc._own_buckets("dim_listing", D.listing_tuples(D.load_listings(bucketed["few"])), "list_orig_id")
    need = D.in_buckets(D.listing_tuples(bucketed["few"]), "dim_listing", n).select(D.BUCKET).distinct().count()
    assert need < n and dim.select(D.BUCKET).distinct().count() <= need
    text = plan(dim)
    assert "PartitionFilters: [" in text and "bucket" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_appended_ids_go_on_where_the_ledger_says(spark, bucketed):
    inc = bucketed["inc"]
    for name, (key, cols, _) in D.LARGE.items():
        got = inc.wh.read("warehouse", name)
        ids = sorted(r[0] for r in got.select(key).collect())
        assert ids == list(range(1, len(ids) + 1)) and inc.wh.noted(f"{name}.next_id") == len(ids) + 1
        tuples = (D.host_tuples if name == "dim_host" else D.listing_tuples)(bucketed["all"])
        assert rows(got.select(*cols)) == rows(tuples.select(*cols))
    # the first ids are those of the global window
    old = inc.wh.read("warehouse", "dim_listing").filter(F.col("listing_id") < bucketed["before"])
    assert [r.list_orig_id for r in old.orderBy("listing_id").collect()] == sorted(r.list_orig_id for r in old.collect())


def test_refresh_equals_the_marts_of_all_rows(spark, bucketed):
    st = {**bucketed["st"], "listings": bucketed["all"]}
    full = P.run_pipeline(spark, scratch_path(spark, "buckets-full"), staging=st)
    for n, df in full.items():
        assert rows(bucketed["inc"].mart(n).select(*df.columns)) == rows(df), n


def test_kpis_read_the_months_they_need(spark, bucketed):
    inc = bucketed["inc"]
    steps = M.month_steps(inc.wh.read("warehouse", "dm_listing_neighbourhood_months"))
    touched = [dt.date(1998, 7, 1)]
    rewrite, read = I.halo(steps, touched)
    assert touched[0] in rewrite and len(read) <= 6
    near = inc.wh.read("warehouse", "dm_listing_neighbourhood_base").filter(I._in_months(read))
    text = plan(M.listing_kpis(near, ["listing_neighbourhood"], "active").filter(I._in_months(rewrite)))
    assert "PartitionFilters: [" in text and "year_month" in text.split("PartitionFilters: [")[1].split("]")[0]
