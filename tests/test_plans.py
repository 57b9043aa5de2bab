"""Plan properties the scale design relies on, read from ``explain("formatted")``."""
import contextlib
import io

import pytest

from rentmart.plans import adhoc as A
from rentmart.plans import dims as D
from rentmart.plans import fact as FT
from rentmart.plans import marts as M
from rentmart.sources import testmap
from helpers import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The five feeds stored as Parquet, read back like warehouse tables."""
    root = tmp_path_factory.mktemp("stored")
    out = {}
    for name, df in testmap.staging(spark, SF_SMALL).items():
        df.write.parquet(str(root / name))
        out[name] = spark.read.parquet(str(root / name))
    listings = D.load_listings(out["listings"])
    # the rebuild stores the reference dimensions, so Spark knows their sizes
    for name, df in (("lga", lambda: D.dim_lga(out["census_1"], out["census_2"], out["lga_code"])),
                     ("suburb", lambda: D.dim_suburb(out["lga_suburb"], out["lga"]))):
        df().write.parquet(str(root / f"dim_{name}"))
        out[name] = spark.read.parquet(str(root / f"dim_{name}"))
    lga, suburb = out["lga"], out["suburb"]
    return {"listings": listings, "lga": lga, "suburb": suburb,
            "star": FT.mart_input_direct(listings, lga, suburb)}


def listing_scan(p: str) -> str:
    blocks = [b for b in p.split("\n\n") if "Scan parquet" in b and "listing_neighbourhood" in b]
    assert blocks, p
    return blocks[0]


def test_marts_have_no_expand_and_read_pruned_filtered_listings(stored):
    for df in (M.dm_listing_neighbourhood(stored["star"]), M.dm_property_type(stored["star"]),
               M.dm_host_neighbourhood(stored["star"])):
        p = plan(df)
        assert "Expand" not in p                      # no row triplication for DISTINCT counts
        scan = listing_scan(p)
        assert "LessThan(price,2000)" in scan          # the price cap reaches the Parquet reader
        assert "review_scores_accuracy" not in scan    # unused columns are not read


def test_reference_dimensions_are_broadcast(stored):
    p = plan(M.dm_listing_neighbourhood(stored["star"]))
    assert p.count("BroadcastHashJoin LeftOuter") >= 2


def test_top_k_is_a_bounded_sort(stored):
    p = plan(A.best_listing_type(stored["star"], 5))
    assert "TakeOrderedAndProject" in p


def test_fact_pushes_price_cap(stored):
    dims = {"dim_lga": stored["lga"], "dim_suburb": stored["suburb"],
            "dim_listing": D.dim_listing(stored["listings"]), "dim_host": D.dim_host(stored["listings"]),
            "dim_date": D.dim_date(stored["listings"])}
    p = plan(FT.build_fact(stored["listings"], dims))
    assert "LessThan(price,2000)" in listing_scan(p)


def test_kpi_marts_have_one_aggregate_by_group(stored):
    for df in (M.dm_listing_neighbourhood(stored["star"]), M.dm_property_type(stored["star"])):
        p = plan(df).split("== Initial Plan ==")[-1].split("(1) ")[0]
        assert p.count("Exchange (") - p.count("BroadcastExchange (") <= 5
        assert "SortMergeJoin" not in p


def test_line_items_are_shuffled_narrow_and_never_by_customer(spark):
    """With every table too large to broadcast, orders meet customers first, and no raw measure goes through a shuffle."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(testmap.listings(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    nodes = [n for n in text.split("\n\n") if ") Exchange" in n.strip().split("\n")[0]]
    by_customer = [n for n in nodes if "hashpartitioning(o_custkey" in n]
    assert by_customer and all("l_orderkey" not in n for n in by_customer)
    assert nodes and not any(c in n for n in nodes for c in ("l_extendedprice", "l_discount", "l_tax", "l_shipdate"))
