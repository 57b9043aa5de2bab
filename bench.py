"""Benchmark the warehouse jobs at one scale factor; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

The mapped staging feeds are built from the driver tables and stored once
(timed as ``staging_feeds``); every other job reads those stored tables, as it
would in the warehouse. Each result is forced with a ``noop`` write (full
execution, nothing collected). Jobs:

* dims / fact / the three marts (direct path) / M1 through the star join
* surrogate key over the listing tuples: range partitions vs one-task window
* the four ad-hoc questions
* full rebuild (every layer written) vs a one-month incremental refresh
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rentmart.operators.keys import dense_surrogate_key  # noqa: E402
from rentmart.plans import adhoc as A  # noqa: E402
from rentmart.plans import dims as D  # noqa: E402
from rentmart.plans import fact as FT  # noqa: E402
from rentmart.plans import marts as M  # noqa: E402
from rentmart.plans.concurrent import run_together  # noqa: E402
from rentmart.plans.pipeline import run_pipeline  # noqa: E402
from rentmart.session import build_session, scratch_path  # noqa: E402
from rentmart.sources import csv_feed, testmap  # noqa: E402
from rentmart.sources.tables import Warehouse  # noqa: E402
from rentmart.streaming.incremental import IncrementalMarts  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(cpus=cpus, app="rentmart-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # untimed warm-up on the smallest tables (JIT, class loading, first broadcast)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        w_st = testmap.staging(spark, warm_dir)
        w_li = D.load_listings(w_st["listings"])
        w_lga = D.dim_lga(w_st["census_1"], w_st["census_2"], w_st["lga_code"])
        w_star = FT.mart_input_direct(w_li, w_lga, D.dim_suburb(w_st["lga_suburb"], w_lga))
        run(M.dm_listing_neighbourhood(w_star))
        run(M.dm_host_neighbourhood(w_star))
        run(D.dim_listing(w_li))

    root = scratch_path(spark, "bench")
    wh = Warehouse(spark, f"{root}/stored", register_views=False)

    def store_feeds():
        return {n: wh.write(df, "staging", n) for n, df in testmap.staging(spark, sf_dir).items()}

    st = timed("staging_feeds", store_feeds)
    listings = D.load_listings(st["listings"])
    lga = D.dim_lga(st["census_1"], st["census_2"], st["lga_code"])
    suburb = D.dim_suburb(st["lga_suburb"], lga)

    def build_dims():
        # as the rebuild does it: independent dimensions as concurrent jobs
        out = {"dim_lga": lga, "dim_suburb": suburb, "dim_host": D.dim_host(listings),
               "dim_listing": D.dim_listing(listings), "dim_date": D.dim_date(listings)}
        return run_together({n: (lambda n=n, df=df: wh.write(df, "warehouse", n)) for n, df in out.items()}, 4)

    dims = timed("dims", build_dims)
    t = D.listing_tuples(listings)
    timed("surrogate_key_range", lambda: run(dense_surrogate_key(t, D.LISTING_TUPLE, "id", method="range")))
    timed("surrogate_key_window", lambda: run(dense_surrogate_key(t, D.LISTING_TUPLE, "id", method="window")))
    fact = timed("fact", lambda: wh.write(FT.build_fact(listings, dims), "warehouse", "fact"))

    star = FT.mart_input_direct(listings, dims["dim_lga"], dims["dim_suburb"])
    timed("dm_listing_neighbourhood", lambda: run(M.dm_listing_neighbourhood(star)))
    timed("dm_property_type", lambda: run(M.dm_property_type(star)))
    timed("dm_host_neighbourhood", lambda: run(M.dm_host_neighbourhood(star)))
    timed("dm_listing_neighbourhood_star",
          lambda: run(M.dm_listing_neighbourhood(FT.star_view(fact, dims))))
    timed("best_worst_population", lambda: run(A.best_worst_population(star, dims["dim_lga"], dims["dim_date"])))
    timed("best_listing_type", lambda: run(A.best_listing_type(star)))
    timed("multi_host_same_lga", lambda: run(A.multi_host_same_lga(star)))
    timed("mortgage_coverage", lambda: run(A.mortgage_coverage(star, dims["dim_lga"], dims["dim_date"])))

    timed("full_rebuild", lambda: run_pipeline(spark, f"{root}/full", staging=st))

    # incremental: everything but the last month is loaded untimed, then the last month arrives
    last = listings.agg(F.max("year_month")).first()[0]
    inc = IncrementalMarts(spark, f"{root}/source", f"{root}/inc")
    inc.bootstrap(st)
    salt = F.xxhash64("host_id", "listing_id", "scraped_date")
    csv_feed.write_feed(st["listings"].filter(F.trunc("scraped_date", "month") < F.lit(last)),
                        "listings", f"{root}/source/drop_0", salt=salt)
    inc.run_once()
    csv_feed.write_feed(st["listings"].filter(F.trunc("scraped_date", "month") == F.lit(last)),
                        "listings", f"{root}/source/drop_1", salt=salt)
    timed("incremental_one_month", inc.run_once)

    headline = ["dims", "fact", "dm_listing_neighbourhood", "dm_property_type", "dm_host_neighbourhood",
                "best_worst_population", "best_listing_type", "multi_host_same_lga", "mortgage_coverage"]
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "warehouse_jobs_total_sec", "value": round(sum(times[k] for k in headline), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
