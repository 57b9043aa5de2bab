"""Shuffle volume per job, read from Spark's event log.

    python tools/shuffle_report.py [sf_dir]

Runs the headline jobs (and the single-aggregate form of the listing KPIs for
comparison) with the event log written to a fresh scratch folder, then sums the
task metrics of every job by its description: input bytes, shuffle bytes and
records written. Prints one markdown table.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rentmart.functions import expr as X  # noqa: E402
from rentmart.plans import dims as D  # noqa: E402
from rentmart.plans import fact as FT  # noqa: E402
from rentmart.plans import marts as M  # noqa: E402
from rentmart.session import build_session, scratch_path  # noqa: E402
from rentmart.sources import testmap  # noqa: E402
from rentmart.sources.tables import Warehouse  # noqa: E402


def single_aggregate_base(star, keys):
    """The listing KPIs as one aggregate with two DISTINCT counts (the warehouse's form)."""
    a = F.col("has_availability")
    return star.groupBy(*keys, "year_month").agg(
        X.count_if(a), X.count_if(~a), X.count_if(a.isNotNull()), F.count(F.lit(1)),
        X.min_if(a, "price"), X.max_if(a, "price"), X.median_if(a, "price"),
        F.count_distinct("host_orig_id"), X.count_distinct_if("host_is_superhost", "host_orig_id"),
        X.avg_if(a, "review_scores_rating"), X.sum_if(a, "stays"), F.sum("revenue"))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="rentmart-eventlog-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    sc = spark.sparkContext
    wh = Warehouse(spark, scratch_path(spark, "shuffle"), register_views=False)
    st = {n: wh.write(df, "staging", n) for n, df in testmap.staging(spark, sf_dir).items()}
    listings = D.load_listings(st["listings"])
    lga = wh.write(D.dim_lga(st["census_1"], st["census_2"], st["lga_code"]), "warehouse", "dim_lga")
    suburb = wh.write(D.dim_suburb(st["lga_suburb"], lga), "warehouse", "dim_suburb")
    dims = {"dim_lga": lga, "dim_suburb": suburb,
            "dim_host": wh.write(D.dim_host(listings), "warehouse", "dim_host"),
            "dim_listing": wh.write(D.dim_listing(listings), "warehouse", "dim_listing"),
            "dim_date": wh.write(D.dim_date(listings), "warehouse", "dim_date")}
    star = FT.mart_input_direct(listings, lga, suburb)
    fact = wh.write(FT.build_fact(listings, dims), "warehouse", "fact")
    jobs = {
        "M2 base, one aggregate with 2 DISTINCT (Expand)": single_aggregate_base(star, M.PROPERTY_KEYS),
        "M2 base, two-level + histogram median": M.listing_kpi_base(star, M.PROPERTY_KEYS),
        "M1 base, one aggregate with 2 DISTINCT (Expand)": single_aggregate_base(star, ["listing_neighbourhood"]),
        "M1 base, two-level + histogram median": M.listing_kpi_base(star, ["listing_neighbourhood"]),
        "M1 through the star join (fact + dims)": M.dm_listing_neighbourhood(FT.star_view(fact, dims)),
        "M1 direct path": M.dm_listing_neighbourhood(star),
        "M3 direct path": M.dm_host_neighbourhood(star),
        "fact build": FT.build_fact(listings, dims),
        "dim_listing, range keys": D.dim_listing(listings),
    }
    for name, df in jobs.items():
        sc.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
        sc.setJobDescription(None)
    spark.stop()

    desc_of_job, job_of_stage = {}, {}
    totals: dict[str, list[int]] = {}
    # Spark 4 writes one folder per application with rolling event files
    paths = sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p))
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    d = (ev.get("Properties") or {}).get("spark.job.description")
                    desc_of_job[ev["Job ID"]] = d
                    for s in ev.get("Stage IDs", []):
                        job_of_stage[s] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    d = desc_of_job.get(job_of_stage.get(ev.get("Stage ID")))
                    if d not in jobs:
                        continue
                    m = ev.get("Task Metrics") or {}
                    sw = m.get("Shuffle Write Metrics") or {}
                    t = totals.setdefault(d, [0, 0, 0])
                    t[0] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                    t[1] += sw.get("Shuffle Bytes Written", 0)
                    t[2] += sw.get("Shuffle Records Written", 0)
    print(f"sf_dir={sf_dir}\n")
    print("| job | input MB | shuffle written MB | shuffle records |")
    print("|---|---|---|---|")
    for name in jobs:
        i, b, r = totals.get(name, [0, 0, 0])
        print(f"| {name} | {i / 1e6:.1f} | {b / 1e6:.1f} | {r:,} |")


if __name__ == "__main__":
    main()
