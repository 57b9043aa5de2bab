"""Print the final (post-AQE) physical plan trees of the headline jobs.

    python tools/explain_plans.py [sf_dir]

The staging feeds are stored first so the plans start from Parquet tables, as
in the warehouse. Each job is executed once (``collect``) so the adaptive plan
shown is the one that ran; only the operator tree is printed.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rentmart.plans import adhoc as A  # noqa: E402
from rentmart.plans import dims as D  # noqa: E402
from rentmart.plans import fact as FT  # noqa: E402
from rentmart.plans import marts as M  # noqa: E402
from rentmart.session import build_session, scratch_path  # noqa: E402
from rentmart.sources import testmap  # noqa: E402
from rentmart.sources.tables import Warehouse  # noqa: E402


def tree(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    return "\n".join(line for line in head.splitlines() if line.strip())


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    wh = Warehouse(spark, scratch_path(spark, "plans"), register_views=False)
    st = {n: wh.write(df, "staging", n) for n, df in testmap.staging(spark, sf_dir).items()}
    listings = wh.write(D.load_listings(st["listings"]), "warehouse", "listings", ["year_month"])
    lga = wh.write(D.dim_lga(st["census_1"], st["census_2"], st["lga_code"]), "warehouse", "dim_lga")
    dims = {"dim_lga": lga,
            "dim_suburb": wh.write(D.dim_suburb(st["lga_suburb"], lga), "warehouse", "dim_suburb"),
            "dim_host": wh.write(D.dim_host(listings), "warehouse", "dim_host"),
            "dim_listing": wh.write(D.dim_listing(listings), "warehouse", "dim_listing"),
            "dim_date": wh.write(D.dim_date(listings), "warehouse", "dim_date")}
    star = FT.mart_input_direct(listings, dims["dim_lga"], dims["dim_suburb"])
    jobs = {
        "dm_listing_neighbourhood (M1, direct path)": M.dm_listing_neighbourhood(star),
        "dm_host_neighbourhood (M3, direct path)": M.dm_host_neighbourhood(star),
        "fact (D8)": FT.build_fact(listings, dims),
        "best_listing_type (Q2)": A.best_listing_type(star),
        "dim_listing with range keys (D6 / W1)": D.dim_listing(listings),
    }
    for name, df in jobs.items():
        print(f"### {name}\n")
        print("```")
        print(tree(df))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
