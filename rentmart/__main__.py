"""Command line: the full rebuild, one incremental refresh, mart exports.

    python -m rentmart rebuild --feeds <root> --target <warehouse> [--export <dir>] [--lean]
    python -m rentmart refresh --feeds <root> --target <warehouse> [--export <dir>]
    python -m rentmart truncate --target <warehouse>

``--feeds`` is a folder with one sub-folder per feed: ``listings``, ``census_1``,
``census_2``, ``lga_code``, ``lga_suburb``. For ``refresh`` the ``listings``
sub-folder is the drop folder the stream watches; the reference feeds are
loaded on the first run. The session comes from ``spark-submit`` settings
(``spark.checkpoint.dir`` must name a shared folder off ``local``).
"""

from __future__ import annotations

import argparse
import sys

from rentmart.plans.marts import MART_ORDER
from rentmart.plans.pipeline import STAGING_TABLES, register_catalog, run_pipeline, truncate_all
from rentmart.session import build_session
from rentmart.sources import csv_feed
from rentmart.sources.tables import Warehouse, export_csv
from rentmart.streaming.incremental import IncrementalMarts


def _feed_dirs(root: str) -> dict[str, str]:
    return {name: f"{root.rstrip('/')}/{name}" for name in STAGING_TABLES}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="rentmart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    rb = sub.add_parser("rebuild", help="rebuild every layer from the CSV feeds")
    rb.add_argument("--feeds", required=True)
    rb.add_argument("--target", required=True)
    rb.add_argument("--export", help="folder for the ordered mart CSV exports")
    rb.add_argument("--divisor", choices=["active", "all"], default="active")
    rb.add_argument("--catalog-prefix", help="also register <prefix><layer>.<table> in the catalog")
    rb.add_argument("--on-error", choices=["raise", "null", "reject"], default="raise",
                    help="a bad CSV field value fails the run, loads as NULL, or sets its row aside (staging.<feed>_rows)")
    rb.add_argument("--null-safe", action="store_true", help="NULL parts of the fact's keys match NULL parts")
    rb.add_argument("--lean", action="store_true",
                    help="do not store the staging copy of the feeds (one write of the listings)")
    rf = sub.add_parser("refresh", help="take new listing files once and refresh the touched months")
    rf.add_argument("--feeds", required=True)
    rf.add_argument("--target", required=True)
    rf.add_argument("--export", help="folder for the ordered mart CSV exports after the refresh")
    rf.add_argument("--divisor", choices=["active", "all"], help="for a new warehouse; else the one it was built with")
    rf.add_argument("--on-error", choices=["raise", "null"], default="raise")
    rf.add_argument("--null-safe", action="store_true", default=None, help="for a new warehouse; else as it was built")
    tr = sub.add_parser("truncate", help="empty every table, keeping schemas")
    tr.add_argument("--target", required=True)
    args = ap.parse_args(argv)

    spark = build_session()
    if args.cmd == "rebuild":
        run_pipeline(spark, args.target, feed_dirs=_feed_dirs(args.feeds), export_dir=args.export,
                     property_divisor=args.divisor, write_staging=not args.lean, on_error=args.on_error,
                     null_safe=args.null_safe)
        if args.catalog_prefix is not None:
            register_catalog(spark, args.target, args.catalog_prefix)
    elif args.cmd == "refresh":
        feeds = _feed_dirs(args.feeds)
        inc = IncrementalMarts(spark, feeds["listings"], args.target, property_divisor=args.divisor, on_error=args.on_error,
                               null_safe=args.null_safe)
        wh = Warehouse(spark, args.target)
        if not wh.exists("warehouse", "dim_lga") or wh.read("warehouse", "dim_lga").isEmpty():
            inc.bootstrap({n: csv_feed.read_feed(spark, p, n) for n, p in feeds.items() if n != "listings"})
        inc.run_once()
        if args.export:
            for name, order in MART_ORDER.items():
                export_csv(inc.mart(name), order, f"{args.export.rstrip('/')}/{name}")
    elif args.cmd == "truncate":
        truncate_all(spark, args.target)
    return 0


if __name__ == "__main__":
    sys.exit(main())
