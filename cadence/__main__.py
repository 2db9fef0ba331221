"""``spark-submit -m cadence <mode> ...`` (or ``python -m cadence``).

Modes: ``macro`` / ``market`` load landed payload directories
(``indicator=<name>/*.json`` and ``coin_id=<asset>/*.json``), ``consolidate``
rebuilds the fact table (optionally from ``--start-date``), ``all`` runs the
three in order, ``counts`` writes the table-count CSV.  Table locations live
under ``--tables`` (shared storage on a cluster).
"""

from __future__ import annotations

import argparse
import json
import logging
import os

from cadence.session import build_session


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="cadence")
    ap.add_argument("mode", choices=["macro", "market", "consolidate", "all", "counts",
                                     "bcb", "crypto"],
                    help="bcb / crypto are accepted as the macro / market loads")
    ap.add_argument("--tables", required=True, help="folder holding the stored tables")
    ap.add_argument("--macro-landing", help="landed macro payload folder")
    ap.add_argument("--market-landing", help="landed market payload folder")
    ap.add_argument("--as-of", help="load the extraction window that ends on this day (YYYY-MM-DD)")
    ap.add_argument("--listed", action="store_true",
                    help="load the monitored indicators and assets only")
    ap.add_argument("--start-date", help="consolidate from this day (YYYY-MM-DD)")
    ap.add_argument("--mode-slice", default="reference", choices=["reference", "lookback"])
    ap.add_argument("--validate", default="before", choices=["before", "after", "report"])
    ap.add_argument("--series-bucket", default=None, choices=["year", "month"],
                    help="bucketed per-asset windows for long (intra-day) series")
    ap.add_argument("--master", default=None)
    ap.add_argument("--shuffle-partitions", type=int, default=None,
                    help="initial shuffle partitions (default: the cluster's setting)")
    ap.add_argument("--log-level", default="INFO",
                    choices=["DEBUG", "INFO", "WARNING", "ERROR"])
    args = ap.parse_args(argv)
    args.mode = {"bcb": "macro", "crypto": "market"}.get(args.mode, args.mode)
    logging.basicConfig(level=getattr(logging, args.log_level),
                        format="%(asctime)s - %(name)s - %(levelname)s - %(message)s")

    spark = build_session(args.master, app_name=f"cadence-{args.mode}",
                          shuffle_partitions=args.shuffle_partitions)
    from cadence.plans import jobs
    from cadence.schemas import ASSETS, INDICATORS
    from cadence.sources.payloads import read_macro_payloads, read_market_payloads

    t = args.tables.rstrip("/")
    paths = jobs.Paths(f"{t}/bcb_indicators", f"{t}/crypto_market",
                       f"{t}/daily_consolidated", f"{t}/pipeline_run_log",
                       f"{t}/monthly_states")
    result: dict = {}
    if args.mode in ("macro", "all"):
        result["macro"] = jobs.load_macro(spark, read_macro_payloads(spark, args.macro_landing),
                                        paths, as_of=args.as_of,
                                        indicators=list(INDICATORS) if args.listed else None)
    if args.mode in ("market", "all"):
        result["market"] = jobs.load_market(
            spark, read_market_payloads(spark, args.market_landing), paths, as_of=args.as_of,
            assets=ASSETS if args.listed else None)
    if args.mode in ("consolidate", "all"):
        result["consolidated"] = jobs.run_consolidation(
            spark, paths, args.start_date, mode=args.mode_slice, validate_when=args.validate,
            series_bucket=args.series_bucket)
    if args.mode == "counts":
        from cadence.operators.upsert import read_table, table_exists
        from cadence.schemas import CONSOLIDATED, MACRO, MARKET
        from cadence.sources.tables import count_report, write_count_report_csv

        def maybe(path, schema):
            return read_table(spark, path, schema) if table_exists(spark, path) else None
        report = count_report({"bcb_indicators": maybe(paths.macro, MACRO),
                               "crypto_market": maybe(paths.market, MARKET),
                               "daily_consolidated": maybe(paths.consolidated, CONSOLIDATED)})
        write_count_report_csv(report, f"{t}/reports/db_counts")
        result = {r.table_name: r.row_count for r in report.collect()}
    print(json.dumps(result))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
