"""Command line: ``python -m sheetlake --mode init|daily|run_script``.

Folders and the warehouse are arguments (no environment file); the session
is the one ``spark-submit`` or the local default provides.
"""

from __future__ import annotations

import argparse
import json
import sys

# --- Fixed values: folder routing and 0-based header rows of the exports. ---
TABLE_FOR = {"cancel": "cancellation_bills", "customer": "customer_data", "revenue": "sales_revenue"}
HEADER_ROWS = {"cancellation_bills": 2, "customer_data": 2, "sales_revenue": 3}
# -------------------------------------------------------------------------------


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="sheetlake", description="report folders as Spark tables")
    p.add_argument("--mode", choices=["init", "daily", "run_script"], required=True)
    p.add_argument("--warehouse", required=True, help="root folder of the stored tables")
    p.add_argument("--cancel-dir", help="folder of cancelled-bill exports")
    p.add_argument("--customer-dir", help="folder of customer exports")
    p.add_argument("--revenue-dir", help="folder of sales exports")
    p.add_argument("--glob", default=None, help="file name pattern (default *.csv or *.xlsx, by --decode)")
    p.add_argument("--decode", default="csv", choices=["csv", "xlsx"])
    p.add_argument("--detect", default="mtime", choices=["mtime", "ledger"],
                   help="daily: how changed files are found")
    p.add_argument("--since", default=None,
                   help="daily: read files modified after this UTC time (ISO), e.g. to redo a failed run")
    p.add_argument("--script-dir", default="script", help="run_script: folder of .sql files")
    p.add_argument("--script", default=None, help="run_script: one .sql file")
    p.add_argument("--out-dir", default="output", help="run_script: output folder")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "xlsx"])
    return p.parse_args(argv)


def folder_map(args: argparse.Namespace) -> dict[str, str]:
    folders = {"cancel": args.cancel_dir, "customer": args.customer_dir, "revenue": args.revenue_dir}
    out = {path: TABLE_FOR[kind] for kind, path in folders.items() if path}
    if not out:
        raise SystemExit("give at least one of --cancel-dir, --customer-dir, --revenue-dir")
    return out


def main(argv: list[str] | None = None, spark=None) -> dict:
    from sheetlake.plans import jobs, storage
    from sheetlake.plans.views import report_views
    from sheetlake.session import get_spark
    from sheetlake.streaming.incremental import daily

    args = parse(argv)
    args.glob = args.glob or f"*.{args.decode}"
    spark = spark or get_spark()
    if args.mode == "init":
        result = jobs.init(spark, folder_map(args), HEADER_ROWS, args.warehouse, args.glob, args.decode)
    elif args.mode == "daily":
        import datetime as dt

        since = dt.datetime.fromisoformat(args.since) if args.since else None
        result = daily(spark, folder_map(args), HEADER_ROWS, args.warehouse, args.glob, args.decode,
                       detect=args.detect, since=since)
    else:
        views = {t: df for t in HEADER_ROWS
                 if (df := storage.read(spark, storage.path(args.warehouse, t))) is not None}
        if len(views) == len(HEADER_ROWS):
            try:
                views.update(report_views(views["sales_revenue"], views["customer_data"],
                                          views["cancellation_bills"]))
            except Exception as e:  # a table without the report columns: base tables only
                print(f"reports not registered: {str(e).splitlines()[0]}", file=sys.stderr)
        result = jobs.run_reports(spark, args.script or args.script_dir, args.out_dir, args.format, views=views)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
