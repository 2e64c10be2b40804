"""Monthly run from the command line.

    spark-submit -m remitview --as-of 2025-03-31 --roles roles.json --out s3://bucket/reports

``roles.json`` maps every input role to a location, e.g.
``{"format": "parquet", "roles": {"claim": "s3://lake/claims", ...}}`` or, for
a JDBC source, ``{"format": "jdbc", "url": "...", "options": {...},
"roles": {"claim": "SCHEMA.TABLE", ...}, "partitioning": {"claim": {...}}}``, or
``{"format": "catalog", "roles": {"claim": "lake.claims", ...}}`` for catalog tables.
Credentials belong in ``options`` supplied by the deployment, never in code.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from remitview.config import ReportConfig
from remitview.operators.history_filter import HistoryFilter
from remitview.plans.run import run_month
from remitview.session import configure
from remitview.sources.layout import load_catalog_tables
from remitview.sources.tables import load_jdbc_tables, load_tables, padded_columns


def main(argv=None) -> dict:
    p = argparse.ArgumentParser(prog="remitview", description=__doc__.split("\n")[0])
    p.add_argument("--as-of", default=dt.date.today().isoformat(), help="run date; reports the month before it")
    p.add_argument("--roles", required=True, help="JSON file binding input roles to locations")
    p.add_argument("--out", required=True, help="output root (any Spark path)")
    p.add_argument("--format", choices=("csv", "text", "display", "delivery"), default="csv")
    p.add_argument("--case-insensitive-codes", action="store_true")
    p.add_argument("--time-zone", default="UTC", help="zone in which a remit time falls on a day")
    p.add_argument(
        "--blank-padded", action=argparse.BooleanOptionalAction, default=None,
        help="compare all text without trailing blanks (default: for JDBC sources only)",
    )
    p.add_argument("--extract-names", help='JSON file of text extract names, {"open_ffs": "name.{d}.txt", ...}')
    p.add_argument("--code-order", default="binary", help="order of text codes in the source: binary, or a code page such as cp037")
    p.add_argument("--colocated", action="store_true", help="the histories are bucketed by their join keys")
    p.add_argument("--rows-per-file", type=int, default=1_000_000, help="rows in a file of --format delivery")
    p.add_argument("--filter-mb", type=int, default=HistoryFilter.max_mb, help="largest filter of claim keys on the histories; 0 for none")
    p.add_argument("--single-file", action="store_true", help="one file per extract (one writer task each)")
    args = p.parse_args(argv)

    with open(args.roles) as f:
        spec = json.load(f)
    names = None
    if args.extract_names:
        with open(args.extract_names) as f:
            names = {tuple(k.split("_", 1)): v for k, v in json.load(f).items()}
    spark = configure(SparkSession.builder.appName("remitview-monthly").getOrCreate(), args.time_zone)
    if spec.get("format") == "jdbc":
        tables = load_jdbc_tables(spark, spec["url"], spec["roles"], spec.get("options"), spec.get("partitioning"))
    elif spec.get("format") == "catalog":
        tables = load_catalog_tables(spark, spec["roles"])
    else:
        tables = load_tables(spark, spec["roles"], spec.get("format", "parquet"), spec.get("options"))
    padded = spec.get("format") == "jdbc" if args.blank_padded is None else args.blank_padded
    cfg = ReportConfig(
        case_sensitive_codes=not args.case_insensitive_codes, blank_padded=padded, padded_columns=padded_columns(tables),
        code_order=args.code_order, colocated=args.colocated,
    )
    limits = HistoryFilter(max_mb=args.filter_mb) if args.filter_mb else None
    return run_month(spark, tables, args.as_of, args.out, cfg, args.format, args.single_file, names, limits, args.rows_per_file)


if __name__ == "__main__":
    print(json.dumps(main()))
