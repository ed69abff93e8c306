"""Command line: run the pipeline, or ask the gold tables the standard questions.

    python -m billow run --root <layers folder> [--raw <raw csv folder>] [--database gold]
                         [--pre-checks] [--no-gate]
    python -m billow query [--database gold | --root <layers folder>] [--rows 10]

``run`` ingests every ``*.csv`` of the raw folder, cleans, checks, and writes
the gold tables; it prints the run report (rows ingested, rows dropped per
step, quality checks) and exits with status 1 when the quality gate fails.
``query`` prints a sample of the profitability fact and the churn summary,
from the catalog (a shared metastore) or, with ``--root``, straight from the
gold folder of a run.
"""

from __future__ import annotations

import argparse
import sys

from billow.session import build_session


def _run(args: argparse.Namespace) -> int:
    from billow.plans.pipeline import run_pipeline, steps_frame
    from billow.plans.quality import DataQualityError
    from billow.sources.layers import Layers

    spark = build_session(app_name="billow-run")
    layers = Layers(args.root, raw_dir=args.raw)
    try:
        result = run_pipeline(spark, layers, database=args.database, pre_checks=args.pre_checks,
                              post_gate=not args.no_gate, size_session=True,
                              multiline=False if args.no_line_breaks else None,
                              start_at=args.start_at, export_csv=args.export_csv)
    except DataQualityError as exc:
        print(f"stopped: {exc}", file=sys.stderr)
        return 1
    print("ingested:", result.ingested)
    for w in result.warnings:
        print("warning:", w)
    for name, n in result.malformed.items():
        if n:
            print(f"warning: {name}: {n} records with more fields than the header, in quarantine")
    for name, layer, column, n in result.losses:
        if n:
            print(f"warning: {name}.{column}: {n} values became null in {layer}")
    steps_frame(spark, result).show(100, truncate=False)
    result.dq.show(200, truncate=False)
    print("gold tables:", ", ".join(result.gold.values()))
    if args.query:
        _show_gold(spark, args.database, 10)
    return 0


def _show_gold(spark, database: str, rows: int) -> None:
    from billow.plans.analytics import gold_question, sample_rows
    print("Sample profitability:")
    sample_rows(spark, f"{database}.fct_profitability",
                ["subscription_id", "month", "sales_amount", "cost_amount", "profit"],
                ["subscription_id", "month"], rows).show(rows, truncate=False)
    print("Churn summary:")
    gold_question(spark, "churn_summary", database).show(truncate=False)


def _query(args: argparse.Namespace) -> int:
    spark = build_session(app_name="billow-query")
    database = args.database
    if args.root:
        # read the gold tables from the layer folder (no shared metastore needed)
        from billow.sources.layers import Layers, read_layer
        gold = Layers(args.root).gold
        for name in ("dim_customer", "dim_subscription", "fct_sales", "fct_profitability", "fct_churn"):
            df = read_layer(spark, f"{gold}/{name}")
            if df is not None:
                df.createOrReplaceGlobalTempView(name)
        database = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    _show_gold(spark, database, args.rows)
    return 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m billow")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="raw CSV -> bronze -> silver -> quality gate -> gold")
    run.add_argument("--root", required=True, help="folder for the bronze/silver/gold layers")
    run.add_argument("--raw", default=None, help="raw CSV folder (default: <root>/raw)")
    run.add_argument("--database", default="gold")
    run.add_argument("--pre-checks", action="store_true", help="also check raw against bronze")
    run.add_argument("--no-gate", action="store_true", help="write gold even if a check fails")
    run.add_argument("--query", action="store_true", help="print the gold sample and churn summary")
    run.add_argument("--no-line-breaks", action="store_true", help="no quoted CSV field holds a line break: skip the pass that looks for them")
    run.add_argument("--export-csv", action="store_true", help="also write the gold tables as CSV")
    run.add_argument("--start-at", default="ingest", choices=("ingest", "transform", "model"),
                     help="restart from the bronze (transform) or silver (model) layer of a previous run")
    run.set_defaults(fn=_run)
    query = sub.add_parser("query", help="sample profitability and churn summary from gold")
    query.add_argument("--database", default="gold")
    query.add_argument("--root", default=None, help="read gold from this layers folder instead of the catalog")
    query.add_argument("--rows", type=int, default=10)
    query.set_defaults(fn=_query)
    args = parser.parse_args(argv)
    return args.fn(args)


if __name__ == "__main__":
    sys.exit(main())
