"""Command line: python -m folioflow run --input TABLES --output FOLDER; query NAME --input TABLES; list."""

from __future__ import annotations

import argparse
import importlib

from folioflow.session import build_session

PLANS = ("records", "documents", "answers", "sources")


def all_queries() -> dict:
    """The queries of the plans by name."""
    return {n: q for p in PLANS for n, q in importlib.import_module(f"folioflow.plans.{p}").QUERIES.items()}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="folioflow", description=__doc__)
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="build and write all tables and metrics")
    run.add_argument("--input", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--gold-dir", help="folder of gold files to compare with")
    query = sub.add_parser("query", help="show or write the result of one query")
    query.add_argument("name")
    query.add_argument("--input", required=True)
    query.add_argument("--output")
    query.add_argument("--document-id", help="only rows of this document, where the result has the column")
    sub.add_parser("list", help="names of the queries")
    args = parser.parse_args(argv)
    if args.command == "list":
        for name, q in all_queries().items():
            print(f"{name}: {(q.__doc__ or '').strip()}")
        return 0
    spark = build_session()
    if args.command == "run":
        from folioflow.plans import pipeline

        failed = pipeline.run(spark, args.input, args.output, gold_folder=args.gold_dir)
        for name, error in failed.items():
            print(f"metric {name} failed: {error}")
        return int(bool(failed))
    known = all_queries()
    if args.name not in known:
        parser.error(f"no query is named {args.name}")
    df = known[args.name](spark, args.input)
    if args.document_id is not None and "document_id" in df.columns:
        df = df.filter(df.document_id == args.document_id)
    if args.output:
        df.write.mode("overwrite").parquet(args.output)
    else:
        df.show(50, truncate=80)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
