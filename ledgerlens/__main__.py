"""Command line: run the seven questions or any catalogue query and show it.

    python -m ledgerlens --csv sales.csv --region "Sub-Saharan Africa"
    python -m ledgerlens --demo
    python -m ledgerlens --tables /root/testdata/sf0.01 --questions
    python -m ledgerlens --tables /root/testdata/sf0.01 --query profit_by_region
    python -m ledgerlens --tables /root/testdata/sf0.01 --query monthly_trend --out /shared/monthly

Results are shown (bounded by ``--rows``) or written as parquet with ``--out``.
"""

from __future__ import annotations

import argparse

from ledgerlens.plans import params as P
from ledgerlens.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ledgerlens")
    src = parser.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="sales CSV (header row, M/d/yyyy dates)")
    src.add_argument("--tables", help="folder with the driver parquet tables")
    src.add_argument("--demo", action="store_true", help="the synthetic demo rows (no file needed)")
    parser.add_argument("--query", help="catalogue query name (with --tables)")
    parser.add_argument("--questions", action="store_true", help="run the seven questions")
    parser.add_argument("--region", default=None, help="region of the weekend question")
    parser.add_argument("--rows", type=int, default=20, help="rows to show per result")
    parser.add_argument("--out", default=None, help="write the result as parquet here")
    parser.add_argument("--master", default=None, help="Spark master (default: launcher's)")
    args = parser.parse_args(argv)

    spark = build_session(args.master)
    if args.query:
        if not args.tables:
            parser.error("--query needs --tables")
        from ledgerlens.plans.catalog import QUERIES
        from ledgerlens.streaming.catalog import STREAM_QUERIES

        catalogue = {**QUERIES, **STREAM_QUERIES}
        if args.query not in catalogue:
            parser.error(f"unknown query {args.query!r}; known: {', '.join(sorted(catalogue))}")
        results = {args.query: catalogue[args.query](spark, args.tables)}
    else:
        from ledgerlens.plans.questions import questions
        from ledgerlens.sources.csv import read_sales_csv
        from ledgerlens.sources.star import sales_fact
        from ledgerlens.sources.synthetic import synthetic_sales

        if args.csv:
            sales = read_sales_csv(spark, args.csv)
            region = args.region or "Sub-Saharan Africa"
        elif args.demo:
            sales = synthetic_sales(spark)
            region = args.region or "Sub-Saharan Africa"
        else:
            sales = sales_fact(spark, args.tables)
            region = args.region or P.WEEKEND_REGION
        results = questions(sales, region)

    for name, df in results.items():
        if args.out:
            from ledgerlens.sources.sinks import write_table

            write_table(df, f"{args.out.rstrip('/')}/{name}")
            print(f"{name}: written to {args.out.rstrip('/')}/{name}")
        else:
            print(f"== {name}")
            df.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
