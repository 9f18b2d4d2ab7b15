"""spark-submit entry: run a pipeline, or list and restore versions of a table."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from martloom.operators import versions
from martloom.plans import pipeline
from martloom.session import get_spark


def print_all(rows: DataFrame) -> None:
    """Every row on a line of its own, one partition at a time."""
    print(*rows.columns, sep="\t")
    for row in rows.toLocalIterator():
        print(*row, sep="\t")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="martloom")
    actions = parser.add_subparsers(dest="action", required=True)
    retail = actions.add_parser("retail", help="CSV drops and two snapshots to a tested star schema")
    for name in ("landing", "customers", "products", "lake"):
        retail.add_argument(f"--{name}", required=True)
    orders = actions.add_parser("orders", help="change feed to four tested marts")
    for name in ("feed", "landing", "lake"):
        orders.add_argument(f"--{name}", required=True)
    history = actions.add_parser("history", help="versions of a table")
    history.add_argument("table")
    restore = actions.add_parser("restore", help="make an old version current again")
    restore.add_argument("table")
    restore.add_argument("version", type=int)
    args = parser.parse_args(argv)

    spark = get_spark()
    if args.action == "retail":
        customers, products = spark.read.parquet(args.customers), spark.read.parquet(args.products)
        print_all(pipeline.run_retail(spark, args.landing, customers, products, args.lake))
    elif args.action == "orders":
        print_all(pipeline.run_orders(spark, spark.read.parquet(args.feed), args.landing, args.lake))
    elif args.action == "history":
        print_all(versions.history(spark, args.table).orderBy("version"))
    else:
        print(versions.restore(spark, args.table, args.version))


if __name__ == "__main__":
    main()
