"""Silver to Gold as a batch job. The Silver job must have run before."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from orderloom import Lake, LakeNames, run_gold
from orderloom.plans.runs import BRONZE_OF, publish_dim_order


def main(argv: list[str] | None = None) -> None:
    defaults = LakeNames()
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder that holds the lake's tables")
    parser.add_argument("--catalog", default=None)
    parser.add_argument("--silver-schema", default=defaults.silver)
    parser.add_argument("--gold-schema", default=defaults.gold)
    parser.add_argument(
        "--with-dim-order", action="store_true", help="also store the orders with their status"
    )
    args = parser.parse_args(argv)
    names = LakeNames(silver=args.silver_schema, gold=args.gold_schema, catalog=args.catalog)
    spark = SparkSession.builder.appName("orderloom-gold").getOrCreate()
    lake = Lake(spark, args.root, names)
    for table in BRONZE_OF:  # a new session's catalog may not know the stored tables yet
        lake.show_in_catalog(table)
    run_gold(lake)
    if args.with_dim_order:
        publish_dim_order(lake)


if __name__ == "__main__":
    main()
