"""Bronze to Silver as a batch job. The Bronze tables must have been landed under the root."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from orderloom import Lake, LakeNames, run_silver


def main(argv: list[str] | None = None) -> None:
    defaults = LakeNames()
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder that holds the lake's tables")
    parser.add_argument("--catalog", default=None)
    parser.add_argument("--bronze-schema", default=defaults.bronze)
    parser.add_argument("--silver-schema", default=defaults.silver)
    parser.add_argument("--upsert", action="store_true", help="merge instead of rebuilding")
    parser.add_argument(
        "--since", type=dt.datetime.fromisoformat, help="upsert rows ingested after this time"
    )
    parser.add_argument("--passes", type=int, default=1, help="shares of the keys that a rebuild takes at a time")
    args = parser.parse_args(argv)
    names = LakeNames(bronze=args.bronze_schema, silver=args.silver_schema, catalog=args.catalog)
    spark = SparkSession.builder.appName("orderloom-silver").getOrCreate()
    run_silver(Lake(spark, args.root, names), rebuild=not args.upsert, since=args.since, passes=args.passes)


if __name__ == "__main__":
    main()
