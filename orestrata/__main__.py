"""Command line: `python -m orestrata <stage> --raw <folder> --base <folder>`."""

from __future__ import annotations

import argparse
import json

from orestrata.plans import reports, stages
from orestrata.plans.silver import CANCELED
from orestrata.session import build_session, shuffle_partitions
from orestrata.sources import tables
from orestrata.sources.registry import DATASETS, with_files

STAGES = ("ingest", "register", "check", "silver", "gold", "report", "all")


def main() -> None:
    parser = argparse.ArgumentParser(prog="orestrata")
    parser.add_argument("stage", choices=STAGES)
    parser.add_argument("--raw", help="folder of the raw CSV files")
    parser.add_argument("--base", help="folder of the bronze, silver and gold tables")
    parser.add_argument("--files", help="JSON object: dataset name -> file under --raw")
    parser.add_argument("--database", default="default")
    parser.add_argument("--infer", action="store_true", help="let Spark guess CSV types")
    parser.add_argument("--excluded", default=CANCELED, help="order status that silver leaves out")
    parser.add_argument("--drop-duplicates", action="store_true", help="keep one of identical raw rows in silver")
    parser.add_argument("--required", nargs="*", default=[], help="silver columns that must have a value")
    parser.add_argument("--rejects", action="store_true", help="write values that do not fit their type to tables of their own")
    parser.add_argument("--shuffle-gb", type=int, help="largest shuffle to expect, which sets the number of its partitions")
    parser.add_argument("--master", help="Spark master, when not run by spark-submit")
    args = parser.parse_args()

    datasets = with_files(json.loads(args.files)) if args.files else DATASETS
    cleaning = {"excluded": args.excluded, "drop_duplicates": args.drop_duplicates, "required": args.required}
    conf = {}
    if args.shuffle_gb:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions(args.shuffle_gb * 1024**3))
    spark = build_session(f"orestrata {args.stage}", args.master, conf)
    try:
        if args.stage == "ingest":
            print(stages.ingest_counts(spark, args.raw, args.base, datasets, infer=args.infer, rejects=args.rejects))
        elif args.stage == "register":
            print(stages.register_bronze(spark, args.base, datasets, args.database))
        elif args.stage == "check":
            tables.databases(spark).show(truncate=False)
            stages.check(spark, args.database).show(truncate=False)
        elif args.stage == "silver":
            print(stages.silver(spark, args.base, args.database, **cleaning))
        elif args.stage == "gold":
            print(stages.gold(spark, args.base, args.database))
        elif args.stage == "all":
            reading = {"infer": args.infer, "rejects": args.rejects}
            print(stages.run_all(spark, args.raw, args.base, datasets, args.database, **reading, **cleaning))
        if args.stage in ("gold", "report", "all"):
            gold = stages.gold_table(spark, args.base, args.database)
            reports.segment_distribution(gold).show(truncate=False)
            reports.top_customers(gold).show(truncate=False)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
