"""spark-submit entry: `python -m gridspark --specs DIR [--layer all | --table NAME] ...`"""

from __future__ import annotations

import argparse

from gridspark import get_spark, run_etl, run_table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="gridspark")
    parser.add_argument("--specs", required=True, help="spec file, or directory of spec files")
    what = parser.add_mutually_exclusive_group()
    what.add_argument("--layer", choices=["silver", "gold", "all"], default="all")
    what.add_argument("--table", help="one table only, by table or output name")
    parser.add_argument(
        "--bronze", action="append", default=[], metavar="FEED=PATH", help="files instead of a table"
    )
    parser.add_argument("--bronze-format", choices=["parquet", "json", "raw", "lines"])
    parser.add_argument("--since", help="only snapshots ingested from this day on (yyyy-MM-dd)")
    parser.add_argument("--output-root", help="folder for Parquet output")
    parser.add_argument("--no-tables", action="store_true", help="write Parquet only")
    parser.add_argument("--mirror", action="store_true", help="also export tables as Parquet")
    parser.add_argument("--newest-wins", action="store_true", help="never replace newer facts")
    args = parser.parse_args(argv)
    options = {
        "specs": args.specs,
        "bronze_paths": dict(pair.split("=", 1) for pair in args.bronze),
        "bronze_format": args.bronze_format,
        "since": args.since,
        "output_root": args.output_root,
        "write_tables": not args.no_tables,
        "mirror": args.mirror,
        "newest_wins": args.newest_wins,
    }
    spark = get_spark()
    if args.table:
        run_table(spark, args.table, **options)
    else:
        run_etl(spark, layer=args.layer, **options)


if __name__ == "__main__":
    main()
