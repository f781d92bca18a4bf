"""Runs for ``spark-submit``: ``refresh``, ``month jan16``, ``backfill 2016-01 2016-12``, ``references`` and ``expire``."""

from __future__ import annotations

import argparse
import datetime as dt

from landfall.functions import months_between
from landfall.plans import backfill, lake_orphans, refresh_dimensions, run_month
from landfall.session import open_session
from landfall.sources import LakeLayout, RawLayout, expire


def _month(text: str) -> dt.date:
    return dt.datetime.strptime(text, "%Y-%m").date()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="landfall", description=__doc__)
    parser.add_argument("--raw", help="root of the raw feeds, for the runs that read them")
    parser.add_argument("--lake", required=True, help="root of the lake tables")
    parser.add_argument("--arrivals-format", default=RawLayout.arrivals_format)
    parser.add_argument("--arrivals", default=RawLayout.arrivals, help="path of a month's file, with {month}")
    parser.add_argument("--arrivals-option", action="append", default=[], metavar="NAME=VALUE", help="for the reader of the arrivals")
    runs = parser.add_subparsers(dest="run", required=True)
    refresh = runs.add_parser("refresh")
    refresh.add_argument("--after", type=dt.date.fromisoformat, default=dt.date(2013, 8, 1))
    refresh.add_argument("--latest", action="store_true", help="keep the last temperature of each city")
    refresh.add_argument("--reach", type=float, help="tell cities of one name apart by airports within so many degrees")
    one = runs.add_parser("month")
    one.add_argument("month", help="such as jan16")
    many = runs.add_parser("backfill")
    many.add_argument("first", type=_month, help="such as 2016-01")
    many.add_argument("last", type=_month, help="such as 2016-12")
    many.add_argument("--together", type=int, default=1, help="months per pass")
    many.add_argument("--skip-unchanged", action="store_true", help="leave out months whose inputs did not change since they were filled")
    runs.add_parser("references", help="report the rows that name none of another table")
    old = runs.add_parser("expire", help="forget old snapshots and remove what only they have")
    old.add_argument("--keep", type=int, default=10, help="snapshots to keep")
    args = parser.parse_args(argv)
    if args.run in ("refresh", "month", "backfill") and not args.raw:
        parser.error(f"{args.run} needs --raw")

    spark = open_session()
    options = dict(option.split("=", 1) for option in args.arrivals_option)
    raw = RawLayout(args.raw or "", arrivals=args.arrivals, arrivals_format=args.arrivals_format, arrivals_options=options)
    lake = LakeLayout(args.lake)
    if args.run == "refresh":
        reports = [refresh_dimensions(spark, raw, lake, after=args.after, latest=args.latest, reach=args.reach)]
    elif args.run == "references":
        reports = [lake_orphans(spark, lake)]
    elif args.run == "expire":
        for folder in expire(spark, lake.root, keep=args.keep):
            print("removed", folder)
        reports = []
    elif args.run == "month":
        reports = [run_month(spark, raw, lake, args.month)]
    else:
        months = months_between(args.first, args.last)
        reports = backfill(spark, raw, lake, months, together=args.together, skip_unchanged=args.skip_unchanged)
    for report in reports:
        report.show(truncate=False)


if __name__ == "__main__":
    main()
