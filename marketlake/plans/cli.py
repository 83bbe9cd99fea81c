"""``python -m marketlake.plans.cli JOB LAKE_ROOT [--date D] [--hour H] [--debug]``."""

from __future__ import annotations

import argparse
import sys

from marketlake.operators.quality import QualityError
from marketlake.plans import jobs
from marketlake.plans.session import builder

JOBS = ("ticks", "rates", "analytics", "checks", "serving", "run")


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(prog="marketlake")
    made.add_argument("job", choices=JOBS)
    made.add_argument("lake", help="root folder of the lake")
    made.add_argument("--date", help="YYYY-MM-DD; all dates when omitted")
    made.add_argument("--hour", type=int, choices=range(24), metavar="0-23")
    made.add_argument(
        "--dedup", action="store_true", help="ticks job: drop replays of a symbol and trade id"
    )
    made.add_argument("--debug", action="store_true", help="print counts and samples")
    return made


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.hour is not None and (args.job != "ticks" or args.date is None):
        parser().error("--hour belongs to the ticks job and needs --date")
    spark = builder(f"marketlake-{args.job}").getOrCreate()
    lake = jobs.Lake(args.lake.rstrip("/"))
    try:
        if args.job == "ticks":
            keys = ("symbol", "trade_id") if args.dedup else None
            seen = jobs.tick_etl(spark, lake, args.date, args.hour, dedup_on=keys)
        elif args.job == "rates":
            seen = jobs.rate_etl(spark, lake, args.date)
        elif args.job == "analytics":
            seen = jobs.analytics(spark, lake)
        elif args.job == "checks":
            if args.debug:
                jobs.check_report(spark, lake).show(truncate=False)
            seen = jobs.checks(spark, lake)
        elif args.job == "serving":
            seen = jobs.serving(spark, lake, args.date)
        else:
            seen = jobs.full_run(spark, lake, args.date)
        if args.debug and seen is not None:
            print(f"{args.job}: {seen}")
        if args.debug and args.job in ("ticks", "rates"):
            table = "trades_agg_hourly" if args.job == "ticks" else "fx_daily"
            jobs.on_date(
                lake.read(spark, table), args.date, "date" if args.job == "ticks" else "fx_date"
            ).show(10, truncate=False)
    except QualityError as error:
        print(f"quality checks failed: {error}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
