"""Command line: ``python -m forgestat daily ...`` runs the daily job on a
landing folder; ``python -m forgestat publish ...`` builds the warehouse over
the driver tables and saves the models as catalog tables. Uses the active
session's own master and settings (spark-submit) unless ``--master`` is given."""

from __future__ import annotations

import argparse
import datetime as dt
import json
from pathlib import Path

from pyspark.sql import SparkSession

from forgestat.params import WarehouseParams
from forgestat.sources.ingest import DEFAULT_INITIAL_CURSOR
from forgestat.session import build_session, configure


def _session(master: str | None) -> SparkSession:
    """The submitted cluster's session; master and sizes are set here only on demand."""
    return build_session(master) if master else configure(SparkSession.builder.getOrCreate())


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="forgestat")
    sub = ap.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily", help="landed JSON -> bronze -> models -> tests")
    d.add_argument("--landing", required=True)
    d.add_argument("--bronze", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--load-id", default=dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H%M%S"))
    d.add_argument("--spine-start", default="2026-01-01")
    d.add_argument("--spine-end", default="2026-12-31")
    d.add_argument("--initial-date", default=DEFAULT_INITIAL_CURSOR, help="where entities without a cursor start")
    d.add_argument("--modes", choices=["effective", "declared"], default="effective")
    d.add_argument("--exclude-pull-requests", action="store_true")
    d.add_argument("--lenient-comment-numbers", action="store_true", help="a comment URL without a number gives NULL")
    d.add_argument("--iso-year", action="store_true", help="weeks by their ISO year")
    d.add_argument("--monday-week-start", action="store_true", help="weeks reported from their Monday")
    d.add_argument("--repositories", help="JSON list of {owner, repo, initial_date, enabled}")
    d.add_argument("--publish-db", help="database whose views move to this run's tables if its tests pass")
    d.add_argument("--warn", nargs="*", default=[], help="patterns of tests that do not hold the views back")
    p = sub.add_parser("publish", help="build over the driver tables, save as catalog tables")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--marts-db", default="marts")
    p.add_argument("--intermediate-db", default="intermediate")
    for s in (d, p):
        s.add_argument("--master")
    a = ap.parse_args(argv)
    spark = _session(a.master)
    if a.cmd == "daily":
        from forgestat.plans.daily import Repository, daily_run
        listed = json.loads(Path(a.repositories).read_text()) if a.repositories else []
        params = WarehouseParams(date_spine_start=dt.date.fromisoformat(a.spine_start),
                                 date_spine_end=dt.date.fromisoformat(a.spine_end),
                                 exclude_pull_requests=a.exclude_pull_requests, load_id=a.load_id,
                                 strict_comment_numbers=not a.lenient_comment_numbers, iso_year=a.iso_year,
                                 monday_week_start=a.monday_week_start)
        out = daily_run(spark, a.landing, a.bronze, a.out, a.load_id, params, a.modes, a.initial_date,
                        tuple(Repository(**r) for r in listed), publish_db=a.publish_db, warn=tuple(a.warn))
        print(json.dumps(out, default=str))
    else:
        from forgestat.plans.warehouse import driver_warehouse
        wh = driver_warehouse(spark, a.sf_dir)
        names = wh.publish(a.marts_db) + wh.publish(a.intermediate_db, models=("int_contributor_activity",))
        print(json.dumps({"published": names}))


if __name__ == "__main__":
    main()
