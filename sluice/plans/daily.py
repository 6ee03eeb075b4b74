"""The daily run: each date's folder of dimension files is loaded once, in order.

The schedule is the caller's, as often as wanted; what is due follows from
the time and from the table of days that were run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import SparkSession

from sluice.plans.ingest import Outcome, ingest_folder, moment
from sluice.sources.folds import entries
from sluice.sources.warehouse import Warehouse

TABLE = "daily_run"
#: hour of a day from which its folder is complete
HOUR = 1


@dataclass
class Day:
    """What the run of one date did."""

    day: date
    outcomes: list[Outcome] = field(default_factory=list)


def landed_days(spark: SparkSession, folder: str) -> list[date]:
    """The dates that have a folder, named YYYY-MM-DD, in order."""
    found = []
    for name in entries(spark, folder):
        if re.fullmatch(r"\d{4}-\d{2}-\d{2}", name):
            try:
                found.append(date.fromisoformat(name))
            except ValueError:
                continue
    return sorted(found)


def due_days(
    spark: SparkSession, folder: str, warehouse: Warehouse, as_of: datetime,
    hour: int = HOUR, first: date | None = None,
) -> list[date]:
    """Landed dates not yet run with success, up to today from ``hour`` on, else to yesterday.

    A date whose folder comes late is due then; ``first`` leaves out older ones.
    """
    last = as_of.date() if as_of.hour >= hour else as_of.date() - timedelta(days=1)
    done = {
        r["day"] for r in warehouse.read(TABLE).where("status = 'success'").select("day").toLocalIterator()
    }
    return [
        d for d in landed_days(spark, folder)
        if d <= last and d not in done and (first is None or d >= first)
    ]


def run_due(
    spark: SparkSession, folder: str, warehouse: Warehouse, as_of: datetime,
    hour: int = HOUR, first: date | None = None,
) -> list[Day]:
    """Run every due date, the oldest first.

    A date is recorded when all its entities were loaded, so a second start
    does nothing.  Single files that cannot be loaded are counted and stay in
    the file ledger; they do not hold the date up.  If a load itself fails, the
    date is recorded as failed, the error is raised and later dates wait: the
    next start begins with it and replaces what it wrote.
    """
    days = []
    for day in due_days(spark, folder, warehouse, as_of, hour, first):
        name = f"daily-{day.isoformat()}"
        try:
            outcomes = ingest_folder(spark, f"{folder}/{day.isoformat()}", warehouse, name, as_of)
        except Exception as error:
            why = f"{type(error).__name__}: {error}"[:1000]
            _record(warehouse, name, day, "failed", [], as_of, why)
            raise
        _record(warehouse, name, day, "success", outcomes, as_of)
        days.append(Day(day, outcomes))
    return days


def _record(
    warehouse: Warehouse, name: str, day: date, status: str, outcomes: list[Outcome],
    as_of: datetime, why: str | None = None,
) -> None:
    counts = [sum(len(getattr(o, part)) for o in outcomes) for part in ("loaded", "skipped", "failed")]
    row = warehouse.spark.createDataFrame(
        [(day, status, *counts, why)],
        "day date, status string, files_loaded bigint, files_skipped bigint, "
        "files_failed bigint, error_msg string",
    )
    warehouse.write_load(TABLE, row.withColumn("finished_at", moment(as_of)), name)
