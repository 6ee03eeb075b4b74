"""Retry of quarantined rows driven by arrivals, on a table of the rows that are still open.

The full retry looks at all quarantine rows and all actions each time.  Here
the open rows are a table of their own, one folder a day of quarantine; a
folder is written anew when rows of its day are closed, so closed rows are
left out by path.  A row is checked against all parents once, when it is
taken in, and keeps the keys that were missing.  After that it only meets
the keys of parents loaded since the run before, so a run costs what came
and what is open, not what ever was.

A run reads what the run before it left, under that run's name, and writes
its own state last: it can be repeated after any failure until the next run.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import is_retry_null
from sluice.functions.times import older_than
from sluice.operators.insert import absent_rows
from sluice.operators.integrity import MISSING, arrived_keys, with_missing_keys
from sluice.operators.quarantine import from_raw
from sluice.operators.schema import restored
from sluice.plans.ingest import build_rows, moment, parents_of
from sluice.plans.retry import (
    MAX_RETRIES,
    ORPHAN_HOURS,
    PROMOTED,
    RESOLVED,
    SKIPPED,
    WAITING,
    open_quarantine,
    outcome_stats,
    true_orphans,
)
from sluice.session import stage, temporary_stages
from sluice.sources.warehouse import BATCH_ID, Warehouse
from sluice.spec import ENTITIES, STREAM, Entity, load_order

FOLDER = "open_row"
#: an open row; ``tried`` and ``tried_at`` are its retries before run ``taken``, ``no_key`` rows
#: lack their own key, ``missing`` is null for rows that no parent can heal
OPEN = (
    "quarantine_id string, source_file string, source_table string, rejection_stage string, "
    "raw_data string, quarantined_at timestamp_ntz, taken long, tried int, tried_at timestamp_ntz, "
    f"no_key boolean, missing {MISSING}"
)
OPEN_NAMES = (
    "quarantine_id", "source_file", "source_table", "rejection_stage", "raw_data", "quarantined_at",
    "taken", "tried", "tried_at", "no_key", "missing",
)
#: what is read of all open rows; documents are read of the rows that are closed or written anew
NARROW = ("quarantine_id", "day", "source_table", "rejection_stage", "quarantined_at", "taken", "tried", "tried_at", "no_key", "missing")


@dataclass
class State:
    """What a run leaves: its number and time, the version of each open day, the loads it has seen."""

    seq: int = 0
    as_of: datetime | None = None
    days: dict[str, str] = field(default_factory=dict)
    loads: dict[str, int] = field(default_factory=dict)

    def rows(self) -> list[tuple[str, str, str]]:
        return [
            ("run", str(self.seq), self.as_of.isoformat()),
            *(("day", d, v) for d, v in self.days.items()),
            *(("load", name, str(at)) for name, at in self.loads.items()),
        ]

    @classmethod
    def of(cls, rows: Iterable) -> State:
        found = cls()
        for kind, name, value in rows:
            if kind == "run":
                found.seq, found.as_of = int(name), datetime.fromisoformat(value)
            elif kind == "day":
                found.days[name] = value
            else:
                found.loads[name] = int(value)
        return found


class OpenSet:
    """The open rows below a warehouse, as a run with a batch id finds and leaves them."""

    def __init__(self, warehouse: Warehouse, batch_id: str):
        self.warehouse, self.spark, self.batch_id = warehouse, warehouse.spark, batch_id
        runs = warehouse.loads("retry_state")
        own = [r for r in runs if r.split("-", 1)[1] == batch_id]
        if own and own[0] != runs[-1]:
            raise ValueError(f"retry {batch_id!r} cannot be repeated: later ones have run")
        before = [r for r in runs if r not in own]
        # one row for the run, each open day and each load of a table
        self.before = State.of(warehouse.read_load("retry_state", before[-1]).collect()) if before else State()
        self.seq = self.before.seq + 1
        self.name = f"{self.seq:012d}-{batch_id}"
        self.seen: dict[str, int] = {}

    @property
    def root(self) -> str:
        return self.warehouse.path(FOLDER)

    def _folder(self, day: str, version: str) -> str:
        return f"{self.root}/version={version}/day={day}"

    def rows(self, days: Iterable[str] | None = None) -> DataFrame:
        """The open rows, of all days or some, with their day; only folders of open days are listed."""
        wanted = self.before.days if days is None else {d: self.before.days[d] for d in days if d in self.before.days}
        schema = f"{OPEN}, day date"
        if not wanted:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.root)
        return reader.parquet(*[self._folder(d, v) for d, v in sorted(wanted.items())])

    def write(self, rows: DataFrame, days: Iterable[str], as_of: datetime) -> None:
        """Write the open rows of some days anew and, last, the state."""
        path = f"{self.root}/version={self.name}"
        # few files a day, and a day of very many rows in several
        rows.hint("rebalance", "day").write.mode("overwrite").partitionBy("day").parquet(path)
        written = {str(r[0]) for r in self.spark.read.schema(f"{OPEN}, day date").parquet(path).select("day").distinct().collect()}
        touched = set(days) | written
        kept = {d: v for d, v in self.before.days.items() if d not in touched}
        after = State(self.seq, as_of, {**kept, **dict.fromkeys(written, self.name)}, self.seen)
        state = self.spark.createDataFrame(after.rows(), "kind string, name string, value string")
        self.warehouse.write_load("retry_state", state.coalesce(1), self.name)

    def arrived(self, table: str) -> DataFrame:
        """Rows of the loads of a table that came, or were run again, since the run before."""
        times = self.warehouse.load_times(table)
        new = [name for name, at in times.items() if self.before.loads.get(f"{table}/{name}") != at]
        # what this run restores is seen as new once more by the next one
        self.seen |= {f"{table}/{n}": at for n, at in times.items() if n != self.batch_id}
        return self.warehouse.read_loads(table, sorted(new))

    def prune(self, keep: int = 2) -> list[str]:
        """Remove versions and states that none of the last ``keep`` runs needs; their names."""
        runs = self.warehouse.loads("retry_state")
        states = [State.of(self.warehouse.read_load("retry_state", r).collect()) for r in runs[-keep:]]
        needed = {v for s in states for v in s.days.values()} | set(runs[-keep:])
        files = self.spark._jvm.org.apache.hadoop.fs
        root = files.Path(self.root)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        versions = [e.getPath() for e in fs.listStatus(root)] if fs.exists(root) else []
        gone = [p for p in versions if p.getName().removeprefix("version=") not in needed]
        gone += [files.Path(f"{self.warehouse.path('retry_state')}/{BATCH_ID}={r}") for r in runs[:-keep]]
        for path in gone:
            fs.delete(path, True)
        return sorted(p.getName() for p in gone)


def _taken_in(found: OpenSet) -> DataFrame:
    """Quarantine rows that came since the run before and are not closed, as open rows without ``missing``."""
    warehouse = found.warehouse
    came = found.arrived("quarantine")
    first = F.min_by(F.struct(*came.columns), F.struct("quarantined_at", "source_file"))
    came = came.groupBy("quarantine_id").agg(first.alias("_row")).select("_row.*")
    # loads that were run again since an earlier run
    repeated = [n.removeprefix("quarantine/") for n in found.before.loads if n.startswith("quarantine/")]
    actions = warehouse.read("quarantine_action", but_batch=found.batch_id)
    if found.before.seq:
        # only a load that was run again, or a file that was loaded twice, can bring back a closed row
        again = warehouse.read("processed_files").groupBy("file_path").agg(F.count("*").alias("n")).where("n > 1")
        twice = came.join(again, came["source_file"] == again["file_path"], "left_semi").select("quarantine_id")
        twice = twice.union(came.where(F.col(BATCH_ID).isin(*repeated)).select("quarantine_id")) if repeated else twice
        twice = stage(twice, "brought_again")
        closed = actions.where(F.col("action").isin(RESOLVED, PROMOTED)).join(twice, "quarantine_id", "left_semi")
        fresh = came.join(closed, "quarantine_id", "left_anti").join(found.rows().select("quarantine_id"), "quarantine_id", "left_anti")
        fresh = fresh.withColumns({"retry_count": F.lit(0), "last_retry_at": F.lit(None).cast("timestamp_ntz")})
    else:
        fresh = open_quarantine(came, actions)
    return stage(
        fresh.select(
            "quarantine_id", "source_file", "source_table", "rejection_stage", "raw_data", "quarantined_at",
            F.lit(found.seq).cast("long").alias("taken"), F.col("retry_count").cast("int").alias("tried"),
            F.col("last_retry_at").alias("tried_at"), F.lit(False).alias("no_key"), F.lit(None).cast(MISSING).alias("missing"),
            F.to_date("quarantined_at").alias("day"),
        ),
        "taken_in",
    )


def _no_placeholders(opened: DataFrame, entity: Entity) -> DataFrame:
    return opened.withColumns(
        {k.column: F.when(~is_retry_null(F.col(k.column)), F.col(k.column)) for k in entity.foreign_keys}
    )


def _still_missing(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows with the keys taken out of ``missing`` that are among the arrived ones; ``counted`` if any was missing."""
    rows = rows.withColumn("counted", F.coalesce(F.size("missing") > 0, F.lit(False)))
    asked = rows.select("quarantine_id", F.explode("missing").alias("m")).select("quarantine_id", "m.*")
    met = asked.join(keys, ["parent", "key"]).groupBy("quarantine_id").agg(F.collect_set("edge").alias("_met"))
    left = F.filter("missing", lambda m: ~F.array_contains(F.coalesce("_met", F.array().cast("array<string>")), m["edge"]))
    return rows.join(met, "quarantine_id", "left").withColumns(
        {"missing": left, "changed": F.col("_met").isNotNull()}
    ).drop("_met")


def _decided(rows: DataFrame, found: OpenSet, as_of: datetime, hours: int, max_retries: int) -> DataFrame:
    """Adds retry_count, last_retry_at, outcome and unresolved_fk; only runs in which a row waited count."""
    again = F.col("counted") & (F.col("taken") < found.seq)
    count = F.col("tried") + F.when(again, F.lit(found.seq) - F.col("taken")).otherwise(F.lit(0)).cast("int")
    last = F.lit(found.before.as_of).cast("timestamp_ntz")
    rows = rows.withColumns(
        {"retry_count": count, "last_retry_at": F.when(again, last).otherwise(F.col("tried_at"))}
    )
    aged = older_than(F.col("quarantined_at"), moment(as_of), hours)
    hopeless = aged | (F.col("retry_count") >= max_retries)
    orphan = F.col("rejection_stage") == "orphan"
    healed = F.size("missing") == 0
    outcome = (
        F.when(~orphan, F.when(aged, PROMOTED).otherwise(SKIPPED))
        .when(F.col("missing").isNull(), SKIPPED)
        .when(healed & F.col("no_key"), SKIPPED)
        .when(healed, RESOLVED)
        .when(hopeless, PROMOTED)
        .otherwise(WAITING)
    )
    fk = F.when(orphan, F.try_element_at(F.col("missing")["edge"], F.lit(1))).otherwise(F.col("rejection_stage"))
    return rows.withColumns({"outcome": outcome, "unresolved_fk": fk})


def retry_arrivals(
    spark: SparkSession,
    warehouse: Warehouse,
    batch_id: str,
    as_of: datetime,
    orphan_hours: int = ORPHAN_HOURS,
    max_retries: int = MAX_RETRIES,
) -> dict[str, int]:
    """One run over all tables; returns the counters of the full retry, with the same outcomes.

    Rows that wait are not written to the actions, their retries follow from
    the number of the run.  The first run takes in all rows that the actions
    have not closed.  Use either this or the full retry on a warehouse from then on.
    """
    with temporary_stages(spark):
        return _run(OpenSet(warehouse, batch_id), as_of, orphan_hours, max_retries)


def _run(found: OpenSet, as_of: datetime, hours: int, max_retries: int) -> dict[str, int]:
    warehouse, batch_id = found.warehouse, found.batch_id
    taken = _taken_in(found)
    known = stage(found.rows().select(*NARROW), "open_rows")
    facts = [ENTITIES[n] for n in load_order() if ENTITIES[n].kind == STREAM]
    orphan = F.col("rejection_stage") == "orphan"
    decided: list[DataFrame] = []
    inserted, place = 0, ("quarantined_at", "quarantine_id")

    for entity in facts:
        mine = orphan & (F.col("source_table") == entity.table)
        came = taken.where(mine)
        waiting = known.where(mine)
        if came.isEmpty() and waiting.isEmpty():
            for k in entity.foreign_keys:
                found.arrived(ENTITIES[k.entity].table)
            continue
        # what came is listed before the parents are read: a load after that is new to the next run
        keys = None
        for k in {k.entity for k in entity.foreign_keys}:
            part = arrived_keys(ENTITIES[k], found.arrived(ENTITIES[k].table))
            keys = part if keys is None else keys.unionByName(part)
        opened = _no_placeholders(from_raw(came.drop("no_key", "missing"), entity), entity)
        fresh = with_missing_keys(opened, entity, parents_of(entity, warehouse), "missing")
        fresh = fresh.withColumns({"no_key": is_retry_null(F.col(entity.key)), "changed": F.lit(True), "counted": F.lit(True)})
        old = _still_missing(waiting, stage(keys.distinct(), "arrived"))
        rows = fresh.select(*NARROW, "changed", "counted").unionByName(old)
        rows = stage(_decided(rows, found, as_of, hours, max_retries), "decided")
        decided.append(rows)

        resolved = _documents(rows.where(F.col("outcome") == RESOLVED), found, taken)
        raw = from_raw(resolved, entity).select(*entity.names, *place)
        built = build_rows(
            entity, restored(_no_placeholders(raw, entity), entity, *place), warehouse, moment(as_of), *place
        )
        existing = warehouse.read(entity.table, but_batch=batch_id)
        # of copies the one that was quarantined first is restored
        new = stage(absent_rows(built, existing, entity.key, F.struct(*place)), "restored")
        warehouse.write_load(entity.table, new, batch_id)
        inserted += new.count()

    tables = [e.table for e in facts]
    rest = known.unionByName(taken.select(*NARROW)).where(~(orphan & F.col("source_table").isin(*tables)))
    rest = rest.withColumns({"changed": F.col("taken") == found.seq, "counted": F.lit(False)})
    every = stage(_decided(rest, found, as_of, hours, max_retries), "decided_rest")
    for rows in decided:
        every = every.unionByName(rows.select(*every.columns))
    every = stage(every, "decided_all")

    closed = every.where(F.col("outcome").isin(RESOLVED, PROMOTED))
    lost = _documents(every.where(F.col("outcome") == PROMOTED), found, taken)
    warehouse.write_load("true_orphan", true_orphans(lost), batch_id)
    actions = closed.select("quarantine_id", F.col("outcome").alias("action"), moment(as_of).alias("acted_at"))
    warehouse.write_load("quarantine_action", actions, batch_id)

    # days of which a row was closed, lost a missing key or came
    touched = every.where(F.col("changed") | F.col("outcome").isin(RESOLVED, PROMOTED)).select("day").distinct()
    days = sorted(str(r["day"]) for r in touched.collect())  # open days
    again = {"tried": F.col("retry_count"), "tried_at": F.col("last_retry_at"), "taken": F.lit(found.seq).cast("long")}
    left = every.withColumns(again).where(~F.col("outcome").isin(RESOLVED, PROMOTED) & F.col("day").cast("string").isin(*days or [""]))
    found.write(_documents(left, found, taken, days).select(*OPEN_NAMES, "day"), days, as_of)

    stats = outcome_stats(every).first().asDict()
    return {**stats, "retried": inserted}


def _documents(rows: DataFrame, found: OpenSet, taken: DataFrame, days: Iterable[str] | None = None) -> DataFrame:
    """Adds source_file and raw_data, read of these rows' days only."""
    if days is None:
        days = [str(r["day"]) for r in rows.select("day").distinct().collect()]  # open days
    whole = found.rows(days).select("quarantine_id", "source_file", "raw_data")
    whole = whole.unionByName(taken.select("quarantine_id", "source_file", "raw_data"))
    return rows.join(whole, "quarantine_id")
