"""Second chance for quarantined rows: late parents, promotion of the hopeless.

Quarantine rows are never deleted.  Each retry appends what it did; a row
is open until an action resolved or promoted it.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import is_retry_null
from sluice.functions.times import older_than
from sluice.operators.insert import absent_rows
from sluice.operators.integrity import flag_raw_orphans
from sluice.operators.quarantine import from_raw
from sluice.operators.schema import restored
from sluice.operators.sieve import left_join_few
from sluice.plans.ingest import build_rows, moment, parents_of
from sluice.session import stage, temporary_stages
from sluice.sources.warehouse import Warehouse
from sluice.spec import ENTITIES, STREAM, Entity, load_order

ORPHAN_HOURS = 24
MAX_RETRIES = 5

RESOLVED, PROMOTED, WAITING, SKIPPED = "resolved", "promoted", "waiting", "skipped"


def open_quarantine(quarantine: DataFrame, actions: DataFrame) -> DataFrame:
    """Quarantine rows without a final action, with the number of retries so far."""
    history = actions.groupBy("quarantine_id").agg(
        F.count_if(F.col("action") == "retry").alias("_retries"),
        F.max(F.when(F.col("action") == "retry", F.col("acted_at"))).alias("last_retry_at"),
        F.max(F.col("action").isin(RESOLVED, PROMOTED)).alias("_closed"),
    )
    history = stage(history.withColumnRenamed("quarantine_id", "_of"), "history")
    return (
        left_join_few(quarantine, [(history, ["_of"], [F.col("quarantine_id")])])
        .where(~F.coalesce(F.col("_closed"), F.lit(False)))
        .withColumn("retry_count", F.coalesce(F.col("_retries"), F.lit(0)).cast("int"))
        .drop("_of", "_retries", "_closed")
    )


def bad_row_outcomes(
    rows: DataFrame, as_of: datetime, orphan_hours: int = ORPHAN_HOURS
) -> DataFrame:
    """Outcome of schema and records rejects: they cannot heal, so only age counts."""
    aged = older_than(F.col("quarantined_at"), moment(as_of), orphan_hours)
    return rows.where(F.col("rejection_stage").isin("schema", "records")).withColumns(
        {
            "outcome": F.when(aged, PROMOTED).otherwise(SKIPPED),
            # the missing key of such a row is its stage
            "unresolved_fk": F.col("rejection_stage"),
        }
    )


def orphan_outcomes(
    rows: DataFrame,
    entity: Entity,
    parents: Mapping[str, DataFrame],
    as_of: datetime,
    orphan_hours: int = ORPHAN_HOURS,
    max_retries: int = MAX_RETRIES,
) -> DataFrame:
    """Orphan rows of one fact with ``outcome``, ``unresolved_fk`` and the raw columns.

    All keys found: resolved, or skipped if the row has no primary key.
    Otherwise promoted once too old or too often tried, else waiting.
    """
    orphans = rows.where(F.col("rejection_stage") == "orphan")
    opened = from_raw(orphans, entity)
    # placeholders for null in any of their spellings count as "no key set"
    opened = opened.withColumns(
        {
            k.column: F.when(~is_retry_null(F.col(k.column)), F.col(k.column))
            for k in entity.foreign_keys
        }
    )
    checked = flag_raw_orphans(opened, entity, parents, "unresolved_fk")
    hopeless = older_than(F.col("quarantined_at"), moment(as_of), orphan_hours) | (
        F.col("retry_count") >= max_retries
    )
    found = F.col("unresolved_fk").isNull()
    return checked.withColumn(
        "outcome",
        F.when(found & is_retry_null(F.col(entity.key)), SKIPPED)
        .when(found, RESOLVED)
        .when(hopeless, PROMOTED)
        .otherwise(WAITING),
    )


def outcome_stats(outcomes: DataFrame) -> DataFrame:
    """One row of counters over rows with ``rejection_stage`` and ``outcome``."""
    outcome, bad = F.col("outcome"), F.col("rejection_stage") != "orphan"
    return outcomes.agg(
        F.count_if(outcome == RESOLVED).alias("retried"),
        F.count_if(outcome == PROMOTED).alias("promoted"),
        F.count_if(outcome.isin(RESOLVED, PROMOTED)).alias("deleted"),
        F.count_if(bad | (outcome == SKIPPED)).alias("skipped"),
    )


def promoted_by_fk(outcomes: DataFrame) -> DataFrame:
    """Promoted rows per table and missing key."""
    return (
        outcomes.where(F.col("outcome") == PROMOTED)
        .groupBy("source_table", "unresolved_fk")
        .agg(F.count("*").alias("promoted_rows"))
    )


TRUE_ORPHAN = (
    "quarantine_id", "source_file", "source_table", "unresolved_fk", "raw_data",
)


def true_orphans(outcomes: DataFrame) -> DataFrame:
    """Promoted rows in the shape of the true-orphan table."""
    return outcomes.where(F.col("outcome") == PROMOTED).select(
        *TRUE_ORPHAN,
        F.col("quarantined_at").alias("first_seen_at"),
        "retry_count",
        "last_retry_at",
    )


def retry(
    spark: SparkSession,
    warehouse: Warehouse,
    batch_id: str,
    as_of: datetime,
    table: str | None = None,
    dry_run: bool = False,
    orphan_hours: int = ORPHAN_HOURS,
    max_retries: int = MAX_RETRIES,
    snapshot: bool = False,
) -> dict[str, int]:
    """Retry open quarantine rows, all or those of one table; returns the counters.

    ``retried`` counts the rows inserted.

    Facts are taken parents first and each sees the parents restored just
    before it; with ``snapshot`` all see the parents as they were at the
    start.  With ``dry_run`` nothing is written and only the retryable rows
    are counted.
    """
    with temporary_stages(spark):
        return _retry(
            warehouse, batch_id, as_of, table, dry_run, orphan_hours, max_retries, snapshot
        )


def _retry(
    warehouse: Warehouse,
    batch_id: str,
    as_of: datetime,
    table: str | None,
    dry_run: bool,
    orphan_hours: int,
    max_retries: int,
    snapshot: bool,
) -> dict[str, int]:
    totals = {"retried": 0, "promoted": 0, "deleted": 0, "skipped": 0}
    is_open = open_quarantine(
        warehouse.read("quarantine"), warehouse.read("quarantine_action", but_batch=batch_id)
    )
    if table is not None:
        is_open = is_open.where(F.col("source_table") == table)
    is_open = stage(is_open, "open_quarantine")
    facts = [ENTITIES[n] for n in load_order() if ENTITIES[n].kind == STREAM]
    tables = [e.table for e in facts]

    def parents(entity: Entity) -> dict[str, DataFrame]:
        found = parents_of(entity, warehouse)
        if snapshot:
            found = {
                name: warehouse.read(ENTITIES[name].table, but_batch=batch_id) for name in found
            }
        return found

    outcomes, inserted, place = [], 0, ("quarantined_at", "quarantine_id")
    for entity in facts:
        rows = is_open.where(
            (F.col("source_table") == entity.table) & (F.col("rejection_stage") == "orphan")
        )
        if rows.isEmpty():
            continue
        decided = stage(
            orphan_outcomes(rows, entity, parents(entity), as_of, orphan_hours, max_retries),
            "retry_outcomes",
        )
        outcomes.append(decided.select(*is_open.columns, "unresolved_fk", "outcome"))
        if not dry_run:
            resolved = decided.where(F.col("outcome") == RESOLVED).select(
                *entity.names, *place
            )
            built = build_rows(
                entity, restored(resolved, entity, *place), warehouse, moment(as_of), *place
            )
            existing = warehouse.read(entity.table, but_batch=batch_id)
            # of copies the one that was quarantined first is restored
            new = stage(absent_rows(built, existing, entity.key, F.struct(*place)), "restored")
            warehouse.write_load(entity.table, new, batch_id)
            inserted += new.count()

    others = is_open.where(
        (F.col("rejection_stage") == "orphan") & ~F.col("source_table").isin(*tables)
    ).withColumns({"outcome": F.lit(SKIPPED), "unresolved_fk": F.lit(None).cast("string")})
    outcomes += [
        others.select(*is_open.columns, "unresolved_fk", "outcome"),
        bad_row_outcomes(is_open, as_of, orphan_hours).select(
            *is_open.columns, "unresolved_fk", "outcome"
        ),
    ]
    every = outcomes[0]
    for part in outcomes[1:]:
        every = every.unionByName(part)
    every = stage(every, "retry_all")

    stats = outcome_stats(every).first().asDict()
    if dry_run:
        totals.update(retried=stats["retried"], skipped=stats["skipped"])
        return totals

    warehouse.write_load("true_orphan", true_orphans(every), batch_id)
    action = F.col("outcome")
    warehouse.write_load(
        "quarantine_action",
        every.where(action.isin(RESOLVED, PROMOTED, WAITING)).select(
            "quarantine_id",
            F.when(action == WAITING, "retry").otherwise(action).alias("action"),
            moment(as_of).alias("acted_at"),
        ),
        batch_id,
    )
    totals.update(stats, retried=inserted)
    return totals
