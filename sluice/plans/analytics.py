"""Service-level, audit and quarantine reports.

Every report that speaks of "today" or "the last hours" takes the moment as
a parameter, so its result depends on the tables only.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.times import is_met, older_than, seconds_between

SLA_VIEW = "v_ticket_sla_performance"


def sla_performance(tickets: DataFrame, *keep: str) -> DataFrame:
    """Per ticket: were first response and resolution in time; ``keep`` names more columns."""
    return tickets.select(
        *keep,
        "ticket_id",
        "agent_id",
        "created_at",
        "first_response_at",
        "sla_first_due_at",
        "resolved_at",
        "sla_resolve_due_at",
        is_met(F.col("first_response_at"), F.col("sla_first_due_at")).alias(
            "is_first_response_met"
        ),
        is_met(F.col("resolved_at"), F.col("sla_resolve_due_at")).alias("is_resolution_met"),
    )


def create_sla_view(tickets: DataFrame) -> None:
    """(Re)create the view over the current tickets; it is computed when read."""
    sla_performance(tickets).createOrReplaceTempView(SLA_VIEW)


def _on_day(df: DataFrame, column: str, day: date | None) -> DataFrame:
    if day is None:
        return df
    start = F.lit(day).cast("timestamp_ntz")
    # a range on the bare column reaches the scan, a function on it would not
    return df.where((F.col(column) >= start) & (F.col(column) < start + F.expr("INTERVAL 1 DAY")))


def _since(df: DataFrame, column: str, as_of: datetime | None, hours: int) -> DataFrame:
    if as_of is None:
        return df
    return df.where(
        F.col(column) > F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))
    )


def percent(part, whole):
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)


def sla_compliance_by_agent(performance: DataFrame, day: date | None = None) -> DataFrame:
    first = F.sum(F.col("is_first_response_met").cast("int"))
    return (
        _on_day(performance, "created_at", day)
        .groupBy("agent_id")
        .agg(
            F.count("*").alias("total_tickets"),
            first.alias("first_response_met"),
            F.sum(F.col("is_resolution_met").cast("int")).alias("resolution_met"),
            percent(first, F.count("*")).alias("first_response_rate_pct"),
        )
        .orderBy(F.desc("first_response_rate_pct"), "agent_id")
    )


def breached_tickets(performance: DataFrame, day: date | None = None) -> DataFrame:
    """Tickets answered late or not at all, with the whole minutes they are over."""
    over = seconds_between(F.col("sla_first_due_at"), F.col("first_response_at")) / 60
    return (
        _on_day(performance, "created_at", day)
        .where(~F.col("is_first_response_met"))
        .select(
            "ticket_id",
            "agent_id",
            "created_at",
            "sla_first_due_at",
            "first_response_at",
            F.when(
                F.col("first_response_at") > F.col("sla_first_due_at"), F.floor(over).cast("bigint")
            )
            .otherwise(F.lit(0).cast("bigint"))
            .alias("minutes_over_sla"),
        )
        .orderBy(F.desc("minutes_over_sla"), "ticket_id")
    )


def status_transitions(events: DataFrame) -> DataFrame:
    """How often tickets moved from one status to another; first statuses come from null."""
    return events.groupBy("old_status", "new_status").agg(F.count("*").alias("transitions"))


def daily_file_summary(
    log: DataFrame, as_of: datetime | None = None, hours: int = 24
) -> DataFrame:
    return (
        _since(log, "processed_at", as_of, hours)
        .groupBy(F.to_date("processed_at").alias("date"), "file_type")
        .agg(
            F.count("*").alias("files_processed"),
            F.sum("total_records").alias("total_records"),
            F.sum("valid_records").alias("valid_records"),
            F.sum("quarantined").alias("quarantined_total"),
            F.sum("orphan_count").alias("orphans_total"),
            F.count_if(F.col("status") == "failed").alias("failed_files"),
        )
    )


def failed_files(log: DataFrame, limit: int = 20) -> DataFrame:
    """The latest failures; of one time, by name and path."""
    return (
        log.where(F.col("status") == "failed")
        .orderBy(F.desc("processed_at"), "file_name", "file_path")
        .limit(limit)
        .select("file_name", "source_table", "rejection_stage", "quarantined", "processed_at")
    )


def duplicate_metrics(
    log: DataFrame, as_of: datetime | None = None, hours: int = 7 * 24
) -> DataFrame:
    dupes = F.sum("duplicate_count")
    return (
        _since(log, "processed_at", as_of, hours)
        .groupBy("file_name")
        .agg(
            dupes.alias("total_dupes"),
            percent(dupes, F.sum("total_records")).alias("dup_rate_pct"),
        )
        .orderBy(F.desc("total_dupes"), "file_name")
    )


def quarantine_listing(quarantine: DataFrame, table: str | None = None) -> DataFrame:
    """Quarantine rows of all tables or one, oldest first."""
    rows = quarantine if table is None else quarantine.where(F.col("source_table") == table)
    return rows.orderBy("quarantined_at", "quarantine_id")


def recent_quarantine(
    quarantine: DataFrame, as_of: datetime | None = None, hours: int = 24
) -> DataFrame:
    return _since(quarantine, "quarantined_at", as_of, hours).orderBy(
        F.desc("quarantined_at"), "quarantine_id"
    )


def orphans_to_promote(
    quarantine: DataFrame, table: str, unresolved_fk: str, as_of: datetime, hours: int = 24
) -> DataFrame:
    """Aged orphan rows of one table in the shape of the true-orphan table."""
    return quarantine.where(
        (F.col("rejection_stage") == "orphan")
        & (F.col("source_table") == table)
        & older_than(F.col("quarantined_at"), F.lit(as_of).cast("timestamp_ntz"), hours)
    ).select(
        "quarantine_id",
        "source_file",
        "source_table",
        F.lit(unresolved_fk).alias("unresolved_fk"),
        "raw_data",
        F.col("quarantined_at").alias("first_seen_at"),
    )
