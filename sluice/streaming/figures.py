"""Service-level figures that are kept up as tickets are loaded.

A ticket counts for its agent on the day it was created.  Every load of
tickets has its own partial counts in a small table, so a load that is run
again replaces its counts, and reports add up counts instead of tickets.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.plans.analytics import percent, sla_performance
from sluice.sources.warehouse import BATCH_ID, Warehouse, table_schema

TABLE, FACTS = "sla_agent_day", "fact_ticket"


def partial_counts(tickets: DataFrame, *by: str) -> DataFrame:
    """Counts per agent and day of tickets, combined in the tasks before they are exchanged."""
    return (
        sla_performance(tickets, *by)
        .groupBy(*by, "agent_id", F.to_date("created_at").alias("day"))
        .agg(
            F.count("*").alias("total_tickets"),
            F.count_if("is_first_response_met").alias("first_response_met"),
            F.count_if("is_resolution_met").alias("resolution_met"),
        )
    )


def compliance(counts: DataFrame, day: date | None = None) -> DataFrame:
    """The compliance report of ``sla_compliance_by_agent`` from partial counts."""
    if day is not None:
        counts = counts.where(F.col("day") == F.lit(day))
    first, total = F.sum("first_response_met"), F.sum("total_tickets")
    return (
        counts.groupBy("agent_id")
        .agg(
            total.alias("total_tickets"),
            first.alias("first_response_met"),
            F.sum("resolution_met").alias("resolution_met"),
            percent(first, total).alias("first_response_rate_pct"),
        )
        .orderBy(F.desc("first_response_rate_pct"), "agent_id")
    )


def maintain(warehouse: Warehouse, loads: list[str]) -> None:
    """Count the tickets of some loads anew; reads the folders of these loads only."""
    if not loads:
        return
    facts = warehouse.read_loads(FACTS, loads)
    counts = partial_counts(facts, BATCH_ID)
    names = [*table_schema(TABLE).names, BATCH_ID]
    (
        counts.select(*names)
        # a file a load while they are small; in tasks of even size when not
        .hint("rebalance", BATCH_ID)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH_ID)
        .parquet(warehouse.path(TABLE))
    )


def keep_figures(
    spark: SparkSession,
    warehouse: Warehouse,
    checkpoint: str,
    trigger: dict | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start keeping the counts up with the loads of tickets.

    The stream says which loads came or were run again, and each is counted
    from its own folder: also when its files reach the stream in two
    micro-batches or under new names, its counts are those of what it holds now.
    """
    arrived = (
        spark.readStream.schema(table_schema(FACTS).add(BATCH_ID, "string"))
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(warehouse.path(FACTS))
        .select(BATCH_ID)
    )

    def update(rows: DataFrame, _number: int) -> None:
        # names of loads, at most one a file of the micro-batch
        loads = [r[0] for r in rows.where(F.col(BATCH_ID).isNotNull()).distinct().toLocalIterator()]
        maintain(warehouse, sorted(loads))

    return (
        arrived.writeStream.foreachBatch(update)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

