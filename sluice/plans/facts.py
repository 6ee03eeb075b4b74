"""Fact rows from typed source rows: keys, durations and service-level flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import is_reopened, normal_id
from sluice.functions.times import date_key, is_breached, minutes_between, time_key
from sluice.plans.dims import conform
from sluice.session import as_large
from sluice.spec import Entity


def surrogate(key: str):
    """Stable surrogate of a key: a hash, so it needs no global counter."""
    return F.xxhash64(F.col(key))


def with_keys(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"date_key": date_key(F.col(ts)), "time_key": time_key(F.col(ts))})


def fact_order(orders: DataFrame, loaded_at, *keep: str) -> DataFrame:
    rows = with_keys(orders.withColumnRenamed("order_created_at", "created_at"), "created_at")
    rows = rows.withColumns({"order_sk": surrogate("order_id"), "_loaded_at": loaded_at})
    return conform(rows, "fact_order", *keep)


def order_regions(loaded_orders: DataFrame) -> DataFrame:
    """Key and region of loaded orders, one row per order, without unknown regions."""
    return loaded_orders.select(
        normal_id(F.col("order_id")).alias("_order_key"), F.col("region_id").alias("_region")
    ).where("_region IS NOT NULL")


def with_region(tickets: DataFrame, loaded_orders: DataFrame) -> DataFrame:
    """Tickets with the region of their order.

    Both sides may be large.  The join stays a plain equi-join, so adaptive
    execution splits the partitions of orders with very many tickets.
    """
    regions = order_regions(loaded_orders)
    return (
        tickets.drop("region_id")
        .join(as_large(regions), normal_id(F.col("order_id")) == F.col("_order_key"), "left")
        .withColumnRenamed("_region", "region_id")
        .drop("_order_key")
    )


def ticket_measures(tickets: DataFrame) -> DataFrame:
    """Durations, service-level flags and the reopened flag of tickets."""
    created, responded, resolved = (
        F.col("created_at"), F.col("first_response_at"), F.col("resolved_at"),
    )
    return tickets.withColumns(
        {
            "first_response_min": minutes_between(created, responded),
            "resolution_min": minutes_between(created, resolved),
            "sla_response_breached": is_breached(responded, F.col("sla_first_due_at")),
            "sla_resolution_breached": is_breached(resolved, F.col("sla_resolve_due_at")),
            "reopened": is_reopened(F.col("status")),
        }
    )


def fact_ticket(tickets: DataFrame, loaded_orders: DataFrame, loaded_at, *keep: str) -> DataFrame:
    rows = ticket_measures(with_keys(with_region(tickets, loaded_orders), "created_at"))
    rows = rows.withColumns({"ticket_sk": surrogate("ticket_id"), "_loaded_at": loaded_at})
    return conform(rows, "fact_ticket", *keep)


def fact_ticket_event(events: DataFrame, loaded_at, *keep: str) -> DataFrame:
    rows = with_keys(events, "event_ts")
    rows = rows.withColumns({"event_sk": surrogate("event_id"), "_loaded_at": loaded_at})
    return conform(rows, "fact_ticket_event", *keep)


def build_fact(
    entity: Entity, clean: DataFrame, loaded_orders: DataFrame | None, loaded_at, *keep: str
) -> DataFrame:
    """Rows for the entity's fact table; tickets need the loaded orders."""
    if entity.name == "tickets":
        return fact_ticket(clean, loaded_orders, loaded_at, *keep)
    builder = {"orders": fact_order, "ticket_events": fact_ticket_event}[entity.name]
    return builder(clean, loaded_at, *keep)
