"""Queries that keep state over the supplied tables: waiting orphans, status moves, kept figures, open rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.catalog.fixtures import STATUS_OF_EVENT, _pick, table
from sluice.catalog.operations import missing_sql, quarantine_cte, quarantine_of
from sluice.catalog.registry import register
from sluice.catalog.star import _compliance_sql, tickets
from sluice.plans.dims import conform
from sluice.plans.open_set import retry_arrivals
from sluice.plans.retry import PROMOTED, RESOLVED, WAITING
from sluice.session import scratch_path
from sluice.sources.warehouse import Warehouse
from sluice.streaming import figures, status, waiting

# ------------------------------------------------- orphans in event time

#: hours an orphan waits, minutes a row may be late
WAIT, LATE = 720, 90
#: late parents of orders: edge, key of the order, table, key and time of arrival; others were always there
LATE_PARENTS = (
    (
        "customer_id", "CASE WHEN o_orderkey % 61 = 0 THEN -1 ELSE o_custkey END",
        "customer", "c_custkey", "TIMESTAMP '1995-06-01 00:30:00' + make_days(c_custkey % 700)", 9,
    ),
    (
        "driver_id", "o_orderkey % 10",
        "supplier", "s_suppkey", "TIMESTAMP '1996-01-01 00:30:00' + make_days(s_suppkey * 37 % 400)", 3,
    ),
)


def _spark(sql: str) -> str:
    return sql.replace("TIMESTAMP '", "TIMESTAMP_NTZ '").replace("make_days(", "make_dt_interval(")


def _late_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        table(spark, sf_dir, name).where(f"{key} % {every} = 0").selectExpr(
            f"'{edge}' AS edge", f"CAST({key} AS STRING) AS key", f"{_spark(at)} AS arrived_at"
        )
        for edge, _, name, key, at, every in LATE_PARENTS
    ]
    return parts[0].unionByName(parts[1])


def _missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The missing keys of orders whose parents come later, or never, one row each."""
    orders, rows = table(spark, sf_dir, "orders"), None
    for edge, child, _, _, _, every in LATE_PARENTS:
        part = orders.where(f"({child}) % {every} = 0 OR ({child}) < 0").selectExpr(
            "CAST(o_orderkey AS STRING) AS quarantine_id", f"'{edge}' AS edge",
            f"CAST({child} AS STRING) AS key", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS quarantined_at",
        )
        rows = part if rows is None else rows.unionByName(part)
    late = _late_parents(spark, sf_dir)
    missing = rows.join(late, ["edge", "key"], "left").where("arrived_at IS NULL OR quarantined_at < arrived_at")
    n_keys = missing.groupBy("quarantine_id").agg(F.count("*").cast("int").alias("n_keys"))
    return missing.drop("arrived_at").join(n_keys, "quarantine_id")


def _missing_sql() -> str:
    parents = " UNION ALL ".join(
        f"SELECT '{edge}' AS edge, CAST({key} AS VARCHAR) AS key, "
        f"{at.replace('make_days(', 'to_days(CAST(').replace('700)', '700 AS INTEGER))').replace('400)', '400 AS INTEGER))')} AS arr "
        f"FROM {name} WHERE {key} % {every} = 0"
        for edge, _, name, key, at, every in LATE_PARENTS
    )
    rows = " UNION ALL ".join(
        f"SELECT CAST(o_orderkey AS VARCHAR) AS id, '{edge}' AS edge, CAST({child} AS VARCHAR) AS key, "
        f"CAST(o_orderdate AS TIMESTAMP) AS q FROM orders WHERE ({child}) % {every} = 0 OR ({child}) < 0"
        for edge, child, _, _, _, every in LATE_PARENTS
    )
    return f"p AS ({parents}), k AS (SELECT r.*, arr FROM ({rows}) r LEFT JOIN p USING (edge, key) WHERE arr IS NULL OR q < arr)"


@register(
    "orphans_in_event_time",
    f"""WITH {_missing_sql()},
    w AS (SELECT least((SELECT max(q) FROM k), (SELECT max(arr) FROM p)) - INTERVAL '{LATE}' MINUTE AS mark),
    v AS (SELECT id, edge, CASE WHEN arr <= q + INTERVAL '{WAIT}' HOUR THEN arr END AS met,
        q + INTERVAL '{WAIT}' HOUR < mark AS over FROM k, w),
    r AS (SELECT id, count(*) AS n, count(met) AS found, max(met) AS last_arrival,
        min(edge) FILTER (WHERE met IS NULL AND over) AS unresolved_fk FROM v GROUP BY id)
    SELECT id AS order_id, CASE WHEN unresolved_fk IS NOT NULL THEN '{PROMOTED}' WHEN found = n THEN '{RESOLVED}'
        ELSE '{WAITING}' END AS outcome, unresolved_fk, last_arrival FROM r""",
)
def orphans_in_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose parents come later, as two streams; what is undecided at their end waits."""
    folder = scratch_path(spark, "waiting")
    at = F.col("quarantined_at").cast("timestamp")
    keys = _missing_keys(spark, sf_dir).withColumn("quarantined_at", at)
    keys.select("quarantine_id", "edge", "key", "n_keys", "quarantined_at").write.parquet(f"{folder}/orphans")
    late = _late_parents(spark, sf_dir).withColumn("arrived_at", F.col("arrived_at").cast("timestamp"))
    late.write.parquet(f"{folder}/parents")
    waiting.stream_verdicts(
        spark, f"{folder}/orphans", f"{folder}/parents", f"{folder}/verdicts", f"{folder}/checkpoint",
        wait=f"{WAIT} hours", lateness=f"{LATE} minutes",
    ).awaitTermination()
    decided = waiting.row_verdicts(spark.read.parquet(f"{folder}/verdicts"))
    every = spark.read.parquet(f"{folder}/orphans").select("quarantine_id").distinct()
    return every.join(decided, "quarantine_id", "left").select(
        F.col("quarantine_id").alias("order_id"), F.coalesce("outcome", F.lit(WAITING)).alias("outcome"),
        "unresolved_fk", F.col("last_arrival").cast("timestamp_ntz").alias("last_arrival"),
    )


# ---------------------------------------------------------- status moves

_OLD_STATUS = (
    f"CASE WHEN event_id % 3 = 0 THEN NULL ELSE "
    f"{_pick('event_id', 'Open', 'InProgress', 'Resolved', 'Closed', 'Reopened')} END"
)
_EVENT_CELLS = {
    "event_id": "CAST(event_id AS STRING)",
    "ticket_id": "CAST(user_id AS STRING)",
    "event_ts": "ts",
    "old_status": _OLD_STATUS,
    "new_status": STATUS_OF_EVENT,
}
_MOVES = f"""WITH e AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _EVENT_CELLS.items())} FROM events),
  w AS (SELECT max(epoch_ms(event_ts)) - 3600000 AS mark FROM e
        WHERE ticket_id IS NOT NULL AND event_id IS NOT NULL),
  m AS (SELECT e.*, lag(new_status) OVER t AS known_status, row_number() OVER t = 1 AS is_first
        FROM e WHERE ticket_id IS NOT NULL AND event_id IS NOT NULL AND event_ts IS NOT NULL
        WINDOW t AS (PARTITION BY ticket_id ORDER BY event_ts, event_id)),
  moved AS (SELECT m.*, old_status IS DISTINCT FROM known_status AS is_broken
        FROM m, w WHERE epoch_ms(event_ts) < mark) """


def _moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moves of all events that the watermark passes when the stream has read them."""
    folder = scratch_path(spark, "moves")
    rows = table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in _EVENT_CELLS.items()])
    rows = rows.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    rows.write.parquet(f"{folder}/events")
    status.stream_moves(spark, f"{folder}/events", f"{folder}/moves", f"{folder}/checkpoint").awaitTermination()
    moved = spark.read.schema(status.MOVE).parquet(f"{folder}/moves")
    return moved.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@register("status_moves_stream", _MOVES + "SELECT * FROM moved")
def status_moves_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the status its ticket had, by keyed state; what the watermark has not passed waits."""
    return _moved(spark, sf_dir)


@register(
    "status_moves_broken",
    _MOVES + """SELECT known_status, old_status, count(*) AS events, count(DISTINCT ticket_id) AS tickets
        FROM moved WHERE is_broken GROUP BY 1, 2""",
)
def status_moves_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status.broken_moves(_moved(spark, sf_dir))


# ---------------------------------------------------------- kept figures


@register("sla_compliance_maintained", _compliance_sql())
def sla_compliance_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compliance report from counts kept up over three loads of tickets, one of them repeated."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse")).create()
    rows = conform(tickets(spark, sf_dir), "fact_ticket")
    part = F.pmod(F.xxhash64("ticket_id"), F.lit(3))
    checkpoint = scratch_path(spark, "figures")
    for load in (0, 1, 0, 2):
        warehouse.write_load("fact_ticket", rows.where(part == load), f"load-{load}")
        figures.keep_figures(spark, warehouse, checkpoint).awaitTermination()
    report = figures.compliance(warehouse.read(figures.TABLE))
    return report.withColumn("agent_id", F.col("agent_id").cast("bigint"))


# ------------------------------------------------- retry by arrivals

#: two runs and the hours after which an orphan is given up; more customers come between the runs
RUNS, GIVEN_UP = (datetime(1996, 1, 1), datetime(1997, 1, 1)), 24 * 730
THERE = ("c_custkey % 50 <> 0", "c_custkey % 100 <> 0")


def _outcome_sql(n: int, missing: str) -> str:
    old = f"quarantined_at < TIMESTAMP '{RUNS[n]}' - INTERVAL '{GIVEN_UP}' HOUR"
    return f"""CASE WHEN rejection_stage = 'orphan' AND {missing} IS NULL THEN '{RESOLVED}'
        WHEN {old} THEN '{PROMOTED}' END"""


@register(
    "retry_by_arrivals",
    f"""WITH {quarantine_cte('orders')},
    met AS (SELECT *, {missing_sql('orders', customers=THERE[0])} AS m1, {missing_sql('orders', customers=THERE[1])} AS m2 FROM q),
    runs AS (SELECT *, {_outcome_sql(0, 'm1')} AS o1, {_outcome_sql(1, 'm2')} AS o2 FROM met)
    SELECT quarantine_id, rejection_stage, coalesce(o1, o2, 'open') AS outcome,
      CASE WHEN o1 IS NOT NULL THEN CAST(TIMESTAMP '{RUNS[0]}' AS DATE) WHEN o2 IS NOT NULL THEN CAST(TIMESTAMP '{RUNS[1]}' AS DATE) END AS acted_on,
      CASE WHEN coalesce(o1, o2) = '{PROMOTED}' THEN CASE WHEN rejection_stage <> 'orphan' THEN rejection_stage
        WHEN o1 IS NOT NULL THEN m1 ELSE m2 END END AS unresolved_fk FROM runs""",
)
def retry_by_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected orders after two runs of the retry that meets new parents only."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse")).create()

    def load(name: str, source: str, key: str, column: str, where: str, batch: str) -> None:
        rows = table(spark, sf_dir, source).where(where).selectExpr(f"CAST({key} AS INT) AS {column}")
        warehouse.write_load(name, conform(rows, name), batch)

    load("dim_customer", "customer", "c_custkey", "customer_id", THERE[0], "first")
    load("dim_driver", "supplier", "s_suppkey", "driver_id", "true", "first")
    load("dim_restaurant", "part", "p_partkey", "restaurant_id", "true", "first")
    warehouse.write_load("quarantine", quarantine_of(spark, sf_dir, "orders"), "orders")
    retry_arrivals(spark, warehouse, "one", RUNS[0], orphan_hours=GIVEN_UP)
    load("dim_customer", "customer", "c_custkey", "customer_id", f"{THERE[1]} AND NOT ({THERE[0]})", "more")
    retry_arrivals(spark, warehouse, "two", RUNS[1], orphan_hours=GIVEN_UP)
    acted = warehouse.read("quarantine_action").select(
        "quarantine_id", "action", F.to_date("acted_at").alias("acted_on")
    )
    lost = warehouse.read("true_orphan").select("quarantine_id", "unresolved_fk")
    rows = warehouse.read("quarantine").select("quarantine_id", "rejection_stage")
    return rows.join(acted, "quarantine_id", "left").join(lost, "quarantine_id", "left").select(
        "quarantine_id", "rejection_stage", F.coalesce("action", F.lit("open")).alias("outcome"),
        "acted_on", "unresolved_fk",
    )
