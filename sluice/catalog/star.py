"""Queries on dimensions, facts, lookups, hashing and service levels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.catalog.fixtures import EVERY, FIXTURES, STATUS_OF_EVENT, parent_frames, table
from sluice.catalog.registry import register
from sluice.catalog.rules_sql import cast_sql, schema_cases, tagged_ctes, when
from sluice.functions.pii import mask
from sluice.functions.times import date_key, time_key
from sluice.operators.cascade import clean_rows, tag
from sluice.operators.insert import absent_rows, append_new
from sluice.operators.schema import typed, typed_passed
from sluice.plans.analytics import (
    breached_tickets,
    sla_compliance_by_agent,
    sla_performance,
    status_transitions,
)
from sluice.plans.calendar import FIRST_DAY, dim_date, dim_time
from sluice.plans.dims import build_dimension, with_city_name, with_reason_category
from sluice.plans.facts import build_fact
from sluice.sources.warehouse import table_schema

LOADED_AT = "2024-06-01 00:00:00"


def loaded_at():
    return F.lit(LOADED_AT).cast("timestamp_ntz")


# ---------------------------------------------------------------- tickets

TICKET_CELLS = {
    "ticket_id": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "agent_id": "l_suppkey",
    "created_at": "o_orderdate",
    "first_response_at": "CASE WHEN l_partkey % 83 <> 0 THEN l_shipdate END",
    "resolved_at": "l_shipdate + INTERVAL '7' DAY",
    "sla_first_due_at": "o_orderdate + INTERVAL '30' DAY",
    "sla_resolve_due_at": "o_orderdate + INTERVAL '60' DAY",
}


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as tickets of their order, answered when they ship."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    return lines.join(orders, F.expr("l_orderkey = o_orderkey")).selectExpr(
        *[f"{e} AS {n}" for n, e in TICKET_CELLS.items()]
    )


_PERFORMANCE = f"""WITH t AS (SELECT {', '.join(f'{e} AS {n}' for n, e in TICKET_CELLS.items())}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
  v AS (SELECT ticket_id, agent_id, created_at, first_response_at, sla_first_due_at, resolved_at,
    sla_resolve_due_at,
    coalesce(first_response_at <= sla_first_due_at, false) AS is_first_response_met,
    coalesce(resolved_at <= sla_resolve_due_at, false) AS is_resolution_met
    FROM t) """


@register("sla_performance_view", _PERFORMANCE + "SELECT * FROM v")
def sla_performance_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla_performance(tickets(spark, sf_dir))


def _compliance_sql(where: str = "") -> str:
    return _PERFORMANCE + f"""SELECT agent_id, count(*) AS total_tickets,
        count(*) FILTER (WHERE is_first_response_met) AS first_response_met,
        count(*) FILTER (WHERE is_resolution_met) AS resolution_met,
        round(100.0 * count(*) FILTER (WHERE is_first_response_met)
            / CAST(nullif(count(*), 0) AS DOUBLE), 2) AS first_response_rate_pct
        FROM v {where} GROUP BY agent_id"""


@register("sla_compliance_by_agent", _compliance_sql())
def compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla_compliance_by_agent(sla_performance(tickets(spark, sf_dir)))


@register(
    "sla_compliance_on_day", _compliance_sql("WHERE CAST(created_at AS DATE) = DATE '1997-05-28'")
)
def compliance_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla_compliance_by_agent(sla_performance(tickets(spark, sf_dir)), date(1997, 5, 28))


@register(
    "sla_breached_tickets",
    _PERFORMANCE
    + """SELECT ticket_id, agent_id, created_at, sla_first_due_at, first_response_at,
        CAST(floor(greatest(0, coalesce(
            date_diff('microsecond', sla_first_due_at, first_response_at), 0)) / 6e7)
            AS BIGINT) AS minutes_over_sla
        FROM v WHERE NOT is_first_response_met""",
)
def breached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breached_tickets(sla_performance(tickets(spark, sf_dir)))


# ------------------------------------------------------------ dimensions


def schema_passed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Typed rows of a fixture past the schema stage."""
    f = FIXTURES[name]
    return typed_passed(f.frame(spark, sf_dir), f.spec)


def _passed_cte(name: str) -> str:
    f = FIXTURES[name]
    cells = ", ".join(f"{cast_sql(f.spec, n)} AS {n}" for n in f.spec.names)
    return (
        f"src AS ({f.sql()}), ok AS (SELECT {cells} FROM src "
        f"WHERE {when(schema_cases(f.spec))} IS NULL)"
    )


def hashed_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' OR lower(trim({c})) = 'n/a' THEN {c} "
        f"ELSE sha256({c}) END"
    )


SQL_TYPES = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


def conformed_sql(name: str, source: str, computed: dict[str, str] | None = None) -> str:
    """Columns of the entity's table over typed rows, without the load time."""
    entity = EVERY[name].spec
    cells = []
    for f in table_schema(entity.table).fields:
        if f.name == "_loaded_at" or f.name.endswith("_sk"):
            continue
        c = (computed or {}).get(f.name, f.name)
        kind = SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
        if f.name in entity.pii:
            c = hashed_sql(f"CAST({c} AS VARCHAR)")
        elif kind == "INTEGER" and f.name in entity.names and entity.column(f.name).dtype == "float":
            c = f"round({c})"
        cells.append(f"CAST({c} AS {kind}) AS {f.name}")
    return f"SELECT {', '.join(cells)} FROM {source}"


def _register_dimension(name: str) -> None:
    entity = FIXTURES[name].spec

    @register(f"{entity.table}_build", f"WITH {_passed_cte(name)} {conformed_sql(name, 'ok')}")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = mask(schema_passed(spark, sf_dir, name), entity)
        return build_dimension(entity, rows, None, loaded_at()).drop("_loaded_at")


for _name in ("customers", "restaurants", "drivers", "agents"):
    _register_dimension(_name)


@register(
    "pii_masked_customers",
    f"WITH src AS ({FIXTURES['customers'].sql()}) SELECT customer_id, full_name, "
    f"{hashed_sql('email')} AS email, {hashed_sql('phone')} AS phone FROM src",
)
def pii_masked_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = FIXTURES["customers"]
    return mask(f.frame(spark, sf_dir), f.spec).select("customer_id", "full_name", "email", "phone")


@register(
    "region_city_lookup",
    """SELECT c_custkey AS customer_id, n_name AS region_name, r_name AS city_name
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) r ON n_regionkey = r_regionkey""",
)
def region_city_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the city of their region, one city missing."""
    regions = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey AS region_id", "n_name AS region_name", "n_regionkey AS city_id"
    )
    cities = (
        table(spark, sf_dir, "region")
        .where("r_regionkey <> 2")
        .selectExpr("r_regionkey AS city_id", "r_name AS city_name")
    )
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id", "c_nationkey AS region_id"
    )
    return customers.join(with_city_name(regions, cities), "region_id", "left").select(
        "customer_id", "region_name", "city_name"
    )


@register(
    "reason_category_lookup",
    """WITH last AS (SELECT p_size, arg_max(p_type, p_partkey) AS category_name FROM part
           WHERE p_size % 7 <> 0 GROUP BY p_size)
       SELECT p_partkey AS reason_id, p.p_size AS reason_category_id, category_name
           AS reason_category FROM part p LEFT JOIN last ON p.p_size = last.p_size""",
)
def reason_category_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as reasons, sizes as their categories; the last name of a category counts."""
    part = table(spark, sf_dir, "part")
    categories = part.where("p_size % 7 <> 0").selectExpr(
        "p_size AS reason_category_id", "p_type AS category_name", "p_partkey AS place"
    )
    reasons = part.selectExpr("p_partkey AS reason_id", "p_size AS reason_category_id")
    return with_reason_category(reasons, categories, "place")


@register(
    "orders_by_calendar_day",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS orders,
           CAST(round(sum(CAST(o_totalprice AS DECIMAL(18,2))), 2) AS DECIMAL(18,2)) AS amount
           FROM orders GROUP BY 1)
       SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
         CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
         CAST(month(d) AS SMALLINT) AS month, monthname(d) AS month_name,
         CAST(weekofyear(d) AS SMALLINT) AS week, CAST(dayofweek(d) + 1 AS SMALLINT) AS day_of_week,
         CAST(day(d) AS SMALLINT) AS day_of_month, CAST(dayofyear(d) AS SMALLINT) AS day_of_year,
         dayname(d) AS day_name, orders, amount FROM d""",
)
def orders_by_calendar_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day with the calendar's attributes; summed before they meet the calendar."""
    per_day = (
        table(spark, sf_dir, "orders")
        .groupBy(date_key(F.col("o_orderdate")).alias("date_key"))
        .agg(
            F.count("*").alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("amount"),
        )
    )
    # the calendar spans the orders' own days, so none is dropped
    span = table(spark, sf_dir, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
    ).first()
    first = span["first"] or FIRST_DAY
    return dim_date(spark, first, span["last"] or first).join(per_day, "date_key")


@register(
    "events_by_clock_minute",
    """WITH m AS (SELECT hour(ts) AS h, minute(ts) AS mi, count(*) AS events FROM events GROUP BY 1, 2),
         s(begins, shift) AS (VALUES (0, 'night'), (6, 'morning'), (14, 'evening'), (22, 'night'))
       SELECT CAST(h * 100 + mi AS INTEGER) AS time_key,
         lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(mi AS VARCHAR), 2, '0') || ':00'
           AS full_time,
         CAST(h AS SMALLINT) AS hour, CAST(mi AS SMALLINT) AS minute,
         strftime(TIMESTAMP '2000-01-01' + to_hours(h), '%p') AS am_pm, s.shift, events
         FROM m ASOF JOIN s ON m.h >= s.begins""",
)
def events_by_clock_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_minute = (
        table(spark, sf_dir, "events")
        .groupBy(time_key(F.col("ts")).alias("time_key"))
        .agg(F.count("*").alias("events"))
    )
    return dim_time(spark).join(per_minute, "time_key")


# ----------------------------------------------------------------- facts


def _clean_cte(name: str) -> str:
    entity = FIXTURES[name].spec
    cells = ", ".join(f"{cast_sql(entity, n)} AS {n}" for n in entity.names)
    return (
        f"{tagged_ctes(name)}, ok AS (SELECT {cells} FROM tagged WHERE reject_stage IS NULL)"
    )


def _keys(ts: str) -> dict[str, str]:
    return {
        "date_key": f"strftime({ts}, '%Y%m%d')",
        "time_key": f"hour({ts}) * 100 + minute({ts})",
    }


def _minutes(a: str, b: str) -> str:
    return f"round(date_diff('microsecond', {a}, {b}) / 6e7, 2)"


_FACT_CELLS = {
    "orders": {**_keys("order_created_at"), "created_at": "order_created_at"},
    "tickets": {
        **_keys("created_at"),
        "region_id": "_region",
        "first_response_min": _minutes("created_at", "first_response_at"),
        "resolution_min": _minutes("created_at", "resolved_at"),
        "sla_response_breached": "coalesce(first_response_at > sla_first_due_at, true)",
        "sla_resolution_breached": "coalesce(resolved_at > sla_resolve_due_at, true)",
        "reopened": "coalesce(trim(status) = 'Reopened', false)",
    },
    "ticket_events": _keys("event_ts"),
}

LOADED_ORDERS = "o_orderkey % 50 <> 0"


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded so far: all but the late ones, some of unknown region."""
    return (
        table(spark, sf_dir, "orders")
        .where(LOADED_ORDERS)
        .selectExpr(
            "CAST(o_orderkey AS STRING) AS order_id",
            "CASE WHEN o_orderkey % 25 <> 7 THEN CAST(o_orderkey % 25 AS INT) END AS region_id",
        )
    )


_LOOKED_UP = f"""(SELECT ok.*, CASE WHEN o_orderkey % 25 <> 7 THEN o_orderkey % 25 END AS _region
    FROM ok LEFT JOIN (SELECT o_orderkey FROM orders WHERE {LOADED_ORDERS}) lo
    ON ok.order_id = CAST(o_orderkey AS VARCHAR))"""


def _register_fact(name: str) -> None:
    fixture = FIXTURES[name]
    entity = fixture.spec
    source = _LOOKED_UP if name == "tickets" else "ok"

    @register(
        f"{entity.table}_build",
        f"WITH {_clean_cte(name)} {conformed_sql(name, source, _FACT_CELLS[name])}",
    )
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        tagged = tag(fixture.frame(spark, sf_dir), entity, parent_frames(spark, sf_dir, name))
        rows = typed(clean_rows(tagged), entity)
        orders = loaded_orders(spark, sf_dir) if name == "tickets" else None
        fact = build_fact(entity, rows, orders, loaded_at())
        return fact.drop("_loaded_at", *[c for c in fact.columns if c.endswith("_sk")])


for _name in ("orders", "tickets", "ticket_events"):
    _register_fact(_name)

_OLD_STATUS = FIXTURES["ticket_events"].columns["old_status"]


@register(
    "status_transitions",
    f"""WITH e AS (SELECT {_OLD_STATUS} AS old_status, {STATUS_OF_EVENT} AS new_status FROM events)
        SELECT old_status, new_status, count(*) AS transitions FROM e GROUP BY 1, 2""",
)
def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = table(spark, sf_dir, "events").selectExpr(
        f"{_OLD_STATUS} AS old_status", f"{STATUS_OF_EVENT} AS new_status"
    )
    return status_transitions(moves)


# --------------------------------------------------------------- inserts

_OLD = "SELECT c_custkey AS customer_id, 'first' AS full_name FROM customer WHERE c_custkey % 3 <> 0"
_NEW = """SELECT c_custkey AS customer_id, c_name AS full_name FROM customer"""


def _old_and_new(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = table(spark, sf_dir, "customer")
    old = customer.where("c_custkey % 3 <> 0").selectExpr(
        "c_custkey AS customer_id", "'first' AS full_name"
    )
    new = customer.selectExpr("c_custkey AS customer_id", "c_name AS full_name", "0L AS place")
    again = customer.where("c_custkey % 6 = 0").selectExpr(
        "c_custkey AS customer_id", "'again' AS full_name", "1L AS place"
    )
    return old, new.unionByName(again)


@register("insert_if_absent", _NEW + " WHERE c_custkey % 3 = 0")
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return absent_rows(new, old, "customer_id", "place").drop("place")


@register("append_new_to_master", f"{_OLD} UNION ALL {_NEW} WHERE c_custkey % 3 = 0")
def append_new_to_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new(spark, sf_dir)
    return append_new(old, new, "customer_id", "place")
