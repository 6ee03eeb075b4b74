"""Untyped, faulty source tables derived from the supplied tables.

A fixture is a projection whose expressions mean the same in Spark SQL and
in DuckDB, so both sides of a comparison start from the same rows.  Nothing
is sampled: every row of the base table takes part, faults are injected by
key, and some rows occur twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.cascade import FILE, ROW
from sluice.session import spread
from sluice.spec import ENTITIES, Entity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _case(key: str, default: str, faults: dict[int, str]) -> str:
    """``default``, or a fault on the keys that are a multiple of its number."""
    whens = " ".join(f"WHEN {key} % {m} = 0 THEN {value}" for m, value in faults.items())
    return f"CASE {whens} ELSE {default} END"


@dataclass(frozen=True)
class Fixture:
    entity: str
    source: str
    key: str
    columns: dict[str, str]
    file: str
    #: second table, and the condition that joins it to the source
    join: tuple[str, str] | None = None
    #: rows whose key is a multiple of this come twice, the copy later
    repeat: int | None = None
    #: columns that order rows of one key when nothing is repeated
    order: tuple[str, ...] = ()

    @property
    def spec(self) -> Entity:
        return ENTITIES[self.entity]

    def frame(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        base = spread(table(spark, sf_dir, self.source))
        if self.join:
            base = base.join(table(spark, sf_dir, self.join[0]), F.expr(self.join[1]))
        cells = [f"{e} AS {n}" for n, e in self.columns.items()] + [f"{self.file} AS {FILE}"]
        if self.order:
            return base.selectExpr(*cells, f"struct({', '.join(self.order)}) AS {ROW}")
        rows = base.selectExpr(*cells, f"CAST(0 AS BIGINT) AS {ROW}")
        copies = base.where(f"{self.key} % {self.repeat} = 0").selectExpr(
            *cells, f"CAST(1 AS BIGINT) AS {ROW}"
        )
        return rows.unionByName(copies)

    def sql(self) -> str:
        cells = ", ".join(f"{e} AS {n}" for n, e in self.columns.items())
        cells += f", {self.file} AS {FILE}"
        base = self.source
        if self.join:
            base += f" JOIN {self.join[0]} ON {self.join[1]}"
        if self.order:
            return f"SELECT {cells}, row({', '.join(self.order)}) AS {ROW} FROM {base}"
        return (
            f"SELECT {cells}, CAST(0 AS BIGINT) AS {ROW} FROM {base} UNION ALL "
            f"SELECT {cells}, CAST(1 AS BIGINT) AS {ROW} FROM {base} "
            f"WHERE {self.key} % {self.repeat} = 0"
        )


def _after(ts: str, days: int) -> str:
    return text(f"{ts} + INTERVAL '{days}' DAY")


def _two(expr: str) -> str:
    return f"lpad({text(expr)}, 2, '0')"


def _stamp(key: str, separator: str = " ") -> str:
    return (
        f"'2024-' || {_two(f'1 + {key} % 12')} || '-' || {_two(f'1 + {key} % 28')} || "
        f"'{separator}' || {_two(f'{key} % 24')} || ':' || {_two(f'{key} % 60')} || ':00'"
    )


def _day(key: str) -> str:
    return f"'2023-' || {_two(f'1 + {key} % 12')} || '-' || {_two(f'1 + {key} % 28')}"


def _pick(expr: str, *values: str) -> str:
    whens = " ".join(f"WHEN {expr} % {len(values)} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {whens} END"


def _customers() -> Fixture:
    k = "c_custkey"
    return Fixture(
        "customers", "customer", k,
        {
            "customer_id": _case(k, text(k), {7: f"{text(k)} || '.0'"}),
            "full_name": _case(k, "c_name", {53: "''", 41: "'N/A'"}),
            "email": _case(
                k, f"'user' || {text(k)} || '@example.com'",
                {31: "'notanemail'", 101: "'missing@domain'", 103: "'N/A'"},
            ),
            "phone": _case(
                k, f"'010' || lpad({text(k)}, 8, '0')",
                {29: "'abc12345'", 107: f"'020' || lpad({text(k)}, 8, '0')"},
            ),
            "region_id": _case(k, text("c_nationkey"), {37: "''", 43: "'abc'"}),
            "segment_id": _case(
                k, "CASE WHEN c_mktsegment = 'MACHINERY' THEN '2' ELSE '1' END", {97: "'-1'"}
            ),
            "signup_date": _case(k, _day(k), {59: "'invalid'"}),
            "gender": _case(k, _pick(k, "male", "female"), {47: "'UNKNOWN'", 109: "''"}),
            "created_at": _stamp(k),
            "updated_at": _case(k, _stamp(k, "T"), {61: "'2024/02/30'"}),
        },
        file="'batch/2024-01-01/customers.csv'",
        repeat=50,
    )


def _restaurants() -> Fixture:
    k = "p_partkey"
    return Fixture(
        "restaurants", "part", k,
        {
            "restaurant_id": text(k),
            "restaurant_name": _case(k, "p_name", {53: "''", 41: "' n/a '", 89: "'Null'"}),
            "region_id": text(f"{k} % 25"),
            "category_id": _case(k, text("p_size"), {59: "'nan'"}),
            "price_tier": _case(k, _pick("p_size", "Low", "Mid", "High"), {47: "'UNKNOWN'"}),
            "rating_avg": _case(k, f"{text(f'{k} % 5')} || '.5'", {37: "'6'", 43: "'-1'"}),
            "prep_time_avg_min": _case(k, text("p_size"), {67: "'1e999'", 71: "'-3'"}),
            "is_active": _case(k, _pick(k, "True", "false", "1"), {61: "'yes'", 73: "''"}),
            "created_at": _stamp(k),
            "updated_at": _stamp(k, "T"),
        },
        file="'batch/2024-01-01/restaurants.json'",
        repeat=50,
    )


def _drivers() -> Fixture:
    k = "s_suppkey"
    return Fixture(
        "drivers", "supplier", k,
        {
            "driver_id": text(k),
            "driver_name": _case(k, "s_name", {53: "NULL", 41: "'None'"}),
            "driver_phone": f"'011' || lpad({text(k)}, 8, '0')",
            "national_id": _case(
                k, f"'2' || lpad({text(k)}, 14, '0')", {31: "'123'", 37: "'N/A'"}
            ),
            "region_id": text("s_nationkey"),
            "shift": _case(k, _pick(k, "morning", "evening", "night"), {47: "'noon'"}),
            "vehicle_type": _pick(k, "bike", "car"),
            "hire_date": _day(k),
            "rating_avg": _case(k, f"{text(f'{k} % 5')} || '.25'", {29: "'5.01'"}),
            "on_time_rate": _case(k, f"'0.' || {text(f'{k} % 100')}", {23: "'1.5'"}),
            "cancel_rate": _case(k, "'0.1'", {19: "'-0.5'"}),
            "completed_deliveries": _case(k, text(f"{k} % 500"), {17: "''"}),
            "is_active": "'True'",
            "created_at": _stamp(k),
            "updated_at": _stamp(k),
        },
        file="'batch/2024-01-01/drivers.csv'",
        repeat=50,
    )


def _agents() -> Fixture:
    k = "s_suppkey"
    return Fixture(
        "agents", "supplier", k,
        {
            "agent_id": text(k),
            "agent_name": _case(k, "s_name", {53: "'   '"}),
            "agent_email": _case(k, f"'agent' || {text(k)} || '@example.com'", {31: "'a@b.org'"}),
            "agent_phone": f"'015' || lpad({text(k)}, 8, '0')",
            "team_id": _case(k, text(f"{k} % 5"), {37: "''"}),
            "skill_level": _pick(k, "Junior", "Mid", "Senior", "Lead"),
            "hire_date": _day(k),
            "avg_handle_time_min": text(f"{k} % 30"),
            "resolution_rate": f"'0.' || {text(f'{k} % 100')}",
            "csat_score": _case(k, f"{text(f'{k} % 5')} || '.0'", {29: "'-2'"}),
            "is_active": _pick(k, "1", "0"),
            "created_at": _stamp(k),
            "updated_at": _stamp(k),
        },
        file="'batch/2024-01-01/agents.csv'",
        repeat=50,
    )


def _orders() -> Fixture:
    k = "o_orderkey"
    price = text("o_totalprice")
    return Fixture(
        "orders", "orders", k,
        {
            "order_id": text(k),
            "customer_id": _case(
                k, text("o_custkey"),
                {61: "'999999999'", 67: "''", 101: "'3.7'", 7: f"{text('o_custkey')} || '.0'"},
            ),
            "restaurant_id": _case(k, text(f"{k} % 200"), {89: "'888888888'"}),
            "driver_id": text(f"{k} % 10"),
            "region_id": text(f"{k} % 25"),
            "order_amount": _case(k, price, {71: f"'-' || {price}", 73: "'abc'"}),
            "delivery_fee": f"{text(f'{k} % 9')} || '.25'",
            "discount_amount": "'0'",
            "total_amount": price,
            "order_status": _case(
                k,
                "CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Pending' "
                "ELSE 'OutForDelivery' END",
                {79: "'invalid'"},
            ),
            "payment_method": _case(k, _pick(k, "card", "cash", "wallet"), {97: "'N/A'"}),
            "order_created_at": _case(k, text("o_orderdate"), {83: "'N/A'"}),
            "delivered_at": (
                "CASE WHEN o_orderstatus = 'O' THEN '' "
                f"ELSE {_after('o_orderdate', 1)} END"
            ),
        },
        file=f"'stream/' || substr({text('o_orderdate')}, 1, 7) || '/orders.json'",
        repeat=50,
    )


def _tickets() -> Fixture:
    k = "l_orderkey"
    return Fixture(
        "tickets", "lineitem", k,
        {
            "ticket_id": f"{text(k)} || '-' || {text('l_linenumber')}",
            "order_id": text(k),
            "customer_id": text("o_custkey"),
            "driver_id": text(f"{k} % 10"),
            "restaurant_id": text("l_partkey"),
            "agent_id": _case("l_partkey", text("l_suppkey"), {61: "'999999'"}),
            "reason_id": text("l_linenumber"),
            "priority_id": text(f"1 + {k} % 4"),
            "channel_id": text("1 + l_partkey % 4"),
            "status": (
                "CASE WHEN l_linenumber = 7 THEN 'Reopened' WHEN l_returnflag = 'A' THEN 'Closed' "
                "WHEN l_returnflag = 'N' THEN 'Open' ELSE 'Resolved' END"
            ),
            "refund_amount": _case("l_partkey", text("l_extendedprice"), {59: "'-5'"}),
            "created_at": text("o_orderdate"),
            "first_response_at": _case("l_partkey", text("l_shipdate"), {83: "''"}),
            "resolved_at": _after("l_shipdate", 7),
            "sla_first_due_at": _after("o_orderdate", 30),
            "sla_resolve_due_at": _after("o_orderdate", 60),
        },
        file=f"'stream/' || substr({text('o_orderdate')}, 1, 7) || '/tickets.csv'",
        join=("orders", "l_orderkey = o_orderkey"),
        order=(
            "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_shipdate", "l_returnflag", "l_linestatus",
        ),
    )


STATUS_OF_EVENT = (
    "CASE event_type WHEN 'signup' THEN 'Open' WHEN 'view' THEN 'InProgress' "
    "WHEN 'click' THEN 'Resolved' WHEN 'purchase' THEN 'Closed' ELSE 'Reopened' END"
)


def _ticket_events() -> Fixture:
    k = "event_id"
    return Fixture(
        "ticket_events", "events", k,
        {
            "event_id": text(k),
            "ticket_id": _case(k, text("user_id"), {71: "'nowhere'", 73: "NULL"}),
            "agent_id": _case(k, text(f"{k} % 10"), {67: "NULL"}),
            "event_ts": text("ts"),
            "old_status": (
                f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE "
                f"{_pick('user_id', 'Open', 'InProgress', 'Resolved', 'Closed', 'Reopened')} END"
            ),
            "new_status": _case(k, STATUS_OF_EVENT, {89: "'N/A'", 97: "NULL"}),
            "notes": "props",
        },
        file=f"'stream/' || substr({text('ts')}, 1, 10) || '/ticket_events.json'",
        repeat=50,
    )


_BUILDERS: tuple[Callable[[], Fixture], ...] = (
    _customers, _restaurants, _drivers, _agents, _orders, _tickets, _ticket_events,
)
FIXTURES: dict[str, Fixture] = {f.entity: f for f in (b() for b in _BUILDERS)}


def _small(entity: str, source: str, key: str, **columns: str) -> Fixture:
    name = ENTITIES[entity].name
    return Fixture(
        entity, source, key, {ENTITIES[entity].key: text(key), **columns},
        file=f"'master/{name}.csv'", repeat=50,
    )


def _lookups() -> tuple[Fixture, ...]:
    """The dimensions that others refer to, from tables that grow with the data."""
    c, p, s, o, e = "c_custkey", "p_partkey", "s_suppkey", "o_orderkey", "event_id"
    level = "substr(o_orderpriority, 1, 1)"
    return (
        _small(
            "cities", "customer", c,
            city_name=_case(c, "c_name", {53: "''", 41: "'n/a'"}),
            country=_case(c, "c_mktsegment", {59: "NULL"}),
            timezone=f"'UTC+' || {text(f'{c} % 12')}",
        ),
        _small(
            "regions", "supplier", s,
            region_name=_case(s, "s_name", {53: "'none'"}),
            # some cities do not exist, some did not pass
            city_id=_case(s, text(f"{s} * 13"), {37: "''", 7: "'-1'"}),
            delivery_base_fee=_case(s, text("s_acctbal"), {31: "'free'"}),
        ),
        _small(
            "segments", "customer", c,
            segment_name=_case(c, _pick(c, "Regular", "VIP"), {47: "'Gold'"}),
            discount_pct=_case(c, text(f"{c} % 30"), {53: "'x'", 61: "''"}),
            priority_support=_case(c, _pick(c, "True", "0", "false"), {67: "'yes'"}),
        ),
        _small("categories", "part", p, category_name=_case(p, "p_brand", {43: "' NA '"})),
        _small("teams", "supplier", s, team_name=_case(s, "s_name", {29: "NULL"})),
        _small(
            "reason_categories", "part", p,
            category_name=_case(p, _pick(p, "Delivery", "Food", "Payment"), {41: "'Other'"}),
        ),
        _small(
            "reasons", "part", p,
            reason_name="p_name",
            # some categories do not exist, some did not pass
            reason_category_id=_case(p, text("p_size"), {59: "'99999999'", 61: "'nan'"}),
            severity_level=_case(p, text(f"{p} % 5"), {37: "'3.0'", 43: "'high'"}),
            typical_refund_pct=text("p_retailprice / 8"),
        ),
        _small(
            "channels", "events", e,
            channel_name=_case(e, _pick(e, "app", "chat", "phone", "email"), {71: "'fax'", 73: "NULL"}),
        ),
        _small(
            "priorities", "orders", o,
            priority_code=_case(o, f"CASE WHEN {level} = '5' THEN 'P4' ELSE 'P' || {level} END", {79: "'P9'"}),
            priority_name=_pick(o, "Critical", "High", "Medium", "Low"),
            sla_first_response_min=_case(o, text(f"{o} % 60"), {83: "''"}),
            sla_resolution_min=text(f"{o} % 600"),
        ),
    )


LOOKUPS: dict[str, Fixture] = {f.entity: f for f in _lookups()}
#: fixtures of all 16 entities
EVERY: dict[str, Fixture] = LOOKUPS | FIXTURES

#: key columns of the tables the facts refer to; every fiftieth customer and
#: ticket has not arrived yet
PARENTS: dict[str, dict[str, tuple[str, str, str]]] = {
    "orders": {
        "customers": ("customer", "c_custkey", "c_custkey % 50 <> 0"),
        "drivers": ("supplier", "s_suppkey", "true"),
        "restaurants": ("part", "p_partkey", "true"),
    },
    "tickets": {
        "orders": ("orders", "o_orderkey", "o_orderkey % 50 <> 0"),
        "agents": ("supplier", "s_suppkey", "true"),
    },
    "ticket_events": {
        "tickets": ("customer", "c_custkey", "c_custkey % 50 <> 0"),
    },
}


def parent_frames(spark: SparkSession, sf_dir: str, entity: str) -> dict[str, DataFrame]:
    frames = {}
    for name, (source, key, arrived) in PARENTS.get(entity, {}).items():
        spec = ENTITIES[name]
        as_type = "STRING" if spec.column(spec.key).dtype == "str" else "BIGINT"
        frames[name] = (
            table(spark, sf_dir, source)
            .where(arrived)
            .selectExpr(f"CAST({key} AS {as_type}) AS {spec.key}")
        )
    return frames
