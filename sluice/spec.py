"""Declared entities: source columns, keys, edges and warehouse targets.

One specification drives reading, typing, validation, foreign-key checks,
hashing, loading and retrying.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import types as T

BATCH, STREAM = "batch", "stream"

SPARK_TYPES = {
    "str": T.StringType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
    "datetime": T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    dtype: str
    required: bool = False
    allowed: tuple[str, ...] = ()
    #: integers are bounded by the 32-bit warehouse columns unless wide
    wide: bool = False


@dataclass(frozen=True)
class ForeignKey:
    column: str
    entity: str


@dataclass(frozen=True)
class Entity:
    name: str
    file: str
    kind: str
    table: str
    key: str
    columns: tuple[Column, ...]
    #: edges whose violation quarantines a row
    foreign_keys: tuple[ForeignKey, ...] = ()
    #: further edges of the star, reported but not enforced on load
    references: tuple[ForeignKey, ...] = ()
    pii: tuple[str, ...] = ()
    null_exempt: tuple[str, ...] = ()
    _by_name: dict[str, Column] = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self) -> None:
        self._by_name.update({c.name: c for c in self.columns})
        if self.kind not in (BATCH, STREAM):
            raise ValueError(f"{self.name}: unknown kind {self.kind!r}")
        if self.key not in self._by_name:
            raise ValueError(f"{self.name}: key {self.key!r} is not a column")

    @property
    def format(self) -> str:
        return self.file.rsplit(".", 1)[-1].lower()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        return self._by_name[name]

    def of_type(self, *dtypes: str) -> list[Column]:
        return [c for c in self.columns if c.dtype in dtypes]

    @property
    def required(self) -> list[Column]:
        return [c for c in self.columns if c.required]

    @property
    def categorical(self) -> list[Column]:
        return [c for c in self.columns if c.allowed]

    @property
    def edges(self) -> tuple[ForeignKey, ...]:
        return self.foreign_keys + self.references

    def raw_schema(self) -> T.StructType:
        """All cells as strings: nothing is inferred on read."""
        return T.StructType([T.StructField(c.name, T.StringType()) for c in self.columns])

    def typed_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(
                    c.name,
                    SPARK_TYPES[c.dtype],
                    metadata={"required": c.required, "allowed": list(c.allowed)},
                )
                for c in self.columns
            ]
        )


def _str(name: str, *allowed: str, required: bool = False) -> Column:
    return Column(name, "str", required, allowed)


def _int(name: str, required: bool = False, wide: bool = False) -> Column:
    return Column(name, "int", required, wide=wide)


def _num(name: str, required: bool = False) -> Column:
    return Column(name, "float", required)


def _bool(name: str) -> Column:
    return Column(name, "bool")


def _time(*names: str) -> tuple[Column, ...]:
    return tuple(Column(n, "datetime") for n in names)


def _edges(**by_column: str) -> tuple[ForeignKey, ...]:
    return tuple(ForeignKey(c, e) for c, e in by_column.items())


TICKET_STATUS = ("Open", "InProgress", "Resolved", "Closed", "Reopened")

_DECLARED = (
    Entity(
        "cities", "cities.json", BATCH, "dim_city", "city_id",
        (
            _int("city_id", True),
            _str("city_name", required=True),
            _str("country", required=True),
            _str("timezone", required=True),
        ),
    ),
    Entity(
        "regions", "regions.csv", BATCH, "dim_region", "region_id",
        (
            _int("region_id", True),
            _str("region_name", required=True),
            _int("city_id", True),
            _num("delivery_base_fee", True),
        ),
    ),
    Entity(
        "segments", "segments.csv", BATCH, "dim_segment", "segment_id",
        (
            _int("segment_id", True),
            _str("segment_name", "Regular", "VIP", required=True),
            _int("discount_pct"),
            _bool("priority_support"),
        ),
    ),
    Entity(
        "categories", "categories.csv", BATCH, "dim_category", "category_id",
        (_int("category_id", True), _str("category_name", required=True)),
    ),
    Entity(
        "teams", "teams.csv", BATCH, "dim_team", "team_id",
        (_int("team_id", True), _str("team_name")),
    ),
    Entity(
        "reason_categories", "reason_categories.csv", BATCH, "dim_reason_category",
        "reason_category_id",
        (
            _int("reason_category_id", True),
            _str("category_name", "Delivery", "Food", "Payment", required=True),
        ),
    ),
    Entity(
        "reasons", "reasons.csv", BATCH, "dim_reason", "reason_id",
        (
            _int("reason_id", True),
            _str("reason_name"),
            _int("reason_category_id"),
            _int("severity_level"),
            _num("typical_refund_pct"),
        ),
        references=_edges(reason_category_id="reason_categories"),
    ),
    Entity(
        "channels", "channels.csv", BATCH, "dim_channel", "channel_id",
        (
            _int("channel_id", True),
            _str("channel_name", "app", "chat", "phone", "email", required=True),
        ),
    ),
    Entity(
        "priorities", "priorities.csv", BATCH, "dim_priority", "priority_id",
        (
            _int("priority_id", True),
            _str("priority_code", "P1", "P2", "P3", "P4", required=True),
            _str("priority_name", "Critical", "High", "Medium", "Low", required=True),
            _int("sla_first_response_min"),
            _int("sla_resolution_min"),
        ),
    ),
    Entity(
        "customers", "customers.csv", BATCH, "dim_customer", "customer_id",
        (
            _int("customer_id", True),
            _str("full_name", required=True),
            _str("email"),
            _str("phone"),
            _num("region_id"),
            _int("segment_id"),
            *_time("signup_date"),
            _str("gender", "male", "female"),
            *_time("created_at", "updated_at"),
        ),
        references=_edges(region_id="regions", segment_id="segments"),
        pii=("email", "phone"),
    ),
    Entity(
        "restaurants", "restaurants.json", BATCH, "dim_restaurant", "restaurant_id",
        (
            _int("restaurant_id", True),
            _str("restaurant_name", required=True),
            _int("region_id"),
            _int("category_id"),
            _str("price_tier", "Low", "Mid", "High"),
            _num("rating_avg"),
            _int("prep_time_avg_min"),
            _bool("is_active"),
            *_time("created_at", "updated_at"),
        ),
        references=_edges(region_id="regions", category_id="categories"),
    ),
    Entity(
        "drivers", "drivers.csv", BATCH, "dim_driver", "driver_id",
        (
            _int("driver_id", True),
            _str("driver_name", required=True),
            _str("driver_phone"),
            _int("national_id", wide=True),
            _int("region_id"),
            _str("shift", "morning", "evening", "night"),
            _str("vehicle_type"),
            *_time("hire_date"),
            _num("rating_avg"),
            _num("on_time_rate"),
            _num("cancel_rate"),
            _int("completed_deliveries", True),
            _bool("is_active"),
            *_time("created_at", "updated_at"),
        ),
        references=_edges(region_id="regions"),
        pii=("driver_phone", "national_id"),
    ),
    Entity(
        "agents", "agents.csv", BATCH, "dim_agent", "agent_id",
        (
            _int("agent_id", True),
            _str("agent_name", required=True),
            _str("agent_email"),
            _str("agent_phone"),
            _int("team_id"),
            _str("skill_level", "Junior", "Mid", "Senior", "Lead"),
            *_time("hire_date"),
            _int("avg_handle_time_min"),
            _num("resolution_rate"),
            _num("csat_score"),
            _bool("is_active"),
            *_time("created_at", "updated_at"),
        ),
        references=_edges(team_id="teams"),
        pii=("agent_email", "agent_phone"),
    ),
    Entity(
        "orders", "orders.json", STREAM, "fact_order", "order_id",
        (
            _str("order_id", required=True),
            _int("customer_id"),
            _int("restaurant_id"),
            _int("driver_id"),
            _int("region_id"),
            _num("order_amount"),
            _num("delivery_fee"),
            _num("discount_amount"),
            _num("total_amount"),
            _str(
                "order_status",
                "Pending", "Preparing", "OutForDelivery", "Delivered", "Cancelled", "Refunded",
            ),
            _str("payment_method", "card", "cash", "wallet", required=True),
            *_time("order_created_at", "delivered_at"),
        ),
        foreign_keys=_edges(
            customer_id="customers", driver_id="drivers", restaurant_id="restaurants"
        ),
        references=_edges(region_id="regions"),
    ),
    Entity(
        "tickets", "tickets.csv", STREAM, "fact_ticket", "ticket_id",
        (
            _str("ticket_id", required=True),
            _str("order_id"),
            _int("customer_id"),
            _int("driver_id"),
            _int("restaurant_id"),
            _int("agent_id"),
            _int("reason_id"),
            _int("priority_id"),
            _int("channel_id"),
            _str("status", *TICKET_STATUS),
            _num("refund_amount"),
            *_time(
                "created_at", "first_response_at", "resolved_at",
                "sla_first_due_at", "sla_resolve_due_at",
            ),
        ),
        foreign_keys=_edges(order_id="orders", agent_id="agents"),
        references=_edges(
            customer_id="customers", region_id="regions", restaurant_id="restaurants",
            driver_id="drivers", reason_id="reasons", priority_id="priorities",
            channel_id="channels",
        ),
    ),
    Entity(
        "ticket_events", "ticket_events.json", STREAM, "fact_ticket_event", "event_id",
        (
            _str("event_id", required=True),
            _str("ticket_id"),
            _int("agent_id"),
            *_time("event_ts"),
            _str("old_status", *TICKET_STATUS),
            _str("new_status", *TICKET_STATUS, required=True),
            _str("notes"),
        ),
        foreign_keys=_edges(ticket_id="tickets"),
        references=_edges(agent_id="agents"),
        null_exempt=("old_status",),
    ),
)

ENTITIES: dict[str, Entity] = {e.name: e for e in _DECLARED}
BY_FILE: dict[str, Entity] = {e.file: e for e in _DECLARED}
BY_TABLE: dict[str, Entity] = {e.table: e for e in _DECLARED}

#: lookups that copy a parent's name without storing an edge
_LOOKUP_PARENTS = {"regions": {"cities"}}


def entity_for_file(file_name: str) -> Entity:
    """The entity a file belongs to; master exports may be CSV copies of JSON files."""
    known = BY_FILE.get(file_name)
    if known is None:
        stem = file_name.rsplit(".", 1)[0].lower()
        known = ENTITIES.get(stem) if file_name.endswith(".csv") else None
    if known is None:
        raise ValueError(f"no entity expects a file named {file_name!r}")
    return known


def load_order(entities: Iterable[Entity] = _DECLARED) -> list[str]:
    """Entity names, every parent before its children."""
    entities = list(entities)
    graph = {
        e.name: {k.entity for k in e.edges} | _LOOKUP_PARENTS.get(e.name, set()) for e in entities
    }
    wanted = set(graph)
    return [n for n in TopologicalSorter(graph).static_order() if n in wanted]
