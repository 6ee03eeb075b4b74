"""Records stage: null, placeholder, format and range rules.

Each function returns (label, SQL predicate) pairs over the raw text columns
and their parsed values, so a row is tagged with its first broken rule in one
projection.
"""

from __future__ import annotations

from sluice.functions.text import is_placeholder
from sluice.operators.schema import Rules, value
from sluice.spec import BATCH, Entity

# Which columns the rules look at, by name.
DATE_COLUMNS = {
    "batch": ("created_at", "updated_at", "signup_date", "hire_date"),
    "stream": (
        "order_created_at", "delivered_at", "event_ts", "created_at",
        "first_response_at", "resolved_at", "sla_first_due_at", "sla_resolve_due_at",
    ),
}
NON_NEGATIVE = {
    "batch": (
        "segment_id", "team_id", "city_id", "reason_category_id", "prep_time_avg_min",
        "rating_avg", "cancel_rate", "on_time_rate", "avg_handle_time_min",
        "resolution_rate", "csat_score",
    ),
    "stream": (
        "order_amount", "delivery_fee", "discount_amount", "total_amount", "refund_amount",
    ),
}
UPPER_BOUNDS = {"rating_avg": 5, "cancel_rate": 1, "on_time_rate": 1}
EMAIL = r"(?U)^[\w.-]+@[\w.-]+[.]com$"
PHONE = r"^0?1[0125][0-9]{8}\z"
NATIONAL_ID_LENGTH = 15

NULL_MODES = ("any", "declared")


def null_columns(entity: Entity, mode: str = "any") -> list[str]:
    """Columns in which a null rejects the row.

    ``any`` takes every number and timestamp column, nullable or not, as the
    original rules do; ``declared`` takes only those declared required.
    """
    if mode not in NULL_MODES:
        raise ValueError(f"null mode {mode!r} is not one of {NULL_MODES}")
    return [
        c.name
        for c in entity.of_type("int", "float", "datetime")
        if c.name not in entity.null_exempt and (mode == "any" or c.required)
    ]


def null_rules(entity: Entity, mode: str = "any") -> Rules:
    """Expects rows past the schema stage, where only a missing value parses to null."""
    return [(f"null:{name}", f"{value(name)} IS NULL") for name in null_columns(entity, mode)]


def placeholder_rules(entity: Entity) -> Rules:
    return [
        (f"placeholder:{c.name}", is_placeholder(c.name))
        for c in entity.required
        if c.dtype == "str"
    ]


def _differs(name: str, pattern: str) -> str:
    return f"NOT coalesce({name} RLIKE r'{pattern}', false)"


def format_rules(entity: Entity) -> Rules:
    rules = [
        (f"date_format:{name}", f"{value(name)} IS NULL")
        for name in DATE_COLUMNS[entity.kind]
        if name in entity.names
    ]
    if entity.kind == BATCH:
        rules += [(f"email_format:{n}", _differs(n, EMAIL)) for n in entity.names if "email" in n]
        rules += [(f"phone_format:{n}", _differs(n, PHONE)) for n in entity.names if "phone" in n]
        if "national_id" in entity.names:
            digits = f"CAST(try_cast(round({value('national_id')}) AS BIGINT) AS STRING)"
            rules.append(
                ("national_id_length", f"coalesce(length({digits}) <> {NATIONAL_ID_LENGTH}, true)")
            )
    return rules


def range_rules(entity: Entity) -> Rules:
    rules = [
        (f"negative:{name}", f"({value(name)} IS NULL OR {value(name)} < 0)")
        for name in NON_NEGATIVE[entity.kind]
        if name in entity.names
    ]
    if entity.kind == BATCH:
        rules += [
            (f"too_large:{name}", f"{value(name)} > {limit}")
            for name, limit in UPPER_BOUNDS.items()
            if name in entity.names
        ]
    return rules
