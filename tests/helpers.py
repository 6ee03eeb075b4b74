"""Raw rows for tests: a valid row of each entity, changed cell by cell."""

from sluice.operators.cascade import FILE, ROW
from sluice.spec import ENTITIES

VALID = {
    "customers": dict(
        customer_id="1", full_name="A B", email="a@b.com", phone="01012345678", region_id="1",
        segment_id="1", signup_date="2024-01-02", gender="male",
        created_at="2024-01-02 03:04:05", updated_at="2024-01-02T03:04:05.5",
    ),
    "drivers": dict(
        driver_id="1", driver_name="D", driver_phone="01112345678",
        national_id="299999999999999", region_id="1", shift="night", vehicle_type="bike",
        hire_date="2024-01-02", rating_avg="4.5", on_time_rate="0.9", cancel_rate="0.1",
        completed_deliveries="5", is_active="True", created_at="2024-01-02",
        updated_at="2024-01-02",
    ),
    "orders": dict(
        order_id="o1", customer_id="1", restaurant_id="1", driver_id="1", region_id="3",
        order_amount="10.5", delivery_fee="1", discount_amount="0", total_amount="11.5",
        order_status="Delivered", payment_method="card",
        order_created_at="2024-01-02 09:07:00", delivered_at="2024-01-02 09:37:00",
    ),
    "tickets": dict(
        ticket_id="t1", order_id="o1", customer_id="1", driver_id="1", restaurant_id="1",
        agent_id="1", reason_id="1", priority_id="1", channel_id="1", status="Reopened",
        refund_amount="0", created_at="2024-01-02 09:00:00",
        first_response_at="2024-01-02 09:00:30", resolved_at="2024-01-02 09:20:00",
        sla_first_due_at="2024-01-02 09:01:00", sla_resolve_due_at="2024-01-02 09:15:00",
    ),
    "ticket_events": dict(
        event_id="e1", ticket_id="t1", agent_id="1", event_ts="2024-01-02 09:00:00",
        old_status=None, new_status="Open", notes="",
    ),
}


def row(entity, **changes):
    return {**VALID[entity], **changes}


def raw_frame(spark, entity, rows, file="f"):
    """Rows as a raw frame; each may name its file with ``_file``."""
    spec = ENTITIES[entity]
    schema = spec.raw_schema().add(FILE, "string").add(ROW, "long")
    data = [
        tuple(r[n] for n in spec.names) + (r.get(FILE, file), i) for i, r in enumerate(rows)
    ]
    return spark.createDataFrame(data, schema)
