import pytest
from helpers import raw_frame, row

from sluice.operators.cascade import clean_rows, tag
from sluice.operators.schema import column_difference, columns_match, typed
from sluice.spec import ENTITIES

PARENTS = {"customers": "customer_id", "drivers": "driver_id", "restaurants": "restaurant_id"}


def order_parents(spark):
    return {n: spark.createDataFrame([(1,), (2,)], f"{k} int") for n, k in PARENTS.items()}


def tags(spark, entity, rows, **kw):
    tagged = tag(raw_frame(spark, entity, rows), ENTITIES[entity], **kw)
    return [
        (r["reject_stage"], r["reject_rule"]) for r in tagged.orderBy("_row").collect()
    ]


def test_customer_rules(spark):
    cases = [
        ({}, (None, None)),
        ({"customer_id": ""}, ("schema", "required:customer_id")),
        ({"customer_id": "nan"}, ("schema", "required:customer_id")),
        ({"customer_id": "abc"}, ("schema", "dtype:customer_id")),
        ({"customer_id": "99999999999"}, ("schema", "dtype:customer_id")),
        ({"region_id": "inf"}, ("schema", "dtype:region_id")),
        ({"region_id": "1_000"}, ("schema", "dtype:region_id")),
        ({"region_id": "12d"}, ("schema", "dtype:region_id")),
        ({"segment_id": " 1e0 "}, (None, None)),
        ({"segment_id": "3.7"}, (None, None)),
        ({"created_at": "2024/01/02"}, ("schema", "dtype:created_at")),
        ({"created_at": "2024-02-30"}, ("schema", "dtype:created_at")),
        ({"created_at": "09:00"}, ("schema", "dtype:created_at")),
        ({"gender": "x"}, ("schema", "categorical:gender")),
        ({"gender": ""}, (None, None)),
        # both the first type rule and a later one are broken
        ({"segment_id": "x", "gender": "x"}, ("schema", "dtype:segment_id")),
        # a null counts although the column is nullable
        ({"region_id": ""}, ("records", "null:region_id")),
        ({"created_at": "None"}, ("records", "null:created_at")),
        ({"full_name": ""}, ("schema", "required:full_name")),
        ({"email": "a@b.org"}, ("records", "email_format:email")),
        ({"email": ""}, ("records", "email_format:email")),
        ({"email": None}, ("records", "email_format:email")),
        ({"email": "ä@b.com"}, (None, None)),
        ({"phone": "1112345678"}, (None, None)),
        ({"phone": "02012345678"}, ("records", "phone_format:phone")),
        ({"phone": "01012345678\n"}, ("records", "phone_format:phone")),
        ({"segment_id": "-1"}, ("records", "negative:segment_id")),
    ]
    rows = [row("customers", **{"customer_id": str(i + 1), **c}) for i, (c, _) in enumerate(cases)]
    assert tags(spark, "customers", rows) == [want for _, want in cases]


def test_driver_rules(spark):
    cases = [
        ({}, (None, None)),
        ({"driver_name": " N/A "}, ("records", "placeholder:driver_name")),
        ({"driver_name": "None"}, ("schema", "required:driver_name")),
        ({"driver_name": "Null"}, ("records", "placeholder:driver_name")),
        ({"is_active": "yes"}, ("schema", "dtype:is_active")),
        ({"is_active": ""}, (None, None)),
        ({"national_id": "123"}, ("records", "national_id_length")),
        ({"national_id": "299999999999999.0"}, (None, None)),
        ({"rating_avg": "5.01"}, ("records", "too_large:rating_avg")),
        ({"on_time_rate": "1.5"}, ("records", "too_large:on_time_rate")),
        ({"cancel_rate": "-0.5"}, ("records", "negative:cancel_rate")),
    ]
    rows = [row("drivers", **{"driver_id": str(i + 1), **c}) for i, (c, _) in enumerate(cases)]
    assert tags(spark, "drivers", rows) == [want for _, want in cases]


def test_duplicates_are_found_before_formats_and_per_file(spark):
    rows = [
        row("customers", customer_id="5", email="bad"),
        row("customers", customer_id="5.0"),
        row("customers", customer_id="6", region_id=""),
        row("customers", customer_id="6"),
        row("customers", customer_id="6"),
        row("customers", customer_id="5", _file="g"),
    ]
    assert tags(spark, "customers", rows) == [
        ("records", "email_format:email"),
        ("records", "duplicate"),
        ("records", "null:region_id"),
        (None, None),
        ("records", "duplicate"),
        (None, None),
    ]


def test_order_rules_and_foreign_keys(spark):
    cases = [
        ({}, (None, None)),
        ({"delivered_at": ""}, ("records", "null:delivered_at")),
        ({"total_amount": "-1"}, ("records", "negative:total_amount")),
        ({"payment_method": "N/A"}, ("schema", "categorical:payment_method")),
        ({"customer_id": "2.0"}, (None, None)),
        ({"customer_id": "9"}, ("orphan", "fk:customer_id")),
        ({"customer_id": "1.5"}, ("orphan", "fk:customer_id")),
        # several keys are missing: the first declared is named
        ({"driver_id": "9", "restaurant_id": "9"}, ("orphan", "fk:driver_id")),
        # rules come before foreign keys
        ({"customer_id": "9", "total_amount": "-1"}, ("records", "negative:total_amount")),
    ]
    rows = [row("orders", **{"order_id": f"o{i}", **c}) for i, (c, _) in enumerate(cases)]
    assert tags(spark, "orders", rows, parents=order_parents(spark)) == [w for _, w in cases]


def test_large_parents_give_the_same_tags(spark):
    rows = [
        row("orders", order_id=f"o{i}", customer_id=c) for i, c in enumerate(("1", "9", "1.5", "2"))
    ]
    small = tags(spark, "orders", rows, parents=order_parents(spark))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert tags(spark, "orders", rows, parents=order_parents(spark)) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_event_keeps_null_first_status_and_null_key(spark):
    rows = [row("ticket_events"), row("ticket_events", event_id="e2", ticket_id=None)]
    tickets = {"tickets": spark.createDataFrame([("t1",)], "ticket_id string")}
    assert tags(spark, "ticket_events", rows, parents=tickets) == [(None, None)] * 2


def test_declared_null_mode(spark):
    rows = [row("orders", delivered_at="")]
    got = tags(spark, "orders", rows, parents=order_parents(spark), null_mode="declared")
    assert got == [("records", "date_format:delivered_at")]
    with pytest.raises(ValueError):
        tags(spark, "orders", rows, null_mode="other", parents=order_parents(spark))


def test_clean_and_rejected_are_a_partition(spark):
    rows = [row("customers", customer_id=str(i % 7), email="x" if i % 3 else "a@b.com")
            for i in range(30)]
    tagged = tag(raw_frame(spark, "customers", rows), ENTITIES["customers"])
    clean = clean_rows(tagged).count()
    assert tagged.count() == 30
    assert tagged.where("reject_stage IS NOT NULL").count() == 30 - clean
    assert tagged.where("(reject_stage IS NULL) <> (reject_rule IS NULL)").count() == 0


def test_typed_rounds_integers(spark):
    got = typed(
        raw_frame(spark, "customers", [row("customers", segment_id="3.7", region_id="370.0")]),
        ENTITIES["customers"],
    )
    first = got.first()
    assert (first["segment_id"], first["region_id"]) == (4, 370.0)
    assert got.schema == ENTITIES["customers"].typed_schema() or [
        f.dataType for f in got.schema
    ] == [f.dataType for f in ENTITIES["customers"].typed_schema()]


def test_column_sets():
    e = ENTITIES["teams"]
    assert columns_match(["team_name", "team_id"], e)
    assert column_difference(["team_id", "x"], e) == (["team_name"], ["x"])
