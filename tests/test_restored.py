"""Values taken back out of quarantine, and files that a source system names."""

import json
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from helpers import raw_frame, row
from sluice.catalog.master import csv_lines, land, land_json
from sluice.operators.schema import restored, typed
from sluice.sources.files import read_text_table
from sluice.spec import ENTITIES

ORDERS = ENTITIES["orders"]


def test_restored_values(spark):
    rows = [
        row("orders"),
        row("orders", order_id=" b ", customer_id=" 7.0 ", order_amount=" 2.5", order_created_at=" 2024-01-02T09:07:00.25 "),
        row("orders", order_id="null", customer_id="NULL", driver_id=" none ", delivered_at="NaN", region_id="", payment_method="none"),
        row("orders", order_id="d", customer_id="x", order_created_at="yesterday", total_amount=None),
    ]
    raw = raw_frame(spark, "orders", rows)
    got = [r.asDict() for r in restored(raw, ORDERS, "_row").orderBy("_row").collect()]
    assert got[0] == {**typed(raw, ORDERS, "_row").where("_row = 0").first().asDict()}
    assert got[1]["customer_id"] == 7 and got[1]["order_amount"] == 2.5 and got[1]["order_id"] == " b "
    assert str(got[1]["order_created_at"]) == "2024-01-02 09:07:00.250000"
    # texts stay as they are, also those that would stand for null elsewhere
    assert got[2]["order_id"] == "null" and got[2]["payment_method"] == "none"
    assert [got[2][n] for n in ("customer_id", "driver_id", "delivered_at", "region_id")] == [None] * 4
    assert [got[3][n] for n in ("customer_id", "order_created_at", "total_amount")] == [None] * 3
    assert restored(raw.limit(0), ORDERS).collect() == []


def test_named_files(spark, tmp_path):
    rows = raw_frame(
        spark, "orders",
        [row("orders", order_id=f"o{i}", payment_method='a "b", c', _file=f"f{i % 3}") for i in range(10)],
    )
    folder = land_json(rows, "orders", str(tmp_path / "json"))
    files = sorted(Path(folder).glob("*/orders.json"))
    assert len(files) == 3 and sum(len(json.loads(f.read_text())) for f in files) == 10
    lines = csv_lines(rows.repartition(2), ORDERS.names)
    folder = land(lines, str(tmp_path / "csv"), "orders.csv")
    files = sorted(str(p) for p in Path(folder).glob("*/orders.csv"))
    got = read_text_table(spark, files, ORDERS, "csv").select(*ORDERS.names)
    want = rows.select(*[F.coalesce(n, F.lit("")).alias(n) for n in ORDERS.names])
    assert sorted(got.collect()) == sorted(want.collect())
    assert Decimal(1) == restored(got, ORDERS).first()["delivery_fee"]
