import csv
import hashlib
import json
import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from helpers import row

from sluice.operators.quarantine import volume_alerts
from sluice.plans.ingest import ingest, seed
from sluice.plans.integrity import star_report
from sluice.plans.retry import retry
from sluice.session import scratch_dir
from sluice.sources.files import batch_plan, inventory, read_text_table
from sluice.sources.warehouse import Warehouse
from sluice.spec import ENTITIES
from sluice.streaming.files import keep_sla_view_fresh, stream_ingest

DAY = datetime(2024, 1, 3)


def write_csv(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as f:
        out = csv.DictWriter(f, fieldnames=list(rows[0]))
        out.writeheader()
        out.writerows(rows)
    return str(path)


def write_json(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(rows))
    return str(path)


def orders(*ids, **changes):
    return [row("orders", order_id=i, **changes) for i in ids]


def master(folder):
    write_csv(folder / "cities.csv", [dict(city_id=7, city_name="Cairo", country="EG",
                                           timezone="Africa/Cairo")])
    write_csv(folder / "regions.csv", [
        dict(region_id=1, region_name="North", city_id="7.0", delivery_base_fee="2.5"),
        dict(region_id=2, region_name="South", city_id=8, delivery_base_fee="2"),
    ])
    write_csv(folder / "reason_categories.csv",
              [dict(reason_category_id=1, category_name="Food")])
    write_csv(folder / "reasons.csv", [dict(reason_id=1, reason_name="cold", reason_category_id=1,
                                            severity_level=2, typical_refund_pct="0.5")])
    write_csv(folder / "segments.csv", [dict(segment_id=1, segment_name="VIP", discount_pct=10,
                                             priority_support="True")])
    write_csv(folder / "channels.csv", [dict(channel_id=1, channel_name="app")])
    write_csv(folder / "priorities.csv", [dict(
        priority_id=1, priority_code="P1", priority_name="High", sla_first_response_min=1,
        sla_resolution_min=15)])
    write_csv(folder / "categories.csv", [dict(category_id=1, category_name="Pizza")])
    write_csv(folder / "teams.csv", [dict(team_id=1, wrong_name="x")])
    write_csv(folder / "customers.csv", [
        row("customers"), row("customers"), row("customers", customer_id="2", full_name='Q "x"\ny'),
        row("customers", customer_id="3", email="bad"),
    ])
    write_csv(folder / "ignored.csv", [dict(a=1)])
    return folder


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse")).create()


@pytest.fixture
def with_parents(spark, warehouse):
    for table, key in (("dim_customer", "customer_id"), ("dim_driver", "driver_id"),
                       ("dim_restaurant", "restaurant_id"), ("dim_agent", "agent_id")):
        schema = warehouse.read(table).schema
        one = spark.createDataFrame(
            [tuple(1 if f.name == key else None for f in schema)], schema
        )
        warehouse.write_load(table, one, "parents")
    return warehouse


def test_seed_then_skip(spark, warehouse, tmp_path):
    folder = master(tmp_path / "master")
    plan = [e.name for e, _ in batch_plan(spark, str(folder))]
    assert plan.index("cities") < plan.index("regions") and "ignored" not in plan

    assert seed(spark, str(folder), warehouse, DAY) == {"loaded": 9, "skipped": 0, "failed": 1}
    regions = {r["region_id"]: r["city_name"] for r in warehouse.read("dim_region").collect()}
    assert regions == {1: "Cairo", 2: None}
    assert warehouse.read("dim_reason").first()["reason_category"] == "Food"
    customers = {r["customer_id"]: r for r in warehouse.read("dim_customer").collect()}
    assert set(customers) == {1, 2} and customers[2]["full_name"] == 'Q "x"\ny'
    assert len(customers[1]["email"]) == 64

    log = {r["file_name"]: r for r in warehouse.read("pipeline_file_log").collect()}
    c = log["customers.csv"]
    assert (c["total_records"], c["valid_records"], c["quarantined"], c["duplicate_count"]) == (
        4, 2, 2, 1,
    )
    assert (log["teams.csv"]["status"], log["teams.csv"]["rejection_stage"]) == ("failed", "schema")
    bad = warehouse.read("quarantine").where("source_table = 'dim_team'").first()
    assert json.loads(bad["raw_data"]) == {"team_id": "1", "wrong_name": "x"}

    # loaded files are skipped, the failed one is tried again
    later = seed(spark, str(folder), warehouse, DAY + timedelta(days=1))
    assert later == {"loaded": 0, "skipped": 9, "failed": 1}
    assert warehouse.read("dim_customer").count() == 2
    assert warehouse.read("dim_date").count() == 4383


def test_order_load_is_replay_safe_and_first_write_wins(spark, with_parents, tmp_path):
    w = with_parents
    rows = orders("a", "b") + orders("a", total_amount=99) + orders("late", customer_id=2) + [
        row("orders", order_id="open", delivered_at=None),
    ]
    path = write_json(tmp_path / "2024-01-03" / "09" / "orders.json", rows)
    staged = Path(scratch_dir(spark)) / "sluice"
    before = set(staged.iterdir()) if staged.exists() else set()
    for _ in range(2):
        out = ingest(spark, "orders", [path], w, "h9", DAY)
        assert out.inserted == 2
    assert set(staged.iterdir()) <= before
    facts = {r["order_id"]: r for r in w.read("fact_order").collect()}
    assert set(facts) == {"a", "b"} and str(facts["a"]["total_amount"]) == "11.50"
    assert (facts["a"]["date_key"], facts["a"]["time_key"]) == (20240102, 907)
    stages = {r["rejection_rule"] for r in w.read("quarantine").collect()}
    assert stages == {"duplicate", "fk:customer_id", "null:delivered_at"}

    assert ingest(spark, "orders", [path], w, "h10", DAY).skipped
    write_json(tmp_path / "2024-01-03" / "09" / "orders.json", orders("b", "c", total_amount=5))
    assert ingest(spark, "orders", [path], w, "h11", DAY).inserted == 1
    amounts = {r["order_id"]: str(r["total_amount"]) for r in w.read("fact_order").collect()}
    assert amounts == {"a": "11.50", "b": "11.50", "c": "5.00"}


def test_single_object_and_empty_files(spark, with_parents, tmp_path):
    one = write_json(tmp_path / "one" / "orders.json", orders("x")[0])
    assert ingest(spark, "orders", [one], with_parents, "one", DAY).inserted == 1
    empty = write_json(tmp_path / "none" / "orders.json", [])
    failed = ingest(spark, "orders", [empty], with_parents, "none", DAY).failed
    assert list(failed) == [f"file:{empty}"]
    names = inventory(spark, [one]).first()["columns"]
    assert sorted(names) == sorted(ENTITIES["orders"].names)
    small, big = (inventory(spark, [one], max_cell=n).first() for n in (1 << 20, 1))
    assert big["columns"] is None and big["file_hash"] == small["file_hash"]
    text = tmp_path / "a b" / "orders.csv"
    text.parent.mkdir()
    text.write_bytes(b'\xef\xbb\xbf"order_id",total_amount\r\n' + b"1,2\r\n" * 3)
    small, big = (inventory(spark, [f"file:{text}"], max_cell=n).first() for n in (1 << 20, 1))
    assert big == small and big["columns"] == ["order_id", "total_amount"]
    assert big["file_hash"] == hashlib.md5(text.read_bytes()).hexdigest()


def test_retry_restores_promotes_and_waits(spark, with_parents, tmp_path):
    w = with_parents
    path = write_json(
        tmp_path / "orders.json",
        orders("late", customer_id=2) + orders("never", driver_id=9) + orders("bad", total_amount=-1),
    )
    ingest(spark, "orders", [path], w, "o", DAY)
    tickets = write_csv(tmp_path / "tickets.csv", [row("tickets", order_id="late")])
    ingest(spark, "tickets", [tickets], w, "t", DAY)
    assert w.read("quarantine").count() == 4 and w.read("fact_ticket").count() == 0

    soon = DAY + timedelta(hours=1)
    schema = w.read("dim_customer").schema
    w.write_load("dim_customer", spark.createDataFrame(
        [tuple(2 if f.name == "customer_id" else None for f in schema)], schema), "more")

    assert retry(spark, w, "dry", soon, dry_run=True)["retried"] == 1
    assert w.read("fact_order").count() == 0

    first = retry(spark, w, "r1", soon)
    # the restored order frees its ticket in the same run
    assert first == {"retried": 2, "promoted": 0, "deleted": 2, "skipped": 1}
    assert retry(spark, w, "r1", soon) == first
    ticket = w.read("fact_ticket").first()
    assert (ticket["region_id"], ticket["sla_response_breached"], ticket["reopened"]) == (
        3, False, True,
    )
    assert str(ticket["first_response_min"]) == "0.50" and ticket["sla_resolution_breached"]

    late = retry(spark, w, "r2", DAY + timedelta(hours=25))
    assert late == {"retried": 0, "promoted": 2, "deleted": 2, "skipped": 1}
    lost = {r["unresolved_fk"]: r["retry_count"] for r in w.read("true_orphan").collect()}
    assert lost == {"driver_id": 1, "records": 0}
    assert retry(spark, w, "r3", DAY + timedelta(hours=26))["deleted"] == 0


def test_retry_gives_up_after_enough_tries(spark, with_parents, tmp_path):
    path = write_json(tmp_path / "orders.json", orders("never", driver_id=9))
    ingest(spark, "orders", [path], with_parents, "o", DAY)
    args = dict(orphan_hours=9999, max_retries=1)
    assert retry(spark, with_parents, "r1", DAY, **args)["promoted"] == 0
    assert retry(spark, with_parents, "r2", DAY, **args)["promoted"] == 1


def test_stream_gives_what_batch_gives(spark, with_parents, tmp_path):
    w = with_parents
    folder = tmp_path / "in"
    write_json(folder / "2024-01-03" / "09" / "orders.json", orders("a", "b", "a"))
    write_json(folder / "2024-01-03" / "10" / "orders.json", orders("b", "c") + orders("x", driver_id=5))
    write_json(folder / "2024-01-03" / "10" / "other.json", orders("z"))
    check = str(tmp_path / "check")

    def run():
        stream_ingest(spark, "orders", str(folder), w, check, files_per_batch=1,
                      clock=lambda: DAY).awaitTermination()
        return sorted(r["order_id"] for r in w.read("fact_order").collect())

    assert run() == ["a", "b", "c"]
    write_json(folder / "2024-01-03" / "11" / "orders.json", orders("d"))
    assert run() == ["a", "b", "c", "d"]
    assert w.read("processed_files").where("status = 'success'").count() == 3

    assert volume_alerts(w.read("quarantine"), limit=0).count() == 2


def test_second_stream_and_renewed_checkpoint_keep_earlier_rows(spark, with_parents, tmp_path):
    w = with_parents

    def run(folder, check):
        stream_ingest(spark, "orders", str(tmp_path / folder), w, str(tmp_path / check),
                      clock=lambda: DAY).awaitTermination()
        return sorted(r["order_id"] for r in w.read("fact_order").collect())

    write_json(tmp_path / "one" / "orders.json", orders("a1", "a2"))
    write_json(tmp_path / "two" / "orders.json", orders("b1"))
    assert run("one", "check-one") == ["a1", "a2"]
    assert run("two", "check-two") == ["a1", "a2", "b1"]
    write_json(tmp_path / "two" / "later" / "orders.json", orders("b2"))
    assert run("two", "check-new") == ["a1", "a2", "b1", "b2"]
    assert w.read("processed_files").where("status = 'success'").count() >= 3


def test_sla_view_follows_the_tickets(spark, with_parents, tmp_path):
    w = with_parents
    refresh = keep_sla_view_fresh(spark, w, str(tmp_path / "check"), every="1 second")
    try:
        path = write_json(tmp_path / "orders.json", orders("o1"))
        ingest(spark, "orders", [path], w, "o", DAY)
        path = write_csv(tmp_path / "tickets.csv", [
            row("tickets"), row("tickets", ticket_id="t2", agent_id="9"),
        ])
        backup = str(tmp_path / "backup")
        for _ in range(2):
            ingest(spark, "tickets", [path], w, "t", DAY, backup=backup)
        refresh.processAllAvailable()
    finally:
        refresh.stop()
    view = spark.table("v_ticket_sla_performance").collect()
    assert [(r["ticket_id"], r["is_first_response_met"], r["is_resolution_met"]) for r in view] == [
        ("t1", True, False)
    ]
    assert spark.read.option("header", True).csv(backup).count() == 1
    report = {(r["child"], r["fk_column"]): r for r in star_report(w).collect()}
    assert len(report) == 28
    assert report["fact_ticket", "agent_id"]["orphan_rows"] == 0
    assert report["fact_ticket", "reason_id"]["orphan_rows"] == 1
    assert report["fact_ticket", "date_key"]["keyed_rows"] == 1


def test_csv_cells_stay_text(spark, tmp_path):
    path = write_csv(tmp_path / "teams.csv", [dict(team_id="01", team_name=""),
                                             dict(team_id="2", team_name=" a,b ")])
    got = read_text_table(spark, [path], ENTITIES["teams"]).orderBy("_row").collect()
    assert [(r["team_id"], r["team_name"]) for r in got] == [("01", ""), ("2", " a,b ")]


def test_first_arrival_wins_across_files_and_formats(spark, with_parents, tmp_path):
    w = with_parents
    small = write_json(tmp_path / "1" / "orders.json", orders("a", total_amount=1))
    large = write_json(tmp_path / "0" / "orders.json",
                       orders("a", *[f"o{i}" for i in range(500)], total_amount=2))
    os.utime(small, (1_000_000, 1_000_000))
    assert ingest(spark, "orders", [large, small], w, "o", DAY).inserted == 501
    assert str(w.read("fact_order").where("order_id = 'a'").first()["total_amount"]) == "1.00"

    city = dict(city_id=7, city_name="late", country="EG", timezone="x")
    one = write_csv(tmp_path / "cities.csv", [city])
    two = write_json(tmp_path / "cities.json", [{**city, "city_name": "early"}])
    os.utime(two, (1_000_000, 1_000_000))
    ingest(spark, "cities", [one, two], w, "c", DAY)
    assert [r["city_name"] for r in w.read("dim_city").collect()] == ["early"]


def test_bad_files_do_not_stop_a_load(spark, warehouse, tmp_path):
    good = write_csv(tmp_path / "a" / "teams.csv", [dict(team_id=1, team_name="A")])
    turned = write_csv(tmp_path / "b" / "teams.csv", [dict(team_name="B, b", team_id=2)])
    wide = tmp_path / "c" / "teams.csv"
    wide.parent.mkdir()
    wide.write_text('team_id,team_name\n3,C\n4,"D, d",x,y\n5\n6,F,\n7,"G\ng"\n')
    cut = tmp_path / "d" / "teams.json"
    cut.parent.mkdir()
    cut.write_text('[{"team_id": 8, "team_n')
    other = tmp_path / "e" / "teams.parq"
    other.parent.mkdir()
    other.write_bytes(b"\x00\x01")
    paths = [good, turned, str(wide), str(cut), str(other)]
    out = ingest(spark, "teams", paths, warehouse, "t", DAY)
    assert len(out.loaded) == 3 and len(out.failed) == 2
    got = {r["team_id"]: r["team_name"] for r in warehouse.read("dim_team").collect()}
    # a short record has blank cells, as a blank cell has always had
    assert got == {1: "A", 2: "B, b", 3: "C", 5: "", 7: "G\ng"}
    rows = warehouse.read("quarantine").collect()
    wide_rows = {json.loads(r["raw_data"])["_excess"] for r in rows if r["rejection_rule"] == "cells"}
    assert wide_rows == {'4,"D, d",x,y', "6,F,"}
    assert any(json.loads(r["raw_data"]).get("line") == '[{"team_id": 8, "team_n' for r in rows)
    states = {r["file_path"].rsplit("/", 2)[1]: r["status"]
              for r in warehouse.read("processed_files").collect()}
    assert states == {"a": "success", "b": "success", "c": "success", "d": "failed", "e": "failed"}


def test_failed_load_is_recorded_and_later_events_count(spark, warehouse, tmp_path, monkeypatch):
    path = write_csv(tmp_path / "teams.csv", [dict(team_id=1, team_name="A")])
    with monkeypatch.context() as m:
        m.setattr("sluice.plans.ingest.tag", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest(spark, "teams", [path], warehouse, "t1", DAY)
    event = warehouse.read("processed_files").first()
    assert (event["status"], event["error_msg"]) == ("failed", "ZeroDivisionError: division by zero")
    assert ingest(spark, "teams", [path], warehouse, "t2", DAY).inserted == 1
    # same time: the later load's event is the state
    assert ingest(spark, "teams", [path], warehouse, "t3", DAY).skipped


def test_retry_restores_the_first_of_copies(spark, with_parents, tmp_path):
    w = with_parents
    for i in range(4):
        path = write_json(tmp_path / str(i) / "orders.json",
                          orders("late", customer_id=2, total_amount=i + 1))
        ingest(spark, "orders", [path], w, f"o{i}", DAY + timedelta(minutes=i))
    schema = w.read("dim_customer").schema
    w.write_load("dim_customer", spark.createDataFrame(
        [tuple(2 if f.name == "customer_id" else None for f in schema)], schema), "more")
    got = retry(spark, w, "r", DAY + timedelta(hours=1))
    assert (got["retried"], got["deleted"]) == (1, 4)
    assert [str(r["total_amount"]) for r in w.read("fact_order").collect()] == ["1.00"]
