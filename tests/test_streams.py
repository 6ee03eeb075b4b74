"""Streams with state: waiting orphans, status moves and kept figures."""

import random
import time
from datetime import datetime, timedelta

import pytest
from helpers import row
from test_jobs import DAY, orders, warehouse, with_parents, write_csv, write_json  # noqa: F401

from pyspark.sql import functions as F
from sluice.plans.analytics import sla_compliance_by_agent, sla_performance
from sluice.plans.ingest import ingest
from sluice.plans.retry import PROMOTED, RESOLVED, WAITING, retry
from sluice.sources.warehouse import BATCH_ID
from sluice.streaming import figures, status, waiting

HOUR = timedelta(hours=1)


def parent(w, spark, table, key, value, load):
    schema = w.read(table).schema
    w.write_load(table, spark.createDataFrame([tuple(value if f.name == key else None for f in schema)], schema), load)


def add(spark, folder, schema, rows):
    """One file more; the file source takes files in the order of their time."""
    time.sleep(0.01)
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def test_waiting_orphans_get_the_verdicts_of_the_retry(spark, with_parents, tmp_path):  # noqa: F811
    w = with_parents
    #: order, missing customer and driver, hours after which they come
    cases = {
        "soon": (2, 1, 1, None), "last": (3, 1, 23, None), "late": (4, 1, 25, None), "never": (5, 1, None, None),
        "both": (6, 7, 2, 5), "half": (8, 9, 3, None), "half late": (10, 11, 3, 30),
    }
    rows = [row("orders", order_id=i, customer_id=c, driver_id=d) for i, (c, d, _, _) in cases.items()]
    path = write_json(tmp_path / "orders.json", rows)
    ingest(spark, "orders", [path], w, "o", DAY)
    ids = {r["order_id"]: r["quarantine_id"] for r in w.read("quarantine").select(
        "quarantine_id", F.get_json_object("raw_data", "$.order_id").alias("order_id")).collect()}
    assert set(ids) == set(cases)

    arrivals = []
    for c, d, c_hours, d_hours in cases.values():
        arrivals += [("customer_id", c, c_hours)] * (c_hours is not None) + [("driver_id", d, d_hours)] * (d_hours is not None)
    missing = {i: [("customer_id", c)] + [("driver_id", d)] * (d != 1) for i, (c, d, _, _) in cases.items()}

    # the stream: one file of orphans, parents one by one, at last a row of each side that moves the watermark on
    orphans, parents, out = (tmp_path / n for n in ("orphans", "parents", "verdicts"))
    for i, keys in missing.items():
        add(spark, orphans, waiting.ORPHAN, [(ids[i], e, str(k), len(keys), DAY) for e, k in keys])
    for edge, key, hours in sorted(arrivals, key=lambda a: a[2]):
        add(spark, parents, waiting.PARENT, [(edge, str(key), DAY + hours * HOUR)])

    def run():
        waiting.stream_verdicts(
            spark, str(orphans), str(parents), str(out), str(tmp_path / "check"), files_per_batch=100
        ).awaitTermination()
        found = waiting.row_verdicts(spark.read.parquet(str(out))).collect()
        return {r["quarantine_id"]: (r["outcome"], r["unresolved_fk"]) for r in found}

    early = run()
    assert early[ids["soon"]] == (RESOLVED, None) and early[ids["half"]] == (WAITING, None)
    assert PROMOTED not in {o for o, _ in early.values()}
    add(spark, orphans, waiting.ORPHAN, [("end", "customer_id", "-1", 1, DAY + 90 * HOUR)])
    add(spark, parents, waiting.PARENT, [("customer_id", "-2", DAY + 90 * HOUR)])
    got = run()
    assert got.pop("end", (WAITING, None))[0] == WAITING

    # the retry: whenever a parent came, and when the waiting time was over
    tables = {"customer_id": "dim_customer", "driver_id": "dim_driver"}
    want = {}
    for n, (edge, key, hours) in enumerate(sorted([*arrivals, (None, None, 24.5)], key=lambda a: a[2])):
        if edge:
            parent(w, spark, tables[edge], edge, key, f"parent-{n}")
        retry(spark, w, f"r{n}", DAY + hours * HOUR, max_retries=99)
    for r in w.read("quarantine_action").where("action <> 'retry'").collect():
        want[r["quarantine_id"]] = r["action"]
    assert {i: got[q][0] for i, q in ids.items()} == {i: want[q] for i, q in ids.items()}
    assert {i for i, q in ids.items() if want[q] == RESOLVED} == {"soon", "last", "both"}
    lost = {r["quarantine_id"]: r["unresolved_fk"] for r in w.read("true_orphan").collect()}
    assert lost == {q: got[q][1] for i, q in ids.items() if want[q] == PROMOTED}
    # as tables the two give the same, without a watermark
    batch = waiting.row_verdicts(waiting.key_verdicts(spark.read.parquet(str(orphans)), spark.read.parquet(str(parents))))
    whole = {r["quarantine_id"]: r["outcome"] for r in batch.collect()}
    assert {i: whole[q] for i, q in ids.items()} == {i: want[q] for i, q in ids.items()}


def test_status_moves_are_those_of_the_whole_table(spark, tmp_path):
    rng = random.Random(4)
    start, rows = datetime(2024, 1, 1), []
    names = ["Open", "InProgress", "Resolved", "Closed"]
    for i in range(300):
        ticket = "hot" if i % 3 == 0 else f"t{rng.randint(0, 9)}"
        at = start + timedelta(minutes=2 * i + rng.randint(0, 20))
        rows.append((f"e{i:03d}", ticket, at, rng.choice([None, *names]), rng.choice(names)))
    rows[10] = (*rows[10][:2], rows[13][2], *rows[10][3:])
    rows += [(None, "t1", start, None, "Open"), ("x", None, start, None, "Open"), ("y", "t1", None, None, "Open")]
    events, out = tmp_path / "events", str(tmp_path / "out")

    def run():
        status.stream_moves(
            spark, str(events), out, str(tmp_path / "check"), files_per_batch=1
        ).awaitTermination()

    for at in range(0, len(rows), 60):
        add(spark, events, status.EVENT, rows[at : at + 60])
        if at in (60, 180):
            run()  # the state outlives the query
    run()
    mark = max(r[2] for r in rows if r[2]) - HOUR
    whole = status.moves(spark.createDataFrame(rows, status.EVENT).where("event_id IS NOT NULL AND ticket_id IS NOT NULL AND event_ts IS NOT NULL"))
    want = sorted(map(str, whole.where(F.col("event_ts") < F.lit(mark)).collect()))
    moved = spark.read.schema(status.MOVE).parquet(out)
    got = sorted(map(str, moved.select(*whole.columns).collect()))
    assert got == want and len(got) > 200
    broken = sum(r["events"] for r in status.broken_moves(moved).collect())
    assert broken == sum(r["is_broken"] for r in moved.collect()) > 0


def test_figures_follow_loads_and_their_repeats(spark, with_parents, tmp_path):  # noqa: F811
    w = with_parents
    parent(w, spark, "dim_agent", "agent_id", 2, "more")
    ingest(spark, "orders", [write_json(tmp_path / "orders.json", orders("o1"))], w, "o", DAY)

    def load(name, *rows):
        path = write_csv(tmp_path / name / "tickets.csv", list(rows))
        ingest(spark, "tickets", [path], w, name, DAY)

    def same(read):
        figures.keep_figures(spark, w, str(tmp_path / "check")).awaitTermination()
        kept = w.read(figures.TABLE)
        for day in (None, datetime(2024, 1, 2).date(), datetime(2024, 1, 9).date()):
            whole = sla_compliance_by_agent(sla_performance(w.read("fact_ticket")), day).collect()
            assert figures.compliance(kept, day).collect() == whole
        assert w.loads(figures.TABLE) == read
        return len(whole)

    late = dict(first_response_at="2024-01-02 09:05:00")
    load("a", row("tickets"), row("tickets", ticket_id="t2", **late), row("tickets", ticket_id="t3", agent_id="2"))
    same(["a"])
    load("b", row("tickets", ticket_id="t4", agent_id="2", **late), row("tickets", ticket_id="t5", created_at="2024-01-09 09:00:00"))
    assert same(["a", "b"]) == 1
    # the same load again, with other rows, replaces its counts
    left = w.read_loads("fact_ticket", ["a"]).where("ticket_id <> 't2'").drop(BATCH_ID).collect()
    w.write_load("fact_ticket", spark.createDataFrame(left, w.read("fact_ticket").schema), "a")
    same(["a", "b"])
    same(["a", "b"])
    files = w.read_loads("fact_ticket", ["b"]).inputFiles()
    assert files and all("_batch_id=b/" in f for f in files)
    assert w.read_loads("fact_ticket", []).count() == 0


@pytest.mark.parametrize("rows", [[], [("q", "customer_id", None, 1, None)]])
def test_empty_streams_and_null_keys(spark, rows):
    orphans = spark.createDataFrame(rows, waiting.ORPHAN)
    parents = spark.createDataFrame([(None, None, None)], waiting.PARENT)
    found = waiting.key_verdicts(orphans, parents).collect()
    assert [r["arrived_at"] for r in found] == [None] * len(rows)
