"""The retry driven by arrivals against the full retry, run after run."""

from datetime import timedelta

import pytest
from helpers import row
from test_jobs import DAY, orders, write_csv, write_json

from pyspark.sql import functions as F
from sluice.plans.ingest import ingest
from sluice.plans.open_set import OpenSet, retry_arrivals
from sluice.plans.retry import retry
from sluice.sources.warehouse import Warehouse

HOUR = timedelta(hours=1)


def parents(w, table, key, values, load):
    schema = w.read(table).schema
    rows = [tuple(v if f.name == key else None for f in schema) for v in values]
    w.write_load(table, w.spark.createDataFrame(rows, schema), load)


@pytest.fixture
def two(spark, tmp_path):
    """Two warehouses with the same first parents, one for each way."""
    found = [Warehouse(spark, str(tmp_path / n)).create() for n in ("full", "arrivals")]
    for w in found:
        for table, key in (("dim_customer", "customer_id"), ("dim_driver", "driver_id"),
                           ("dim_restaurant", "restaurant_id"), ("dim_agent", "agent_id")):
            parents(w, table, key, [1], "parents")
    return found


def outcome(w):
    facts = {t: sorted(map(str, w.read(t).collect())) for t in ("fact_order", "fact_ticket")}
    closed = w.read("quarantine_action").where("action <> 'retry'")
    return facts, sorted(map(str, closed.collect())), sorted(map(str, w.read("true_orphan").collect()))


def test_runs_have_the_outcomes_of_the_full_retry(spark, two, tmp_path):
    full, arrivals = two

    def load(entity, path, name, at):
        for w in two:
            ingest(spark, entity, [path], w, name, at)

    def run(name, at, **args):
        want = retry(spark, full, name, at, **args)
        assert retry_arrivals(spark, arrivals, name, at, **args) == want
        assert outcome(arrivals) == outcome(full)
        return want

    load("orders", write_json(tmp_path / "a" / "orders.json", (
        orders("late", customer_id=2) + orders("both", customer_id=3, driver_id=4) + orders("never", driver_id=9)
        + orders("bad", total_amount=-1) + orders("odd", customer_id="3.7") + orders("early", customer_id=2, total_amount=7)
        + [row("orders", order_id=" none ", customer_id=2)]
    )), "a", DAY)
    load("tickets", write_csv(tmp_path / "a" / "tickets.csv", [
        row("tickets", order_id="late"), row("tickets", ticket_id="t2", order_id="both", agent_id="8"),
    ]), "at", DAY + HOUR)
    assert run("r1", DAY + HOUR)["retried"] == 0
    for w in two:
        parents(w, "dim_customer", "customer_id", [2, 3], "more")
    load("orders", write_json(tmp_path / "b" / "orders.json", orders("late2", customer_id=5, order_created_at="2024-01-04")), "b", DAY + 2 * HOUR)
    # the restored order frees its ticket in the same run
    first = run("r2", DAY + 2 * HOUR)
    assert first["retried"] >= 3
    # a run may be repeated, a load of rejects too: what was closed stays closed
    assert retry_arrivals(spark, arrivals, "r2", DAY + 2 * HOUR) == first
    assert outcome(arrivals) == outcome(full)
    for w in two:
        w.write_load("quarantine", spark.createDataFrame(w.read_load("quarantine", "a").collect(), w.read("quarantine").schema), "a")
        parents(w, "dim_driver", "driver_id", [4], "drivers")
        parents(w, "dim_agent", "agent_id", [8], "agents")
    assert run("r3", DAY + 3 * HOUR)["retried"] == 2
    with pytest.raises(ValueError):
        retry_arrivals(spark, arrivals, "r2", DAY + 2 * HOUR)
    # tried often enough, though young; then too old
    assert run("r4", DAY + 4 * HOUR, max_retries=3)["promoted"] >= 1
    assert run("r5", DAY + 27 * HOUR)["promoted"] >= 1

    state = OpenSet(arrivals, "next")
    assert state.rows().count() == 0 and state.before.seq == 5
    assert len(state.prune()) > 0 and arrivals.loads("retry_state")[-1].endswith("-r5")


def test_first_run_goes_on_from_a_full_retry(spark, two, tmp_path):
    full, arrivals = two
    path = write_json(tmp_path / "orders.json", orders("never", driver_id=9) + orders("late", customer_id=2))
    for w in two:
        ingest(spark, "orders", [path], w, "o", DAY)
        retry(spark, w, "r1", DAY + HOUR)
        parents(w, "dim_customer", "customer_id", [2], "more")
    args = dict(max_retries=2)
    for n in (2, 3):
        want = retry(spark, full, f"r{n}", DAY + n * HOUR, **args)
        assert retry_arrivals(spark, arrivals, f"r{n}", DAY + n * HOUR, **args) == want
        assert outcome(arrivals) == outcome(full)
    assert full.read("true_orphan").first()["retry_count"] == 2


def test_only_open_days_are_read(spark, two, tmp_path):
    _, w = two
    for day in range(3):
        at = DAY + day * 24 * HOUR
        path = write_json(tmp_path / str(day) / "orders.json", orders(f"o{day}", customer_id=day + 2))
        ingest(spark, "orders", [path], w, f"o{day}", at)
    retry_arrivals(spark, w, "r1", DAY + 48 * HOUR, orphan_hours=9999)
    assert len(OpenSet(w, "x").rows().inputFiles()) == 3
    parents(w, "dim_customer", "customer_id", [3], "middle")
    retry_arrivals(spark, w, "r2", DAY + 49 * HOUR, orphan_hours=9999)
    state = OpenSet(w, "x")
    files = state.rows().inputFiles()
    assert sorted(f.split("day=")[1][:10] for f in files) == ["2024-01-03", "2024-01-05"]
    # the other days are as the first run wrote them, and documents are not read with the keys
    assert all("-r1/" in f for f in files)
    plan = state.rows().select("quarantine_id", "missing")._jdf.queryExecution().executedPlan().toString()
    assert "raw_data" not in plan
    assert state.rows(["2024-01-04"]).count() == 0
    assert w.read("fact_order").select(F.col("order_id")).first()["order_id"] == "o1"
