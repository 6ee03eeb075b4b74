"""Rows that meet no key are not shuffled, documents are made after copies are grouped, ended shuffles are removed."""

import time

import pytest
from pyspark.sql import functions as F

from sluice import session
from sluice.catalog.fixtures import FIXTURES
from sluice.operators.cascade import RULE, STAGE, rejected_rows, tag
from sluice.operators.quarantine import quarantine_rows
from sluice.operators.sieve import left_join_few
from sluice.session import stage, stage_only
from sluice.spec import ENTITIES
from helpers import raw_frame, row

KEY = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, "-1")
    yield
    spark.conf.set(KEY, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def orders(spark):
    rows = [row("orders", order_id=f"o{i}") for i in range(60)]
    rows += [row("orders", order_id=f"o{i}", total_amount="12") for i in range(0, 60, 7)]
    rows += [row("orders", order_id=f"p{i}", customer_id=c) for i, c in enumerate(["9", "8.0", "1.5", "", "x", None])]
    rows += [row("orders", order_id="o1", driver_id="77"), row("orders", order_id="q", restaurant_id="5", driver_id="77")]
    return raw_frame(spark, "orders", rows)


def parents(spark):
    return {n: spark.range(1, 4).select(F.col("id").alias(ENTITIES[n].key)) for n in ("customers", "drivers", "restaurants")}


def tagged(spark):
    found = tag(orders(spark), ENTITIES["orders"], parents(spark))
    return found, sorted(map(str, found.select("order_id", "customer_id", STAGE, RULE).collect()))


def test_tags_with_large_parents_and_keys(spark):
    _, want = tagged(spark)
    assert len({r.split("reject_rule=")[1] for r in want}) >= 5
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, "-1")
    try:
        found, got = tagged(spark)
    finally:
        spark.conf.set(KEY, before)
    assert got == want
    # one branch meets nothing and has no exchange
    assert "Union" in plan_of(found)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_few_rows_are_joined_as_by_plain_joins(spark, no_broadcast, n):
    rows = stage(spark.range(3000).select("id", (F.col("id") % 50).alias("k"), F.expr("nullif(id % 7, 3)").alias("m")), "wide")
    few = [
        (stage(spark.range(0, 3000, 300).select(F.col("id").alias("a"), F.lit("x").alias("ax")), "few"), ["a"], [F.col("id")]),
        (stage(spark.range(40, 60).select(F.col("id").alias("b"), F.lit(1).alias("bx")), "few"), ["b"], [F.col("k")]),
        (stage(spark.range(3, 5).select(F.col("id").alias("c"), F.col("id").alias("d")), "few"), ["c", "d"], [F.col("m"), F.col("m")]),
    ][:n]
    want = rows
    for other, names, equals in few:
        want = want.join(other, [F.col(x) == e for x, e in zip(names, equals)], "left")
    got = left_join_few(rows, few).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_documents_are_not_shuffled(spark):
    entity = ENTITIES["orders"]
    found = quarantine_rows(rejected_rows(tagged(spark)[0]), entity, F.lit("2024-01-01").cast("timestamp_ntz"))
    exchanges = [line for line in plan_of(found).splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("raw_data" in line or "quarantine_id" in line for line in exchanges)


def test_shuffles_of_ended_writes_are_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "LONG_WRITE", 0.0)
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    stage(spark.range(1000).repartition(3), "shuffled")
    # the listeners of the write may still have it; later writes collect again
    for _ in range(20):
        if shuffled() <= before:
            return
        time.sleep(0.2)
        stage(spark.range(1), "later")
    raise AssertionError("the shuffle is still there")


def test_tables_staged_on_the_way_are_removed(spark):
    paths = []

    def build():
        one = stage(spark.range(10), "on-the-way")
        paths.extend(one.inputFiles())
        return one.where("id > 4")

    kept = stage_only(spark, "result", build)
    fs = spark._jvm.org.apache.hadoop.fs
    path = fs.Path(paths[0])
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    assert kept.count() == 5
