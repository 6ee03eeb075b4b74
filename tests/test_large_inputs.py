"""What keeps time and memory in proportion to the input."""

import re
from pathlib import Path

from helpers import raw_frame, row
from pyspark.sql import functions as F

from __spark_entry__ import queries
from sluice.operators.cascade import tag
from sluice.operators.integrity import flag_missing
from sluice.plans.dims import conform
from sluice.session import as_large, fits_broadcast, stage
from sluice.sources.warehouse import Warehouse
from sluice.operators.cascade import FILE, RULE, STAGE
from sluice.operators.quarantine import quarantine_rows
from sluice.spec import ENTITIES
from sluice.streaming import figures

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_many_rows_of_small_files_are_not_broadcast(spark):
    keys = stage(spark.range(400_000).selectExpr("CAST(id AS STRING) AS key"), "keys")
    assert not fits_broadcast(keys)
    assert fits_broadcast(keys.where("CAST(key AS INT) < 100").limit(100))
    joined = keys.limit(10).join(as_large(keys), "key")
    assert joined.count() == 10 and "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_missing_keys_of_many_parents(spark):
    # the estimate of a table with many empty columns would allow a broadcast
    wide = spark.range(400_000).selectExpr("CAST(id AS STRING) AS key", *[f"CAST(NULL AS STRING) AS n{i}" for i in range(9)])
    parents = stage(wide, "parents")
    child = spark.createDataFrame([("5",), ("400000",), (None,)], "fk string")
    found = flag_missing(child, F.col("fk"), parents, "key", "missing", as_text=True)
    assert {r["fk"]: bool(r["missing"]) for r in found.collect()} == {"5": False, "400000": True, None: False}


def test_texts_are_parsed_above_the_joins_and_once(spark):
    tickets = plan(queries()["typed_tickets"](spark, SMALL))
    assert not [line for line in tickets.splitlines() if "Join" in line and "RLIKE" in line]
    assert len(re.findall(r"try_cast\(resolved_at#\d+ as timestamp_ntz\)", tickets)) == 1


def test_rules_are_evaluated_once_for_all_readers_of_the_tags(spark):
    rows = [row("customers"), row("customers"), row("customers", customer_id="x")]
    tagged = tag(raw_frame(spark, "customers", rows), ENTITIES["customers"])
    assert "[.]com" not in plan(tagged.where("reject_stage IS NOT NULL"))
    assert [r["reject_rule"] for r in tagged.orderBy("_row").collect()] == [None, "duplicate", "dtype:customer_id"]


def test_only_the_columns_asked_for_are_staged(spark):
    rows = [row("customers"), row("customers"), row("customers", email="x")]
    tagged = tag(raw_frame(spark, "customers", rows), ENTITIES["customers"], keep=["_file"])
    assert tagged.columns == ["_file", "reject_rule", "reject_stage"]
    assert "email" not in plan(tagged)
    assert sorted(str(r["reject_rule"]) for r in tagged.collect()) == ["None", "duplicate", "duplicate"]


def test_a_large_load_is_counted_by_several_tasks(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w")).create()
    rows = spark.range(200_000).selectExpr(
        "CAST(id AS STRING) AS ticket_id", "CAST(id AS INT) AS agent_id",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS created_at",
    )
    warehouse.write_load("fact_ticket", conform(rows, "fact_ticket"), "one")
    adaptive = "spark.sql.adaptive."
    sizes = {
        f"{adaptive}advisoryPartitionSizeInBytes": "64k",
        f"{adaptive}coalescePartitions.minPartitionSize": "16k",
        f"{adaptive}coalescePartitions.parallelismFirst": "false",
    }
    for key, size in sizes.items():
        spark.conf.set(key, size)
    try:
        figures.maintain(warehouse, ["one"])
    finally:
        for key in sizes:
            spark.conf.unset(key)
    folder = Path(warehouse.path(figures.TABLE))
    assert len(list(folder.glob("_batch_id=one/*.parquet"))) > 1
    assert warehouse.read(figures.TABLE).agg(F.sum("total_tickets")).first()[0] == 200_000
    # a small load stays one file
    few = spark.createDataFrame([("t", 1)], "ticket_id string, agent_id int")
    warehouse.write_load("fact_ticket", conform(few, "fact_ticket"), "two")
    figures.maintain(warehouse, ["two"])
    assert len(list(folder.glob("_batch_id=two/*.parquet"))) == 1


def test_rejects_are_found_once_without_sorting(spark):
    entity = ENTITIES["ticket_events"]
    rules = [("a.json", "1", "records", "null:event_ts"), ("a.json", "1", "records", "duplicate"), ("b.json", "1", "records", "duplicate")]
    rows = [(f, rule, stage_, key, *["x"] * (len(entity.names) - 1)) for f, key, stage_, rule in rules]
    tagged = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (FILE, RULE, STAGE, *entity.names)))
    found = quarantine_rows(tagged, entity, F.lit("2024-01-01").cast("timestamp_ntz"))
    got = sorted((r["source_file"], r["rejection_rule"]) for r in found.collect())
    assert got == [("a.json", "duplicate"), ("b.json", "duplicate")]
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    without = quarantine_rows(tagged, entity, F.lit("2024-01-01").cast("timestamp_ntz"), texts=False)
    assert sorted(map(tuple, without.collect())) == sorted(map(tuple, found.drop("raw_data").collect()))


def test_wide_rows_are_not_sorted_to_meet_repeated_keys(spark):
    keys = stage(spark.range(400_000).selectExpr("CAST(id AS STRING) AS key"), "keys")
    joined = keys.limit(10).join(as_large(keys), "key", "left")._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in joined and "SortMergeJoin" not in joined
