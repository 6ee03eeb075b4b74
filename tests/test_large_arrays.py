"""JSON arrays that are too large for one cell are read in pieces, with the rows that Spark's reader gives."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice.operators.cascade import ARRIVED, FILE, ROW
from sluice.plans.ingest import ingest
from sluice.session import as_large, stage
from sluice.sources import files
from sluice.sources.files import array_elements, inventory, large_arrays, read_large_arrays, read_text_table
from sluice.sources.warehouse import Warehouse
from sluice.spec import ENTITIES
from helpers import VALID, row

ODD = [
    {"order_id": "1", "customer_id": 7, "total_amount": 1.50, "order_status": None, "driver_id": True},
    {"order_id": 'a "q" \\ } ] , {', "customer_id": 1e3, "restaurant_id": -0.0, "region_id": 12345678901234567890123},
    {"order_id": "\u00e9\u4e2d\n", "other": 1}, {},
]


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_rows_are_those_of_the_plain_reader(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(files, "PIECE", piece)
    paths = []
    for i, text in enumerate([json.dumps(ODD, indent=2), json.dumps(ODD, ensure_ascii=False), " [\n] "]):
        path = tmp_path / f"{i}" / "orders.json"
        path.parent.mkdir()
        path.write_text(text, encoding="utf-8")
        paths.append(f"file:{path}")
    # in this process, where the size of a piece is the one set
    assert [len(list(array_elements(p))) for p in paths] == [len(ODD), len(ODD), 0]
    entity = ENTITIES["orders"]
    got, want = read_large_arrays(spark, paths, entity), read_text_table(spark, paths, entity, "json")
    assert got.columns[:-4] == entity.names and sorted(got.columns) == sorted(want.columns)
    assert got.schema[ARRIVED].dataType == want.schema[ARRIVED].dataType
    rows = lambda df: sorted(map(str, df.select(*[c for c in want.columns if c != ROW]).collect()))
    assert rows(got) == rows(want)
    in_file = [r["order_id"] for r in got.where(F.col(FILE).endswith("0/orders.json")).orderBy(ROW).collect()]
    assert in_file == [o.get("order_id") for o in ODD]


@pytest.mark.parametrize("text", ['{"a": 1}', '[{"a": 1}', "[{'a': 1}]", '[{"a": 1}, 2]', '[{"a": 1} {"a": 2}]', '[{"a": 1}] x', '[{"a": 1},]', "", '[{"a": "', '[{"a": [1]}]'])
def test_other_files_are_left_to_the_plain_reader(tmp_path, text):
    path = tmp_path / "orders.json"
    path.write_text(text)
    with pytest.raises(ValueError):
        list(array_elements(f"file:{path}"))
    assert files._array_names(f"file:{path}") is None


def test_load_of_large_arrays(spark, tmp_path, monkeypatch):
    orders = [row("orders", order_id=f"o{i % 40}", total_amount=str(i)) for i in range(45)]
    path = tmp_path / "in" / "orders.json"
    path.parent.mkdir()
    path.write_text(json.dumps(orders))
    names = inventory(spark, [str(path)]).first()
    assert large_arrays(spark, [str(path)]) == set() and large_arrays(spark, [str(path)], 10) == {f"file:{path}"}
    # limits as small as this file stand for large files
    monkeypatch.setattr(files, "CELL_BYTES", 10)
    assert inventory(spark, [str(path)]).first() == names and sorted(names["columns"]) == sorted(VALID["orders"])
    read = []
    monkeypatch.setattr("sluice.plans.ingest.read_large_arrays", lambda *a: read.append(a[1]) or read_large_arrays(*a))
    warehouse = Warehouse(spark, str(tmp_path / "w")).create()
    for name in ("customer", "driver", "restaurant"):
        warehouse.write_load(f"dim_{name}", spark.createDataFrame([(1,)], f"{name}_id int").withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in warehouse.read(f"dim_{name}").schema.fields if f.name != f"{name}_id"}), "p")
    done = ingest(spark, "orders", [str(path)], warehouse, "one", datetime(2024, 1, 2))
    assert done.inserted == 40 and read == [[f"file:{path}"]]
    amounts = {r["order_id"]: int(r["total_amount"]) for r in warehouse.read("fact_order").collect()}
    assert amounts == {f"o{i}": i for i in range(40)}


def test_keys_only_are_sorted_not_hashed(spark):
    keys = stage(spark.range(400_000).selectExpr("CAST(id AS STRING) AS key"), "keys")
    joined = keys.limit(10).join(as_large(keys, meets_wide=False), "key", "left_semi")
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
