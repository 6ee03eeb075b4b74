"""Daily runs by date, and folding of small loads."""

import threading
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_jobs import write_csv

from sluice.plans import daily
from sluice.plans.compaction import fold, sweep
from sluice.plans.ingest import ingest
from sluice.sources import folds
from sluice.sources.warehouse import BATCH_ID, Warehouse

DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(3)]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse")).create()


def at(day, hour=2):
    return datetime(day.year, day.month, day.day, hour)


def land(root, day, *ids):
    write_csv(root / day.isoformat() / "teams.csv",
              [dict(team_id=i, team_name=f"{day}") for i in ids])


def teams(w):
    return {r["team_id"]: r["team_name"] for r in w.read("dim_team").collect()}


def test_a_late_start_catches_up_in_order_and_a_second_start_does_nothing(spark, warehouse, tmp_path):
    root = tmp_path / "batch"
    for i, day in enumerate(DAYS):
        land(root, day, 1, i + 10)
    (root / "not-a-day").mkdir()
    (root / "2024-02-31").mkdir()
    early = at(DAYS[2], 0)
    assert daily.due_days(spark, str(root), warehouse, early) == DAYS[:2]
    assert [d.day for d in daily.run_due(spark, str(root), warehouse, early)] == DAYS[:2]
    assert [d.day for d in daily.run_due(spark, str(root), warehouse, at(DAYS[2]))] == DAYS[2:]
    assert daily.run_due(spark, str(root), warehouse, at(DAYS[2], 9)) == []
    # the first day to hold a key counts
    assert teams(warehouse) == {1: "2024-01-01", 10: "2024-01-01", 11: "2024-01-02", 12: "2024-01-03"}
    rows = warehouse.read(daily.TABLE).orderBy("day").collect()
    assert [(r["day"], r["status"], r["files_loaded"]) for r in rows] == [(d, "success", 1) for d in DAYS]
    assert daily.due_days(spark, str(root), warehouse, at(DAYS[2]), first=DAYS[2]) == []


def test_a_failed_day_holds_later_days_and_is_run_again(spark, warehouse, tmp_path, monkeypatch):
    root = tmp_path / "batch"
    for i, day in enumerate(DAYS):
        land(root, day, i)
    whole = daily.ingest_folder

    def broken(spark, folder, *rest):
        if folder.endswith("2024-01-02"):
            raise OSError("storage is away")
        return whole(spark, folder, *rest)

    monkeypatch.setattr(daily, "ingest_folder", broken)
    with pytest.raises(OSError):
        daily.run_due(spark, str(root), warehouse, at(DAYS[2]))
    found = {r["day"]: (r["status"], r["error_msg"]) for r in warehouse.read(daily.TABLE).collect()}
    assert found == {DAYS[0]: ("success", None), DAYS[1]: ("failed", "OSError: storage is away")}
    monkeypatch.undo()
    assert [d.day for d in daily.run_due(spark, str(root), warehouse, at(DAYS[2]))] == DAYS[1:]
    assert {r["status"] for r in warehouse.read(daily.TABLE).collect()} == {"success"}
    assert set(teams(warehouse)) == {0, 1, 2}


def test_a_folder_that_comes_late_is_due_then(spark, warehouse, tmp_path):
    root = tmp_path / "batch"
    assert daily.run_due(spark, str(root), warehouse, at(DAYS[2])) == []
    land(root, DAYS[2], 3)
    daily.run_due(spark, str(root), warehouse, at(DAYS[2]))
    land(root, DAYS[0], 1)
    assert [d.day for d in daily.run_due(spark, str(root), warehouse, at(DAYS[2]))] == DAYS[:1]


def many_loads(w, n, table="dim_team"):
    for i in range(n):
        folder = f"{w.path(table)}/{BATCH_ID}=load-{i:05d}"
        columns = {"team_id": pa.array([i], pa.int32()), "team_name": [f"t{i}"]}
        write_folder(folder, pa.table(columns))


def write_folder(folder, data):
    Path(folder).mkdir(parents=True)
    pq.write_table(data, f"{folder}/part-0.parquet")


def files_of(w, table="dim_team"):
    return w.read(table).inputFiles()


def test_a_thousand_loads_become_few_files(spark, warehouse):
    w = warehouse
    many_loads(w, 1000)
    before = w.read("dim_team")
    loads = w.loads("dim_team")
    times = w.load_times("dim_team")
    assert fold(w, "dim_team") == 1000
    assert len(files_of(w)) == 1
    assert sorted(r[0] for r in w.read("dim_team").select("team_id").collect()) == list(range(1000))
    # a reader planned before still sees each row once
    assert before.agg({"team_id": "sum"}).first()[0] == 999 * 500
    # loads are known by their names and times as before
    assert w.loads("dim_team") == loads and w.load_times("dim_team") == times
    assert [r["team_id"] for r in w.read_load("dim_team", "load-00007").collect()] == [7]
    some = w.read_loads("dim_team", ["load-00007", "load-00999"]).collect()
    assert sorted((r["team_id"], r[BATCH_ID]) for r in some) == [(7, "load-00007"), (999, "load-00999")]
    assert fold(w, "dim_team") == 0
    # folders go only when they are old enough
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert sweep(w, "dim_team", now, timedelta(days=1)) == []
    assert len(sweep(w, "dim_team", now + timedelta(days=2), timedelta(days=1))) == 1000
    assert w.read("dim_team").count() == 1000 and w.loads("dim_team") == loads


def test_a_folded_load_can_be_written_again(spark, warehouse):
    w = warehouse
    many_loads(w, 3)
    fold(w, "dim_team")
    again = spark.createDataFrame([(1, "new"), (50, "more")], "team_id int, team_name string")
    w.write_load("dim_team", again, "load-00001")
    assert teams(w) == {0: "t0", 1: "new", 2: "t2", 50: "more"}
    assert w.read("dim_team", but_batch="load-00001").count() == 2
    assert w.read("dim_team", but_batch="load-00002").count() == 3
    many = [{r["team_id"] for r in w.read_load("dim_team", f"load-0000{i}").collect()} for i in range(3)]
    assert many == [{0}, {1, 50}, {2}]
    w.write_load("dim_team", spark.createDataFrame([(9, "x")], again.schema), "load-9")
    assert fold(w, "dim_team", fan_in=1) == 2 and len(files_of(w)) == 1
    assert teams(w) == {0: "t0", 1: "new", 2: "t2", 9: "x", 50: "more"}
    assert w.folds("dim_team").replaced == {}


def test_a_fold_that_stops_before_its_version_changes_nothing(spark, warehouse, monkeypatch):
    w = warehouse
    many_loads(w, 4)
    import sluice.plans.compaction as compaction

    def stop(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(compaction, "commit", stop)
    with pytest.raises(KeyboardInterrupt):
        fold(w, "dim_team")
    assert w.read("dim_team").count() == 4 and not w.folds("dim_team").folds
    monkeypatch.undo()
    assert fold(w, "dim_team") == 4 and w.read("dim_team").count() == 4
    with pytest.raises(RuntimeError):
        folds.commit(spark, w.path("dim_team"), w.folds("dim_team"))


def test_reads_beside_folds_see_each_row_once(spark, warehouse):
    w = warehouse
    many_loads(w, 40)
    seen, done = [], threading.Event()

    def reader():
        while not done.is_set():
            seen.append(w.read("dim_team").agg({"team_id": "sum"}).first()[0])

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        for i in range(3):
            extra = spark.createDataFrame([(0, "zero")], "team_id int, team_name string")
            w.write_load("dim_team", extra, f"extra-{i}")
            w.write_load("dim_team", extra, f"more-{i}")
            assert fold(w, "dim_team", fan_in=2) > 0
    finally:
        done.set()
        thread.join()
    assert seen and set(seen) == {39 * 20}


def test_loads_and_ledger_work_over_folds(spark, warehouse, tmp_path):
    w = warehouse
    a = write_csv(tmp_path / "a" / "teams.csv", [dict(team_id=1, team_name="a")])
    b = write_csv(tmp_path / "b" / "teams.csv", [dict(team_id=1, team_name="b"), dict(team_id=2, team_name="b")])
    ingest(spark, "teams", [a], w, "a", at(DAYS[0]))
    ingest(spark, "teams", [b], w, "b", at(DAYS[1]))
    for table in ("dim_team", "processed_files", "pipeline_file_log", "quarantine"):
        fold(w, table)
    assert ingest(spark, "teams", [a], w, "c", at(DAYS[2])).skipped
    # the same load again replaces itself, also from a fold
    assert ingest(spark, "teams", [b], w, "b", at(DAYS[1])).inserted == 1
    assert teams(w) == {1: "a", 2: "b"}
    with pytest.raises(ValueError):
        fold(w, "retry_state")
