from datetime import datetime

from pyspark.sql import functions as F

from sluice import load_order
from sluice.functions.casts import coerce
from sluice.functions.pii import hash_value
from sluice.functions.text import file_stem, normal_id, stage_of_reason
from sluice.functions.times import is_breached, is_met, minutes_between, time_key
from sluice.operators.dedup import split_duplicates
from sluice.operators.insert import absent_rows
from sluice.operators.integrity import first_missing, split_orphans
from sluice.operators.ledger import current_state, files_to_process
from sluice.plans.calendar import dim_date, dim_time
from sluice.spec import ENTITIES, entity_for_file


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_parents_come_first():
    order = load_order()
    for e in ENTITIES.values():
        for edge in e.edges:
            assert order.index(edge.entity) < order.index(e.name)
    assert order.index("cities") < order.index("regions")
    # with the two calendar keys of each fact these are the 28 edges of the star
    assert sum(len(e.edges) for e in ENTITIES.values()) + 6 == 28


def test_files_belong_to_entities():
    assert entity_for_file("orders.json").name == "orders"
    assert entity_for_file("restaurants.csv").name == "restaurants"
    for unknown in ("orders.csv.bak", "x.csv", "orders.xml"):
        try:
            entity_for_file(unknown)
        except ValueError:
            continue
        raise AssertionError(unknown)


def test_scalar_functions(spark):
    ids = spark.createDataFrame(
        [(" 370.0 ",), ("370",), ("3.7",), ("f2e3",), ("-5.0",), ("0012.0",)], "x string"
    )
    assert [r[0] for r in ids.select(normal_id(F.col("x"))).collect()] == [
        "370", "370", "3.7", "f2e3", "-5", "12",
    ]
    one = spark.range(1).select(
        file_stem(F.lit("a/b/Orders.JSON")).alias("stem"),
        stage_of_reason(F.lit("Referential problem")).alias("stage"),
        F.expr(coerce("' NULL '", "int")).alias("none"),
        F.expr(coerce("' 370.0 '", "int")).alias("number"),
        hash_value(F.lit(" N/A ")).alias("kept"),
        hash_value(F.lit("abc")).alias("hashed"),
    ).first()
    assert one["stem"] == "orders" and one["stage"] == "orphan"
    assert one["none"] is None and one["number"] == 370 and one["kept"] == " N/A "
    assert one["hashed"] == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"


def test_service_level_functions(spark):
    t = lambda s: F.lit(s).cast("timestamp_ntz")
    a, b, none = t("2024-01-02 09:07:00"), t("2024-01-02 09:06:15.5"), t(None)
    got = spark.range(1).select(
        time_key(a), minutes_between(a, b), is_breached(none, a), is_met(none, a), is_met(a, a),
        is_breached(a, b),
    ).first()
    assert [str(v) for v in got] == ["907", "-0.74", "True", "False", "True", "True"]


def test_calendar_sizes_and_edges(spark):
    days = dim_date(spark)
    assert days.count() == 4383
    d = days.where("date_key = 20270101").first()
    assert (d["week"], d["day_name"], d["day_of_week"], d["month_name"]) == (
        53, "Friday", 6, "January",
    )
    clock = dim_time(spark)
    assert clock.count() == 1440
    assert values(clock.where("time_key IN (1359, 1400, 559)").select("full_time", "shift")) == [
        ("05:59:00", "night"), ("13:59:00", "morning"), ("14:00:00", "evening"),
    ]


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, "1.0"), (2, None), (3, "7")], "i int, fk string")
    parent = spark.createDataFrame([(1,), (1,)], "pk int")
    clean, orphans = split_orphans(child, "fk", parent, "pk")
    assert values(clean.select("i")) == [(1,), (2,)] and values(orphans.select("i")) == [(3,)]
    _, all_of_them = split_orphans(child, "fk", parent.where("false"), "pk")
    assert values(all_of_them.select("i")) == [(1,), (3,)]
    named = first_missing(child.selectExpr("i", "i AS a", "fk"), [("fk", parent, "pk"),
                                                                ("a", parent, "pk")])
    assert {r["i"]: r["unresolved_fk"] for r in named.collect()} == {1: None, 2: "a", 3: "fk"}


def test_hot_key_keeps_one_row(spark):
    rows = spark.range(3000).selectExpr("id % 3 * 0 + IF(id < 2000, 0, id) AS k", "id AS o")
    kept, dropped = split_duplicates(rows, ["k"], ["o"])
    assert kept.count() == 1001 and dropped.count() == 1999
    assert kept.where("k = 0").first()["o"] == 0


def test_first_write_wins(spark):
    old = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(1, "x", 0), (2, "b", 2), (2, "a", 1)], "id int, v string, o int")
    assert values(absent_rows(new, old, "id", "o").select("id", "v")) == [(2, "a")]


def test_ledger(spark):
    at = [datetime(2024, 1, d) for d in (1, 2, 3)]
    events = spark.createDataFrame(
        [
            ("a", "h", "failed", at[0]), ("a", "h", "success", at[1]),
            ("b", "h", "success", at[0]), ("b", "h", "failed", at[2]),
            ("c", "h", "success", at[0]),
        ],
        "file_path string, file_hash string, status string, processed_at timestamp_ntz",
    )
    assert values(current_state(events).select("file_path", "status")) == [
        ("a", "success"), ("b", "failed"), ("c", "success"),
    ]
    found = spark.createDataFrame(
        [("a", "h"), ("b", "h"), ("c", "changed"), ("d", "h")], "file_path string, file_hash string"
    )
    assert values(files_to_process(found, events)) == [("b", "h"), ("c", "changed"), ("d", "h")]
