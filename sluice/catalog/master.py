"""Queries on the whole star: small dimensions, the cold start, every edge, the retry job."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.catalog.fixtures import EVERY, FIXTURES, LOOKUPS, PARENTS, parent_frames, table
from sluice.catalog.operations import quarantine_cte
from sluice.catalog.registry import register
from sluice.catalog.rules_sql import cast_sql, is_null, number, tagged_ctes
from sluice.catalog.star import _FACT_CELLS, _LOOKED_UP, conformed_sql, loaded_at, loaded_orders
from sluice.functions.pii import mask
from sluice.operators.cascade import ARRIVED, EXCESS, FILE, ROW, STAGE, clean_rows, tag
from sluice.operators.quarantine import as_json, quarantine_rows, write_backup
from sluice.operators.schema import typed
from sluice.plans.calendar import FIRST_DAY, LAST_DAY
from sluice.plans.dims import build_dimension, conform
from sluice.plans.facts import build_fact
from sluice.plans.ingest import ingest, load_calendar, seed
from sluice.plans.integrity import star_edges, star_report
from sluice.plans.retry import retry
from sluice.session import scratch_path, side_by_side, temporary_stages
from sluice.sources.files import read_text_table
from sluice.sources.warehouse import Warehouse
from sluice.spec import BATCH, ENTITIES, STREAM, load_order

NOW = datetime(2024, 6, 1)
MASTERS = [n for n in load_order() if ENTITIES[n].kind == BATCH]
FACTS = [n for n in load_order() if ENTITIES[n].kind == STREAM]


# -------------------------------------------------------- landing files


def land(rows: DataFrame, folder: str, name: str, split: str | None = None) -> str:
    """Text lines as files called ``name``, one in each written sub-folder.

    Source systems name their files; Spark names its own.  Each part file is
    given the name in a folder of its own; only paths come to the driver.
    ``split`` names a column with one file for each of its values.
    """
    spark = rows.sparkSession
    written = scratch_path(spark, "lines")
    writer = rows.write.partitionBy(split) if split else rows.write
    writer.text(written)
    files, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    root = files.Path(written)
    fs = root.getFileSystem(conf)
    found, i = fs.listFiles(root, True), 0
    while found.hasNext():
        path = found.next().getPath()
        if path.getName().startswith("part-"):
            to = files.Path(f"{folder}/{i:05d}")
            fs.mkdirs(to)
            fs.rename(path, files.Path(to, name))
            i += 1
    return folder


def csv_lines(rows: DataFrame, names: list[str]) -> DataFrame:
    """CSV text of the rows in their order within a partition; the header comes first in each."""
    cells = [F.regexp_replace(F.coalesce(F.col(n), F.lit("")), '"', '""') for n in names]
    line = F.concat(F.lit('"'), F.concat_ws('","', *cells), F.lit('"'))
    # the first line of a file holds the header as well
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    return rows.select(F.when(first, F.concat(F.lit(",".join(names) + "\n"), line)).otherwise(line).alias("value"))


def land_master(spark: SparkSession, sf_dir: str, name: str, folder: str, files: int = 4) -> str:
    """The master export of an entity as some CSV files; copies of a key are in one file."""
    entity = ENTITIES[name]
    rows = EVERY[name].frame(spark, sf_dir).repartition(files, entity.key)
    rows = rows.sortWithinPartitions(ROW)
    return land(csv_lines(rows, entity.names), f"{folder}/{name}", f"{name}.csv")


def land_json(rows: DataFrame, name: str, folder: str) -> str:
    """Rows as one JSON array a file, by the file that each row names."""
    entity = ENTITIES[name]
    at = Window.partitionBy(FILE).orderBy(entity.key, ROW)
    places = rows.withColumns({"_n": F.row_number().over(at), "_last": F.lead(ROW).over(at).isNull()})
    begin = F.when(F.col("_n") == 1, "[").otherwise("")
    end = F.when(F.col("_last"), "]").otherwise(",")
    lines = places.select(
        F.md5(FILE).alias("_of"), "_n", F.concat(begin, as_json(*entity.names), end).alias("value")
    )
    lines = lines.repartition("_of").sortWithinPartitions("_of", "_n").drop("_n")
    return land(lines, folder, f"{name}.json", split="_of")


@register(
    "json_round_trip",
    f"WITH src AS ({FIXTURES['orders'].sql()}) SELECT {', '.join(ENTITIES['orders'].names)} FROM src",
)
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write raw orders as one JSON array a month and read them back untyped."""
    folder = land_json(FIXTURES["orders"].frame(spark, sf_dir), "orders", scratch_path(spark, "json"))
    rows = read_text_table(spark, [f"{folder}/*"], ENTITIES["orders"], "json")
    return rows.drop(FILE, ROW, ARRIVED, EXCESS)


# ------------------------------------------------------ clean rows, SQL


def clean_cte(name: str) -> str:
    """CTEs ending in ``{name}_ok``: typed rows that pass the whole cascade."""
    entity = ENTITIES[name]
    cells = ", ".join(f"{cast_sql(entity, n)} AS {n}" for n in entity.names)
    return (
        f"{tagged_ctes(name, f'{name}_')}, {name}_ok AS (SELECT {cells} FROM {name}_tagged "
        "WHERE reject_stage IS NULL)"
    )


def clean(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Typed rows that pass the whole cascade."""
    fixture = EVERY[name]
    tagged = tag(fixture.frame(spark, sf_dir), fixture.spec, parent_frames(spark, sf_dir, name))
    return typed(clean_rows(tagged), fixture.spec)


#: entity -> (its lookup, key, name in the lookup, name here)
LOOKED_UP = {
    "regions": ("cities", "city_id", "city_name", "city_name"),
    "reasons": ("reason_categories", "reason_category_id", "category_name", "reason_category"),
}


def dimension_sql(name: str) -> tuple[str, str]:
    """(CTEs, query) of a dimension's rows."""
    if name not in LOOKED_UP:
        return clean_cte(name), conformed_sql(name, f"{name}_ok")
    other, key, there, here = LOOKED_UP[name]
    source = f"""(SELECT c.*, l.{there} AS _name FROM {name}_ok c LEFT JOIN {other}_ok l
        ON c.{key} = l.{key})"""
    return f"{clean_cte(other)}, {clean_cte(name)}", conformed_sql(name, source, {here: "_name"})


def dimension(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lookup = None
    if name in LOOKED_UP:
        other = LOOKED_UP[name][0]
        lookup = conform(clean(spark, sf_dir, other), ENTITIES[other].table)
    rows = mask(clean(spark, sf_dir, name), ENTITIES[name])
    return build_dimension(ENTITIES[name], rows, lookup, loaded_at())


def _register_dimension(name: str) -> None:
    ctes, sql = dimension_sql(name)

    @register(f"{ENTITIES[name].table}_build", f"WITH {ctes} {sql}")
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dimension(spark, sf_dir, name)


for _name in LOOKUPS:
    _register_dimension(_name)


# ------------------------------------------------------------ cold start

_SEEDED = " UNION ALL ".join(
    f"SELECT '{ENTITIES[n].table}' AS table_name, count(*) AS loaded_rows, "
    f"(SELECT count(*) FROM {n}_tagged WHERE reject_stage IS NOT NULL) AS rejected_rows FROM {n}_ok"
    for n in MASTERS
)


@register("master_seed", f"WITH {', '.join(clean_cte(n) for n in MASTERS)} {_SEEDED}")
def master_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cold start on CSV exports of all 13 dimensions: rows loaded and rejected."""
    folder = scratch_path(spark, "master")
    side_by_side(lambda n: land_master(spark, sf_dir, n, folder), MASTERS)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    seed(spark, folder, warehouse, NOW)
    tables = [ENTITIES[n].table for n in MASTERS]
    rows = None
    for name in tables:
        part = warehouse.read(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("loaded_rows"))
        rows = part if rows is None else rows.unionByName(part)
    log = warehouse.read("pipeline_file_log").groupBy(F.col("source_table").alias("table_name"))
    return rows.join(log.agg(F.sum("quarantined").alias("rejected_rows")), "table_name")


# ------------------------------------------------------------- all edges


def _key_sql(child: str, column: str, parent: str, key: str) -> str:
    if parent in ("dim_date", "dim_time"):
        known = (
            f"{column} BETWEEN {FIRST_DAY:%Y%m%d} AND {LAST_DAY:%Y%m%d}"
            if parent == "dim_date"
            else f"{column} BETWEEN 0 AND 2359 AND {column} % 100 < 60"
        )
        orphan = f"{column} IS NOT NULL AND NOT ({known})"
    else:
        orphan = f"{column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"
    return f"""SELECT '{child}' AS child, '{column}' AS fk_column, '{parent}' AS parent,
        count(*) AS child_rows, count({column}) AS keyed_rows,
        count(*) FILTER (WHERE {orphan}) AS orphan_rows FROM {child}"""


def _star_sql() -> str:
    parts = []
    for n in load_order():
        parts.append(clean_cte(n))
        if n in LOOKED_UP:
            # the lookup's clean rows are there already
            other, key, there, here = LOOKED_UP[n]
            source = f"(SELECT c.*, l.{there} AS _name FROM {n}_ok c LEFT JOIN {other}_ok l ON c.{key} = l.{key})"
            sql = conformed_sql(n, source, {here: "_name"})
        elif n in FACTS:
            source = _LOOKED_UP.replace("ok.*", f"{n}_ok.*").replace("FROM ok", f"FROM {n}_ok").replace("ok.order_id", f"{n}_ok.order_id")
            sql = conformed_sql(n, source if n == "tickets" else f"{n}_ok", _FACT_CELLS[n])
        else:
            sql = conformed_sql(n, f"{n}_ok")
        parts.append(f"{ENTITIES[n].table} AS ({sql})")
    edges = " UNION ALL ".join(_key_sql(*edge) for edge in star_edges())
    return f"WITH {', '.join(parts)} {edges}"


@register("star_integrity", _star_sql())
def star_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every edge of a loaded star: rows of the child, rows with a key, rows whose key leads nowhere."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse")).create()
    load_calendar(spark, warehouse)

    def load(name: str) -> None:
        entity = ENTITIES[name]
        # the staged rows of a table are not needed once it is loaded
        with temporary_stages(spark):
            if entity.kind == BATCH:
                rows = dimension(spark, sf_dir, name)
            else:
                orders = loaded_orders(spark, sf_dir) if name == "tickets" else None
                rows = build_fact(entity, clean(spark, sf_dir, name), orders, loaded_at())
            warehouse.write_load(entity.table, rows, "star")

    side_by_side(load, load_order())
    return star_report(warehouse)


# ------------------------------------------------------------- retry job

_LATE = "c_custkey % 50 = 0"


def _retry_sql() -> str:
    entity = ENTITIES["orders"]
    cells = ", ".join(f"{cast_sql(entity, n)} AS {n}" for n in entity.names)
    still = " OR ".join(
        f"(NOT {is_null(k.column)} AND {number(k.column)} NOT IN "
        f"(SELECT CAST({PARENTS['orders'][k.entity][1]} AS DOUBLE) FROM {PARENTS['orders'][k.entity][0]}))"
        for k in entity.foreign_keys
    )
    return f"""WITH {tagged_ctes('orders')}, ok AS (SELECT {cells} FROM tagged
        WHERE reject_stage IS NULL OR (reject_stage = 'orphan' AND NOT ({still})))
        {conformed_sql('orders', 'ok', _FACT_CELLS['orders'])}"""


@register("retry_job_orders", _retry_sql())
def retry_job_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch and the retry job on JSON files of orders: some customers come after their orders."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse")).create()
    for name, rows in parent_frames(spark, sf_dir, "orders").items():
        warehouse.write_load(ENTITIES[name].table, conform(rows, ENTITIES[name].table), "early")
    folder = land_json(FIXTURES["orders"].frame(spark, sf_dir), "orders", scratch_path(spark, "landing"))
    ingest(spark, "orders", [folder], warehouse, "day-1", NOW)
    late = table(spark, sf_dir, "customer").where(_LATE).selectExpr("c_custkey AS customer_id")
    warehouse.write_load("dim_customer", conform(late, "dim_customer"), "late")
    retry(spark, warehouse, "retry-1", NOW + timedelta(hours=2))
    return warehouse.read("fact_order").drop("order_sk", "_loaded_at")


# -------------------------------------------------------------- backups


@register(
    "quarantine_backup",
    f"""WITH {quarantine_cte('customers')} SELECT '2024-06-01' AS day, rejection_stage, rejection_rule,
        count(*) AS row_count FROM q GROUP BY 2, 3""",
)
def quarantine_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV copies that a load leaves of its quarantine, read back and counted by rule."""
    fixture = FIXTURES["customers"]
    tagged = tag(fixture.frame(spark, sf_dir), fixture.spec).where(F.col(STAGE).isNotNull())
    at = F.lit(NOW).cast("timestamp_ntz")
    path = scratch_path(spark, "backup")
    write_backup(quarantine_rows(tagged, fixture.spec, at), path, BATCH, "day-1")
    names = "quarantine_id source_file source_table rejection_reason rejection_stage rejection_rule raw_data quarantined_at"
    schema = ", ".join(f"{n} string" for n in names.split())
    read = spark.read.schema(f"{schema}, kind string, load string, date string")
    rows = read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return rows.groupBy(F.col("date").alias("day"), "rejection_stage", "rejection_rule").agg(
        F.count("*").alias("row_count")
    )
