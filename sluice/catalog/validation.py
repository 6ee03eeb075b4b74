"""Queries on typing, rules, duplicates and foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.catalog.fixtures import FIXTURES, parent_frames, table
from sluice.catalog.registry import register
from sluice.catalog.rules_sql import (
    cast_sql,
    is_null,
    schema_cases,
    tagged_ctes,
    when,
)
from sluice.operators.cascade import (
    FILE,
    ROW,
    RULE,
    STAGE,
    null_profile,
    tag,
    tag_schema,
)
from sluice.operators.dedup import duplicate_rate, split_duplicates
from sluice.operators.integrity import count_edge, first_missing, split_orphans
from sluice.operators.records import null_columns
from sluice.operators.schema import typed_passed


def tagged_fixture(
    spark: SparkSession, sf_dir: str, name: str, keep: list[str] | None = None
) -> DataFrame:
    fixture = FIXTURES[name]
    parents = parent_frames(spark, sf_dir, name)
    return tag(fixture.frame(spark, sf_dir), fixture.spec, parents, keep=keep)


def _typed_sql(name: str) -> str:
    f = FIXTURES[name]
    cells = ", ".join(f"{cast_sql(f.spec, n)} AS {n}" for n in f.spec.names)
    return (
        f"WITH src AS ({f.sql()}) SELECT {cells} FROM src "
        f"WHERE {when(schema_cases(f.spec))} IS NULL"
    )


def _rejects_sql(name: str) -> str:
    f = FIXTURES[name]
    return (
        f"WITH src AS ({f.sql()}) SELECT DISTINCT {', '.join(f.spec.names)}, "
        f"{when(schema_cases(f.spec))} AS reject_rule FROM src "
        f"WHERE {when(schema_cases(f.spec))} IS NOT NULL"
    )


def _register_typing(name: str) -> None:
    fixture = FIXTURES[name]

    @register(f"typed_{name}", _typed_sql(name))
    def typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
        return typed_passed(fixture.frame(spark, sf_dir), fixture.spec)

    @register(f"schema_rejects_{name}", _rejects_sql(name))
    def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
        failed = tag_schema(fixture.frame(spark, sf_dir), fixture.spec)
        return failed.where(F.col(RULE).isNotNull()).drop(FILE, ROW).distinct()


def _register_rules(name: str) -> None:
    fixture = FIXTURES[name]
    key = fixture.spec.key
    by_row = [] if fixture.order else [ROW]
    kept = [key, FILE, *by_row]
    columns = [*kept, STAGE, RULE]

    @register(
        f"record_rules_{name}",
        f"WITH {tagged_ctes(name)} SELECT {', '.join(columns)} FROM tagged",
    )
    def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tagged_fixture(spark, sf_dir, name, kept).select(*columns)


for _name in FIXTURES:
    _register_typing(_name)
    _register_rules(_name)


def _null_profile_sql() -> str:
    f = FIXTURES["customers"]
    parts = [
        f"SELECT '{n}' AS column_name, count(*) FILTER (WHERE {is_null(n)}) AS null_rows FROM ok"
        for n in null_columns(f.spec)
    ]
    return (
        f"WITH src AS ({f.sql()}), ok AS (SELECT * FROM src WHERE "
        f"{when(schema_cases(f.spec))} IS NULL) " + " UNION ALL ".join(parts)
    )


@register("null_profile", _null_profile_sql())
def null_profile_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixture = FIXTURES["customers"]
    return null_profile(fixture.frame(spark, sf_dir), fixture.spec)


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
_NUMBERED = f"""WITH n AS (SELECT *, row_number() OVER (
    PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem) """


@register("dedup_keep_first", _NUMBERED + "SELECT * EXCLUDE (rn) FROM n WHERE rn = 1")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_duplicates(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)[0]


@register("dedup_rejects", _NUMBERED + "SELECT * EXCLUDE (rn) FROM n WHERE rn > 1")
def dedup_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_duplicates(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)[1]


@register(
    "duplicate_rate",
    """WITH per_key AS (SELECT l_returnflag, l_orderkey, l_linenumber, count(*) AS n
           FROM lineitem GROUP BY ALL)
       SELECT l_returnflag, CAST(sum(n) AS BIGINT) AS row_count,
              CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
              round(sum(n - 1) / CAST(sum(n) AS DOUBLE), 4) AS duplicate_rate
       FROM per_key GROUP BY l_returnflag""",
)
def duplicate_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_key = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", *LINE_KEY).count()
    totals = per_key.groupBy("l_returnflag").agg(
        F.sum("count").alias("row_count"), F.sum(F.col("count") - 1).alias("duplicate_count")
    )
    return totals.withColumn(
        "duplicate_rate", duplicate_rate(F.col("row_count"), F.col("duplicate_count"))
    )


def _late_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_custkey % 50 <> 0")


_KNOWN = "(SELECT c_custkey FROM customer WHERE c_custkey % 50 <> 0)"
#: orders of which some name no customer at all
_SPARSE = "CASE WHEN o_orderkey % 67 <> 0 THEN o_custkey END"


def _sparse_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", f"{_SPARSE} AS o_custkey", "o_totalprice", "o_orderdate"
    )


_SPARSE_SQL = (
    f"WITH o AS (SELECT o_orderkey, {_SPARSE} AS o_custkey, o_totalprice, o_orderdate FROM orders) "
)


@register(
    "fk_orphans",
    _SPARSE_SQL + f"SELECT * FROM o WHERE o_custkey IS NOT NULL AND o_custkey NOT IN {_KNOWN}",
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, late = _sparse_orders(spark, sf_dir), _late_customers(spark, sf_dir)
    return split_orphans(orders, "o_custkey", late, "c_custkey")[1]


@register(
    "fk_clean", _SPARSE_SQL + f"SELECT * FROM o WHERE o_custkey IS NULL OR o_custkey IN {_KNOWN}"
)
def fk_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, late = _sparse_orders(spark, sf_dir), _late_customers(spark, sf_dir)
    return split_orphans(orders, "o_custkey", late, "c_custkey")[0]


@register(
    "multi_fk_first_failure",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
         CASE WHEN l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 50 <> 0)
                THEN 'l_orderkey'
              WHEN l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 50 <> 0)
                THEN 'l_partkey'
              WHEN l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 50 <> 0)
                THEN 'l_suppkey' END AS unresolved_fk
       FROM lineitem""",
)
def multi_fk_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    edges = [
        (fk, table(spark, sf_dir, parent).where(f"{key} % 50 <> 0"), key)
        for fk, parent, key in (
            ("l_orderkey", "orders", "o_orderkey"),
            ("l_partkey", "part", "p_partkey"),
            ("l_suppkey", "supplier", "s_suppkey"),
        )
    ]
    return first_missing(lines, edges)


#: (child, column, parent, key, condition under which the parent has arrived)
STAR_EDGES = (
    ("nation", "n_regionkey", "region", "r_regionkey", "true"),
    ("customer", "c_nationkey", "nation", "n_nationkey", "n_nationkey <> 3"),
    ("supplier", "s_nationkey", "nation", "n_nationkey", "true"),
    ("orders", "o_custkey", "customer", "c_custkey", "c_custkey % 50 <> 0"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey", "o_orderkey % 50 <> 0"),
    ("lineitem", "l_partkey", "part", "p_partkey", "true"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey", "s_suppkey <> 7"),
    ("events", "user_id", "customer", "c_custkey", "c_custkey % 50 <> 0"),
)


def _edge_sql(child: str, fk: str, parent: str, key: str, arrived: str) -> str:
    return f"""SELECT '{child}' AS child, '{fk}' AS fk_column, '{parent}' AS parent,
        count(*) AS child_rows, count({fk}) AS keyed_rows,
        count(*) FILTER (WHERE {fk} IS NOT NULL AND {fk} NOT IN
            (SELECT {key} FROM {parent} WHERE {arrived})) AS orphan_rows FROM {child}"""


@register("fk_integrity_report", " UNION ALL ".join(_edge_sql(*e) for e in STAR_EDGES))
def fk_integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = None
    for child, fk, parent, key, arrived in STAR_EDGES:
        row = count_edge(
            table(spark, sf_dir, child), child, fk,
            table(spark, sf_dir, parent).where(arrived), parent, key,
        )
        report = row if report is None else report.unionByName(row)
    return report
