"""Queries on quarantine, retries, the ledger, file audits and alerts."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.catalog.fixtures import FIXTURES, table
from sluice.catalog.registry import register
from sluice.catalog.rules_sql import cast_sql, is_null, normal_id, number, tagged_ctes
from sluice.catalog.star import _FACT_CELLS, conformed_sql, loaded_at
from sluice.catalog.validation import tagged_fixture
from sluice.functions.text import REASON_ORPHAN, REASON_RULES, REASON_SCHEMA, stage_of_reason
from sluice.operators.cascade import FILE, rejected_rows
from sluice.operators.ledger import current_state, files_to_process
from sluice.operators.quarantine import (
    ALERT_ROWS,
    breakdown,
    quarantine_rows,
    rule_alerts,
    volume_alerts,
)
from sluice.operators.schema import restored as retyped
from sluice.plans.analytics import (
    daily_file_summary,
    duplicate_metrics,
    failed_files,
    orphans_to_promote,
    quarantine_listing,
    recent_quarantine,
)
from sluice.plans.facts import build_fact
from sluice.plans.ingest import file_counts
from sluice.plans.retry import (
    MAX_RETRIES,
    RESOLVED,
    bad_row_outcomes,
    open_quarantine,
    orphan_outcomes,
    outcome_stats,
    promoted_by_fk,
    true_orphans,
)
from sluice.session import side_by_side, stage_only
from sluice.spec import ENTITIES, STREAM

# ------------------------------------------------------------- quarantine

#: rejects count as quarantined on the first day of the month of their file
_AT = "CAST(coalesce(nullif(regexp_extract({f}, '([0-9]{{4}}-[0-9]{{2}})/', 1), ''), '2024-01') || '-01 00:00:00' AS {t})"


def _quarantined_at(file: str = "source_file"):
    month = F.nullif(F.regexp_extract(file, r"([0-9]{4}-[0-9]{2})/", 1), F.lit(""))
    text = F.concat(F.coalesce(month, F.lit("2024-01")), F.lit("-01 00:00:00"))
    return text.cast("timestamp_ntz")


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def tagged_all(
    spark: SparkSession, sf_dir: str, names: Iterable[str], keep: list[str] | None = None
) -> list[DataFrame]:
    """The tagged rows of several entities; their cascades do not depend on each other."""
    return side_by_side(lambda name: tagged_fixture(spark, sf_dir, name, keep), names)


def quarantine_of(spark: SparkSession, sf_dir: str, *names: str, texts: bool = True) -> DataFrame:
    return union_all(
        quarantine_rows(rejected_rows(tagged), FIXTURES[name].spec, _quarantined_at(), texts)
        for name, tagged in zip(names, tagged_all(spark, sf_dir, names))
    )


def quarantine_cte(name: str, prefix: str = "") -> str:
    """CTEs ending in ``{prefix}q``: quarantine rows, raw columns kept as well."""
    e = FIXTURES[name].spec
    document = ", ".join(f"'{n}', {n}" for n in e.names)
    raw = ", ".join(e.names)
    return f"""{tagged_ctes(name, prefix)},
{prefix}j AS (SELECT _file AS source_file, '{e.table}' AS source_table,
    CASE reject_stage WHEN 'schema' THEN '{REASON_SCHEMA}' WHEN 'orphan' THEN '{REASON_ORPHAN}'
        ELSE '{REASON_RULES[e.kind]}' END AS rejection_reason,
    reject_stage AS rejection_stage, min(reject_rule) AS rejection_rule,
    CAST(json_object({document}) AS VARCHAR) AS raw_data, {raw}
    FROM {prefix}tagged WHERE reject_stage IS NOT NULL GROUP BY _file, reject_stage, {raw}),
{prefix}q AS (SELECT sha256(concat_ws('|', source_file, source_table, rejection_stage, raw_data))
    AS quarantine_id, *, {_AT.format(f='source_file', t='TIMESTAMP')} AS quarantined_at
    FROM {prefix}j)"""


Q_COLUMNS = (
    "quarantine_id, source_file, source_table, rejection_reason, rejection_stage, "
    "rejection_rule, raw_data, quarantined_at"
)
#: all entities, and the facts, whose orphans are tried again
ALL = tuple(FIXTURES)
FACTS = tuple(n for n in ALL if ENTITIES[n].kind == STREAM)
_ALL_CTES = ", ".join(quarantine_cte(n, f"{n}_") for n in ALL)
_ALL_ROWS = " UNION ALL ".join(f"SELECT {Q_COLUMNS} FROM {n}_q" for n in ALL)
_ALL_Q = f"WITH {_ALL_CTES}, q AS ({_ALL_ROWS}) "


@register("quarantine_json", _ALL_Q + "SELECT * FROM q")
def quarantine_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_of(spark, sf_dir, *ALL)


@register(
    "quarantine_breakdown",
    _ALL_Q + "SELECT source_table, rejection_stage, count(*) AS row_count FROM q GROUP BY 1, 2",
)
def quarantine_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return breakdown(quarantine_of(spark, sf_dir, *ALL, texts=False))


@register(
    "quarantine_stage_of_reason",
    _ALL_Q + "SELECT rejection_reason, rejection_stage AS stage, count(*) AS row_count "
    "FROM q GROUP BY 1, 2",
)
def quarantine_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quarantine_of(spark, sf_dir, *ALL, texts=False)
    return rows.groupBy(
        "rejection_reason", stage_of_reason(F.col("rejection_reason")).alias("stage")
    ).agg(F.count("*").alias("row_count"))


@register(
    "quarantine_alerts",
    _ALL_Q + f"""SELECT source_file, source_table, rejection_reason, count(*) AS quarantined_rows
        FROM q GROUP BY 1, 2, 3 HAVING count(*) > {ALERT_ROWS}""",
)
def quarantine_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return volume_alerts(quarantine_of(spark, sf_dir, *ALL, texts=False))


_ALL_TAGGED = "WITH " + ", ".join(tagged_ctes(n, f"{n}_") for n in ALL)
_ALL_RULES = " UNION ALL ".join(
    f"SELECT '{n}' AS entity, reject_stage, reject_rule FROM {n}_tagged" for n in ALL
)


@register(
    "rule_alerts",
    f"""{_ALL_TAGGED}, r AS ({_ALL_RULES})
        SELECT entity, reject_rule, count(*) AS rejected_rows FROM r
        WHERE reject_stage = 'schema' GROUP BY 1, 2""",
)
def alerts_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(map(rule_alerts, tagged_all(spark, sf_dir, ALL, [FILE])))


@register(
    "quarantine_listing",
    _ALL_Q + "SELECT * FROM q WHERE source_table = 'fact_order'",
)
def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine_listing(quarantine_of(spark, sf_dir, "customers", "orders"), "fact_order")


RECENT = datetime(1998, 1, 1)
RECENT_HOURS = 24 * 180


@register(
    "recent_quarantine",
    f"{_ALL_Q} SELECT * FROM q WHERE quarantined_at > "
    f"TIMESTAMP '{RECENT}' - INTERVAL '{RECENT_HOURS}' HOUR",
)
def recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_quarantine(quarantine_of(spark, sf_dir, *ALL), RECENT, RECENT_HOURS)


# ------------------------------------------------------------------ retry

RETRY_AT = datetime(1999, 1, 1)

#: parents by now, half of the late ones came: entity, table, key
ARRIVED = {
    "customers": ("customer", "c_custkey", "c_custkey % 100 <> 0"),
    "drivers": ("supplier", "s_suppkey", "true"),
    "restaurants": ("part", "p_partkey", "true"),
    "orders": ("orders", "o_orderkey", "o_orderkey % 100 <> 0"),
    "agents": ("supplier", "s_suppkey", "true"),
    "tickets": ("customer", "c_custkey", "c_custkey % 100 <> 0"),
}


def missing_sql(name: str, **there: str) -> str:
    """The first foreign key of a raw fact that has no parent; ``there`` says which parents came."""
    cases = []
    for edge in ENTITIES[name].foreign_keys:
        source, key, where = ARRIVED[edge.entity]
        where = there.get(edge.entity, where)
        if ENTITIES[name].column(edge.column).dtype == "str":
            child, parent = normal_id(edge.column), f"CAST({key} AS VARCHAR)"
        else:
            child, parent = number(edge.column), f"CAST({key} AS DOUBLE)"
        cases.append(
            f"WHEN NOT {is_null(edge.column)} AND {child} NOT IN "
            f"(SELECT {parent} FROM {source} WHERE {where}) THEN '{edge.column}'"
        )
    return f"CASE {' '.join(cases)} END"


_FACT_CTES = ", ".join(quarantine_cte(n, f"{n}_") for n in FACTS)
_FACT_ROWS = " UNION ALL ".join(f"SELECT {Q_COLUMNS}, {missing_sql(n)} AS missing FROM {n}_q" for n in FACTS)
_RETRY = f"""WITH {_FACT_CTES}, q AS ({_FACT_ROWS}),
actions AS (SELECT quarantine_id, 'retry' AS action, TIMESTAMP '{RETRY_AT}' AS acted_at
      FROM q CROSS JOIN range({MAX_RETRIES}) WHERE source_file LIKE '%-03/%'
    UNION ALL SELECT quarantine_id, 'resolved', TIMESTAMP '{RETRY_AT}' FROM q
      WHERE source_file LIKE '%-07/%'),
history AS (SELECT quarantine_id, count(*) FILTER (WHERE action = 'retry') AS n,
    max(acted_at) FILTER (WHERE action = 'retry') AS last_retry_at,
    bool_or(action <> 'retry') AS closed FROM actions GROUP BY 1),
op AS (SELECT q.*, CAST(coalesce(n, 0) AS INTEGER) AS retry_count, last_retry_at
    FROM q LEFT JOIN history USING (quarantine_id) WHERE NOT coalesce(closed, false)),
decided AS (SELECT *,
    CASE WHEN rejection_stage = 'orphan' THEN missing ELSE rejection_stage END AS unresolved_fk,
    CASE WHEN rejection_stage <> 'orphan' THEN CASE WHEN quarantined_at <
            TIMESTAMP '{RETRY_AT}' - INTERVAL '24' HOUR THEN 'promoted' ELSE 'skipped' END
        WHEN missing IS NULL THEN 'resolved'
        WHEN quarantined_at < TIMESTAMP '{RETRY_AT}' - INTERVAL '24' HOUR
            OR retry_count >= {MAX_RETRIES} THEN 'promoted' ELSE 'waiting' END AS outcome
    FROM op) """


def _open_facts(spark: SparkSession, sf_dir: str, *names: str, texts: bool = False) -> DataFrame:
    """Quarantined facts; those of March were tried often, those of July are done.

    Only orphans are opened again, so without ``texts`` others have no ``raw_data``.
    """

    def quarantine() -> DataFrame:
        rows = quarantine_of(spark, sf_dir, *names)
        is_orphan = F.col("rejection_stage") == "orphan"
        return rows if texts else rows.withColumn("raw_data", F.when(is_orphan, F.col("raw_data")))

    rows = stage_only(spark, "quarantine", quarantine)
    at = F.lit(RETRY_AT).cast("timestamp_ntz").alias("acted_at")
    tried = (
        rows.where("source_file LIKE '%-03/%'")
        .select("quarantine_id", F.explode(F.sequence(F.lit(1), F.lit(MAX_RETRIES))))
        .select("quarantine_id", F.lit("retry").alias("action"), at)
    )
    done = rows.where("source_file LIKE '%-07/%'").select(
        "quarantine_id", F.lit("resolved").alias("action"), at
    )
    return open_quarantine(rows, tried.unionByName(done))


def _arrived(spark: SparkSession, sf_dir: str, name: str) -> dict[str, DataFrame]:
    found = {}
    for edge in ENTITIES[name].foreign_keys:
        parent, (source, key, where) = ENTITIES[edge.entity], ARRIVED[edge.entity]
        as_type = "STRING" if parent.column(parent.key).dtype == "str" else "BIGINT"
        rows = table(spark, sf_dir, source).where(where)
        found[parent.name] = rows.selectExpr(f"CAST({key} AS {as_type}) AS {parent.key}")
    return found


def _orphans(spark: SparkSession, sf_dir: str, name: str, is_open: DataFrame) -> DataFrame:
    mine = is_open.where(F.col("source_table") == ENTITIES[name].table)
    return orphan_outcomes(mine, ENTITIES[name], _arrived(spark, sf_dir, name), RETRY_AT)


def outcomes(spark: SparkSession, sf_dir: str, texts: bool = False) -> DataFrame:
    """The outcome of every open row of the three facts; without ``texts`` only orphans have ``raw_data``."""
    is_open = _open_facts(spark, sf_dir, *FACTS, texts=texts)
    columns = [*is_open.columns, "unresolved_fk", "outcome"]
    decided = side_by_side(lambda n: _orphans(spark, sf_dir, n, is_open).select(*columns), FACTS)
    return union_all([*decided, bad_row_outcomes(is_open, RETRY_AT).select(*columns)])


@register(
    "retry_outcome",
    _RETRY + "SELECT quarantine_id, rejection_stage, retry_count, unresolved_fk, outcome "
    "FROM decided",
)
def retry_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(spark, sf_dir).select(
        "quarantine_id", "rejection_stage", "retry_count", "unresolved_fk", "outcome"
    )


@register(
    "retry_stats",
    _RETRY + """SELECT count(*) FILTER (WHERE outcome = 'resolved') AS retried,
        count(*) FILTER (WHERE outcome = 'promoted') AS promoted,
        count(*) FILTER (WHERE outcome IN ('resolved', 'promoted')) AS deleted,
        count(*) FILTER (WHERE rejection_stage <> 'orphan' OR outcome = 'skipped') AS skipped
        FROM decided""",
)
def retry_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_stats(outcomes(spark, sf_dir))


@register(
    "retry_promoted_by_fk",
    _RETRY + """SELECT source_table, unresolved_fk, count(*) AS promoted_rows FROM decided
        WHERE outcome = 'promoted' GROUP BY 1, 2""",
)
def retry_promoted_by_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return promoted_by_fk(outcomes(spark, sf_dir))


@register(
    "true_orphans",
    _RETRY + """SELECT quarantine_id, source_file, source_table, unresolved_fk, raw_data,
        quarantined_at AS first_seen_at, retry_count, last_retry_at FROM decided
        WHERE outcome = 'promoted'""",
)
def promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return true_orphans(outcomes(spark, sf_dir, texts=True))


#: tickets take the region of their order, here a number of it
_REGIONS = """(SELECT ok.*, o_orderkey % 25 AS _region FROM ok
    LEFT JOIN orders ON ok.order_id = CAST(o_orderkey AS VARCHAR))"""


def _register_restored(name: str, title: str) -> None:
    entity = ENTITIES[name]
    cells = ", ".join(f"{cast_sql(entity, n)} AS {n}" for n in entity.names)
    sql = (
        _RETRY
        + f", ok AS (SELECT {cells} FROM {name}_q WHERE quarantine_id IN (SELECT quarantine_id "
        + "FROM decided WHERE outcome = 'resolved' AND rejection_stage = 'orphan')) "
        + conformed_sql(name, _REGIONS if name == "tickets" else "ok", _FACT_CELLS[name])
    )

    @register(title, sql)
    def restored(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Fact rows built back from the JSON of orphans whose parents arrived."""
        decided = _orphans(spark, sf_dir, name, _open_facts(spark, sf_dir, name))
        resolved = retyped(decided.where(F.col("outcome") == RESOLVED), entity)
        orders = table(spark, sf_dir, "orders").selectExpr(
            "CAST(o_orderkey AS STRING) AS order_id", "CAST(o_orderkey % 25 AS INT) AS region_id"
        )
        fact = build_fact(entity, resolved, orders if name == "tickets" else None, loaded_at())
        return fact.drop("_loaded_at", *[c for c in fact.columns if c.endswith("_sk")])


_register_restored("orders", "retry_restored_orders")
_register_restored("tickets", "retry_restored_tickets")
_register_restored("ticket_events", "retry_restored_events")


@register(
    "orphans_to_promote",
    f"""WITH {quarantine_cte('orders')} SELECT quarantine_id, source_file, source_table,
        'customer_id' AS unresolved_fk, raw_data, quarantined_at AS first_seen_at FROM q
        WHERE rejection_stage = 'orphan' AND source_table = 'fact_order'
        AND quarantined_at < TIMESTAMP '{RETRY_AT}' - INTERVAL '24' HOUR""",
)
def to_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quarantine_of(spark, sf_dir, "orders")
    return orphans_to_promote(rows, "fact_order", "customer_id", RETRY_AT)


# ----------------------------------------------------------------- ledger

_LEDGER = """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS file_path, md5(event_type) AS file_hash,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'failed'
         WHEN event_id % 5 = 0 THEN 'failed' ELSE 'success' END AS status,
    ts AS processed_at, event_id FROM events),
cur AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY file_path, file_hash
    ORDER BY processed_at DESC, event_id DESC) = 1) """


def _ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(user_id AS STRING) AS file_path",
        "md5(event_type) AS file_hash",
        "CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'failed' "
        "WHEN event_id % 5 = 0 THEN 'failed' ELSE 'success' END AS status",
        "ts AS processed_at",
        "event_id",
    )


@register("ledger_current", _LEDGER + "SELECT * FROM cur")
def ledger_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_state(_ledger_events(spark, sf_dir), ("processed_at", "event_id"))


_FOUND = "CASE WHEN c_custkey % 2 = 0 THEN 'click' ELSE 'error' END"


@register(
    "files_to_process",
    _LEDGER + f""", f AS (SELECT CAST(c_custkey AS VARCHAR) AS file_path,
        md5({_FOUND}) AS file_hash FROM customer)
        SELECT f.* FROM f LEFT JOIN (SELECT * FROM cur WHERE status = 'success') d
        ON f.file_path = d.file_path AND f.file_hash = d.file_hash WHERE d.file_path IS NULL""",
)
def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS file_path", f"md5({_FOUND}) AS file_hash"
    )
    # processed_at and event_id order the events of one file
    events = _ledger_events(spark, sf_dir)
    return files_to_process(found, events, ("processed_at", "event_id"))


# ------------------------------------------------------------------ audit

_COUNTS = """count(*) AS total_records,
    count(*) FILTER (WHERE reject_stage IS NULL) AS valid_records,
    count(*) FILTER (WHERE reject_stage IS NOT NULL) AS quarantined,
    count(*) FILTER (WHERE reject_rule = 'duplicate') AS duplicate_count,
    count(*) FILTER (WHERE reject_stage = 'orphan') AS orphan_count"""


_ALL_COUNTS = " UNION ALL ".join(f"SELECT _file, {_COUNTS} FROM {n}_tagged GROUP BY _file" for n in ALL)


@register("file_audit", f"{_ALL_TAGGED} {_ALL_COUNTS}")
def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(map(file_counts, tagged_all(spark, sf_dir, ALL, [FILE])))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An audit log of all files, some of them taken as failed."""
    log = None
    for name, tagged in zip(ALL, tagged_all(spark, sf_dir, ALL, [FILE])):
        e = ENTITIES[name]
        part = file_counts(tagged).select(
            F.col(FILE).alias("file_path"),
            F.element_at(F.split(F.col(FILE), "/"), -1).alias("file_name"),
            F.lit(e.kind).alias("file_type"),
            F.lit(e.table).alias("source_table"),
            F.when(F.col("quarantined") % 2 == 0, "failed").otherwise("success").alias("status"),
            F.when(F.col("quarantined") % 2 == 0, "schema").alias("rejection_stage"),
            "total_records", "valid_records", "quarantined", "duplicate_count", "orphan_count",
            _file_month().alias("processed_at"),
        )
        log = part if log is None else log.unionByName(part)
    return log


def _file_month():
    return F.concat(F.substring(F.element_at(F.split(F.col(FILE), "/"), -2), 1, 7),
                    F.lit("-01 06:30:00")).cast("timestamp_ntz")


def _log_sql() -> str:
    parts = [
        f"""SELECT _file AS file_path, split_part(_file, '/', -1) AS file_name, '{ENTITIES[n].kind}' AS file_type,
          '{ENTITIES[n].table}' AS source_table, {_COUNTS},
          CAST(substr(split_part(_file, '/', -2), 1, 7) || '-01 06:30:00' AS TIMESTAMP)
            AS processed_at FROM {n}_tagged GROUP BY _file"""
        for n in ALL
    ]
    return f"""{_ALL_TAGGED}, l AS ({' UNION ALL '.join(parts)}),
        log AS (SELECT *, CASE WHEN quarantined % 2 = 0 THEN 'failed' ELSE 'success' END AS status,
            CASE WHEN quarantined % 2 = 0 THEN 'schema' END AS rejection_stage FROM l) """


@register(
    "file_daily_summary",
    _log_sql() + """SELECT CAST(processed_at AS DATE) AS date, file_type,
        count(*) AS files_processed, CAST(sum(total_records) AS BIGINT) AS total_records,
        CAST(sum(valid_records) AS BIGINT) AS valid_records,
        CAST(sum(quarantined) AS BIGINT) AS quarantined_total,
        CAST(sum(orphan_count) AS BIGINT) AS orphans_total,
        count(*) FILTER (WHERE status = 'failed') AS failed_files FROM log GROUP BY 1, 2""",
)
def file_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_file_summary(_log(spark, sf_dir))


@register(
    "failed_files_top20",
    _log_sql() + """SELECT file_name, source_table, rejection_stage, quarantined, processed_at
        FROM log WHERE status = 'failed'
        ORDER BY processed_at DESC, file_name, file_path LIMIT 20""",
)
def failed_files_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_files(_log(spark, sf_dir))


@register(
    "duplicate_metrics",
    _log_sql() + """SELECT file_name, CAST(sum(duplicate_count) AS BIGINT) AS total_dupes,
        round(100.0 * CAST(sum(duplicate_count) AS DOUBLE) / nullif(sum(total_records), 0), 2)
          AS dup_rate_pct
        FROM log WHERE processed_at > TIMESTAMP '1999-01-01' - INTERVAL '8760' HOUR
        GROUP BY file_name""",
)
def duplicates_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_metrics(_log(spark, sf_dir), datetime(1999, 1, 1), 365 * 24)
