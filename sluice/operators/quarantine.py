"""Quarantine rows: one table of JSON documents for rejects of any entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import REASON_ORPHAN, REASON_RULES, REASON_SCHEMA, file_stem
from sluice.operators.cascade import EXCESS, FILE, RULE, STAGE, rule_labels
from sluice.spec import Entity

ALERT_ROWS = 50


def as_json(*columns: str) -> Column:
    """Row as JSON text, nulls kept."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def reason_text(stage: Column, kind: str) -> Column:
    return (
        F.when(stage == "schema", REASON_SCHEMA)
        .when(stage == "orphan", REASON_ORPHAN)
        .otherwise(REASON_RULES[kind])
    )


def quarantine_id(*parts: str) -> Column:
    """The same reject always gets the same id, so a replay adds nothing."""
    return F.sha2(F.concat_ws("|", *[F.col(p) for p in parts]), 256)


def quarantine_rows(
    rejects: DataFrame, entity: Entity, quarantined_at: Column, texts: bool = True
) -> DataFrame:
    """Tagged raw rejects as quarantine rows; equal copies of one file become one row.

    Copies have the same id, as their cells are the same.  They are grouped by
    the cells, and the document and the id are made once a group: both are
    longer than the cells and are not shuffled.  Of the rules of copies the
    least is found by its place, a number: so rows are hashed and not sorted,
    and a filter by file comes before it all.
    Records with too many cells carry their original text as well.  Without
    ``texts`` there is no ``raw_data``, for reports that do not look at it.
    """
    names = [*entity.names, *([EXCESS] if EXCESS in rejects.columns else [])]
    raw = as_json(*entity.names)
    if EXCESS in names:
        raw = F.when(F.col(EXCESS).isNull(), raw).otherwise(as_json(*names))
    rules = F.array(*map(F.lit, rule_labels(entity)))
    return (
        rejects.select(
            F.col(FILE).alias("source_file"),
            F.col(STAGE).alias("rejection_stage"),
            F.array_position(rules, F.col(RULE)).alias("_rule"),
            *names,
        )
        .groupBy("source_file", "rejection_stage", *names)
        .agg(F.min("_rule").alias("_rule"))
        .withColumns({"source_table": F.lit(entity.table), "raw_data": raw})
        .select(
            quarantine_id("source_file", "source_table", "rejection_stage", "raw_data").alias("quarantine_id"),
            "source_file",
            "source_table",
            reason_text(F.col("rejection_stage"), entity.kind).alias("rejection_reason"),
            "rejection_stage",
            F.element_at(rules, F.col("_rule").cast("int")).alias("rejection_rule"),
            *(("raw_data",) if texts else ()),
            quarantined_at.alias("quarantined_at"),
        )
    )


def from_raw(quarantine: DataFrame, entity: Entity) -> DataFrame:
    """Quarantine rows with their JSON opened into the entity's raw text columns."""
    return quarantine.withColumn("_raw", F.from_json("raw_data", entity.raw_schema())).select(
        *quarantine.columns, *[F.col(f"_raw.{n}").alias(n) for n in entity.names]
    )


def write_backup(rows: DataFrame, path: str, kind: str, batch_id: str) -> None:
    """Spreadsheet copy of a load's quarantine rows, by kind and day; a replay replaces it."""
    (
        rows.withColumn("date", F.to_date("quarantined_at"))
        .write.partitionBy("date")
        .mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .csv(f"{path}/kind={kind}/load={batch_id}")
    )


def breakdown(quarantine: DataFrame) -> DataFrame:
    """Rows per table and stage."""
    return (
        quarantine.groupBy("source_table", "rejection_stage")
        .agg(F.count("*").alias("row_count"))
        .orderBy("source_table", "rejection_stage")
    )


def volume_alerts(quarantine: DataFrame, limit: int = ALERT_ROWS) -> DataFrame:
    """Files with more than ``limit`` rows quarantined for one reason."""
    return (
        quarantine.groupBy("source_file", "source_table", "rejection_reason")
        .agg(F.count("*").alias("quarantined_rows"))
        .where(F.col("quarantined_rows") > limit)
    )


def rule_alerts(tagged: DataFrame) -> DataFrame:
    """Schema rules broken in a file, with the number of rows they reject."""
    return (
        tagged.where(F.col(STAGE) == "schema")
        .groupBy(file_stem(F.col(FILE)).alias("entity"), RULE)
        .agg(F.count("*").alias("rejected_rows"))
    )
