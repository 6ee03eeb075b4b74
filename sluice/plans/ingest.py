"""Jobs that take files through validation into the warehouse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.pii import mask
from sluice.functions.text import REASON_SCHEMA
from sluice.operators.cascade import (
    ARRIVED,
    CELLS,
    EXCESS,
    FILE,
    ROW,
    RULE,
    STAGE,
    clean_rows,
    rejected_rows,
    tag,
)
from sluice.operators.insert import absent_rows
from sluice.operators.ledger import files_to_process
from sluice.operators.quarantine import (
    as_json,
    quarantine_id,
    quarantine_rows,
    write_backup,
)
from sluice.operators.schema import column_difference, typed
from sluice.plans.dims import LOOKUP_TABLE, build_dimension
from sluice.plans.facts import build_fact
from sluice.session import spread, stage, stage_only, temporary_stages
from sluice.sources.files import (
    batch_plan,
    file_format,
    inventory,
    large_arrays,
    read_large_arrays,
    read_text_table,
    read_untyped,
)
from sluice.sources.warehouse import Warehouse
from sluice.plans.calendar import dim_date, dim_time
from sluice.spec import BATCH, ENTITIES, Entity


@dataclass
class Outcome:
    """What one load did; paths and counts only."""

    entity: str
    loaded: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    failed: dict[str, str] = field(default_factory=dict)
    inserted: int = 0


def moment(as_of: datetime):
    return F.lit(as_of).cast("timestamp_ntz")


def parents_of(entity: Entity, warehouse: Warehouse) -> dict[str, DataFrame]:
    return {
        k.entity: warehouse.read(ENTITIES[k.entity].table) for k in entity.foreign_keys
    }


def build_rows(
    entity: Entity, typed_rows: DataFrame, warehouse: Warehouse, loaded_at, *keep: str
) -> DataFrame:
    """Hashed and enriched rows in the shape of the entity's table."""
    masked = mask(typed_rows, entity)
    if entity.kind == BATCH:
        table = LOOKUP_TABLE.get(entity.name)
        lookup = warehouse.read(table) if table else None
        return build_dimension(entity, masked, lookup, loaded_at, *keep)
    orders = warehouse.read("fact_order") if entity.name == "tickets" else None
    return build_fact(entity, masked, orders, loaded_at, *keep)


def file_counts(tagged: DataFrame) -> DataFrame:
    """Rows per file: read, valid, duplicate and orphan; the rest is quarantined."""
    stage_name = F.col(STAGE)
    return tagged.groupBy(FILE).agg(
        F.count("*").alias("total_records"),
        F.count_if(stage_name.isNull()).alias("valid_records"),
        F.count_if(stage_name.isNotNull()).alias("quarantined"),
        F.count_if(F.col(RULE) == "duplicate").alias("duplicate_count"),
        F.count_if(stage_name == "orphan").alias("orphan_count"),
    )


def audit_rows(
    counts: DataFrame, files: DataFrame, entity: Entity, status: str, at, rejection_stage=None
) -> DataFrame:
    """One audit row per file; a file without rows counts zero."""
    numbers = ["total_records", "valid_records", "quarantined", "duplicate_count", "orphan_count"]
    return (
        files.join(counts, files["file_path"] == counts[FILE], "left")
        .select(
            "file_path",
            "file_name",
            "file_hash",
            F.lit(entity.kind).alias("file_type"),
            F.lit(entity.table).alias("source_table"),
            F.lit(status).alias("status"),
            F.lit(rejection_stage).cast("string").alias("rejection_stage"),
            *[F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias(n) for n in numbers],
            at.alias("processed_at"),
        )
    )


def ledger_rows(
    log: DataFrame, loaded: DataFrame | None, seq: int, error: str | None = None
) -> DataFrame:
    """Ledger events for audited files; ``loaded`` counts the rows inserted per file.

    ``seq`` orders the events of loads with the same time.
    """
    if loaded is None:
        count = F.lit(0)
    else:
        log = log.join(loaded, log["file_path"] == loaded[FILE], "left")
        count = F.coalesce(F.col("records_loaded"), F.lit(0))
    return log.select(
        "file_path",
        "file_hash",
        "status",
        "processed_at",
        F.lit(seq).cast("bigint").alias("seq"),
        count.cast("bigint").alias("records_loaded"),
        F.lit(error).cast("string").alias("error_msg"),
    )


def ingest(
    spark: SparkSession,
    entity_name: str,
    paths: Sequence[str],
    warehouse: Warehouse,
    batch_id: str,
    as_of: datetime,
    null_mode: str = "any",
    backup: str | None = None,
) -> Outcome:
    """Load files of one entity: validate, quarantine, hash, insert if absent, record.

    Files whose path and content were loaded before are skipped.  A file
    whose columns are not the declared ones, in any order, is quarantined
    whole, and one that cannot be read is recorded as failed; the others
    load.  If the load itself fails, its files are recorded as failed before
    the error is raised.  Of rows with one key the first to arrive counts:
    by the file's time, its path and the place in the file.  Running
    the same batch id again gives the same tables.  With ``backup`` a CSV
    copy of the quarantined rows is left below that folder.
    """
    with temporary_stages(spark):
        return _ingest(
            spark, ENTITIES[entity_name], paths, warehouse, batch_id, as_of, null_mode, backup
        )


def _ingest(
    spark: SparkSession,
    entity: Entity,
    paths: Sequence[str],
    warehouse: Warehouse,
    batch_id: str,
    as_of: datetime,
    null_mode: str,
    backup: str | None,
) -> Outcome:
    result = Outcome(entity.name)
    found = stage(inventory(spark, paths), "inventory")
    ledger = warehouse.read("processed_files", but_batch=batch_id)
    order = ("processed_at", "seq")
    pending = stage(files_to_process(found, ledger, order), "pending")
    seq = (ledger.agg(F.max("seq")).first()[0] or 0) + 1

    # file names only, as many as the scan itself lists on the driver
    todo = list(pending.select("path", "file_path", "columns").toLocalIterator())
    todo_paths = {r["path"] for r in todo}
    arrays = [r["path"] for r in todo if r["path"].lower().endswith(".json")]
    large = large_arrays(spark, arrays) if arrays else set()
    result.skipped = sorted(
        r["path"]
        for r in found.select("path").toLocalIterator()
        if r["path"] not in todo_paths
    )
    #: paths by format, for CSV the order of the columns, and whether a JSON array is read in pieces
    good: dict[tuple, list[str]] = {}
    bad, unreadable = {}, set()
    for r in todo:
        path, names = r["path"], r["columns"]
        try:
            fmt = file_format(path)
        except ValueError as error:
            bad[path] = str(error)
            unreadable.add(path)
            continue
        if names is None:
            names = read_untyped(spark, [path], fmt).columns
        missing, extra = column_difference(names, entity)
        if missing or extra:
            bad[path] = f"missing columns {missing}, extra columns {extra}"
        else:
            header = tuple(names) if fmt == "csv" else None
            # the names of large arrays were read in pieces, and so are their rows
            streamed = fmt == "json" and r["columns"] is not None and path in large
            good.setdefault((fmt, header, streamed), []).append(path)
    good_paths = sorted(p for paths in good.values() for p in paths)

    logs, ledger_events, quarantined = [], [], []
    at = moment(as_of)
    if good:
        files = pending.join(_paths_of(spark, good_paths), "path", "left_semi")
        try:
            tagged, new = _insert(spark, entity, good, warehouse, batch_id, at, null_mode)
        except Exception as error:
            failed = audit_rows(_no_counts(spark), files, entity, "failed", at)
            why = f"{type(error).__name__}: {error}"[:1000]
            warehouse.write_load("pipeline_file_log", failed, batch_id)
            warehouse.write_load("processed_files", ledger_rows(failed, None, seq, why), batch_id)
            raise
        quarantined.append(quarantine_rows(rejected_rows(tagged), entity, at))
        log = audit_rows(file_counts(tagged), files, entity, "success", at)
        logs.append(log)
        per_file = new.groupBy(FILE).agg(F.count("*").alias("records_loaded"))
        ledger_events.append(ledger_rows(log, per_file, seq))
        result.inserted = new.count()
        result.loaded = good_paths

    for path, why in sorted(bad.items()):
        counts = _no_counts(spark)
        if path not in unreadable:
            whole = _whole_file(spark, path, entity, at)
            quarantined.append(whole)
            counts = whole.groupBy(F.col("source_file").alias(FILE)).agg(
                F.sum("_copies").alias("total_records"),
                F.lit(0).alias("valid_records"),
                F.sum("_copies").alias("quarantined"),
                F.lit(0).alias("duplicate_count"),
                F.lit(0).alias("orphan_count"),
            )
        log = audit_rows(
            counts, pending.where(F.col("path") == path), entity, "failed", at, "schema"
        )
        logs.append(log)
        ledger_events.append(ledger_rows(log, None, seq, why))
        result.failed[path] = why

    if logs:
        if quarantined:
            warehouse.write_load("quarantine", _union(quarantined), batch_id)
        if quarantined and backup is not None:
            write_backup(
                warehouse.read_load("quarantine", batch_id), backup, entity.kind, batch_id
            )
        warehouse.write_load("pipeline_file_log", _union(logs), batch_id)
        # last: a load that stops before this is done again and replaces itself
        warehouse.write_load("processed_files", _union(ledger_events), batch_id)
    return result


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _paths_of(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string")


def _no_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [],
        f"{FILE} string, total_records long, valid_records long, quarantined long, "
        "duplicate_count long, orphan_count long",
    )


def _insert(
    spark: SparkSession,
    entity: Entity,
    files: dict[tuple, list[str]],
    warehouse: Warehouse,
    batch_id: str,
    at,
    null_mode: str,
) -> tuple[DataFrame, DataFrame]:
    """Validate and insert the rows of files; returns the tagged raw rows and the new ones."""
    parts = [
        read_large_arrays(spark, paths, entity)
        if streamed
        else read_text_table(spark, paths, entity, fmt, header)
        for (fmt, header, streamed), paths in files.items()
    ]

    def all_tagged() -> DataFrame:
        # numbered in file order before they are shared out
        raw = stage(spread(_union(parts)), "raw")
        regular = raw.where(F.col(EXCESS).isNull()).drop(EXCESS)
        too_wide = raw.where(F.col(EXCESS).isNotNull()).withColumns(
            {STAGE: F.lit("schema"), RULE: F.lit(CELLS)}
        )
        judged = tag(regular, entity, parents_of(entity, warehouse), null_mode)
        return judged.unionByName(too_wide, allowMissingColumns=True)

    tagged = stage_only(spark, "tagged", all_tagged)
    place = (ARRIVED, FILE, ROW)
    rows = build_rows(
        entity, typed(clean_rows(tagged), entity, *place), warehouse, at, *place
    )
    existing = warehouse.read(entity.table, but_batch=batch_id)
    new = stage_only(
        spark, "new_rows", lambda: absent_rows(rows, existing, entity.key, F.struct(*place))
    )
    warehouse.write_load(entity.table, new, batch_id)
    return tagged, new


def _whole_file(spark: SparkSession, path: str, entity: Entity, at) -> DataFrame:
    """All rows of a file with undeclared columns, as schema-stage quarantine rows."""
    df = read_untyped(spark, [path], file_format(path))
    if df.columns == ["_corrupt_record"]:
        # no document at all, such as a file that was cut off: its lines
        df = spark.read.text(path).withColumnRenamed("value", "line")
    raw = as_json(*df.columns) if df.columns else F.lit("{}")
    return (
        df.select(F.col("_metadata.file_path").alias("source_file"), raw.alias("raw_data"))
        .groupBy("source_file", "raw_data")
        .agg(F.count("*").alias("_copies"))
        .withColumns(
            {
                "source_table": F.lit(entity.table),
                "rejection_reason": F.lit(REASON_SCHEMA),
                "rejection_stage": F.lit("schema"),
                "rejection_rule": F.lit("columns"),
                "quarantined_at": at,
            }
        )
        .withColumn(
            "quarantine_id",
            quarantine_id("source_file", "source_table", "rejection_stage", "raw_data"),
        )
    )


def ingest_folder(
    spark: SparkSession, folder: str, warehouse: Warehouse, batch_id: str, as_of: datetime
) -> list[Outcome]:
    """Load a day's folder of dimension files, parents first."""
    return [
        ingest(spark, entity.name, paths, warehouse, f"{batch_id}-{entity.name}", as_of)
        for entity, paths in batch_plan(spark, folder)
    ]


def load_calendar(spark: SparkSession, warehouse: Warehouse) -> None:
    """(Re)write the calendar and clock dimensions."""
    warehouse.write_load("dim_date", dim_date(spark), "calendar")
    warehouse.write_load("dim_time", dim_time(spark), "clock")


def seed(
    spark: SparkSession, master_dir: str, warehouse: Warehouse, as_of: datetime
) -> dict[str, int]:
    """Cold start: create the tables and load the master files; counts files by outcome."""
    warehouse.create()
    load_calendar(spark, warehouse)
    outcomes = ingest_folder(spark, master_dir, warehouse, f"seed-{as_of:%Y%m%d%H%M%S}", as_of)
    return {
        "loaded": sum(len(o.loaded) for o in outcomes),
        "skipped": sum(len(o.skipped) for o in outcomes),
        "failed": sum(len(o.failed) for o in outcomes),
    }
