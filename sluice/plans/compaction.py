"""Fold many small loads of a table into few files, and remove what folds replaced.

Folding writes new files and then one new version of the table's list of folds.  A
job that stops before that has changed nothing, and is run again.  A reader
planned before sees the loads, one planned after sees the fold: each row
once.  The folders that a fold stands for are removed later, by ``sweep``, when
no reader planned before can be at work any more.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from uuid import uuid4

from sluice.sources.folds import (
    FOLDER,
    LOAD,
    commit,
    entries,
    fold_path,
    remove,
    size_of,
)
from sluice.sources.warehouse import BATCH_ID, TABLES, Warehouse, table_schema

#: tables whose loads other jobs replace or prune by folder
KEPT = ("sla_agent_day", "retry_state")
#: bytes of a folder that is left as it is, and of a file of a fold
SMALL, FILE_BYTES = 128 << 20, 256 << 20
#: small folds that are themselves folded, so a row is rewritten a logarithmic number of times
FAN_IN = 8


def _order(table: str) -> list[str]:
    """Columns that a fold is sorted by, so that scans of some days or keys skip row groups."""
    names = table_schema(table).names
    return [n for n in ("date_key", "processed_at", "quarantined_at") if n in names][:1] + names[:1]


def fold(
    warehouse: Warehouse, table: str, small: int = SMALL, file_bytes: int = FILE_BYTES,
    fan_in: int = FAN_IN,
) -> int:
    """Fold the loads of a table whose folders hold under ``small`` bytes; returns how many.

    One small load alone is left as it is.  Small folds of earlier runs are
    taken along when there are ``fan_in`` of them.  Rows are ordered by day or
    time and key over all files.  Must not run beside a load of the same table.
    """
    if table in KEPT:
        raise ValueError(f"loads of {table} are replaced by folder")
    spark, path = warehouse.spark, warehouse.path(table)
    state = warehouse.folds(table)
    sizes, times = {}, {}
    for load, at in warehouse._folders(table).items():
        if load not in state.loads:
            size = size_of(spark, f"{path}/{BATCH_ID}={load}")
            if size < small:
                sizes[load], times[load] = size, at
    gone = {n: size_of(spark, fold_path(path, n)) for n in state.folds}
    gone = {n: size for n, size in gone.items() if size < small}
    if len(gone) < fan_in:
        gone = {}
    if len(sizes) + len(gone) < 2:
        return 0
    rows = warehouse._of_folders(table, list(sizes)).unionByName(
        warehouse._of_folds(table, state, list(gone))
    )
    files = max(1, -(-(sum(sizes.values()) + sum(gone.values())) // file_bytes))
    order = _order(table)
    if files > 1:
        rows = rows.repartitionByRange(files, *order, BATCH_ID)
    else:
        rows = rows.coalesce(1)
    name = f"fold-{uuid4().hex}"
    (
        rows.sortWithinPartitions(*order)
        .withColumnRenamed(BATCH_ID, LOAD)
        .write.option(f"parquet.bloom.filter.enabled#{order[-1]}", "true")
        .parquet(fold_path(path, name))
    )
    loads = dict(times)
    for n in gone:
        loads |= state.folds[n]
    commit(spark, path, state.merged(list(gone), name, loads))
    return len(sizes)


def fold_all(warehouse: Warehouse, **settings) -> dict[str, int]:
    """Fold every table that may be; the number of loads folded by table."""
    return {t: fold(warehouse, t, **settings) for t in TABLES if t not in KEPT}


def sweep(warehouse: Warehouse, table: str, as_of: datetime, age: timedelta) -> list[str]:
    """Remove folders that folds stand for, unused folds and old versions; returns their names.

    Only what was last changed ``age`` before ``as_of`` (UTC) goes, and nothing
    before the current version itself has that age: longer than any reader, and
    any stream that follows the table's folders, may lag.
    """
    spark, path = warehouse.spark, warehouse.path(table)
    state = warehouse.folds(table)
    limit = (as_of - age - datetime(1970, 1, 1)).total_seconds() * 1000
    inside = entries(spark, f"{path}/{FOLDER}")
    now = f"{state.version:012d}.json"
    if now not in inside or inside[now] > limit:
        return []
    old = [
        f"{BATCH_ID}={load}"
        for load, at in warehouse._folders(table).items()
        if load in state.loads and at <= limit
    ]
    old += [
        f"{FOLDER}/{name}" for name, at in inside.items()
        if name != now and name not in state.folds and at <= limit
    ]
    for name in old:
        remove(spark, f"{path}/{name}")
    return sorted(old)
