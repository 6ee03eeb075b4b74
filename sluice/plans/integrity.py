"""Integrity of the loaded star: every edge, also those that loading does not enforce."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluice.operators.integrity import count_edge
from sluice.sources.warehouse import Warehouse, table_schema
from sluice.spec import ENTITIES, STREAM


def star_edges() -> list[tuple[str, str, str, str]]:
    """(child table, column, parent table, parent key) of the whole star."""
    edges = []
    for e in ENTITIES.values():
        for k in e.edges:
            parent = ENTITIES[k.entity]
            edges.append((e.table, k.column, parent.table, parent.key))
        if e.kind == STREAM:
            edges += [(e.table, k, f"dim_{k[:4]}", k) for k in ("date_key", "time_key")]
    return edges


def star_report(warehouse: Warehouse) -> DataFrame:
    """One row per edge: rows of the child, rows with a key, rows whose key does not resolve."""
    report = None
    for child, column, parent, key in star_edges():
        assert column in table_schema(child).names
        row = count_edge(
            warehouse.read(child), child, column, warehouse.read(parent), parent, key
        )
        report = row if report is None else report.unionByName(row)
    return report
