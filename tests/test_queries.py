"""Registered queries against their SQL on the smallest supplied tables.

By default a selection that touches every operator family runs; set
SLUICE_ALL_QUERIES=1 to run all of them.
"""

import os
from decimal import Decimal
from pathlib import Path

import pytest

from __spark_entry__ import oracle_sql, queries
from sluice.catalog import all_queries

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="supplied tables are not here")

SELECTED = (
    "typed_orders", "schema_rejects_customers", "record_rules_restaurants",
    "record_rules_tickets", "dedup_keep_first", "duplicate_rate", "multi_fk_first_failure",
    "fk_clean", "sla_compliance_by_agent", "sla_breached_tickets", "dim_driver_build",
    "fact_ticket_event_build", "pii_masked_customers", "reason_category_lookup",
    "orders_by_calendar_day", "events_by_clock_minute", "insert_if_absent", "retry_outcome",
    "recent_quarantine", "ledger_current", "files_to_process", "status_transitions",
    "csv_round_trip", "file_md5_scan", "sla_performance_view", "failed_files_top20",
    "dim_region_build", "json_round_trip", "quarantine_backup",
)
#: queries of this package; those of the pipeline operators have tests of their own
OWN = all_queries()
NAMES = sorted(OWN) if os.environ.get("SLUICE_ALL_QUERIES") else SELECTED


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, (float, Decimal)):
        return f"{float(value):.9g}"
    return str(value)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, sql, name):
    df = queries()[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    text = oracle_sql().get(name)
    if text is None:
        assert got
        return
    result = sql.execute(text)
    found = [d[0] for d in result.description]
    assert sorted(found) == columns
    at = [found.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())


def test_every_query_has_sql():
    assert set(OWN) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())
    assert set(OWN) <= set(queries())
