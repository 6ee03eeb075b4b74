"""Star-schema tables as parquet folders, one sub-folder per load.

A load replaces its own sub-folder, so replaying it changes nothing.  Small
loads can be folded together (``plans/compaction.py``); reads and loads then
follow the table's current version of its folds.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import write_parquet
from sluice.sources.folds import LOAD, Folds, commit, current, entries, fold_path

BATCH_ID = "_batch_id"

#: amounts and minutes share one decimal type, wide enough for any value that
#: passes validation
AMOUNT = "decimal(18,2)"

TABLES: dict[str, str] = {
    "dim_date": """date_key int, full_date date, year smallint, quarter smallint,
        month smallint, month_name string, week smallint, day_of_week smallint,
        day_of_month smallint, day_of_year smallint, day_name string""",
    "dim_time": """time_key int, full_time string, hour smallint, minute smallint,
        am_pm string, shift string""",
    "dim_city": "city_id int, city_name string, country string, timezone string",
    "dim_region": f"""region_id int, region_name string, city_name string,
        delivery_base_fee {AMOUNT}""",
    "dim_segment": """segment_id int, segment_name string, discount_pct int,
        priority_support boolean""",
    "dim_category": "category_id int, category_name string",
    "dim_team": "team_id int, team_name string",
    "dim_reason_category": "reason_category_id int, category_name string",
    "dim_reason": """reason_id int, reason_name string, reason_category_id int,
        reason_category string, severity_level int, typical_refund_pct decimal(18,4)""",
    "dim_channel": "channel_id int, channel_name string",
    "dim_priority": """priority_id int, priority_code string, priority_name string,
        sla_first_response_min int, sla_resolution_min int""",
    "dim_customer": """customer_id int, full_name string, email string, phone string,
        region_id int, segment_id int, signup_date date, gender string,
        created_at timestamp_ntz, updated_at timestamp_ntz, _loaded_at timestamp_ntz""",
    "dim_restaurant": """restaurant_id int, restaurant_name string, region_id int,
        category_id int, price_tier string, rating_avg decimal(18,2), prep_time_avg_min int,
        is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz,
        _loaded_at timestamp_ntz""",
    "dim_driver": """driver_id int, driver_name string, driver_phone string,
        national_id string, region_id int, shift string, vehicle_type string, hire_date date,
        rating_avg decimal(18,2), on_time_rate decimal(18,4), cancel_rate decimal(18,4),
        completed_deliveries int, is_active boolean, created_at timestamp_ntz,
        updated_at timestamp_ntz, _loaded_at timestamp_ntz""",
    "dim_agent": """agent_id int, agent_name string, agent_email string, agent_phone string,
        team_id int, skill_level string, hire_date date, avg_handle_time_min int,
        resolution_rate decimal(18,4), csat_score decimal(18,2), is_active boolean,
        created_at timestamp_ntz, updated_at timestamp_ntz, _loaded_at timestamp_ntz""",
    "fact_order": f"""order_sk bigint, order_id string, customer_id int, restaurant_id int,
        driver_id int, region_id int, date_key int, time_key int, order_status string,
        payment_method string, created_at timestamp_ntz, delivered_at timestamp_ntz,
        order_amount {AMOUNT}, delivery_fee {AMOUNT}, discount_amount {AMOUNT},
        total_amount {AMOUNT}, _loaded_at timestamp_ntz""",
    "fact_ticket": f"""ticket_sk bigint, ticket_id string, order_id string, customer_id int,
        region_id int, restaurant_id int, driver_id int, agent_id int, reason_id int,
        priority_id int, channel_id int, date_key int, time_key int, status string,
        refund_amount {AMOUNT}, created_at timestamp_ntz, first_response_at timestamp_ntz,
        resolved_at timestamp_ntz, sla_first_due_at timestamp_ntz,
        sla_resolve_due_at timestamp_ntz, first_response_min {AMOUNT}, resolution_min {AMOUNT},
        sla_response_breached boolean, sla_resolution_breached boolean, reopened boolean,
        _loaded_at timestamp_ntz""",
    "fact_ticket_event": """event_sk bigint, event_id string, ticket_id string, agent_id int,
        date_key int, time_key int, event_ts timestamp_ntz, old_status string,
        new_status string, notes string, _loaded_at timestamp_ntz""",
    "quarantine": """quarantine_id string, source_file string, source_table string,
        rejection_reason string, rejection_stage string, rejection_rule string,
        raw_data string, quarantined_at timestamp_ntz""",
    # per load of tickets, day and agent; added up by reports
    "sla_agent_day": """agent_id int, day date, total_tickets bigint, first_response_met bigint,
        resolution_met bigint""",
    # what retries did with quarantine rows: retry, resolved or promoted
    "quarantine_action": "quarantine_id string, action string, acted_at timestamp_ntz",
    # one row a day of the daily run, replaced when the day is run again
    "daily_run": """day date, status string, files_loaded bigint, files_skipped bigint,
        files_failed bigint, error_msg string, finished_at timestamp_ntz""",
    # what the last runs of the incremental retry knew, one load a run
    "retry_state": "kind string, name string, value string",
    "true_orphan": """quarantine_id string, source_file string, source_table string,
        unresolved_fk string, raw_data string, first_seen_at timestamp_ntz,
        retry_count int, last_retry_at timestamp_ntz""",
    "pipeline_file_log": """file_path string, file_name string, file_hash string,
        file_type string, source_table string, status string, rejection_stage string,
        total_records bigint, valid_records bigint, quarantined bigint,
        duplicate_count bigint, orphan_count bigint, processed_at timestamp_ntz""",
    "processed_files": """file_path string, file_hash string, status string,
        processed_at timestamp_ntz, seq bigint, records_loaded bigint, error_msg string""",
}


_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(18,4)": T.DecimalType(18, 4),
}


def table_schema(name: str) -> T.StructType:
    """Declared columns of a table; needs no session."""
    columns = re.findall(r"(\w+) ([a-z_]+(?:\(\d+,\d+\))?)", TABLES[name])
    return T.StructType([T.StructField(c, _TYPES[t]) for c, t in columns])


class Warehouse:
    """Tables below one root folder on storage that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self) -> "Warehouse":
        """Create the missing tables, empty: folders that the declared schema can be read from."""
        files = self.spark._jvm.org.apache.hadoop.fs
        conf = self.spark._jsc.hadoopConfiguration()
        for name in TABLES:
            path = files.Path(self.path(name))
            path.getFileSystem(conf).mkdirs(path)
        return self

    def read(self, table: str, but_batch: str | None = None) -> DataFrame:
        """The table; with ``but_batch`` without the rows an earlier try of that load wrote."""
        state = self.folds(table)
        if state.folds:
            live = [b for b in self._folders(table) if b not in state.loads]
            df = self._of_folders(table, live).unionByName(self._of_folds(table, state))
        else:
            df = self.spark.read.schema(self._stored(table)).parquet(self.path(table))
        if but_batch is not None:
            df = df.where(F.col(BATCH_ID) != but_batch)
        return df.drop(BATCH_ID)

    def folds(self, table: str) -> Folds:
        return current(self.spark, self.path(table))

    def _stored(self, table: str) -> T.StructType:
        return table_schema(table).add(BATCH_ID, "string")

    def _folders(self, table: str) -> dict[str, int]:
        """Loads that have a folder of their own, folded or not, and when it was last changed."""
        mark = f"{BATCH_ID}="
        return {
            name.removeprefix(mark): at
            for name, at in entries(self.spark, self.path(table)).items()
            if name.startswith(mark) and not name.endswith("__HIVE_DEFAULT_PARTITION__")
        }

    def _of_folders(self, table: str, batch_ids: Sequence[str]) -> DataFrame:
        if not batch_ids:
            return self.spark.createDataFrame([], self._stored(table))
        folders = [f"{self.path(table)}/{BATCH_ID}={b}" for b in sorted(batch_ids)]
        reader = self.spark.read.schema(self._stored(table)).option("basePath", self.path(table))
        return reader.parquet(*folders)

    def _of_folds(self, table: str, state: Folds, names: Sequence[str] | None = None) -> DataFrame:
        """The rows of folds that count, with the load each is of."""
        names = sorted(state.folds if names is None else names)
        if not names:
            return self.spark.createDataFrame([], self._stored(table))
        schema = table_schema(table).add(LOAD, "string")

        def one_scan(folds: Sequence[str]) -> DataFrame:
            return self.spark.read.schema(schema).parquet(
                *[fold_path(self.path(table), n) for n in folds]
            )

        whole = [n for n in names if n not in state.replaced]
        rows = one_scan(whole) if whole else self.spark.createDataFrame([], schema)
        for name in names:
            if name in state.replaced:
                rows = rows.union(one_scan([name]).where(~F.col(LOAD).isin(*state.replaced[name])))
        return rows.withColumnRenamed(LOAD, BATCH_ID)

    def write_load(self, table: str, rows: DataFrame, batch_id: str) -> None:
        """Write one load's rows, replacing what an earlier try of it wrote."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch_id):
            raise ValueError(f"batch id {batch_id!r} is not usable as a folder name")
        schema = table_schema(table)
        # a cast, not a guess: every column has the declared type on disk
        declared = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
        write_parquet(declared, f"{self.path(table)}/{BATCH_ID}={batch_id}", "overwrite")
        state = self.folds(table)
        if batch_id in state.loads:
            # from here on its rows in the fold do not count
            commit(self.spark, self.path(table), state.without(batch_id))

    def read_load(self, table: str, batch_id: str) -> DataFrame:
        if batch_id in self.folds(table).loads:
            return self.read_loads(table, [batch_id]).drop(BATCH_ID)
        return self.spark.read.schema(table_schema(table)).parquet(
            f"{self.path(table)}/{BATCH_ID}={batch_id}"
        )

    def read_loads(self, table: str, batch_ids: Sequence[str]) -> DataFrame:
        """The rows of some loads with the load they are of; no other folder is listed or read."""
        state = self.folds(table)
        folded = [b for b in batch_ids if b in state.loads]
        rows = self._of_folders(table, [b for b in batch_ids if b not in state.loads])
        if folded:
            names = [n for n, loads in state.folds.items() if not loads.keys().isdisjoint(folded)]
            of_folds = self._of_folds(table, state, names).where(F.col(BATCH_ID).isin(*folded))
            rows = rows.unionByName(of_folds)
        return rows

    def load_times(self, table: str) -> dict[str, int]:
        """The names of a table's loads and when they were last written; no row is read."""
        return self._folders(table) | self.folds(table).loads

    def loads(self, table: str) -> list[str]:
        return sorted(self.load_times(table))
