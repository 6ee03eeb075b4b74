"""Orphans that wait for their parents in event time.

An orphan and the parents that arrive later are two streams.  They meet in
a left outer join whose time bound lets Spark forget both sides: an orphan
when its waiting time is over, a parent when no orphan in time can ask for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.plans.retry import ORPHAN_HOURS, PROMOTED, RESOLVED, WAITING

#: how long before an orphan was noticed its parent may have come unseen, and
#: how much later than others a row may reach the stream
EARLY, LATENESS = "1 hour", "1 hour"

#: an orphan's missing key: ``edge`` names the foreign key, ``n_keys`` counts the row's missing keys
ORPHAN = "quarantine_id string, edge string, key string, n_keys int, quarantined_at timestamp"
PARENT = "edge string, key string, arrived_at timestamp"


def key_verdicts(
    orphans: DataFrame,
    parents: DataFrame,
    wait: str = f"{ORPHAN_HOURS} hours",
    early: str = EARLY,
    lateness: str = LATENESS,
) -> DataFrame:
    """Each missing key with ``arrived_at`` of its parent, null if it did not come in time.

    ``orphans`` and ``parents`` have the columns of ORPHAN and PARENT; on
    streams a found key comes out when both sides are there, a lost one when
    the watermark has passed the end of its waiting time, and later rows than
    ``lateness`` allows are dropped.  On tables all keys come out.  A null
    key or time meets nothing.  Parents that arrive twice give two rows.
    """
    child = orphans.withWatermark("quarantined_at", lateness).alias("o")
    parent = parents.withWatermark("arrived_at", lateness).select(
        F.col("edge").alias("_edge"), F.col("key").alias("_key"), "arrived_at"
    )
    in_time = F.expr(
        f"arrived_at >= quarantined_at - INTERVAL {early} "
        f"AND arrived_at <= quarantined_at + INTERVAL {wait}"
    )
    same = (F.col("edge") == F.col("_edge")) & (F.col("key") == F.col("_key"))
    return child.join(parent, same & in_time, "left_outer").drop("_edge", "_key")


def row_verdicts(keys: DataFrame) -> DataFrame:
    """One row per orphan with keys decided so far: outcome, the first lost key, the last arrival.

    Promoted if a key is lost, resolved if all of the row's missing keys were
    found, else waiting.  Keys that came out twice count once.
    """
    once = keys.groupBy("quarantine_id", "edge").agg(
        F.max("n_keys").alias("n_keys"), F.min("arrived_at").alias("arrived_at")
    )
    lost = F.col("arrived_at").isNull()
    rows = once.groupBy("quarantine_id").agg(
        F.max("n_keys").alias("n_keys"),
        F.count_if(~lost).alias("found"),
        F.min(F.when(lost, F.col("edge"))).alias("unresolved_fk"),
        F.max("arrived_at").alias("last_arrival"),
    )
    outcome = (
        F.when(F.col("unresolved_fk").isNotNull(), PROMOTED)
        .when(F.col("found") >= F.col("n_keys"), RESOLVED)
        .otherwise(WAITING)
    )
    return rows.select("quarantine_id", outcome.alias("outcome"), "unresolved_fk", "last_arrival")


def stream_verdicts(
    spark: SparkSession,
    orphans: str,
    parents: str,
    verdicts: str,
    checkpoint: str,
    wait: str = f"{ORPHAN_HOURS} hours",
    early: str = EARLY,
    lateness: str = LATENESS,
    trigger: dict | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start the join over two folders of Parquet files that grow, appending verdicts of keys.

    The file sink lists the files of finished batches, so a batch that is run
    again counts once.  Read the folder with ``row_verdicts``.
    """

    def arriving(folder: str, schema: str) -> DataFrame:
        reader = spark.readStream.schema(schema)
        if files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(folder)

    found = key_verdicts(arriving(orphans, ORPHAN), arriving(parents, PARENT), wait, early, lateness)
    return (
        found.writeStream.format("parquet")
        .option("path", verdicts)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
