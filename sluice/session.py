"""Session settings, the shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


#: Settings that suit the plans of this package on any cluster.  The rules of
#: an entity make wide projections: past 8000 bytes of bytecode the JVM does not
#: compile a method, and Spark's own limit should then fall back to split code.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder for staged tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session
    may fall back on a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="sluice-")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/sluice/{name}-{uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, keeps a row
    numbering assigned at scan time, and gives the optimizer the real size
    of the result: later joins broadcast it only if it is measurably small
    and otherwise stay shuffled joins that adaptive execution can split.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    mine = _staged.get()
    if mine is not None:
        mine.append(path)
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


#: seconds from which on a write may have shuffled enough to be worth a collection
LONG_WRITE = 2.0


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    began = time.monotonic()
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    if time.monotonic() - began > LONG_WRITE:
        free_shuffles(df.sparkSession)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that have ended.

    It does so when the driver's collector finds that nothing refers to them
    any more, and a driver that plans only may not collect for half an hour:
    until then the files of all steps of a query lie on the executors' disks.
    """
    spark._jvm.System.gc()


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the tables staged inside the block.

    For jobs that write all their results before they return.  A query that
    returns a lazy frame must keep its staged tables.
    """
    token = _staged.set([])
    try:
        yield
    finally:
        files = spark._jvm.org.apache.hadoop.fs
        for path in _staged.get() or ():
            folder = files.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        _staged.reset(token)


def stage_only(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``build()`` staged, where tables that were staged on the way are removed once it is written.

    For results that everything later is made of; nothing lazy may be left of the others.
    """
    outer = _staged.get()
    with temporary_stages(spark):
        done = stage(build(), name)
        path = _staged.get().pop()
    if outer is not None:
        outer.append(path)
    return done


def side_by_side[A, B](fn: Callable[[A], B], items: Iterable[A], at_once: int = 4) -> list[B]:
    """The results of ``fn`` in order, where several calls may run Spark jobs at a time.

    For plans that do not depend on each other but stage tables while they
    are built: the cluster then has the tasks of several small jobs to fill it.
    """
    with ThreadPoolExecutor(at_once) as pool:
        calls = [pool.submit(copy_context().run, fn, item) for item in items]
        return [c.result() for c in calls]


def spread(scan: DataFrame) -> DataFrame:
    """Share out a scan that has fewer splits than there are cores.

    One large file that cannot be split would otherwise keep a single task
    busy with all the work up to the next shuffle.  Scans of many splits are
    left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


#: bytes that a cell of a broadcast row takes at least, with its share of the hash table
_CELL = 64


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer's size estimate and the number of rows let it broadcast ``df``.

    The estimate goes by the size of files.  Parquet keeps long runs of keys in
    a byte or two a row, where a broadcast takes some hundred, so rows are
    counted where the estimate alone would allow one; the count ends at the
    first row too many.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if not 0 <= int(str(size)) <= limit:
        return False
    rows = limit // (_CELL * len(df.columns))
    return df.limit(rows + 1).count() <= rows


#: bytes of a task that a hash table of one partition may take
_TABLE = 128 << 20


def as_large(df: DataFrame, meets_wide: bool = True) -> DataFrame:
    """``df``, with few rows a key, for a join: shuffled, whatever its estimate, unless it fits a broadcast.

    The rows that meet it are wide and more, so they are not sorted as long as
    ``df`` has so few rows a partition that a hash table of them fits a task.
    Where they are keys only or perhaps none, both sides are sorted: adaptive
    execution then joins many small partitions to one, by their bytes, and a
    hash table of all its rows would not fit.
    """
    if fits_broadcast(df):
        return df
    if not meets_wide:
        return df.hint("merge")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fits_task = df.count() * _CELL * len(df.columns) <= _TABLE * partitions
    return df.hint("shuffle_hash" if fits_task else "merge")
