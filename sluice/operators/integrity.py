"""Foreign-key checks.

A key that is null is never an orphan.  A parent small enough to broadcast
is joined directly in one pass.  Otherwise the distinct keys of the child
(combined on the map side, so a hot key is one row) are anti-joined with
the parent and only the missing keys, staged, meet the wide child rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.casts import to_number
from sluice.functions.text import is_schema_null, normal_id
from sluice.session import as_large, fits_broadcast, stage
from sluice.spec import ENTITIES, Entity


def _is_integral(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.IntegralType)


def parent_keys(parent: DataFrame, key: str, as_text: bool) -> DataFrame:
    """Distinct non-null keys of a parent in comparable form."""
    form = normal_id(F.col(key)) if as_text else F.col(key).cast("bigint")
    return parent.select(form.alias("_pk")).where("_pk IS NOT NULL").distinct()


def flag_missing(
    df: DataFrame, key: Column, parent: DataFrame, parent_key: str, flag: str, as_text: bool
) -> DataFrame:
    """Add boolean ``flag``: ``key`` is set and the parent table does not have it."""
    keyed = df.withColumn("_fk", key)
    known = parent_keys(parent, parent_key, as_text)
    if fits_broadcast(known):
        joined = keyed.join(known, F.col("_fk") == F.col("_pk"), "left")
        missing = F.col("_fk").isNotNull() & F.col("_pk").isNull()
    else:
        absent = _absent_keys(df, key, known)
        joined = keyed.join(as_large(absent), F.col("_fk") == F.col("_pk"), "left")
        missing = F.col("_pk").isNotNull()
    return joined.withColumn(flag, missing).drop("_fk", "_pk")


def _absent_keys(df: DataFrame, key: Column, known: DataFrame) -> DataFrame:
    """(_pk) the keys of ``df`` that ``known`` lacks, staged."""
    wanted = df.select(key.alias("_fk")).where("_fk IS NOT NULL").distinct()
    absent = wanted.join(known.hint("merge"), F.col("_fk") == F.col("_pk"), "left_anti")
    return stage(absent.select(F.col("_fk").alias("_pk")), "missing_keys")


def split_orphans(
    df: DataFrame, fk: str, parent: DataFrame, parent_key: str
) -> tuple[DataFrame, DataFrame]:
    """(clean, orphans) of typed rows for one foreign key; null keys are clean."""
    as_text = not (_is_integral(df, fk) and _is_integral(parent, parent_key))
    key = normal_id(F.col(fk)) if as_text else F.col(fk).cast("bigint")
    flagged = flag_missing(df, key, parent, parent_key, "_orphan", as_text)
    return flagged.where("NOT _orphan").drop("_orphan"), flagged.where("_orphan").drop("_orphan")


def first_missing(
    df: DataFrame, edges: Sequence[tuple[str, DataFrame, str]], into: str = "unresolved_fk"
) -> DataFrame:
    """Name the first foreign key, in the order given, that does not resolve.

    ``edges`` holds (column, parent, parent key); all are checked in one pass.
    """
    flags = []
    for i, (fk, parent, parent_key) in enumerate(edges):
        as_text = not (_is_integral(df, fk) and _is_integral(parent, parent_key))
        key = normal_id(F.col(fk)) if as_text else F.col(fk).cast("bigint")
        df = flag_missing(df, key, parent, parent_key, f"_missing_{i}", as_text)
        flags.append(F.when(F.col(f"_missing_{i}"), F.lit(fk)))
    name = F.coalesce(*flags) if flags else F.lit(None).cast("string")
    return df.withColumn(into, name).drop(*[f"_missing_{i}" for i in range(len(edges))])


def raw_key(entity: Entity, name: str) -> tuple[Column, Column, bool]:
    """(comparable key, key is set, compare as text) of a raw text column.

    A fraction in an integer column can match no parent, so its key is null
    although the key is set.
    """
    is_set = F.expr(f"NOT {is_schema_null(name)}")
    if entity.column(name).dtype in ("int", "float"):
        number = F.expr(to_number(name))
        # comparing with the cast keeps fractions out and out-of-range numbers null
        whole = number.try_cast("bigint")
        return F.when(whole == number, whole), is_set, False
    return normal_id(F.when(is_set, F.col(name))), is_set, True


def _raw_edges(
    df: DataFrame, entity: Entity, parents: Mapping[str, DataFrame]
) -> tuple[DataFrame, list[tuple[str, str, Column, Column]]]:
    """Adds a flag for each enforced foreign key; (column, parent, comparable key, does not resolve)."""
    edges = []
    for i, edge in enumerate(entity.foreign_keys):
        key, is_set, as_text = raw_key(entity, edge.column)
        parent_key = ENTITIES[edge.entity].key
        df = flag_missing(df, key, parents[edge.entity], parent_key, f"_missing_{i}", as_text)
        broken = F.col(f"_missing_{i}") | (is_set & key.isNull())
        edges.append((edge.column, edge.entity, key, broken))
    return df, edges


def _without_flags(df: DataFrame, entity: Entity) -> DataFrame:
    return df.drop(*[f"_missing_{i}" for i in range(len(entity.foreign_keys))])


def flag_raw_orphans(
    df: DataFrame, entity: Entity, parents: Mapping[str, DataFrame], into: str
) -> DataFrame:
    """First enforced foreign key of raw rows that does not resolve, or null.

    ``parents`` maps entity names to tables that have the entity's key column.
    """
    df, edges = _raw_edges(df, entity, parents)
    flags = [F.when(broken, F.lit(column)) for column, _, _, broken in edges]
    name = F.coalesce(*flags) if flags else F.lit(None).cast("string")
    return _without_flags(df.withColumn(into, name), entity)


def small_parents(entity: Entity, parents: Mapping[str, DataFrame]) -> set[str]:
    """Foreign keys whose parents fit a broadcast: these are checked in the pass that reads the rows."""
    found = set()
    for edge in entity.foreign_keys:
        as_text = entity.column(edge.column).dtype not in ("int", "float")
        if fits_broadcast(parent_keys(parents[edge.entity], ENTITIES[edge.entity].key, as_text)):
            found.add(edge.column)
    return found


def flag_edges(
    df: DataFrame, entity: Entity, parents: Mapping[str, DataFrame], columns: set[str]
) -> DataFrame:
    """Adds ``broken_flag`` of these foreign keys: the raw key is set and does not resolve."""
    for edge in entity.foreign_keys:
        if edge.column in columns:
            key, is_set, as_text = raw_key(entity, edge.column)
            flag, parent_key = broken_flag(edge.column), ENTITIES[edge.entity].key
            df = flag_missing(df, key, parents[edge.entity], parent_key, flag, as_text)
            df = df.withColumn(flag, F.col(flag) | (is_set & key.isNull()))
    return df


def broken_flag(column: str) -> str:
    return f"_broken_{column}"


def absent_parents(
    df: DataFrame, entity: Entity, parents: Mapping[str, DataFrame], columns: set[str]
) -> list[tuple[str, DataFrame, Column, Column]]:
    """For these foreign keys of staged raw rows: (column, staged keys without a parent, key, key that no parent can have)."""
    found = []
    for edge in entity.foreign_keys:
        if edge.column in columns:
            key, is_set, as_text = raw_key(entity, edge.column)
            known = parent_keys(parents[edge.entity], ENTITIES[edge.entity].key, as_text)
            absent = _absent_keys(df, key, known).withColumnRenamed("_pk", f"_absent_{edge.column}")
            found.append((edge.column, absent, key, is_set & key.isNull()))
    return found


#: a foreign key that does not resolve; a key that no parent can have is null
MISSING = "array<struct<edge:string,parent:string,key:string>>"


def with_missing_keys(
    df: DataFrame, entity: Entity, parents: Mapping[str, DataFrame], into: str
) -> DataFrame:
    """All enforced foreign keys of raw rows that do not resolve, in the declared order (MISSING)."""
    df, edges = _raw_edges(df, entity, parents)
    every = [
        F.when(broken, F.struct(F.lit(column).alias("edge"), F.lit(parent).alias("parent"),
                                key.cast("string").alias("key")))
        for column, parent, key, broken in edges
    ]
    found = F.array_compact(F.array(*every)) if every else F.array()
    return _without_flags(df.withColumn(into, found.cast(MISSING)), entity)


def arrived_keys(entity: Entity, rows: DataFrame) -> DataFrame:
    """(parent, key) of rows of a parent's table, in the form that ``with_missing_keys`` gives."""
    key = entity.key
    known = parent_keys(rows, key, as_text=entity.column(key).dtype not in ("int", "float"))
    return known.select(F.lit(entity.name).alias("parent"), F.col("_pk").cast("string").alias("key"))


def count_edge(
    child: DataFrame, child_name: str, fk: str, parent: DataFrame, parent_name: str, parent_key: str
) -> DataFrame:
    """One row: how many rows of a child set a key and how many do not resolve.

    Counted from rows per key, so a hot key is one row before the join.
    """
    as_text = not (_is_integral(child, fk) and _is_integral(parent, parent_key))
    key = normal_id(F.col(fk)) if as_text else F.col(fk).cast("bigint")
    per_key = child.select(key.alias("_fk")).groupBy("_fk").agg(F.count("*").alias("_n"))
    known = parent_keys(parent, parent_key, as_text)
    total = F.coalesce(F.sum("_n"), F.lit(0))
    set_rows = F.coalesce(F.sum(F.when(F.col("_fk").isNotNull(), F.col("_n"))), F.lit(0))
    orphan_rows = F.coalesce(
        F.sum(F.when(F.col("_fk").isNotNull() & F.col("_pk").isNull(), F.col("_n"))), F.lit(0)
    )
    return per_key.join(known, F.col("_fk") == F.col("_pk"), "left").agg(
        F.lit(child_name).alias("child"),
        F.lit(fk).alias("fk_column"),
        F.lit(parent_name).alias("parent"),
        total.alias("child_rows"),
        set_rows.alias("keyed_rows"),
        orphan_rows.alias("orphan_rows"),
    )
