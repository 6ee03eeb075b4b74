"""The full rule cascade: every row tagged with its first broken rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.casts import to_number
from sluice.operators.dedup import key_name, repeated_keys
from sluice.operators.integrity import absent_parents, broken_flag, flag_edges, small_parents
from sluice.operators.records import (
    format_rules,
    null_rules,
    placeholder_rules,
    range_rules,
)
from sluice.operators.schema import (
    first_broken,
    schema_rules,
    with_values,
    without_values,
)
from sluice.operators.sieve import Few, left_join_few
from sluice.session import stage
from sluice.spec import Entity

#: bookkeeping columns of raw rows: the file and the row's place in the scan
FILE, ROW = "_file", "_row"
#: of rows read from files: when the file came, and the text of a record with too many cells
ARRIVED, EXCESS = "_arrived", "_excess"
STAGE, RULE = "reject_stage", "reject_rule"
#: the rule that records with too many cells break
CELLS = "cells"


def tag_schema(df: DataFrame, entity: Entity) -> DataFrame:
    """Schema stage only: ``reject_rule`` is the first broken schema rule."""
    return without_values(_schema_tagged(df, entity, RULE), entity)


def _schema_tagged(df: DataFrame, entity: Entity, into: str) -> DataFrame:
    return with_values(df, entity).selectExpr(
        "*", f"{first_broken(schema_rules(entity))} AS {into}"
    )


def dedup_keys(entity: Entity) -> dict[str, Column]:
    """Rows of a file repeat when their keys are equal after typing: ``7`` and ``7.0``.

    The key comes first: sorts look at the first bytes of the first column, and
    files of one kind begin alike, so that each comparison would read both rows.
    """
    is_number = entity.column(entity.key).dtype == "int"
    key = F.expr(to_number(entity.key)) if is_number else F.col(entity.key)
    return {"key": key, "file": F.col(FILE)}


def _judged(df: DataFrame, entity: Entity, null_mode: str) -> DataFrame:
    """First broken rules of rows with their values: ``_schema``, ``_before`` the duplicate check
    and ``_late``, after it.

    Each looks at the one before, so they stay steps of their own, small enough to be compiled.
    """
    early = null_rules(entity, null_mode) + placeholder_rules(entity)
    late = format_rules(entity) + range_rules(entity)
    return (
        df.selectExpr("*", f"{first_broken(schema_rules(entity))} AS _schema")
        .selectExpr("*", f"coalesce(_schema, {first_broken(early)}) AS _before")
        .selectExpr("*", f"CASE WHEN _before IS NULL THEN {first_broken(late)} END AS _late")
    )


def rule_labels(entity: Entity) -> list[str]:
    """All that ``reject_rule`` may say of an entity's rows, in the order of the texts."""
    rules = (
        schema_rules(entity) + null_rules(entity) + placeholder_rules(entity)
        + format_rules(entity) + range_rules(entity)
    )
    orphans = [f"fk:{edge.column}" for edge in entity.foreign_keys]
    return sorted({label for label, _ in rules} | {"duplicate", CELLS, *orphans})


def tag(
    df: DataFrame,
    entity: Entity,
    parents: Mapping[str, DataFrame] | None = None,
    null_mode: str = "any",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Tag every row with ``reject_stage`` and ``reject_rule``; clean rows have nulls.

    ``df`` holds the entity's raw text columns plus ``_file`` and ``_row``.
    Texts are parsed and rules are evaluated once a row; what they found is
    staged with the rows, also foreign keys to parents that fit a broadcast.
    Larger parents meet the keys of the staged rows.  Duplicates are looked for among rows that pass the
    schema, null and placeholder rules and before the format and range rules:
    a first row that fails its format still makes the next copy a duplicate.
    With ``keep`` the rows have these columns only, and no others are staged.
    """
    parents = parents or {}
    small = small_parents(entity, parents)
    large = {edge.column for edge in entity.foreign_keys} - small
    joined = flag_edges(df, entity, parents, small)
    names = list(keep or df.columns)
    found = ["_schema", "_before", "_late", *map(broken_flag, small)]
    staged = dict.fromkeys([*names, entity.key, FILE, ROW, *sorted(large), *found])
    judged = stage(_judged(with_values(joined, entity), entity, null_mode).select(*staged), "judged")

    # what follows meets few rows: keys without a parent, and keys that are repeated in a file
    keys, order = dedup_keys(entity), F.col(ROW)
    firsts = repeated_keys(judged, keys, order, among=F.col("_before").isNull())
    few: list[Few] = [(stage(firsts, "repeated"), [key_name(n) for n in keys], list(keys.values()))]
    broken = {c: F.col(broken_flag(c)) for c in small}
    for column, absent, key, impossible in absent_parents(judged, entity, parents, large):
        few.append((absent, absent.columns, [key]))
        broken[column] = F.col(absent.columns[0]).isNotNull() | impossible
    orphans = [F.when(broken[e.column], F.lit(e.column)) for e in entity.foreign_keys]
    orphan = F.coalesce(*orphans) if orphans else F.lit(None).cast("string")
    late = f"CASE WHEN {ROW} > _first THEN 'duplicate' END"
    return (
        left_join_few(judged, few)
        .withColumn("_orphan_fk", orphan)
        .selectExpr(*names, "_schema", "_orphan_fk", f"coalesce(_before, {late}, _late) AS _rule")
        .selectExpr(
            *names,
            f"coalesce(_rule, 'fk:' || _orphan_fk) AS {RULE}",
            "CASE WHEN _schema IS NOT NULL THEN 'schema' WHEN _rule IS NOT NULL THEN 'records' "
            f"WHEN _orphan_fk IS NOT NULL THEN 'orphan' END AS {STAGE}",
        )
    )


def clean_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(STAGE).isNull()).drop(STAGE, RULE)


def rejected_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(STAGE).isNotNull())


def null_profile(df: DataFrame, entity: Entity, null_mode: str = "any") -> DataFrame:
    """Per column under the null rule: how many rows past the schema stage lack it."""
    passed = _schema_tagged(df, entity, RULE).where(F.col(RULE).isNull())
    counts = passed.agg(
        *[
            F.expr(f"count_if({broken})").alias(label.split(":", 1)[1])
            for label, broken in null_rules(entity, null_mode)
        ]
    )
    return counts.unpivot([], counts.columns, "column_name", "null_rows")
