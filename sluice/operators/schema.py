"""Schema stage: column sets, types, required and categorical columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.casts import (
    FALSE_TOKENS,
    TRUE_TOKENS,
    coerce,
    from_text,
    number_limit,
    number_or_nan,
    parse,
)
from sluice.functions.text import SCHEMA_NULLS, is_schema_null, one_of
from sluice.spec import Column, Entity


def column_difference(names: Iterable[str], entity: Entity) -> tuple[list[str], list[str]]:
    """(missing, extra) columns against the declared set; order does not matter."""
    found, declared = set(names), set(entity.names)
    return sorted(declared - found), sorted(found - declared)


def columns_match(names: Iterable[str], entity: Entity) -> bool:
    return column_difference(names, entity) == ([], [])


#: (label, SQL predicate that holds on rows breaking the rule)
Rules = list[tuple[str, str]]


def value(name: str) -> str:
    """The parsed value of a raw column, added by :func:`with_values`."""
    return f"_v_{name}"


def _value_of(column: Column) -> str:
    is_number = column.dtype in ("int", "float")
    return number_or_nan(column.name) if is_number else parse(column.name, column.dtype)


#: columns parsed in one step, whose code is then small enough to be compiled
_AT_ONCE = 4


def with_values(df: DataFrame, entity: Entity) -> DataFrame:
    """Parse every non-text column once, for all the rules to look at.

    The values come out of an array of one row: a filter on them stays above
    it, where the optimizer would move one on plain columns below the joins of
    ``df`` and parse the texts there as well.
    """
    parsed = [
        F.expr(_value_of(c)).alias(value(c.name)) for c in entity.columns if c.dtype != "str"
    ]
    for i in range(0, len(parsed), _AT_ONCE):
        df = df.select("*", F.inline(F.array(F.struct(*parsed[i : i + _AT_ONCE]))))
    return df


def without_values(df: DataFrame, entity: Entity) -> DataFrame:
    return df.drop(*[value(n) for n in entity.names])


def dtype_rules(entity: Entity) -> Rules:
    """Texts that neither parse nor stand for null; a null text satisfies no predicate here."""
    rules = []
    for c in entity.columns:
        if c.dtype in ("int", "float"):
            broken = f"abs({value(c.name)}) > {number_limit(c.dtype, c.wide)}"
        elif c.dtype == "datetime":
            broken = f"{value(c.name)} IS NULL AND {c.name} NOT IN {one_of(SCHEMA_NULLS)}"
        elif c.dtype == "bool":
            broken = f"{c.name} NOT IN {one_of(TRUE_TOKENS + FALSE_TOKENS + SCHEMA_NULLS)}"
        else:
            continue
        rules.append((f"dtype:{c.name}", broken))
    return rules


def required_rules(entity: Entity) -> Rules:
    """Used after the type rules, when a number is null only if its text stands for null."""
    return [
        (
            f"required:{c.name}",
            f"{value(c.name)} IS NULL" if c.dtype in ("int", "float") else is_schema_null(c.name),
        )
        for c in entity.required
    ]


def categorical_rules(entity: Entity) -> Rules:
    return [
        (
            f"categorical:{c.name}",
            f"{c.name} NOT IN {one_of(c.allowed + SCHEMA_NULLS)}",
        )
        for c in entity.categorical
    ]


def schema_rules(entity: Entity) -> Rules:
    """Rules in the order of use; they expect the columns of :func:`with_values`."""
    return dtype_rules(entity) + required_rules(entity) + categorical_rules(entity)


def first_broken(rules: Rules) -> str:
    """SQL text giving the label of the first broken rule, null if none is."""
    if not rules:
        return "CAST(NULL AS STRING)"
    return "CASE " + " ".join(f"WHEN {broken} THEN '{label}'" for label, broken in rules) + " END"


def typed(df: DataFrame, entity: Entity, *keep: str) -> DataFrame:
    """Cast raw text columns to the declared types, carrying the ``keep`` columns along."""
    return df.selectExpr(
        *[f"{from_text(c.name, c.dtype)} AS {c.name}" for c in entity.columns], *keep
    )


def typed_passed(df: DataFrame, entity: Entity, *keep: str) -> DataFrame:
    """The typed rows that break no schema rule; each text is parsed once."""
    passed = with_values(df, entity).where(f"{first_broken(schema_rules(entity))} IS NULL")
    return passed.selectExpr(*[f"{_from_value(c)} AS {c.name}" for c in entity.columns], *keep)


def _from_value(column: Column) -> str:
    if column.dtype == "str":
        return column.name
    v = value(column.name)
    return f"try_cast(round({v}) AS BIGINT)" if column.dtype == "int" else v


def restored(df: DataFrame, entity: Entity, *keep: str) -> DataFrame:
    """Cast raw texts that come back out of quarantine to the declared types.

    Unlike in :func:`typed` blanks around a number or time do not count, and
    the words that stand for null in a retry are null.  Texts stay as they are.
    """
    cells = [c.name if c.dtype == "str" else coerce(c.name, c.dtype) for c in entity.columns]
    return df.selectExpr(*[f"{v} AS {n}" for v, n in zip(cells, entity.names)], *keep)
