"""The validation cascade written as ANSI SQL, for comparison with the Spark plans."""

from __future__ import annotations

from sluice.catalog.fixtures import EVERY, PARENTS
from sluice.functions.casts import FALSE_TOKENS, NUMBER, TIMESTAMP, TRUE_TOKENS
from sluice.functions.text import PLACEHOLDERS, SCHEMA_NULLS
from sluice.operators.records import (
    DATE_COLUMNS,
    NATIONAL_ID_LENGTH,
    NON_NEGATIVE,
    UPPER_BOUNDS,
    null_columns,
)
from sluice.spec import BATCH, Entity


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def number(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, '{NUMBER}') THEN TRY_CAST(trim({c}) AS DOUBLE) END)"


def fitting(c: str, dtype: str, wide: bool = False) -> str:
    limit = 99999999999999 if dtype == "float" else 9007199254740991 if wide else 2147483647
    return f"(CASE WHEN abs({number(c)}) <= {limit} THEN {number(c)} END)"


def stamp(c: str) -> str:
    return f"(CASE WHEN regexp_matches({c}, '{TIMESTAMP}') THEN TRY_CAST({c} AS TIMESTAMP) END)"


def is_null(c: str) -> str:
    return f"({c} IS NULL OR {c} IN ({quoted(SCHEMA_NULLS)}))"


def boolean(c: str) -> str:
    return (
        f"(CASE WHEN {c} IN ({quoted(TRUE_TOKENS)}) THEN true "
        f"WHEN {c} IN ({quoted(FALSE_TOKENS)}) THEN false END)"
    )


def normal_id(c: str) -> str:
    return f"regexp_replace(trim({c}), '^[+]?(-?)0*([0-9]+)[.]0$', '\\1\\2')"


def cast_sql(entity: Entity, name: str) -> str:
    column = entity.column(name)
    value = {
        "str": lambda: name,
        "int": lambda: f"CAST(round({fitting(name, 'int', column.wide)}) AS BIGINT)",
        "float": lambda: fitting(name, "float"),
        "bool": lambda: boolean(name),
        "datetime": lambda: stamp(name),
    }[column.dtype]()
    return value if column.dtype == "str" else f"CASE WHEN NOT {is_null(name)} THEN {value} END"


def schema_cases(entity: Entity) -> list[tuple[str, str]]:
    cases = []
    for c in entity.columns:
        if c.dtype != "str":
            parsed = {
                "int": lambda: fitting(c.name, "int", c.wide),
                "float": lambda: fitting(c.name, "float"),
                "bool": lambda: boolean(c.name),
                "datetime": lambda: stamp(c.name),
            }[c.dtype]()
            cases.append((f"NOT {is_null(c.name)} AND {parsed} IS NULL", f"dtype:{c.name}"))
    cases += [(is_null(c.name), f"required:{c.name}") for c in entity.required]
    cases += [
        (
            f"NOT {is_null(c.name)} AND {c.name} NOT IN ({quoted(c.allowed)})",
            f"categorical:{c.name}",
        )
        for c in entity.categorical
    ]
    return cases


def first_cases(entity: Entity) -> list[tuple[str, str]]:
    cases = [(is_null(n), f"null:{n}") for n in null_columns(entity)]
    cases += [
        (
            f"({c.name} IS NULL OR lower(trim({c.name})) IN ({quoted(PLACEHOLDERS)}))",
            f"placeholder:{c.name}",
        )
        for c in entity.required
        if c.dtype == "str"
    ]
    return cases


def last_cases(entity: Entity) -> list[tuple[str, str]]:
    names = entity.names
    cases = [
        (f"{stamp(n)} IS NULL", f"date_format:{n}") for n in DATE_COLUMNS[entity.kind] if n in names
    ]
    if entity.kind == BATCH:
        cases += [
            (
                f"NOT coalesce(regexp_matches({n}, '^[A-Za-z0-9_.-]+@[A-Za-z0-9_.-]+[.]com$'), false)",
                f"email_format:{n}",
            )
            for n in names
            if "email" in n
        ]
        cases += [
            (
                f"NOT coalesce(regexp_full_match({n}, '0?1[0125][0-9]{{8}}'), false)",
                f"phone_format:{n}",
            )
            for n in names
            if "phone" in n
        ]
        if "national_id" in names:
            digits = f"CAST(CAST({number('national_id')} AS BIGINT) AS VARCHAR)"
            cases.append(
                (f"coalesce(length({digits}) <> {NATIONAL_ID_LENGTH}, true)", "national_id_length")
            )
    cases += [
        (f"({number(n)} IS NULL OR {number(n)} < 0)", f"negative:{n}")
        for n in NON_NEGATIVE[entity.kind]
        if n in names
    ]
    if entity.kind == BATCH:
        cases += [
            (f"{number(n)} > {limit}", f"too_large:{n}")
            for n, limit in UPPER_BOUNDS.items()
            if n in names
        ]
    return cases


def when(cases: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN {broken} THEN '{label}'" for broken, label in cases)
    return f"CASE {whens} END" if cases else "CAST(NULL AS VARCHAR)"


def orphan_case(name: str, entity: Entity) -> str:
    whens = []
    for edge in entity.foreign_keys:
        source, key, arrived = PARENTS[name][edge.entity]
        if entity.column(edge.column).dtype == "str":
            value = normal_id(edge.column)
            known = f"SELECT CAST({key} AS VARCHAR) FROM {source} WHERE {arrived}"
        else:
            value = number(edge.column)
            known = f"SELECT CAST({key} AS DOUBLE) FROM {source} WHERE {arrived}"
        whens.append(
            (f"NOT {is_null(edge.column)} AND {value} NOT IN ({known})", f"fk:{edge.column}")
        )
    return when(whens)


def tagged_ctes(name: str, prefix: str = "") -> str:
    """CTEs ending in ``{prefix}tagged``: raw columns, _file, _row, reject_stage, reject_rule."""
    fixture = EVERY[name]
    entity = fixture.spec
    key = number(entity.key) if entity.column(entity.key).dtype == "int" else entity.key
    p = prefix
    return f"""
{p}src AS ({fixture.sql()}),
{p}s AS (SELECT *, {when(schema_cases(entity))} AS _schema FROM {p}src),
{p}b AS (SELECT *, coalesce(_schema, {when(first_cases(entity))}) AS _before FROM {p}s),
{p}d AS (SELECT *, _before IS NULL AND row_number() OVER (
    PARTITION BY _before IS NULL, _file, {key} ORDER BY _row) > 1 AS _dup FROM {p}b),
{p}r AS (SELECT *, coalesce(_before, CASE WHEN _dup THEN 'duplicate' END,
    {when(last_cases(entity))}) AS _rule FROM {p}d),
{p}o AS (SELECT *, CASE WHEN _rule IS NULL THEN {orphan_case(name, entity)} END AS _fk FROM {p}r),
{p}tagged AS (SELECT *, coalesce(_rule, _fk) AS reject_rule,
    CASE WHEN _schema IS NOT NULL THEN 'schema' WHEN _rule IS NOT NULL THEN 'records'
         WHEN _fk IS NOT NULL THEN 'orphan' END AS reject_stage FROM {p}o)"""
