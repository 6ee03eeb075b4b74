"""Guarded casts from text: a value that does not parse becomes null, never an error.

The functions take and give SQL expression text, so the many rules of an
entity reach Spark as one expression each.
"""

from __future__ import annotations

from sluice.functions.text import RETRY_NULLS, SCHEMA_NULLS, one_of, stripped

# Accepted spellings.
NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
TIMESTAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?)?$"
)
TRUE_TOKENS = ("True", "true", "1")
FALSE_TOKENS = ("False", "false", "0")

# Largest magnitudes the warehouse columns hold: 32-bit integers, decimals with
# 14 digits before the point, and integers a double holds exactly.
INT32_LIMIT = 2147483647
DECIMAL_LIMIT = 99999999999999
EXACT_LIMIT = 9007199254740991


def to_number(c: str) -> str:
    """Double, or null if the text is no number; the cast ignores the blanks that it may have."""
    return f"CASE WHEN {c} RLIKE r'{NUMBER}' THEN try_cast({c} AS DOUBLE) END"


def number_or_nan(c: str) -> str:
    """Double; null for a text that stands for null, NaN for one that is no number.

    NaN compares greater than every limit, so one comparison finds both the
    unreadable and the too large.
    """
    return (
        f"CASE WHEN {c} RLIKE r'{NUMBER}' THEN try_cast({c} AS DOUBLE) "
        f"WHEN {c} NOT IN {one_of(SCHEMA_NULLS)} THEN double('NaN') END"
    )


def to_timestamp(c: str) -> str:
    """Wall-clock timestamp from an ISO date or date-time; or null."""
    return f"CASE WHEN {c} RLIKE r'{TIMESTAMP}' THEN try_cast({c} AS TIMESTAMP_NTZ) END"


def to_boolean(c: str) -> str:
    return (
        f"CASE WHEN {c} IN {one_of(TRUE_TOKENS)} THEN true "
        f"WHEN {c} IN {one_of(FALSE_TOKENS)} THEN false END"
    )


def parse(c: str, dtype: str) -> str:
    """The value a text stands for, by declared type; null if it stands for none.

    Integers come back as unrounded doubles: fractions are accepted, as the
    source does not tell ``3`` from ``3.0``, and only round when they reach
    an integer column.
    """
    if dtype == "str":
        return c
    if dtype == "datetime":
        return to_timestamp(c)
    if dtype == "bool":
        return to_boolean(c)
    return to_number(c)


def number_limit(dtype: str, wide: bool = False) -> int:
    """Largest magnitude that fits the column a number is loaded into."""
    return DECIMAL_LIMIT if dtype == "float" else EXACT_LIMIT if wide else INT32_LIMIT


def from_text(c: str, dtype: str) -> str:
    """Parse and convert to the column's own type."""
    value = parse(c, dtype)
    return f"try_cast(round({value}) AS BIGINT)" if dtype == "int" else value


def coerce(c: str, dtype: str) -> str:
    """Safe cast of a value taken back out of quarantined JSON."""
    known = f"coalesce(lower({stripped(c)}) NOT IN {one_of(RETRY_NULLS)}, false)"
    return f"CASE WHEN {known} THEN {from_text(stripped(c), dtype)} END"
