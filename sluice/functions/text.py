"""Null vocabularies, id normalising, status and reason texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three null vocabularies of the three stages.
SCHEMA_NULLS = ("None", "nan", "NaN", "NaT", "")
PLACEHOLDERS = ("", "nan", "null", "none", "na", "n/a")
RETRY_NULLS = ("nan", "none", "null", "")

# Reason texts of quarantined rows.
REASON_SCHEMA = "Records failed in schema validation"
REASON_RULES = {
    "batch": "Quarantined records due to batch rules",
    "stream": "Quarantined records due to stream rules",
}
REASON_ORPHAN = "Orphan records (Referential integrity failed)"

WHITESPACE = " \t\n\x0b\x0c\r"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def one_of(values: tuple[str, ...]) -> str:
    """Texts as a SQL list."""
    return "(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def stripped(c: str) -> str:
    """SQL text of :func:`strip`."""
    return f"btrim({c}, ' \\t\\n\\u000b\\u000c\\r')"


def is_schema_null(c: str) -> str:
    """Null, or a text that stands for null in an untyped file (case matters)."""
    return f"({c} IS NULL OR {c} IN {one_of(SCHEMA_NULLS)})"


def is_placeholder(c: str) -> str:
    return f"coalesce(lower({stripped(c)}) IN {one_of(PLACEHOLDERS)}, true)"


def is_retry_null(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)).isin(*RETRY_NULLS), F.lit(True))


def normal_id(c: Column) -> Column:
    """An id as text: trimmed, and ``370.0`` written as ``370``."""
    text = strip(c.cast("string"))
    # few ids have the ending, and looking for it costs less than a pattern
    short = F.regexp_replace(text, "^[+]?(-?)0*([0-9]+)[.]0$", "$1$2")
    return F.when(text.contains(".0"), short).otherwise(text)


def stage_of_reason(reason: Column) -> Column:
    """The rejection stage a reason text belongs to."""
    low = F.lower(reason)
    return (
        F.when(low.contains("schema"), "schema")
        .when(low.contains("orphan") | low.contains("referential"), "orphan")
        .otherwise("records")
    )


def is_reopened(status: Column) -> Column:
    return F.coalesce(strip(status) == "Reopened", F.lit(False))


def file_stem(name: Column) -> Column:
    """Logical name of a file: base name without folder and extension, lower case."""
    return F.lower(F.regexp_extract(name, r"([^/]*?)(\.[^./]*)?$", 1))
