"""Hashing of personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import strip
from sluice.spec import Entity


def hash_value(c: Column) -> Column:
    """SHA-256 hex of the text; null, blank and ``n/a`` stay as they are."""
    text = c.cast("string")
    return F.when(
        text.isNull() | (text == "") | (F.lower(strip(text)) == "n/a"), text
    ).otherwise(F.sha2(text, 256))


def mask(df: DataFrame, entity: Entity) -> DataFrame:
    present = [c for c in entity.pii if c in df.columns]
    return df.withColumns({c: hash_value(F.col(c)) for c in present}) if present else df
