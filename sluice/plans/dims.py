"""Dimension rows from typed source rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.sources.warehouse import table_schema
from sluice.operators.dedup import last_per_key
from sluice.spec import Entity


def column_or_null(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None)


def conform(df: DataFrame, table: str, *keep: str) -> DataFrame:
    """Columns and types of a warehouse table; absent columns are null.

    Whole-number columns take the nearest integer.
    """
    source = dict(df.dtypes)
    columns = []
    for f in table_schema(table).fields:
        c = column_or_null(df, f.name)
        if f.dataType.typeName() == "integer" and source.get(f.name) == "double":
            c = F.round(c)
        columns.append(c.cast(f.dataType).alias(f.name))
    return df.select(*columns, *keep)


def with_city_name(regions: DataFrame, cities: DataFrame, order: str | None = None) -> DataFrame:
    """Regions with the name of their city; no such city gives null.

    With ``order`` a repeated city id takes the name of its last row.
    """
    names = _names(cities, "city_id", "city_name", order)
    return regions.join(names, "city_id", "left")


def with_reason_category(
    reasons: DataFrame, categories: DataFrame, order: str | None = None
) -> DataFrame:
    """Reasons with the name of their category."""
    names = _names(categories, "reason_category_id", "category_name", order)
    return reasons.join(names, "reason_category_id", "left").withColumnRenamed(
        "category_name", "reason_category"
    )


def _names(lookup: DataFrame, key: str, name: str, order: str | None) -> DataFrame:
    usable = lookup.where(
        F.col(key).isNotNull() & F.col(name).isNotNull() & (F.col(name) != "")
    )
    if order is not None:
        return last_per_key(usable, key, name, order)
    # loaded dimensions hold each key once; their file size decides the join
    return usable.select(key, name)


def build_dimension(
    entity: Entity, clean: DataFrame, lookup: DataFrame | None, loaded_at, *keep: str
) -> DataFrame:
    """Rows for the entity's dimension table.

    ``lookup`` is the cities table for regions and the reason categories for
    reasons; other dimensions need none.
    """
    if entity.name == "regions" and lookup is not None:
        clean = with_city_name(clean, lookup)
    elif entity.name == "reasons" and lookup is not None:
        clean = with_reason_category(clean, lookup)
    return conform(clean.withColumn("_loaded_at", loaded_at), entity.table, *keep)


#: the loaded dimension each lookup reads
LOOKUP_TABLE = {"regions": "dim_city", "reasons": "dim_reason_category"}
