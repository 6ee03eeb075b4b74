"""Keep-first duplicate removal by key, safe for keys that hold much of the data.

No window is used: a window would send every copy of a key to one task.
Instead the keys that occur more than once are found by a map-side combined
aggregation over key and order columns only, staged, and joined back.  They
are normally few, so the wide rows are not shuffled at all; when they are
many the join is a shuffled one whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import as_large, stage

DUPLICATE = "_duplicate"


def repeated_keys(
    df: DataFrame, keys: dict[str, Column], order: Column, among: Column | None = None
) -> DataFrame:
    """Keys with more than one row, with the order value of their first row.

    ``among`` restricts the rows that count.  It blanks the order value and
    is no filter, which would be moved below the joins of ``df`` and there
    be evaluated on rows the joins drop.
    """
    place = order if among is None else F.when(among, order)
    return (
        df.select(*[c.alias(key_name(n)) for n, c in keys.items()], place.alias("_o"))
        .groupBy(*map(key_name, keys))
        .agg(F.min("_o").alias("_first"), F.count("_o").alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )


def key_name(name: str) -> str:
    return f"_k_{name}"


def _same(keys: dict[str, Column]) -> Column:
    return reduce(Column.__and__, [c == F.col(key_name(n)) for n, c in keys.items()])


def with_first(df: DataFrame, keys: dict[str, Column], repeated: DataFrame) -> DataFrame:
    """Add ``_first``, the order value of the key's first row, where the key is repeated."""
    return df.join(as_large(repeated), _same(keys), "left").drop(*map(key_name, keys))


def flag_duplicates(df: DataFrame, keys: dict[str, Column], order: Column) -> DataFrame:
    """Add a boolean that is true on all but the first row of each key.

    ``order`` must be unique within a key.
    """
    repeated = stage(repeated_keys(df, keys, order), "repeated")
    return (
        with_first(df, keys, repeated)
        .withColumn(DUPLICATE, F.coalesce(order > F.col("_first"), F.lit(False)))
        .drop("_first")
    )


def split_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(first rows, duplicates) by key, first in the order of the ``order`` columns."""
    by = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    flagged = flag_duplicates(df, {k: F.col(k) for k in keys}, by)
    return (
        flagged.where(~F.col(DUPLICATE)).drop(DUPLICATE),
        flagged.where(DUPLICATE).drop(DUPLICATE),
    )


def duplicate_rate(rows: Column, duplicates: Column) -> Column:
    """Share of duplicates to four decimals, zero for an empty input."""
    return F.coalesce(F.round(duplicates / F.nullif(rows, F.lit(0)), 4), F.lit(0.0))


def last_per_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key holding the value of its last row."""
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))
