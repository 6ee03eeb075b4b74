"""Left joins of wide rows with few keys, in which only rows that may meet a key are shuffled."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import as_large, fits_broadcast, stage

#: bits of a sieve for each of its rows, and most bits that one has (16 MB); bits of a page, as Spark's bitmaps have them
SIEVE_BITS, SIEVE_MOST, PAGE = 16, 1 << 27, 1 << 15


def free_mark(df: DataFrame, mark: str) -> str:
    """A prefix like ``mark`` that no column of the table starts with, in either case."""
    while any(c.lower().startswith(mark.lower()) for c in df.columns):
        mark += "_"
    return mark


def sieve(few: DataFrame, key: Column) -> Callable[[DataFrame, Column, bool], DataFrame]:
    """Parts a table by its keys: rows that certainly have no equal in ``few``, or those that may have one.

    Where a join meets few rows of a wide table, the others need not be
    shuffled for it.  A bit is set for the hash of each key.  The pages of
    bits are broadcast, 16 MB at most: with more rows than that is made for,
    more of the table may have an equal and is shuffled, and nothing is lost.
    """
    flag = sieve_flag(few, key)

    def part(df: DataFrame, key: Column, may_have: bool) -> DataFrame:
        into = free_mark(df, "_v_") + "found"
        return flag(df, key, into).where(F.col(into) if may_have else ~F.col(into)).drop(into)

    return part


def sieve_flag(few: DataFrame, key: Column) -> Callable[[DataFrame, Column, str], DataFrame]:
    """As :func:`sieve`, but adds a boolean column: whether the row may have an equal in ``few``."""
    wanted = few.count() * SIEVE_BITS
    bits = min(SIEVE_MOST, max(1, -(-wanted // PAGE)) * PAGE)

    def place(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(bits)) + 1

    set_bits = few.select(F.bitmap_bucket_number(place(key)).alias("page"), F.bitmap_bit_position(place(key)).alias("bit"))
    pages = set_bits.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))
    # two bytes an element: a bit is then found without making a text of them
    two = F.transform(
        F.sequence(F.lit(0), F.lit(PAGE // 16 - 1)),
        lambda i: (F.conv(F.hex(F.substring("bits", 2 * i + 1, F.lit(2))), 16, 10).cast("int") - 32768).cast("smallint"),
    )
    pages = stage(pages.select("page", two.alias("bits")), "sieve")

    def flag(df: DataFrame, key: Column, into: str) -> DataFrame:
        mark = free_mark(df, "_v_")
        page, held = f"{mark}page", f"{mark}bits"
        own = pages.select(F.col("page").alias(page), F.col("bits").alias(held))
        bit = F.bitmap_bit_position(place(key))
        both = F.get(F.col(held), F.shiftright(bit, 4).cast("int")).cast("int") + 32768
        found = F.coalesce(F.getbit(both, bit.bitwiseAND(15).bitwiseXOR(8).cast("int")) == 1, F.lit(False))
        met = df.join(F.broadcast(own), F.bitmap_bucket_number(place(key)) == F.col(page), "left")
        return met.withColumn(into, found).drop(page, held)

    return flag


#: few rows, their key columns, and what each is equal to in the wide rows
Few = tuple[DataFrame, Sequence[str], Sequence[Column]]


def left_join_few(df: DataFrame, parts: Sequence[Few]) -> DataFrame:
    """Left joins of ``df`` with staged tables of few rows, whose columns are added.

    What fits a broadcast is broadcast.  For the others ``df`` is parted: rows
    that meet none of them get nulls and are not shuffled, and those that may
    meet the largest only are shuffled once, for it.  ``df`` is read three times
    at most for that, so it should be a table and not a plan with joins.
    """
    large = []
    for few, names, equals in parts:
        if fits_broadcast(few):
            df = df.join(few, _same(names, equals), "left")
        else:
            large.append((few.count(), few, names, equals))
    if not large:
        return df
    large.sort(key=lambda x: x[0])
    mark = free_mark(df, "_w_")
    marks = [f"{mark}{i}" for i in range(len(large))]
    for (_, few, names, equals), into in zip(large, marks):
        flag = sieve_flag(few.select(*names), F.struct(*names))
        df = flag(df, F.struct(*[e.alias(n) for e, n in zip(equals, names)]), into)
    *earlier, last = map(F.col, marks)
    any_earlier = reduce(Column.__or__, earlier, F.lit(False))
    branches = [(~(any_earlier | last), 0), (~any_earlier & last, 1)]
    if earlier:
        branches.append((any_earlier, len(large)))
    found = []
    for condition, n in branches:
        rows = df.where(condition).drop(*marks)
        for i, (_, few, names, equals) in enumerate(large):
            if i >= len(large) - n:
                rows = rows.join(as_large(few), _same(names, equals), "left")
            else:
                rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in few.schema.fields})
        found.append(rows)
    return reduce(DataFrame.unionByName, found)


def _same(names: Sequence[str], equals: Sequence[Column]) -> Column:
    return reduce(Column.__and__, [e == F.col(n) for n, e in zip(names, equals)])
