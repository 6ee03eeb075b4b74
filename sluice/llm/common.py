"""What several operators share: words, tables, files on shared storage."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.sieve import free_mark, sieve

__all__ = ["free_mark", "named", "once", "open_folder", "put_file", "sieve", "slices", "table", "text_of", "words_of"]

#: fixed values: the white space that separates words
WHITE = "\t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null and blank texts."""
    spaced = F.trim(F.translate(text, WHITE, " " * len(WHITE)))
    none = F.array().cast("array<string>")
    return F.when(F.length(spaced) > 0, F.split(spaced, " +")).otherwise(none)


def named(column: str) -> Column:
    """The column of exactly this name, which may hold dots and the like."""
    return F.col("`" + column.replace("`", "``") + "`")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row.

    The optimizer may put the expression of a plain column in place of its
    name, also inside the lambda of a higher-order function, where it would be
    computed for every element.  It does not do so across a generator.
    """
    kept = [named(c) for c in df.columns if c != name]
    return df.select(*kept, F.explode(F.array(value)).alias(name))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator:
    """Record batches cut so that each holds about ``limit`` bytes of a text column."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        first = held = 0
        for i, size in enumerate(sizes):
            held += size or 0
            if held >= limit:
                yield batch.slice(first, i + 1 - first)
                first, held = i + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, on any scheme that pyarrow knows, and the path in it."""
    return pafs.FileSystem.from_uri(uri)


def put_file(uri: str, content: Iterable[bytes]) -> None:
    """Write a file whole or not at all: a task that is run again replaces it."""
    fs, path = open_folder(uri)
    fs.create_dir(posixpath.dirname(path), recursive=True)
    part = f"{path}.{uuid4().hex}.part"
    with fs.open_output_stream(part) as out:
        for piece in content:
            out.write(piece)
    fs.move(part, path)
