"""Landing files: discovery, fingerprints and untyped reading.

CSV files have a header; JSON files hold one array of objects or one object.
Every cell is read as text, so nothing is lost before validation.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.cascade import ARRIVED, EXCESS, FILE, ROW
from sluice.spec import BATCH, Entity, entity_for_file, load_order, ENTITIES

CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}
FORMATS = ("csv", "json")
_RECORD = "_record"

#: larger files are read piece by piece instead of as one cell; the fingerprint is the same
MAX_CELL_BYTES = 512 * 1024 * 1024
#: of schemes that pyarrow knows, files above this: a cell, its text and its objects are all in one task's memory
CELL_BYTES = 16 * 1024 * 1024
KNOWN_SCHEME = "^(file|hdfs|s3|s3a|s3n|gs|abfs|abfss):"
#: bytes of a piece
PIECE = 1 << 23
#: bytes of texts that are handed on at once
HANDED = 1 << 22


def file_format(path: str) -> str:
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix not in FORMATS:
        raise ValueError(f"unsupported file type {suffix!r}: {path}")
    return suffix


def read_text_table(
    spark: SparkSession,
    paths: Sequence[str],
    entity: Entity,
    fmt: str | None = None,
    header: Sequence[str] | None = None,
) -> DataFrame:
    """The entity's columns as text, with the file, its time and the row's place in the scan.

    ``header`` gives the order of the columns in CSV files, if it is not the
    declared one.  Rows of one file are numbered in file order, so the
    smaller ``_row`` is the earlier one; across files the file's time and
    path come first.  The numbering belongs to this scan: stage the result
    before using it in more than one plan.  ``_excess`` is the text of a CSV
    record with more cells than columns, else null.
    """
    fmt = fmt or file_format(paths[0])
    if fmt == "csv":
        names = list(header or entity.names)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RECORD]])
        df = (
            spark.read.schema(schema)
            .options(**CSV_OPTIONS, enforceSchema=False, columnNameOfCorruptRecord=_RECORD)
            .csv(list(paths))
        )
        # a blank CSV cell is an empty text, not a missing value
        cells = [F.coalesce(F.col(n), F.lit("")).alias(n) for n in entity.names]
        # records that are too short are kept here as well, and have blank cells
        record = F.rtrim(F.col(_RECORD), F.lit("\r\n"))
        n_cells = F.size(F.split(F.regexp_replace(record, '"[^"]*"', ""), ","))
        excess = F.when(n_cells > len(names), record)
    else:
        df = spark.read.schema(entity.raw_schema()).option("multiLine", True).json(list(paths))
        cells = [F.col(n) for n in entity.names]
        excess = F.lit(None).cast("string")
    return df.select(
        *cells,
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_modification_time").alias(ARRIVED),
        F.monotonically_increasing_id().alias(ROW),
        excess.alias(EXCESS),
    )


def read_untyped(spark: SparkSession, paths: Sequence[str], fmt: str) -> DataFrame:
    """Whatever columns the files have, as text: for files whose columns are not as declared."""
    if fmt == "csv":
        df = spark.read.options(**CSV_OPTIONS).csv(list(paths))
    else:
        df = spark.read.options(multiLine=True, primitivesAsString=True).json(list(paths))
    return df


def _header_columns(text: Column) -> Column:
    """Column names in the first line of a CSV text."""
    header = F.regexp_replace(F.substring_index(text, "\n", 1), "[﻿\r\"]", "")
    return F.when(header == "", F.array().cast("array<string>")).otherwise(F.split(header, ","))


def _columns_of(text: Column, fmt: Column) -> Column:
    objects = F.coalesce(
        F.from_json(text, "array<map<string,string>>"),
        F.array(F.from_json(text, "map<string,string>")),
    )
    names = F.flatten(F.transform(F.filter(objects, lambda o: o.isNotNull()), F.map_keys))
    found = F.when(fmt == "csv", _header_columns(text)).otherwise(F.array_distinct(names))
    return F.when(text.isNotNull(), found)


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    scheme, rest = uri.split(":", 1)
    # fixed values: other names of the schemes of one store
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(f"{scheme}:{rest}")


def array_elements(uri: str) -> Iterator[tuple[str, dict]]:
    """Text and keys of each object of plain values in a JSON array, with one piece of the file in memory.

    Anything else, such as a cut-off file, another encoding, nested values or single quotes,
    is a ValueError: Spark's reader knows more kinds, but holds all rows of an array.
    """
    decode = json.JSONDecoder(parse_int=str, parse_float=str).raw_decode
    to_text = codecs.getincrementaldecoder("utf-8")()
    fs, path = _opened(uri)
    with fs.open_input_stream(path, compression=None) as file:
        text, at, state = "", 0, "begin"
        while True:
            piece = file.read(PIECE)
            text, at = text[at:] + to_text.decode(piece, final=not piece), 0
            while True:
                at = _BLANK.match(text, at).end()
                if at == len(text):
                    break
                if state == "end":
                    raise ValueError("text after the array")
                if state == "begin":
                    if text[at] != "[":
                        raise ValueError("no array")
                    at, state = at + 1, "first"
                elif text[at] == "]" and state in ("first", "comma"):
                    at, state = at + 1, "end"
                elif state == "comma":
                    if text[at] != ",":
                        raise ValueError("no comma")
                    at, state = at + 1, "element"
                else:
                    if text[at] != "{":
                        raise ValueError("no object")
                    try:
                        found, end = decode(text, at)
                    except (ValueError, RecursionError) as error:
                        if piece:
                            break
                        raise ValueError("cut off") from error
                    if any(isinstance(v, (dict, list)) for v in found.values()):
                        raise ValueError("nested values, whose text Spark's reader takes as it is in the file")
                    yield text[at:end], found
                    at, state = end, "comma"
            if not piece:
                if state != "end":
                    raise ValueError("cut off")
                return


_BLANK = re.compile(r"[ \t\r\n]*")


def _array_names(uri: str) -> list[str] | None:
    """The keys of all objects of an array in their order; null for what :func:`array_elements` does not take."""
    names: dict[str, None] = {}
    try:
        for _, found in array_elements(uri):
            names.update(dict.fromkeys(found))
    except ValueError:
        return None
    return list(names)


def _element_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of the elements of files, in their order."""
    for batch in batches:
        for row in batch.to_pylist():
            texts, held = [], 0
            for text, _ in array_elements(row["path"]):
                texts.append(text)
                held += len(text)
                if held >= HANDED:
                    yield _texts_of(row, texts)
                    texts, held = [], 0
            if texts:
                yield _texts_of(row, texts)


def _texts_of(row: dict, texts: list[str]) -> pa.RecordBatch:
    n = len(texts)
    columns = [pa.array([row[FILE]] * n), pa.array([row[ARRIVED]] * n, pa.timestamp("us", "UTC")), pa.array(texts)]
    return pa.RecordBatch.from_arrays(columns, [FILE, ARRIVED, _RECORD])


def large_arrays(spark: SparkSession, paths: Sequence[str], from_bytes: int | None = None) -> set[str]:
    """Of files, those too large for one cell that are read in pieces instead."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    limit = CELL_BYTES if from_bytes is None else from_bytes
    large = found.where((F.col("length") > limit) & F.col("path").rlike(KNOWN_SCHEME))
    return {r["path"] for r in large.select("path").toLocalIterator()}


def read_large_arrays(spark: SparkSession, paths: Sequence[str], entity: Entity) -> DataFrame:
    """As :func:`read_text_table`, for JSON files that each hold one array of objects: a task holds a piece of one."""
    found = spark.read.format("binaryFile").load(list(paths)).select(
        "path",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_modification_time").alias(ARRIVED),
    )
    found = found.repartition(max(1, len(paths)), "path")
    texts = found.mapInArrow(_element_texts, f"{FILE} string, {ARRIVED} timestamp, {_RECORD} string")
    opened = texts.withColumn(ROW, F.monotonically_increasing_id()).withColumn(
        _RECORD, F.from_json(_RECORD, entity.raw_schema())
    )
    cells = [F.col(f"{_RECORD}.{n}").alias(n) for n in entity.names]
    return opened.select(*cells, FILE, ARRIVED, ROW, F.lit(None).cast("string").alias(EXCESS))


def _in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """MD5 and first line of files, held one piece at a time."""
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = _opened(row["path"])
            digest, head, in_head = hashlib.md5(), b"", True
            with fs.open_input_stream(path, compression=None) as file:
                while piece := file.read(PIECE):
                    digest.update(piece)
                    if in_head:
                        head += piece.split(b"\n", 1)[0]
                        # no header is longer than a piece
                        in_head = b"\n" not in piece and len(head) < PIECE
            row |= {"file_hash": digest.hexdigest(), "header": head.decode("utf-8", "replace")}
            row["names"] = _array_names(row["path"]) if row["file_name"].lower().endswith(".json") else None
            yield pa.RecordBatch.from_pylist([row], _READ)


_READ = pa.schema(
    [(n, pa.string()) for n in ("path", "file_path", "file_name", "file_hash", "header")]
    + [("names", pa.list_(pa.string()))]
)
INVENTORY = "path string, file_path string, file_hash string, file_name string, columns array<string>"


def inventory(
    spark: SparkSession, paths: Sequence[str], max_cell: int = MAX_CELL_BYTES
) -> DataFrame:
    """One row per file: location, MD5 of its bytes and the column names it holds.

    The MD5 is that of all bytes at every size.  Files above ``max_cell``
    bytes are not loaded into one cell but read in pieces by a task of their
    own, which takes a scheme that pyarrow knows; if all have one, that begins at
    CELL_BYTES.  Of those, JSON files that are not one array of objects have null column
    names: only Spark's reader tells them.
    """
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    )
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    # a plain limit: the scan then leaves the content of larger files unread
    if found.where(~F.col("path").rlike(KNOWN_SCHEME)).select("path").isEmpty():
        max_cell = min(max_cell, CELL_BYTES)
    small = found.where(F.col("length") <= max_cell).select(
        "path",
        path.alias("file_path"),
        F.md5("content").alias("file_hash"),
        name.alias("file_name"),
        _columns_of(F.col("content").cast("string"), _suffix(name)).alias("columns"),
    )
    named = found.where(F.col("length") > max_cell).select(
        "path", path.alias("file_path"), name.alias("file_name")
    )
    read = named.mapInArrow(
        _in_pieces, "path string, file_path string, file_name string, file_hash string, header string, names array<string>"
    )
    large = read.select(
        "path",
        "file_path",
        "file_hash",
        "file_name",
        F.when(_suffix(F.col("file_name")) == "csv", _header_columns(F.col("header")))
        .otherwise(F.col("names"))
        .alias("columns"),
    )
    return small.unionByName(large)


def _suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"([^.]*)$", 1))


def batch_plan(spark: SparkSession, folder: str) -> list[tuple[Entity, list[str]]]:
    """Expected dimension files below a day's folder, parents first.

    Files of unknown name are not listed.  Only names and paths come to the
    driver, as they do for any file scan.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", F.col("_metadata.file_name").alias("name"))
    )
    by_entity: dict[str, list[str]] = {}
    for row in listed.toLocalIterator():
        try:
            entity = entity_for_file(row["name"])
        except ValueError:
            continue
        if entity.kind == BATCH:
            by_entity.setdefault(entity.name, []).append(row["path"])
    return [(ENTITIES[n], sorted(by_entity[n])) for n in load_order() if n in by_entity]


PATH_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def arriving_files(
    spark: SparkSession, folder: str, pattern: str, files_per_batch: int = 100
) -> DataFrame:
    """Stream of the paths of matching files as they arrive anywhere below ``folder``.

    Contents are not read here: the column is pruned from the scan.
    """
    return (
        spark.readStream.format("binaryFile")
        .schema(PATH_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
    )
