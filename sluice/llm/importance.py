"""Importance resampling: documents are drawn by how much their hashed n-grams look like a target's."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import slices
from sluice.session import stage

#: buckets of the hashed features, words of the longest feature
BUCKETS, ORDER = 10_000, 3
#: least words of a document that may be drawn, and the part of those that is drawn
MIN_WORDS, DRAW, OF = 20, 5, 100
SEED = 42
#: bytes of a text that are split into words at a time
PIECE = 1 << 20
#: lower-cases A-Z and blanks all other ASCII but letters and digits; bytes of longer characters stay
TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def word_pieces(text: bytes | None, piece: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text in order, a list for every ``piece`` bytes; a longer word stays whole."""
    data = (text or b"").translate(TABLE)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + piece)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def features(text: bytes | None, order: int = ORDER, buckets: int = BUCKETS, piece: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """For each piece of a text its number of words and the buckets of the runs that end in it.

    The checksum of a run seeds that of the run one word longer.
    """
    before: list[bytes] = []
    for words in word_pieces(text, piece):
        known, runs = len(before), before + words
        spaced = [b" " + w for w in runs]
        sums = list(map(crc32, runs))
        found = [sums[known:]]
        for n in range(1, order):
            sums = list(map(crc32, spaced[n:], sums))
            found.append(sums[max(known - n, 0) :])
        size = sum(map(len, found))
        yield len(words), np.fromiter(chain.from_iterable(found), np.uint32, size) % np.uint32(buckets)
        before = runs[len(runs) - order + 1 :] if order > 1 and len(runs) >= order else runs[: order - 1]


def _bytes_of(column: str) -> Column:
    return F.col(column).cast("string").cast("binary")


def bucket_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                for _, found in features(text.as_py()):
                    counts.update(found.tolist())
        keys, values = list(counts), list(counts.values())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(values, pa.int64())], ["bucket", "n"])

    found = texts.select(_bytes_of(column).alias("text")).mapInArrow(run, "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, gain) of every bucket: thousandths of the log ratio of its shares, one added to each count."""
    spark = docs.sparkSession
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    source = bucket_counts(docs).withColumnRenamed("n", "s")
    wanted = bucket_counts(target).withColumnRenamed("n", "t")
    both = stage(every.join(source, "bucket", "left").join(wanted, "bucket", "left").na.fill(0, ["s", "t"]), "buckets")
    sums = both.agg(F.sum("s").alias("s_all"), F.sum("t").alias("t_all"))
    s, t, s_all, t_all = (F.col(c).cast("double") for c in ("s", "t", "s_all", "t_all"))
    ratio = (t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS))
    # one row joined to the fixed number of buckets
    one = both.withColumn("_all", F.lit(1)).join(sums.withColumn("_all", F.lit(1)), "_all")
    return one.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weighed(docs: DataFrame, target: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, text, n_words, n_features, weight."""
    table = np.zeros(BUCKETS, dtype=np.int64)
    for row in gains(docs, target).collect():  # one row a bucket
        table[row["bucket"]] = row["gain"]
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in (b for whole in batches for b in slices([whole], "text")):
            rows = []
            for text in batch.column("text"):
                n_words = n_features = weight = 0
                for n, found in features(text.as_py()):
                    n_words, n_features = n_words + n, n_features + len(found)
                    weight += int(gain[found].sum())
                rows.append((n_words, n_features, weight))
            more = [pa.array(v, pa.int64()) for v in (zip(*rows) if rows else ((), (), ()))]
            texts = batch.column("text").cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, *more], names)

    names = ["doc_id", "text", "n_words", "n_features", "weight"]
    kept = docs.select(F.col(id_column).cast("long").alias("doc_id"), _bytes_of("text").alias("text"))
    return kept.mapInArrow(run, "doc_id long, text string, n_words long, n_features long, weight long")


def noise(id_column: str, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel variable that the id fixes; a null id counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(uniform)))


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Adds ``place``, the number of a row from 1 in a given order, and ``rows``, the number of all.

    The rows are dealt out by ranges of the order and written with their
    place in a range; the number of rows before a range, one row a task,
    makes it the place in the whole.  No task holds more than a range.
    """
    inside = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    inside = stage(inside.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    part = F.shiftrightunsigned("_at", 33)
    sizes = inside.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # one row a task of the sort
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("_n").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    sizes = stage(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"), whole.alias("rows")), "sizes")
    placed = inside.withColumn("_part", part).join(sizes, "_part")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1
    return placed.withColumn("place", place).drop("_at", "_part", "_before")


def resampled(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank and, if asked for, text.

    ``weight`` is the sum of the gains of a document's features, ``score``
    that plus the noise of its id.  Of the documents of MIN_WORDS words or
    more, the DRAW of OF with the highest scores have a rank, from 1, ties to
    the smaller id, a null id last; all others have none.  That is a draw without
    replacement with chances in proportion to exp(weight / 1000).

    A null text is empty: no features, weight 0.  Rows of one id are
    documents of their own with one noise; equal ones are ranked in any order.  An
    empty target has no counts, an empty table no rows.  Only the columns
    named here are read.  A word of any length is one word; texts are split
    a megabyte at a time.
    """
    found = weighed(docs, target, id_column)
    found = found.withColumn("score", F.col("weight") + noise("doc_id"))
    found = stage(found if with_text else found.drop("text"), "scores")
    able = ranked(found.where(F.col("n_words") >= MIN_WORDS), F.desc("score"), F.asc_nulls_last("doc_id"))
    drawn = F.col("place") <= F.floor(DRAW * F.col("rows") / OF)
    able = able.withColumn("rank", F.when(drawn, F.col("place")))
    rest = found.where(F.col("n_words") < MIN_WORDS).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank", *["text"] * with_text]
    return able.select(*columns).unionByName(rest.select(*columns))
