"""SimHash fingerprints and near-duplicate groups by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import sieve, slices, text_of
from sluice.llm.components import components
from sluice.llm.near_copies import digest_of, near_copies
from sluice.llm.shingles import hashes_of, majority
from sluice.session import stage

#: words of a shingle, bits that linked fingerprints may differ in
SHINGLE, RADIUS = 3, 2
#: bits of a segment; fingerprints under one table key from which on they are linked on their own
SEGMENT, CROWD = 32, 32
#: fingerprints of a task that enumerates keys
PART_ROWS = 400_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in more than half of the hashes of all shingles, repeats included."""
    return majority(hashes_of(text, shingle))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint of each row's whole text as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            fps = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], ["id", "fp"])

    kept = docs.select(F.col(id_column).cast("long").alias("id"), text_of().alias("text"))
    return kept.mapInArrow(run, "id long, fp long")


def _segments(fp: Column) -> Column:
    """Table keys of a fingerprint: each 32-bit segment's value, with the segment's number above it."""
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.call_function("shiftrightunsigned", fp, F.lit(32))
    return F.array(low, high.bitwiseOR(F.lit(1 << 32)))


def _flips(value: Column, bits: int) -> Column:
    one = F.lit(1).cast("long")
    return F.transform(
        F.sequence(F.lit(0), F.lit(bits - 1)),
        lambda bit: value.bitwiseXOR(F.call_function("shiftleft", one, bit)),
    )


def _ball(fp: Column) -> Column:
    """Table keys within one bit of either segment's own."""
    near = lambda key: F.concat(F.array(key), _flips(key, SEGMENT))
    return F.flatten(F.transform(_segments(fp), near))


def _shared_out(fps: DataFrame) -> DataFrame:
    """As many partitions as the rows need once each has become some 66 keys."""
    cores = fps.sparkSession.sparkContext.defaultParallelism
    return fps.repartition(max(cores, -(-fps.count() // PART_ROWS)))


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS


def fingerprint_links(fps: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within two bits of each other.

    Multi-index hashing with two segments of 32 bits, a table for each, keyed
    by the segment's value.  Of two fingerprints within two bits one segment
    differs in one bit at most.  So each fingerprint enumerates the ball of
    radius 1 around each of its segments, fetches what the table holds under
    these 66 keys and keeps those whose complete distance is 2 or less.

    A table key that more than ``crowd`` fingerprints share, such as half a
    group of near copies, would make pairs by the square of their number.  Its
    fingerprints leave the table and are linked among themselves (``_crowded``).
    Nothing is lost: with one of a pair under a key that is not crowded the
    other finds it there, and otherwise both are among the crowded.
    """
    fps = stage(_shared_out(fps.select("fp")), "shared_out")
    table = fps.select("fp", F.explode(_segments(F.col("fp"))).alias("key"))
    sizes = table.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    crowds = stage(sizes.select("key"), "crowds")
    sparse = table.join(crowds, "key", "left_anti").select(F.col("fp").alias("b"), "key")
    asked = fps.select(F.col("fp").alias("a"), F.explode(_ball(F.col("fp"))).alias("key"))
    fetched = asked.join(sparse, "key").where((F.col("a") != F.col("b")) & _near("a", "b"))
    links = fetched.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crowded = stage(table.join(crowds, "key", "left_semi").select("fp").distinct(), "crowded")
    return links.union(_crowded(_shared_out(crowded))).distinct()


def _crowded(fps: DataFrame) -> DataFrame:
    """Links that join all of these fingerprints within two bits, at most 65 of which meet in a group.

    Both sides enumerate: the fingerprint itself and the 64 that differ from
    it in one bit.  Two within two bits have one of these in common, and no
    more than 65 fingerprints can have the same one.  Those that meet are linked to
    the smallest of them if near it, which keeps components whole: any two of
    them are within two bits.
    """
    every = F.concat(F.array("fp"), _flips(F.col("fp"), 64))
    met = (
        fps.select("fp", F.explode(every).alias("key"))
        .groupBy("key")
        .agg(F.collect_list("fp").alias("met"))
        .where(F.size("met") > 1)
        .select(F.array_min("met").alias("a"), F.explode("met").alias("b"))
    )
    return met.where((F.col("a") != F.col("b")) & _near("a", "b"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """One row per document: id, fp and the smallest id of its component.

    Rows of one id are separate members and each is returned.  A null id is
    returned as it is and never names a component unless all its ids are
    null.  Null, empty and blank texts have fingerprint zero, linked like any
    other.
    """
    found = stage(fingerprints(docs, id_column, shingle), "fingerprints")
    distinct = stage(found.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = stage(components(fingerprint_links(distinct)), "roots")
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = stage(named, "named")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = stage(named.join(stage(least, "least"), "root").select("fp", "component_id"), "classes")
    return found.join(by_fp, "fp").select("id", "fp", "component_id")


def hex_of(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Exactly one row of each group of near copies: one with the smallest id, a null id only if all are null.

    Groups are those of ``near_copies``: five-word shingles alike in 0.8 or
    more.  Texts are proposed by the links of their SimHash fingerprints over
    the same shingles, found by multi-index hashing as above, and by least
    hashes, which also find copies whose fingerprints differ in more bits.
    The exact similarity decides about all of them.
    Rows are told apart by id and text, so rows of one id with other texts
    are decided on their own; of rows alike in both one is taken.
    """
    classes = stage(near_copies(docs, id_column, fingerprint_links), "copies")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    best = stage(classes.groupBy("node").agg(F.min(rank).alias("best")), "best")
    taken = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("digest") == F.col("best.digest"))
    marks = classes.join(best, "node").withColumn("taken", taken).where("not taken or copies > 1")
    # names that no column of the table has, and columns by position: any name may be there
    at, of, digest = (_free(name, docs) for name in ("_id", "_of", "_digest"))
    marks = stage(marks.select(F.col("id").alias(at), F.col("digest").alias(of), "taken"), "marks")
    taken_rows = marks.where("taken").drop("taken")
    keyed = docs.withColumn(digest, digest_of(text_of()))
    # most rows stay and have no mark: only those that may have one are shuffled
    part = sieve(marks, F.struct(at, of))
    key = F.struct(F.col(id_column).cast("long"), digest)
    alone = part(keyed, key, False)
    # a digest is never null, but said here both joins below read one and the same shuffle of the texts
    keyed = part(keyed.where(F.col(digest).isNotNull()), key, True)
    same = F.col(id_column).cast("long").eqNullSafe(F.col(at)) & (F.col(digest) == F.col(of))
    single = keyed.join(marks.drop("taken"), same, "left_anti")
    repeated = keyed.join(taken_rows, same, "left_semi").dropDuplicates([id_column, digest])
    return alone.union(single).union(repeated).drop(digest)


def _free(name: str, docs: DataFrame) -> str:
    """A column name like ``name`` that the table lacks, in either case."""
    known = {c.lower() for c in docs.columns}
    while name in known:
        name += "_"
    return name
