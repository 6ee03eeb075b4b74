"""Groups of near copies: texts whose sets of five-word shingles are alike in 0.8 or more."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import sieve, slices, text_of
from sluice.llm.components import components
from sluice.llm.shingles import hashes_of, majority
from sluice.session import stage

#: words of a shingle, least shared part of two sets (intersection by union)
SHINGLE, SIMILARITY = 5, 0.8
#: tables, and least hashes that form one key; a pair at 0.8 shares no key with probability 0.0004
BANDS, ROWS = 20, 5
#: rounds in which every text is compared with one other of another group
STARS = 2
#: of the BANDS * ROWS least hashes, those that must agree before the sets themselves are compared; a pair
#: at 0.8 has fewer with probability 3e-6
AGREE = 60
#: classes of shingles by the number of texts that hold them: 2 to 3, 4 to 15, 16 to 63 and so on
CLASSES = 6
_FACTORS = np.random.default_rng(7).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * 2 + 1


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's shingles in order; a shorter text is one shingle."""
    return np.unique(hashes_of(text, shingle))


def _least(hashes: np.ndarray) -> np.ndarray:
    """The least value of each permutation of the hashes."""
    least = np.full(BANDS * ROWS, (1 << 64) - 1, dtype=np.uint64)
    for at in range(0, len(hashes), 1 << 11):
        least = np.minimum(least, np.multiply.outer(hashes[at : at + (1 << 11)], _FACTORS).min(axis=0))
    return least


def keys_of(hashes: np.ndarray) -> list[int]:
    """A key for each table: a hash of the least values of its ROWS permutations."""
    return _keys(_least(hashes))


def _keys(least: np.ndarray) -> list[int]:
    import xxhash

    data = least.tobytes()
    keys = [xxhash.xxh64_intdigest(data[i * 8 * ROWS : (i + 1) * 8 * ROWS], seed=i) for i in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def _marks(least: np.ndarray) -> bytes:
    """Sixteen bits of each least value."""
    return (least * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype("<u2").tobytes()


def digest_of(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _sketches(texts: DataFrame) -> DataFrame:
    """(id, digest, size, keys, marks, fp) of rows (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            every = [hashes_of(t, SHINGLE) for t in batch.column("text").to_pylist()]
            sets = [np.unique(h) for h in every]
            least = [_least(s) for s in sets]
            fps = np.array([majority(h) for h in every], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("digest"),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array(map(_keys, least), pa.list_(pa.int64())),
                    pa.array(map(_marks, least), pa.binary()),
                    pa.array(fps),
                ],
                ["id", "digest", "size", "keys", "marks", "fp"],
            )

    return texts.mapInArrow(run, "id long, digest binary, size int, keys array<long>, marks binary, fp long")


def _sets(texts: DataFrame) -> DataFrame:
    """(node, hashes) of rows (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingles(t).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])

    return texts.mapInArrow(run, "node long, hashes array<long>")


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) that agree in AGREE least hashes or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(-1, BANDS * ROWS)
                for c in ("a_marks", "b_marks")
            )
            kept = pa.array((one == two).sum(axis=1) >= AGREE)
            yield batch.select(["a", "b"]).filter(kept)

    one = nodes.select(F.col("node").alias("a"), F.col("marks").alias("a_marks"))
    two = nodes.select(F.col("node").alias("b"), F.col("marks").alias("b_marks"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "a_marks", "b_marks").mapInArrow(run, "a long, b long")


def _alike(pairs: DataFrame, nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are alike in SIMILARITY or more; empty sets are equal.

    Only likely pairs fetch their sets, that of ``b`` first: one ``a`` may
    have very many ``b``, and its set is then sent once and not with each of them.
    """
    both = F.size(F.array_intersect("_a", "_b"))
    whole = F.size("_a") + F.size("_b") - both
    likely = stage(_likely(pairs, nodes), "likely")
    wanted = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    some = sets.join(wanted, "node", "left_semi")
    one = some.select(F.col("node").alias("a"), F.col("hashes").alias("_a"))
    two = some.select(F.col("node").alias("b"), F.col("hashes").alias("_b"))
    return likely.join(two, "b").join(one, "a").where(both >= SIMILARITY * whole).select("a", "b")


def _with_roots(entries: DataFrame, links: DataFrame | None) -> DataFrame:
    """Entries with the group that the links so far put a node in."""
    if links is None:
        return entries.withColumn("root", F.col("node"))
    roots = stage(components(links), "roots")
    return stage(entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "named")


def _several(named: DataFrame, key: str) -> DataFrame:
    """Keys that hold more than one group."""
    return named.groupBy(key).agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select(key)


def _profiles(sets: DataFrame) -> DataFrame:
    """(node, profile): how many shingles of each class a text has; those that no other text holds are in no class."""
    held = sets.select("node", F.explode("hashes").alias("hash"))
    often = held.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    often = often.select("hash", F.least(F.floor(F.log2("n") / 2).cast("int"), F.lit(CLASSES - 1)).alias("class"))
    counts = (F.count_if(F.col("class") == i).cast("int") for i in range(CLASSES))
    return held.join(often, "hash").groupBy("node").agg(F.array(*counts).alias("profile"))


def _profiles_allow(a: str, b: str, a_size: str, b_size: str) -> Column:
    """Whether two sets can be alike: of each class they share no more than the lesser number."""
    most = sum(F.least(F.get(a, F.lit(i)), F.get(b, F.lit(i))) for i in range(CLASSES))
    return (1 + SIMILARITY) * most + 1e-6 >= SIMILARITY * (F.col(a_size) + F.col(b_size))


def fingerprint_pairs(nodes: DataFrame, links_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, fp) that have one fingerprint, or linked ones.

    ``links_of`` gives links (a, b) of distinct fingerprints.  The first node
    of a fingerprint stands for all of it, so pairs are no more than nodes and links.
    """
    firsts = stage(nodes.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints")
    same = nodes.join(firsts, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    linked = stage(links_of(firsts.select("fp")), "fingerprint-links")
    one = firsts.select(F.col("fp").alias("a"), F.col("first").alias("node_a"))
    two = firsts.select(F.col("fp").alias("b"), F.col("first").alias("node_b"))
    linked = linked.join(one, "a").join(two, "b").select(
        F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
    )
    return same.union(linked).distinct()


def near_links(nodes: DataFrame, sets_of, proposed: DataFrame | None = None) -> DataFrame:
    """Links that join all of ``nodes`` (node, size, keys, marks) that share a key and are alike.

    The ``proposed`` pairs (a, b) are compared as well, with the first round.

    First in rounds: the centre of a table key is the member that meets most
    texts over all its keys, as a text that others were made from does, and
    every text is compared with the best centre of its keys that is not in
    its own group.  A round costs one comparison a text, however large a
    group is.  What still meets texts of other groups under a key is then entered under
    every two of its keys together, and under those all pairs of different
    groups are compared.  A pair at 0.8 shares two keys with probability
    0.996; texts that only quote one passage hardly ever do.  Sizes that
    differ too much need no comparison, nor do texts whose profiles show that they
    share too little: near copies that were each changed much have shingles
    of their own, and no pairs are made of these.
    """
    entries = nodes.select("node", "size", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    entries = stage(entries.join(shared, "key"), "shared")
    degree = entries.groupBy("node").agg(F.sum("n").alias("degree"))
    entries = stage(entries.drop("n").join(degree, "node"), "entries")
    # the others meet no text and are not sent along again
    found = degree.select("node")
    if proposed is not None:
        proposed = stage(proposed, "proposed")
        found = found.union(proposed.select("a")).union(proposed.select("b")).distinct()
    found = stage(found, "found")
    nodes = stage(sieve(found, F.col("node"))(nodes, F.col("node"), True).join(found, "node", "left_semi"), "meeting")
    sets = stage(sets_of(nodes.select("node")), "sets")
    links = tested = None
    for _ in range(STARS):
        named = _with_roots(entries, links)
        rank = F.struct("degree", (-F.col("node")).alias("back"), "size", "root")
        centres = named.groupBy("key").agg(F.max(rank).alias("c"), F.min("root").alias("r"), F.max("root").alias("s"))
        centres = centres.where("r <> s").select("key", "c")
        met = named.join(centres, "key").where((F.col("root") != F.col("c.root")) & _sizes_allow("size", "c.size"))
        met = met.select((-F.col("c.back")).alias("a"), F.col("node").alias("b"), F.col("c.degree").alias("degree"))
        if tested is not None:
            met = met.join(tested, ["a", "b"], "left_anti")
        best = met.groupBy("b").agg(F.max(F.struct("degree", (-F.col("a")).alias("back"))).alias("c"))
        pairs = best.select((-F.col("c.back")).alias("a"), "b")
        if tested is None and proposed is not None:
            pairs = pairs.union(proposed).distinct()
        pairs = stage(pairs, "pairs")
        found = stage(_alike(pairs, nodes, sets), "stars")
        links = found if links is None else links.union(found)
        tested = pairs if tested is None else tested.union(pairs)
    named = _with_roots(entries, links)
    left = named.join(_several(named, "key"), "key").select("node", "root").distinct()
    left = left.join(nodes.select("node", "size", "keys"), "node")
    two_keys = F.flatten(
        F.transform(F.sequence(F.lit(0), F.lit(BANDS - 2)), lambda i: F.transform(
            F.sequence(i + 1, F.lit(BANDS - 1)), lambda j: F.xxhash64(i, j, F.get("keys", i), F.get("keys", j))
        ))
    )
    both = left.select("node", "size", "root", F.explode(two_keys).alias("both"))
    both = stage(both.join(_several(both, "both"), "both"), "both")
    profiles = stage(_profiles(sets.join(both.select("node").distinct(), "node", "left_semi")), "profiles")
    none = F.array_repeat(F.lit(0), CLASSES)
    both = stage(both.join(profiles, "node", "left").withColumn("profile", F.coalesce("profile", none)), "profiled")
    one = both.select("both", F.col("node").alias("a"), F.col("size").alias("a_size"), F.col("root").alias("a_root"), F.col("profile").alias("a_profile"))
    two = both.select("both", F.col("node").alias("b"), "size", "root", "profile")
    across = one.join(two, "both").where((F.col("a") < F.col("b")) & (F.col("a_root") != F.col("root")))
    across = across.where(_sizes_allow("size", "a_size") & _profiles_allow("profile", "a_profile", "size", "a_size")).select("a", "b").distinct()
    across = stage(across.join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "across")
    return links.union(stage(_alike(across, nodes, sets), "across-links"))


def _sizes_allow(a: str, b: str) -> Column:
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def near_copies(
    docs: DataFrame, id_column: str = "doc_id", links_of: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """(digest, id, copies, node): the group of each distinct id and text, and its number of rows.

    Two texts are linked if their sets of shingles are alike in SIMILARITY or
    more; a group holds all that links lead to, and ``node`` is its number.
    Null, empty and blank texts have the empty set and form one group.  With
    ``links_of``, links (a, b) of fingerprints, texts of linked ones are compared too.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), text_of().alias("text"))
    texts = texts.select("id", digest_of(F.col("text")).alias("digest"), "text")
    found = _sketches(texts).groupBy("digest", "id").agg(
        F.count("*").alias("copies"),
        *(F.first(c).alias(c) for c in ("size", "keys", "marks", "fp")),
    )
    found = stage(found, "sketches")
    nodes = found.groupBy("digest").agg(*(F.first(c).alias(c) for c in ("size", "keys", "marks", "fp")))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    def sets_of(some: DataFrame) -> DataFrame:
        wanted = stage(some.join(nodes, "node").select("node", "digest"), "wanted")
        likely = sieve(wanted, F.col("digest"))(texts.select("digest", "text"), F.col("digest"), True)
        return _sets(likely.dropDuplicates(["digest"]).join(wanted, "digest").select("node", "text"))

    proposed = None if links_of is None else fingerprint_pairs(nodes, links_of)
    roots = stage(components(near_links(nodes.drop("fp"), sets_of, proposed)), "roots")
    named = nodes.select("digest", "node").join(roots, "node", "left")
    named = stage(named.select("digest", F.coalesce("root", "node").alias("node")), "named")
    return found.select("digest", "id", "copies").join(named, "digest")
