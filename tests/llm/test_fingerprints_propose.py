"""The stage of near copies takes what SimHash fingerprints propose; the exact similarity decides."""

import random

from pyspark.sql import functions as F

from sluice.llm import near_copies, simhash


def prose(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_links_of_fingerprints_are_compared_without_a_common_key(spark):
    rng = random.Random(3)
    long = prose(rng, 900)
    texts = [" ".join(long), " ".join([*long[:-1], "other"]), " ".join(long).upper(), " ".join(prose(rng, 900))]
    hashes = [near_copies.hashes_of(t, near_copies.SHINGLE) for t in texts]
    fps = [near_copies.majority(h) for h in hashes]
    assert fps[0] == fps[2] and bin(fps[0] ^ fps[1]).count("1") <= simhash.RADIUS < bin(fps[0] ^ fps[3]).count("1")
    sets = [sorted(int(x) - (1 << 64 if x >> 63 else 0) for x in set(map(int, h))) for h in hashes]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame(
        # no table key is shared, as where least hashes miss a pair
        [(i, len(s), [100 * i + k for k in range(near_copies.BANDS)], near_copies._marks(near_copies._least(near_copies.shingles(t))), f)
         for i, (t, s, f) in enumerate(zip(texts, sets, signed))],
        "node long, size int, keys array<long>, marks binary, fp long",
    )
    all_sets = spark.createDataFrame(list(enumerate(sets)), "node long, hashes array<long>")
    pairs = near_copies.fingerprint_pairs(nodes, simhash.fingerprint_links)
    links = near_copies.near_links(nodes.drop("fp"), lambda some: all_sets.join(some, "node"), pairs)
    assert sorted(map(tuple, links.collect())) == [(0, 1), (0, 2)]
    # texts of linked fingerprints that are not alike stay apart
    apart = spark.createDataFrame([(0, 3)], "a long, b long")
    assert near_copies.near_links(nodes.drop("fp"), lambda some: all_sets.join(some, "node"), apart).collect() == []


def test_stage_links_fingerprints(spark, monkeypatch):
    asked = []

    def links(fps, *rest, found=simhash.fingerprint_links):
        asked.append(fps.count())
        return found(fps, *rest)

    monkeypatch.setattr(simhash, "fingerprint_links", links)
    rng = random.Random(4)
    one, two = " ".join(prose(rng, 60)), " ".join(prose(rng, 60))
    docs = spark.createDataFrame([(1, one), (2, one.upper()), (3, two), (4, None)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == [1, 3, 4]
    assert asked == [3]
