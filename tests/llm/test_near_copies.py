"""Near copies by five-word shingles against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import near_copies, simhash
from sluice.llm.common import sieve
from sluice.session import stage

DOCS = "doc_id long, text string, source string"


def grams(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    x, y = grams(a), grams(b)
    return len(x & y) >= 0.8 * len(x | y)


def changed(rng, text, n):
    words = text.split()
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.random()}"
    return " ".join(words)


def groups(rows):
    """The positions of the rows of each group."""
    root = list(range(len(rows)))
    more = True
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if alike(rows[i][1], rows[j][1])]
    while more:
        more = False
        for i, j in pairs:
            if root[i] != root[j]:
                root[i] = root[j] = min(root[i], root[j])
                more = True
    found = {}
    for i, r in enumerate(root):
        found.setdefault(r, []).append(i)
    return list(found.values())


def sample(rng):
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 300))) for _ in range(12)]
    texts = list(base)
    for text in base:
        texts += [changed(rng, text, n) for n in (1, 1, 2, 3, 5, 9)]
    common = base[0]
    texts += [common + " " + " ".join(f"u{k}x{i}" for i in range(200)) for k in range(6)]
    return texts


def test_near_copies_are_grouped(spark):
    rng = random.Random(5)
    rows = [(i, t, "a") for i, t in enumerate(sample(rng))]
    want = sorted(sorted(rows[i][0] for i in g) for g in groups(rows))
    found = {}
    for r in near_copies.near_copies(spark.createDataFrame(rows, DOCS).repartition(3)).collect():
        found.setdefault(r["node"], []).append(r["id"])
    assert sorted(map(sorted, found.values())) == want
    assert sorted(r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()) == sorted(g[0] for g in want)


def test_groups_whose_first_member_is_like_few(spark):
    # copies of one text that are alike with it and not with each other; the one with many links comes late
    rng = random.Random(8)
    base = " ".join(f"b{i}" for i in range(400))
    rows = [(i, changed(rng, base, 8), "a") for i in range(30)] + [(99, base, "a")]
    assert [len(g) for g in groups(rows)] == [31]
    assert [r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, DOCS)).collect()] == [0]


def test_stage_drops_a_copy_with_one_word_more(spark):
    text = " ".join(f"word{i} of the sample" for i in range(60))
    docs = spark.createDataFrame([(1, text, "a"), (2, text + " more", "a"), (3, changed(random.Random(1), text, 2), "a")], DOCS)
    step = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    assert [r["doc_id"] for r in step(spark, docs, "").collect()] == [1]


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 5000])
def test_shingles_and_keys(n):
    text = " ".join(f"k{i}" for i in range(n))
    assert len(near_copies.shingles(text)) == len(grams(text))
    assert near_copies.keys_of(near_copies.shingles(text)) == near_copies.keys_of(near_copies.shingles(f" {text.upper()}\n"))


def test_one_row_of_each_group_stays(spark):
    def text(word):
        return " ".join(f"{word}{i}" for i in range(100))

    rows = [
        (1, text("a"), "s"),
        (5, text("a"), "t"), (5, text("b"), "s"),  # a reused id: one text is a copy, the other is not
        (7, text("c"), "s"), (7, text("c"), "s"), (8, text("c"), "s"),  # repeated rows
        (None, text("d"), "s"), (None, text("d"), "s"),  # copies without an id
        (None, text("a"), "s"), (None, text("e"), "s"),
        (9, text("f"), "s"), (9, text("f") + " more", "s"),  # near copies of one id
        (11, None, "s"), (12, " ", "s"),
    ]
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS).repartition(3))
    got = sorted((str(r["doc_id"]), (r["text"] or "-").split(" ")[0]) for r in kept.collect())
    assert got == sorted([("1", "a0"), ("5", "b0"), ("7", "c0"), ("None", "d0"), ("None", "e0"), ("9", "f0"), ("11", "-")])
    assert kept.columns == ["doc_id", "text", "source"]


def test_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(100))
    schema = "doc_id long, text string, _id string, `_DIGEST` string, `a.b` string, node long, taken string, id long"
    docs = spark.createDataFrame([(i, text, "x", "y", "z", i, "t", i) for i in (3, 2)] + [(9, "other", "p", "q", "r", 1, "u", 2)], schema)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(2, text, "x", "y", "z", 2, "t", 2), (9, "other", "p", "q", "r", 1, "u", 2)]


def test_texts_that_quote_one_passage_are_not_all_compared(spark):
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"u{i}x{k}" for k in range(60)), "a") for i in range(60)]
    rows += [(100 + i, changed(rng, rows[i][1], 1), "a") for i in range(5)]
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(60))


def test_both_choices_of_rows_read_one_shuffle_of_the_texts(spark):
    rows = [(i, " ".join(f"w{i // 2}x{k}" for k in range(40)), "a") for i in range(6)]
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # the same filter on both sides, or the shuffles below the joins differ and none is used again
    assert sum("Filter" in line and "isnotnull(unhex(md5" in line for line in plan.splitlines()) == 2


def test_rows_that_meet_no_mark_are_parted_from_those_that_may(spark):
    rows = spark.range(20_000).selectExpr("if(id = 7, null, id) AS k", "cast(id AS string) AS text")
    part = sieve(rows.where("k % 1000 = 3 OR k IS NULL"), F.col("k"))
    may, free = part(rows, F.col("k"), True), part(rows, F.col("k"), False)
    assert may.columns == free.columns == rows.columns
    assert may.where("k % 1000 = 3").count() == 20 and may.where("k IS NULL").count() == 1
    assert may.count() < 500 and may.count() + free.count() == 20_000 and may.join(free, "text").count() == 0
    none = sieve(rows.limit(0), F.col("k"))
    assert none(rows, F.col("k"), True).count() == 0 and none(rows, F.col("k"), False).count() == 20_000


def test_texts_without_a_mark_are_not_shuffled(spark):
    rows = [(i, " ".join(f"w{max(i, 2)}x{k}" for k in range(40)), "a") for i in range(300)]
    kept = simhash.keep_one(spark.createDataFrame(rows, DOCS))
    plan = kept._jdf.queryExecution().optimizedPlan()
    # the first part of the result is a join with the broadcast bits alone
    parts = [str(plan.children().apply(i).toString()) for i in range(plan.children().size())]
    assert plan.nodeName() == "Union" and [p.count("Join LeftAnti") + p.count("Join LeftSemi") for p in parts] == [0, 1, 1]
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, *range(3, 300)]


def test_no_pairs_are_made_of_copies_that_share_too_little(spark, monkeypatch):
    rng = random.Random(12)
    base = " ".join(f"z{i}" for i in range(150))
    rows = [(i, changed(rng, base, 4), "a") for i in range(30)]
    rows.append((50, changed(rng, rows[3][1], 1), "a"))
    want = sorted(g[0] for g in groups(rows))
    made = []

    def counted(df, name):
        done = stage(df, name)
        if name == "across":
            made.append(done.count())
        return done

    monkeypatch.setattr(near_copies, "stage", counted)
    docs = spark.createDataFrame(rows, DOCS)
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == want
    monkeypatch.setattr(near_copies, "_profiles_allow", lambda *_: F.lit(True))
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == want
    few, all_pairs = made
    assert all_pairs > 100 and few < all_pairs / 5
