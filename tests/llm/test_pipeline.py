"""The pipeline: each stage on small documents, and the whole on the smallest table."""

from pathlib import Path

import pytest

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_decisions_take_effect(spark):
    text = " ".join(f"word{i} of the sample" for i in range(60))
    rows = [
        (1, text, "en", "a", len(text)), (2, text + " more", "en", "a", 0), (3, "too short", "en", "a", 9), (4, None, None, None, None),
        (5, " ".join(f"other{i} line" for i in range(80)) + " token = \"deadbeefdeadbeefdeadbeef\"", "en", "b", 0),
    ]
    docs = spark.createDataFrame(rows, COLUMNS)
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["quality_rules"](spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5]
    single = steps["simhash_near_dedup"](spark, kept, "")
    assert sorted(r["doc_id"] for r in single.collect()) in ([1, 5], [1, 2, 5])
    clean = steps["secret_scans"](spark, single, "")
    five = {r["doc_id"]: r for r in clean.collect()}[5]
    assert "deadbeef" not in five["text"] and five["n_chars"] == len(five["text"])
    mixed = steps["mixing_to_weights"](spark, clean, "")
    for frame in (kept, single, clean, mixed):
        assert frame.columns == docs.columns
    packed = steps["best_fit_packing"](spark, mixed, "")
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_documents(spark, name):
    docs = spark.createDataFrame([], COLUMNS)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, "").collect() == []


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="supplied tables are not here")
def test_whole_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert got and {r["piece"] for r in got} >= {0}
