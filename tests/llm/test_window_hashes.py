"""Windows that a hash rolled modulo a power of two cannot tell apart."""

from sluice.llm import substring


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_windows_that_differ_in_one_word_stay_apart(spark):
    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    rest = [f"w{i}" for i in range(19)]
    rows = [(1, " ".join([one, *rest])), (2, " ".join([two, *rest])), (3, " ".join([one, *rest]))]
    got = substring.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (2, 0), (3, 20)]
    h, g = substring.window_hashes([w.encode() for w in rows[0][1].split()] * 2)
    assert len(h) == len(g) == 21 and h[0] == h[20] and g[0] == g[20] and len(set(h.tolist())) == 20
