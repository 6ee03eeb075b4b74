"""Redaction of many and of overlapping spans, any column names, and links by segment tables."""

import random
import time

import pytest

from sluice.llm import secret_scan, simhash

CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
FLAT = [0.0] * len(secret_scan.ALPHABET) ** 2


def plain(text, spans, filler="[SECRET]"):
    merged = []
    for a, b in sorted(spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    out, at = [], 0
    for a, b in merged:
        out += [text[at:a], filler]
        at = b
    return "".join(out) + text[at:]


def test_redaction_equals_plain_code(spark):
    rng = random.Random(8)
    texts = []
    for n in (1, 3, 40, 300):
        parts = []
        for _ in range(n):
            parts.append(rng.choice([
                "é🙂 words\n" * rng.randint(0, 90), "token: " + "k" * rng.randint(11, 30) + " ",
                "deadbeef" * rng.randint(1, 900), "secret=0123456789abcdef0123", "AKIA" + "Q" * 16 + "\u0000 ",
            ]))
        texts.append("".join(parts))
    texts += ["", None, "a" * 4096 + " 0123456789abcdef", "0123456789abcdef" + "\r\n" * 4096]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {
        r["doc_id"]: [(s["start"], s["end"]) for k in (*secret_scan.KINDS, "markov") for s in r[f"_s_{k}"]]
        for r in secret_scan.scan(docs, FLAT).collect()
    }
    got = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs, FLAT).collect()}
    assert got == {i: plain(t, spans[i]) if t else t for i, t in enumerate(texts)}
    assert sum(map(len, spans.values())) > 100


def test_many_secrets_in_one_text_take_time_in_proportion(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, "token: abcdefghijklmnop é " * n)], "doc_id long, text string")
        start = time.time()
        row = secret_scan.redacted(docs, FLAT).first()
        assert row["text"] == "[SECRET] é " * n
        return time.time() - start

    seconds(10)
    assert seconds(16000) < 60


def test_any_column_names(spark):
    docs = spark.createDataFrame(
        [(1, "see 0123456789abcdef", "x", "y", "z", 3)],
        "doc_id long, text string, `a.b` string, _s_hex string, `_S_all` string, n_chars int",
    )
    row = secret_scan.redacted(docs, FLAT).first()
    assert tuple(row) == (1, "see [SECRET]", "x", "y", "z", 12)
    assert secret_scan.redacted(docs, FLAT).columns == docs.columns


def test_letters_only_and_touching_candidates(spark):
    rng = random.Random(4)
    key = lambda n: "".join(rng.choices(CHARS, k=n))
    parts = ["get", "value", "from", "index", "parser", "total", "count", "render", "page", "config", "load", "user"]
    name = lambda k: "_".join(rng.choices(parts, k=k))
    rows = [(i, f"token = {key(32)} and {name(4)} with {name(4)}") for i in range(300)]
    train = spark.createDataFrame(rows, "doc_id long, text string")
    model = secret_scan.train(secret_scan.samples(train))
    held = [(i, f"see {key(40)} here") for i in range(60)] + [(100 + i, f"see {name(6)} here") for i in range(60)]
    long_key = f"{key(30)}0123456789abcdef{key(30)}"
    held += [(200, f"a {long_key} b"), (201, "a 0123456789abcdef01234567 b"), (202, f"token={key(30)}")]
    docs = spark.createDataFrame(held, "doc_id long, text string")
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["_s_markov"]] for r in secret_scan.scan(docs, model).collect()}
    assert sum(found[i] == [(4, 44)] for i in range(60)) >= 57
    assert not any(found[100 + i] for i in range(60))
    assert found[200] == [(2, 2 + len(long_key))] and found[201] == found[202] == []
    texts = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs, model).collect()}
    assert texts[200] == "a [SECRET] b" and texts[202] == "[SECRET]"


def classes(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("crowd", [0, 2, 32, 10**6])
def test_links_join_what_brute_force_joins(spark, crowd):
    rng = random.Random(crowd)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    fps = {0, (1 << 64) - 1, 1 << 63, 1 << 31, 1 << 32}
    for _ in range(12):
        seed = rng.getrandbits(64)
        fps.add(seed)
        # one half alike in many, the other anything
        fps |= {(seed & ~0xFFFFFFFF) | rng.getrandbits(32) for _ in range(20)}
        for _ in range(25):
            x = rng.choice([seed, rng.choice(sorted(fps))])
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    nodes = sorted(fps)
    near = [(a, b) for i, a in enumerate(nodes) for b in nodes[i + 1 :] if (a ^ b).bit_count() <= 2]
    frame = spark.createDataFrame([(signed(x),) for x in nodes], "fp long")
    found = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.fingerprint_links(frame, crowd).collect()]
    assert set(map(frozenset, found)) <= set(map(frozenset, near))
    assert classes(found, nodes) == classes(near, nodes)
