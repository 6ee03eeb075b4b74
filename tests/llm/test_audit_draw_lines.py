"""Divergence audit, importance resampling and line removal against plain Python on small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from sluice.llm import divergence, importance, line_dedup

#: names that the operators use themselves, as other columns of the table
DOCS = "doc_id long, text string, lang string, source string, n string, idx string, bucket string, `a.b` string, hi string"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", "w", "v") for r in rows], DOCS)


def sample(seed=5, size=150):
    rng = random.Random(seed)
    words = [f"Word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["naïve", "ÉTÉ", "日本", "x1y2", "don't"]
    lines = [" ".join(rng.choices(words, k=6)) for _ in range(25)]
    rows = []
    for i in range(size):
        parts = [rng.choice(lines) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(rng.randint(0, 8))]
        rows.append((i, "\n".join(parts), rng.choice(["en", "en", "de"]), rng.choice("abcd")))
    rows += [(None, None, None, None), (None, lines[0], "en", None), (7, lines[1] + "\n" + lines[1], "en", "a"), rows[3], rows[3]]
    rows += [(1000, "", "en", "only empty"), (1001, " \t\r\n", "xx", "alone"), (1002, (lines[2] + "\n") * 3000, "de", "b")]
    rows += [(1003, "\t" + lines[3].upper() + " \r\n" + lines[3] + "\x0b", "de", "b"), (1004, "ä" * 19 + "\n" + "ä" * 20, "de", "b")]
    rows += [(1005 + i, "ä" * 19 + "\n" + "Ä" * 20 + "\n" + "ä" * 20, "de", "c") for i in range(3)]
    return rows


def drops(rows):
    held = defaultdict(set)
    ids = [-(1 << 63) if r[0] is None else r[0] for r in rows]

    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))

    for doc, r in zip(ids, rows):
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(doc)
    out = []
    for doc, r in zip(ids, rows):
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < 3 or max(held[key(x)]) == doc]
        out.append((str(r[0]), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


@pytest.mark.parametrize("keys,lines", [(1 << 18, 1 << 20), (4, 50)])
def test_lines_go_but_for_the_largest_id(spark, monkeypatch, keys, lines):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", keys)
    monkeypatch.setattr(line_dedup, "PROBE_LINES", lines)
    rows = sample()
    got = line_dedup.deduplicated(docs_of(spark, rows)).collect()
    want = drops(rows)
    assert sorted((str(r["doc_id"]), r["n_lines"], r["n_dropped"], r["kept"]) for r in got) == want
    assert sum(w[2] for w in want) > 100


def test_lines_of_empty_tables_and_of_few_documents(spark):
    assert line_dedup.deduplicated(docs_of(spark, [])).collect() == []
    rows = [(1, "a line that is long enough", "en", "a"), (2, "a line that is long enough", "en", "a"), (2, "a line that is long enough", "en", "b")]
    got = line_dedup.deduplicated(docs_of(spark, rows))
    assert [(r["n_lines"], r["n_dropped"]) for r in got.collect()] == [(1, 0)] * 3


def test_perfect_hash_numbers_its_keys_and_shards_tell_others_apart():
    rng = np.random.default_rng(3)
    hi, lo = rng.integers(0, 1 << 64, (2, 50_000), dtype=np.uint64)
    hi[:40_000:2] = hi[0]  # equal first halves
    found = line_dedup.PerfectHash.of(hi, lo).numbers(hi, lo)
    assert sorted(found.tolist()) == list(range(50_000))
    counts, last = rng.integers(1, 9, 50_000), rng.integers(0, 1 << 40, 50_000)
    shard = line_dedup.Shard(line_dedup.packed(hi, lo, counts, last))
    got = shard.probe(hi, lo)
    assert (got[0] == counts).all() and (got[1] == last).all()
    assert not shard.probe(hi, lo + np.uint64(1))[0].any()
    none = line_dedup.Shard(line_dedup.packed(hi[:0], lo[:0], counts[:0], last[:0]))
    assert not none.probe(hi[:3], lo[:3])[0].any()


def audited(rows):
    groups, counts, held = set(), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups.add((lang, source))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in held[lang].items() if n >= divergence.MIN_DOCS]
        mine = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in mine:
            whole.update(counts[lang, s])

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in mine}, shares(whole)
        for s in mine:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in mine if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", i.decode(), -v, n) for n, (v, i) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", i.decode(), -v, n) for n, (v, i) in enumerate(sorted(terms)[:50], 1)]
    return sorted(out)


@pytest.mark.parametrize("postings,rows_of,held", [(200_000, 256, 400_000), (20, 2, 30)])
def test_audit_is_that_of_all_pairs(spark, monkeypatch, postings, rows_of, held):
    monkeypatch.setattr(divergence, "POSTINGS", postings)
    monkeypatch.setattr(divergence, "ROWS", rows_of)
    monkeypatch.setattr(divergence, "HELD", held)
    rows = sample(size=250)
    got = sorted(tuple(r) for r in divergence.audit(docs_of(spark, rows)).collect())
    want = audited(rows)
    assert got == want
    assert {r[2] for r in want} == {"pair", "term"} and len(want) > 100


def test_audit_without_rows_or_kept_terms(spark):
    assert divergence.audit(docs_of(spark, [])).collect() == []
    got = divergence.audit(docs_of(spark, [(1, "few terms", "en", "a"), (2, None, "en", "b")])).collect()
    assert sorted(tuple(r) for r in got) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_pieces_split_between_words_only():
    text = ("Ab cd1é " * 50 + "x" * 100 + " Z").encode()
    whole = [w for p in divergence.term_pieces(text) for w in p]
    assert [w for p in divergence.term_pieces(text, 7) for w in p] == whole
    one = np.concatenate([f for _, f in importance.features(text)])
    cut = list(importance.features(text, piece=5))
    assert Counter(np.concatenate([f for _, f in cut]).tolist()) == Counter(one.tolist())
    assert sum(n for n, _ in cut) == len(importance.features(text).__next__()[1]) // 3 + 1


def features(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % 10_000 for r in runs]


def drawn(rows, target):
    docs = [(r[0], *features(r[1])) for r in rows]
    s, t = Counter(b for d in docs for b in d[2]), Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc, n_words, found in docs:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, len(found), weight, score, n_words))
    able = sorted((o for o in out if o[4] >= 20), key=lambda o: (-o[3], o[0] is None, o[0] or 0))
    first = able[: 5 * len(able) // 100]
    rest = able[len(first) :] + [o for o in out if o[4] < 20]
    return sorted([(str(o[0]), *o[1:4], str(i)) for i, o in enumerate(first, 1)] + [(str(o[0]), *o[1:4], "None") for o in rest])


def test_draw_is_that_of_all_scores(spark):
    rows = sample(size=300)
    target = ["Wordaa wordba naïve Wordca " * 5, None, "日本 x1y2"]
    names = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, bucket string")
    got = importance.resampled(docs_of(spark, rows), names, with_text=True).collect()
    columns = ("doc_id", "n_features", "weight", "score", "rank")
    want = drawn(rows, target)
    assert sorted((str(r["doc_id"]), *(r[c] for c in columns[1:4]), str(r["rank"])) for r in got) == want
    assert sorted(r["text"] or "" for r in got) == sorted(r[1] or "" for r in rows)
    assert sum(w[4] != "None" for w in want) > 5


def test_draw_without_target_or_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = [(i, "the same text of six words " * 5, "en", "a") for i in range(40)]
    got = importance.resampled(docs_of(spark, rows), none).collect()
    assert sorted((str(r[0]), *r[1:4], str(r[4])) for r in got) == drawn(rows, [])
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2]
    assert importance.resampled(docs_of(spark, []), none).collect() == []
