"""What a site repeats inside its articles goes by counts alone; quoted text and copies stay."""

import random
import zlib
from collections import defaultdict

from sluice.llm import extraction
from sluice.llm.extraction import INNER, WORD, main_text, page_sketch, set_marks, set_words, text_blocks, tree

PAGES = "page_id long, url string, html string"
#: no tag, class or id of it tells what it is
NOTICE = "<div><p>Our team reads every letter you send</p><p>Write to the office by post</p></div>"
LINE = "<p>Printed in the town of our founders</p>"


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))


def site(rng, host, n, extra=lambda i: ""):
    return [
        (host, f"<html><body><article><h1>{words(rng, 3)}</h1><p>{words(rng, 40)}</p>{extra(i)}{NOTICE}<p>{words(rng, 20)}</p>{LINE}</article></body></html>")
        for i in range(n)
    ]


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://{h}/{i}", html) for i, (h, html) in enumerate(rows)], PAGES).repartition(5)


def by_hand(rows, min_pages=5):
    """Templates inside main parts by plain counting."""
    has, seen = defaultdict(set), defaultdict(set)
    for host, html in rows:
        root = tree(html)
        set_marks(root)
        set_words(root)
        found = WORD.findall(main_text(root, frozenset()).lower())
        seen[host].add(page_sketch(found))
        for node in text_blocks(root, len(found)):
            has[node.mark, host].add(page_sketch(found))
    often = {k for k, p in has.items() if len(p) >= min_pages and 2 * len(p) >= len(seen[k[1]])}
    hosts = defaultdict(lambda: [0, 0])
    for mark, host in has:
        hosts[mark][0] += 1
        hosts[mark][1] += (mark, host) in often
    return {(host, INNER + mark) for mark, host in often if 2 * hosts[mark][1] >= hosts[mark][0]}


def test_blocks_of_a_site(spark):
    rng = random.Random(5)
    quote = f"<div><p>{words(rng, 12)}</p></div>"
    rows = site(rng, "one", 20, lambda i: quote if i < 6 else "")
    # nearly all pages of a host quote it, but it is on most others now and then
    rows += site(rng, "two", 12, lambda i: quote)
    for k in range(4):
        rows += [(f"h{k}", f"<article><p>{words(rng, 30)}</p>{quote if i == 0 else ''}</article>") for i in range(8)]
    # copies of one page with a word changed, and small pages that are mostly repeated
    body = [f"<p>{words(rng, 30)}</p>" for _ in range(6)]
    rows += [("copies", f"<article><h1>{words(rng, 2)}</h1>{''.join(body)}<p>{words(rng, 2)}</p></article>") for _ in range(30)]
    rows += [("small", f"<article><p>{words(rng, 4)}</p>{NOTICE}{LINE}</article>") for _ in range(9)]
    # too few pages
    rows += site(rng, "few", 4)
    frame = pages(spark, rows)
    found = {(r["host"], bytes(r["mark"])) for r in extraction.templates(frame).collect() if len(r["mark"]) == 9}
    assert found == by_hand(rows)
    text = {r["page_id"]: r["text"] for r in extraction.extracted(frame).collect()}
    plain = extraction.main_text
    for i, (host, html) in enumerate(rows):
        whole = plain(tree(html), frozenset())
        if host in ("one", "two"):
            assert "Our team" not in text[i] and "Write to" not in text[i] and "Printed" not in text[i]
            left = [b for b in whole.split("\n\n") if not b.startswith(("Our team", "Write to", "Printed"))]
            assert text[i].split("\n\n") == left
        else:
            assert text[i] == whole
    assert extraction.templates(frame.limit(0)).collect() == []


def test_rest_of_site_stays_cut(spark):
    """Copies, nulls and pages without an address beside a site."""
    rng = random.Random(6)
    rows = site(rng, "one", 10) * 2
    frame = pages(spark, rows).unionByName(spark.createDataFrame([(900, None, None), (901, None, rows[0][1]), (902, "http://one/", "")], PAGES))
    text = {r["page_id"]: r["text"] for r in extraction.extracted(frame).collect()}
    assert len(text) == 23 and text[900] == text[902] == ""
    # an address without a host is one host with one page here
    assert "Our team" in text[901] and all("Our team" not in text[i] for i in range(20))


def test_attributes_are_looked_at_once_for_each_element(monkeypatch):
    looked = []
    hidden = extraction._hidden
    monkeypatch.setattr(extraction, "_hidden", lambda node: looked.append(node.tag) or hidden(node))
    root = extraction.tree('<body><main><div class="x"><p>two words</p></div><section class="promo">more words</section></main></body>')
    extraction.set_marks(root)
    extraction.set_words(root)
    extraction.candidates(root)
    assert extraction.main_text(root, frozenset()) == "two words"
    extraction.text_blocks(root, 2)
    assert sorted(looked) == ["div", "section"]


def test_sketch_is_the_least_hash_of_three_words():
    for n in (0, 1, 2, 3, 4, 50):
        words = [f"wört{'abc'[i % 3]}{chr(97 + i % 26)}" for i in range(n)]
        runs = [" ".join(words[i : i + 3]) for i in range(max(1, n - 2))]
        assert extraction.page_sketch(words) == min(zlib.crc32(r.encode()) for r in runs).to_bytes(4, "big")
