"""Text that recurs on pages of a host stays; what a site puts around it goes."""

from sluice.llm import extraction

PAGES = "page_id long, url string, html string"
LINKS = "<ul><li><a href='/a'>one page</a></li><li><a href='/b'>other page</a></li></ul>"


def texts(spark, rows):
    frame = spark.createDataFrame([(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(rows)], PAGES)
    return {r["page_id"]: r["text"] for r in extraction.extracted(frame).collect()}


def test_recurring_text_stays(spark):
    near = [("near", f"<article><h1>title {i}</h1><div>the body of all copies</div>{LINKS}</article>") for i in range(6)]
    bare = [("bare", f"<body><h1>title {i}</h1><div>the body of all these copies without an article</div></body>") for i in range(6)]
    quote = "<div>a passage that few pages quote</div>"
    foot = "<div>all rights are reserved</div>"
    some = [("some", f"<body><p>text of page {i} {'word ' * 20}</p>{quote if i < 8 else ''}{foot}</body>") for i in range(60)]
    lists = [("lists", f"<main><p>number {i}</p><ul><li>first of the steps</li></ul></main>") for i in range(6)]
    teaser = [("news", f"<body><div><p>lead of the story</p></div><article><p>page {i}</p></article></body>") for i in range(6)]
    teaser += [("news", "<article><p>lead of the story</p><p>rest</p></article>")]
    got = list(texts(spark, near + bare + some + lists + teaser).values())
    a, b, c, d = got[:6], got[6:12], got[12:72], got[72:78]
    assert a == [f"title {i}\n\nthe body of all copies" for i in range(6)]
    assert all(t.endswith("copies without an article") for t in b)
    assert all(("few pages quote" in t) == (i < 8) and "reserved" not in t for i, t in enumerate(c))
    assert all(t.endswith("first of the steps") for t in d)
    assert got[84] == "lead of the story\n\nrest"
