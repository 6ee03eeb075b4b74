"""Extraction of main texts and nearest-neighbour search on small tables."""

import math

import numpy as np

from sluice.llm import ann, extraction


def text_of(html, template=frozenset()):
    return extraction.main_text(extraction.tree(html), template)


def test_blocks_and_references():
    html = (
        "<html><head><title>t</title><style>p{}</style></head><body><nav>menu</nav><div class='ad box'>buy</div>"
        "<article><header><h1>A &amp; B</h1></header><p>one <b>two\n three</b><br>four<p>five&nbsp;six</p><script>var t='</p>';</script>"
        "<form>mail</form><ul><li>x<li>y</ul><section id='comments'><p>me too</p></section></article><footer>&copy;</footer></body></html>"
    )
    assert text_of(html) == "A & B\n\none two three four\n\nfive six\n\nx\n\ny"


def test_odd_pages():
    assert text_of("") == "" and text_of("just text") == "just text"
    assert text_of("<p>a<div>b</p></div></i>c") == "a\n\nb\n\nc"
    assert text_of("<article><p>" + "<b>" * 3000 + "deep") == "deep"
    assert text_of("<main><p>m</p><aside>no</aside></main>out") == "m"


def test_site_template(spark):
    rows = []
    for i in range(30):
        menu = "<div><span>home</span><span>about us</span></div>"
        rows.append((i, f"http://Big.example/p{i}", f"<body>{menu}<div><p>text number {i}</p><p>quoted line</p></div></body>", "x"))
    rows += [(100 + i, "https://copy.example/c", "<body><div><p>copied page</p></div></body>", "x") for i in range(40)]
    rows += [(200, None, "<p>no host</p>", "x"), (201, "http://Big.example/q", None, "x"), (5, "http://Big.example/p5", rows[5][2], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(5)
    got = extraction.extracted(pages).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[7].startswith("text number 7") and "home" not in text[7]
    assert text[100] == "copied page" and text[200] == "no host" and text[201] == ""
    # a line that pages of the host quote inside their article stays
    inside = [(i, "http://b/", f"<article><p>n {i}</p><p>quoted line</p></article>", "x") for i in range(30)]
    kept = extraction.extracted(spark.createDataFrame(inside, pages.schema)).collect()
    assert all(r["text"].endswith("\n\nquoted line") for r in kept)
    assert extraction.extracted(pages.limit(0)).collect() == []


def test_search_finds_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16)) * 3
    x = (centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16))).astype(np.float32)
    x[500:900] = x[500]
    rows = [(i, [float(v) for v in row], 0) for i, row in enumerate(x)]
    rows += [(5000, None, 0), (5100, [0.0] * 16, 0), (5200, [float("nan")] * 16, 0), (5300, [1.0] * 3, 0), (5400, [None] + [1.0] * 15, 0)]
    rows += [(5500, [math.inf] + [1.0] * 15, 0), (None, rows[3][1], 0), (600, rows[600][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(4)
    got = ann.search(frame, frame.where("vec_id % 100 = 0"), part_rows=200).collect()
    ids = np.array([*range(3000), 600])
    y = np.concatenate([x, x[600:601]]).astype(np.float64)
    hit = total = 0
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r)
    assert sorted(by) == list(range(0, 3000, 100))
    for q, found in by.items():
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        want = np.lexsort((ids, d))[:10]
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, 11))
        assert all(r["vec_id"] != q for r in found)
        assert all(abs(r["score"] - d[r["vec_id"]]) < 1e-9 for r in found)
        hit += len({r["vec_id"] for r in found} & set(ids[want].tolist()))
        total += len(set(ids[want].tolist()))
        if 500 <= q < 900:
            assert [r["score"] for r in found] == [0.0] * 10
    assert hit / total >= 0.9


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], schema)
    got = ann.search(few, few.where("vec_id = 0")).collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 2), (2, 1)]
    assert ann.search(few.limit(0), few).collect() == []


def test_parts_are_balanced():
    x = np.random.default_rng(2).normal(size=(1000, 8))
    part = ann.balanced_parts(x, ann.neighbour_graph(x, 8), 10)
    sizes = np.bincount(part, minlength=10)
    assert sizes.max() <= 110 and sizes.min() >= 90
