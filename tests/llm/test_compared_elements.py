"""Only the elements that are compared with a template are hashed, and texts stay those of pages hashed whole."""

import itertools

from sluice.llm import extraction

LINKS = "<ul><li><a href='/x'>one link</a></li><li><a href='/y'>other link</a></li></ul>"
SAYS = "<div><p>Words that a site says on every page.</p></div>"
PARTS = [
    "<p>Plain words of an article.</p>",
    LINKS,
    f"<section><p>Some words here.</p>{LINKS}</section>",
    SAYS,
    "<main><p>Nested main words.</p>" + LINKS + "</main>",
    "<div><div></div></div>",
]
AROUND = ["<body>{}</body>", "<body><nav>x</nav><article>{}</article></body>", "<main>{}</main>", "<main><p>a b</p><article>{}</article><article>{}</article></main>"]


def pages():
    for around in AROUND:
        for n in (1, 2, 3):
            for parts in itertools.permutations(PARTS, n):
                yield around.replace("{}", "".join(parts))


def marks_in(html):
    root = extraction.tree(html)
    extraction.set_marks(root)
    return [n.mark for n in extraction._order(root)]


def test_texts_are_those_of_pages_hashed_whole():
    of_links, of_says, empty = (set(marks_in(x)[1:]) for x in (LINKS, SAYS, "<div><div></div></div>"))
    templates = [of_links, of_links | of_says | empty, of_links | {extraction.INNER + m for m in of_says}]
    changed = 0
    for html, template in itertools.product(pages(), map(frozenset, templates)):
        whole, root = extraction.tree(html), extraction.tree(html)
        extraction.set_marks(whole)
        extraction.set_words(whole)
        extraction.set_compared(root, template)
        text = extraction.main_text(root, template)
        assert text == extraction.main_text(whole, template), html
        changed += text != extraction.main_text(whole, frozenset())
    assert changed


def test_articles_without_link_lists_are_not_hashed(monkeypatch):
    monkeypatch.setattr(extraction, "set_marks", lambda root: (_ for _ in ()).throw(AssertionError("hashed")))
    root = extraction.tree("<nav>" + LINKS + "</nav><article><h1>Head words</h1><div><p>Some text.</p></div><p>More text.</p></article>")
    template = frozenset([b"12345678"])
    extraction.set_compared(root, template)
    assert extraction.main_text(root, template) == "Head words\n\nSome text.\n\nMore text."
