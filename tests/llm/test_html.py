"""Main text of pages of several makes."""

import re
from html import unescape

import pytest

from reelmetrics.llm.html_text import blocks, extract_text, main_text, tree

SMALL = "/root/testdata/sf0.01"
TREE = tree()
# What the blocks' densities alone reach.
RECALL, PRECISION = 0.9, 0.5
LONG = "The harbour was quiet when the boats came home, and nobody on the quay had expected them so early in the year, least of all the old men. "

PAGES = {
    "plain article": (
        "<nav><a href=/a>Home</a> <a href=/b>News</a></nav><article><h1>A &amp; B</h1><p>One.</p><p>  Two\n three&nbsp;four </p></article><footer>Imprint</footer>",
        "A & B\nOne.\nTwo three four",
    ),
    "comments and notices": (
        f"<div class='cookie-banner'><p>{LONG}</p></div><main><h2>Boats</h2><p>{LONG}</p><div id=comments><p>{LONG}</p></div>"
        f"<form><label>Mail</label><button>Send</button></form></main><aside><p>{LONG}</p></aside>",
        f"Boats\n{LONG.strip()}",
    ),
    "no telling elements": (
        f"<div><a href=1>One</a> | <a href=2>Two</a></div><div><b>Harbour news</b></div><div>{LONG}</div><div>{LONG}{LONG}</div><div>ok</div><div>{LONG}</div><div><a href=3>Next</a></div>",
        f"Harbour news\n{LONG.strip()}\n{LONG}{LONG.strip()}\nok\n{LONG.strip()}",
    ),
    "broken markup": (
        "<article><p>a <b>b<p>c < d <i>e</b> f<br>g</article><script>var x='</p><p>no';</script><div class=ad>" + LONG,
        "a b\nc < d e f\ng",
    ),
    "comments in markup": ("<article><!-- <p>no</p> --><p>yes</p><style>p{}</style><!--[if x]>no<![endif]--><p title='a>b'>more</p><!-- open <p>no</article>", "yes\nmore"),
    "hidden": ("<article><p hidden>no</p><div style='display: none'><p>no</p></div><p>yes</p></article>", None),
    "text alone": (LONG, LONG.strip()),
    "nothing": ("", ""),
    "only tags": ("<div><p></p><br></div>", ""),
    "links at the end": ("<article><p>yes yes</p><ul><li><a href=1>Other story here</a></li><li><a href=2>One more story</a></li></ul></article>", "yes yes"),
}


BODY = f"<h1>Boats</h1><p>{LONG}</p><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
ARTICLE = f"Boats\n{LONG.strip()}\n{LONG.strip()}\nShort.\n{LONG.strip()}"
NAV = "<nav><a href=/a>Home</a> <a href=/b>News</a></nav>"
ASIDE = f"<aside><p>{LONG}</p></aside><footer>Imprint</footer>"

# Containers whose names or tags speak of side matter and that hold the article.
CONTAINERS = {
    "body": f"<body class='page has-sidebar'>{NAV}<article>{BODY}</article>{ASIDE}",
    "form": f"<body><form action=x>{NAV}<article>{BODY}</article><input name=q></form>{ASIDE}",
    "form without a mark": f"<form>{NAV}<div>{BODY}</div></form>{ASIDE}",
    "header": f"<div class='with-header'>{NAV}<main>{BODY}</main></div>{ASIDE}",
    "widget area": f"<div id='page' class='widget-area'>{NAV}<div class='post'>{BODY}</div></div>{ASIDE}",
    "nested": f"<body class=widget><form><div class=social><section class=banner><article>{BODY}</article></section></div></form>{ASIDE}",
    "name alone": f"<div class='tags'>{NAV}<div>{BODY}</div></div>{ASIDE}",
    "comments as articles": f"<div class=topbar>{NAV}<div class=post>{BODY}</div></div><div id=comments><article>{BODY}{BODY}{BODY}</article></div>{ASIDE}",
    "teasers as articles": f"{NAV}<article>{BODY}</article><div class=promo><article><p>{LONG}</p></article></div>{ASIDE}",
    "long comments": f"<div>{BODY}</div><div class=comments>{BODY}{BODY}</div>{ASIDE}",
}


@pytest.mark.parametrize("name", CONTAINERS)
def test_containers_that_hold_the_article(name):
    assert main_text(CONTAINERS[name], TREE) == ARTICLE


def test_the_tree_cuts_on_its_neighbours():
    def cuts(node):
        return [] if node.left is None else [node.feature, *cuts(node.left), *cuts(node.right)]

    assert {3, 5} & set(cuts(TREE))
    linked = f"<div><a href=1>{LONG}</a></div>"
    line = "<div>Ten plain words that stand between blocks full of links</div>"
    assert main_text(linked * 3 + line + linked * 3, TREE) == ""
    assert line[5:-6] in main_text(f"<div>{LONG}</div>" + line + f"<div>{LONG}</div>", TREE)


def test_pages_without_names_and_marks(spark):
    """By densities alone: all class names, ids and telling elements are taken from the pages."""
    hit = said = wanted = 0
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        bare = re.sub(r"""\s(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "", r.html)
        bare = re.sub(r"(</?)(?:article|main|nav|aside|header|footer|form|section)\b", r"\1div", bare)
        got, want = set(main_text(bare, TREE).split("\n")), set(main_text(r.html, TREE).split("\n"))
        hit, said, wanted = hit + len(got & want), said + len(got), wanted + len(want)
    print(f"recall {hit / wanted:.3f}, precision {hit / said:.3f}")
    assert hit / wanted >= RECALL and hit / said >= PRECISION


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    html, want = PAGES[name]
    got = main_text(html, TREE)
    assert got == want if want is not None else "yes" in got


def test_link_density():
    found = blocks("<p>one two <a href=x>three four</a></p>")
    assert [(b.linked, "".join(b.parts).split()) for b in found] == [(2, ["one", "two", "three", "four"])]


def test_long_and_hostile_pages_take_linear_time():
    for html in ("<" * 200_000, "<p '" * 60_000, "<!--" * 60_000, "<script>" * 60_000, "<div>" * 5_000 + "x", "<a href=\"x>" * 40_000, "&amp;" * 100_000):
        main_text(html, TREE)


def test_articles_of_the_table(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    own = {r.page_id: r for r in extract_text(pages).collect()}
    assert own.keys() == html.keys()
    for i, page in html.items():
        article = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?(?:p|br|h1)>", article)]
        assert own[i].text == "\n".join(filter(None, parts)) and own[i].n_chars == len(own[i].text)


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "u", "<p>x"), (2, "u", ""), (3, "u", "😀 " * 30_000), (3, "u", "😀 " * 30_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' as text", "1 as n_chars")
    got = extract_text(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in got) == [(0, "u", 0), (1, "", 0), (2, "u", 0), (3, "u", 59_999), (3, "u", 59_999)]
    assert extract_text(pages.where("false")).collect() == []
