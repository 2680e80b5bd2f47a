from __future__ import annotations

import pytest

from zoneflow.llm import pages

PROSE = "The old house at the end of the road was sold in the spring, and it is said that they have been there for many of the years since."


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<html><body></body></html>", ""),
        ("<article><h1>T</h1><p>Kurz &amp; gut&nbsp;&lt;b&gt;</p></article>", "T\nKurz & gut <b>"),
        ("<article><h1>T\n  x</h1><p><b>one<br>two<p>three</article><footer>f</footer>", "T x\none two\nthree"),
        ('<script>var t="</p><article>x";</script><article><p>a</p></article>', "a"),
        ('<article><p>a<!-- <p>no</p> -->b</p><style>p{}</style><p>c', "ab\nc"),
        ('<nav><ul><li><a href="/">m</a></ul></nav><div class="ad">ad</div><article><p>Zz%%% $$$</p></article><footer>f', "Zz%%% $$$"),
        ('<article><p>a</p><div class="comments"><p>nice!</p></div><aside>s</aside><form><p>f</p></form><p>b</p></article>', "a\nb"),
        ('<article class="post with-sidebar"><p>a</p></article><article class="comment"><p>c</p></article>', "a"),
        ('<div id="cookie-notice"><p>' + PROSE + "</p></div><main><p>a</p></main>", "a"),
        (f"<header><p>{PROSE}</p></header><div><h2>Head</h2><p>{PROSE}</p><p>short</p><p>{PROSE}</p></div><div>foot</div>", f"Head\n{PROSE}\nshort\n{PROSE}\nfoot"),
        (f'<div><p>{PROSE}</p><p><a href="x">{PROSE}</a></p></div>', PROSE),
        ('<article><p hidden>no</p><p style="display: none">no</p><p>yes</p></article>', "yes"),
        (f'<article><p>a</p><p><a href="x">{PROSE}</a></p><ul><li><a href="y">menu</a></li><li>item <a href="z">z</a></li></ul></article>', f"a\n{PROSE}\nitem z"),
        ("<article><p>a < b and 3 > 2</p></article>", "a < b and 3 > 2"),
        ("<article><p>cut off</p><p", "cut off"),
        ('<article><p title="a > b">x</p><p title="unclosed>y</p></article>', "x\ny"),
        ("<article><p>&#8364;&eacute;&#x1F600;&unknown;</p></article>", "€é\U0001f600&unknown;"),
    ],
)
def test_rules(html, text):
    assert pages.main_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f'<div><p title="The hidden valley">{PROSE}</p></div>', PROSE),
        (f'<div data-hidden="false" data-id="ad-7" data-class=\'menu\' data-role=nav><p>{PROSE}</p></div>', PROSE),
        (f'<div title="a class=ad"><p>{PROSE}</p></div><div CLASS = "ad"><p>{PROSE}</p></div>', PROSE),
        (f'<div class="post-content with-sidebar"><p>{PROSE}</p><div class="sidebar"><p>{PROSE}</p></div></div>', PROSE),
        (f'<section id="main" class="layout-with-sidebar"><p>{PROSE}</p></section>', PROSE),
        (f'<div class="row has-sidebar"><p>{PROSE}</p></div>', PROSE),
        (f'<div class="entry comments-open"><p>{PROSE}</p></div>', PROSE),
        (f'<div><p>{PROSE}</p><div class="comment-body"><p>{PROSE}</p></div><div id="sidebar" class="content"><p>{PROSE}</p></div></div>', PROSE),
        (f'<div><p>{PROSE}</p><div class="content comment"><p>{PROSE}</p></div><div class="text" role="search"><p>{PROSE}</p></div></div>', PROSE),
        *((f"<body><p>{PROSE}</p><div><{e}>inner</div><p>{PROSE}</p></body>", f"{PROSE}\n{PROSE}") for e in pages.EMBEDDED.split()),
        (f"<div><svg>x<p>{PROSE}</p><svg><title>t</title></svg><p>{PROSE}</p></div>", f"{PROSE}\n{PROSE}"),
        (f"<div><svg><svg>x</svg>y</svg><p>{PROSE}</p><video>no <p>no</p></video></div>", PROSE),
        (f"<div><p>{PROSE}</p><script>var a = '<p>{PROSE}</p>'</div>", PROSE),
    ],
)
def test_nothing_of_the_article_goes_by_mistake(html, text):
    assert pages.main_text(html) == text


def test_many_unclosed_elements_take_no_time():
    assert pages.main_text("<article>" + "<svg><p>word</p>" * 20_000) == "\n".join(["word"] * 20_000)


def test_undecided_blocks_take_the_nearer_label():
    junk = "zork blib " * 12
    html = f"<div><p>{PROSE}</p><p>near text</p><p>mid</p><p>x</p><p>near junk</p><p>{junk}</p></div>"
    assert pages.main_text(html) == f"{PROSE}\nnear text\nmid"


def test_very_long_page():
    assert len(pages.main_text("<article>" + "<p>word</p>" * 50_000 + "</article>")) == 50_000 * 5 - 1
    assert pages.main_text("<div>" * 3000 + PROSE) == PROSE


def test_table(spark, sf):
    given = spark.read.parquet(f"{sf}/pages.parquet").select("*", "url").toDF("page_id", "url", "html", "text")
    rows = pages.extract(given).collect()
    assert len(rows) == given.count() and all(r["n_chars"] == len(r["text"]) > 0 for r in rows)
    assert not any("track(" in r["text"] or "<p>" in r["text"] for r in rows)
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", "<p>x")], "page_id long, url string, html string")
    assert sorted(r["text"] for r in pages.extract(odd).collect()) == ["", "", ""]
    assert pages.extract(odd.limit(0)).count() == 0
