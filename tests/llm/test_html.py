import html
import re

import pytest

from routeledger.llm import html_text, shared

LONG = "A sentence of the article that goes on for a while, with some commas, and then ends. " * 4


def plain(page):
    """The article element of a generated page, block by block."""
    article = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", article))
    return "\n\n".join(b for b in blocks if b)


def test_given_pages(spark):
    pages = shared.read(spark, "/root/testdata/sf0.01", "pages")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = html_text.extracted(pages).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("page, want", [
    (f"<nav>Home</nav><div id=c><h1>T</h1><p>{LONG}<p>Short.<br>Line</div><aside>{LONG}</aside>", ["T", LONG, "Short. Line"]),
    (f"<body><div class='side-bar sidebar'><p>{LONG}{LONG}</div><main><p>{LONG}</p><ul><li>one<li>two</ul></main>",
     [LONG, "one", "two"]),
    (f"<article><header><h1>T</h1></header><p>{LONG}</p><div class='advert'>{LONG}</div><section id='comments'>"
     f"<article><p>{LONG}</p></article></section><footer>x</footer></article>", ["T", LONG]),
    (f"<div class='cookie-notice'>{LONG}</div><article><p>{LONG} &lt;b&gt; &amp;amp; &eacute;</p></article>",
     [LONG.strip() + " <b> &amp; é"]),
    (f"<form><p>{LONG}</p></form><div><p>{LONG}</p><script>var x = '<p>no</p>'</script><style>p{{}}</style></div>", [LONG]),
    (f"<table><tr><td><a href=1>a</a></td><td><p>{LONG}</p><blockquote>q</blockquote></td></tr></table>", [LONG, "q"]),
])
def test_article_without_its_surroundings(page, want):
    assert html_text.main_text(page).split("\n\n") == [" ".join(w.split()) for w in want]


@pytest.mark.parametrize("page, want", [
    (f"<body><h1>T</h1><p>lead</p><div><p>{LONG * 5}</div><div><p>{LONG * 3}</div></body>",
     ["T", "lead", LONG * 5, LONG * 3]),
    (f"<body><div><div><p>{LONG * 5}</div><div><p>{LONG * 3}</div></div><footer>x</footer></body>", [LONG * 5, LONG * 3]),
    *((f"<body><div class='{c}'><h1>T</h1><p>{LONG}</p></div><div class='site-header'>{LONG}</div></body>", ["T", LONG])
      for c in ("content has-sidebar", "no-comments", "share-enabled", "with-banner", "social-history")),
    (f"<body><div><p>{LONG * 4}</p><div id='social-history'><p>{LONG}</p></div><div id=comment-list><p>{LONG}</p></div>"
     "</div></body>", [LONG * 4, LONG]),
    (f"<body><div class='banner'><p>{LONG * 4}</p></div></body>", [LONG * 4]),
])
def test_article_in_several_parts_and_under_telling_classes(page, want):
    assert html_text.main_text(page).split("\n\n") == [" ".join(w.split()) for w in want]


@pytest.mark.parametrize("page, want", [
    # content in one page-wide form, with and without an article element, beside buttons and labels
    (f"<body><form><div><h1>T</h1><p>{LONG}</p><p>{LONG}</p></div><label>Name</label><button>Go</button></form></body>",
     ["T", LONG, LONG]),
    (f"<body><form id=aspnet><nav>x</nav><article><h1>T</h1><p>{LONG}</p></article><footer>f</footer></form></body>", ["T", LONG]),
    (f"<article><p>{LONG}</p><form><p>{LONG}</p></form></article>", [LONG]),
    # names that may be subjects, around prose and around links
    (f"<article><p>{LONG}</p><section class='market-share'><h2>Share</h2><p>{LONG}</p></section></article>", [LONG, "Share", LONG]),
    (f"<article><p>{LONG}</p><section id=login><h2>Login</h2><p>{LONG}</p></section></article>", [LONG, "Login", LONG]),
    (f"<article><p>{LONG}</p><div class='fancy-share'><a>a</a> <a>b</a> <a>c</a> <a>d</a></div><p>{LONG}</p></article>", [LONG, LONG]),
    (f"<article><p>{LONG}</p><div class='post-share'><p>{LONG}</p></div><div class=related><p>{LONG}</p></div></article>", [LONG]),
    # an advert inside a part under such a name still goes
    (f"<article><section class='market-share'><p>{LONG}</p><div class=advert>{LONG}</div></section><p>{LONG}</p></article>", [LONG, LONG]),
    # headings, cells and inline elements have any id
    *((f"<article><h2 id='{i}' class='{i}'>Part</h2><p id='{i}'>{LONG} <span class='{i}'>in</span></p></article>", ["Part", LONG + "in"])
      for i in ("login", "social", "comments", "market-share", "cookie", "menu")),
    (f"<article><div class='entry-header'><h1>T</h1></div><p>{LONG}</p><p class=advert>{LONG}</p></article>", ["T", LONG]),
])
def test_forms_subjects_and_slugs(page, want):
    assert html_text.main_text(page).split("\n\n") == [" ".join(w.split()) for w in want]


def test_odd_pages(spark):
    rows = [(1, "u", None, 1), (2, None, "", 1), (None, "u", "<p>x", 1), (3, "u", "plain", 1), (3, "u", "plain", 1),
            (4, "u", "<<<&&& <!-- <p", 1), (5, "u", "<script>x", 1), (6, "u", "<p>" * 3000 + "deep", 1),
            (7, "u", f"<article><p>{'long ' * 200_000}</article>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r.page_id, r.url, r.text if r.page_id != 7 else len(r.text)) for r in html_text.extracted(pages).collect()}
    assert {(1, "u", ""), (2, None, ""), (None, "u", "x"), (3, "u", "plain"), (5, "u", ""), (6, "u", "deep"),
            (7, "u", 999_999)} <= got and html_text.extracted(pages).count() == 9
    assert html_text.extracted(pages.limit(0)).count() == 0


def test_threshold_splits_two_clusters():
    assert 2 < html_text._threshold([1, 1, 2, 50, 60]) < 50 and html_text._threshold([3, 3]) == 3
