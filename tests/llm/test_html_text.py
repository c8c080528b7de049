"""Main texts of pages whose article is known."""

import time
from html import escape

import pytest

from gridmend.llm import html_text

BLOCKS = ["A Title", "First words of a paragraph that goes on for quite a while, with commas & signs, and then it ends.", "Short.",
          "Another long paragraph follows the short one; it has enough words to look like text to any measure of text and tags."]
ARTICLE = "<h1>{}</h1>\n<p>{}</p><p>  {}\n</p><p>{}</p>".format(*map(escape, BLOCKS))
WANT = "\n".join(BLOCKS)
LONG = "This text is no part of the article although it is long and has many words, which is why it looks like it. " * 3
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Entry {i}</a></li>' for i in range(8)) + "</ul>"
PAGES = {
    "plain": f"<html><head><title>T</title><style>p{{}}</style></head><body><nav>{MENU}</nav><article>{ARTICLE}</article><footer>{LONG}</footer></body></html>",
    "script with tags": f"<body><script>var t='</p><article>no</article>';</script><article>{ARTICLE}<script>x<y</script></article></body>",
    "adverts and notices": f'<body><div class="ad">{LONG}</div><div id="cookie-notice">{LONG}</div><article>{ARTICLE}<aside>{LONG}</aside></article></body>',
    "comments": f'<body><main>{ARTICLE}<section class="comments"><article class="comment"><p>{LONG}</p></article></section></main></body>',
    "comments after": f'<body><article>{ARTICLE}</article><div id="comments"><h2>Comments</h2><p>{LONG}</p></div></body>',
    "forms": f"<body><article>{ARTICLE}<form><p>{LONG}</p><input><select><option>a<option>b</select></form></article></body>",
    "no article": f'<body><header>{LONG}</header><div class="top">{MENU}</div><div class="page"><div class="body">{ARTICLE}</div><div class="sidebar">{LONG}</div></div><div class="footer">{LONG}</div></body>',
    "text in the body": f'<body><div class="nav">{MENU}</div><p>Home</p>{ARTICLE}<div class="footer">{LONG}</div></body>',
    "open elements": f"<body><article><b>{ARTICLE.replace('</p>', '<br>')}</article><footer>{LONG}</body>",
    "sidebar layout": f'<body><div class="page has-sidebar"><article class="post">{ARTICLE}</article></div></body>',
    "article in a named element": f'<body><div class="sidebar"><article>{ARTICLE}</article></div></body>',
    "entry header": f'<body><div class="main-header">{LONG}</div><article><div class="entry-header">{ARTICLE[: ARTICLE.index("<p>")]}</div>{ARTICLE[ARTICLE.index("<p>") :]}</article></body>',
    "header in the article": f'<body><div class="header">{LONG}</div><article><div class="header">{ARTICLE[: ARTICLE.index("<p>")]}</div>{ARTICLE[ARTICLE.index("<p>") :]}<div class="banner">{LONG}</div></article></body>',
    "form around the page": f'<body><form id="page"><nav>{MENU}</nav><article>{ARTICLE}</article><footer>{LONG}</footer></form></body>',
    "thread of comments": f'<body><article>{ARTICLE}<ol class="commentlist"><li>{LONG}<li>{LONG}</ol></article><div id="disqus_thread"><p>{LONG}</p></div></body>',
    "notices": f'<body><div role="alert"><p>{LONG}</p></div><p class="notice">{LONG}</p><article>{ARTICLE}<div class="newsletter-signup"><p>{LONG}</p></div></article></body>',
    "hidden": f'<body><article>{ARTICLE}<p style="display: none">{LONG}</p><p hidden>{LONG}</p></article></body>',
    "comment markup": f"<body><!-- {LONG} --><article>{ARTICLE}</article></body>",
    "upper case": f"<BODY><NAV>{MENU}</NAV><ARTICLE>{ARTICLE}</ARTICLE></BODY>",
    "teasers": f"<body><article>{ARTICLE}</article>" + '<article><a href="/x">Read this</a></article>' * 4 + "</body>",
}


@pytest.mark.parametrize("name", PAGES)
def test_article_is_found_whole(name):
    assert html_text.main_text(PAGES[name]) == WANT


def test_blocks_and_white_space():
    page = "<article><p>a\n\t b&nbsp;c &lt;d&gt; &copy;&#233;&#x41;</p><ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><th>z</table>text<div>in</div>after<br>break</article>"
    assert html_text.main_text(page).split("\n") == ["a b c <d> ©éA", "one", "two", "x y", "z", "text", "in", "after break"]


def test_pages_without_text():
    for page in (None, "", "   ", "<html></html>", f"<body><nav>{MENU}</nav><footer>f</footer></body>", "<!-- x", "<", "<article>"):
        assert html_text.main_text(page) == ""


def test_paragraphs_of_one_word_and_of_links_stay():
    assert html_text.main_text('<article><p>One.</p><p><a href="/x">All of it a link</a></p><p>Two.</p></article>') == "One.\nAll of it a link\nTwo."


def test_threshold_parts_two_clusters():
    import numpy as np

    assert html_text.threshold(np.array([1.0, 2, 1, 50, 60, 2])) == 50 and html_text.threshold(np.array([3.0, 3])) == 3
    assert np.allclose(html_text.smoothed(np.array([5.0, 5, 5])), 5)


def test_long_pages_take_time_in_proportion():
    start = time.time()
    text = html_text.main_text("<article>" + "<p>word " * 200_000 + "</article>")
    assert text.count("\n") == 199_999
    assert len(html_text.main_text("<article><p>" + "x" * 5_000_000 + "</p></article>")) == 5_000_000
    html_text.main_text("<b>" * 100_000 + "x" + "</i>" * 100_000 + "</b>" * 100_000)
    assert time.time() - start < 30


def test_query_over_odd_rows(spark):
    rows = [(1, "u", PAGES["plain"]), (1, "u", PAGES["plain"]), (None, None, None), (2, None, ""), (3, "w", "<article>é</article>")]
    table = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = sorted((tuple(r) for r in html_text.extract(table).collect()), key=str)
    assert got == sorted([(i, u, html_text.main_text(p), len(html_text.main_text(p))) for i, u, p in rows], key=str)
    assert html_text.extract(table.limit(0)).count() == 0
