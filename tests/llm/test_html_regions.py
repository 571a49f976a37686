import html
import re

import pytest

from shelfwise.llm import html_regions as regions

SCHEMA = "page_id long, url string, html string, text string, n_chars int"
BODY = "The first paragraph is long enough to be read as content by itself. " * 3
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
<header><a href=/>Home</a></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies, and this notice is quite long, longer than many paragraphs of any page.</div>
<article><h1>Title &amp; more</h1><p><b>Short.<br><p>{BODY}</p><p>Tail&nbsp;end &#169;
 2020</p><form><input><button>Send</button></form><div class="ad">Buy now!</div>
<section class="comments"><p>A reader comment of some length, which isn't part of the article text itself.</p></section></article>
<aside><p>Sidebar words that should go away even if there are many of them in a row.</p></aside>
<footer>&copy; example</footer></body></html>"""
WANT = f"Title & more Short. {BODY.strip()} Tail end © 2020"


@pytest.mark.parametrize("page,want", [
    (PAGE, WANT), (PAGE.replace("</article>", "").replace("</body></html>", ""), WANT), (None, ""), ("", ""), ("<p></p>", ""),
    ("plain text only", "plain text only"), ("<p>cut in the mid", "cut in the mid"), ("<div><p>a &lt;b&gt;</p>\n<p>c</p></div>", "a <b> c"),
    ("<script>x<", ""), ("<!-- note --><p>kept", "kept"),
])
def test_pages(page, want):
    assert regions.main_text(page) == want


def test_without_article_the_dense_box_is_taken():
    links = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(30))
    page = f'<html><body><div id="top"><ul>{links}</ul></div><div id="x"><p>{BODY}</p><p>{BODY}</p><p>Ok.</p></div><div>{links}</div></body></html>'
    assert regions.main_text(page) == f"{BODY.strip()} {BODY.strip()} Ok."


@pytest.mark.parametrize("around", ["content has-sidebar", "post with-comments", "entry share-enabled", "side-by-side", "navy", "modal-open", "plain"])
@pytest.mark.parametrize("inside", ["{}", "<main>{}</main>"])
def test_names_that_only_mention_a_mark_keep_the_article(around, inside):
    comments = '<div id="comments" class="comment-list"><p>' + "A reader says something rather long here. " * 60 + "</p></div>"
    page = f'<body><div class="site-nav"><a>Home</a></div>{inside.format(f"""<div class="{around}"><p>{BODY}</p><p>{BODY}</p></div>""")}{comments}</body>'
    assert regions.main_text(page.replace(comments, "")) == f"{BODY.strip()} {BODY.strip()}"
    assert regions.main_text(page) == f"{BODY.strip()} {BODY.strip()}"


@pytest.mark.parametrize("name", ["cookie-notice", "comments", "comments-area", "related-posts", "site-header", "ad", "newsletter_signup", "nav-menu"])
def test_marked_boxes_go(name):
    page = f'<body><div><p>{BODY}</p></div><div class="x {name}"><p>{"Words that are no part of the article. " * 3}</p></div></body>'
    assert regions.main_text(page) == BODY.strip()


def test_box_around_an_article_stays():
    page = f'<body><div class="sidebar"><article><p>{BODY}</p></article></div><div class="sidebar"><p>Away.</p></div></body>'
    assert regions.main_text(page) == BODY.strip()


def test_one_huge_paragraph_leaves_the_others():
    links = "".join(f'<li><a href="/{i}">Link {i}</a></li>' for i in range(30))
    for menu in ("", f"<div><ul>{links}</ul></div>"):
        page = f'<body>{menu}<div><p>{BODY}</p></div><div><p>{"long " * 20_000}</p></div><div><p>{BODY}</p></div></body>'
        assert regions.main_text(page) == f'{BODY.strip()} {("long " * 20_000).strip()} {BODY.strip()}'


def test_chunks_do_not_change_the_text(monkeypatch):
    monkeypatch.setattr(regions, "CHUNK", 7)
    assert regions.main_text(PAGE) == WANT


def test_given_pages(spark, sf_dir):
    """The article element of the given pages, by pattern."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in regions.extract(pages).collect():
        article = source[r.page_id].split("<article>")[1].split("</article>")[0]
        article = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)\b[^>]*>", " ", article))
        assert r.text == " ".join(html.unescape(article).split()) and r.n_chars == len(r.text)


def test_table_with_clashing_columns_nulls_and_repeats(spark):
    rows = [(1, "u", PAGE, "own", 3), (1, "u", PAGE, "own", 3), (None, None, None, None, None), (2, "v", "<p>x" + " y" * 200_000, "own", 1)]
    found = regions.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in found) == [(0, 0), (1, len(WANT)), (1, len(WANT)), (2, 400_001)]
    assert regions.extract(spark.createDataFrame([], SCHEMA)).collect() == []
