from __future__ import annotations

import html
import re

import pytest

from tests_llm import SF, clashing
from tideline.llm.html_text import densities, extract_pages, main_text, _Tree

BODY = "<p>First paragraph with a good number of words in it.</p><p>Second one, <a href=x>with a link</a> inside.</p>"
TEXT = "First paragraph with a good number of words in it.\nSecond one, with a link inside."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body><nav><a href=1>Home</a></nav><article>{BODY}</article><footer>Imprint and all</footer></body></html>",
        f"<body><div id=page><div class='side-bar sidebar'>Words words words.</div><div id=c>{BODY}</div></div>",
        f"<body><header><h1>Site</h1></header><main><section>{BODY}<form>Name <input></form></section></main><aside>More</aside>",
        f"<body><article>{BODY}<section class='comments'><p>I read this and it was long and good.</p></section></article>",
        f"<body><div class='cookie-notice'>We use cookies, many of them, all day long.</div><div>{BODY}</div>",
        f"<body><div>{BODY}<ul><li><a href=1>Read this as well</a><li><a href=2>And this</a></ul></div>",
        f"<body><script>var a='<p>no</p>'</script><style>p{{}}</style><div>{BODY}<!-- <p>no</p> --></div><noscript>no</noscript>",
        f"<body><div><p hidden>gone</p><p style='display: none'>gone</p>{BODY}<div class=adsbygoogle-ad>Buy this now, friends.</div></div>",
        f"<body><article><section>{BODY[:BODY.index('<p>Second')]}</section><section>{BODY[BODY.index('<p>Second'):]}</section></article>",
        f"<BODY><ARTICLE>{BODY}</ARTICLE></BODY>".replace("<p>", "<P CLASS=Text>"),
    ],
)
def test_article_alone(page):
    assert main_text(page) == TEXT


@pytest.mark.parametrize(
    "page",
    [
        f"<body><div class='content with-sidebar'>{BODY}</div><div class=sidebar>Words words.</div>",
        f"<body><div id=page class=no-sidebar><div>{BODY}</div></div>",
        f"<body><div class='post has-comments'>{BODY}</div><div class=comments>Well said, I think.</div>",
        f"<body><div class='social-policy'>{BODY}</div>",
        f"<body><div class=sidebar>{BODY}</div><div class=menu>Home</div>",
        f"<body><form action=page.aspx><div class=menu>Home, news</div><div>{BODY}</div></form>",
        f"<body><div class=widget><article>{BODY}</article></div><p>" + "Other words. " * 40,
        f"<head><title>T</title><meta charset=utf-8><div>{BODY}</div>",
        f"<body><div>{BODY}<div class=related-posts>More of the same.</div><div class='post-comments'>I agree.</div></div>",
        f"<body><main><div class='layout sidebar'>{BODY}</div></main>",
    ],
)
def test_names_and_forms_around_the_article(page):
    found = main_text(page)
    assert found == TEXT or "Other words" in page and found.startswith(TEXT)


def test_linked_headings_and_paragraphs_of_the_article_stay():
    page = f"<article><h2><a href='#s'>Section</a></h2>{BODY}<p><a href=y>Source of it all</a></p><div><h3><a href=z>More</a></h3></div>"
    assert main_text(page) == f"Section\n{TEXT}\nSource of it all\nMore"
    page = f"<article>{BODY}<ul><li><a href=1>Read this</a><li><a href=2>And this</a></ul><div><a href=3>One</a> <a href=4>two</a></div>"
    assert main_text(page) == TEXT


def test_short_named_parts_go_and_head_stays_out():
    assert main_text("<body>" + "<div class=promo><p>one two</p></div>" * 3) == "one two\none two\none two"
    assert main_text("<body><div class=ad>An advert that is longer than the text.</div><article><p>Short text.</article>") == "Short text."
    assert main_text("<head><title>T</title><noscript><p>no</p></noscript></head><p>text") == "text"
    assert main_text("<head><title>T</title>text") == "text"
    assert main_text(f"<body><article>{BODY}<div class=comments><article>Yes, quite.</article></div></article>") == TEXT


def test_blocks_white_space_and_references():
    page = "<article><h1> A &amp;  B&nbsp;&copy; </h1><p>one\n two<b>three</b> f<i>our</i><br>five &#x41;&#66; &lt;p&gt;<p>six<ul><li>x<li>y</ul><p> </p>tail"
    assert main_text(page) == "A & B ©\none twothree four\nfive AB <p>\nsix\nx\ny\ntail"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain &amp; simple\ntext", "plain & simple text"), ("<p", "<p"),
        ("<nav>menu</nav><script>x</script>", ""), ("<article>cut off &am", "cut off &am"), ("</p></div></b>end tags", "end tags"),
        ("<body><b>bold <i>both</b> italic</i> rest", "bold both italic rest"), ("<p>\x00zero\x00</p>", "\x00zero\x00"),
    ],
)
def test_broken_and_empty_pages(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "<p>deep text here</p>") == "deep text here"
    assert main_text("<article>" + "<p>word and word.</p>" * 50_000 + "</article>") == "\n".join(["word and word."] * 50_000)


def test_densities_by_hand():
    tree = _Tree()
    tree.feed("<body><div><p>abcdefghij</p><p><a>abcde</a></p></div></body>")
    density, sums, links = densities(tree)
    by_tag = dict(zip(tree.tag, zip(density, sums, links, strict=True), strict=True))
    assert by_tag["a"][2] and not by_tag["div"][2]
    assert by_tag["div"][1] == sum(d for d, t, p in zip(density, tree.tag, tree.parent, strict=True) if t == "p")
    assert density[3] > density[4]  # the text paragraph beats the link paragraph


def test_table_against_its_template(spark):
    """The given pages follow one template, so a plain cut of the article is a check."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r for r in extract_pages(clashing(pages)).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for row in rows:
        article = row.html.split("<article>")[1].split("</article>")[0].split("<footer")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?p>|</?h1>|<br>", article)]
        assert found[row.page_id].text == "\n".join(b for b in blocks if b)
        assert found[row.page_id].n_chars == len(found[row.page_id].text) and found[row.page_id].url == row.url


def test_awkward_rows(spark):
    schema = "page_id long, url string, html string"
    rows = [(1, None, None), (None, "u", ""), (2, "u", BODY), (2, "u", BODY), (3, "v", "<article>\U0001f600é</article>")]
    found = extract_pages(spark.createDataFrame(rows, schema)).collect()
    assert sorted(((r.page_id, r.text, r.n_chars) for r in found), key=repr) == sorted(
        [(1, "", 0), (None, "", 0), (2, TEXT, len(TEXT)), (2, TEXT, len(TEXT)), (3, "\U0001f600é", 2)], key=repr
    )
    assert extract_pages(spark.createDataFrame([], schema)).count() == 0
