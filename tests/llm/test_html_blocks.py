"""Block rules: tables' pages against their article markup, hand-made pages, odd rows."""
import html
import re

import pytest

from conftest import SF_SMALL
from rankwise.llm import html_blocks as h

LONG = ("The harbour of the old town was built in the years of the great trade, and it is "
        "still in use by the small boats that go out to the islands in the summer. ") * 2
NEWS = "Read the ten best offers of the week and get one of them for free with this code today. "


def page(body, head="<title>The title of it</title>"):
    return f"<!doctype html><html><head>{head}</head><body class='has-sidebar'>{body}</body></html>"


def test_tables_articles_are_found_whole(spark):
    for r in h.extract(spark.read.parquet(f"{SF_SMALL}/pages.parquet")).join(
            spark.read.parquet(f"{SF_SMALL}/pages.parquet"), "page_id").collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        article = re.sub(r"<[^<>]*\Z", "", article)
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split())
                 for x in re.split(r"</?(?:p|h1)[^>]*>", article)]
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


@pytest.mark.parametrize("junk", [
    f"<nav><ul><li><a href=/x>{NEWS}</a></li></ul></nav>", f"<header><p>{LONG}</p></header>",
    f"<aside><p>{LONG}</p></aside>", f"<div class='cookie-notice'><p>{LONG}</p></div>",
    f"<div id=\"comments\"><div class='c'><p>{LONG}</p></div></div>",
    f"<form action=/s><label>{NEWS}</label><input value='{NEWS}'></form>",
    f"<div class='ad box'>{LONG}</div>", f"<script>var x = '<p>{LONG}</p>';</script>",
    f"<style>p {{ content: '{NEWS}' }}</style>", f"<!-- <p>{LONG}</p> -->",
    f"<div role=navigation>{LONG}</div>", f"<div style='display: none'>{LONG}</div>",
    f"<p><a href='/a'>{LONG}</a> more</p>", f"<noscript><p>{LONG}</p></noscript>",
    f"<section class='relatedPosts'><p>{LONG}</p></section>"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_junk_goes_wherever_it_stands(junk, tag):
    text = f"<h1>A heading</h1><p>{LONG}</p><p>Short.</p>{{}}<p>{LONG}</p><p>The end.</p>"
    want = ["A heading", LONG.strip(), "Short.", LONG.strip(), "The end."]
    # A header inside an article is the article's own.
    inside = "" if tag == "article" and junk.startswith("<header") else junk
    for source in (f"<{tag}>" + text.format(inside) + f"</{tag}>",
                   junk + f"<{tag}>" + text.format("") + f"</{tag}>" + junk,
                   f"<main><{tag}>" + text.format("") + f"</{tag}></main>" + junk):
        got = h.main_text(page(source)).split("\n")
        if tag == "article" or "<main>" in source:
            assert got == want
        else:
            assert [x for x in got if x in (LONG.strip(), "Short.")] == \
                [LONG.strip(), "Short.", LONG.strip()]


def test_short_blocks_follow_their_nearest_decided_neighbour():
    body = (f"<div><p>{LONG}</p><p>Inside.</p><p>{LONG}</p></div>"
            f"<div><p><a href=x>{NEWS}</a></p><p>Outside.</p><p><a href=x>{NEWS}</a></p></div>")
    assert "Inside." in h.main_text(body) and "Outside." not in h.main_text(body)
    heading = f"<p><a href=x>{NEWS}</a></p><h2>Follows</h2><p>{LONG}</p>"
    assert h.main_text(heading).split("\n")[0] == "Follows"


@pytest.mark.parametrize(("source", "want"), [
    ("<article><p>a &amp;amp; b&nbsp;&eacute;\n\t c<b>d</b> e<br>f &lt;p&gt;</p></article>",
     "a &amp; b é cd e f <p>"),
    ("<article><p>one<p>two <li>three</article>", "one\ntwo\nthree"),
    ("<article><p>text cut in a <a href='x", "text cut in a"),
    ("<article><p>x</p><script>never closed <p>y</p>", "x"),
    ("<nav><a>m</a><article><p>the nav was not closed</p></article>", "the nav was not closed"),
    ("<ARTICLE><P CLASS=\"a>b\">upper</P></ARTICLE>", "upper"),
    ("<article>1 < 2 and 3 > 2</article>", "1 < 2 and 3 > 2"), ("", ""), ("no markup", "")])
def test_markup(source, want):
    assert h.main_text(source) == want


def test_rows(spark):
    good = f"<article><p>{LONG}</p></article>"
    rows = [(1, "u", good, "t"), (1, "u", good, "t"), (2, None, None, None), (None, "v", "", "t"),
            (3, "w", "<article>" + "<p>x</p>" * 20_000 + "</article>", "t"),
            (4, "w", "<p>" * 50_000 + "<" * 50_000 + "\"" * 1000, "t"),
            (5, "w", "<p>tiny</p><p><a>l</a></p>" * 5_000, "t")]
    out = h.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert out.columns == ["page_id", "url", "text", "_text", "n_chars"]
    got = {r.page_id: r for r in out.collect()}
    assert got[1]._text == LONG.strip() and got[2]._text == got[None]._text == ""
    assert got[3].n_chars == 39_999 and got[5]._text == ""
    assert out.count() == len(rows)
    assert h.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


@pytest.mark.parametrize("tag", ["button", "svg", "select", "noscript", "video", "object", "iframe"])
@pytest.mark.parametrize("source", [
    "<article><h1>Head</h1><{t} x=1>Go</div><p>{a}</p><p>{b}</p></article>",
    "<div><div><{t}></div><article><h1>Head</h1><p>{a}</p><p>{b}</p></article></div>",
    "<article><h1>Head</h1><p>{a}<{t}></p><p>{b}</p></article><p><{t}>Buy</{t}></p>",
    "<article><h1>Head</h1><div><{t} a=b></div><p>{a}</p><div><{t}>Like it</{t}></div><p>{b}</p></article>"])
def test_an_element_without_its_end_tag_takes_no_text_along(tag, source):
    a, b = LONG.strip(), LONG.strip().replace("harbour", "castle")
    got = h.main_text(page(source.format(t=tag, a=a, b=b))).split("\n")
    assert [x for x in got if x in ("Head", a, b)] == ["Head", a, b]
    assert "Like it" not in got and "Buy" not in got
    if tag in h.LABELLED_TAGS:
        assert got == ["Head", a, b]


def test_unread_elements_inside_a_block_leave_it_whole():
    source = ("<article><p>one <svg><g><text>no</text></g></svg>two <button>no</button>three "
              "<object><object>no</object>no</object>four <svg/>five <math><mi>x</mi>=<mn>1</mn></math></p></article>")
    assert h.main_text(source) == "one two three four five x=1"


@pytest.mark.parametrize("text", [
    "Il porto della vecchia città fu costruito negli anni del grande commercio ed è ancora usato "
    "dalle piccole barche che vanno alle isole durante tutta questa lunga estate.",
    "Port starego miasta zbudowano w latach wielkiego handlu i nadal korzystają z niego małe "
    "łodzie, które latem wypływają ku wyspom położonym niedaleko brzegu."])
def test_pages_in_other_languages_without_an_article(text):
    menu = "<ul>" + "<li><a href=x>Strona</a></li>" * 9 + "</ul>"
    more = f"<div class=cookie-notice>{text}</div><p><a href=x>{text}</a></p>"
    got = h.main_text(page(f"{menu}<div><p>{text}</p><p>{text}</p></div>{more}<p>© {text}</p>"))
    assert got == f"{text}\n{text}"


def test_many_unclosed_elements_are_read_in_time():
    import time
    for tag in ("button", "svg", "noscript"):
        start = time.time()
        h.main_text(f"<{tag}>" * 20_000 + "<p>x</p>")
        h.main_text(f"<div><{tag}>y</div>" * 20_000 + f"</{tag}>")
        assert time.time() - start < 20


def test_a_column_name_with_a_dot(spark):
    df = spark.createDataFrame([(1, "<article><p>x</p></article>", 7)], "page_id long, html string, `a.b` int")
    assert tuple(h.extract(df).select("page_id", "`a.b`", "text").first()) == (1, 7, "x")
