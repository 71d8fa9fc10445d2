from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from deskmetrics.llm import html_wrapper as H
from deskmetrics.llm import queries

from .conftest import SF


def plain(page: str) -> str:
    """The generated pages hold one article of headings and paragraphs."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    spaced = re.sub(r"<(/?p|/?h1|br)\b[^>]*>", " ", inside)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", spaced)).split())


def test_query_matches_brute_force(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op8_html_wrapper(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain(pages[r.page_id].html), len(r.text))


ARTICLE = "<html><body><nav><a href=/>Home</a></nav><article><h1>T{0}</h1><p>One {0} &amp; <b>tw</b>o<br>three" \
          "<p>four {0}{1}</article><footer>Foot</footer></body></html>"


@pytest.mark.parametrize("inner", [
    "<aside>no</aside>", "<div class='ad-box'>no</div>", "<section id=comments><p>no</p></section>",
    "<form><input>no</form>", "<script>no('</p>')</script>", "<style>no</style>", "<!-- no <p>no</p> -->",
    "<div class=\"cookie-notice\">no</div>", "<article class='comment'>no</article>", "<ul role=menu><li>no</ul>"])
def test_parts_that_are_not_the_article(inner):
    page = ARTICLE.format("x", inner)
    assert H.extract(page, H.wrapper_of(H.parse(page)), 1) == "Tx One x & two three four x"


def test_wrapper_has_slots_options_and_repeats():
    wrapper = None
    for i, extra in enumerate(["", "<p>more</p><p>and more</p>", "<ul><li>a<li>b</ul>"]):
        wrapper = H.align(wrapper, H.wrapper_of(H.parse(ARTICLE.format(i, extra))))
    text = H.expression(wrapper)
    assert "(<p>#TEXT</>)+" in text and "<h1>#TEXT</>" in text and "(<ul>" in text and "</>)?" in text
    assert "<footer>'Foot'</>" in text      # the same on all pages: template text
    for i, extra in enumerate(["", "<p>more</p><p>and more</p>", "<ul><li>a<li>b</ul>"]):
        assert H.extract(ARTICLE.format(i, extra), wrapper, 3).startswith(f"T{i} One {i} & two three four {i}")


def test_pages_without_an_article_lose_template_text():
    make = "<body><div>Site name</div><div><p>Story {0} a.<p>Story {0} b.</div><div class=sidebar>x{0}</div></body>"
    pages = [make.format(i) for i in range(4)]
    wrapper = None
    for p in pages:
        wrapper = H.align(wrapper, H.wrapper_of(H.parse(p)))
    assert H.extract(pages[2], wrapper, 4) == "Story 2 a. Story 2 b."


@pytest.mark.parametrize("page", [
    None, "", "plain text", "<", "<div", "</p></div>", "<a href=\"x>y", "<div>" * 3000 + "deep" + "</div>" * 3000,
    "<script>never closed", "<!-- open", "<p>a<p>b</table></ul>", "<article>" * 80 + "t", "<x-y>z</x-y>", "&#x110000; &bogus; &lt;"])
def test_broken_pages(page):
    text = H.extract(page, H.wrapper_of(H.parse(page)), 1)
    assert isinstance(text, str) and "<div" not in text.replace("<div", "", 1)


def test_depth_does_not_lose_text():
    page = "<article><p>top</p>" + "<div>" * 200 + "deep &lt;" + "</div>" * 200 + "<p>end</p></article><p>out</p>"
    assert H.extract(page, H.wrapper_of(H.parse(page)), 1) == "top deep < end"


def test_edge_rows(spark):
    rows = [(1, "http://A.example/x", ARTICLE.format(1, "")), (2, "https://a.example:80/y?z", ARTICLE.format(2, "")),
            (2, "https://a.example:80/y?z", ARTICLE.format(2, "")), (3, None, ARTICLE.format(3, "")), (4, "http://b.example", None),
            (5, "", ""), (None, None, None), (6, "http://long.example/", "<article>" + "<p>word</p>" * 30000 + "</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clashing = pages.select("*", *[F.lit(1).alias(c) for c in ("host", "wrapper", "pages", "id", "text")])
    for df in (pages, clashing):
        got = {r.page_id: r.text for r in H.main_text(df).collect()}
        assert got[1] == "T1 One 1 & two three four 1" and got[3].startswith("T3") and got[2].startswith("T2")
        assert got[4] == got[5] == got[None] == "" and got[6] == " ".join(["word"] * 30000)
    assert H.main_text(pages).count() == len(rows)
    assert H.main_text(pages.filter(F.lit(False))).collect() == []


def test_only_text_of_all_pages_is_template(spark):
    copy = "<body><div>Site</div><div><p>Same story.</p></div><footer>{0}</footer></body>"
    rows = [(1, "http://a/1", "<div>Site</div><p>Story A.</p><blockquote>Only here.</blockquote>"),
            (2, "http://a/2", "<div>Site</div><p>Story B.</p>"), (3, "http://a/2", "<div>Site</div><p>Story B.</p>"),
            (4, "http://b/1", copy.format(1)), (5, "http://b/1", copy.format(1)), (6, "http://b/1", copy.format(2))]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got == {1: "Story A. Only here.", 2: "Story B.", 3: "Story B.", 4: "Site Same story.",
                   5: "Site Same story.", 6: "Site Same story."}


def _wrapped(make):
    wrapper = None
    for i in range(3):
        wrapper = H.align(wrapper, H.wrapper_of(H.parse(make.format(i))))
    return H.extract(make.format(1), wrapper, 3)


@pytest.mark.parametrize("opening", [
    "<div class='page has-sidebar'>", "<div class=no-sidebar>", "<div id=x class='with-comments'>", "<form action='/x'>",
    "<div class='search-results'>", "<div class=header-fixed>", "<div class=search><div class='layout sidebar'>"])
@pytest.mark.parametrize("tag", ["article", "main", "div"])
def test_containers_of_the_article_are_no_asides(opening, tag):
    make = f"<body><div>Site</div>{opening}<{tag}><p>Story {{0}}.</{tag}><div class=ad-box>no {{0}}</div>"
    assert _wrapped(make) == "Story 1."


@pytest.mark.parametrize("attrs", [
    'data-comment-count="3"', 'class="post comments-open"', 'id="reply-all-story"', 'data-id="comment"',
    'class="comment"', "id=comment-7"])
def test_attributes_do_not_make_the_article_a_comment(attrs):
    assert _wrapped(f"<div>Site</div><article {attrs}><p>Story {{0}}.</article>") == "Story 1."


def test_comments_as_articles_stay_out():
    page = "<article><p>Story {0}.</article><article class=comment><p>no {0}</article><article id=reply-4>no {0}</article>"
    assert _wrapped(page) == "Story 1."


def test_anchors_inside_an_article_are_no_roles():
    page = "<article><section id=search><h2 id=menu>Search</h2><p>Story {0}.</section><div id=search>no</div></article>"
    assert _wrapped(page) == "Search Story 1."


def test_fixed_lines_of_articles_are_template():
    page = "<article><h2>Summary</h2><p>Story {0}.</p><div>Share this with friends</div></article>"
    wrapper = None
    for i in range(6):
        wrapper = H.align(wrapper, H.wrapper_of(H.parse(page.format(i))))
    assert H.extract(page.format(1), wrapper, 6) == "Summary Story 1."
    assert H.extract(page.format(1), wrapper, 4) == "Summary Story 1. Share this with friends"


def test_headings_beside_the_story_stay():
    assert _wrapped("<h1>Site</h1><div><h2>Summary</h2><p>Story {0}.</div>") == "Summary Story 1."


@pytest.mark.parametrize("tag", ["div", "x-story", "section"])
def test_hosts_with_other_tags(tag):
    page = f"<header>Top</header><div>Site</div><{tag}><p>Story {{0}}.<p>More {{0}}.</{tag}><footer>End</footer>"
    assert _wrapped(page) == "Story 1. More 1."


def test_articles_among_comments_stay_out():
    assert _wrapped("<div><p>Story {0}.</div><section id=comments><article>no {0}</article></section>") == "Story 1."
