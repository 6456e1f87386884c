import html
import re

import pytest

from delaylens.llm import html_text as H
from delaylens.llm.queries import op6_html_extraction

SMOKE = "/root/testdata/sf0.001"


def plain(page):
    """The article element of a page of the test data, read by patterns."""
    inside = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    inside = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", inside))
    return " ".join(html.unescape(inside).split())


def test_query_gives_the_articles(workers):
    pages = {r.page_id: r for r in workers.read.parquet(f"{SMOKE}/pages.parquet").collect()}
    rows = op6_html_extraction(workers, SMOKE).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url
        assert r.text == plain(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_held_out_blocks():
    field, memo, right, n = H.trained(), {}, 0, 0
    for found, labels in H.labelled_pages(200, seed=4242):
        got = field.labels(found, memo)
        right += sum(a == b for a, b in zip(got, labels))
        n += len(labels)
    assert right / n > 0.98


def say(page):
    return H.page_text(page, H.trained(), {})


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<html><body></body></html>", ""),
    ("<nav><a href=x>Home</a></nav><article><h1>T</h1><p>One &amp; two&nbsp;three\n four.</article><footer>&copy; x</footer>",
     "T One & two three four."),
    ("<article><p>a<b>b</b>c<br>d<p>e &lt;p&gt;<script>var t='</p>';</script><style>p{}</style></article>", "abc d e <p>"),
    ("<main><p>Long enough text of an article.</p><div class='comments'><p>A reader says this.</p></div></main>",
     "Long enough text of an article."),
    ("<div id=sidebar><p>Other things to read.</p></div><div class='post-content'><p>The story itself is here.</p></div>"
     "<div class='cookie-notice'>We use cookies.</div>", "The story itself is here."),
    ("<article><p>Text.</p><form><label>Mail</label><p>Write to us</p></form><aside>More</aside><p>End.</p></article>", "Text. End."),
    ("<article><p>unclosed <b>bold <p>next", "unclosed bold next"),
    ("<article><p title='a > b'>kept</p><!-- <p>gone</p> --></article>", "kept"),
    ("<article><ul><li>one<li>two</ul></article>", "one two"),
])
def test_pages(page, want):
    assert say(page) == want


@pytest.mark.parametrize("attributes, seen", [
    ('title="The hidden life of trees"', True), ("aria-label='A hidden gem'", True), ('class="md hidden lg:block"', True),
    ('data-x="a hidden"', True), ("alt=hidden", True), ('title="a" data-hidden', True), ("hidden", False), ("id=x HIDDEN", False),
    ('class="a"hidden', False), ('hidden="until-found" class=b', False), ("hidden = ''", False),
])
def test_only_an_attribute_named_hidden_hides(attributes, seen):
    assert say(f"<article {attributes}><p>All of the text is here.</p></article>") == ("All of the text is here." if seen else "")


@pytest.mark.parametrize("page, want", [
    ('<article><p title="a"">Lost text here.</p><p class="b">kept</p></article>', "Lost text here. kept"),
    ("<article><p title=don't>Lost one.</p><p>It's kept</p></article>", "Lost one. It's kept"),
    ("<article><p a'b>One.</p><p c\"d>It's \"two\".</p></article>", "One. It's \"two\"."),
    ('<article><p title=a="b>One.</p><p title="c">Two.</p></article>', "One. Two."),
    ("<article><p title = 'a > b' id=\"c > 'd\">kept</p></article>", "kept"),
    ('<article><p title="a>One.</p><p>Two.</p></article>', "One. Two."),
    ("<article><p title=>One.</p><p =\"x>Two.</p></article>", "One. Two."),
    ("<article><p>One.</p title='x>'><p>Two.</article>", "One. Two."),
])
def test_quotes_in_tags(page, want):
    assert say(page) == want


@pytest.mark.parametrize("page, want", [
    ("<html><head><meta charset=utf-8><title>T</title><article><p>The text.</p></article>", "The text."),
    ("<head><link rel=x><script>var a='<p>';</script>\n<style>p{}</style><article><p>The text.</article>", "The text."),
    ("<head><title>T</title><body><article><p>The text.</p></article></body>", "The text."),
    ("<head><title>T</title></head><body><article><p>The text.</p></article></body>", "The text."),
    ("<head><title>T</title><noscript><p>no</p></noscript><meta name=x content=y></head><article><p>The text.", "The text."),
])
def test_head_ends_where_content_starts(page, want):
    assert say(page) == want


def test_text_in_an_open_head_is_read():
    assert [b.text for b in H.blocks("<head><title>T</title> Bare text<p>and more")] == ["Bare text", "and more"]


def test_every_word_of_a_class_counts():
    utility = "flex flex-col items-center justify-between px-4 py-2 mt-6 rounded-lg cookie-notice"
    found = H.blocks(f'<div class="{utility}">We use cookies.</div>')
    assert {"is:cookie", "is:notice", "is:flex", "is:lg"} <= found[0].features
    found = H.blocks(f'<p class="{" ".join("x" * k + "-y" for k in range(1, 300))} telling">Text.</p>')
    assert {"is:telling", "is:y", "is:" + "x" * 299} <= found[0].features


def test_long_page_and_edge_rows(workers):
    long = "<article>" + "<p>some words here.</p>" * 20_000 + "</article>"
    rows = [(None, None, None), (1, "u", ""), (2, None, long), (2, None, long), (3, "u", "<" * 3000 + "'\"" * 3000)]
    df = workers.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.url, r.n_chars) for r in H.extract(df).collect()), key=repr)
    n = 20_000 * 17 - 1
    assert [g for g in got if g[0] != 3] == sorted([(None, None, 0), (1, "u", 0), (2, None, n), (2, None, n)], key=repr)
    assert H.extract(df.limit(0)).collect() == []
