"""Main texts: hostile pages in linear time, and what the contract keeps."""

import time

import pytest

from loglark.llm import main_text, page_tree

MEGABYTE = 1_000_000


def repeated(piece):
    return piece * (MEGABYTE // len(piece))


HOSTILE = {
    "ends without starts": "<x>" * 150_000 + "</y>" * 140_000,
    "open quotes": repeated('<a "'),
    "open quotes with an end": repeated('<a "') + ">",
    "crossing quotes": repeated("<a '\"><b \">"),
    "open tags": repeated("<a "),
    "nested quotations": repeated("<blockquote>") + "deep",
    "items below a paragraph": "<p><body>" + repeated("<blockquote>") + "deep",
    "raw ends that never end": "<script>" + repeated("</script "),
    "quotes in names": repeated('<div class="'),
    "comments": repeated("<!-- -"),
    "references": repeated("&amp;<"),
}


@pytest.mark.parametrize("page", HOSTILE.values(), ids=HOSTILE.keys())
def test_hostile_pages_of_a_megabyte(page):
    start = time.process_time()
    tree = page_tree.parse(f"<p>before</p>{page}")
    assert time.process_time() - start < 2
    assert "before" in tree.text and max(tree.depth) <= page_tree.MAX_DEPTH + 1


def test_deep_pages_are_read_to_the_end():
    html = "<article>" + "<div>" * 3000 + "<p>One deep sentence is here.</p>" + "</div>" * 3000 + "<p>Then another one.</p></article>"
    model = main_text.train([])
    start = time.process_time()
    assert main_text.extract(model, [html]) == ["One deep sentence is here. Then another one."]
    assert time.process_time() - start < 5


def test_text_after_what_nothing_closes():
    for broken in ("<a '\"", '<b class="x', "<!-- no end", "<", "</", "a < b"):
        tree = page_tree.parse(f"<p>First.</p><p>Second. {broken}")
        assert "First." in tree.text and any(t and t.startswith("Second.") for t in tree.text)
    tree = page_tree.parse("<p>One.</p><a '\">two</a><p class='x'>Three.</p><p>Four.</p>")
    assert [t for t in tree.text if t] == ["One.", "two", "Three.", "Four."]


ARTICLE = (
    "<body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
    "{open}<header><h1>The heading of the piece</h1><p class=byline>By A. Writer</p></header>"
    "<p>The first paragraph says something about the matter at hand.</p>"
    "<div class=author-note><p>A note of the author that belongs to the text as much as the rest.</p></div>"
    "<p class=meta>Written in spring.</p><div class=tags><p>It is about birds and about trees.</p></div>"
    "<div class=read-more><p>There is more to say of this, and it follows here.</p></div>{close}"
    "<aside class=sidebar><h3>Popular</h3><ul><li><a href=/c>Other</a></li></ul></aside>"
    "<section class=comments><div class=comment><p>I did not like it at all.</p></div></section>"
    "<footer>&copy; example. All rights reserved.</footer></body>"
)
WANTED = (
    "The heading of the piece By A. Writer The first paragraph says something about the matter at hand. "
    "A note of the author that belongs to the text as much as the rest. Written in spring. It is about birds and about trees. "
    "There is more to say of this, and it follows here."
)


@pytest.mark.parametrize("wrap", [("<article>", "</article>"), ("<main>", "</main>"), ("<article class=post>", "</article>")])
@pytest.mark.parametrize("marked", [False, True])
def test_bylines_notes_tags_and_headings_stay(wrap, marked):
    page = ARTICLE.format(open=wrap[0], close=wrap[1])
    model = main_text.train([page.replace("birds", w) for w in ("fish", "rain", "snow")] * 20 if marked else [])
    assert main_text.extract(model, [page]) == [WANTED]


def test_an_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert main_text.main_text(pages).collect() == []


def test_long_pages_and_odd_columns(spark):
    long = "<article>" + "<p>Some words of a sentence.</p>" * 20_000 + "</article>"
    rows = [(1, "u", long), (1, "u", long), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "'x' as n_chars")
    got = sorted(main_text.main_text(df).collect(), key=lambda r: r.n_chars)
    assert [r.n_chars for r in got] == [0] + [len(" ".join(["Some words of a sentence."] * 20_000))] * 2
