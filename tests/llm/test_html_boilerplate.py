"""Boilerplate on pages that mark no article."""

import pytest

from roomstar.llm import html

NOTICE = "this notice is the same on each of the pages of this host"


def texts_of(spark, pages):
    """page_id -> text of pages given as (page_id, html) of one host."""
    rows = spark.createDataFrame([(i, f"http://a.org/{i}", h) for i, h in pages], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html.extract(rows).collect()}


def test_short_blocks_are_boilerplate(spark):
    menu = "<ul><li>Home</li><li>About us</li></ul><div>Site map</div>"
    foot = "<p>Copyright Ann Example</p>"
    pages = [(i, f"{menu}<p>Page {i} has words{i} of its own.</p>{foot}") for i in range(3)]
    assert texts_of(spark, pages) == {i: f"Page {i} has words{i} of its own." for i in range(3)}


def test_short_blocks_of_fewer_pages_stay(spark):
    pages = [(i, f"<p>Home</p><p>own{i} text</p>") for i in range(2)]
    assert texts_of(spark, pages) == {i: f"Home own{i} text" for i in range(2)}


def test_strings_run_over_blocks_and_take_whole_ones():
    """Cut at different places on each page, so that no block is on two pages."""
    line = "all rights reserved by the owner of this site".split()
    pages = [[[f"own{i}", "text"], line[:i], line[i:], ["The", f"end{i}"]] for i in (2, 4, 7)]
    for own, a, b, end in html.repeated(pages):
        assert a.all() and b.all() and not own.any() and not end.any()


def test_strings_do_not_cross_pages_or_articles():
    half = [["one", "two", "three", "four"], ["five", "six", "seven", "eight"]]
    apart = html.page_stream("<p>one two three four</p><article>x</article><p>five six seven eight</p>")
    assert apart[:3] == ("x", ["one two three four", "", "five six seven eight"], [False] * 3)
    pages = [[[f"a{i}", *half[0]], [], [*half[1], f"b{i}"]] for i in range(4)]
    assert not any(m.any() for page in html.repeated(pages) for m in page)


def test_marked_pages_of_one_template_are_different_pages(spark):
    foot = f"<div>{NOTICE}</div>"
    marked = [(i, f"<article>Article {i}</article>{foot}") for i in range(2)]
    assert texts_of(spark, [*marked, (9, f"<p>own words</p>{foot}")])[9] == "own words"


def test_copies_of_a_page_are_one_page(spark):
    foot = f"<div>{NOTICE}</div>"
    copies = [(i, f"<article>Article</article>{foot}") for i in range(5)]
    assert texts_of(spark, [*copies, (9, f"<p>own words</p>{foot}")])[9] == f"own words {NOTICE}"


@pytest.mark.parametrize("shard_pages", [html.SHARD_PAGES, 10, 1])
def test_boilerplate_does_not_depend_on_shards(spark, monkeypatch, shard_pages):
    """A notice and a short block on three or two of many pages, some of these twice."""
    monkeypatch.setattr(html, "SHARD_PAGES", shard_pages)
    pages = [(i, f"<p>own{i} words of page number{i}</p>") for i in range(60)]
    for i in (3, 17, 42):
        pages[i] = (i, f"<p>own{i} words of page number{i}</p><p>{NOTICE}</p><p>Home</p>")
    for i in (5, 6):
        pages[i] = (i, f"<p>own{i} words of page number{i}</p><p>not {NOTICE[5:]} twice</p><p>Away</p>")
    pages += [(100 + k, pages[5][1]) for k in range(4)]
    got = texts_of(spark, pages)
    want = {i: f"own{i} words of page number{i}" for i in range(60)}
    assert [got[i] for i in (3, 17, 42)] == [want[i] for i in (3, 17, 42)]
    for i in (5, 6, *range(100, 104)):
        assert got[i].endswith("twice Away")
    assert len(got) == 64 and all(got[i].startswith(want[i]) for i in want)
