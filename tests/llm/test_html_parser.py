"""Pages whose class words, quotes or tags mislead, hostile pages, and repeated strings by brute force."""

import collections
import random
import time

import pytest

from roomstar.llm import html


def text(page):
    return " ".join(t for kind, t in html.blocks(page) if kind == html.ARTICLE)


@pytest.mark.parametrize("page", [
    '<article class="post-1 post category-search tag-social"><p>Text</p></article>',
    '<main class="has-sidebar"><p>Text</p></main>',
    '<div class="wrapper sidebar-right"><article><p>Text</p></article></div>',
    '<div class="widget"><div class="promo"><main>Text</main></div></div><div class="ad">Buy</div>',
    '<article>Text<div class="comments-area"><article class="comment">no</article></div></article>',
    '<article>Text</article><section class="comments"><article id="c2">no</article></section>',
    '<article>Text<p hidden>no</p><div class="cookie-bar">no</div><div aria-hidden="true">no</div></article>',
    '<article><p title="x>Text</p></article>', "<article><p title='a > b' class=x>Text</b></p></article></div>",
    "<nav>no<article>no</article></nav><article>Text</article>",
])
def test_marked_text_is_kept(page):
    assert text(page) == "Text"


def test_names_that_only_look_like_chrome():
    page = ('<article><p class="notice-of-birth">a</p><div class="ad-hoc">b</div><p id="related-work">c</p>'
            '<div class="ad">x</div><div class="share-buttons">y</div><p class="site-footer">z</p></article>')
    assert text(page) == "a b c"


def test_unfinished_markup():
    assert html.blocks("a < b <3 <p") == [(html.OPEN, "a < b <3")]
    assert html.blocks("x<![CDATA[1 < 2]]>y<!-- gone") == [(html.OPEN, "x1 < 2y")]
    assert html.blocks('<a "x<a "x<p>t') == [(html.OPEN, "t")]
    assert html.blocks("") == html.blocks("<p></p>") == []


@pytest.mark.parametrize("page", ['<a "x', "<a 'x\"", "<![CDATA[", "<!--", "<!", "<", "<?x", "</", "<a href=", '<p class="a">', "&amp"])
def test_hostile_pages_take_time_in_proportion(page):
    def seconds(size):
        began = time.thread_time()
        html.blocks(page * (size // len(page)))
        return time.thread_time() - began

    seconds(50_000)
    small, large = max(seconds(100_000), 0.02), seconds(800_000)
    assert large < 8 * small * 3


def test_stray_close_tags_take_time_in_proportion():
    began = time.thread_time()
    html.blocks("<div>" * 50_000 + "</b>" * 50_000)
    assert time.thread_time() - began < 10


def test_strings_against_counting_all_windows():
    draw = random.Random(8)
    streams = [[[draw.choice("ab") for _ in range(draw.choice([0, 2, 5, 9, 14]))] for _ in range(draw.randrange(1, 6))]
               for _ in range(25)]
    found = html.Strings(streams)
    want = collections.defaultdict(set)  # string -> places
    for number, page in enumerate(streams):
        run = []
        at = 0
        for block in [*page, []]:
            if not block:  # nothing runs over an empty block or the end of a page
                for k in range(len(run) - html.RUN + 1):
                    want[tuple(t for _, t in run[k:k + html.RUN])].add((number, run[k][0]))
                run = []
                at += 1
                continue
            if len(block) < html.RUN:
                want["whole", *block].add((number, at))
            run += [(at + k, t) for k, t in enumerate(block)]
            at += len(block)
    got = collections.defaultdict(set)
    begin = {}
    at = 0
    for number, page in enumerate(streams):
        begin[number] = at
        at += sum(max(1, len(b)) for b in page) + 1
    for start, group, page in zip(found.start, found.group, found.page, strict=True):
        got[int(group)].add((int(page), int(start) - begin[int(page)]))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_edge_table(spark):
    big = "<p>" + "word " * 200_000
    rows = [(1, None, None, 1), (2, "http://h.org/", "<article>a</article>", 1), (2, "http://h.org/", "<article>a</article>", 1),
            (3, "http://h.org/x", big, 1), (None, None, "<main>b</main>", 1), (4, "http://h.org/y", "", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = collections.Counter((r["page_id"], len(r["text"])) for r in html.extract(pages).collect())
    assert got == {(1, 0): 1, (2, 1): 2, (3, len(("word " * 200_000).strip())): 1, (None, 1): 1, (4, 0): 1}
    assert html.extract(pages.where("false")).count() == 0
