"""HTML extraction: the article of a page, with the boilerplate of its host found by a suffix array.

A page is cut into blocks of text by its block-level tags. Elements that are never part of an
article (scripts, styles, forms, navigation, asides, page headers and footers, and elements
whose class, id or role names a menu, advert, notice, share bar, reader comment or the like)
make chrome blocks. If the page marks its article (``article``, else ``main`` or the
like), the blocks inside are the article and the others are chrome. A page without such a mark
leaves its other blocks open.

A class or id word counts if it is the whole name, its last part (``site-footer``), or its first part
before words for a container (``comments-area``); ``ad-hoc`` or ``related-work`` name nothing. Such a
word is weaker than a mark: ``article`` and ``main`` are chrome only for a whole name (``comment``), and
if all marked text of a page lies in elements that only a word makes chrome, the words around it do
not count. Parsing takes time in proportion to the page, whatever is in it: a quote without an end is
a character, a tag without ``>`` ends at the next ``<``, a close tag without an open one is skipped.

Chrome and open blocks of a host's pages are concatenated in page order as token streams, cut only
between pages and where an article lay, and their suffixes are sorted. Strings of ``RUN`` tokens
that start suffixes of at least ``PAGES`` different pages are boilerplate, as are the
longer strings they make up, and so is a whole block of fewer tokens that as many pages have. Open
blocks lose the tokens they cover, the unique runs stay. Strings that run over several blocks take
the blocks they cover whole: the word with which an article's text starts is not cut for always
following the same menu. Blocks inside a marked article are never cut: two articles may share a
passage. A host with many pages is dealt into shards of about
``SHARD_PAGES`` by hashed page id, each with its own suffix array. A shard hands on each of its
strings as a hash with the digests of up to ``PAGES`` pages; the strings that reach ``PAGES`` over
all shards of the host come back to those that can cut them. So what is boilerplate does not
depend on a host's size.

Null and empty html give an empty text; a null url has an empty host. Unclosed tags end with the
element around them. Repeated rows are extracted each, and copies of a page (the same text in all of its
blocks, the article's too) count as one page when repeats are looked for.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomstar.llm.fm_index import suffix_array
from roomstar.llm.text import U64, SpanHash, from_texts, mix, slices
from roomstar.llm.url_filter import host_and_path
from roomstar.operators.joins import maybe_broadcast
from roomstar.session import checkpoint_dir, work_dir

RUN = 8
PAGES = 3
SHARD_PAGES = 1000

# Elements of the HTML standard and usual names of page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe object svg math".split())
SKIP = RAW | frozenset("head form nav footer aside button select option dialog menu audio video canvas".split())
BLOCK = frozenset("""address article aside blockquote body br button caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol
    option p pre section select summary table tbody td tfoot th thead title tr ul""".split())
CHROME_NAMES = frozenset("""ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo
    promotion nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside rail widget
    footer header masthead topbar toolbar cookie cookies consent gdpr notice alert notification popup modal
    overlay newsletter subscribe subscription signup login share sharing social related recommended
    comment comments reply replies respond disqus discussion search form""".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())
MARKS = ("article", "main")
MAIN_NAMES = re.compile(r"(?:^|\s)(?:article|post|entry|story)[-_]?(?:body|content|text)(?:\s|$)", re.I)

# Words for a container, after the name of what it contains.
CONTAINERS = frozenset("""area bar block box button buttons container content form inner item items left link links
    list panel posts right section slot thread top unit widget wrap wrapper""".split())

_OPEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile(r"[<>\"']")
VERBATIM = {name: re.compile(rf"</{name}", re.I) for name in ("script", "style", "textarea", "title", "noscript", "iframe")}
_ATTRIBUTE = re.compile(r"([a-zA-Z][-a-zA-Z0-9:]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
ARTICLE, OPEN, CHROME = range(3)
WORD = 3  # chrome by a class or id word alone


class _Scanner:
    """Markup of a page from left to right. ``find`` remembers what does not come any more, so that a
    page full of beginnings without ends is not searched to its end for each."""

    def __init__(self, page: str) -> None:
        self.page, self.gone = page, set()

    def find(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        k = self.page.find(what, at)
        if k < 0:
            self.gone.add(what)
        return k

    def tag_end(self, at: int) -> tuple[int, int]:
        """(end of a tag's attributes, where to go on) from the place after its name."""
        while (m := _STOP.search(self.page, at)) is not None:
            c = m[0]
            if c == ">":
                return m.start(), m.end()
            if c == "<":
                return m.start(), m.start()
            close = self.find(c, m.end())
            at = close + 1 if close >= 0 else m.end()
        return len(self.page), len(self.page)

    def skip(self, at: int) -> tuple[int, str]:
        """(end, text) of what a ``<!`` or ``<?`` at a place begins: a comment, a declaration, or CDATA,
        whose content is text."""
        page = self.page
        if page.startswith("<!--", at):
            end = self.find("-->", at + 4)
            return (end + 3 if end >= 0 else len(page)), ""
        if page.startswith("<![CDATA[", at) and (end := self.find("]]>", at + 9)) >= 0:
            return end + 3, page[at + 9:end]
        end = self.find(">", at)
        return (end + 1, "") if end >= 0 else (at + 1, "<")


def _names_chrome(name: str) -> bool:
    parts = [w for w in re.split(r"[-_]+", name.lower()) if w]
    return bool(parts) and (parts[-1] in CHROME_NAMES
                            or parts[0] in CHROME_NAMES and all(w in CONTAINERS for w in parts[1:]))


def _part(name: str, attributes: str, in_article: bool) -> int | None:
    """What an element says it is: CHROME, ARTICLE, or WORD (chrome by a class or id word)."""
    if name in SKIP or name == "header" and not in_article:
        return CHROME
    found = {}
    if attributes and not attributes.isspace():
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
        names = f"{found.get('class', '')} {found.get('id', '')}"
        role = found.get("role", "").lower()
        if "hidden" in found or found.get("aria-hidden") == "true":
            return CHROME
        if MAIN_NAMES.search(names) or role == "main" or found.get("itemprop", "").lower() == "articlebody":
            return ARTICLE
        if name in MARKS:
            return WORD if any(w.lower() in CHROME_NAMES for w in names.split()) else ARTICLE
        if name not in ("body", "html"):
            if role in CHROME_ROLES:
                return CHROME
            if any(_names_chrome(w) for w in names.split()):
                return WORD
    return ARTICLE if name in MARKS else None


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in order; texts without markup, white space as is."""
    out: list[tuple[bool, bool, bool, bool, str]] = []
    held: list[str] = []
    # Open elements with the state inside them: (chrome, in an article, in chrome by a word,
    # in an article inside of that).
    stack: list[tuple[str, tuple[bool, bool, bool, bool]]] = []
    open_names: Counter[str] = Counter()
    outside = (False, False, False, False)
    state = outside
    scan = _Scanner(page)

    def close_block():
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((*state, text))
            held.clear()

    def enter(new):
        nonlocal state
        if new != state:
            close_block()
            state = new

    def pop():
        open_names[stack.pop()[0]] -= 1

    at = 0
    while (lt := page.find("<", at)) >= 0:
        if lt > at:
            held.append(page[at:lt])
        m = _OPEN.match(page, lt)
        if m is None:
            if page[lt + 1:lt + 2] in ("!", "?"):
                at, text = scan.skip(lt)
                held.append(html.escape(text))
            else:
                held.append("&lt;")
                at = lt + 1
            continue
        attributes_end, at = scan.tag_end(m.end())
        attributes, name = page[m.end():attributes_end], m[2].lower()
        if m[1]:
            if name in BLOCK:
                close_block()
            if open_names[name]:
                while stack[-1][0] != name:
                    pop()
                pop()
                enter(stack[-1][1] if stack else outside)
            continue
        if name in BLOCK:
            close_block()
            while stack and stack[-1][0] == "p" and name != "br":  # a block ends an open paragraph
                pop()
            enter(stack[-1][1] if stack else outside)
        if name in VOID:
            continue
        part = _part(name, attributes, state[1] or state[3])
        chrome, article, word, inside = state
        now = (chrome or part == CHROME, article or part == ARTICLE and not word, word or part == WORD,
               inside and part != WORD or part == ARTICLE and word)
        if attributes.endswith("/"):
            if now != state:
                close_block()
            continue
        enter(now)
        stack.append((name, now))
        open_names[name] += 1
        if name in VERBATIM:  # no tags inside, and no text of the page
            end = VERBATIM[name].search(page, at)
            at = end.start() if end else len(page)
    if at < len(page):
        held.append(page[at:])
    close_block()
    # Words that hide all marked text are not believed about what holds it.
    marked = any(article and not chrome and not word for chrome, article, word, _, _ in out)

    def kind(chrome, article, word, inside):
        if chrome:
            return CHROME
        if word:
            return ARTICLE if inside and not marked else CHROME
        return ARTICLE if article else OPEN

    return [(kind(*flags), text) for *flags, text in out]


def page_stream(page: str) -> tuple[str | None, list[str], list[bool], int]:
    """(article text, blocks outside it in page order, whether each is open, digest of all blocks); the
    article is null if none is marked. An empty block stands where an article lay."""
    found = blocks(page)
    article = [t for k, t in found if k == ARTICLE]
    parts, is_open = [], []
    for kind, text in found:
        parts.append("" if kind == ARTICLE else text)
        is_open.append(kind == OPEN and not article)
    whole = hashlib.blake2b("\n".join(t for _, t in found).encode(), digest_size=8).digest()
    return " ".join(article) if article else None, parts, is_open, int.from_bytes(whole, "little", signed=True)


def page_parts(page: str) -> tuple[str | None, list[str], list[str]]:
    """(article text, open blocks, chrome blocks); the article is null if none is marked."""
    article, parts, is_open, _ = page_stream(page)
    return (article, [t for t, o in zip(parts, is_open, strict=True) if o],
            [t for t, o in zip(parts, is_open, strict=True) if t and not o])


def _groups(rows: np.ndarray) -> np.ndarray:
    """A number for every row, the same for equal rows."""
    return np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1)


class Strings:
    """What may be boilerplate on the given pages (lists of blocks of tokens): all strings of RUN
    tokens in a row, and whole blocks of fewer. ``start``, ``length``, ``group`` and ``page`` tell
    of each occurrence where it is, which ones are equal and whose it is."""

    def __init__(self, streams: list[list[list[str]]]) -> None:
        self.streams, self.vocabulary = streams, {}
        seq, first, size, of_page = [], [], [], []
        for number, page in enumerate(streams):
            for block in page:
                first.append(len(seq))
                size.append(len(block))
                seq += [self.vocabulary.setdefault(t, len(self.vocabulary) + 1) for t in block]
                if not block:
                    seq.append(0)
            seq.append(0)
            of_page.append(len(seq))
        self.seq = seq = np.array(seq, np.int64)
        self.first, self.size = np.array(first, np.int64), np.array(size, np.int64)
        order, run = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(seq):
            stop = np.flatnonzero(seq == 0)
            order = suffix_array(seq)
            order = order[stop[np.searchsorted(stop, order)] - order >= RUN]
        if len(order):
            same = np.ones(len(order) - 1, bool)
            for k in range(RUN):
                same &= seq[order[1:] + k] == seq[order[:-1] + k]
            run = np.concatenate([[0], np.cumsum(~same)])
        short = (self.size > 0) & (self.size < RUN)
        at, length, k = self.first[short], self.size[short], np.arange(RUN - 1)
        block = np.where(k < length[:, None], seq[np.minimum(at[:, None] + k, max(len(seq) - 1, 0))], 0) \
            if len(at) else np.zeros((0, RUN - 1), np.int64)
        self.start = np.concatenate([order, at])
        self.length = np.concatenate([np.full(len(order), RUN), length])
        self.group = np.concatenate([run, (run[-1] + 1 if len(run) else 0) + _groups(block)])
        self.n = int(self.group.max(initial=-1)) + 1
        self.page = np.searchsorted(np.array(of_page, np.int64), self.start, "right")

    def on_pages(self, page: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(group, page) of every different page that a group is on, in order; ``page`` numbers the
        pages, equal ones alike."""
        width = int(page.max(initial=0)) + 1
        return np.divmod(np.unique(self.group * width + page[self.page]), width)

    def keys(self) -> np.ndarray:
        """A hash of every group's tokens, the same on all shards."""
        one = np.zeros(self.n, np.int64)
        one[self.group] = np.arange(len(self.group))
        start, length = self.start[one], self.length[one]
        data, at = from_texts(list(self.vocabulary))
        token = np.concatenate([np.zeros(1, U64), SpanHash(data).of(at[:-1], at[1:])])
        h = length.astype(U64)
        for k in range(RUN):
            word = token[self.seq[np.minimum(start + k, max(len(self.seq) - 1, 0))]] if self.n else token[:0]
            h = np.where(k < length, mix(h * U64(0x9E3779B97F4A7C15) + word), h)
        return h.astype(np.int64)

    def in_open(self, is_open: list[list[bool]]) -> np.ndarray:
        """Whether a group has a token in an open block, given whether each block is one."""
        flags = np.array([o for page in is_open for o in page], bool)
        edge = np.zeros(len(self.seq) + 1, np.int64)
        edge[self.first[flags]] += self.size[flags] > 0
        edge[(self.first + self.size)[flags]] -= self.size[flags] > 0
        total = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]))])
        out = np.zeros(self.n, bool)
        out[self.group[total[self.start + self.length] > total[self.start]]] = True
        return out

    def marks(self, hit: np.ndarray) -> list[list[np.ndarray]]:
        """For every token of every block of every page: whether the groups in ``hit`` cover it."""
        n = len(self.seq)
        chosen = hit[self.group]
        start, end = self.start[chosen], (self.start + self.length)[chosen]
        block = np.searchsorted(self.first, start, "right") - 1
        inside = end <= self.first[block] + self.size[block]

        def covered(some):
            edge = np.bincount(start[some], minlength=n + 1) - np.bincount(end[some], minlength=n + 1)
            return np.cumsum(edge[:n]) > 0

        own, total = covered(inside), np.concatenate([[0], np.cumsum(covered(slice(None)))])
        whole = total[self.first + self.size] - total[self.first] == self.size
        each = iter([np.ones(k, bool) if w else own[a:a + k] for a, k, w in
                     zip(self.first.tolist(), self.size.tolist(), whole.tolist(), strict=True)])
        return [[next(each) for _ in page] for page in self.streams]


def repeated(streams: list[list[list[str]]], digests: list | None = None,
             elsewhere: np.ndarray | None = None) -> list[list[np.ndarray]]:
    """For every token of every block of every page: whether it lies in a string found on PAGES
    different pages, told apart by their digests (by their streams if none are given), or one whose
    key is in ``elsewhere``. An empty block keeps its neighbours apart."""
    whole: dict = {}
    same = digests if digests is not None else [tuple(map(tuple, p)) for p in streams]
    page = np.array([whole.setdefault(k, len(whole)) for k in same], np.int64)
    strings = Strings(streams)
    group, _ = strings.on_pages(page)
    hit = np.bincount(group, minlength=strings.n) >= PAGES
    if elsewhere is not None and len(elsewhere):
        hit |= np.isin(strings.keys(), elsewhere)
    return strings.marks(hit)


PARSED = "page_id long, url string, article string, parts array<string>, open array<boolean>, digest long"
STRINGS = "host string, shard long, key long, open boolean, pages array<long>"
RESULT = "page_id long, url string, text string"


def _parse(batches):
    for part in slices(batches, "html"):
        rows = [page_stream(h or "") for h in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array([r[0] for r in rows], pa.string()),
             pa.array([r[1] for r in rows], pa.list_(pa.string())), pa.array([r[2] for r in rows], pa.list_(pa.bool_())),
             pa.array([r[3] for r in rows], pa.int64())],
            ["page_id", "url", "article", "parts", "open", "digest"])


def _shard_strings(table: pa.Table) -> pa.Table:
    """The strings of one shard: key, whether it is in an open block, digests of up to PAGES pages."""
    parts, is_open = table.column("parts").to_pylist(), table.column("open").to_pylist()
    digests, page = np.unique(table.column("digest").to_numpy(), return_inverse=True)
    strings = Strings([[b.split() for b in p] for p in parts])
    group, number = strings.on_pages(page)
    first = np.searchsorted(group, np.arange(strings.n))
    few = np.arange(len(group)) - first[group] < PAGES
    ends = np.concatenate([[0], np.cumsum(np.bincount(group[few], minlength=strings.n))])
    host, shard = (table.column(c).combine_chunks().take(pa.array(np.zeros(strings.n, np.int64))) for c in ("host", "shard"))
    return pa.table({
        "host": host, "shard": shard, "key": pa.array(strings.keys()), "open": pa.array(strings.in_open(is_open)),
        "pages": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(digests[number[few]]))})


def _finish(table: pa.Table, reached: pa.Table) -> pa.Table:
    """One shard of a host: open blocks without the strings that its pages repeat, or that those
    of all shards repeat (``reached``)."""
    article, parts, is_open, digest = (table.column(c).to_pylist() for c in ("article", "parts", "open", "digest"))
    streams = [[b.split() for b in p] for p in parts]
    found = repeated(streams, digest, reached.column("key").to_numpy())
    texts = []
    for a, opened, stream, marks in zip(article, is_open, streams, found, strict=True):
        kept = (t for o, tokens, mark in zip(opened, stream, marks, strict=True) if o
                for t, m in zip(tokens, mark, strict=True) if not m)
        texts.append(a if a is not None else " ".join(kept))
    return pa.table({"page_id": table.column("page_id"), "url": table.column("url"),
                     "text": pa.array(texts, pa.string())})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text``."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
                        F.col(f"`{html_col}`").cast("string").alias("html"))
    checkpoint_dir(pages.sparkSession)
    host, _ = host_and_path(F.col("url"))
    # Hosts of more than one shard; there are at most as many as there are shards.
    hot = (rows.groupBy(host.alias("host")).agg(F.count("*").alias("n")).where(F.col("n") > SHARD_PAGES).checkpoint())
    hot = maybe_broadcast(hot, hot.count())
    dealt = _dealt(rows, host, hot, "left")
    path = work_dir(pages.sparkSession)
    (_dealt(rows.join(hot, host == hot.host, "left_semi"), host, hot, "inner").drop("page_id", "url", "article")
     .groupBy("host", "shard").applyInArrow(_shard_strings, STRINGS).write.option("compression", "zstd").parquet(path))
    strings = pages.sparkSession.read.schema(STRINGS).parquet(path)
    cut = strings.where("open").select("host", "shard", "key")
    reached = (strings.select("host", "key", F.explode("pages").alias("page")).groupBy("host", "key")
               .agg(F.count_distinct("page").alias("n")).where(F.col("n") >= PAGES).select("host", "key"))
    back = cut.join(reached, ["host", "key"]).select("host", "shard", "key").repartition("host", "shard")
    return dealt.groupBy("host", "shard").cogroup(back.groupBy("host", "shard")).applyInArrow(_finish, RESULT)


def _dealt(rows: DataFrame, host, hot: DataFrame, how: str) -> DataFrame:
    """Parsed pages with their ``host`` and ``shard``, each shard in one partition."""
    shards = F.coalesce(F.ceil(F.col("n") / SHARD_PAGES).cast("long"), F.lit(1))
    parsed = rows.mapInArrow(_parse, PARSED).withColumn("host", host).join(hot, "host", how)
    return (parsed.withColumn("shard", F.pmod(F.xxhash64("page_id"), shards)).drop("n").repartition("host", "shard"))
