"""The operators against brute force on the smallest tables, and on edge rows."""

import collections
import hashlib
import html as html_lib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from edge_rows import EDGE
from tokenizers import Tokenizer

import corpus_pipeline
from roomstar.llm import bpe, decontaminate, fingerprints, fm_index, html, language, near_dedup, quality
from roomstar.llm import queries as Q
from roomstar.llm import suffix_dedup, token_files, url_filter
from roomstar.session import work_dir

SF = "/root/testdata/sf0.001"
SPEC = Q.rank_spec()


@pytest.fixture(scope="session")
def edge(spark):
    """The edge rows with extra columns whose names clash with results."""
    schema = "doc_id long, text string, lang string, score double, ids string, spans int, chunk int, node int, n_chars long"
    return spark.createDataFrame([(i, t, "en", 0.5, "x", 1, 2, 3, 4) for i, t in EDGE], schema)


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("false")


def table(name):
    return duckdb.sql(f"SELECT * FROM read_parquet('{SF}/{name}.parquet')").fetchall()


DOCS = {r[0]: r[1] for r in table("documents")}
ORDER = sorted(DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_fingerprints(spark):
    rows = by_id(Q.op1_fingerprints(spark, SF))
    for i, nxt in zip(ORDER, [*ORDER[1:], ORDER[0]], strict=True):
        t, k = DOCS[i], len(DOCS[i]) // 4
        edited = t[:len(t) - k] + DOCS[nxt][:k]
        assert rows[i]["n_chars"] == len(t)
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert np.mean([rows[i]["near_edited"] > rows[i]["near_next"] for i in ORDER]) > 0.95


def test_sketches_recover_differences():
    a, b = "one two three\nfour five\n" * 3 + "six", "one two three\nfour five\n" * 2 + "seven"
    ka, kb = fingerprints.digests([a]), fingerprints.digests([b])
    only = collections.Counter(ka[0].tolist())
    only.subtract(kb[0].tolist())
    assert fingerprints.differing(ka, kb).tolist() == [sum(abs(n) for n in only.values())]


def test_token_files(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    rows, at = by_id(Q.op3_token_files(spark, SF)), 0
    for i in ORDER:
        ids = [*tok.encode(DOCS[i], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (at, len(ids), crc)
        at += len(ids)


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [0, 5, 5, 900, 10**9], list(range(0, 5000, 7))])
def test_elias_fano(values):
    coded, _ = token_files.EliasFano.from_bytes(token_files.EliasFano.encode(np.array(values)).to_bytes())
    assert coded.select(np.arange(len(values))).tolist() == values


def test_bpe_equals_tiktoken(spark):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.read_ranks(
        public_tokenizers.path("byte_bpe_50k.tiktoken")))
    rows = by_id(Q.op4_byte_bpe(spark, SF))
    for i in ORDER:
        ids = enc.encode_ordinary(DOCS[i])
        assert rows[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[i]["decoded_sha256"] == hashlib.sha256(DOCS[i].encode()).hexdigest()


def test_language_and_quality(spark):
    lang = {r[0]: r[2] for r in table("documents")}
    held = [r for r in Q.op5_language_id(spark, SF).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    label = {r[0]: r[1] for r in table("labels")}
    held = [r for r in Q.op2_quality(spark, SF).collect() if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) > 0.85


def test_html(spark):
    rows = {r["page_id"]: r["text"] for r in Q.op6_html(spark, SF).collect()}
    for i, _, page in table("pages"):
        body = re.search("<article>(.*?)</article>", page, re.S)[1]
        want = html_lib.unescape(re.sub("</?b>", "", re.sub("<(?:/?p|/?h1|br)>", " ", body)))
        assert rows[i] == " ".join(want.split())


def test_html_without_a_marked_article():
    shared = "this notice is the same on each of the pages of this host".split()
    pages = [[[f"own{i}", "text"], shared] for i in range(3)]
    marks = html.repeated(pages)
    assert [m[0].any() for m in marks] == [False] * 3 and all(m[1].all() for m in marks)
    assert html.page_parts("<article>1 &lt; 2<script>if(a<b)</script><p>x</article><footer>f") == ("1 < 2 x", [], ["f"])


def test_decontaminate(spark):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for item, text in table("benchmark"):
        w = pattern.findall(low(text))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k:k + 13])].add(str(item))
    rows = by_id(Q.op7_decontaminate(spark, SF))
    for i in ORDER:
        w = pattern.findall(low(DOCS[i]))
        hit, items = [False] * len(w), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if found := windows.get(tuple(w[k:k + n])):
                    items |= found
                    hit[k:k + n] = [True] * n
        assert (rows[i]["n_words"], rows[i]["n_hit"]) == (len(w), sum(hit))
        assert rows[i]["items_sha256"] == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(1)
    seq = np.append(rng.integers(0, 4, 2000), 0)
    phrases = rng.integers(1, 4, (40, 4))
    index = fm_index.FMIndex(seq, 3)
    lo, hi = index.search(phrases, np.full(40, 4))
    for p, a, b in zip(phrases, lo, hi, strict=True):
        want = [k for k in range(len(seq) - 3) if (seq[k:k + 4] == p).all()]
        assert sorted(index.locate(np.arange(a, b))) == want


@pytest.mark.parametrize("frequent", [suffix_dedup.FREQUENT, 2])
def test_suffix_dedup(spark, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    rows, seen = by_id(Q.op8_suffix_dedup(spark, SF)), set()
    for i in ORDER:
        b = DOCS[i].encode()
        own = {b[s:s + 50] for s in range(len(b) - 49)}
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 49):
            if b[s:s + 50] in seen:
                gone[s:s + 50] = True
        seen |= own
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        assert rows[i]["n_removed"] == gone.sum() and rows[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert rows[i]["n_spans"] == (np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()


def test_url_filter(spark):
    rows = {r["page_id"]: r for r in Q.op9_url_filter(spark, SF).collect()}
    for i, url, _ in table("pages"):
        host, path = re.match(r"[^:]*://([^/?#]*)([^?#]*)", url).groups()
        host = host.lower()
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (rows[i]["host"], rows[i]["path"]) == (host, path)
        assert rows[i]["rule"] == (max(fits)[1] if fits else None)
        assert rows[i]["verdict"] in (("allow", "block") if not fits else (max(fits)[2],))


def classes_of(texts):
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
            for i, w in ((i, re.findall(r"[^\x20\x09-\x0D]+", low(t))) for i, t in texts.items())}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_near_dedup(spark):
    want, size = classes_of(DOCS)
    rows = by_id(Q.op10_near_dedup(spark, SF))
    assert {i: r["component_id"] for i, r in rows.items()} == want
    assert {i: r["n_shingles"] for i, r in rows.items()} == size


def test_near_dedup_links_chains_that_hubs_do_not_see(spark):
    base = [f"w{k}" for k in range(60)]
    texts = {i: " ".join(base[:4 * (i % 3)] + [f"v{i}x{k}" for k in range(2)] + base[4 * (i % 3):]) for i in range(30)}
    want, _ = classes_of(texts)
    rows = near_dedup.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want


def operators(docs):
    spark = docs.sparkSession
    bench = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1, 0), (8, 0, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    path = work_dir(spark)
    token_files.write_shards(docs, SPEC, path)
    model = language.learn(docs, docs.doc_id.isNotNull())
    votes = quality.fit(docs, labels, labels.doc_id.isNotNull())
    return {
        "fingerprints": fingerprints.compare_edits(docs), "quality": quality.predict(docs, votes),
        "token_files": token_files.read_documents(spark, path), "bpe": bpe.decode(bpe.encode(docs, SPEC), SPEC),
        "language": language.predict(docs, model), "decontaminate": decontaminate.overlaps(docs, bench),
        "suffix_dedup": suffix_dedup.remove_repeats(docs), "near_dedup": near_dedup.classes(docs),
    }


def test_edge_rows(edge):
    out = {k: df.collect() for k, df in operators(edge).items()}
    assert {k: len(v) for k, v in out.items()} == dict.fromkeys(out, len(EDGE))
    lang = {r["doc_id"]: r["lang_pred"] for r in out["language"]}
    assert [lang[i] for i in (1, 2, 3, 8)] == ["und"] * 4 and lang[9] == "en"
    near = {r["doc_id"]: r["component_id"] for r in out["near_dedup"]}
    assert (near[1], near[2], near[3], near[5], near[7], near[None]) == (1, 2, 3, 4, 6, None)
    kept = {r["doc_id"]: bytes(r["kept"]) for r in out["suffix_dedup"]}
    assert kept[7] == b"" and len(kept[6]) == len(dict(EDGE)[6].encode()) and kept[1] == b""
    hit = {r["doc_id"]: r["n_hit"] for r in out["decontaminate"]}
    assert hit[4] == hit[5] == 1 and hit[1] == hit[2] == 0
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in out["bpe"]} == {i: t or "" for i, t in EDGE}


def test_empty_tables(empty):
    assert {k: df.count() for k, df in operators(empty).items()} == dict.fromkeys(operators(empty), 0)


def test_pages_edge_rows(spark):
    pages = spark.createDataFrame(
        [(1, None, None), (2, "no scheme", ""), (3, "http://A.org", "<p>x"), (3, "http://A.org", "<p>x"), (None, "://", "t")],
        "page_id long, url string, html string")
    for rows in (pages, pages.where("false")):
        assert html.extract(rows).count() == url_filter.judge(rows).count() == rows.count()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_filter.judge(pages).collect()}
    assert got[1] == got[2] == ("", "", None) and got[3] == ("a.org", "", None)


def test_pipeline(spark, edge):
    rows = edge.selectExpr("doc_id", "text", "lang", "'src' AS source", "n_chars")
    kept = [r["doc_id"] for r in corpus_pipeline.identify_language(spark, rows, SF).collect()]
    assert sorted(i for i in kept if i) == [4, 5, 6, 7, 7, 9, 11]
    out = corpus_pipeline.run(spark, SF).collect()
    assert all(r["exact"] for r in out)
    want, _ = classes_of(DOCS)
    assert {r["doc_id"] for r in out} <= {i for i, c in want.items() if i == c}
