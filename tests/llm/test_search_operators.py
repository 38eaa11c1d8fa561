"""Hard negatives, licence scan and lexical search against brute force, and on edge rows."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from edge_rows import EDGE, LONG

from roomstar.llm import hard_negatives, lexical_search, license_scan
from roomstar.llm import queries as Q
from roomstar.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


def plain(df):
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=key)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = Q.QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(sorted(got.columns))} FROM ({ORACLE[name]})").fetchall()
    assert plain(got) == sorted(want, key=lambda r: tuple((x is None, x) for x in r))


# --- hard negatives ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, score long, part string"


def mined_by_hand(rows):
    """anchor_id, positive_rank, rank -> (positive_id, negative_id, scores), with Python's integers."""
    live = set()
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        live.add((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, tuple(math.floor(256.0 * x) for x in v)))
    last = lambda r: (r[0] is None, r[0] or 0, r[1])
    dot = lambda a, b: max(-(1 << 63) + 1, min((1 << 63) - 1, sum(x * y for x, y in zip(a, b, strict=False))))
    out = []
    for a in live:
        if a[0] is None or a[0] % 100:
            continue
        scored = sorted(((dot(a[2], b[2]), b) for b in live if b != a), key=lambda s: (-s[0], last(s[1])))
        for place, (p, pos) in enumerate([s for s in scored if s[1][1] == a[1]][:5], 1):
            fits = [s for s in scored if s[1][1] != a[1] and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(a[0], n[0], s, p, pos[0], place, k) for k, (s, n) in enumerate(fits[:10], 1)]
    return sorted(out, key=repr)


def mined(df):
    c = ["anchor_id", "negative_id", "negative_score", "positive_score", "positive_id", "positive_rank", "rank"]
    return sorted((tuple(r) for r in hard_negatives.mine(df).select(*c).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x") for i, v, label in rows], VECTORS)


def test_hard_negatives_edges(spark, monkeypatch):
    draw = random.Random(5)
    rows = [(i, [draw.choice([-1.0, 0.0, 0.25, 0.5, 1.0]) for _ in range(6)], draw.randrange(3)) for i in range(301)]
    rows += rows[:40]                                               # repeated rows
    rows += [(i, [1.0] * 6, i % 3) for i in range(500, 560)]          # ties
    rows += [(600, [1.0] * 6, None), (700, None, 1), (800, [1.0, None], 1), (900, [float("nan")] * 6, 1),
             (1000, [float("inf")], 1), (None, [1.0] * 6, 1), (None, [1.0] * 6, 2), (1100, [], 1), (1200, [0.5] * 9, 1),
             (1200, [0.25] * 6, 1), (1300, [0.0] * 6, 2), (-100, [-1.0] * 6, 1), (1400, [1e30, -1e30, 1.0], 2),
             (1500, [0.5] * 4000, 0), (1600, [-0.001] * 6, 2), (1700, [3e6] * 6, 0)]
    want = mined_by_hand(rows)
    assert len(want) > 200 and mined(frame(spark, rows)) == want
    monkeypatch.setattr(hard_negatives, "BLOCK_VALUES", 200)        # many blocks and chunks
    monkeypatch.setattr(hard_negatives, "CHUNK_VALUES", 30)
    assert mined(frame(spark, rows[:361])) == mined_by_hand(rows[:361])
    assert mined(frame(spark, rows).where("false")) == []


def test_threshold_stops_before_all_rows_are_scored():
    draw = np.random.default_rng(3)
    values = np.floor(np.exp(draw.normal(0, 2, (20_000, 4))) * 100)
    block = hard_negatives.Block(np.arange(20_000), np.zeros(20_000, np.int64), values)
    anchor = np.array([[3.0, 1.0, 2.0, 5.0]])
    windows = hard_negatives.Windows(np.array([[hard_negatives.LEAST + 1]]), np.array([[hard_negatives.NO_ID]]), 10)
    scored = hard_negatives.best_rows(block, np.array([-1]), np.zeros(1, np.int64), anchor, windows, True)
    assert scored < 5_000
    assert windows.row[0, 0].tolist() == np.lexsort((np.arange(20_000), -(values @ anchor[0])))[:10].tolist()


# --- licence scan -----------------------------------------------------------------------------


def scanned(spark, texts):
    rows = [(i, t, "x", 2.0, "y") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, score double, template string")
    return license_scan.scan(docs).collect()


def places(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(license_scan.WORD, text or "")]
    found = [(k, label) for label, phrase in license_scan.PHRASES for p in [phrase.split()]
             for k in range(len(words)) if words[k:k + len(p)] == p]
    return len(words), sorted(found)


def test_license_scan_edges(spark):
    granted = license_scan.TEMPLATES[3][1]
    words = granted.split()
    near = " ".join(["some", "text", *words[:6], "and", "gladly", *words[6:20], *words[21:]])
    texts = [*EDGE, (20, "Under the MIT License. under the mit license"), (21, "CC BY-NC cc by nc by nc"),
             (22, "under the mitK license"), (23, "Kunder the mit license"), (24, near),
             (25, " ".join(words[:8])), (26, "under the mit license\n" * 300), (26, "under the mit license\n" * 300),
             (27, "apache license version license version 2"), (28, "CC BY NC " + LONG), (29, None), (None, ""),
             (30, "UNDER THE MİT LICENSE"), (31, "Ä under-the/mit_license x")]
    got = sorted(scanned(spark, texts), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_words"]))
    by = sorted(texts, key=lambda t: (t[0] is None, t[0] or 0, places(t[1])[0]))
    assert [r["doc_id"] for r in got] == [i for i, _ in by]
    for r, (_, text) in zip(got, by, strict=True):
        n, found = places(text)
        assert (r["n_words"], r["n_base"]) == (n, len(found))
        assert (r["first_word"], r["last_word"]) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    one = {r["doc_id"]: r for r in got}
    assert one[24]["labels"] == "mit" and one[24]["base_labels"] == "" and 0.8 <= one[24]["score"] < 1
    assert [(s["first_word"], s["end_word"]) for s in one[24]["spans"]] == [(2, len(near.split()))]
    assert one[25]["labels"] == one[27]["labels"] == "" and one[1]["score"] == 0
    assert license_scan.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(spark.createDataFrame([], "doc_id long, text string"), phrases=[("x", "two words")])


# --- lexical search ---------------------------------------------------------------------------


def ranked_by_hand(docs, items):
    split = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(license_scan.WORD, t or "")]
    held = [(i, Counter(split(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, all_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c in held:
            m = 100 - 50 + (50 * c.total() * n_docs) // all_terms
            scores.append((i, sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                                  * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(split(text)) if t in c)))
        best = sorted((s for s in scores if s[1] > 0), key=lambda s: (-s[1], s[0] is None, s[0] or 0))[:50]
        out += [(i, item, k, s) for k, (i, s) in enumerate(best, 1)]
    return sorted(out, key=repr)


def test_lexical_search_edges(spark, monkeypatch):
    draw = random.Random(2)
    some = lambda n: " ".join(draw.choice("alpha Beta gamma delta Ünï x1 x2 x3 word it's".split()) for _ in range(n))
    docs = [*EDGE, *((100 + i, some(draw.randrange(1, 40))) for i in range(300)), *((500 + i, "alpha beta") for i in range(70)),
            (700, "alpha beta"), (700, "alpha beta")]
    items = [(1, "alpha beta beta"), (1, "alpha beta beta"), (1, "gamma"), (2, None), (3, ""), (4, "nowhere to be seen"),
             (5, "WORD it's Ünï"), (None, "x1 x2"), (6, some(30)), *((10 + i, some(3)) for i in range(20))]
    d = spark.createDataFrame([(i, t, "a", 7) for i, t in docs], "doc_id long, text string, term string, n long").repartition(5)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    want = ranked_by_hand(docs, items)
    assert plain(lexical_search.search(d, q)) == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    monkeypatch.setattr(lexical_search, "BLOCK_BYTES", 40)  # several blocks of items
    monkeypatch.setattr(lexical_search, "BATCH_DOCS", 64)
    assert plain(lexical_search.search(d, q)) == sorted(want, key=lambda r: tuple((x is None, x) for x in r))
    for a, b in ((d.where("false"), q), (d, q.where("false"))):
        assert lexical_search.search(a, b).count() == 0


def test_dual_tree_prunes_and_stays_exact():
    draw = np.random.default_rng(1)
    weights = draw.integers(1, 9000, 300)
    items = [sorted(draw.choice(300, 6, replace=False).tolist()) for _ in range(90)]
    tree = lexical_search.Search(items, weights, top=5)
    impacts = np.zeros((300, 4000))
    for d in range(4000):  # documents of a topic hold neighbouring terms
        impacts[(d // 40) * 3 + draw.integers(0, 3, 4), d] = draw.integers(1, 10**6, 4)
    for at in range(0, 4000, 500):
        tree.add(np.arange(at, at + 500), impacts[:, at:at + 500])
    assert tree.pruned > tree.opened / 4
    for i, doc, score in tree.rows():
        exact = weights[items[i]] @ impacts[items[i]].astype(np.int64)
        best = [k for k in np.lexsort((np.arange(4000), -exact))[:5] if exact[k] > 0]
        assert doc.tolist() == best and score.tolist() == exact[best].tolist()
