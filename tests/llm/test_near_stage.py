"""The pipeline's near-duplicate stage against brute force at its own similarity of 0.8."""

import re

import duckdb

import corpus_pipeline
from roomstar.llm import near_dedup

SF = "/root/testdata/sf0.01"


def shingle_sets(texts):
    out = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    return out


def smallest_ids(texts, percent):
    """Smallest id of each class of texts, and the pairs below 0.85."""
    sets = shingle_sets(texts)
    by_shingle, root, low = {}, {i: i for i in sets}, []
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in {(a, b) for ids in by_shingle.values() for a in ids for b in ids if a < b}:
        shared, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if 100 * shared >= percent * union:
            low += [(a, b)] * (100 * shared < 85 * union)
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i for i in sets if find(i) == i}, low


def test_stage_links_at_080(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet')").fetchall())
    want, low = smallest_ids(texts, 80)
    assert low and want != smallest_ids(texts, 85)[0]
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()]
    assert sorted(got) == sorted(want)


def test_bands_keep_the_miss_rate():
    for percent in (50, 70, 80, 85, 95, 100):
        n = near_dedup.bands_for(percent)
        assert (1 - (percent / 100) ** near_dedup.ROWS) ** n <= 1e-6
    assert near_dedup.bands_for(85) == 24 and near_dedup.bands_for(80) > 24
