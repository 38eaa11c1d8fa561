"""The template tree of the URL filter against a plain Python tree, and on hostile urls."""

import collections
import random
import re

import duckdb
import pytest

from roomstar.llm import url_filter as U

SF = "/root/testdata/sf0.01"


def host_path(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(str.maketrans(U.ASCII_UPPER, U.ASCII_LOWER)), m[2]) if m else ("", "")


def rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits) if fits else None


def judged_by_hand(urls):
    """verdict of each url, by walking one level after the other without any shortcut."""
    def segments(path):
        return [U.DIGITS if re.search("[0-9]", s) else U.TOO_LONG if len(s) >= U.LONG else s for s in path.split("/") if s]
    leaves = collections.OrderedDict()
    for u in urls:
        h, p = host_path(u)
        r = rule(h, p)
        e = leaves.setdefault((h, tuple(segments(p))), [0, 0, 0])
        e[0] += 1
        e[1] += r is not None
        e[2] += r is not None and r[2] == "block"
    total, blocked = sum(e[1] for e in leaves.values()), sum(e[2] for e in leaves.values())
    smooth = lambda b, n, up: (b + up * U.PRIOR) / (n + U.PRIOR)
    root = (blocked + U.PRIOR / 2) / (total + U.PRIOR)
    path = {k: list(k[1]) for k in leaves}
    purity = {}
    for h in {k[0] for k in leaves}:
        mine = [k for k in leaves if k[0] == h]
        first = smooth(sum(leaves[k][2] for k in mine), sum(leaves[k][1] for k in mine), root)
        purity.update(dict.fromkeys(mine, first))
    level = 1
    while any(len(s) >= level for s in path.values()):
        at = lambda k, n: (k[0], *path[k][:n])
        live = [k for k in leaves if len(path[k]) >= level]
        kids = collections.defaultdict(lambda: collections.defaultdict(list))
        for k in live:
            kids[at(k, level - 1)][path[k][level - 1]].append(k)
        for children in kids.values():
            # as the operator: nothing is generalised where all leaves go one way
            if len({tuple(path[k]) for ks in children.values() for k in ks}) > 1 and len(children) > U.MANY:
                for ks in list(children.values()):
                    if sum(leaves[k][0] for k in ks) <= U.RARE:
                        for k in ks:
                            path[k][level - 1] = U.ANY
        kids = collections.defaultdict(lambda: collections.defaultdict(list))
        for k in live:
            kids[at(k, level - 1)][path[k][level - 1]].append(k)
        for children in kids.values():
            one_way = len({tuple(path[k]) for ks in children.values() for k in ks}) == 1
            counts = {c: (sum(leaves[k][1] for k in ks), sum(leaves[k][2] for k in ks)) for c, ks in children.items()}
            entries = collections.Counter(v for v in counts.values() if v[0])
            branch, last, number = {}, None, 0
            for (n, b), same in sorted(entries.items(), key=lambda e: (e[0][1] / e[0][0], e[0][0])):
                cur = (n * same, b * same)
                if last:
                    p = (cur[1] + last[1]) / (cur[0] + last[0])
                    spread = (p * (1 - p) * (1 / cur[0] + 1 / last[0])) ** 0.5
                    d = abs(cur[1] / cur[0] - last[1] / last[0])
                    number += d / spread >= U.MERGE_Z if spread > 0 else d > 0
                branch[n, b], last = number, cur
            pools = collections.defaultdict(lambda: [0, 0, 0])
            for c, v in counts.items():
                if v[0]:
                    pool = pools[branch[v]]
                    pool[0], pool[1], pool[2] = pool[0] + v[0], pool[1] + v[1], pool[2] + 1
            for c, ks in children.items():
                pool = pools[branch[counts[c]]] if counts[c][0] else [0, 0, 1]
                for k in ks:
                    purity[k] = smooth(pool[1], pool[0], purity[k])
                    if pool[2] > 1 and not one_way:
                        path[k][level - 1] = f"{U.MERGED}{branch[counts[c]]}"
        level += 1
    out = []
    for u in urls:
        h, p = host_path(u)
        r = rule(h, p)
        k = (h, tuple(segments(p)))
        out.append((r[2] if r else "block" if purity[k] > 0.5 else "allow", purity[k]))
    return out


def check(spark, urls):
    rows = spark.createDataFrame([(i, u, "x", 0.5, 3) for i, u in enumerate(urls)],
                                 "page_id long, url string, host string, purity double, template int")
    got = {r["page_id"]: r for r in U.judge(rows).collect()}
    for i, (verdict, purity) in enumerate(judged_by_hand(urls)):
        assert got[i]["purity"] == pytest.approx(purity, abs=1e-9), urls[i]
        assert abs(purity - 0.5) < 1e-9 or got[i]["verdict"] == verdict, urls[i]
    return got


def test_pages_against_a_plain_tree(spark):
    urls = [u for (u,) in duckdb.sql(f"SELECT url FROM read_parquet('{SF}/pages.parquet') ORDER BY page_id").fetchall()]
    check(spark, urls)


def test_deep_and_like_branches(spark):
    draw = random.Random(4)
    urls = []
    for _ in range(600):
        h = draw.choice(["a.example.org", "b.example.org", "c.com", "d.net"])
        first = draw.choice(["es", "fr", "de", "en", "x", "y", "news"])
        rest = [draw.choice(["p", "q", "r", "12", "*", "~", "long" * 12]) for _ in range(draw.randrange(7))]
        urls.append(f"http://{h}/{'/'.join([first, *rest])}")
    urls += [f"http://c.com/de/many/u{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}/z" for i in range(70)]
    check(spark, urls)


def test_hostile_urls(spark):
    deep = "http://e.org/" + "/".join(f"s{'x' * (i % 5)}" for i in range(5_000))
    urls = [None, "", "no scheme", "://", "http://", "http://e.org/*/~/#", deep, deep, "http://e.org/" + "y" * 100_000,
            "http://e.org/a//b///c", "HTTP://E.ORG/A", "http://e.org/s/sx"]
    got = check(spark, urls)
    assert got[6]["verdict"] == "allow" and got[6]["rule"] == "org/" and got[0]["host"] == got[0]["path"] == ""
    assert U.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
