"""URL filters: longest matching rules, and a tree of path templates for the urls without one.

Rules decide first. The urls they decide are the labels of the tree. In the tree a url goes from
its host through all segments of its path, level by level:

1. Variable segments become wildcards: those with a digit, very long ones (``LONG`` characters), and
   below a template with more than ``MANY`` different children the rare ones (``RARE`` urls at most).
2. The labelled children of a template are sorted by block rate; neighbours whose rates a two-sample
   z-test cannot tell apart (below ``MERGE_Z``) are merged: they become one branch, and what is below
   them is joined segment by segment. Children with equal counts are one entry of the sort, so a
   template with very many children does not fill a task. Hosts are not merged.
3. A branch's purity is its block rate, smoothed towards its parent's with ``PRIOR``
   pseudo-observations (a host's towards the rate of all labels, half if there are none).

A url without a rule is blocked if the purity of its whole path's template is over one half. Where all
urls below a template go the same way to the end, the rest of the path is one step: smoothing n
labels k more times is a geometric series. So levels are passed only while paths differ, and a
single url with very many segments costs none.

Everything is DataFrame operations over distinct (host, segments) with their counts, so a hot
host costs its number of templates, and a task never holds a host.

A null url and one without ``://`` have an empty host and path. Empty tables give no rows.
Repeated rows are judged each, and count each. Columns other than the id and the url are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomstar.session import checkpoint_dir

#: (verdict, host, path prefix)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
LONG = 40          # characters from which on a segment is variable
MANY = 50          # children of a template from which on rare ones are variable
RARE = 3           # urls up to which a child is rare
PRIOR = 4.0
MERGE_Z = 1.0
# Marks of generalised segments: a segment of a path has no slash, so none is equal to a mark.
DIGITS, TOO_LONG, ANY, MERGED = "/#", "/~", "/*", "/="
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host (after the first ``://`` up to ``/ ? #``) and path (up to ``? #``)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest fitting rule; null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _segments(path: Column) -> Column:
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(s.rlike("[0-9]"), F.lit(DIGITS))
                       .when(F.length(s) >= LONG, F.lit(TOO_LONG)).otherwise(s))


def _template(level: int) -> Column:
    return F.concat_ws("/", F.col("host"), F.slice("segments", 1, level))


def _relabel(level: int, name: Column) -> Column:
    """Segments with ``name``, unless null, at a level."""
    return F.when(name.isNull(), F.col("segments")).otherwise(
        F.transform("segments", lambda s, i: F.when(i == level - 1, name).otherwise(s)))


def _smoothed(blocked: Column, labelled: Column, up: Column) -> Column:
    return (blocked + up * PRIOR) / (labelled + PRIOR)


def judge(pages: DataFrame, url_col: str = "url", id_col: str = "page_id", rules=RULES) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, template, purity``."""
    checkpoint_dir(pages.sparkSession)
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    rows = (pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
            .withColumn("raw", _segments(F.col("path"))))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("rule_verdict", verdict)
    judged = _tree(rows.groupBy("host", "raw").agg(
        F.count("*").alias("n"), F.count("rule_verdict").alias("labelled"),
        F.count_if(F.col("rule_verdict") == "block").alias("blocked")))
    out = rows.join(judged.select("host", "raw", _template(LAST).alias("template"), "purity"), ["host", "raw"])
    by_tree = F.when(F.col("purity") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", by_tree).alias("verdict"),
                      "template", "purity")


LAST = (1 << 31) - 1
_LEAF = ["host", "raw", "segments", "n", "labelled", "blocked", "purity"]


def _tree(leaves: DataFrame) -> DataFrame:
    """Distinct (host, raw segments) with their generalised ``segments`` and the ``purity`` of their
    templates."""
    leaves = leaves.withColumn("segments", F.col("raw")).checkpoint()
    all_rates = leaves.agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b")).first()
    root = ((all_rates["b"] or 0) + PRIOR / 2) / ((all_rates["l"] or 0) + PRIOR)
    hosts = leaves.groupBy("host").agg(
        _smoothed(F.sum("blocked"), F.sum("labelled"), F.lit(root)).alias("purity"))
    live, level, done = leaves.join(hosts, "host").select(*_LEAF), 0, None
    while True:
        ended, live = _step_to_end(live, level)
        done = ended if done is None else done.unionByName(ended)
        if live.isEmpty():
            return done
        level += 1
        live = _level(_generalise(live, level), level)


def _step_to_end(live: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """(leaves whose template is final, the others). A leaf is final if its path ends at this level, or if
    all leaves below its template go the same way to their end."""
    here = live.withColumn("_t", _template(level))
    below = here.where(F.size("segments") > level).groupBy("_t").agg(
        (F.min("segments") == F.max("segments")).alias("_one_way"), F.sum("labelled").alias("_l"), F.sum("blocked").alias("_b"))
    here = here.join(below, "_t", "left").withColumn("_ends", F.size("segments") <= level)
    rate = F.col("_b") / F.col("_l")
    left = F.size("segments") - level
    at_end = F.when(F.col("_l") > 0, rate + (F.col("purity") - rate) * F.pow(F.lit(PRIOR) / (F.col("_l") + PRIOR), left)) \
              .otherwise(F.col("purity"))
    here = here.withColumn("purity", F.when(F.col("_ends") | ~F.col("_one_way"), F.col("purity")).otherwise(at_end)).checkpoint()
    final = F.col("_ends") | F.col("_one_way")
    return here.where(final).select(*_LEAF), here.where(~final).select(*_LEAF)


def _generalise(live: DataFrame, level: int) -> DataFrame:
    """Rare children of templates with many children become a wildcard at this level."""
    children = (live.groupBy(_template(level - 1).alias("_parent"), _template(level).alias("_child"))
                .agg(F.sum("n").alias("_n")))
    many = children.groupBy("_parent").agg(F.count("*").alias("_children")).where(F.col("_children") > MANY)
    rare = children.where(F.col("_n") <= RARE).join(many, "_parent").select("_child", F.lit(ANY).alias("_any"))
    marked = live.withColumn("_child", _template(level)).join(rare, "_child", "left")
    return marked.withColumn("segments", _relabel(level, F.col("_any"))).select(*_LEAF)


def _level(live: DataFrame, level: int) -> DataFrame:
    """Merge the like children of each template and give every leaf its branch's name and purity."""
    children = live.groupBy(_template(level - 1).alias("_parent"), _template(level).alias("_child")).agg(
        F.sum("labelled").alias("_l"), F.sum("blocked").alias("_b"), F.max("purity").alias("_up"))
    counts = ["_parent", "_l", "_b"]
    equal = children.where(F.col("_l") > 0).groupBy(*counts).agg(F.count("*").alias("_same"))
    by_rate = Window.partitionBy("_parent").orderBy((F.col("_b") / F.col("_l")).alias("_rate"), "_l")
    n, b = F.col("_l") * F.col("_same"), F.col("_b") * F.col("_same")
    n0, b0 = F.lag(n).over(by_rate), F.lag(b).over(by_rate)
    pooled = (b + b0) / (n + n0)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / n0))
    apart = F.when(spread > 0, F.abs(b / n - b0 / n0) / spread >= MERGE_Z).otherwise(b / n != b0 / n0)
    branch = equal.withColumn("_apart", F.coalesce(apart, F.lit(False)).cast("int")).withColumn(
        "_branch", F.sum("_apart").over(by_rate.rowsBetween(Window.unboundedPreceding, 0)))
    together = branch.groupBy("_parent", "_branch").agg(F.sum(n).alias("_all_l"), F.sum(b).alias("_all_b"),
                                                        F.sum("_same").alias("_members"))
    named = (branch.join(together, ["_parent", "_branch"]).select(*counts, "_branch", "_all_l", "_all_b", "_members"))
    children = children.join(named, counts, "left").select(
        "_child", F.when(F.col("_members") > 1, F.concat(F.lit(MERGED), F.col("_branch").cast("string"))).alias("_name"),
        _smoothed(F.coalesce("_all_b", F.lit(0)), F.coalesce("_all_l", F.lit(0)), F.col("_up")).alias("_purity"))
    joined = live.withColumn("_child", _template(level)).join(children, "_child")
    return joined.withColumn("segments", _relabel(level, F.col("_name"))).withColumn("purity", F.col("_purity")).select(*_LEAF)
