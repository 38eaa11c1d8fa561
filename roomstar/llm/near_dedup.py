"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets
and star-shaped candidate links, confirmed on full shingle sets.

Two texts are linked if their sets of word shingles have a similarity (intersection over union)
of at least ``threshold``; the result is the classes of linked texts.

1. Each text's distinct shingles are hashed once. The range of hashes is cut into ``ROWS`` bins
   for each band; a bin's smallest hash is its signature value and empty bins copy from bins picked by a
   fixed sequence of trials. ``ROWS`` values make a band. Texts with equal sets become one node,
   so groups of copies shrink to a row before anything is paired.
2. A bucket is the nodes with an equal band. Its smallest node is the hub and is compared with
   every other member, so a bucket makes as many pairs as it has members. Pairs are confirmed on
   the full sets of both texts, and confirmed links join nodes into classes.
3. Members of buckets that still hold several classes could have links that no hub saw. They
   are grouped anew by their rarest shingles (``_rare_groups``), where every similar pair is sure
   to meet. Small groups join their pairs of different classes (at most SMALL - 1 for a member);
   larger ones are compared block by block inside the tasks, which return a star of links for
   each class they find. So no link is lost to the star shape and no group is paired out.

There are as many bands as it takes (``bands_for``) that a link at the threshold is missed by all
of them with a probability below one in a million: 24 at 0.85, 35 at 0.8.

Null, empty and blank texts have no shingles and are classes of their own. Fewer words than a
shingle has make one shingle. Rows that share an id are nodes of their own by their texts; a
null id never is a class's smallest id unless the class has no other.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomstar.llm.columns import id_and_text
from roomstar.llm.components import components
from roomstar.llm.text import U64, SpanHash, lower_ascii, mix, per_text, pieces, slices, spans, utf8
from roomstar.operators.joins import maybe_broadcast
from roomstar.session import checkpoint_dir, work_dir

SHINGLE = 5
ROWS = 5      # signature values of a band
MISS = 1e-6   # probability that no band holds a link at the threshold
SMALL = 16  # members of a group whose pairs of different classes are joined as pairs
BLOCK = 512   # members of a larger group's block


def shingles(column, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of every text in ascending order, offsets of each text's)."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, U64), np.zeros(n + 1, np.int64)
    data = lower_ascii(data)
    start, end, owner = spans(~((data == 32) | ((data >= 9) & (data <= 13))), offsets)
    word = SpanHash(data).of(start, end)
    at = per_text(owner, n)
    count = np.diff(at)
    made = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    whose = np.repeat(np.arange(n), made)
    first = at[whose] + np.arange(len(whose)) - np.repeat(np.cumsum(made) - made, made)
    length = np.minimum(count, size)[whose]
    h = length.astype(U64)
    for k in range(size):
        w = word[np.minimum(first + k, max(len(word) - 1, 0))]
        h = np.where(k < length, mix(h * U64(0x9E3779B97F4A7C15) + w), h)
    order = np.lexsort((h, whose))
    h, whose = h[order], whose[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (whose[1:] != whose[:-1])
    return h[new], per_text(whose[new], n)


def bands_for(threshold_percent: int) -> int:
    """Bands that together miss a pair at the threshold with a probability of at most MISS."""
    same = (threshold_percent / 100) ** ROWS
    return 1 if same >= 1 else math.ceil(math.log(MISS) / math.log1p(-same))


def signatures(h: np.ndarray, at: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` values per text that has shingles."""
    texts = np.flatnonzero(np.diff(at))
    owner = np.repeat(np.arange(len(texts)), np.diff(at)[texts])
    bin_of = ((h >> U64(32)) * U64(bins)) >> U64(32)
    cell = owner * bins + bin_of.astype(np.int64)
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]  # hashes ascend, so a bin's first is its smallest
    out = np.zeros((len(texts), bins), U64)
    full = np.zeros((len(texts), bins), bool)
    out.reshape(-1)[cell[new]] = h[new]
    full.reshape(-1)[cell[new]] = True
    row, col = np.nonzero(~full)
    trial = 0
    while len(row):
        trial += 1
        to = (mix(col.astype(U64) * U64(0x10001) + U64(trial)) % U64(bins)).astype(np.int64)
        hit = full[row, to]
        out[row[hit], col[hit]] = out[row[hit], to[hit]]
        row, col = row[~hit], col[~hit]
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; equal keys of different bands differ in their number."""
    bands = signature.shape[1] // ROWS
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * U64(0xA0761D6478BD642F), (len(signature), bands))
    for r in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + signature[:, r::ROWS])
    return key


def _node_of(h: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """A digest of each text's set; none for an empty set."""
    raw = h.tobytes()
    return [hashlib.blake2b(raw[a * 8:b * 8], digest_size=16).digest() if b > a else None
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _signed(bands: int):
    def run(batches):
        for part in slices(batches, "text"):
            h, at = shingles(part.column("text"))
            count = np.diff(at)
            keys = band_keys(signatures(h, at, bands * ROWS)).astype(np.int64)
            ends = np.cumsum(np.where(count > 0, bands, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(count), pa.array(_node_of(h, at), pa.binary()), lists],
                ["doc_id", "n_shingles", "node", "bands"])
    return run


def _confirm(threshold_percent: int):
    def run(batches):
        for part in slices(batches, "text_a", 1 << 19):
            a, a_at = shingles(part.column("text_a"))
            b, b_at = shingles(part.column("text_b"))
            n = part.num_rows
            pair = np.concatenate([np.repeat(np.arange(n), np.diff(a_at)), np.repeat(np.arange(n), np.diff(b_at))])
            h = np.concatenate([a, b])
            order = np.lexsort((h, pair))
            p, h = pair[order], h[order]
            shared = np.bincount(p[1:][(h[1:] == h[:-1]) & (p[1:] == p[:-1])], minlength=n)
            union = np.diff(a_at) + np.diff(b_at) - shared
            near = (100 * shared >= threshold_percent * union) & (union > 0)
            yield pa.RecordBatch.from_arrays(
                [part.column("a").filter(pa.array(near)), part.column("b").filter(pa.array(near))], ["a", "b"])
    return run


def _known_size(df: DataFrame) -> DataFrame:
    """A checkpointed frame, broadcast in its next join if it is small enough."""
    df = df.checkpoint()
    return maybe_broadcast(df, df.count())


class _Texts:
    """One text of every node that is in a pair, kept as a table; grown as pairs come up."""

    def __init__(self, docs: DataFrame, signed: DataFrame) -> None:
        self.docs, self.signed, self.known = docs, signed, None

    def add(self, nodes: DataFrame) -> DataFrame:
        if self.known is not None:
            nodes = nodes.join(self.known.select("node"), "node", "left_anti")
        first = (self.signed.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id")))
        wanted = _known_size(first)

        def check(batches):  # an id may come with several texts
            for part in slices(batches, "text"):
                own = _node_of(*shingles(part.column("text")))
                same = pa.array([x == y for x, y in zip(own, part.column("node").to_pylist(), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").filter(same), part.column("text").filter(same)], ["node", "text"])

        path = work_dir(self.docs.sparkSession)
        (self.docs.join(wanted, self.docs.doc_id.eqNullSafe(wanted.doc_id)).select("node", "text", wanted.doc_id)
         .mapInArrow(check, "node binary, text string").dropDuplicates(["node"])
         .write.option("compression", "zstd").parquet(path))
        new = self.docs.sparkSession.read.parquet(path)
        self.known = new if self.known is None else self.known.unionAll(new)
        return self.known


def _linked(pairs: DataFrame, texts: _Texts, threshold_percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    known = texts.add(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    a = known.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = known.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
            .mapInArrow(_confirm(threshold_percent), "a binary, b binary"))


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members (key, node, ...) of groups with several classes, with their ``label``."""
    now = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    return now.join(mixed.select("key"), "key")


def _rare_groups(nodes: DataFrame, texts: _Texts, threshold_percent: int) -> DataFrame:
    """Groups ``key, node, size`` in which every pair of similar nodes meets: a node is in the
    groups of its n - ceil(threshold * n) + 1 rarest shingles (rarest among ``nodes``, ties by
    hash). Two sets that share none of these cannot be similar enough, so what many texts
    have in common puts nobody in a group unless it is most of their text."""
    def emit(batches):
        for part in slices(batches, "text"):
            h, at = shingles(part.column("text"))
            count = np.diff(at)
            row = pa.array(np.repeat(np.arange(len(count)), count))
            yield pa.RecordBatch.from_arrays(
                [part.column("node").take(row), pa.array(np.repeat(count, count)), pa.array(h.astype(np.int64))],
                ["node", "size", "key"])

    rows = (texts.known.join(nodes, "node", "left_semi").select("node", "text")
            .mapInArrow(emit, "node binary, size long, key long"))
    shared = rows.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    n, found = F.col("size"), F.size("keys")
    keep = n - F.floor((n * threshold_percent + 99) / 100) + 1 - (n - found)
    return (rows.join(shared, "key").groupBy("node", "size")
            .agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("keys"))
            .withColumn("key", F.explode(F.slice("keys", F.lit(1), F.greatest(keep, F.lit(0)).cast("int"))))
            .select("key.key", "node", "size").checkpoint())


def _overlaps(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Intersection sizes of all sets with each other, as blocked products of their incidence
    matrix; hashes that only one set has are left out."""
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    values, column, times = np.unique(h, return_inverse=True, return_counts=True)
    common = times > 1
    column = (np.cumsum(common) - 1)[column]
    keep = np.flatnonzero(common[np.searchsorted(values, h)])
    order = keep[np.argsort(column[keep], kind="stable")]
    out = np.zeros((n, n), np.float32)
    step = 2048
    cuts = np.searchsorted(column[order], np.arange(0, int(common.sum()) + step, step))
    for k, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        block = np.zeros((n, step), np.float32)
        block[owner[order[lo:hi]], column[order[lo:hi]] - k * step] = 1
        out += block @ block.T
    return out


def _roots(near: np.ndarray) -> np.ndarray:
    """Smallest index that each row of a symmetric link matrix reaches."""
    root = np.arange(len(near), dtype=np.int32)
    while True:
        least = np.minimum(root, np.where(near, root[None, :], np.int32(len(near))).min(1))
        least = least[least]
        if (least == root).all():
            return root
        root = least


def _block_links(threshold_percent: int):
    """Compare all texts of one block pair; a star of links for each class found in it."""
    def run(table: pa.Table) -> pa.Table:
        # Piece by piece: what hashing takes beside the hashes is many times the text.
        parts = [shingles(part.column("text")) for part in pieces(table.to_batches(), "text")]
        h = np.concatenate([p[0] for p in parts])
        at = np.append(0, np.cumsum(np.concatenate([np.diff(p[1]) for p in parts])))
        size = np.diff(at).astype(np.float32)
        shared = _overlaps(h, at)
        near = 100 * shared >= threshold_percent * (size[:, None] + size[None, :] - shared)
        root = _roots(near)
        some = np.flatnonzero(root != np.arange(len(root)))
        node = table.column("node")
        return pa.table({"a": node.take(pa.array(root[some])), "b": node.take(pa.array(some))})
    return run


def _large_groups(members: DataFrame, texts: _Texts, threshold_percent: int) -> DataFrame:
    """Links in groups ``key, node, n``: a group of n is dealt into blocks of about BLOCK members
    and every pair of blocks is one task's work, so no task holds more than two blocks."""
    count = F.ceil(F.col("n") / BLOCK).cast("long")
    own, other = F.pmod(F.xxhash64("node"), count), F.explode(F.sequence(F.lit(0), count - 1))
    dealt = (members.withColumn("own", own).withColumn("other", other)
             .select("key", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    return (dealt.join(texts.known.select("node", "text"), "node").groupBy("key", "i", "j")
            .applyInArrow(_block_links(threshold_percent), "a binary, b binary"))


def classes(docs: DataFrame, threshold_percent: int = 85, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles`` (size of its set) and ``component_id``, the
    smallest id of its class."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    docs = id_and_text(docs, id_col, text_col)
    path = work_dir(spark)
    docs.mapInArrow(_signed(bands_for(threshold_percent)),
                    "doc_id long, n_shingles long, node binary, bands array<long>").write.parquet(path)
    signed = spark.read.parquet(path)
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(F.first("bands").alias("bands"))
    members = nodes.select(F.explode("bands").alias("key"), "node")
    hubs = (members.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
            .select("key", "hub"))
    buckets = members.join(hubs, "key").checkpoint()

    texts = _Texts(docs, signed)
    pairs = (buckets.where("node <> hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
             .distinct().checkpoint())
    labels = None
    if not pairs.isEmpty():
        links = _linked(pairs, texts, threshold_percent).checkpoint()
        labels = components(links)
        # Hubs have been compared with all others of their bucket.
        rest = _mixed(buckets.where("node <> hub").select("key", "node"), labels).select("node").distinct()
        groups = _mixed(_rare_groups(rest, texts, threshold_percent), labels).checkpoint()
        size = groups.groupBy("key").agg(F.count("*").alias("n"))
        groups = groups.join(size, "key")
        small = groups.where(F.col("n") <= SMALL).drop("n")
        other = small.select("key", *[F.col(c).alias(f"{c}2") for c in ("node", "size", "label")])
        met = (small.join(other, "key").where("node < node2 AND label <> label2")
               .where(F.least("size", "size2") * 100 >= F.greatest("size", "size2") * threshold_percent))
        more = (met.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()
                .join(pairs, ["a", "b"], "left_anti").checkpoint())
        found = (_linked(more, texts, threshold_percent)
                 .unionAll(_large_groups(groups.where(F.col("n") > SMALL), texts, threshold_percent)).checkpoint())
        if not found.isEmpty():
            labels = components(links.unionAll(found))
    own = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("lowest"))
    if labels is not None:
        own = own.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        least = own.groupBy("label").agg(F.min("lowest").alias("component_id"))
        own = own.join(least, "label")
    else:
        own = own.withColumn("component_id", F.col("lowest"))
    return (signed.select("doc_id", "n_shingles", "node").join(own.select("node", "component_id"), "node", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id")))
