"""Hard negatives by Fagin's threshold algorithm, with exact integer scores.

A component x becomes floor(256 * x); a row's score for an anchor is the integer inner product. Anchors
are rows whose id is divisible by ``ANCHOR_EVERY``; the positives of an anchor are its best
``POSITIVES`` other rows of its label, and for each positive the best ``NEGATIVES`` rows of other labels are
wanted whose score lies in the window LOW % to HIGH % of the positive's. Both are searches for
the best k rows of some windows of scores, and run in the same way:

Candidates are dealt into blocks. A block keeps, for each dimension, its rows sorted by that
component. A chunk of anchors reads the lists from the end that the sign of the anchor's
component names, deeper in rounds that double; rows that come up are scored in full (random
access), for all anchors of the chunk in one product. What no list has brought up scores at most the
threshold, the product of the anchor with the components at the depth reached. An anchor is done
once its threshold is strictly below the k-th score of each of its windows (while a window has
fewer rows: below its lower end). Each block gives its best rows; those of all blocks are ranked.
Every block meets every chunk of anchors (a stated query set against all rows, in blocks): chunks
are sent to each block's task and follow the block there, one after the other. Blocks and chunks
are rows of bounded size; a task holds one block and one chunk.

Rows with a null label, a null vector, or a null or non-finite component take no part. Vectors of
different lengths are multiplied as far as both go. A row that repeats as a whole (id, label, vector)
counts once. Ties go to the smaller id, a null id comes last, then to the smaller label; rows that
share an id are told apart by label and vector. Scores outside 64 bits are given as the nearest
64-bit integer. Vectors of any length are used whole; a block is cut by bytes. Empty tables give
no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roomstar.session import checkpoint_dir

SCALE = 256.0
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90          # per cent of the positive's score
BLOCK_VALUES = 1 << 19      # components of a block of candidates
CHUNK_VALUES = 1 << 14      # components of a chunk of anchors
FIRST_DEPTH = 16
NO_ID = (1 << 63) - 1
LEAST = -(1 << 63)


def scaled(raw: np.ndarray) -> np.ndarray:
    """floor(256 * x) as doubles (exact: a power of two times a double, rounded down)."""
    return np.floor(SCALE * raw)


class Block:
    """Rows sorted by (id, label) and, for each dimension, the row numbers by ascending component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray) -> None:
        order = np.lexsort((labels, ids))
        self.ids, self.labels, self.values = ids[order], labels[order], values[order]
        self.lists = np.argsort(self.values, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(self.values, self.lists, axis=0)
        self.most = float(np.abs(self.values).max(initial=0))


def number_type(bound: float) -> type:
    """The fastest type that holds whole numbers up to a bound exactly; Python's integers beyond 2^53."""
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object


def whole(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return values.astype(kind)
    return np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


class Windows:
    """The best k rows seen so far, for each anchor and window: score and row number, best first."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int) -> None:
        self.low, self.high, self.k = low, high, k  # anchors x windows; low > high: nothing fits
        self.score = np.full((*low.shape, 0), 0, np.int64)
        self.row = np.full((*low.shape, 0), 0, np.int64)

    def add(self, score: np.ndarray, rows: np.ndarray, allowed: np.ndarray, at: np.ndarray) -> None:
        """Rows (ascending) with their scores (anchors ``at`` x rows) where ``allowed``."""
        pad = max(0, self.k - self.score.shape[2])
        if pad:
            self.score = np.pad(self.score, ((0, 0), (0, 0), (0, pad)), constant_values=LEAST)
            self.row = np.pad(self.row, ((0, 0), (0, 0), (0, pad)), constant_values=-1)
        for w in range(self.low.shape[1]):
            fits = allowed & (score >= self.low[at, w, None]) & (score <= self.high[at, w, None])
            fits &= (score > self.score[at, w, -1:]) | (self.row[at, w, -1:] < 0) | (score == self.score[at, w, -1:])
            for i in np.flatnonzero(fits.any(axis=1)):
                new = np.flatnonzero(fits[i])
                s = np.concatenate([self.score[at[i], w], score[i, new]])
                r = np.concatenate([self.row[at[i], w], rows[new]])
                held = r >= 0
                s, r = s[held], r[held]
                best = np.lexsort((r, -s))[:self.k]
                self.score[at[i], w, :len(best)], self.row[at[i], w, :len(best)] = s[best], r[best]

    def open(self, threshold: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Whether an unseen row, which scores at most the threshold, may still belong to a window."""
        if not self.score.shape[2]:
            return np.ones(len(at), bool)
        full = self.row[at, :, -1] >= 0
        need = np.where(full, np.maximum(self.score[at, :, -1], self.low[at]), self.low[at])
        return ((threshold[:, None] >= need) & (self.low[at] <= self.high[at])).any(axis=1)


def clipped(score: np.ndarray) -> np.ndarray:
    if score.dtype != object:
        return score.astype(np.int64)
    return np.clip(score, LEAST + 1, NO_ID).astype(np.int64)


def best_rows(block: Block, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, windows: Windows,
              same_label: bool) -> int:
    """Fill ``windows`` (one row for each anchor) from a block; returns the number of rows scored."""
    n, dims = len(block.ids), min(vectors.shape[1], block.values.shape[1])
    kind = number_type(block.most * float(np.abs(vectors).sum(axis=1).max(initial=0)))
    anchor = whole(vectors[:, :dims], kind)
    values, ordered = whole(block.values[:, :dims], kind), whole(block.sorted[:, :dims], kind)
    up, down = np.where(anchor > 0, anchor, 0), np.where(anchor < 0, anchor, 0)
    seen = np.zeros(n, bool)
    active = np.flatnonzero((windows.low <= windows.high).any(axis=1))
    depth, scored = 0, 0
    while len(active) and depth < n:
        deeper = min(n, max(FIRST_DEPTH, 2 * depth))
        new = np.zeros(n, bool)
        new[block.lists[n - deeper:n - depth, :dims][:, (up[active] != 0).any(axis=0)].ravel()] = True
        new[block.lists[depth:deeper, :dims][:, (down[active] != 0).any(axis=0)].ravel()] = True
        if deeper == n:  # also rows that only zero components of the anchors lead to
            new[:] = True
        new &= ~seen
        seen |= new
        rows = np.flatnonzero(new)
        depth = deeper
        if len(rows):
            scored += len(rows)
            score = clipped(anchor[active] @ values[rows].T)
            allowed = (labels[active, None] == block.labels[rows]) == same_label
            if same_label:  # an anchor is not its own positive
                own = (ids[active, None] == block.ids[rows]) & allowed
                for a, r in zip(*np.nonzero(own), strict=True):
                    full, whole_row = vectors[active[a]], block.values[rows[r]]
                    allowed[a, r] = not (len(full) == len(whole_row) and (full == whole_row).all())
            windows.add(score, rows, allowed, active)
        threshold = clipped(up[active] @ ordered[n - deeper] + down[active] @ ordered[deeper - 1])
        active = active[windows.open(threshold, active)]
    return scored


# --- Spark side -------------------------------------------------------------------------------


def candidates(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, vec``: the rows that take part, relabelled, each once."""
    vec = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    label = F.col(f"`{label_col}`").cast("long")
    moved = F.coalesce(F.col(f"`{id_col}`").cast("long") % RELABEL_EVERY == 0, F.lit(False))
    return (vectors.where(label.isNotNull() & vec.isNotNull() & ~F.coalesce(bad, F.lit(False)))
            .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                    F.when(moved, (label + 1) % LABELS).otherwise(label).alias("label"), vec.alias("vec"))
            .dropDuplicates(["vec_id", "label", "vec"]))


PACKED = "part long, dims long, ids binary, labels binary, vecs binary"


def _packed(rows: DataFrame, part: Column) -> DataFrame:
    """One row for each part and vector length: ids, labels and scaled components as arrays of bytes."""
    def pack(key, group):
        group = group.combine_chunks()
        ids = group["vec_id"].fill_null(NO_ID).to_numpy()
        values = scaled(pa.array(group["vec"].combine_chunks().flatten()).to_numpy()) if key[1].as_py() else np.zeros(0)
        body = (ids, group["label"].to_numpy(), values)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "dims": pa.array([key[1].as_py()], pa.int64()),
                         **{n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(("ids", "labels", "vecs"), body, strict=True)}})

    return (rows.withColumn("part", part).withColumn("dims", F.size("vec").cast("long"))
            .groupBy("part", "dims").applyInArrow(pack, PACKED))


def _arrays(ids: bytes, labels: bytes, vecs: bytes, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(labels, np.int64), np.frombuffer(vecs, np.float64).reshape(len(i), dims)


def _parts(rows: DataFrame, values: int) -> int:
    total = rows.agg(F.sum(F.size("vec") + 2).alias("v")).first()["v"] or 0
    return -(-total // values)


FOUND = ("chunk long, chunk_dims long, anchor int, anchor_id long, window int, vec_id long, label long, "
         "score long")


def _search(blocks: DataFrame, chunks: DataFrame, n_blocks: int, k: int, same_label: bool) -> DataFrame:
    """FOUND of the best k rows of each block, for each anchor and window. ``chunks`` has the columns of
    PACKED and ``low``, ``high``: ``width`` windows of each anchor as arrays of bytes; null: one window
    of all scores."""
    sent = chunks.select(F.explode(F.expr(f"sequence(0L, {max(0, n_blocks - 1)}L)")).alias("to"),
                         F.lit(1).alias("kind"), *chunks.columns)
    here = blocks.select(F.col("part").alias("to"), F.lit(0).alias("kind"), *blocks.columns)
    stream = (here.unionByName(sent, allowMissingColumns=True)
              .repartition("to").sortWithinPartitions("to", "kind", "dims"))

    def run(batches):
        at, held = None, []  # the blocks of the part at hand: one for each vector length
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["to"] != at:
                    at, held = row["to"], []
                if not row["kind"]:
                    held.append(Block(*_arrays(row["ids"], row["labels"], row["vecs"], row["dims"])))
                    continue
                ids, labels, vectors = _arrays(row["ids"], row["labels"], row["vecs"], row["dims"])
                if row["low"] is None:
                    low, high = np.full((len(ids), 1), LEAST + 1), np.full((len(ids), 1), NO_ID)
                else:
                    low, high = (np.frombuffer(row[c], np.int64).reshape(len(ids), row["width"]) for c in ("low", "high"))
                for block in held:
                    windows = Windows(low, high, k)
                    best_rows(block, ids, labels, vectors, windows, same_label)
                    anchor, window, place = np.nonzero(windows.row >= 0)
                    rows = windows.row[anchor, window, place]
                    found = block.ids[rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), row["part"])), pa.array(np.full(len(rows), row["dims"])),
                         pa.array(anchor.astype(np.int32)), pa.array(ids[anchor]), pa.array(window.astype(np.int32)),
                         pa.array(found, mask=found == NO_ID), pa.array(block.labels[rows]),
                         pa.array(windows.score[anchor, window, place])],
                        [c.split()[0] for c in FOUND.split(", ")])

    best = Window.partitionBy("chunk", "chunk_dims", "anchor", "window").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "label")
    return stream.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _with_windows(chunks: DataFrame, positives: DataFrame) -> DataFrame:
    """Chunks with the windows of their anchors' positives; a window without a positive is empty."""
    listed = positives.groupBy("chunk", "chunk_dims").agg(
        F.collect_list(F.struct("anchor", "rank", "score")).alias("found"))
    joined = chunks.join(listed, (chunks.part == listed.chunk) & (chunks.dims == listed.chunk_dims), "left")

    def run(batches):
        for batch in batches:
            low, high = [], []
            for ids, found in zip(batch.column("ids"), batch.column("found"), strict=True):
                lo = np.ones((len(ids.as_py()) // 8, POSITIVES), np.int64)
                hi = np.zeros((len(lo), POSITIVES), np.int64)
                for f in found.as_py() or ():
                    lo[f["anchor"], f["rank"] - 1] = -(-LOW * f["score"] // 100)
                    hi[f["anchor"], f["rank"] - 1] = HIGH * f["score"] // 100
                low.append(lo.tobytes())
                high.append(hi.tobytes())
            kept = batch.schema.names[:5]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(low, pa.binary()), pa.array(high, pa.binary()),
                 pa.array(np.full(len(low), POSITIVES, np.int32))], [*kept, "low", "high", "width"])

    return joined.select(*chunks.columns, "found").mapInArrow(run, PACKED + ", low binary, high binary, width int")


def mine(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` and
    ``positive_rank``, the place of the positive among its anchor's."""
    spark = vectors.sparkSession
    checkpoint_dir(spark)
    rows = candidates(vectors, id_col, vector_col, label_col)
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    dealt = F.xxhash64("vec_id", "label", "vec")
    n_blocks, n_chunks = _parts(rows, BLOCK_VALUES), _parts(anchors, CHUNK_VALUES)
    blocks = _packed(rows, F.pmod(dealt, F.lit(max(1, n_blocks)))).checkpoint()
    # The number of an anchor in its chunk names it in both searches: the chunks are kept.
    chunks = _packed(anchors, F.pmod(dealt, F.lit(max(1, n_chunks)))).checkpoint()

    open_windows = chunks.selectExpr("*", "cast(null AS binary) AS low", "cast(null AS binary) AS high", "1 AS width")
    positives = _search(blocks, open_windows, n_blocks, POSITIVES, True).drop("window").checkpoint()
    negatives = _search(blocks, _with_windows(chunks, positives), n_blocks, NEGATIVES, False)
    key = ["chunk", "chunk_dims", "anchor", "positive_rank"]
    pos = positives.select("chunk", "chunk_dims", "anchor", F.col("rank").alias("positive_rank"),
                           F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    neg = negatives.select("chunk", "chunk_dims", "anchor", (F.col("window") + 1).alias("positive_rank"), "anchor_id", "rank",
                           F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return neg.join(pos, key).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                     "negative_score", "positive_rank")
