"""Quality classifier: similarity-weighted votes of the nearest labelled documents in a latent
semantic space.

A text becomes counts of hashed terms: its words, trigrams of its character classes (runs of
one class count once) and repeats of words and lines. The counts are weighted by inverse
document frequency and each group is brought to length one. A bounded sample of labelled
documents (``SAMPLE`` of each class, those with the smallest hashed ids) gives the latent
space, a truncated singular value decomposition, and the labelled vectors. Both are broadcast;
their size depends on the parameters below alone. Every document is then compared with all
labelled vectors in blocks of exact cosine products.

Empty and null texts have no terms and get the share of label 1 among the labels learned from;
so does every text if there are no labels of both classes (0.5 if there are none at all).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomstar.llm.columns import id_and_text
from roomstar.llm.text import U64, SpanHash, lower_ascii, slices, spans, utf8

SAMPLE = 2048        # labelled documents of each class, at most
WORDS, SHAPES = 1024, 512
DIMENSIONS = 64
NEIGHBOURS = 25
BLOCK = 1024         # labelled vectors of one cosine block
PIECE = 1 << 20
GROUPS = ((0, WORDS, 0.5), (WORDS, WORDS + SHAPES, 1.0), (WORDS + SHAPES, WORDS + SHAPES + 4, 1.0))
TERMS = GROUPS[-1][1]


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, np.uint8)  # 0: lower-case letters and all non-ASCII bytes
    table[65:91] = 1
    table[48:58] = 2
    table[[9, 32]] = 3
    table[[10, 13]] = 4
    other = [b for b in range(128) if not (chr(b).isalnum() or b in (9, 10, 13, 32))]
    table[other] = 5 + np.arange(len(other)) % 59
    return table


_CLASSES = _byte_classes()


def terms(column) -> np.ndarray:
    """Term counts, one row per text (float32)."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    if not len(data):
        return np.zeros((n, TERMS), np.float32)
    out = np.zeros(n * TERMS, np.int64)

    def add(owner, term):
        out.__iadd__(np.bincount(owner * TERMS + term, minlength=n * TERMS))

    start, end, owner = spans(data > 32, offsets)
    word = SpanHash(lower_ascii(data)).of(start, end)
    add(owner, (word >> U64(40)).astype(np.int64) % WORDS)
    same = np.zeros(len(word), bool)
    same[1:] = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    add(owner, WORDS + SHAPES + same)
    cls = _CLASSES[data]
    new = np.ones(len(cls), bool)
    new[1:] = cls[1:] != cls[:-1]
    new[offsets[:-1][offsets[:-1] < len(cls)]] = True
    runs = np.flatnonzero(new)
    c = cls[runs].astype(np.int64)
    text = np.searchsorted(offsets, runs, "right") - 1
    if len(c) > 2:
        inside = text[2:] == text[:-2]
        code = ((c[:-2] * 64 + c[1:-1]) * 64 + c[2:]) * 0x9E3779B1
        add(text[2:][inside], WORDS + (code[inside] >> 7) % SHAPES)
    start, end, owner = spans(data != 10, offsets)
    line = SpanHash(data).of(start, end)
    order = np.lexsort((line, owner))
    twin = np.zeros(len(line), bool)
    twin[order[1:]] = (line[order[1:]] == line[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    add(owner, WORDS + SHAPES + 2 + twin)
    return out.reshape(n, TERMS).astype(np.float32)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted terms with each group scaled to its share of the length."""
    x = counts * idf
    for lo, hi, share in GROUPS:
        size = np.linalg.norm(x[:, lo:hi], axis=1, keepdims=True)
        x[:, lo:hi] *= share / np.maximum(size, 1e-12)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


class Model:
    """Latent space, labelled vectors, their labels and class weights."""

    def __init__(self, counts: np.ndarray, label: np.ndarray, prior: float) -> None:
        self.prior = prior
        self.empty = len(np.unique(label)) < 2
        if self.empty:
            return
        df = (counts > 0).sum(0)
        self.idf = np.log((1 + len(counts)) / (1 + df)).astype(np.float32) + 1
        x = weigh(counts, self.idf)
        _, v = np.linalg.eigh(x.T.astype(np.float64) @ x)
        self.basis = np.ascontiguousarray(v[:, ::-1][:, :DIMENSIONS]).astype(np.float32)
        self.vectors = _unit(x @ self.basis)
        self.label = label
        # The sample has the classes in other shares than the labels have.
        share = label.mean()
        self.weight = np.where(label == 1, prior / share, (1 - prior) / (1 - share))

    def score(self, counts: np.ndarray) -> np.ndarray:
        if self.empty:
            return np.full(len(counts), self.prior)
        y = _unit(weigh(counts, self.idf) @ self.basis)
        best = np.full((len(y), 0), 0, np.float32)
        which = np.full((len(y), 0), 0, np.int64)
        for lo in range(0, len(self.vectors), BLOCK):
            sim = y @ self.vectors[lo:lo + BLOCK].T
            best = np.concatenate([best, sim], axis=1)
            which = np.concatenate([which, np.broadcast_to(np.arange(lo, lo + sim.shape[1]), sim.shape)], axis=1)
            if best.shape[1] > NEIGHBOURS:
                top = np.argpartition(-best, NEIGHBOURS - 1, axis=1)[:, :NEIGHBOURS]
                best, which = np.take_along_axis(best, top, 1), np.take_along_axis(which, top, 1)
        vote = np.maximum(best, 0).astype(np.float64) ** 8 * self.weight[which]
        total = vote.sum(1)
        some = (counts.sum(1) > 0) & (total > 0)
        out = np.full(len(counts), self.prior)
        out[some] = (vote * self.label[which]).sum(1)[some] / total[some]
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents of each class, from label rows where
    ``usable`` holds. Null ids and labels do not count; of repeated labels the smallest does."""
    known = (labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("doc_id"))
             .agg(F.min(F.col(label_col).cast("int")).alias("label")))
    share = known.agg(F.avg("label").alias("p")).first()["p"]
    prior = 0.5 if share is None else float(share)
    spark = docs.sparkSession
    picked = {}
    for value in (0, 1):
        rows = (known.where(F.col("label") == value)
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id").collect())
        picked |= {r["doc_id"]: value for r in rows}
    if not picked:
        return Model(np.zeros((0, TERMS), np.float32), np.zeros(0), prior)
    ids = spark.createDataFrame([(i,) for i in picked], "doc_id long")  # at most 2 * sample rows

    def count(batches):
        for part in slices(batches, "text", PIECE):
            x = terms(part.column("text"))
            flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(TERMS * 4), len(x), [None, pa.py_buffer(x)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), flat.cast(pa.binary())], ["doc_id", "terms"])

    rows = (id_and_text(docs, id_col, text_col).join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"))
            .mapInArrow(count, "doc_id long, terms binary").orderBy("doc_id").collect())
    counts = np.array([np.frombuffer(r["terms"], np.float32) for r in rows]).reshape(-1, TERMS)
    return Model(counts, np.array([picked[r["doc_id"]] for r in rows]), prior)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, score`` (0 to 1; higher: label 1 likelier)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part in slices(batches, "text", PIECE):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(shared.value.score(terms(part.column("text"))))],
                ["doc_id", "score"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
