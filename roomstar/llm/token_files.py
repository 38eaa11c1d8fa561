"""Token-id shard files with Elias-Fano encoded document boundaries.

A shard holds whole documents in ascending id order:

    magic "EFT1" | bytes per id (u32) | end id (u32) | Elias-Fano boundaries | ids

The boundaries are the n + 1 offsets 0 = o[0] <= ... <= o[n] into the id array. Each offset's
low bits are packed; its high part h is bit h + i of a bit vector, which has n + 1 ones in about
2 n bits. ``select(i)`` finds the i-th one through counts per 512-bit block and returns the
offset, in about 2 + log2(ids / documents) bits per document where a table would take 64. Ids
take two bytes if the vocabulary allows it, else four.

Shards are the rows of a Parquet table (bucket, part, start inside the bucket, document ids and
the shard's bytes), so Spark's commit protocol writes them to any shared store and a lost task
leaves nothing behind.
"""

from __future__ import annotations

import struct
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomstar.llm.bpe import worker_encoder
from roomstar.llm.columns import id_and_text
from roomstar.llm.order import in_order
from roomstar.llm.text import slices

MAGIC = b"EFT1"
SHARD_IDS = 2 << 20  # a shard ends with the document that reaches this many ids
BLOCK = 512          # bits per counted block of the select structure


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    if not bits:
        return np.zeros(0, np.uint8)
    each = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(each.astype(np.uint8).ravel(), bitorder="little")


class EliasFano:
    """A non-decreasing sequence of non-negative integers; ``select`` returns elements by index."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, counts: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.counts = n, low_bits, low, high, counts

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = _pack(v & np.uint64((1 << low_bits) - 1), low_bits)
        at = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        size = (int(at[-1]) + 1 if n else 0)
        bits = np.zeros(-(-size // BLOCK) * BLOCK, np.uint8)
        bits[at] = 1
        counts = np.concatenate([[0], np.cumsum(bits.reshape(-1, BLOCK).sum(1, dtype=np.int64))])
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), counts.astype(np.uint32))

    def select(self, index) -> np.ndarray:
        """Elements at the given indexes."""
        index = np.asarray(index, np.int64)
        if not index.size:
            return np.zeros(index.shape, np.int64)
        block = np.searchsorted(self.counts, index, "right") - 1
        rows = self.high.reshape(-1, BLOCK // 8)[block]
        bits = np.unpackbits(rows, axis=1, bitorder="little")
        inside = index - self.counts[block].astype(np.int64)
        at = (np.cumsum(bits, axis=1, dtype=np.int32) == (inside + 1)[:, None]).argmax(1)
        high = block * BLOCK + at - index
        low = np.zeros(len(index), np.int64)
        for b in range(self.low_bits):
            bit = index * self.low_bits + b
            low |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.int64) << b
        return (high << self.low_bits) | low

    def to_bytes(self) -> bytes:
        head = struct.pack("<QIQQQ", self.n, self.low_bits, len(self.low), len(self.high), len(self.counts))
        return head + self.low.tobytes() + self.high.tobytes() + self.counts.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that starts at ``at``, and where it ends."""
        n, low_bits, n_low, n_high, n_counts = struct.unpack_from("<QIQQQ", raw, at)
        at += struct.calcsize("<QIQQQ")
        low = np.frombuffer(raw, np.uint8, n_low, at)
        high = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        counts = np.frombuffer(raw, "<u4", n_counts, at + n_low + n_high)
        return cls(n, low_bits, low, high, counts), at + n_low + n_high + 4 * n_counts


def pack_shard(ids: np.ndarray, offsets: np.ndarray, width: int, end_id: int) -> bytes:
    return (MAGIC + struct.pack("<II", width, end_id) + EliasFano.encode(offsets).to_bytes()
            + ids.astype(f"<u{width}").tobytes())


class Shard:
    """Reads a shard: any document's ids through two select calls."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != MAGIC:
            raise ValueError("not a token shard")
        width, self.end_id = struct.unpack_from("<II", raw, 4)
        self.bounds, at = EliasFano.from_bytes(raw, 12)
        self.n_docs = max(0, self.bounds.n - 1)
        self.ids = np.frombuffer(raw, f"<u{width}", offset=at)

    def offsets(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of the given documents in ``ids``."""
        return self.bounds.select(docs), self.bounds.select(np.asarray(docs) + 1)

    def document(self, i: int) -> np.ndarray:
        (start,), (end,) = self.offsets(np.array([i]))
        return self.ids[start:end]


SHARDS = "bucket long, part int, start long, n_ids long, doc_ids array<long>, data binary"


def _append_end(ids: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(at) - 1
    out = np.insert(ids, at[1:], end_id)
    return out, at + np.arange(n + 1)


def write_shards(docs: DataFrame, spec: str, path: str, end_id: int = 2, vocabulary: int = 1 << 16,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text (null: empty), append ``end_id`` to each and write shards to ``path``
    in ascending (id, text) order; null ids come first, repeated rows are all kept, an empty
    table writes no shard. ``vocabulary`` bounds the ids and sets their width."""
    width = 2 if max(vocabulary - 1, end_id) < 1 << 16 else 4
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        encoder = worker_encoder(shared.value)
        bucket, part, start = None, 0, 0
        held: list[tuple[np.ndarray, np.ndarray, list]] = []  # ids, lengths, document ids

        def shard():
            ids = np.concatenate([h[0] for h in held])
            bounds = np.concatenate([[0], np.cumsum(np.concatenate([h[1] for h in held]))])
            doc_ids = [d for h in held for d in h[2]]
            return pa.RecordBatch.from_pylist(
                [{"bucket": bucket, "part": part, "start": start, "n_ids": len(ids), "doc_ids": doc_ids,
                  "data": pack_shard(ids, bounds, width, end_id)}],
                schema=pa.schema([("bucket", pa.int64()), ("part", pa.int32()), ("start", pa.int64()),
                                  ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                                  ("data", pa.binary())]))

        for piece in slices(batches, "text"):
            where = piece.column("_bucket").to_numpy()
            for lo, hi in _runs(where):
                if bucket is not None and where[lo] != bucket:
                    if held:
                        yield shard()
                    held, part, start = [], 0, 0
                bucket = int(where[lo])
                rows = piece.slice(lo, hi - lo)
                ids, at = _append_end(*encoder.encode(rows.column("text")), end_id)
                held.append((ids, np.diff(at), rows.column("doc_id").to_pylist()))
                size = sum(len(h[0]) for h in held)
                if size >= SHARD_IDS:
                    yield shard()
                    held, part, start = [], part + 1, start + size
        if held:
            yield shard()

    (in_order(id_and_text(docs, id_col, text_col)).drop("_ahead").mapInArrow(run, SHARDS)
     .write.mode("overwrite").option("compression", "zstd").parquet(path))


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.diff(values)) + 1
    return list(zip([0, *cut], [*cut, len(values)], strict=True))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per written document: ``doc_id, start`` (ids of all documents before it),
    ``n_tokens`` and ``ids binary`` (little-endian u32, end id included). Only one total per
    bucket reaches the driver."""
    shards = spark.read.schema(SHARDS).parquet(path)
    totals = sorted((r["bucket"], r["n"]) for r in
                    shards.groupBy("bucket").agg(F.sum("n_ids").alias("n")).collect())
    before = dict(zip([b for b, _ in totals], accumulate([0, *(n for _, n in totals)]), strict=False))
    shared = spark.sparkContext.broadcast(before)

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch.column("data")[row].as_buffer().to_pybytes())
                base = shared.value[batch.column("bucket")[row].as_py()] + batch.column("start")[row].as_py()
                start, end = shard.offsets(np.arange(shard.n_docs))
                doc_ids = batch.column("doc_ids")[row].values
                wide = np.ascontiguousarray(shard.ids.astype("<u4"))
                at = np.append(start, end[-1:]) * 4
                ids = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), shard.n_docs,
                    [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(wide.view(np.uint8))])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, pa.array(base + start), pa.array(end - start), ids.cast(pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return shards.select("bucket", "start", "doc_ids", "data").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")
