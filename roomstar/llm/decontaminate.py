"""Benchmark decontamination with one FM-index per shard of the training documents.

A window is ``WINDOW`` consecutive words of a benchmark item, or a whole shorter item. Each
task gathers shards of documents. Words that no window has become separators, and pieces
between them that are shorter than the shortest window are left out: no window can occur there.
The rest of the shard is indexed; all windows are searched backwards at once through
wavelet-tree ranks, their occurrences are located from sampled suffix positions, and the
covered words are merged into spans.

Words are lower-cased (A to Z) runs of letters, digits and all non-ASCII characters. Null and
empty texts have no words; items without words have no windows; an item's null id counts as the
empty string. Repeated rows are judged each.

The benchmark is a fixed evaluation set. It reaches the tasks in blocks of at most
``BLOCK_BYTES`` of text; a task holds one block at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomstar.llm.columns import handed_on, id_and_text
from roomstar.llm.fm_index import FMIndex
from roomstar.llm.text import SpanHash, per_text, ranges, slices, spans, utf8

WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_SYMBOLS = 1 << 19  # a shard ends with the batch that reaches this many symbols
SHARD_WORDS = 1 << 22    # or this many words

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start byte, end byte, text index) of every word."""
    data, offsets = utf8(column)
    data = _FOLD[data]
    start, end, owner = spans(_WORD[data], offsets)
    return SpanHash(data).of(start, end), start - offsets[owner], end - offsets[owner], owner


class Phrases:
    """The distinct windows of a block of benchmark items, as rows of symbols 1..top."""

    def __init__(self, item_ids: list[str], texts: list[str | None], window: int) -> None:
        hashed, _, _, owner = words(pa.array(texts, pa.string()))
        at = per_text(owner, len(texts))
        self.vocabulary = np.unique(hashed)
        symbol = np.searchsorted(self.vocabulary, hashed) + 1
        rows: dict[tuple, set[str]] = {}
        for i, item in enumerate(item_ids):
            s = symbol[at[i]:at[i + 1]].tolist()
            for k in range(max(1, len(s) - window + 1) if s else 0):
                rows.setdefault(tuple(s[k:k + window]), set()).add(item)
        self.length = np.array([len(r) for r in rows], np.int64)
        self.symbols = np.zeros((len(rows), window), np.int64)
        for i, r in enumerate(rows):
            self.symbols[i, :len(r)] = r
        self.items = [sorted(v) for v in rows.values()]
        self.shortest = int(self.length.min(initial=window))

    def symbols_of(self, hashed: np.ndarray) -> np.ndarray:
        """Symbol of each word; 0 if no window has it."""
        if not len(self.vocabulary):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashed), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashed, at + 1, 0)


def find(phrases: Phrases, symbol: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, index of its first word) of every occurrence of a phrase in a shard's words;
    ``owner`` is each word's document."""
    none = np.zeros(0, np.int64)
    offsets = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else none
    start, end, _ = spans(symbol > 0, np.append(offsets, len(symbol))) if len(symbol) else (none, none, none)
    long = end - start >= phrases.shortest
    start, end = start[long], end[long]
    if not len(start):
        return none, none
    # Pieces one after the other, each followed by a separator.
    size = end - start + 1
    at = np.cumsum(size) - size
    seq = np.zeros(int(size.sum()), np.int64)
    index = ranges(at, size - 1)
    seq[index] = symbol[ranges(start, size - 1)]
    fm = FMIndex(seq, len(phrases.vocabulary))
    lo, hi = fm.search(phrases.symbols, phrases.length)
    phrase = np.repeat(np.arange(len(lo)), hi - lo)
    position = fm.locate(ranges(lo, hi - lo))
    piece = np.searchsorted(at, position, "right") - 1
    return phrase, start[piece] + position - at[piece]


SPANS = "array<struct<first:int,end:int,start_byte:int,end_byte:int>>"


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
             text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
             keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: its number of words, how many lie in occurrences of benchmark
    windows, their merged spans (words first..end, end exclusive, and the bytes they cover in
    the text), the sorted ids of the items with an occurring window, and the ``keep`` columns."""
    rows = id_and_text(docs, id_col, text_col, keep)
    schema, names = handed_on(rows, "doc_id long, n_words long, n_hit long", keep)
    schema = schema.replace("n_hit long", "n_hit long, spans " + SPANS + ", item_ids array<string>")
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(item_text_col).cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    blocks = []
    for b in range(n_blocks):
        block_items = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == b).collect()
        blocks.append(spark.sparkContext.broadcast(
            ([r["item"] for r in block_items], [r["text"] for r in block_items], window)))

    def run(batches):
        cached: list[tuple[int, Phrases]] = []  # the block at hand

        def block(i: int) -> Phrases:
            if not cached or cached[0][0] != i:
                cached[:] = [(i, Phrases(*blocks[i].value))]
            return cached[0][1]

        held, n_words, n_symbols = [], 0, 0
        for part in slices(batches, "text"):
            hashed, lo, hi, owner = words(part.column("text"))
            held.append((part.select(["doc_id", *names]), hashed, lo, hi, owner))
            n_words += len(hashed)
            n_symbols += int((block(0).symbols_of(hashed) > 0).sum()) if n_blocks == 1 else len(hashed)
            if n_symbols >= SHARD_SYMBOLS or n_words >= SHARD_WORDS:
                yield from _judge(held, n_blocks, block)
                held, n_words, n_symbols = [], 0, 0
        if held:
            yield from _judge(held, n_blocks, block)

    return rows.mapInArrow(run, schema)


def _judge(held: list, n_blocks: int, block):
    """Result batches of a shard's documents."""
    rows = pa.Table.from_batches([h[0] for h in held])
    n = rows.num_rows
    base = np.cumsum([0, *(h[0].num_rows for h in held)])
    hashed, lo, hi = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
    owner = np.concatenate([h[4] + b for h, b in zip(held, base, strict=False)])
    cover = np.zeros(len(hashed) + 1, np.int64)
    hits: dict[int, set[str]] = {}
    for b in range(n_blocks):
        phrases = block(b)
        phrase, first = find(phrases, phrases.symbols_of(hashed), owner)
        np.add.at(cover, first, 1)
        np.add.at(cover, first + phrases.length[phrase], -1)
        pair = np.unique(np.stack([owner[first], phrase]), axis=1) if len(first) else np.zeros((2, 0), np.int64)
        for d, p in pair.T.tolist():
            hits.setdefault(d, set()).update(phrases.items[p])
    hit = np.cumsum(cover)[:-1] > 0
    at = per_text(owner, n)
    n_hit = np.bincount(owner[hit], minlength=n)
    start, end, _ = spans(hit, at)
    whose = owner[start] if len(start) else start
    span = pa.StructArray.from_arrays(
        [pa.array(x.astype(np.int32)) for x in (start - at[whose], end - at[whose], lo[start], hi[end - 1])],
        ["first", "end", "start_byte", "end_byte"])
    lists = pa.ListArray.from_arrays(pa.array(per_text(whose, n).astype(np.int32)), span)
    items = pa.array([sorted(hits.get(d, ())) for d in range(n)], pa.list_(pa.string()))
    own = [pa.array(np.diff(at)), pa.array(n_hit), lists, items]
    yield from pa.table([rows.column(0), *own, *rows.columns[1:]],
                        ["doc_id", "n_words", "n_hit", "spans", "item_ids", *rows.column_names[1:]]).to_batches()


def contaminated() -> Column:
    """The rule of a contaminated document: words are hit, and they are a twentieth or more."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
