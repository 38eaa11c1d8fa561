"""Ranked lexical search by a dual-tree: the best documents of every benchmark item, exactly.

An item is the set of its terms with their weights, a document the set of the item terms that it
holds with their impacts; a score is the sum of weight times impact over the common terms (all in
64-bit integers, weights and impacts are never negative). Both sides are hierarchies whose nodes
hold the greatest weight and the greatest impact of each term below them, so the product of two
nodes bounds every score between them. A pair of nodes is opened only if its bound reaches
the weakest k-th score of the items below the item node; otherwise all its pairs are pruned at
once. A bound equal to a k-th score is opened too, as the smaller id wins among equal scores.

1. One pass over the texts keeps ``(doc_id, n, terms, counts)`` of the item terms, and the
   number of terms ``n``; it is written to the shared folder and read twice.
2. Documents with a term, all their terms, and the documents that hold each item term are counted.
3. Tasks read documents in batches (``BATCH_VALUES`` numbers at most), sort a batch by the term with the greatest
   impact times weight (like documents share a leaf), build its tree and search it with the item
   tree. The k-th scores of an item live on over the batches of a task.
4. The tasks' best rows of an item are ranked in two steps, by (item, task group) and by item.

The items are read in blocks of at most ``BLOCK_BYTES`` of text; each block is its own search, so
neither the driver nor a task holds more than one. Terms are runs of letters, digits and non-ASCII
characters, A to Z lower-cased. Null and empty texts have none and are never found; an item without
terms has no rows. Rows that repeat an item's id and text are one item; document rows that repeat
each take a rank. A null document id comes after all others. Empty tables give no rows. Texts
are read whole, whatever their length; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roomstar.llm.columns import id_and_text
from roomstar.session import work_dir

TOP = 50
BLOCK_BYTES = 1 << 18
BATCH_VALUES = 1 << 22  # documents of a batch times item terms
BATCH_DOCS = 1024
LEAF_DOCS = 32
LEAF_ITEMS = 8
FAN = 4
GROUPS = 64
NO_ID = (1 << 63) - 1  # stands for a null id inside a task

_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[48:58] = _TERM_BYTE[65:91] = _TERM_BYTE[97:123] = _TERM_BYTE[128:] = True
_FOLD = bytes(32 if not _TERM_BYTE[b] else b + 32 if 65 <= b <= 90 else b for b in range(256))


def terms(text: str | bytes | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8. Every byte that is in no term becomes a space."""
    body = text.encode() if isinstance(text, str) else text or b""
    return body.translate(_FOLD).split()


def weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def length_factor(n: int, n_docs: int, all_terms: int) -> int:
    """What a document of n terms adds to its counts: 100 - 50 + 50 * (n over the mean), rounded down."""
    return 50 + (50 * n * n_docs) // all_terms


def number_type(weights: np.ndarray) -> type:
    """Doubles while every score is a whole number below 2^53, else 64-bit integers."""
    return np.float64 if int(weights.sum()) * 1_000_000 < 1 << 53 else np.int64


def _grouped(values: np.ndarray, size: int) -> np.ndarray:
    """Greatest value of each run of ``size`` columns."""
    return np.maximum.reduceat(values, np.arange(0, values.shape[1], size), axis=1)


class DocumentTree:
    """Greatest impact of each term over runs of documents; the top level has at most FAN nodes."""

    def __init__(self, impacts: np.ndarray) -> None:
        self.levels = [_grouped(impacts, LEAF_DOCS)]
        while self.levels[-1].shape[1] > FAN:
            self.levels.append(_grouped(self.levels[-1], FAN))

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Nodes of the level below."""
        below = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return below[below < self.levels[level - 1].shape[1]]


class ItemNode:
    """Items first..end: their terms, each one's greatest weight, and the nodes or items below."""

    def __init__(self, first: int, end: int, term: np.ndarray, most: np.ndarray) -> None:
        self.first, self.end, self.term, self.most = first, end, term, most
        self.below: list[ItemNode] = []
        self.weights = most[:0, None]  # of a leaf: a row for each item, a column for each of its terms


def _leaf(first: int, items: list[list[int]], weights: np.ndarray) -> ItemNode:
    used = np.unique(np.concatenate([np.array(t, np.int64) for t in items]))
    own = np.zeros((len(items), len(used)), number_type(weights))
    for k, t in enumerate(items):
        at = np.searchsorted(used, t)
        own[k, at] = weights[t]
    node = ItemNode(first, first + len(items), used, own.max(axis=0))
    node.weights = own
    return node


def _above(nodes: list[ItemNode]) -> ItemNode:
    used, back = np.unique(np.concatenate([n.term for n in nodes]), return_inverse=True)
    most = np.zeros(len(used), nodes[0].most.dtype)
    np.maximum.at(most, back, np.concatenate([n.most for n in nodes]))
    node = ItemNode(nodes[0].first, nodes[-1].end, used, most)
    node.below = nodes
    return node


class Search:
    """The items of a block and their k best documents so far."""

    def __init__(self, item_terms: list[list[int]], weights: np.ndarray, top: int = TOP) -> None:
        # Items that share their heaviest term stand next to each other.
        heaviest = [max(t, key=lambda k: (weights[k], k)) for t in item_terms]
        self.order = sorted(range(len(item_terms)), key=lambda i: (heaviest[i], i))
        n = len(item_terms)
        own = [item_terms[i] for i in self.order]
        nodes = [_leaf(at, own[at:at + LEAF_ITEMS], weights) for at in range(0, n, LEAF_ITEMS)]
        while len(nodes) > 1:
            nodes = [_above(nodes[at:at + FAN]) for at in range(0, len(nodes), FAN)]
        self.root = nodes[0] if nodes else None
        self.top = top
        self.score = [np.zeros(0, np.int64) for _ in range(n)]
        self.doc = [np.zeros(0, np.int64) for _ in range(n)]
        self.weakest = np.ones(n, np.int64)  # what a document needs at least: more than nothing, or the k-th score
        self.opened = self.pruned = 0

    def add(self, ids: np.ndarray, impacts: np.ndarray) -> None:
        """Search a batch: ``impacts`` has a row for each term and a column for each document."""
        if len(ids) and self.root is not None:
            docs = DocumentTree(impacts)
            top = len(docs.levels) - 1
            self._visit(self.root, docs, top, np.arange(docs.levels[top].shape[1]), ids, impacts)

    def _visit(self, node: ItemNode, docs: DocumentTree, level: int, nodes: np.ndarray,
               ids: np.ndarray, impacts: np.ndarray) -> None:
        """Open the pairs of an item node with document nodes of one level that their bounds allow."""
        bound = node.most @ docs.levels[level][np.ix_(node.term, nodes)]
        alive = nodes[bound >= self.weakest[node.first:node.end].min()]
        self.opened += len(alive)
        self.pruned += len(nodes) - len(alive)
        if not len(alive):
            return
        if not node.below and not level:
            columns = (alive[:, None] * LEAF_DOCS + np.arange(LEAF_DOCS)).ravel()
            columns = columns[columns < len(ids)]
            score = node.weights @ impacts[np.ix_(node.term, columns)]  # exact: see number_type
            for k in range(node.first, node.end):
                self._take(k, score[k - node.first].astype(np.int64), ids[columns])
            return
        if level:
            alive = docs.children(level, alive)
            level -= 1
        for child in node.below or [node]:
            self._visit(child, docs, level, alive, ids, impacts)

    def _take(self, item: int, score: np.ndarray, ids: np.ndarray) -> None:
        good = score >= self.weakest[item]
        if not good.any():
            return
        score = np.concatenate([self.score[item], score[good]])
        ids = np.concatenate([self.doc[item], ids[good]])
        best = np.lexsort((ids, -score))[:self.top]
        self.score[item], self.doc[item] = score[best], ids[best]
        if len(best) == self.top:
            self.weakest[item] = score[best[-1]]

    def rows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for column, i in enumerate(self.order):
            yield i, self.doc[column], self.score[column]


def impacts_of(batch: pa.RecordBatch, n_docs: int, all_terms: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, impacts) of the documents of a batch that hold an item term, like ones together."""
    offsets = batch.column("terms").offsets.to_numpy()
    size = np.diff(offsets)
    term = batch.column("terms").flatten().to_numpy()
    tf = batch.column("counts").flatten().to_numpy()
    n = batch.column("n").to_pylist()
    factor = np.array([20 * length_factor(k, n_docs, all_terms) for k in n], np.int64)
    held = np.flatnonzero(size)
    column = np.repeat(np.arange(len(held)), size[held])
    value = (1_000_000_000 * tf) // (1000 * tf + factor[held][column])
    # The term with the greatest share of a document's scores, to order the documents by it.
    strongest = np.lexsort((term, -value * weights[term], column))
    first = term[strongest[np.concatenate([[0], np.cumsum(size[held])[:-1]])]] if len(held) else term
    order = np.argsort(first, kind="stable")
    place = np.empty(len(held), np.int64)
    place[order] = np.arange(len(held))
    out = np.zeros((len(weights), len(held)), number_type(weights))
    out[term, place[column]] = value
    ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
    return ids[held][order], out


STATE = "doc_id long, n long, terms array<int>, counts array<long>"


def _count_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """STATE of every document with a term; ``vocabulary`` is a broadcast map from term to number."""
    kind = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                      ("counts", pa.list_(pa.int64()))])

    def run(batches):
        number = vocabulary.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(at, BATCH_DOCS)
                rows = []
                for i, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    found = terms(text.as_py())
                    if found:
                        held = sorted((number[t], c) for t, c in Counter(found).items() if t in number)
                        rows.append((i, len(found), [t for t, _ in held], [c for _, c in held]))
                columns = list(zip(*rows, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)

    return docs.mapInArrow(run, STATE)


def _search_block(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """(item number, doc_id, score, group): the best documents of each task, of a block of items."""
    spark = docs.sparkSession
    held = [sorted(set(terms(text))) for _, text in items]
    items = [(k, t) for k, t in enumerate(held) if t]
    number = {t: i for i, t in enumerate(sorted({t for _, ts in items for t in ts}))}
    state_path = work_dir(spark)
    _count_terms(docs, spark.sparkContext.broadcast(number)).write.parquet(state_path)
    state = spark.read.schema(STATE).parquet(state_path)
    totals = state.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    # At most one row for each item term of the block comes back.
    holding = {r["term"]: r["docs"] for r in state.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("docs")).collect()}
    weights = np.array([weight(totals["docs"], holding.get(i, 0)) for i in range(len(number))], np.int64)
    shared = spark.sparkContext.broadcast(([k for k, _ in items], [[number[t] for t in ts] for _, ts in items], weights))
    n_docs, all_terms = totals["docs"], totals["terms"]

    def run(batches):
        from pyspark import TaskContext
        numbers, item_terms, w = shared.value
        search = Search(item_terms, w, top)
        step = max(LEAF_DOCS, min(BATCH_DOCS, BATCH_VALUES // max(1, len(w))))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                search.add(*impacts_of(batch.slice(at, step), n_docs, all_terms, w))
        group = TaskContext.get().partitionId() % GROUPS
        for i, doc, score in search.rows():
            if len(doc):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(doc), numbers[i])), pa.array(doc, mask=doc == NO_ID), pa.array(score),
                     pa.array(np.full(len(doc), group))], ["item", "doc_id", "score", "group"])

    return state.mapInArrow(run, "item long, doc_id long, score long, group long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0,
    best first, equal scores by ascending id."""
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text")).distinct()
    size = asked.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    n_blocks = -(-size // BLOCK_BYTES)
    kind = StructType([StructField("item", LongType()), StructField("item_id", asked.schema["item_id"].dataType)])
    found = None
    for b in range(n_blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).collect()
        names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(block)], kind)
        part = _ranked(_search_block(rows, [(r["item_id"], r["text"]) for r in block], top), top)
        part = names.join(part, "item").select("item_id", "rank", "doc_id", "score")
        if n_blocks > 1:  # a block's rows are kept as a table, its broadcasts can go
            path = work_dir(spark)
            part.write.parquet(path)
            part = spark.read.parquet(path)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], StructType([kind["item_id"], StructField("doc_id", LongType()), StructField("score", LongType())])) \
                     .select("item_id", F.lit(1).alias("rank"), "doc_id", "score")
    return found


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    place = F.row_number().over(Window.partitionBy("item", "group").orderBy(*best))
    few = rows.withColumn("rank", place).where(F.col("rank") <= top)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*best))).where(F.col("rank") <= top)
