"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning counts every n-gram of every labelled text inside the tasks, one (language, bucket)
row per task and pair reaches the shuffle, and the sums (buckets x languages) make a matrix of
log probabilities that is broadcast. Scoring adds up the matrix rows of a text's n-grams in
numpy and normalises over the languages.

Texts that are null or have no letter are ``und`` with score 0, as is every text if there was
nothing to learn from. Ties go to the language that sorts first. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roomstar.llm.bpe import LETTER, _classes, code_points
from roomstar.llm.columns import handed_on, id_and_text, with_columns
from roomstar.llm.text import slices, utf8

BITS = 15       # log2 of the number of n-gram buckets
ORDERS = (1, 2, 3)
SMOOTHING = 0.5
UNKNOWN = "und"
PIECE = 1 << 18  # bytes of text handled at once


def grams(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every n-gram, text offsets in them, whether each text has a letter).

    Texts are lower-cased; everything but letters counts as a blank; n-grams of blanks alone
    do not count and none crosses two texts.
    """
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(column, "")))
    n_texts = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(n_texts + 1, np.int64), np.zeros(n_texts, bool)
    points, at, _ = code_points(data, offsets)
    letter = _classes()[points] == LETTER
    seen = np.concatenate([[0], np.cumsum(letter)])
    has_letter = seen[at[1:]] > seen[at[:-1]]
    symbol = np.where(letter, points, np.uint32(32))
    owner = np.repeat(np.arange(n_texts), np.diff(at))
    parts, owners = [], []
    for k in ORDERS:
        m = len(points) - k + 1
        if m <= 0:
            continue
        h = np.full(m, k * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        some = np.zeros(m, bool)
        for j in range(k):
            h = (h ^ symbol[j:j + m]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
            some |= letter[j:j + m]
        keep = np.flatnonzero(some & (owner[:m] == owner[k - 1:]))
        parts.append(h[keep] >> np.uint32(32 - BITS))
        owners.append(owner[keep])
    # Orders one after the other inside each text, so that a text's n-grams are contiguous.
    count = np.array([np.bincount(o, minlength=n_texts) for o in owners])
    ends = np.cumsum(count, axis=0).T.ravel()
    total = np.concatenate([[0], np.cumsum(count.sum(0))])
    base = np.repeat(total[:-1], len(parts))
    stop = base + ends
    start = stop - count.T.ravel()
    out = np.empty(int(total[-1]), np.uint32)
    for i, (p, c) in enumerate(zip(parts, count, strict=True)):
        first = np.concatenate([[0], np.cumsum(c)[:-1]])
        shift = np.repeat(start[i::len(parts)] - first, c)
        out[np.arange(len(p)) + shift] = p
    return out, total, has_letter


def learn(docs: DataFrame, usable: Column, text_col: str = "text",
          lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages in order, log probabilities [languages, buckets]) from the rows where
    ``usable`` holds and the language is not null; all their whole texts count. The model's
    size is the number of distinct languages times 2**BITS."""
    rows = (docs.where(usable & F.col(lang_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")))

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for part in slices(batches, "text", PIECE):
            bucket, at, _ = grams(part.column("text"))
            langs = np.array(part.column("lang").to_pylist(), object)
            owner = np.repeat(np.arange(len(langs)), np.diff(at))
            for lang in dict.fromkeys(langs):
                hit = bucket[(langs == lang)[owner]]
                if lang not in held:
                    held[lang] = np.zeros(1 << BITS, np.int64)
                held[lang] += np.bincount(hit, minlength=1 << BITS)
        for lang, n in held.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(n[some])],
                ["lang", "bucket", "n"])

    sums = (rows.mapInArrow(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(sums.column("lang").to_pylist()))
    n = np.full((len(langs), 1 << BITS), SMOOTHING)
    place = {v: i for i, v in enumerate(langs)}
    at = np.array([place[v] for v in sums.column("lang").to_pylist()], np.int64)
    np.add.at(n, (at, sums.column("bucket").to_numpy()), sums.column("n").to_numpy())
    return langs, np.log(n / n.sum(1, keepdims=True)) if langs else n


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id",
            text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per input row: ``doc_id, lang_pred, score`` (the language's posterior) and the
    input's ``keep`` columns."""
    rows = id_and_text(docs, id_col, text_col, keep)
    schema, names = handed_on(rows, "doc_id long, lang_pred string, score double", keep)
    shared = docs.sparkSession.sparkContext.broadcast((model[0], model[1].astype(np.float64)))

    def run(batches):
        langs, logp = shared.value
        values = np.array([*langs, UNKNOWN], object)
        for part in slices(batches, "text", PIECE):
            bucket, at, has_letter = grams(part.column("text"))
            n = part.num_rows
            best, score = np.full(n, len(langs)), np.zeros(n)
            rows = np.flatnonzero(has_letter) if langs else np.zeros(0, np.int64)
            if len(rows):
                # A text with a letter has n-grams, so none of these sums is empty.
                total = np.array([np.add.reduceat(row[bucket], at[rows]) for row in logp]).T
                total -= total.max(1, keepdims=True)
                share = np.exp(total)
                share /= share.sum(1, keepdims=True)
                best[rows] = share.argmax(1)
                score[rows] = share.max(1)
            yield with_columns(pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(values[best], pa.string()), pa.array(score)],
                ["doc_id", "lang_pred", "score"]), part, names)

    return rows.mapInArrow(run, schema)
