"""Document fingerprints: invertible Bloom lookup sketches of paragraph pieces.

A text is cut after every line end and, so that a long paragraph does not stand or fall as a
whole, after blanks chosen by the bytes before them (about one in ``PIECE_WORDS``; a cut depends on
its own surroundings only, so an edit moves no cut elsewhere), and every ``PIECE_BYTES`` of a longer piece. Each piece's 64-bit digest, with
its number among equal pieces of the text, is added to three cells of a sketch: a count, a sum
of digests and a sum of check values. Subtracting two sketches leaves the pieces of one text
only; peeling cells that hold a single piece recovers their digests. If peeling gets stuck, both
sketches are built again four times as large. The likeness of two texts is 1 - differing pieces
/ all pieces of both (1 for two empty texts).

The fingerprint string is the smallest sketch in base64. Null counts as the empty text; equal
texts have equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from roomstar.llm.columns import id_and_text
from roomstar.llm.order import in_order
from roomstar.llm.text import U64, SpanHash, from_texts, mix, per_text

HASHES = 3
CELLS = 24          # of the smallest sketch; a multiple of HASHES
GROWTH = 4
PIECE_WORDS = 4
PIECE_BYTES = 32    # longest piece
WINDOW = 8          # bytes that decide a cut after a blank
BLOCK_BYTES = 1 << 20

_CHECK = U64(0xC2B2AE3D27D4EB4F)
_SALT = np.array([0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], U64)


def digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(digest of every piece, offsets of each text's pieces)."""
    data, offsets = from_texts(texts)
    n = len(texts)
    if not len(data):
        return np.zeros(0, U64), np.zeros(n + 1, np.int64)
    spans = SpanHash(data)
    blank = np.flatnonzero(data == 32)
    seen = spans.of(np.maximum(blank + 1 - WINDOW, offsets[np.searchsorted(offsets, blank, "right") - 1]), blank + 1)
    cut = np.zeros(len(data) + 1, bool)
    cut[blank[seen % U64(PIECE_WORDS) == 0] + 1] = True
    cut[np.flatnonzero(data == 10) + 1] = True
    cut[offsets] = True
    start = np.flatnonzero(cut[:-1])
    # A piece without a cut inside it for long is divided at multiples of PIECE_BYTES.
    length = np.diff(np.append(start, len(data)))
    parts = -(-length // PIECE_BYTES)
    first = np.repeat(np.cumsum(parts) - parts, parts)
    start = np.repeat(start, parts) + (np.arange(len(first)) - first) * PIECE_BYTES
    piece = spans.of(start, np.append(start[1:], len(data)))
    owner = np.searchsorted(offsets, start, "right") - 1
    # Equal pieces of one text are told apart by their number.
    order = np.lexsort((piece, owner))
    p, o = piece[order], owner[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    number = np.arange(len(p)) - np.repeat(first, np.diff(np.append(first, len(p))))
    return mix(p + number.astype(U64) * _CHECK), per_text(o, n)


def _check(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ _CHECK)


def _places(keys: np.ndarray, cells: int) -> np.ndarray:
    """The HASHES cells of each key, one in each third."""
    part = cells // HASHES
    return np.stack([mix(keys ^ s) % U64(part) + U64(i * part) for i, s in enumerate(_SALT)]).astype(np.int64)


class Sketches:
    """One sketch per text, as rows of cells."""

    def __init__(self, keys: np.ndarray, at: np.ndarray, cells: int) -> None:
        n = len(at) - 1
        self.count = np.zeros((n, cells), np.int64)
        self.sum = np.zeros((n, cells), U64)
        self.check = np.zeros((n, cells), U64)
        self.add(np.repeat(np.arange(n), np.diff(at)), keys, np.ones(len(keys), np.int64))

    def add(self, row: np.ndarray, keys: np.ndarray, sign: np.ndarray) -> None:
        check, places = _check(keys), _places(keys, self.count.shape[1])
        wrap = sign.astype(U64)  # -1 is the additive inverse modulo 2^64
        keys, check = keys * wrap, check * wrap
        cells = self.count.shape[1]
        for place in places:
            cell = row * cells + place
            np.add.at(self.count.reshape(-1), cell, sign)
            np.add.at(self.sum.reshape(-1), cell, keys)
            np.add.at(self.check.reshape(-1), cell, check)

    def minus(self, other: Sketches) -> Sketches:
        out = object.__new__(Sketches)
        out.count, out.sum, out.check = self.count - other.count, self.sum - other.sum, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, digest, sign) of every recovered piece and whether each row came out whole.
        Empties the cells."""
        found = []
        active = np.arange(len(self.count))
        while len(active):
            r, c = np.nonzero(np.abs(self.count[active]) == 1)
            r = active[r]
            sign = self.count[r, c]
            key = self.sum[r, c] * sign.astype(U64)
            pure = self.check[r, c] * sign.astype(U64) == _check(key)
            r, key, sign = r[pure], key[pure], sign[pure]
            if not len(r):
                break
            order = np.lexsort((key, r))
            r, key, sign = r[order], key[order], sign[order]
            new = np.ones(len(r), bool)
            new[1:] = (r[1:] != r[:-1]) | (key[1:] != key[:-1])
            r, key, sign = r[new], key[new], sign[new]
            self.add(r, key, -sign)
            found.append((r, key, sign))
            active = np.unique(r)
        whole = ~(self.count.any(1) | self.sum.any(1) | self.check.any(1))
        if not found:
            none = np.zeros(0, np.int64)
            return none, np.zeros(0, U64), none, whole
        return *(np.concatenate(x) for x in zip(*found, strict=True)), whole

    def strings(self) -> list[str]:
        cells = np.concatenate([self.count.astype("<i4").view(np.uint8).reshape(len(self.count), -1),
                                self.sum.astype("<u8").view(np.uint8).reshape(len(self.count), -1),
                                (self.check >> U64(32)).astype("<u4").view(np.uint8).reshape(len(self.count), -1)], 1)
        return [base64.b64encode(row.tobytes()).decode() for row in cells]


def _pick(keys: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    length = np.diff(at)[rows]
    total = np.concatenate([[0], np.cumsum(length)])
    index = np.arange(total[-1]) + np.repeat(at[rows] - total[:-1], length)
    return keys[index], total


def differing(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray],
              first: tuple[Sketches, Sketches] | None = None) -> np.ndarray:
    """Number of pieces that only one of each pair of texts has, by subtraction and peeling,
    with larger sketches until every pair comes out whole."""
    n = len(a[1]) - 1
    out = np.zeros(n, np.int64)
    rows, cells = np.arange(n), CELLS
    while len(rows):
        if first is not None and cells == CELLS:
            x, y = first
        else:
            x, y = Sketches(*_pick(*a, rows), cells), Sketches(*_pick(*b, rows), cells)
        r, _, _, whole = x.minus(y).peel()
        found = np.bincount(r, minlength=len(rows))
        out[rows[whole]] = found[whole]
        rows, cells = rows[~whole], cells * GROWTH
    return out


def likeness(na: np.ndarray, nb: np.ndarray, differ: np.ndarray) -> np.ndarray:
    both = na + nb
    return np.where(both > 0, 1 - differ / np.maximum(both, 1), 1.0)


def compare_block(texts: list[str], following: list[str]) -> dict[str, list]:
    """Fingerprints of texts and of their edited forms, with likenesses."""
    edited = [t[:len(t) - len(t) // 4] + f[:len(t) // 4] for t, f in zip(texts, following, strict=True)]
    own, edit, nxt = digests(texts), digests(edited), digests(following)
    a, e, f = (Sketches(*x, CELLS) for x in (own, edit, nxt))
    n_own, n_edit, n_next = (np.diff(x[1]) for x in (own, edit, nxt))
    return {
        "n_chars": [len(t) for t in texts],
        "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in edited],
        "fingerprint": a.strings(), "edited_fingerprint": e.strings(),
        "near_edited": likeness(n_own, n_edit, differing(own, edit, (a, e))),
        "near_next": likeness(n_own, n_next, differing(own, nxt, (a, f))),
        "n_pieces": n_own,
    }


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double, n_pieces long")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited form: the last quarter of its code points (rounded
    down) replaced by as many from the start of the next document in (id, text) order, all of
    it if it is shorter; after the last comes the first. A lone document follows itself."""
    rows = in_order(id_and_text(docs, id_col, text_col), look_ahead=True)

    def run(batches):
        held: list[tuple[int | None, str]] = []  # rows of one bucket, the last still without its next
        size, bucket, closed = 0, None, False

        def flush(rows, last_next):
            texts = [t for _, t in rows]
            out = compare_block(texts, [*texts[1:], last_next])
            return pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()),
                 *(pa.array(out[k]) for k in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                              "near_edited", "near_next", "n_pieces"))],
                [c.split()[0] for c in COMPARED.split(", ")])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("_bucket", "_ahead", "doc_id", "text"))
            for b, ahead, doc_id, text in zip(*columns, strict=True):
                text = text or ""
                if b != bucket:
                    bucket, closed = b, False
                if ahead:
                    if not closed and held:
                        yield flush(held, text)
                    held, size, closed = [], 0, True
                    continue
                if size >= BLOCK_BYTES:
                    yield flush(held, text)
                    held, size = [], 0
                held.append((doc_id, text))
                size += len(text)

    return rows.mapInArrow(run, COMPARED)
