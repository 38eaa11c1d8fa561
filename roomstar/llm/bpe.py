"""Byte-level BPE over Arrow batches: encoding with the tokenizers library, decoding with the
byte table.

A text is split into pre-tokens (the split pattern of the vocabulary, evaluated with numpy over
character classes), every distinct pre-token of a batch is encoded once by the tokenizers
library, and the ids are gathered back in text order. A bounded per-worker cache keeps ids of
pre-tokens met before. Merges never cross pre-tokens, so this equals encoding whole texts.

Bytes that are not printable characters are mapped to characters above U+0100 before the merges
(``byte_chars``); decoding reverses that table, so a character split over several tokens is put
together again from its bytes.

Null and empty texts have no ids. The added tokens of a tokenizers file are taken out of the texts
first, as the library does; a model made from ranks has none, so such strings are ordinary text.
"""

from __future__ import annotations

import base64
import json
import os
import re
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from roomstar.llm.columns import handed_on, id_and_text, with_columns
from roomstar.llm.text import U64, SpanHash, ranges, slices, utf8

CACHE_WORDS = 1 << 20  # pre-tokens kept per worker; the cache starts anew beyond it


# --- byte <-> character table -------------------------------------------------------------

def byte_chars() -> list[str]:
    """Byte -> character: printable Latin-1 characters stand for themselves, the other bytes
    for U+0100, U+0101, ... in ascending order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in printable}
    rest = (b for b in range(256) if b not in out)
    out.update({b: chr(256 + i) for i, b in enumerate(rest)})
    return [out[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from lines of base64 bytes and a decimal rank."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """A tokenizers model with the given ranks: every way to make a token from two tokens is a
    merge, in rank order, so that pairs merge by the rank of what they form."""
    chars = byte_chars()
    name = {t: "".join(chars[b] for b in t) for t in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        for cut in range(1, len(token)):
            a, b = token[:cut], token[cut:]
            if a in ranks and b in ranks:
                # The pair of the lower-ranked parts first: the one the merges themselves reach.
                merges.append((ranks[token], max(ranks[a], ranks[b]), name[a], name[b]))
    merges.sort(key=lambda m: m[:2])
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [],
        "normalizer": None, "post_processor": None, "decoder": None,
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False,
                          "trim_offsets": False, "use_regex": False},
        "model": {"type": "BPE", "dropout": None, "unk_token": None,
                  "continuing_subword_prefix": None, "end_of_word_suffix": None,
                  "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
                  "vocab": {name[t]: r for t, r in ranks.items()},
                  "merges": [[a, b] for _, _, a, b in merges]},
    })


def load_tokenizer(spec: str):
    """Tokenizer from a JSON string, without its own splitting: it is only given single pre-tokens
    and added tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers
    tok = Tokenizer.from_str(spec)
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tok


def added_pattern(spec: str) -> re.Pattern[bytes] | None:
    """Finds the added tokens of a tokenizers JSON string in UTF-8 bytes, the longest first; none if
    it has none."""
    tokens = json.loads(spec).get("added_tokens") or []
    if any(t.get(k) for t in tokens for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise NotImplementedError("added tokens that depend on what is around them")
    names = sorted((t["content"].encode() for t in tokens), key=len, reverse=True)
    return re.compile(b"|".join(map(re.escape, names))) if names else None


# --- splitting --------------------------------------------------------------------------------

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
_CLASS: np.ndarray | None = None


def _classes() -> np.ndarray:
    """Class of every code point: \\p{L}, \\p{N}, \\s (White_Space) or none of them."""
    global _CLASS
    if _CLASS is None:
        table = np.zeros(0x110000, np.uint8)
        for c in range(0x110000):
            kind = unicodedata.category(chr(c))[0]
            table[c] = LETTER if kind == "L" else NUMBER if kind == "N" else OTHER
        # White_Space: tab to carriage return, U+0085 and the separators (category Z).
        table[9:14] = SPACE
        table[0x85] = SPACE
        for c in range(0x3001):
            if unicodedata.category(chr(c))[0] == "Z":
                table[c] = SPACE
        _CLASS = table
    return _CLASS


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, offsets in code points, byte position of each code point + end)."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, np.searchsorted(lead, offsets), np.append(lead, len(data))


def split(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start positions of the pre-tokens of texts given as code points.

    The pattern's alternatives as rules on character classes: runs of letters, numbers or other
    characters, each with one blank before it; contractions; runs of white space, which leave
    their last character to what follows.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    cls = _classes()[points]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = edge[:n].copy()
    first[0] = True
    last = edge[1:]
    change = np.empty(n, bool)
    change[0] = True
    change[1:] = cls[1:] != cls[:-1]
    start = first | change  # of maximal class runs
    space = cls == SPACE
    # The last white-space character before a non-space character of the same text is cut off
    # its run; if it is a blank, what follows joins it instead of starting anew.
    nxt_other = np.zeros(n, bool)
    nxt_other[:-1] = space[:-1] & ~space[1:] & ~last[:-1]
    start |= nxt_other
    joined = np.zeros(n, bool)
    joined[1:] = nxt_other[:-1] & (points[:-1] == 32)
    start &= ~joined
    # Contractions: an apostrophe where a pre-token starts, directly before s t m d ll ve re.
    quote = np.flatnonzero((points == 39) & start & ~last)
    if len(quote):
        same = np.searchsorted(offsets, quote, "right")
        a = points[quote + 1]
        room = quote + 2 < offsets[same]
        b = np.where(room, points[np.minimum(quote + 2, n - 1)], 0)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = np.zeros(len(quote), bool)
        for x, y in ("re", "ve", "ll"):
            two |= (a == ord(x)) & (b == ord(y))
        start[quote[one | two] + 1] = False
        for hit, k in ((one, 2), (two & ~one, 3)):
            after = quote[hit] + k
            after = after[after < n]
            # What follows a contraction starts a pre-token, unless a run of spaces has it.
            start[after] |= ~space[after] | first[after]
    return np.flatnonzero(start)


# --- encoding ---------------------------------------------------------------------------------

class Encoder:
    """Encodes batches of texts; keeps the ids of distinct pre-tokens between batches."""

    def __init__(self, spec: str) -> None:
        self._tok = load_tokenizer(spec)
        self._added = added_pattern(spec)
        self._clear()

    def _clear(self) -> None:
        self._keys = np.zeros(0, U64)
        self._at = np.zeros(0, np.int64)
        self._len = np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        ids, count = [], np.zeros(len(words), np.int64)
        for lo in range(0, len(words), 20_000):
            part = words[lo:lo + 20_000]
            enc = self._tok.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(enc.ids, np.uint32))
            count[lo:lo + len(part)] = np.bincount(np.array(enc.word_ids, np.int64), minlength=len(part))
        at = len(self._pool) + np.concatenate([[0], np.cumsum(count)[:-1]])
        where = np.searchsorted(self._keys, keys)
        # All at once: an encoder may outlive a task that fails here.
        self._pool, self._keys, self._at, self._len = (
            np.concatenate([self._pool, *ids]), np.insert(self._keys, where, keys),
            np.insert(self._at, where, at), np.insert(self._len, where, count))

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where pre-tokens and added tokens start, and of all code points + end."""
        points, text_at, byte_at = code_points(data, offsets)
        raw = data.tobytes()
        if self._added is None or not self._added.search(raw):
            return byte_at[split(points, text_at)], byte_at
        found = np.array([m.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                          for m in self._added.finditer(raw, a, b)], np.int64).reshape(-1, 2)
        if not len(found):
            return byte_at[split(points, text_at)], byte_at
        # The texts between added tokens are split each for itself; an added token is one piece.
        edges = np.searchsorted(byte_at, np.unique(np.concatenate([offsets, found.ravel()])))
        start = byte_at[split(points, edges)]
        token = np.searchsorted(found[:, 0], start, "right") - 1
        inside = (token >= 0) & (start > found[token, 0]) & (start < found[token, 1])
        return start[~inside], byte_at

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids) of a string column."""
        data, offsets = utf8(column)
        ids, at, _ = self._encode(data, offsets)
        return ids, at

    def encode_with_offsets(self, column):
        """Also the code-point span of every token inside its text (start, end): the
        characters whose bytes the token touches."""
        data, offsets = utf8(column)
        ids, at, span = self._encode(data, offsets, spans=True)
        return ids, at, *span

    def _encode(self, data, offsets, spans: bool = False):
        if len(self._keys) > CACHE_WORDS:
            self._clear()
        n = len(offsets) - 1
        if not len(data):
            none = np.zeros(0, np.uint32)
            return none, np.zeros(n + 1, np.int64), (none, none)
        start, byte_at = self._starts(data, offsets)
        end = np.append(start[1:], len(data))
        key = SpanHash(data).of(start, end)
        distinct, where, back = np.unique(key, return_index=True, return_inverse=True)
        slot = np.searchsorted(self._keys, distinct)
        known = slot < len(self._keys)
        known[known] = self._keys[slot[known]] == distinct[known]
        if not known.all():
            new = where[~known]
            raw = pa.LargeStringArray.from_buffers(
                len(new), pa.py_buffer(np.concatenate([[0], np.cumsum(end[new] - start[new])]).astype(np.int64)),
                pa.py_buffer(np.ascontiguousarray(data[ranges(start[new], end[new] - start[new])])))
            self._learn(distinct[~known], raw.to_pylist())
            slot = np.searchsorted(self._keys, distinct)
        count = self._len[slot][back]
        ids = self._pool[ranges(self._at[slot][back], count)]
        total = np.concatenate([[0], np.cumsum(count)])
        first = np.searchsorted(start, offsets)  # pre-tokens do not cross texts
        at = total[first]
        if not spans:
            return ids, at, None
        length = token_lengths(self._tok)[ids]
        stop = np.cumsum(length)
        begin = stop - length
        lead, text_at = byte_at[:-1], np.searchsorted(byte_at, offsets)
        owner = np.repeat(np.arange(n), np.diff(at))
        lo = np.searchsorted(lead, begin, "right") - 1 - text_at[owner]
        hi = np.searchsorted(lead, stop, "left") - text_at[owner]
        return ids, at, (lo, hi)


@lru_cache(maxsize=1)
def worker_encoder(spec: str) -> Encoder:
    """The encoder of a Python worker, kept with its bounded cache from one task to the next: words
    that a task has met are not encoded again by those after it."""
    return Encoder(spec)


def token_bytes(tok) -> list[bytes]:
    """id -> bytes, by the reversed byte table."""
    back = {c: b for b, c in enumerate(byte_chars())}
    out = [b""] * tok.get_vocab_size()
    for token, i in tok.get_vocab().items():
        if i >= len(out):
            out.extend([b""] * (i + 1 - len(out)))
        out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def token_lengths(tok) -> np.ndarray:
    return np.array([len(b) for b in token_bytes(tok)], np.int64)


class Decoder:
    """ids -> bytes by table; characters split over tokens come together in the bytes."""

    def __init__(self, table: list[bytes]) -> None:
        self._bytes = np.frombuffer(b"".join(table), np.uint8)
        self._len = np.array([len(b) for b in table], np.int64)
        self._at = np.concatenate([[0], np.cumsum(self._len)[:-1]])

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of each text; the inverse of encode."""
        length = self._len[ids]
        total = np.concatenate([[0], np.cumsum(length)])
        return self._bytes[ranges(self._at[ids], length)], total[at]

    def texts(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """Decoded texts; bytes that are not UTF-8 become U+FFFD."""
        data, off = self.decode(ids, at)
        raw = data.tobytes()
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:], strict=True)],
                        pa.large_string())


def _binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


# --- operators over DataFrames ---------------------------------------------------------------

def encode(docs: DataFrame, spec: str, id_col: str = "doc_id", text_col: str = "text",
           keep: Sequence[str] = (), with_bytes: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, ids array<int>``, with ``with_bytes`` also ``decoded
    binary`` (the ids decoded again, in the same pass), and the ``keep`` columns; no shuffle. Null and empty texts have
    an empty array. ``spec`` is a tokenizers JSON string (``tokenizer_json`` or a file)."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    rows = id_and_text(docs, id_col, text_col, keep)
    schema, names = handed_on(rows, "doc_id long, ids array<int>" + ", decoded binary" * with_bytes, keep)
    table = docs.sparkSession.sparkContext.broadcast(token_bytes(load_tokenizer(spec)) if with_bytes else None)

    def run(batches):
        encoder = Encoder(shared.value)
        decoder = Decoder(table.value) if with_bytes else None
        for part in slices(batches, "text"):
            ids, at = encoder.encode(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            own = {"doc_id": part.column("doc_id"), "ids": lists}
            if decoder:
                own["decoded"] = _binaries(*decoder.decode(ids, at))
            yield with_columns(pa.RecordBatch.from_pydict(own), part, names)

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, spec: str, keep: Sequence[str] = ()) -> DataFrame:
    """``encode``'s rows with ``decoded binary``, the bytes that the ids stand for, and the
    ``keep`` columns. Null ids count as none."""
    rows = encoded.select("doc_id", "ids", *keep)
    schema, names = handed_on(rows, "doc_id long, ids array<int>, decoded binary", keep)
    shared = encoded.sparkSession.sparkContext.broadcast(token_bytes(load_tokenizer(spec)))

    def run(batches):
        decoder = Decoder(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                lists = part.column("ids")
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                at = np.concatenate([[0], np.cumsum(size.astype(np.int64))])
                yield with_columns(pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, _binaries(*decoder.decode(flat, at))], ["doc_id", "ids", "decoded"]),
                    part, names)

    return rows.mapInArrow(run, schema)
