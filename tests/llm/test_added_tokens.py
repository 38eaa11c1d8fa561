"""op3's tokenizer file, used as it is, against texts that hold its added token."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from roomstar.llm import bpe
from roomstar.llm import queries as Q

LITERAL = "<|endoftext|>"
TEXTS = [
    f"end{LITERAL} next", LITERAL, f"{LITERAL}{LITERAL}", f" {LITERAL} ", f"it{LITERAL}'s", f"a  {LITERAL}  b\n",
    "<|endoftext|", "|>", "<|endof", "text|> no token over two texts", f"<|{LITERAL}|>", f"é🙂{LITERAL}é", "", None, "plain text",
]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_equals_the_unchanged_library(spark, tok, scratch):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{scratch}/documents.parquet")
    got, at = {r["doc_id"]: r for r in Q.op3_token_files(spark, scratch).collect()}, 0
    for i, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (at, len(ids), crc), text
        at += len(ids)


def test_offsets_and_ordinary_text(tok):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        encoder = bpe.Encoder(f.read())
    ids, at, lo, hi = encoder.encode_with_offsets(pa.array(TEXTS))
    where = (ids == 50256).nonzero()[0]
    text_of = np.searchsorted(at, where, "right") - 1
    assert len(where) and all(TEXTS[t][a:b] == LITERAL for t, a, b in zip(text_of, lo[where], hi[where], strict=True))
    halves = [LITERAL[:5], LITERAL[5:]]
    ids, at = encoder.encode(pa.array(halves))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [
        tok.encode(t, add_special_tokens=False).ids for t in halves]
    plain, _ = bpe.Encoder(Q.rank_spec()).encode(pa.array(TEXTS))
    assert not (plain == 50256).any()
