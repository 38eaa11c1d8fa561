"""The encoder that a worker keeps between tasks: loaded once, same ids as one made anew."""

import public_tokenizers
import pyarrow as pa

from roomstar.llm import bpe

with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
    SPEC = f.read()
TASKS = [["the first task's words", None, "", "it's fine"], ["other words, and the first task's words again"],
         ["Ünïcode 🙂 <|endoftext|> it's fine", "the first"], [], ["x" * 500, "the first task's words"]]


def ids_of(encoder, texts):
    ids, at = encoder.encode(pa.array(texts, pa.string()))
    return ids.tolist(), at.tolist()


def test_words_of_earlier_tasks_are_not_encoded_again(monkeypatch):
    loads, learned = [], []
    load, learn = bpe.load_tokenizer, bpe.Encoder._learn
    monkeypatch.setattr(bpe, "load_tokenizer", lambda spec: loads.append(1) or load(spec))
    monkeypatch.setattr(bpe.Encoder, "_learn", lambda self, keys, words: learned.extend(words) or learn(self, keys, words))
    bpe.worker_encoder.cache_clear()
    got = [ids_of(bpe.worker_encoder("".join(SPEC)), texts) for texts in TASKS]
    assert len(loads) == 1 and len(learned) == len(set(learned))
    assert got == [ids_of(bpe.Encoder(SPEC), texts) for texts in TASKS]


def test_the_kept_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    bpe.worker_encoder.cache_clear()
    got = [ids_of(bpe.worker_encoder(SPEC), texts) for texts in TASKS + TASKS]
    assert got == [ids_of(bpe.Encoder(SPEC), texts) for texts in TASKS + TASKS]
    assert len(bpe.worker_encoder(SPEC)._keys) < 30
    bpe.worker_encoder.cache_clear()
