"""What the pipeline's stages take of an executor: files of small tables, memory of grouped work."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from roomstar.llm import near_dedup, suffix_dedup
from roomstar.llm.components import components


def test_small_link_tables_have_few_files(spark):
    held = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        links = [(1, 5), (5, 9), (2, 9), (9, 12), (100, 101), (101, 103), (7, 7)]
        labels = components(spark.createDataFrame(links, "a long, b long").checkpoint())
        got = dict(map(tuple, labels.collect()))
        parts = labels.rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {1: 1, 2: 1, 5: 1, 9: 1, 12: 1, 100: 100, 101: 100, 103: 100}
    assert parts <= spark.sparkContext.defaultParallelism


def test_blocks_of_long_texts_are_hashed_piece_by_piece():
    draw = random.Random(5)
    words = [f"word{i}" for i in range(5000)]
    base = [" ".join(draw.choice(words) for _ in range(6000)) for _ in range(80)]
    texts = [*base, base[0] + " tail", "short text", None]
    table = pa.table({"node": pa.array([b"%03d" % i for i in range(len(texts))]), "text": pa.array(texts, pa.string())})
    near_dedup._block_links(85)(table.slice(0, 2))
    tracemalloc.start()
    links = near_dedup._block_links(85)(table).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert links == [{"a": b"000", "b": b"080"}]
    assert peak < 30 * sum(len(t or "") for t in texts)


def test_grouped_work_gives_its_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(suffix_dedup, "release", lambda: calls.append(1))
    text = "a passage of more than fifty bytes that stands in two rows of the table"
    docs = pa.table({"doc_id": pa.array([1, 2], pa.int64()), "text": [text, "x " + text],
                     "chunk": pa.array([0, 0], pa.int32())})
    answers = suffix_dedup._match_runs(suffix_dedup._send_runs(1)(docs))
    assert len(calls) == 2
    sent = suffix_dedup._send_bytes(1)((0,), docs, answers)
    windows = suffix_dedup._match_bytes(sent) if sent.num_rows else answers.slice(0, 0)
    kept = suffix_dedup._cut(docs, pa.concat_tables([answers, windows]), [], False)
    assert len(calls) == 4 + bool(sent.num_rows)
    assert kept.column("kept").to_pylist() == [text.encode(), b"x "]
    assert np.array_equal(kept.column("n_bytes").to_numpy(), [len(text), len(text) + 2])
