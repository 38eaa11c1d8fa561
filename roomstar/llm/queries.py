"""Registered queries of the subpackage: thin digests over the operators' outputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomstar.llm import (bpe, decontaminate, fingerprints, hard_negatives, html, language, lexical_search, license_scan,
                          near_dedup, quality, suffix_dedup, token_files, url_filter)
from roomstar.session import configure, work_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    docs = _table(spark, sf_dir, "documents")
    path = work_dir(spark)
    token_files.write_shards(docs, spec, path, end_id=2)
    return token_files.read_documents(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def rank_spec(path: str = "") -> str:
    return bpe.tokenizer_json(bpe.read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(_table(spark, sf_dir, "documents"), rank_spec(), with_bytes=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(_table(spark, sf_dir, "documents"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def _remainder(n: int):
    """crc32 of the id as text, modulo n: the fold of a document."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, _remainder(4) != 2)
    return quality.predict(docs, model).select(
        "doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.learn(docs, F.coalesce(_remainder(3) != 1, F.lit(True)))
    return language.predict(docs, model).select(
        "doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.transform("spans", lambda s: s["end"] - s["start"])
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", F.aggregate(length, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents"), 85).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_quality": op2_quality,
    "op3_token_files": op3_token_files,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_language_id": op5_language_id,
    "op6_html": op6_html,
    "op7_decontaminate": op7_decontaminate,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_near_dedup": op10_near_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_license_scan": op12_license_scan,
    "op13_lexical_search": op13_lexical_search,
}
