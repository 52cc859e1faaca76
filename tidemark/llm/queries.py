"""The registered queries of this package, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import collocations, compression, conversations, exact, host_rules, jaccard, katz, licenses, mixing, multiprobe, packing, passages, repeats
from tidemark.llm.common import store, table

TOKENIZER = os.environ.get("PACKING_TOKENIZER") or public_tokenizers.path("word_bpe_49k.json")


def crc_mod(n: int):
    """crc32 of the decimal doc_id, modulo n: how rows are held out."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return katz.score(docs, crc_mod(7) != 2).withColumnRenamed("key", "doc_id")


def op2_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return multiprobe.search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)
    return packed.withColumnRenamed("key", "doc_id")


def op4_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.remove_repeats(docs)


def op5_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(crc_mod(4) != 2)
    scored = compression.score(docs, compression.fit(docs, labels))
    # A row without doc_id is never learned from.
    held_out = F.coalesce(crc_mod(4) == 2, F.lit(True)).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    measured = store(host_rules.measure(docs).drop("text"), "measured")
    judged = host_rules.judge(measured, host_rules.host_verdicts(measured))
    return judged.select("doc_id", *host_rules.MEASURES, "base_failed", "kept")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).withColumnRenamed("key", "doc_id")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard.near_duplicates(docs)
    return found.select(F.col("key").alias("doc_id"), "class_id", "n_texts", "n_links")


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies")


def op10_maximal_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = repeats.remove_repeated_bytes(docs)
    gone = (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed")
    runs = F.size("removed").cast("long").alias("n_spans")
    return cut.select("doc_id", "n_bytes", gone, runs, F.sha2("kept", 256).alias("kept_sha256"), "removed")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.find_copies(table(spark, sf_dir, "documents"))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select(F.col("key").alias("doc_id"), F.col("keep").alias("keep_id"), "group_size", "kept", digest)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations.collocations(table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_katz_backoff": op1_katz_backoff,
    "op2_multiprobe_neighbours": op2_multiprobe_neighbours,
    "op3_pattern_packing": op3_pattern_packing,
    "op4_passage_dedup": op4_passage_dedup,
    "op5_compression_classifier": op5_compression_classifier,
    "op6_host_rules": op6_host_rules,
    "op7_license_scan": op7_license_scan,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_mix_sources": op9_mix_sources,
    "op10_maximal_repeats": op10_maximal_repeats,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_phrase_collocations": op13_phrase_collocations,
}
