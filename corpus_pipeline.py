"""The corpus pipeline: quality rules, near duplicates, repeated passages, source mix, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import host_rules, jaccard, mixing, packing, passages
from tidemark.llm.common import store
from tidemark.llm.queries import TOKENIZER

#: The last stage needs a model of the tokenizer, the first a window over words: SQL has neither.
ORACLE_SQL = None


def _wrapped(docs: DataFrame, *names: str) -> DataFrame:
    """All columns inside `row`, next to the ones an operator works on, so that no other name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *names)


def _columns(docs: DataFrame, **changed) -> list:
    return [changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no rule and whose host is not refused.

    A NULL or empty text has no words and goes. A NULL source is a host of its own. Rows that repeat are judged
    alike, each by itself; an empty table gives an empty one.
    """
    measured = host_rules.measure(_wrapped(docs, "text", "source"))
    judged = host_rules.judge(measured, host_rules.host_verdicts(measured))
    return judged.filter("kept").select(_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id.

    A doc_id of NULL comes last; of equal ones the smallest text hash stays. Texts without words, NULL ones too, resemble none and stay; rows with
    equal doc_id and text are one. An empty table gives an empty one.
    """
    return jaccard.survivors(_wrapped(docs, "doc_id", "text")).select(_columns(docs))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; n_chars follows the text.

    Every row stays, also one whose whole text goes. Earlier is by doc_id, NULL last, then by a hash of the text;
    equal rows are one document. NULL and short texts, and their n_chars, stay as they are.
    """
    cut = passages.remove_repeats(_wrapped(docs, "doc_id", "text"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return cut.select(_columns(docs, **changed))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, as their source's rate says.

    A NULL source is one source, the last. A text without words has size 0 and is emitted by its source's rate
    like any other. Reruns emit the same rows.
    """
    mixed = mixing.mix(_wrapped(docs, "doc_id", "text", "source"))
    return mixing.emit(mixed, ["row"]).select(_columns(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 2048 tokens.

    A NULL or empty text is one piece, its end mark. Rows that repeat, as the mix makes them, are packed each.
    """
    return packing.pack_documents(docs, TOKENIZER).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("packed sequences", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = store(docs, f"stage-{i}")
    return docs
