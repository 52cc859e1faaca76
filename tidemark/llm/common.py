"""Pieces shared by the operators: reading tables, storing a step, words as SQL expressions, ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import fresh_dir

#: A word is a run of characters other than space and the ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder."""
    return fresh_dir(spark, purpose)


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` below the shared folder and read it back: lineage ends there, and lost executors lose nothing."""
    path = table_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def unused(df: DataFrame, *names: str) -> list[str]:
    """`names`, each lengthened until no column of `df` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ranked(df: DataFrame, order: Column, name: str) -> DataFrame:
    """Add the 0-based position of each row in `order`, without sorting all rows in one task.

    Rows are range-partitioned and stored, so the sampled ranges stay the same; rows are numbered within a
    range, and ranges are shifted by the rows before them (one row per range meets in one task).
    """
    piece, local, first = unused(df, "_piece", "_local", "_first")
    pieces = store(df.repartitionByRange(order).withColumn(piece, F.spark_partition_id()), "ranked")
    before = Window.orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        pieces.groupBy(piece)
        .agg(F.count(F.lit(1)).alias(local))
        .select(piece, F.coalesce(F.sum(local).over(before), F.lit(0)).alias(first))
    )
    numbered = pieces.withColumn(local, F.row_number().over(Window.partitionBy(piece).orderBy(order)) - 1)
    return numbered.join(starts, piece).withColumn(name, F.col(first) + F.col(local)).drop(piece, local, first)
