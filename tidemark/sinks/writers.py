"""Parquet sinks: full refresh, partitioned, append, written-and-counted."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.readers import list_files

#: The folder name Spark gives to rows without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> str:
    """Store a version of a table that nobody reads yet, and return its name."""
    version = uuid.uuid4().hex
    if partition_by:
        write_partitioned(df, f"{path}/{version}", partition_by, sort_by, mode="errorifexists")
    else:
        df.write.parquet(f"{path}/{version}")
    return version


def publish_version(spark: SparkSession, path: str, version: str) -> None:
    """Make a stored version the one that `read_table` reads."""
    done = spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("stored_at"))
    done.coalesce(1).write.mode("append").parquet(f"{path}/versions")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table and return what was stored.

    Each version has a folder of its own, and a row in the table `versions` names it once it is complete. So a
    failed write leaves the version before it, and the rows may come from the very table they replace.
    """
    spark, version = df.sparkSession, write_version(df, path, partition_by, sort_by)
    publish_version(spark, path, version)
    return spark.read.schema(df.schema).parquet(f"{path}/{version}").select(*df.columns)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The latest complete version of a table that `write_table` stored."""
    version = spark.read.parquet(f"{path}/versions").agg(F.max_by("version", "stored_at").alias("v")).first().v
    stored = spark.read.schema(schema) if schema is not None else spark.read
    return stored.parquet(f"{path}/{version}")


def write_snappy_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    cols: Sequence[str],
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
    derived: Mapping[str, Column] | None = None,
    **options: str,
) -> None:
    """One folder per combination of `cols`; rows with a NULL there go to the default folder.

    Rows are rebalanced on the partition columns: Spark merges small pieces and splits a value that
    holds very many rows over several tasks and files. `sort_by` clusters rows inside each file.
    Columns `derived` from others are added to rows in their place, so they are stored and not moved.
    """
    rows = df.hint("rebalance", *cols).withColumns({**(derived or {})})
    if sort_by:
        rows = rows.sortWithinPartitions(*cols, *sort_by)
    writer = rows.write.mode(mode).option("compression", "snappy").partitionBy(*cols)
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(path)


def append_rates(rates: DataFrame, path: str) -> None:
    rates.write.mode("append").parquet(path)


def write_read_verify(df: DataFrame, path: str, cols: Sequence[str] = ()) -> DataFrame:
    """Write, read back and count the rows that arrived."""
    if cols:
        write_partitioned(df, path, cols)
    else:
        write_snappy_parquet(df, path)
    return df.sparkSession.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_read_back"))


def select_unprocessed(source_files: DataFrame, done_files: DataFrame) -> DataFrame:
    """Files of the source that are not yet done, compared by path relative to the table root."""
    return source_files.join(done_files.select("relative_path"), "relative_path", "left_anti")


def read_selected(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """Rows of the files listed in `files` (relative_path), which may be a table of any size.

    The file names stay in Spark: rows meet them by the path of their file. What is sent to all tasks is one row per
    folder, by which Spark leaves out the other folders at run time, before it opens a file.
    """
    rows = spark.read.parquet(root)
    base = root.split("://", 1)[-1].split(":", 1)[-1].rstrip("/") + "/"
    full = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    path = F.expr("substring(__file, __from)")
    found = rows.select("*", full.alias("__file")).withColumn("__from", F.instr("__file", base) + len(base))
    found = found.withColumn("relative_path", path).drop("__file", "__from")
    folders = _folders_of(rows, files)
    if folders is not None:
        names = folders.columns
        some = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
        inside = found.where(some).join(F.broadcast(folders), names, "left_semi")
        found = inside.unionByName(found.where(~some))
    return found.join(files.select("relative_path").distinct(), "relative_path", "left_semi").select(*rows.columns)


def _folders_of(rows: DataFrame, files: DataFrame) -> DataFrame | None:
    """The values of the folder columns (`name=value` parts of the paths) that the listed files lie in."""
    one = files.select("relative_path").first()
    parts = one.relative_path.split("/")[:-1] if one else []
    names = [n for n in (part.partition("=")[0] for part in parts) if n in rows.columns]
    if not names:
        return None
    values = [F.nullif(F.regexp_extract("relative_path", f"(?:^|/){n}=([^/]*)/", 1), F.lit(_NO_VALUE)) for n in names]
    typed = [F.url_decode(v).cast(rows.schema[n].dataType).alias(n) for n, v in zip(names, values)]
    # The comparison tells Spark that this side is worth pruning by.
    return files.where(F.length("relative_path") > 0).select(*typed).distinct()


def unprocessed_in(spark: SparkSession, source_root: str, done_root: str) -> DataFrame:
    """Files below one root whose relative path is missing below the other."""
    return select_unprocessed(list_files(spark, source_root), list_files(spark, done_root))
