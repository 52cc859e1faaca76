"""Scans: raw tables, CSV, Parquet prefixes, partitioned lake tables, file listings, rate documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.sources import schemas


# Where rates come from and the currency they are quoted in.
RATES_SOURCE = "open.er-api.com"
RATES_BASE = "USD"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header line and a declared schema; an empty field is NULL."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_raw(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """One raw table below `root`, by name, with its declared schema."""
    schema = schemas.RAW[name]
    if fmt == "csv":
        return read_csv(spark, f"{root}/{name}.csv", schema)
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def read_parquet_prefix(spark: SparkSession, root: str, prefix: str, schema: T.StructType) -> DataFrame:
    """All Parquet files below a prefix as one table; no rows (but the schema) if there are none."""
    path = f"{root.rstrip('/')}/{prefix.strip('/')}"
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_partition_filtered(
    spark: SparkSession, root: str, predicate: Column | str, schema: T.StructType | None = None
) -> DataFrame:
    """A partitioned table restricted by its partition columns: other folders are not opened."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(root).where(predicate)


def list_files(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """Files below `root`: path relative to it and length. Only metadata is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{suffix}")
        .load(root)
        .select("path", "length")
    )
    base = root.split("://", 1)[-1].split(":", 1)[-1].rstrip("/")
    after = F.instr("path", base + "/") + len(base) + 1
    return files.select(F.expr("path").substr(after, F.length("path")).alias("relative_path"), "length")


def explode_rates(
    docs: DataFrame,
    json_col: str = "value",
    ingested_at: str | Column | None = None,
    source: str = RATES_SOURCE,
    base: str = RATES_BASE,
) -> DataFrame:
    """Rate documents (`{"rates": {currency: rate}, "time_last_update_utc": ...}`) to one row per currency."""
    doc = F.from_json(json_col, "rates map<string,double>, time_last_update_utc string").alias("doc")
    if ingested_at is None:
        ingested_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    stamp = F.lit(ingested_at) if isinstance(ingested_at, str) else ingested_at
    return docs.select(doc).select(
        F.lit(base).alias("base_currency"),
        F.explode("doc.rates").alias("target_currency", "exchange_rate"),
        F.col("doc.time_last_update_utc").alias("rate_date"),
        stamp.alias("_ingested_at"),
        F.lit(source).alias("_source"),
    )
