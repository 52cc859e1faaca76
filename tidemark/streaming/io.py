"""Stream sources, sinks and bounded runs.

Progress is the checkpoint; it advances only after a batch's output is stored. Outputs of a batch go to
a folder named after its id and are replaced when the batch is repeated, and readers see a batch once a commit log
(or a table's manifest) names it, so a lost executor or driver leaves neither gaps nor duplicates nor half a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.cleaning import dedup_latest
from tidemark.sinks.folders import FolderTable, Manifest
from tidemark.sources.readers import read_parquet_prefix
from tidemark.sources.schemas import KEYED_MESSAGE


def stream_source(
    spark: SparkSession,
    fmt: str = "parquet",
    path: str | None = None,
    schema: T.StructType | None = KEYED_MESSAGE,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A stream from its earliest record: a message broker by options, or files below a path."""
    reader = spark.readStream.format(fmt)
    settings = dict(options or {})
    if fmt == "kafka":
        settings.setdefault("startingOffsets", "earliest")
        schema = None
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**settings)
    return reader.load(path) if path else reader.load()


def table_stream(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """One of the test tables as a stream of its file(s)."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .options(**options)
        .parquet(sf_dir)
    )


_COMMIT = T.StructType([T.StructField("batch_id", T.LongType())])


def committed(spark: SparkSession, log: str) -> int:
    """The last batch that a commit log names; -1 before the first."""
    last = read_parquet_prefix(spark, log, "", _COMMIT).agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last


def consume(batch: DataFrame) -> None:
    """Compute a batch and drop its rows: state that it depends on has to move on even if the output is there."""
    batch.write.format("noop").mode("overwrite").save()


def _logged(batch_fn: Callable[[DataFrame, int], None], log: str | None) -> Callable[[DataFrame, int], None]:
    """`batch_fn`, then an entry in the log. For a batch that the log names already `batch_fn` is not called again.

    Batches come one after the other, so the log is one number; two paths take turns, so the one that is being
    replaced is never the last.
    """
    if log is None:
        return batch_fn

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= committed(spark, log):
            consume(batch)
            return
        batch_fn(batch, batch_id)
        done = spark.createDataFrame([(batch_id,)], _COMMIT).coalesce(1)
        done.write.mode("overwrite").parquet(f"{log}/turn={batch_id % 2}")

    return run


def bounded_run(
    stream: DataFrame,
    batch_fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    log: str | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Process all that is there now, then stop; the source's `maxBytesPerTrigger` or `maxFilesPerTrigger` sizes batches.

    With `log`, a batch is committed there once `batch_fn` returned, and `read_committed` shows it from then on.
    `partitions` are those of the stream's shuffles and state, instead of the session's; a checkpoint keeps its own.
    """
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(_logged(batch_fn, log))
    )
    conf, name = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(name)
    # A stream copies the settings when it starts, so the session has its own again from then on.
    conf.set(name, str(partitions or before))
    try:
        query = writer.start()
    finally:
        conf.set(name, before)
    query.awaitTermination()
    return query


def commit_after_success(
    stream: DataFrame,
    batch_fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    log: str | None = None,
) -> StreamingQuery:
    """Continuous form of `bounded_run`: a batch is done when `batch_fn` returned, otherwise it is repeated."""
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_logged(batch_fn, log))
        .start()
    )


def batch_folder(root: str, batch_id: int) -> str:
    return f"{root}/batch_id={batch_id}"


def append_batches(root: str) -> Callable[[DataFrame, int], None]:
    """Store each batch in its own folder; a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(batch_folder(root, batch_id))

    return write


def commit_log(root: str) -> str:
    """Where the commits of the batches below `root` are kept: next to them, so that no reader takes it for data."""
    return f"{root}-commits"


def read_committed(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches below `root`; those of a batch that failed, or still runs, are not read."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    stored = read_parquet_prefix(spark, root, "", full)
    return stored.where(F.col("batch_id") <= committed(spark, commit_log(root))).select(*schema.names)


def run_append(stream: DataFrame, root: str, mode: str = "append") -> DataFrame:
    """Run to the end of the available data and return all rows the stream put out."""
    out = f"{root}/out"
    bounded_run(stream, append_batches(out), f"{root}/checkpoint", mode, commit_log(out))
    return read_committed(stream.sparkSession, out, stream.schema)


def store_version(batch: DataFrame, batch_id: int, root: str) -> None:
    """Store a batch as the latest version of a table that only ever grows.

    Two folders take turns, so a repeated batch overwrites its own version and leaves the one before
    it, and storage does not grow with the number of batches.
    """
    batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
        f"{root}/turn={batch_id % 2}"
    )


def read_version(spark: SparkSession, root: str, schema: T.StructType, batch_id: int | None = None) -> DataFrame:
    """The table as of a batch, or as of the last one."""
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if batch_id is not None:
        stored = spark.read.schema(full).parquet(f"{root}/turn={batch_id % 2}")
        return stored.where(F.col("batch_id") == batch_id).select(*schema.names)
    # No version yet: the stream had nothing to read.
    stored = read_parquet_prefix(spark, root, "", full)
    last = stored.agg(F.max("batch_id")).scalar()
    return stored.where(F.col("batch_id") == last).select(*schema.names)


def state_partitions(spark: SparkSession) -> int:
    """Into how many parts an aggregation's state falls: no more than there are cores.

    Every batch writes files for each part, however few rows it has; a batch has a share of its source for each core.
    """
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def run_complete(stream: DataFrame, root: str) -> DataFrame:
    """Run an aggregation to the end of the available data and return its last full result."""
    out, parts = f"{root}/out", state_partitions(stream.sparkSession)
    bounded_run(stream, lambda batch, n: store_version(batch, n, out), f"{root}/checkpoint", "complete", partitions=parts)
    return read_version(stream.sparkSession, out, stream.schema)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _with_fields(schema: T.StructType, **more: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in more.items()]])


def keyed_table(spark: SparkSession, root: str, schema: T.StructType) -> FolderTable:
    """The stored result of `run_update`: the changes of each batch, in folders by key."""
    return FolderTable(spark, root, "bucket", _with_fields(schema, batch_id=T.LongType(), bucket=T.IntegerType()))


def latest_of_keys(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    return dedup_latest(changes, keys, "batch_id")


def once_per_batch(table: FolderTable, change: Callable[[DataFrame, Manifest, str], None]) -> Callable[[DataFrame, int], None]:
    """A batch function that changes a table whose note is the last batch: a repeated batch changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        before = table.manifest()
        if before.note is not None and batch_id <= int(before.note):
            consume(batch)
        else:
            change(batch, before, str(batch_id))

    return write


def store_changes(table: FolderTable, keys: Sequence[str], buckets: int, most: int) -> Callable[[DataFrame, int], None]:
    """Append the changed keys of each batch; folders of more than `most` batches become one, with the last state of each key."""

    def change(batch: DataFrame, before: Manifest, number: str) -> None:
        rows = batch.withColumn("batch_id", F.lit(number).cast("bigint")).withColumn("bucket", bucket_of(keys, buckets))
        table.compact(table.append(before, rows, number), most, lambda changes: latest_of_keys(changes, keys))

    return once_per_batch(table, change)


def run_update(stream: DataFrame, root: str, keys: Sequence[str], buckets: int = 8, most: int = 8) -> DataFrame:
    """Run an aggregation and return its result, storing per batch only the keys that changed.

    A reader opens one snapshot and a few changes per folder, however many batches there were.
    """
    table = keyed_table(stream.sparkSession, f"{root}/out", stream.schema)
    parts = state_partitions(stream.sparkSession)
    bounded_run(stream, store_changes(table, keys, buckets, most), f"{root}/checkpoint", "update", partitions=parts)
    return latest_of_keys(table.read(), keys).select(*stream.columns)


# A batch has this much of its source for each core, and a file falls into row groups of this size (as written, not
# packed), so that a batch of few large files still has work for all cores.
BATCH_BYTES_PER_CORE = 16 << 20
ROW_GROUP_BYTES = 16 << 20


def batch_bytes(spark: SparkSession) -> int:
    """What a batch takes: a batch costs a fixed time beside its rows, so batches grow with the cores there are."""
    return BATCH_BYTES_PER_CORE * spark.sparkContext.defaultParallelism


def write_topic(messages: DataFrame, path: str) -> None:
    """Publish keyed messages: equal keys go to the same partition file."""
    messages.repartition("key").write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


# Topics, and how a broker has to confirm, repeat and bundle messages.
ORDER_TOPIC = "order-placed"
PAYMENT_TOPIC = "payment-processed"
BROKER_OPTIONS = {"kafka.acks": "all", "kafka.retries": "3", "kafka.linger.ms": "10"}


def publish(
    messages: DataFrame, checkpoint: str, fmt: str = "kafka", options: Mapping[str, str] | None = None
) -> StreamingQuery:
    """Publish a stream of keyed messages to a broker topic, or to files by `fmt="parquet"`."""
    settings = {**(BROKER_OPTIONS if fmt == "kafka" else {}), **dict(options or {})}
    writer = messages.writeStream.format(fmt).option("checkpointLocation", checkpoint).options(**settings)
    return writer.trigger(availableNow=True).start()
