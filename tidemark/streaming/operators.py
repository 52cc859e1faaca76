"""Stateful stream operators. Event time must be an instant, so local timestamps are cast on the way in."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.order_events import last_n, mean_of_last, parse_with_message, with_reject_reason
from tidemark.operators.sessions import merge_sessions, user_sessions
from tidemark.sinks.folders import FolderTable, Manifest
from tidemark.streaming.io import batch_folder, bounded_run, bucket_of, commit_log, once_per_batch, read_committed


def with_event_time(stream: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_dedup(
    stream: DataFrame, key: str = "event_id", ts: str = "event_timestamp", watermark: str = "1 day", salts: int = 8
) -> DataFrame:
    """Repeated deliveries of an event are dropped while they arrive within the watermark.

    Events more than the watermark behind the newest one are lost, copies or not; `run_dedup` keeps them.

    Copies are first dropped per (key, salt), so that an event delivered very many times does not send
    all its copies to one task; at most one copy per salt reaches the second step, which decides. With
    `salts=1` there is only that step, and state is kept once instead of twice.
    """
    rows = with_event_time(stream, ts).withWatermark(ts, watermark)
    if salts > 1:
        salted = rows.withColumn("__salt", F.floor(F.rand(seed=0) * salts).cast("int"))
        rows = salted.dropDuplicatesWithinWatermark([key, "__salt"]).drop("__salt")
    return rows.dropDuplicatesWithinWatermark([key])


class SeenKeys:
    """The keys of all events so far, in folders by hash, with a filter per folder.

    A filter is a handful of bitmaps of 4 KiB, one per block of its folder; a key sets one bit of one block and may
    be new only if its bit was not set. So a batch reads the filters, and of the keys only the folders in which one
    of its bits was set before, however many batches came earlier.
    """

    def __init__(self, spark: SparkSession, root: str, kind: T.DataType, folders: int = 64, blocks: int = 64, most: int = 8):
        self.spark, self.folders, self.blocks, self.most = spark, folders, blocks, most
        number, folder = T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())
        self.keys = FolderTable(spark, f"{root}/keys", "bucket", T.StructType([T.StructField("key", kind), number, folder]))
        block, bits = T.StructField("block", T.LongType()), T.StructField("bits", T.BinaryType())
        self.filters = FolderTable(spark, f"{root}/filters", "bucket", T.StructType([block, bits, folder]))

    def _placed(self, keys: DataFrame) -> DataFrame:
        """(key, bucket, block, bit): where each key belongs."""
        spot = F.xxhash64("key", F.lit(1))
        return keys.select(
            "key",
            bucket_of(["key"], self.folders).alias("bucket"),
            F.pmod(F.shiftright(spot, 15), F.lit(self.blocks)).alias("block"),
            spot.bitwiseAND(F.lit(32767)).alias("bit"),
        )

    def unseen(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """The keys (one row each) that no earlier batch has stored."""
        known = self.filters.manifest()
        if not known.batches:
            return keys
        filters = self.filters.read(known).withColumnsRenamed({"bucket": "b", "block": "k"})
        placed = self._placed(keys)
        met = placed.join(filters, (F.col("bucket") == F.col("b")) & (F.col("block") == F.col("k")), "left")
        byte = F.conv(F.hex(F.substring("bits", (F.shiftright("bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = F.getbit(byte, F.col("bit").bitwiseAND(F.lit(7)).cast("int")) == 1
        marked = met.select("key", "bucket", F.coalesce(hit, F.lit(False)).alias("maybe"))
        # One row per folder at most, and there are only so many folders.
        opened = [str(r.bucket) for r in marked.where("maybe").select("bucket").distinct().collect()]
        if not opened:
            return keys
        stored = self.keys.read(folders=opened).where(F.col("batch_id") < batch_id).select("key")
        return marked.where("not maybe").select("key").unionByName(marked.where("maybe").select("key").join(stored, "key", "left_anti"))

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Store new keys. A repeated batch does no harm: its own keys do not count, and equal ones are merged."""
        rows = self._placed(keys)
        before = self.keys.manifest()
        after = self.keys.append(before, rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        self.keys.compact(after, self.most, lambda df: df.groupBy("key", "bucket").agg(F.min("batch_id").alias("batch_id")))
        bits = rows.groupBy("bucket", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
        known = self.filters.manifest()
        touched = [str(r.bucket) for r in rows.select("bucket").distinct().collect()]
        both = self.filters.read(known, touched).unionByName(bits.select("block", "bits", "bucket"))
        self.filters.replace(known, both.groupBy("block", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")), touched)


def run_dedup(stream: DataFrame, root: str, key: str = "event_id", **sizes: int) -> DataFrame:
    """Run to the end of the available data and return the first delivery of every event, however late.

    Each batch drops its own copies, then the events whose key `SeenKeys` holds (`sizes` are its). Events without a
    key are no copies: all stay. A batch is read once it is committed; a repeated batch replaces itself and does not
    see itself.
    """
    spark, out = stream.sparkSession, f"{root}/out"
    seen = SeenKeys(spark, root, stream.schema[key].dataType, **sizes)

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = f"{root}/new-keys/turn={batch_id % 2}"
        keys = batch.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
        seen.unseen(keys, batch_id).write.mode("overwrite").parquet(stored)
        new = spark.read.schema(T.StructType([T.StructField("key", stream.schema[key].dataType)])).parquet(stored)
        once = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        fresh = once.join(new, once[key] == new["key"], "left_semi").select(*stream.columns)
        alone = batch.where(F.col(key).isNull()).select(*stream.columns)
        seen.add(new, batch_id)
        fresh.unionByName(alone).write.mode("overwrite").parquet(batch_folder(out, batch_id))

    bounded_run(stream, write, f"{root}/checkpoint", log=commit_log(out))
    return read_committed(spark, out, stream.schema)


def stream_sessions(
    stream: DataFrame, gap_minutes: int = 30, watermark: str = "1 hour", ts: str = "event_timestamp"
) -> DataFrame:
    """Sessions split by pauses of more than `gap_minutes` whole minutes, as in the batch operator.

    Session windows that touch are merged, so the gap is one microsecond short of the first whole minute
    that ends a session.
    """
    window = F.session_window(ts, f"{gap_minutes} minutes 59 seconds 999999 microseconds")
    return (
        with_event_time(stream, ts)
        .withWatermark(ts, watermark)
        .groupBy("user_id", window)
        .agg(
            F.min(ts).alias("session_start"),
            F.max(ts).alias("session_end"),
            F.count(F.lit(1)).alias("events_in_session"),
        )
        .select(
            "user_id",
            F.col("session_start").cast("timestamp_ntz").alias("session_start"),
            F.col("session_end").cast("timestamp_ntz").alias("session_end"),
            "events_in_session",
        )
    )


def run_sessions(events: DataFrame, root: str, gap_minutes: int = 30, most: int = 8, grain: str = "day") -> DataFrame:
    """Run to the end of the available data and return all sessions, whatever the order in which events came.

    A batch stores only its own events' sessions, in folders by the day (or month) of their start. They are put together with those of other
    batches when they are read, and in the folders themselves once one consists of more than `most` batches; late
    events close the pause between two sessions like any others. A repeated batch is stored once.
    """
    spark = events.sparkSession
    parts = "user_id string, session_start timestamp_ntz, session_end timestamp_ntz, events_in_session bigint, period date"
    table = FolderTable(spark, f"{root}/out", "period", T.StructType.fromDDL(parts))

    def placed(sessions: DataFrame) -> DataFrame:
        return sessions.withColumn("period", F.to_date(F.date_trunc(grain, "session_start")))

    def change(batch: DataFrame, before: Manifest, number: str) -> None:
        own = user_sessions(batch.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")), gap_minutes)
        after = table.append(before, placed(own), number)
        table.compact(after, most, lambda rows: placed(merge_sessions(rows, gap_minutes)))

    bounded_run(events.select("user_id", "event_timestamp"), once_per_batch(table, change), f"{root}/checkpoint")
    return merge_sessions(table.read(), gap_minutes)


def stream_daily_metrics(
    stream: DataFrame, watermark: str = "1 day", purchase: str = "purchase", rsd: float = 0.02
) -> DataFrame:
    """Events, purchases and approximately distinct users per day."""
    ts = "event_timestamp"
    return (
        with_event_time(stream, ts)
        .withWatermark(ts, watermark)
        .groupBy(F.window(ts, "1 day").alias("w"))
        .agg(
            F.approx_count_distinct("user_id", rsd).alias("active_users"),
            F.count(F.lit(1)).alias("total_events"),
            F.count_if(F.col("event_name") == purchase).alias("purchases"),
        )
        .select(F.to_date("w.start").alias("event_date"), "active_users", "total_events", "purchases")
    )


def run_split_messages(messages: DataFrame, root: str) -> tuple[DataFrame, DataFrame]:
    """Valid events, and refused messages with key, value and reason, of a stream of messages."""
    valid, refused = run_split(messages, root, parse_with_message)
    return valid.drop("key", "value"), refused.select("key", "value", "reject_reason")


def run_split(
    events: DataFrame, root: str, mark: Callable[[DataFrame], DataFrame] = with_reject_reason
) -> tuple[DataFrame, DataFrame]:
    """Store valid and refused events of a stream in one write per batch; returns both tables."""
    out, marked = f"{root}/out", mark(events)

    def write(batch: DataFrame, batch_id: int) -> None:
        routed = batch.withColumn("valid", F.col("reject_reason").isNull())
        routed.write.mode("overwrite").partitionBy("valid").parquet(batch_folder(out, batch_id))

    bounded_run(marked, write, f"{root}/checkpoint", log=commit_log(out))
    schema = T.StructType([*marked.schema.fields, T.StructField("valid", T.BooleanType())])
    stored = read_committed(events.sparkSession, out, schema)
    columns = [c for c in marked.columns if c != "reject_reason"]
    return stored.where(F.col("valid")).select(*columns), stored.where(~F.col("valid")).select(*columns, "reject_reason")


def run_last_n(events: DataFrame, root: str, n: int = 100, key: str | None = None, buckets: int = 8) -> DataFrame:
    """Mean of the latest n amounts after all available events.

    State is a table of the latest n events (per key), in folders by key: a batch rewrites only the folders of its
    keys. It first shrinks to its own latest n in every map task, so one busy key costs no task more than the
    others. A repeated batch is taken once.
    """
    spark: SparkSession = events.sparkSession
    rows = events.select(*dict.fromkeys(["timestamp", "order_id", "amount", *([key] if key else [])]))
    schema = T.StructType([*rows.schema.fields, T.StructField("bucket", T.IntegerType())])
    state = FolderTable(spark, f"{root}/state", "bucket", schema)
    bucket = bucket_of([key], buckets) if key else F.lit(0)

    def change(batch: DataFrame, before: Manifest, number: str) -> None:
        # Kept, so that the batch is read once: at most n rows, or n per key.
        latest = last_n(batch, n, key).withColumn("bucket", bucket).persist()
        touched = [str(r.bucket) for r in latest.select("bucket").distinct().collect()]
        both = latest.unionByName(state.read(before, touched))
        state.replace(before, last_n(both, n, key), touched, number)
        latest.unpersist()

    bounded_run(rows, once_per_batch(state, change), f"{root}/checkpoint")
    return mean_of_last(state.read().drop("bucket"), key)
