"""Streams: equal to their batch twins, over several batches, after restarts and repeated batches."""

from __future__ import annotations

import datetime as dt
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from samples import events
from tidemark.operators import order_events, sessions
from tidemark.session import fresh_dir
from tidemark.sinks.folders import FolderTable
from tidemark.sources import schemas, star_schema
from tidemark.streaming import io, operators

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def topic(spark):
    path = fresh_dir(spark, "topic")
    messages = order_events.to_keyed_json(star_schema.order_events(spark, SF))
    for part in range(3):
        io.write_topic(messages.where(F.pmod(F.xxhash64("key"), F.lit(3)) == part), path)
    return path


def stream(spark, topic):
    parsed = order_events.parse_order_events(io.stream_source(spark, path=topic, options={"maxFilesPerTrigger": "1"}))
    return order_events.split_valid_invalid(parsed)[0]


def batch(spark):
    return order_events.split_valid_invalid(star_schema.order_events(spark, SF))[0]


def test_running_metrics_over_batches(spark, topic, rows):
    for op in (order_events.running_city_metrics, order_events.running_seller_revenue, order_events.running_totals):
        got = io.run_complete(op(stream(spark, topic)), fresh_dir(spark, "stream"))
        assert rows(got) == rows(op(batch(spark)))


def files_of(spark, frames, schema, per_batch="1"):
    """A stream that takes one file per frame, in order."""
    path = fresh_dir(spark, "files")
    for i, frame in enumerate(frames):
        spark.createDataFrame(frame, schema).coalesce(1).write.parquet(f"{path}/part={i:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path).drop("part")


def test_changed_keys_only(spark, rows):
    rng = random.Random(1)
    schema = "seller_id string, amount double"
    frames = [[(rng.choice(["a", "b", None, f"s{i}"]), float(rng.randint(1, 9))) for _ in range(5)] for i in range(12)]
    root = fresh_dir(spark, "stream")
    live = order_events.running_seller_revenue(files_of(spark, frames, schema))
    got = io.run_update(live, root, ["seller_id"], buckets=2, most=3)
    assert rows(got) == rows(order_events.running_seller_revenue(spark.createDataFrame(sum(frames, []), schema)))
    # A reader opens one snapshot and a few changes per folder, and the changes are those of single batches.
    manifest = io.keyed_table(spark, f"{root}/out", live.schema).manifest()
    assert max(len(batches) for batches in manifest.batches.values()) <= 3 and manifest.note == "11"


def test_repeated_batch_of_changes_is_stored_once(spark, rows):
    root = fresh_dir(spark, "stream")
    live = order_events.running_seller_revenue(files_of(spark, [[("a", 1.0)], [("a", 2.0)]], "seller_id string, amount double"))
    got = rows(io.run_update(live, root, ["seller_id"]))
    table = io.keyed_table(spark, f"{root}/out", live.schema)
    before = table.manifest()
    # Both batches again, as after the loss of the checkpoint.
    io.bounded_run(live, io.store_changes(table, ["seller_id"], 8, 8), f"{root}/other", "update")
    assert table.manifest() == before
    assert got == rows(io.latest_of_keys(table.read(), ["seller_id"]).select("seller_id", "revenue")) == [("a", 3.0)]


@pytest.mark.parametrize("key", [None, "city"])
def test_last_n_over_batches(spark, topic, rows, key):
    got = operators.run_last_n(stream(spark, topic), fresh_dir(spark, "stream"), 10, key)
    assert rows(got) == rows(order_events.rolling_last_n_avg(batch(spark), 10, key))


def test_messages_are_read_as_json_once(spark, topic):
    messages = spark.read.schema(schemas.KEYED_MESSAGE).parquet(topic)
    valid, refused = order_events.split_valid_invalid(order_events.parse_order_events(messages))
    for df in (order_events.running_seller_revenue(valid), order_events.last_n(valid, 10), refused, order_events.split_messages(messages)[0]):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_messages_without_an_object_are_rows_of_nulls(spark):
    texts = [b'{"order_id":"1","amount":2.5}', None, b"null", b"[]", b"", b"{bad", b'{"order_id":"2","amount":"free"}']
    messages = spark.createDataFrame([(b"k", t) for t in texts], schemas.KEYED_MESSAGE)
    got = [(r.order_id, r.amount) for r in order_events.parse_order_events(messages).collect()]
    assert sorted(got, key=str) == sorted([("1", 2.5), *[(None, None)] * 5, ("2", None)], key=str)


@pytest.mark.parametrize("key", [None, "city"])
def test_last_n_reads_a_batch_once(spark, topic, monkeypatch, key):
    runs, run = [], io.bounded_run
    monkeypatch.setattr(operators, "bounded_run", lambda *a, **k: runs.append(run(*a, **k)))
    operators.run_last_n(stream(spark, topic), fresh_dir(spark, "stream"), 10, key)
    assert sum(p.numInputRows for p in runs[0].recentProgress) == spark.read.parquet(topic).count()


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_state_has_no_more_parts_than_cores(spark, topic, rows, monkeypatch, mode):
    name, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    before, many = spark.conf.get(name), str(3 * cores)
    runs, run = [], io.bounded_run
    monkeypatch.setattr(io, "bounded_run", lambda *a, **k: runs.append(run(*a, **k)))
    spark.conf.set(name, many)
    try:
        totals, root = order_events.running_seller_revenue(stream(spark, topic)), fresh_dir(spark, "stream")
        got = io.run_update(totals, root, ["seller_id"]) if mode == "update" else io.run_complete(totals, root)
        assert {s.numShufflePartitions for p in runs[0].recentProgress for s in p.stateOperators} == {cores}
        assert spark.conf.get(name) == many
        assert rows(got) == rows(order_events.running_seller_revenue(batch(spark)))
    finally:
        spark.conf.set(name, before)


def test_a_large_topic_file_is_work_for_several_tasks(spark):
    path = fresh_dir(spark, "topic")
    text = F.concat(*[F.sha2((F.col("id") * 20 + i).cast("string"), 512) for i in range(20)])
    io.write_topic(spark.range(20000).select(F.lit(b"one").alias("key"), text.cast("binary").alias("value")), path)
    files = [f for f in spark.read.parquet(path).inputFiles()]
    assert len(files) == 1 and pq.ParquetFile(files[0].removeprefix("file://")).num_row_groups >= 3
    assert io.batch_bytes(spark) == io.BATCH_BYTES_PER_CORE * spark.sparkContext.defaultParallelism


def test_refused_events_are_kept_with_their_reason(spark, topic, rows):
    parsed = order_events.parse_order_events(io.stream_source(spark, path=topic))
    valid, refused = operators.run_split(parsed, fresh_dir(spark, "stream"))
    expected_valid, expected_refused = order_events.split_valid_invalid(star_schema.order_events(spark, SF))
    assert rows(valid) == rows(expected_valid)
    assert rows(refused) == rows(expected_refused)
    assert valid.count() + refused.count() == star_schema.order_events(spark, SF).count()


def test_failed_batch_is_repeated_without_duplicates(spark, topic):
    root = fresh_dir(spark, "stream")
    source = io.stream_source(spark, path=topic, options={"maxFilesPerTrigger": "1"})
    write = io.append_batches(f"{root}/out")

    def fails_once_stored(rows_, batch_id):
        write(rows_, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost after the output was stored")

    with pytest.raises(Exception, match="lost after"):
        io.bounded_run(source, fails_once_stored, f"{root}/checkpoint")
    io.bounded_run(source, write, f"{root}/checkpoint")
    stored = spark.read.schema(schemas.KEYED_MESSAGE).parquet(f"{root}/out")
    assert stored.count() == spark.read.parquet(topic).count()
    assert stored.select("key").distinct().count() == stored.count()


def test_state_of_last_n_survives_a_restart(spark, topic, rows):
    root = fresh_dir(spark, "stream")
    messages = order_events.to_keyed_json(star_schema.order_events(spark, SF))
    late = fresh_dir(spark, "topic")
    first = F.pmod(F.xxhash64("key"), F.lit(2)) == 0
    for part in (first, ~first):
        io.write_topic(messages.where(part), late)
        got = operators.run_last_n(stream(spark, late), root, 10)
    assert rows(got) == rows(order_events.rolling_last_n_avg(batch(spark), 10))
    # A run that finds nothing new still reports the stored state.
    assert rows(operators.run_last_n(stream(spark, late), root, 10)) == rows(got)


def written_events(spark, data):
    path = fresh_dir(spark, "events")
    events(spark, data).write.parquet(path)
    schema = "event_id string, user_id string, event_name string, event_timestamp timestamp_ntz"
    return spark.readStream.schema(schema).parquet(path), spark.read.parquet(path)


def test_sessions_split_like_the_batch(spark, rows):
    base = dt.datetime(2024, 1, 1, 10)
    gaps = [0, 30 * 60 + 59, 31 * 60, 5, 31 * 60 + 1]
    times = [base + dt.timedelta(seconds=sum(gaps[: i + 1])) for i in range(len(gaps))]
    live, stored = written_events(spark, [("u", "x", t) for t in times] + [("v", "x", base)])
    got = io.run_complete(operators.stream_sessions(live), fresh_dir(spark, "stream"))
    assert rows(got) == rows(sessions.user_sessions(stored).select(got.columns))
    assert got.where("user_id = 'u'").count() == 3


def test_closed_sessions_are_put_out_once(spark, rows):
    live, stored = written_events(
        spark, [("u", "x", f"2024-01-01 {h:02}:00") for h in range(6)] + [("v", "x", "2024-01-01 00:10")]
    )
    closed = io.run_append(operators.stream_sessions(live, watermark="1 minute"), fresh_dir(spark, "stream"))
    expected = rows(sessions.user_sessions(stored).select(closed.columns))
    last = dt.datetime(2024, 1, 1, 5)
    assert rows(closed) == [r for r in expected if r[1] != last]


def test_rows_of_a_batch_are_read_once_it_is_committed(spark, topic):
    root = fresh_dir(spark, "stream")
    out, source = f"{root}/out", io.stream_source(spark, path=topic, options={"maxFilesPerTrigger": "1"})
    log, write, runs = io.commit_log(out), io.append_batches(out), []

    def fails_later(rows_, batch_id):
        runs.append(batch_id)
        write(rows_, batch_id)
        if len(runs) == 2:
            raise RuntimeError("lost after the output was stored")

    with pytest.raises(Exception, match="lost after"):
        io.bounded_run(source, fails_later, f"{root}/checkpoint", log=log)
    stored = spark.read.schema(schemas.KEYED_MESSAGE).parquet(out).count()
    seen = io.read_committed(spark, out, schemas.KEYED_MESSAGE).count()
    assert 0 < seen < stored and io.committed(spark, log) == 0
    io.bounded_run(source, fails_later, f"{root}/checkpoint", log=log)
    total = spark.read.parquet(topic).count()
    assert io.read_committed(spark, out, schemas.KEYED_MESSAGE).count() == total
    # A committed batch whose checkpoint was lost is not run again.
    done = len(runs)
    io.bounded_run(source, fails_later, f"{root}/other-checkpoint", log=log)
    assert len(runs) == done


def test_sessions_from_files_out_of_order(spark, rows):
    rng = random.Random(2)
    base = dt.datetime(2024, 1, 1, 22)
    data = [(rng.choice(["a", "b", "c", None]), base + dt.timedelta(minutes=rng.randint(0, 2500))) for _ in range(300)]
    data += [("edge", base), ("edge", base + dt.timedelta(minutes=30, seconds=59)), ("edge", base + dt.timedelta(minutes=61, seconds=59))]
    rng.shuffle(data)
    schema = "user_id string, event_timestamp timestamp_ntz"
    live = files_of(spark, [data[i::7] for i in range(7)], schema)
    root = fresh_dir(spark, "stream")
    got = operators.run_sessions(live, root, most=2)
    expected = sessions.user_sessions(spark.createDataFrame(data, schema))
    assert rows(got) == rows(expected.select(got.columns))
    # A run that finds nothing new reports the same.
    assert rows(operators.run_sessions(live, root, most=2)) == rows(got)


def test_a_late_event_joins_two_closed_sessions(spark):
    at = lambda minute: dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=minute)
    live = files_of(spark, [[("u", at(0)), ("u", at(50))], [("u", at(500))], [("u", at(25))]], "user_id string, event_timestamp timestamp_ntz")
    got = operators.run_sessions(live, fresh_dir(spark, "stream"))
    assert sorted((r.session_start, r.events_in_session) for r in got.collect()) == [(at(0), 3), (at(500), 1)]


def test_only_folders_with_a_possible_copy_are_opened(spark, monkeypatch):
    opened = []
    read = FolderTable.read

    def watched(self, manifest=None, folders=None):
        if self.root.endswith("/keys") and manifest is None:
            opened.append(sorted(folders))
        return read(self, manifest, folders)

    monkeypatch.setattr(FolderTable, "read", watched)
    frames = [[(f"{i}-{k}", k) for k in range(3)] for i in range(6)] + [[("2-1", 9), ("new", 9)], [(None, 1), (None, 1), ("new", 3)]]
    live = files_of(spark, frames, "event_id string, n int")
    got = operators.run_dedup(live, fresh_dir(spark, "stream"), folders=16, blocks=4, most=2)
    keys = [r.event_id for r in got.collect()]
    assert sorted(k for k in keys if k) == sorted([f"{i}-{k}" for i in range(6) for k in range(3)] + ["new"])
    assert keys.count(None) == 2
    # Six batches without a copy read no stored keys at all; the two others read one folder each.
    assert [len(folders) for folders in opened] == [1, 1]


@pytest.mark.parametrize("salts", [1, 4])
def test_stream_dedup(spark, salts):
    live, stored = written_events(spark, [("u", "x", "2024-01-01 10:00"), ("u", "x", "2024-01-01 10:05")])
    often = live.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("copy")
    got = io.run_append(operators.stream_dedup(often, salts=salts), fresh_dir(spark, "stream"))
    assert got.count() == stored.count() == 2


def test_late_first_deliveries_stay(spark, tmp_path):
    days = {1: "2024-01-10 00:00", 2: "2024-01-10 01:00", 3: "2024-01-05 00:00", 4: "2024-01-10 02:00"}
    for i, ids in enumerate([[1, 1], [2, 1], [3], [4, 3, 2]]):
        part = spark.createDataFrame([(k, days[k]) for k in ids], "event_id long, at string")
        part.select("event_id", F.to_timestamp("at").alias("event_timestamp")).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema("event_id long, event_timestamp timestamp").option("maxFilesPerTrigger", "1")
    got = operators.run_dedup(stream.parquet(str(tmp_path / "in/*")), fresh_dir(spark, "stream"))
    assert sorted(r.event_id for r in got.collect()) == [1, 2, 3, 4]


def test_daily_metrics(spark):
    live, _ = written_events(spark, [(f"u{i % 7}", "purchase" if i % 2 else "x", f"2024-01-0{1 + i % 3} 10:00") for i in range(90)])
    got = io.run_complete(operators.stream_daily_metrics(live), fresh_dir(spark, "stream"))
    assert [(r.total_events, r.purchases, r.active_users) for r in got.collect()] == [(30, 15, 7)] * 3


def test_payment_messages_round_trip(spark, rows):
    payments = star_schema.payment_events(spark, SF)
    back = order_events.parse_payment_events(order_events.to_keyed_json(payments))
    assert back.schema == schemas.PAYMENT_EVENT and rows(back) == rows(payments)


def test_broker_source_starts_at_the_earliest_record(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        io.stream_source(spark, "kafka", options={"subscribe": "orders", "kafka.bootstrap.servers": "unused:9092"})


def test_stream_without_any_file(spark, tmp_path, rows):
    (tmp_path / "topic").mkdir()
    got = io.run_complete(
        order_events.running_city_metrics(stream(spark, str(tmp_path / "topic"))), str(tmp_path / "run")
    )
    assert got.count() == 0
