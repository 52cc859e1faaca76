"""Lake tables: partitioned writes, file selection, incremental refresh, stored warehouse."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from samples import small_warehouse, ts
from tidemark.operators import cleaning, history, quality
from tidemark.operators.revenue import fct_revenue_from_staging, order_refunds
from tidemark.plans import contracts, incremental
from tidemark.plans.quality_rules import CONTRACT_NOT_NULL, FCT_REVENUE_CONTRACT, RULES, STG_ORDERS_CONTRACT
from tidemark.plans.stored_history import StoredHistory
from tidemark.plans.warehouse import MODELS
from tidemark.sinks import writers
from tidemark.sinks.folders import FolderTable
from tidemark.sources import readers, schemas


def lake(spark):
    data = [(str(i), "c", "s", float(i), "x", "ok", 2024 if i % 3 else None, 1 + i % 2, 1) for i in range(12)]
    return spark.createDataFrame(data, schemas.LAKE_ORDERS)


def test_partitioned_write_keeps_null_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "lake")
    writers.write_partitioned(lake(spark), path, ["year", "month"], sort_by=["order_id"])
    back = spark.read.schema(schemas.LAKE_ORDERS).parquet(path)
    assert rows(back.select(lake(spark).columns)) == rows(lake(spark))
    assert writers.write_read_verify(lake(spark), str(tmp_path / "again"), ["year"]).first()[0] == 12


def test_prefix_and_missing_prefix(spark, tmp_path, rows):
    writers.write_partitioned(lake(spark), str(tmp_path / "orders"), ["year", "month"])
    whole = readers.read_parquet_prefix(spark, str(tmp_path), "orders/", schemas.LAKE_ORDERS)
    assert whole.count() == 12
    one = readers.read_parquet_prefix(spark, str(tmp_path), "orders/year=2024/", schemas.LAKE_ORDERS)
    assert one.count() == 8 and one.select("year").distinct().collect() == [(2024,)]
    none = readers.read_parquet_prefix(spark, str(tmp_path), "nothing/", schemas.LAKE_ORDERS)
    assert none.schema == schemas.LAKE_ORDERS and none.count() == 0


def test_unprocessed_files_are_told_apart_by_folder(spark, tmp_path, rows):
    source, done = tmp_path / "source", tmp_path / "done"
    for folder in (source / "day=1", source / "day=2", done / "day=1"):
        folder.mkdir(parents=True)
    for i, folder in enumerate((source / "day=1", source / "day=2")):
        spark.range(i + 1).coalesce(1).write.parquet(str(tmp_path / f"tmp{i}"))
        part = next((tmp_path / f"tmp{i}").glob("*.parquet"))
        (folder / "part-000.parquet").write_bytes(part.read_bytes())
    (done / "day=1" / "part-000.parquet").write_bytes((source / "day=1" / "part-000.parquet").read_bytes())
    todo = writers.unprocessed_in(spark, str(source), str(done))
    assert rows(todo, "relative_path") == [("day=2/part-000.parquet",)]
    assert writers.read_selected(spark, str(source), todo).count() == 2
    nothing = writers.read_selected(spark, str(source), todo.where("false"))
    assert nothing.count() == 0 and nothing.columns == ["id", "day"]


USERS = [("1", "2024-01-01", "in", "ads", 1), ("2", "2024-01-01", None, "x", 1), ("3", "2024-01-02", "us", "ads", 1)]
ORDERS = [
    ("1", "1", "2024-01-01", 10, 1),
    ("2", "2", "2024-01-02", 20, 1),
    ("3", "3", "2024-01-03", 30, 1),
    ("4", "9", "2024-01-10", 40, 1),
    ("5", None, "2024-01-11", 50, 1),
    (None, "1", None, 60, 1),
]
REFUNDS = [("r1", "1", 1, "2024-01-02", 1), ("r2", "3", 2, "2024-01-04", 1), ("r3", None, 7, "2024-01-04", 1)]


def test_selected_files_prune_folders_at_run_time(spark, tmp_path, rows):
    path = str(tmp_path / "la ke+x")
    writers.write_partitioned(lake(spark), path, ["year", "month"])
    files = readers.list_files(spark, path)
    for chosen in ("relative_path like '%month=2/%'", "relative_path like '%HIVE_DEFAULT%'", "true"):
        got = writers.read_selected(spark, path, files.where(chosen))
        expected = {"true": "true", "relative_path like '%month=2/%'": "month = 2"}.get(chosen, "year is null")
        assert rows(got, *lake(spark).columns) == rows(lake(spark).where(expected))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text


def users_at(spark, *data):
    return spark.createDataFrame([(k, c, ts(t)) for k, c, t in data], "user_id string, country string, seen timestamp_ntz")


def test_stored_history_rewrites_the_folders_of_its_batch(spark, tmp_path, rows):
    first = users_at(spark, *[(str(i), "a", "2024-01-01") for i in range(300)])
    kept = StoredHistory(spark, str(tmp_path), first.schema, "user_id", "seen", buckets=64)
    assert kept.apply(first) == 64
    before = kept.table.manifest().batches
    few = [(str(i), "b", "2024-02-01") for i in range(10)]
    assert kept.apply(users_at(spark, *few)) <= 10
    after = kept.table.manifest().batches
    assert sum(after.get(f) != b for f, b in before.items()) <= 10
    plain = history.scd2_apply(history.open_history(first, "user_id", "seen"), users_at(spark, *few), "user_id", "seen")
    assert rows(kept.read()) == rows(plain)
    third = users_at(spark, ("3", "c", "2024-03-01"), ("999", "x", "2024-03-01"), ("4", "old", "2023-01-01"))
    kept.apply(third)
    plain = history.scd2_apply(plain, third, "user_id", "seen")
    assert rows(kept.read()) == rows(plain) and rows(kept.current()) == rows(plain.where("is_current"))
    # Closed versions are added to, never rewritten.
    closed = {f: b for f, b in kept.table.manifest().batches.items() if f.startswith("closed-")}
    assert all(closed[f][: len(b)] == b for f, b in after.items() if f.startswith("closed-"))


def test_a_broken_contract_leaves_the_last_version(spark, tmp_path, rows):
    path, orders = str(tmp_path / "orders"), small_warehouse(spark).stg_orders
    rules = RULES["stg_orders"]

    def store(df):
        return contracts.store_checked(df, path, "stg_orders", STG_ORDERS_CONTRACT, CONTRACT_NOT_NULL, rules)

    expected = rows(store(orders))
    broken = {
        "order_amount": orders.withColumn("order_amount", F.lit(-1).cast("decimal(38,9)")),
        "user_id": orders.withColumn("user_id", F.lit(None).cast("string")),
        "order_id": orders.unionByName(orders),
        "currency": orders.drop("currency"),
        "created_at": orders.withColumn("created_at", F.lit("x")),
        "more": orders.withColumn("more", F.lit(1)),
    }
    for column, df in broken.items():
        with pytest.raises(contracts.ContractBroken) as refused:
            store(df)
        assert [c for c, _ in refused.value.issues][0] == column
        assert rows(writers.read_table(spark, path, orders.schema)) == expected
    assert rows(store(orders.limit(1))) == rows(writers.read_table(spark, path, orders.schema))


def loads(spark, users=(), orders=(), refunds=(), through=99):
    """Raw tables from short rows that end with the day of January on which they were loaded."""
    day = lambda n: dt.date(2024, 1, n)
    at = lambda t: None if t is None else ts(t)
    known = lambda rows_: [r for r in rows_ if r[-1] <= through]
    return (
        spark.createDataFrame([(o, u, at(t), Decimal(a), "USD", None, day(n)) for o, u, t, a, n in known(orders)], schemas.ORDERS_RAW),
        spark.createDataFrame([(u, at(t), c, a, day(n)) for u, t, c, a, n in known(users)], schemas.USERS_RAW),
        spark.createDataFrame([(r, o, Decimal(a), "", at(t), day(n)) for r, o, a, t, n in known(refunds)], schemas.REFUNDS_RAW),
    )


def rebuilt(orders, users, refunds):
    return fct_revenue_from_staging(cleaning.stg_orders(orders), cleaning.stg_users(users), order_refunds(cleaning.stg_refunds(refunds)))


# What a second day of loads may bring, with the number of days of the fact that have to be written for it.
SECOND = {
    "nothing": ({}, 0),
    "a corrected amount": ({"orders": [("1", "1", "2024-01-01", 999, 2)]}, 1),
    "an order on another day, its old day left empty": ({"orders": [("3", "3", "2024-01-05", 30, 2)]}, 2),
    "a new order": ({"orders": [("6", "1", "2024-01-12", 5, 2)]}, 1),
    "an old refund, loaded late": ({"refunds": [("r9", "2", 3, "2023-12-30", 2)]}, 1),
    "a refund that moves to another order": ({"refunds": [("r1", "2", 1, "2024-01-03", 2)]}, 2),
    "a value that moves to a NULL neighbour": ({"users": [("2", "2024-01-01", "x", None, 2)]}, 1),
    "a user whose order is there already": ({"users": [("9", "2024-01-01", "de", "ads", 2)]}, 1),
    "an order without id and date": ({"orders": [(None, "1", "2024-01-01", 61, 2)]}, 2),
    "a refund for no order": ({"refunds": [("r3", None, 8, "2024-01-05", 2)]}, 1),
}


GRAINS = [(case, "day") for case in SECOND] + [("an order on another day, its old day left empty", "month")]


@pytest.mark.parametrize("case, grain", GRAINS)
def test_refresh_equals_rebuild(spark, tmp_path, rows, case, grain):
    more, written = SECOND[case]
    # The last day that was read is read again: here, that of the seventh order.
    tables = {"users": USERS, "orders": [*ORDERS, ("7", "1", "2024-01-20", 1, 2)], "refunds": REFUNDS}
    tables = {name: [*own, *[(*r[:-1], 3) for r in more.get(name, ())]] for name, own in tables.items()}
    path = str(tmp_path / "fact")
    fact = incremental.fact_table(spark, path, grain)
    assert incremental.refresh_revenue(spark, path, *loads(spark, **tables, through=2), grain=grain) == (7 if grain == "day" else 2)
    before = fact.manifest()
    assert rows(incremental.read_fact(spark, path, grain)) == rows(rebuilt(*loads(spark, **tables, through=2)))
    n = incremental.refresh_revenue(spark, path, *loads(spark, **tables), grain=grain)
    assert rows(incremental.read_fact(spark, path, grain)) == rows(rebuilt(*loads(spark, **tables)))
    # Readers of the version before still see it.
    assert rows(fact.read(before).select("order_id", "net_revenue")) == rows(rebuilt(*loads(spark, **tables, through=2)), "order_id", "net_revenue")
    after = fact.manifest().batches
    changed = {f for f in {*before.batches, *after} if after.get(f) != before.batches.get(f)}
    assert len(changed) == n == (written + 1 if grain == "day" else 1)


def test_a_failed_refresh_leaves_the_fact(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "fact")
    incremental.refresh_revenue(spark, path, *loads(spark, USERS, ORDERS, REFUNDS))
    expected = rows(incremental.read_fact(spark, path))
    more = loads(spark, USERS, [*ORDERS, ("3", "3", "2024-01-06", 31, 2)], REFUNDS)
    with monkeypatch.context() as patch:
        patch.setattr(FolderTable, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            incremental.refresh_revenue(spark, path, *more)
    assert rows(incremental.read_fact(spark, path)) == expected
    incremental.refresh_revenue(spark, path, *more)
    assert rows(incremental.read_fact(spark, path)) == rows(rebuilt(*more))


def test_random_loads_equal_rebuild_every_day(spark, tmp_path, rows):
    rng = random.Random(5)
    some = lambda values: rng.choice(values)
    users, orders, refunds = [], [], []
    for n in range(1, 6):
        users += [(str(rng.randint(1, 6)), f"2024-01-0{n}", some(["a", None, "b"]), some(["x", None]), n) for _ in range(3)]
        orders += [
            (str(rng.randint(1, 15)), some(["1", "2", "3", "7", None]), f"2024-01-{rng.randint(1, 9):02}", rng.randint(1, 99), n)
            for _ in range(8)
        ]
        refunds += [(f"r{rng.randint(1, 8)}", str(rng.randint(1, 15)), rng.randint(1, 60), f"2024-01-{rng.randint(1, 20):02}", n) for _ in range(4)]
        known = loads(spark, users, orders, refunds)
        incremental.refresh_revenue(spark, str(tmp_path), *known)
        assert rows(incremental.read_fact(spark, str(tmp_path))) == rows(rebuilt(*known))


def test_filters_on_the_day_open_few_folders(spark, tmp_path):
    incremental.refresh_revenue(spark, str(tmp_path), *loads(spark, USERS, ORDERS, REFUNDS))
    one = incremental.read_fact(spark, str(tmp_path)).where(F.col("order_date") == "2024-01-02")
    assert "PartitionFilters: [isnotnull(order_date" in one._jdf.queryExecution().executedPlan().toString()
    table = incremental.fact_table(spark, str(tmp_path))
    assert len(table.read(folders=["2024-01-02", "2024-01-31"]).inputFiles()) == 1


def test_two_writers_of_a_folder_table(spark, tmp_path, rows):
    schema = T.StructType.fromDDL("k int, v string")
    table = FolderTable(spark, str(tmp_path), "k", schema)
    assert table.read().count() == 0
    frame = lambda data: spark.createDataFrame(data, schema)
    first = table.append(table.manifest(), frame([(1, "a"), (None, "b")]), "one")
    second = table.append(first, frame([(1, "c"), (2, "d")]), "two")
    with pytest.raises(RuntimeError, match="published after"):
        table.append(first, frame([(3, "x")]))
    assert rows(table.read()) == rows(frame([(1, "a"), (None, "b"), (1, "c"), (2, "d")]))
    with pytest.raises(ValueError, match="outside"):
        table.replace(second, frame([(2, "y")]), ["1"])
    third = table.replace(second, frame([(1, "z")]), ["1", None])
    assert rows(table.read()) == rows(frame([(1, "z"), (2, "d")])) and third.version == 3
    many = table.append(third, frame([(1, "w"), (1, "w")]), "more")
    packed = table.compact(many, 1, lambda df: df.distinct())
    assert rows(table.read()) == rows(frame([(1, "w"), (1, "z"), (2, "d")])) and len(packed.batches["1"]) == 1
    assert table.compact(packed, 1) == packed and packed.note == "more"
    assert table.replace(packed, frame([]), ["1", "2"]).batches == {} and table.read().count() == 0


def test_stored_warehouse_passes_its_rules(spark, tmp_path):
    w = small_warehouse(spark)
    stored = w.save(str(tmp_path), MODELS)
    failed = quality.run_checks(stored, RULES).where("status = 'fail'").collect()
    assert failed == []
    assert quality.check_contract(stored["stg_orders"], STG_ORDERS_CONTRACT, CONTRACT_NOT_NULL, "o").count() == 0
    assert quality.check_contract(stored["fct_revenue"], FCT_REVENUE_CONTRACT, CONTRACT_NOT_NULL, "f").count() == 0


def test_appended_loads_add_up(spark, tmp_path):
    doc = spark.createDataFrame([('{"rates": {"EUR": 0.9}}',)], "value string")
    for stamp in ("a", "b"):
        writers.append_rates(readers.explode_rates(doc, ingested_at=stamp), str(tmp_path / "rates"))
    got = spark.read.parquet(str(tmp_path / "rates"))
    assert {r._ingested_at for r in got.collect()} == {"a", "b"} and got.where(F.col("base_currency") == "USD").count() == 2


def test_shared_models_are_kept_and_released(spark):
    w = small_warehouse(spark)
    with w.cached("stg_events") as kept:
        assert kept.stg_events.is_cached
        assert "InMemoryTableScan" in kept.mart_growth_metrics._jdf.queryExecution().executedPlan().toString()
    assert not w.stg_events.is_cached


def test_saving_twice_and_failing_once(spark, tmp_path, rows):
    w = small_warehouse(spark)
    first = w.save(str(tmp_path), ["stg_orders", "fct_revenue"])
    expected = rows(first["fct_revenue"])
    again = w.save(str(tmp_path), ["stg_orders", "fct_revenue"])
    assert rows(again["fct_revenue"]) == rows(first["fct_revenue"]) == expected
    path = f"{tmp_path}/fct_revenue"
    with pytest.raises(Exception, match="broken"):
        broken = again["fct_revenue"].withColumn("order_id", F.raise_error(F.lit("broken")).cast("string"))
        writers.write_table(broken, path, ["order_date"])
    stored = writers.read_table(spark, path, first["fct_revenue"].schema).select(*first["fct_revenue"].columns)
    assert rows(stored) == expected
    one_day = first["fct_revenue"].where(F.col("order_date") == "2024-01-01")
    text = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in text


def test_net_revenue_is_computed_where_it_is_written(spark, monkeypatch):
    from tidemark.plans.registry import QUERIES
    from tidemark.sinks import folders

    moved, write = [], folders.write_partitioned

    def watched(df, *args, **kwargs):
        moved.append(df.columns)
        write(df, *args, **kwargs)

    monkeypatch.setattr(folders, "write_partitioned", watched)
    fact = QUERIES["incremental_revenue"](spark, "/root/testdata/sf0.001")
    assert len(moved) == 2 and not any("net_revenue" in columns for columns in moved)
    stored = fact.select("order_amount", "total_refund_amount", "net_revenue").collect()
    assert stored and all(r.net_revenue == max(r.order_amount - r.total_refund_amount, 0) for r in stored)
