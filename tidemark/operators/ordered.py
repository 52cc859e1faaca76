"""Row number, lag, running sum and moving mean per key, for keys of any size.

A plain window sends all rows of a key to one task. Here rows are first cut into ranges of (key, order), which
are even whatever the keys are, and windowed within (key, range); what a range inherits from the ones before it
(row count, sum, last value) is worked out on one row per key and range and added back. The result equals that
of the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import add_money, less_money, money
from tidemark.session import fresh_dir

PIECE = "__piece"


def in_pieces(df: DataFrame, *order: str, pieces: int | None = None) -> DataFrame:
    """The rows cut into `pieces` ranges of `order` (as many as shuffle partitions), numbered in `__piece`.

    They are stored in the shared folder: range bounds come from a sample, so working them out twice could
    place a row twice or nowhere. Only rows equal in all of `order` cannot be told apart.
    """
    spark = df.sparkSession
    n = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).withColumn(PIECE, F.spark_partition_id())
    path = fresh_dir(spark, "pieces")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank: str | None = None,
    lags: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """Add row number, previous value and running (exact, decimal) sum per key.

    `order` should identify a row within its key. `lags` and `sums` map new column names to existing ones.
    """
    placed = in_pieces(df, *keys, *order, pieces=pieces)
    return running_in_pieces(placed, keys, order, rank, lags, sums).drop(PIECE)


def running_in_pieces(
    placed: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank: str | None = None,
    lags: Mapping[str, str] | None = None,
    sums: Mapping[str, str] | None = None,
) -> DataFrame:
    """`with_running` on rows that `in_pieces` has cut by `keys` and `order`."""
    lags, sums = dict(lags or {}), dict(sums or {})
    # A struct compares NULL fields as equal, so NULL keys join like any other key.
    rows = placed.withColumn("__key", F.struct(*keys, PIECE))
    position = F.struct(*order)

    totals = [F.count(F.lit(1)).alias("__n")]
    totals += [F.sum(money(src)).alias(f"__sum_{out}") for out, src in sums.items()]
    totals += [F.max_by(F.struct(src), position).alias(f"__last_{out}") for out, src in lags.items()]
    per_piece = rows.groupBy("__key").agg(*totals)

    across = W.partitionBy(*[F.col(f"__key.{k}") for k in keys]).orderBy(f"__key.{PIECE}")
    before = across.rowsBetween(W.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n")]
    carried += [F.sum(f"__sum_{out}").over(before).alias(f"__sum_{out}") for out in sums]
    carried += [F.lag(f"__last_{out}").over(across).alias(f"__last_{out}") for out in lags]
    inherited = per_piece.select("__key", *carried)

    inside = W.partitionBy("__key").orderBy(*order)
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = rows.select(
        "*",
        F.row_number().over(inside).alias("__row"),
        *[F.sum(money(src)).over(upto).alias(f"__part_{out}") for out, src in sums.items()],
        *[F.lag(src).over(inside).alias(f"__prev_{out}") for out, src in lags.items()],
    )
    joined = local.join(inherited, "__key", "left")
    exprs = []
    if rank:
        exprs.append((F.col("__row") + F.col("__n")).cast("bigint").alias(rank))
    for out in lags:
        first = F.col("__row") == 1
        exprs.append(F.when(first, F.col(f"__last_{out}").getField(lags[out])).otherwise(F.col(f"__prev_{out}")).alias(out))
    for out in sums:
        part, past = F.col(f"__part_{out}"), F.col(f"__sum_{out}")
        exprs.append(F.when(past.isNull(), part).when(part.isNull(), past).otherwise(add_money(part, past)).alias(out))
    return joined.select(*placed.columns, *exprs)


def moving_average(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    n: int = 100,
    out: str = "moving_avg",
    chunk_rows: int = 100_000,
    pieces: int | None = None,
) -> DataFrame:
    """Mean of the last n rows (the current one included) per key.

    The sum over a frame is the difference of two running sums, which is exact in decimal and takes one
    step per row, whatever n is. Rows are numbered per key and looked back in chunks of `chunk_rows`;
    each chunk also receives the last n rows of the one before it.
    """
    if chunk_rows < n:
        raise ValueError("a chunk must hold at least one full frame")
    known = df.withColumn("__known", F.when(F.col(value).isNull(), 0).otherwise(1))
    summed = with_running(
        known, keys, order, rank="__rank", sums={"__sum": value, "__count": "__known"}, pieces=pieces
    )
    position = F.col("__rank") - 1
    chunk = F.floor(position / chunk_rows).cast("bigint")
    own = F.struct(chunk.alias("chunk"), F.lit(False).alias("context"))
    ahead = F.struct((chunk + 1).alias("chunk"), F.lit(True).alias("context"))
    near_end = position % chunk_rows >= chunk_rows - n
    placed = summed.withColumn(
        "__place", F.explode(F.when(near_end, F.array(own, ahead)).otherwise(F.array(own)))
    )
    in_chunk = W.partitionBy(*keys, "__place.chunk").orderBy("__rank")

    def over_frame(total: str) -> Column:
        before = F.coalesce(F.lag(total, n).over(in_chunk), F.lit(0))
        return less_money(F.coalesce(F.col(total), F.lit(0)), before).cast("double")

    return (
        placed.withColumn(out, F.try_divide(over_frame("__sum"), over_frame("__count")))
        .where(~F.col("__place.context"))
        .select(*df.columns, out)
    )
