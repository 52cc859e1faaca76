"""Slowly changing attributes: version history and point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.cleaning import dedup_latest
from tidemark.operators.ordered import PIECE, in_pieces, running_in_pieces

VALIDITY = ("valid_from", "valid_to", "is_current")


def scd2_history(
    changes: DataFrame, key: str, updated_at: str, tracked: Sequence[str] | None = None, pieces: int | None = None
) -> DataFrame:
    """All versions of each key from a table of changes.

    One version per key and time; it is valid until the next one. With `tracked`, a row that leaves
    these columns as they were starts no version. The next version is looked up within even ranges of
    (key, time), see `ordered`; the last one of a range gets the first time of the key's following range.
    """
    rows = in_pieces(dedup_latest(changes, [key, updated_at], updated_at), key, updated_at, pieces=pieces)
    if tracked is not None:
        now = rows.withColumn("__now", F.struct(*tracked))
        seen = running_in_pieces(now, [key], [updated_at], rank="__rank", lags={"__was": "__now"})
        changed = (F.col("__rank") == 1) | ~F.col("__was").eqNullSafe(F.col("__now"))
        rows = seen.where(changed).select(*changes.columns, PIECE)
    rows = rows.withColumn("__key", F.struct(key, PIECE))
    firsts = rows.groupBy("__key").agg(F.min(updated_at).alias("__first"))
    following = F.lead("__first").over(W.partitionBy(f"__key.{key}").orderBy(f"__key.{PIECE}"))
    inside = F.lead(updated_at).over(W.partitionBy("__key").orderBy(updated_at))
    attributes = [c for c in changes.columns if c not in (key, updated_at)]
    joined = rows.withColumn("__next", inside).join(
        firsts.select("__key", following.alias("__following")), "__key", "left"
    )
    valid_to = F.coalesce("__next", "__following")
    return joined.select(
        key,
        *attributes,
        F.col(updated_at).alias("valid_from"),
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


def scd2_apply(
    current: DataFrame,
    batch: DataFrame,
    key: str,
    updated_at: str,
    tracked: Sequence[str] | None = None,
    as_of: str | None = None,
) -> DataFrame:
    """The history after one more batch of current rows (one per key).

    Without `tracked` a row counts as changed when its `updated_at` is later than the open version's.
    With it, when any of these columns differs, whatever the timestamp says; such a version starts at
    `as_of`, which is then needed: a change under an unmoved timestamp would start where it ends. Closed versions pass through; keys missing from
    the batch stay open.
    """
    if tracked is not None and as_of is None:
        raise ValueError("changes of tracked columns need as_of, the time from which they hold")
    attributes = [c for c in batch.columns if c != key]
    closed, opened = current.where(~F.col("is_current")), current.where(F.col("is_current"))
    old, new = opened.alias("old"), batch.alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    if tracked is None:
        differs = F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}")
    else:
        differs = ~F.struct(*[F.col(f"new.{c}") for c in tracked]).eqNullSafe(
            F.struct(*[F.col(f"old.{c}") for c in tracked])
        )
    start = F.col(f"new.{updated_at}")
    if tracked is not None:
        # The first version of a key starts with its own timestamp; later ones when they were seen.
        start = F.when(F.col(f"old.{key}").isNull(), start).otherwise(F.lit(as_of).cast("timestamp_ntz"))
    both = F.col(f"old.{key}").isNotNull() & F.col(f"new.{key}").isNotNull()
    changed = both & F.coalesce(differs, F.lit(False))

    def version(side: str, valid_from, valid_to, is_current):
        values = [F.col(f"{side}.{c}").alias(c) for c in (key, *attributes)]
        return F.struct(
            *values,
            valid_from.cast("timestamp_ntz").alias("valid_from"),
            valid_to.cast("timestamp_ntz").alias("valid_to"),
            is_current.alias("is_current"),
        )

    kept = F.when(
        F.col(f"old.{key}").isNotNull(),
        version("old", F.col("old.valid_from"), F.when(changed, start), ~changed),
    )
    added = F.when(
        F.col(f"old.{key}").isNull() | changed, version("new", start, F.lit(None), F.lit(True))
    )
    versions = joined.select(F.inline(F.array_compact(F.array(kept, added))))
    return closed.select(*versions.columns).unionByName(versions)


def open_history(batch: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The history after a first batch: one open version per key."""
    return batch.select(
        key,
        *[c for c in batch.columns if c != key],
        F.col(updated_at).cast("timestamp_ntz").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def asof_user_attributes(
    facts: DataFrame, history: DataFrame, key: str, ts_col: str, pieces: int | None = None
) -> DataFrame:
    """Facts with the attribute version valid at their time; facts without one, or without a key, keep NULLs.

    Facts and versions are lined up by time in even ranges of (key, time), see `ordered`, and each fact takes
    the last version before it, so the work grows with facts plus versions, never with their product. The
    version a range starts with is carried in from the key's earlier ranges, on one row per key and range.
    Facts of one key and instant are told apart by a hash of the row.
    """
    attributes = [c for c in history.columns if c not in (key, *VALIDITY)]
    version = F.struct(*attributes, "valid_from", "valid_to")
    keyed, keyless = facts.where(F.col(key).isNotNull()), facts.where(F.col(key).isNull())
    versions = history.where(F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col("valid_from").alias("t"), F.lit(0).alias("after"), F.lit(0).cast("bigint").alias("tie"),
        version.alias("version"),
    )
    moved = keyed.select(
        F.col(key).alias("k"), F.col(ts_col).alias("t"), F.lit(1).alias("after"), F.xxhash64(*facts.columns).alias("tie"),
        F.struct(*facts.columns).alias("fact"),
    )
    lined_up = in_pieces(
        moved.unionByName(versions, allowMissingColumns=True), "k", "t", "after", "tie", pieces=pieces
    ).withColumn("place", F.struct("k", PIECE))

    last = lined_up.groupBy("place").agg(F.max_by("version", "version.valid_from").alias("carried"))
    earlier = W.partitionBy("place.k").orderBy(f"place.{PIECE}").rowsBetween(W.unboundedPreceding, -1)
    inherited = last.select("place", F.last("carried", ignorenulls=True).over(earlier).alias("carried"))
    upto = W.partitionBy("place").orderBy("t", "after").rowsBetween(W.unboundedPreceding, 0)
    found = (
        lined_up.withColumn("version", F.last("version", ignorenulls=True).over(upto))
        .where(F.col("fact").isNotNull())
        .join(inherited, "place", "left")
        .select("fact", F.coalesce("version", "carried").alias("version"))
    )
    valid = F.col("version.valid_to").isNull() | (F.col(f"fact.{ts_col}") < F.col("version.valid_to"))
    matched = found.select("fact.*", *[F.when(valid, F.col(f"version.{c}")).alias(c) for c in attributes])
    return matched.unionByName(keyless, allowMissingColumns=True)
