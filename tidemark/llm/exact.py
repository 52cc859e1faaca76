"""Exact duplicates by two passes over a Bloom filter, with DataFrame functions only.

The first pass sets bits for the fingerprint of every text and keeps those that two rows or more have set. The
second looks every row up: a row with a bit nobody else has set is unlike all others and passes straight through;
only the others, the copies and a few false alarms, are shuffled and grouped by fingerprint. The filter can err
on one side only, so the result is exact at any size of the filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, store

#: Bits of the filter per row, and bits set per row: about 1 % false alarms among rows without a copy.
BITS_PER_ROW = 16
PROBES = 4
#: The filter is a table of blocks of 4 KiB; all bits of a row lie in one block.
BLOCK_BITS = 32768
#: Up to this size (33 million rows) the filter is sent to every executor; beyond it, fingerprints meet it in a join.
BROADCAST_BYTES = 64 << 20
#: Groups with at least 1 / HOT_PARTS of the shuffled rows are joined apart; there are at most HOT_PARTS of them.
HOT_PARTS = 1000


def fingerprint(text: Column) -> Column:
    """SHA-256 (binary) of a text with each run of white space as one space; NULL counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "), 256))


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks).cast("long"))


def _places(digest: Column) -> list[Column]:
    """The bits of a fingerprint inside its block."""
    other = F.xxhash64(digest, F.lit(1))
    return [F.shiftrightunsigned(other, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]


def blocks_for(rows: int) -> int:
    return max(1, -(-rows * BITS_PER_ROW // BLOCK_BITS))


def repeated_bits(prints: DataFrame, blocks: int) -> DataFrame:
    """The filter: (block, bits) with the bits that at least two rows of `prints` (digest) set.

    Equal bits are counted inside each map task before the shuffle, so a fingerprint of very many rows costs no
    task more than the others.
    """
    digest = F.col("digest")
    own = F.explode(F.array_distinct(F.array(*_places(digest))))
    cells = prints.select(_block(digest, blocks).alias("block"), own.alias("bit"))
    cells = cells.select((F.col("block") * BLOCK_BITS + F.col("bit")).alias("cell"))
    twice = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return twice.groupBy(F.shiftright("cell", BLOCK_BITS.bit_length() - 1).alias("block")).agg(
        F.bitmap_construct_agg(F.col("cell").bitwiseAND(F.lit(BLOCK_BITS - 1))).alias("bits")
    )


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def looked_up(rows: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """`rows` (with `digest`) and `maybe`: false if no other row can have the same fingerprint."""
    bits = bits.withColumnsRenamed({"block": "filter_block", "bits": "filter_bits"})
    if blocks * BLOCK_BITS // 8 <= BROADCAST_BYTES:
        bits = F.broadcast(bits)
    digest = F.col("digest")
    found = rows.join(bits, _block(digest, blocks) == F.col("filter_block"), "left")
    hit = reduce(lambda a, b: a & b, [_is_set(F.col("filter_bits"), p) for p in _places(digest)])
    return found.withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("filter_block", "filter_bits")


def find_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, keep, group_size, kept, digest): one row per row of `docs`, dropped ones too.

    Of equal texts the row with the smallest key stays, `keep` is its key. A NULL key comes after all others; of
    rows that share text and key exactly one stays. A NULL text equals the empty one; an empty table gives no
    rows. Other columns are not read, whatever their names. Only fingerprints travel, never texts, and the join
    that brings a group's size back to its rows takes very large groups apart from the others.
    """
    narrow = docs.select(F.col(f"`{key}`").alias("key"), fingerprint(F.col(f"`{text}`")).alias("digest"))
    # Stored once: the row number must be the same in all that follows.
    prints = store(narrow.withColumn("row", F.monotonically_increasing_id()), "prints")
    blocks = blocks_for(prints.count())
    bits = store(repeated_bits(prints, blocks), "filter")
    marked = looked_up(prints, bits, blocks)
    alone = marked.filter(~F.col("maybe")).select(
        "key", F.col("key").alias("keep"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    maybe = store(marked.filter("maybe").drop("maybe"), "maybe")
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "row")).alias("first")
    groups = store(maybe.groupBy("digest").agg(first, F.count(F.lit(1)).alias("group_size")), "groups")
    hot = F.broadcast(groups.filter(F.col("group_size") * HOT_PARTS >= maybe.count()))
    met = maybe.join(hot, "digest").unionByName(maybe.join(hot, "digest", "left_anti").join(groups, "digest"))
    copies = met.select(
        "key", F.col("first.key").alias("keep"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "digest"
    )
    return alone.unionByName(copies)


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns, by the rules of `find_copies`.

    Whole rows are shuffled only where the filter has found a possible copy, and copies are dropped inside each
    map task first. Of rows that share text and key one stays, no matter which.
    """
    digest = fingerprint(F.col(f"`{text}`"))
    prints = store(docs.select(digest.alias("digest")), "prints")
    blocks = blocks_for(prints.count())
    bits = store(repeated_bits(prints, blocks), "filter")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked = looked_up(docs.select(row, F.col(f"`{key}`").alias("key"), digest.alias("digest")), bits, blocks)
    first = F.min_by("row", F.struct(F.col("key").isNull(), F.col("key"))).alias("row")
    kept = marked.filter("maybe").groupBy("digest").agg(first).select("row")
    rows = marked.filter(~F.col("maybe")).select("row").unionByName(kept)
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
