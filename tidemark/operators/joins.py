"""Joins of a large, uneven table with one that has a row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_uneven(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join on `key` so that Spark can split a key that holds very many rows of `left`.

    At run time Spark splits a hot partition only if both inputs of the join come straight from a
    shuffle made for it. A `right` that was deduplicated or aggregated on the key is already in place
    and gets none. Joining also on a hash of the key shuffles it once more, the smaller side, and
    leaves the result as it is.
    """
    spread = F.xxhash64(key)
    joined = left.withColumn("__spread", spread).join(right.withColumn("__spread", spread), [key, "__spread"], how)
    return joined.drop("__spread")
