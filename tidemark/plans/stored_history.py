"""Attribute history as a stored table that a batch changes only where its keys are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.history import open_history, scd2_apply
from tidemark.sinks.folders import FolderTable


class StoredHistory:
    """Versions of keys, open ones apart from closed ones, each in folders by the hash of the key.

    A batch reads and rewrites the open versions of the folders its keys fall into, and adds the versions it closes
    to what is there; closed versions are never read for it. Both become visible at once. The number of folders is
    fixed with the first batch.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, key: str, updated_at: str, buckets: int = 256
    ):
        """`schema` is that of a batch: the key, its attributes and the time of the row."""
        self.key, self.updated_at, self.buckets = key, updated_at, buckets
        history = open_history(spark.createDataFrame([], schema), key, updated_at).schema
        self.columns = history.names
        self.table = FolderTable(spark, root, "folder", T.StructType([*history.fields, T.StructField("folder", T.StringType())]))

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("string")

    def apply(self, batch: DataFrame, tracked: Sequence[str] | None = None, as_of: str | None = None) -> int:
        """Take in one more batch of current rows (one per key), by the rules of `scd2_apply`; returns the folders rewritten."""
        before = self.table.manifest()
        touched = [r.b for r in batch.select(self._bucket().alias("b")).distinct().collect()]
        open_folders = [f"open-{b}" for b in touched]
        current = self.table.read(before, open_folders).select(*self.columns)
        versions = scd2_apply(current, batch, self.key, self.updated_at, tracked, as_of)
        state = F.when(F.col("is_current"), F.lit("open-")).otherwise(F.lit("closed-"))
        self.table.change(before, versions.withColumn("folder", F.concat(state, self._bucket())), open_folders)
        return len(touched)

    def read(self) -> DataFrame:
        """All versions."""
        return self.table.read().select(*self.columns)

    def current(self) -> DataFrame:
        """The open versions; no closed one is read."""
        manifest = self.table.manifest()
        return self.table.read(manifest, [f for f in manifest.batches if f.startswith("open-")]).select(*self.columns)
