"""Tables of folders that change by single folders and never show half a change.

The rows of a folder (a day, a key bucket) lie in one or more batches, each written to a path of its own. A
manifest names the batches of every folder; replacing the manifest is what publishes a change. It has one row per
folder and batch, so it stays small whatever the number of rows, and a reader opens the folders it names and no
others. A failed write leaves files that nothing names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sinks.writers import write_partitioned
from tidemark.sources.readers import read_parquet_prefix

MANIFEST = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("batch", T.StringType()),
        T.StructField("note", T.StringType()),
    ]
)
#: The folder name Spark gives to rows without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Manifest:
    """Version 0 is the table before its first change; `note` is free for the writer, such as how far it has read."""

    version: int = 0
    note: str | None = None
    batches: Mapping[str | None, tuple[str, ...]] = field(default_factory=dict)


class FolderTable:
    """A table below `root` with one folder per value of the column `folder`. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, folder: str, schema: T.StructType):
        self.spark, self.root, self.folder, self.schema = spark, root.rstrip("/"), folder, schema
        kind = schema[folder].dataType
        rest = [f for f in schema.fields if f.name != folder]
        self._stored = T.StructType([*rest, T.StructField("batch", T.StringType()), T.StructField(folder, kind)])

    def manifest(self) -> Manifest:
        """The last published manifest. Two paths take turns, so one that is being replaced is never the last one."""
        # The versions of both turns; small, so no shuffle is worth its start.
        rows = read_parquet_prefix(self.spark, f"{self.root}/manifest", "", MANIFEST).collect()
        version = max((r.version for r in rows), default=0)
        batches: dict[str | None, tuple[str, ...]] = {}
        for r in rows:
            if r.version == version and r.batch is not None:
                batches[r.folder] = (*batches.get(r.folder, ()), r.batch)
        return Manifest(version, next((r.note for r in rows if r.version == version), None), batches)

    def publish(self, before: Manifest, batches: Mapping[str | None, Sequence[str]], note: str | None = None) -> Manifest:
        """Make `batches` the content of the table; refused if somebody else has published since `before`."""
        now = self.manifest().version
        if now != before.version:
            raise RuntimeError(f"{self.root}: version {now} was published after version {before.version} was read")
        version = before.version + 1
        rows = [(version, f, b, note) for f, names in batches.items() for b in names] or [(version, None, None, note)]
        new = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        new.write.mode("overwrite").parquet(f"{self.root}/manifest/turn={version % 2}")
        return Manifest(version, note, {f: tuple(b) for f, b in batches.items()})

    def store(
        self, rows: DataFrame, sort_by: Sequence[str] = (), derived: Mapping[str, Column] | None = None
    ) -> tuple[str, list[str | None]]:
        """Write rows as a new batch, unseen until published; returns its name and the folders it has rows for.

        Columns `derived` from others are computed as rows are written, whatever `rows` has there.
        """
        batch = uuid.uuid4().hex
        path = f"{self.root}/data/batch={batch}"
        moved = rows.select(*[n for n in self.schema.names if n not in (derived or {})])
        write_partitioned(moved, path, [self.folder], sort_by, mode="errorifexists", derived=derived)
        files = read_parquet_prefix(self.spark, path, "", self.schema).inputFiles()
        names = {unquote(n) for f in files for n in f.split("/") if n.startswith(f"{self.folder}=")}
        folders = sorted(n.partition("=")[2] for n in names)
        return batch, [None if f == _NO_VALUE else f for f in folders]

    def read(self, manifest: Manifest | None = None, folders: Iterable[str | None] | None = None) -> DataFrame:
        """All rows, or those of some folders. A filter on the folder column opens no other folders either."""
        manifest = self.manifest() if manifest is None else manifest
        wanted = manifest.batches if folders is None else [f for f in folders if f in manifest.batches]
        paths = [
            f"{self.root}/data/batch={batch}/{self.folder}={_NO_VALUE if f is None else f}"
            for f in wanted
            for batch in manifest.batches[f]
        ]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self._stored).option("basePath", f"{self.root}/data")
        return reader.parquet(*paths).select(*self.schema.names)

    def change(
        self, before: Manifest, rows: DataFrame, replaced: Iterable[str | None], note: str | None = None, sort_by: Sequence[str] = ()
    ) -> Manifest:
        """Publish `rows`: in the folders `replaced` they are all there is from now on, in others they come on top."""
        batch, written = self.store(rows, sort_by)
        gone = set(replaced)
        batches = {f: b for f, b in before.batches.items() if f not in gone}
        return self.publish(before, {**batches, **{f: (*batches.get(f, ()), batch) for f in written}}, note)

    def replace(
        self,
        before: Manifest,
        rows: DataFrame,
        folders: Iterable[str | None],
        note: str | None = None,
        sort_by: Sequence[str] = (),
        derived: Mapping[str, Column] | None = None,
    ) -> Manifest:
        """Publish `rows` as the whole content of `folders` (rows must lie in them); other folders stay as they are."""
        batch, written = self.store(rows, sort_by, derived)
        gone = set(folders)
        if strange := set(written) - gone:
            raise ValueError(f"rows outside the folders to replace: {sorted(map(str, strange))[:5]}")
        batches = {f: b for f, b in before.batches.items() if f not in gone}
        return self.publish(before, {**batches, **{f: (batch,) for f in written}}, note)

    def append(self, before: Manifest, rows: DataFrame, note: str | None = None, sort_by: Sequence[str] = ()) -> Manifest:
        """Publish `rows` next to what their folders hold."""
        return self.change(before, rows, (), note, sort_by)

    def compact(self, before: Manifest, most: int, merge: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Manifest:
        """Rewrite the folders that consist of more than `most` batches as one batch each, after `merge`."""
        many = [f for f, batches in before.batches.items() if len(batches) > most]
        if not many:
            return before
        return self.replace(before, merge(self.read(before, many)), many, before.note)

