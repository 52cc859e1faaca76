"""Tables under contract: a version that breaks it is written, counted and never shown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import NotNull, Rule, Unique, run_table_checks, schema_issues
from tidemark.sinks.writers import publish_version, write_version


class ContractBroken(ValueError):
    """`issues` holds (column, what is wrong) pairs."""

    def __init__(self, table: str, issues: Sequence[tuple[str, str]]):
        super().__init__(f"{table}: " + "; ".join(f"{c}: {text}" for c, text in issues))
        self.issues = list(issues)


def store_checked(
    df: DataFrame,
    path: str,
    table: str,
    declared: T.StructType,
    not_null: Sequence[str] = (),
    rules: Sequence[Rule] = (),
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Replace a table as `write_table` does, if the rows keep the contract; otherwise refuse, and leave the last version.

    Columns and types are compared before anything runs. The rules are counted while the rows are written, so they
    cost no pass of their own; only uniqueness is counted afterwards, over the stored columns it needs.
    """
    if issues := schema_issues(df.schema, declared):
        raise ContractBroken(table, issues)
    checks = [*[NotNull(c) for c in not_null], *rules]
    counted = [r for r in checks if not isinstance(r, Unique)]
    spark, seen = df.sparkSession, Observation()
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[r.failures().alias(f"f{i}") for i, r in enumerate(counted)])
    version = write_version(watched, path, partition_by, sort_by)
    failures = seen.get
    issues = [(r.column, f"{r.name}: {failures[f'f{i}']}") for i, r in enumerate(counted) if failures[f"f{i}"]]
    stored = spark.read.schema(df.schema).parquet(f"{path}/{version}").select(*df.columns)
    if unique := [r for r in checks if isinstance(r, Unique)]:
        broken = run_table_checks(stored, unique, table).where("status = 'fail'")
        issues += [(r.column_name, f"{r.check_name}: {r.failures}") for r in broken.collect()]
    if issues:
        raise ContractBroken(table, issues)
    publish_version(spark, path, version)
    return stored
