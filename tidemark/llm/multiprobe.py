"""Approximate nearest neighbours by largest inner product: p-stable hashing with several probes per table."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store

NEAREST = 20
SAMPLE = 2000
SAMPLE_QUERIES = 300
SLACK = 1.5
SUCCESS = 0.96
SHARD_ROWS = 8192
QUERY_ROWS = 20_000
CHUNK = 256
BROADCAST_BYTES = 10 * 2**20
SEED = 20


@dataclass(frozen=True)
class Hashes:
    """`tables` x `dims` random lines: cell = floor((line . v + shift) / width).

    Vectors are lengthened so that the largest inner product is the smallest distance: a row v becomes
    (v, sqrt(top^2 - |v|^2)), a query q becomes (q * top / |q|, 0), with `top` the largest norm of all rows.
    """

    lines: np.ndarray
    shifts: np.ndarray
    width: float
    reach: float  # distance of a neighbour to be found
    top: float

    def places(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Positions along the lines in cells: (rows, tables, dims)."""
        norm = np.sqrt((vectors**2).sum(axis=1, keepdims=True))
        if query:
            long = np.hstack([vectors * (self.top / norm), np.zeros_like(norm)])
        else:
            long = np.hstack([vectors, np.sqrt(np.maximum(self.top**2 - norm**2, 0))])
        return np.einsum("nd,tmd->ntm", long, self.lines) / self.width + self.shifts

    @staticmethod
    def codes(cells: np.ndarray) -> np.ndarray:
        """One 64-bit number per cell vector (last axis)."""
        code = np.zeros(cells.shape[:-1], dtype=np.uint64)
        for c in np.moveaxis(cells.astype(np.int64).astype(np.uint64), -1, 0):
            code = (code ^ (c + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
            code ^= code >> np.uint64(29)
        return code.view(np.int64)

    def probes(self, place: np.ndarray, success: float) -> np.ndarray:
        """Codes of the cells of one table in falling order of success, until their success adds up.

        Along a line of a stable distribution, a neighbour at distance `reach` lies at the query's place
        plus a normal deviate of that size; a cell's success is the product over the lines.
        """
        sigma = self.reach / self.width
        chance, cells = np.ones(1), np.zeros((1, 0), dtype=np.int64)
        for p in place:
            near = np.arange(math.floor(p - 4 * sigma), math.floor(p + 4 * sigma) + 1)
            edge = np.append(near, near[-1] + 1)
            below = np.array([0.5 * (1 + math.erf((e - p) / (sigma * math.sqrt(2)))) for e in edge])
            mass = np.diff(below)
            near, mass = near[mass > 0.004], mass[mass > 0.004]
            cells = np.hstack([np.repeat(cells, len(near), axis=0), np.tile(near, len(cells))[:, None]])
            chance = np.multiply.outer(chance, mass).ravel()
        order = np.argsort(-chance, kind="stable")
        enough = int(np.searchsorted(np.cumsum(chance[order]), success)) + 1
        return self.codes(cells[order[:enough]])


def _usable(v: str, size: int) -> Column:
    """Vectors of the usual size with finite components that are not all zero."""
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == size) & good & F.exists(v, lambda x: x != 0), F.lit(False))


def prepared(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, one per id (of rows that repeat an id the smallest vector).

    NULL ids, NULL or zero vectors, NULL or non-finite components and sizes other than the commonest take no part.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector")).filter("vec_id is not null")
    common = rows.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    size = common["n"] if common else 0
    return rows.filter(_usable("vector", size)).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def sampled(rows: DataFrame, count: int) -> list[Row]:
    """The at most `SAMPLE` of `count` rows whose ids have the smallest digests.

    Every task sends the driver as many rows as the sample has, so that of many rows only those below a bound on
    the digest, `SLACK` times as many as needed, are sorted. Should they be too few, all rows are.
    """
    digest = F.md5(F.col("vec_id").cast("string"))
    if count > SLACK * SAMPLE:
        bound = f"{int(16**8 * SLACK * SAMPLE / count):08x}"
        picked = rows.filter(digest < bound).orderBy(digest, "vec_id").limit(SAMPLE).collect()
        if len(picked) == SAMPLE:
            return picked
    return rows.orderBy(digest, "vec_id").limit(SAMPLE).collect()


def fit(rows: DataFrame, nearest: int, tables: int, dims: int, width: float) -> Hashes | None:
    """Lines and cell width from at most `SAMPLE` of the distinct vectors, those whose ids have the smallest digests.

    `reach` is the distance within which the sample suggests `nearest` neighbours: if the sample is too thin
    for that, the distance of its nearest, which is further. The norm bound and the row count cover all rows.
    """
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    count, top = rows.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not count:
        return None
    sample = np.array([r["vector"] for r in sampled(rows, count)], dtype=float)
    d = sample.shape[1]
    rng = np.random.default_rng(SEED)
    lines = rng.standard_normal((tables, dims, d + 1))
    place = max(1, round(nearest * len(sample) / count))
    some = sample[:SAMPLE_QUERIES]
    product = (some * (top / np.linalg.norm(some, axis=1))[:, None]) @ sample.T
    product[np.arange(len(some)), np.arange(len(some))] = -np.inf
    kth = -np.sort(-product, axis=1)[:, min(place, len(sample)) - 1]
    far = np.sqrt(np.maximum(2 * top**2 - 2 * kth[np.isfinite(kth)], 0))
    reach = max(float(np.quantile(far, 0.6)) if len(far) else 0.0, 1e-3 * top)
    return Hashes(lines, rng.random((tables, dims)), width * reach, reach, float(top))


def search(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST,
    tables: int = 2, dims: int = 6, width: float = 1.5, success: float = SUCCESS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the `nearest` rows found, itself excepted.

    Every row is indexed in each table. Of equal vectors the `nearest` + 1 smallest ids stand for all, as no
    query can return more of them; equal queries are searched once. Cells are dealt over shards of about
    `SHARD_ROWS` rows, larger cells over several, and a query visits a shard once per table with all of its
    cells there, so no cell is capped and no group grows with the input. A query whose cells hold too few rows
    visits all of them, so that fewer than `nearest` come back only if there are no more. Scores are inner products of the
    original vectors in double precision, summed in one fixed order; ties go to the smaller id.
    An empty table gives no rows; a query row that takes no part (see `prepared`) gives none.
    """
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = store(prepared(vectors, key, vector), "vectors")
    hashes = fit(rows.groupBy("vector").agg(F.min("vec_id").alias("vec_id")), nearest, tables, dims, width)
    if hashes is None:
        return empty
    each = 1 - (1 - success) ** (1 / tables)
    same = Window.partitionBy("vector").orderBy("vec_id")
    base = rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= nearest + 1).drop("_n")
    asked = prepared(queries, key, vector)
    distinct = store(asked.groupBy("vector").agg(F.min("vec_id").alias("query")), "queries")
    n_rows, n_queries = rows.count(), distinct.count()
    shards, query_blocks = n_rows // SHARD_ROWS + 1, n_queries // QUERY_ROWS + 1

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.array(b["vector"].tolist(), dtype=float).reshape(len(b), -1)
            if len(b):
                codes = hashes.codes(np.floor(hashes.places(v, query=False)))
                for t in range(tables):
                    yield pd.DataFrame({"tab": t, "cell": codes[:, t], "vec_id": b["vec_id"], "vector": b["vector"]})

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = np.array(b["vector"].tolist(), dtype=float).reshape(len(b), -1)
            places = hashes.places(v, query=True) if len(b) else []
            for q, place in zip(b["query"], places):
                for t in range(tables):
                    yield pd.DataFrame({"query": q, "tab": t, "cell": hashes.probes(place[t], each)})

    kind = rows.schema["vector"].dataType.simpleString()
    indexed = store(base.mapInPandas(index, f"tab int, cell long, vec_id long, vector {kind}"), "index")
    cells = indexed.groupBy("tab", "cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.select("tab", "cell", (F.floor((F.col("n") - 1) / SHARD_ROWS) + 1).cast("int").alias("parts"))
    shard = F.pmod(F.xxhash64("tab", "cell", "part"), F.lit(shards)).cast("int").alias("shard")
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(query_blocks)).cast("int").alias("block")
    held = indexed.join(cells, ["tab", "cell"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    held = held.select("tab", shard, F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("block"), "cell", "vec_id", "vector")
    spread = distinct.repartition(n_queries // 100 + 1, "query")  # rows are few, but each is much work
    # Spark takes the probes, hundreds of a query, to be about as large as the queries, and would broadcast them. It knows
    # the queries by their file, which may be far smaller than they are.
    held_queries = distinct.hint("merge") if n_queries * hashes.lines.shape[2] * 8 > BROADCAST_BYTES else distinct
    probed = spread.mapInPandas(probe, "query long, tab int, cell long").hint("merge").join(cells, ["tab", "cell"])

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids = left["vec_id"].to_numpy()
            v = np.array(left["vector"].tolist(), dtype=float)
            names, local = np.unique(left["cell"].to_numpy(), return_inverse=True)
            for at in range(0, len(right), CHUNK):
                part = right.iloc[at : at + CHUNK]
                q = np.array(part["asked"].tolist(), dtype=float)
                visited = np.zeros((len(part), len(names)), dtype=bool)
                for i, c in enumerate(part["cells"]):
                    visited[i, np.searchsorted(names, np.intersect1d(c, names))] = True
                rough = np.where(visited[:, local], q @ v.T, -np.inf)
                most = min(nearest + 1, rough.shape[1])
                # The product may round differently from the final sum: what is as near as that stays in.
                floor = -np.partition(-rough, most - 1, axis=1)[:, most - 1] - 1e-9 * hashes.top**2
                a, b = np.nonzero((rough >= floor[:, None]) & np.isfinite(rough))
                exact = (q[a] * v[b]).sum(axis=1)
                out.append(pd.DataFrame({"query": part["query"].to_numpy()[a], "vec_id": ids[b], "score": exact}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "vec_id": [], "score": []})

    groups = ["tab", "shard", "block"]
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def visited(visits: DataFrame) -> DataFrame:
        """The best rows of all cells that (query, tab, cell, parts) names."""
        visits = visits.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        visits = visits.select("query", "tab", shard, "cell").groupBy("query", "tab", "shard").agg(F.collect_set("cell").alias("cells"))
        visits = visits.join(held_queries, "query").select("tab", "shard", block("query"), "query", "cells", F.col("vector").alias("asked"))
        found = held.groupBy(*groups).cogroup(visits.groupBy(*groups)).applyInPandas(best, "query long, vec_id long, score double")
        merged = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        return merged.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= nearest + 1).drop("_r")

    kept = store(visited(probed), "found")
    enough = kept.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > nearest).select("query")
    short = store(distinct.select("query").join(enough, "query", "left_anti"), "short")
    if not short.isEmpty():  # too little in the cells tried: the query visits all cells of one table
        rest = visited(short.withColumn("tab", F.lit(0)).join(cells, "tab"))
        kept = kept.join(short, "query", "left_anti").unionByName(rest)
    own = asked.withColumnRenamed("vec_id", "query_id").join(held_queries, "vector").select("query_id", "query")
    mine = own.join(kept, "query").filter(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = mine.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
