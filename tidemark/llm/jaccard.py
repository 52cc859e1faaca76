"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store, text_of, unused
from tidemark.llm.components import components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.995
MAX_ROWS = 8
BLOCK_BYTES = 8 * 2**20
BLOCK_ROWS = 2500
CACHE_WORDS = 500_000
SLICE = 4096
SIGNED = np.iinfo(np.int64)


@dataclass(frozen=True)
class Bands:
    count: int
    rows: int

    def recall(self, similarity: float) -> float:
        return 1 - (1 - similarity**self.rows) ** self.count


def bands_for(recall: float = RECALL, similarity: float = SIMILARITY, most_hashes: int = 128) -> Bands:
    """The most selective bands (most rows) that find a pair of this similarity with this probability."""
    found = Bands(most_hashes, 1)
    for rows in range(2, MAX_ROWS + 1):
        count = int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))
        if count * rows <= most_hashes:
            found = Bands(count, rows)
    return found


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, hashes: WordHashes, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `n` words; a text with fewer words has one run of all of them.

    Words are runs of characters other than ASCII white space, in lower case.
    """
    words = text.lower().encode("utf-8", "replace").split()
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    if len(h) == 0:
        return h
    k = min(n, len(h))
    factors = mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        total += h[i : len(h) - k + 1 + i] * factors[i]
    return np.unique(mixed(total + np.uint64(k)))


def band_keys(sets: np.ndarray, bands: Bands) -> np.ndarray:
    """One signed 64-bit key per band: a mix of the minima of the band's hash functions over the set."""
    n = bands.count * bands.rows
    factor = (mixed(np.arange(n, dtype=np.uint64) + np.uint64(11)) | np.uint64(1))[:, None]
    shift = mixed(np.arange(n, dtype=np.uint64) + np.uint64(7919))[:, None]
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(sets), 1024):
        least = np.minimum(least, (sets[None, at : at + 1024] * factor + shift).min(axis=1))
    key = np.arange(bands.count, dtype=np.uint64)
    for column in mixed(least).reshape(bands.count, bands.rows).T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def signatures(docs: DataFrame, bands: Bands, text: str = "text", key: str = "doc_id", n: int = WORDS) -> DataFrame:
    """(key, version, set_id, size, bands) per row: `set_id` names the n-gram set, NULL for a text without words.

    `version` is a hash of the text.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            ids, sizes, keys = [], [], []
            for t in b["text"]:
                s = shingles(t, hashes, n)
                ids.append(_digest(s) if len(s) else None)
                sizes.append(len(s))
                keys.append(band_keys(s, bands) if len(s) else None)
            yield pd.DataFrame({"key": b["key"].astype("Int64"), "version": b["version"], "set_id": ids, "size": sizes, "bands": keys})

    picked = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text_of(text)).alias("version"), text_of(text).alias("text"))
    return picked.mapInPandas(run, "key long, version long, set_id binary, size long, bands array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, text: str, key: str, n: int) -> DataFrame:
    """(set_id, grams) of the wanted sets, cut again from the text of one document each: (key, version, set_id).

    The hash of the text is part of the join, so rows that share a key do not each meet all sets of that key.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for b in batches:
            rows = []
            for t, set_id in zip(b["text"], b["set_id"]):
                s = shingles(t, hashes, n)
                if _digest(s) == bytes(set_id):  # two texts of a key might share their hash
                    rows.append((set_id, s.tobytes()))
            yield pd.DataFrame(rows, columns=["set_id", "grams"])

    picked = docs.select(F.col(key).cast("long").alias("_k"), F.xxhash64(text_of(text)).alias("_v"), text_of(text).alias("text"))
    same = picked["_k"].eqNullSafe(wanted["key"]) & (picked["_v"] == wanted["version"])
    joined = picked.join(wanted, same).select("text", "set_id")
    return joined.mapInPandas(run, "set_id binary, grams binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections, by products of slices of the two incidence tables."""
    sizes = [np.array([len(s) for s in side]) for side in (left, right)]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    values = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]]))
    in_left, in_right = owner < len(left), owner >= len(left)
    both = (np.bincount(column[in_left], minlength=column[-1] + 1) > 0) & (np.bincount(column[in_right], minlength=column[-1] + 1) > 0)
    new = np.cumsum(both) - 1
    keep = both[column]
    column, owner = new[column[keep]], owner[keep]
    for at in range(0, int(both.sum()), SLICE):
        here = slice(*np.searchsorted(column, [at, at + SLICE]))
        a = np.zeros((len(left), SLICE), dtype=np.float32)
        b = np.zeros((len(right), SLICE), dtype=np.float32)
        c, o = column[here] - at, owner[here]
        a[o[o < len(left)], c[o < len(left)]] = 1
        b[o[o >= len(left)] - len(left), c[o >= len(left)]] = 1
        out += a @ b.T
    return out


class Forest:
    """Joins of a union-find: the edges that connect something new."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _verified(similarity: float):
    """All pairs of one bucket (or of two blocks of it) that no earlier band has: links and connecting edges.

    Pairs stay inside: what comes out is one row per set with its number of links, and at most one edge per
    set. Rows carry (set_id, copies, links in texts, links in documents) or (set_id, other) for an edge.
    """

    def run(g: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in g["grams"]]
        size = np.array([len(s) for s in sets])
        keys = np.array(g["bands"].tolist())
        copies = g["copies"].to_numpy()
        band, first, second = int(g["band"].iloc[0]), int(g["first"].iloc[0]), int(g["second"].iloc[0])
        block = g["block"].to_numpy()
        left = np.flatnonzero(block == first)
        right = np.flatnonzero(block == second)
        texts, documents = np.zeros(len(g), dtype=np.int64), np.zeros(len(g), dtype=np.int64)
        ids = g["set_id"].tolist()
        forest, edges = Forest(len(g)), []
        if len(left) and len(right):
            fresh = np.ones((len(left), len(right)), dtype=bool)
            for k in range(band):
                fresh &= keys[left, k][:, None] != keys[right, k][None, :]
            if first == second:
                fresh &= np.tri(len(left), k=-1, dtype=bool)
            if fresh.any():
                common = overlaps([sets[i] for i in left], [sets[i] for i in right])
                near = fresh & (common >= similarity * (size[left][:, None] + size[right][None, :] - common) - 1e-6)
                texts += np.bincount(left, weights=near.sum(1), minlength=len(g)).astype(np.int64)
                texts += np.bincount(right, weights=near.sum(0), minlength=len(g)).astype(np.int64)
                documents += np.bincount(left, weights=near @ copies[right], minlength=len(g)).astype(np.int64)
                documents += np.bincount(right, weights=near.T @ copies[left], minlength=len(g)).astype(np.int64)
                for i in range(len(left)):
                    for j in np.flatnonzero(near[i]).tolist():
                        if forest.join(int(left[i]), int(right[j])):
                            edges.append((ids[left[i]], ids[right[j]]))
        linked = np.flatnonzero(texts)
        out = [(ids[i], None, int(texts[i]), int(documents[i])) for i in linked] + [(a, b, 0, 0) for a, b in edges]
        return pd.DataFrame(out, columns=["set_id", "other", "texts", "documents"])

    return run


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL
) -> DataFrame:
    """One row per row of `docs`: (key, version, root, class_id, n_texts, n_links).

    `root` names the class and is NULL for a text without words, `version` is a hash of the text.
    `class_id` is the smallest key among the documents that links connect; `n_texts` counts the other n-gram
    sets with a Jaccard similarity of at least `similarity`, `n_links` the other documents, copies included.
    Equal sets are one class from the start, so copies never meet as pairs. Every pair of different sets that
    shares a band is compared on its whole sets, once, in the first band that it shares; a bucket is dealt out
    in blocks of bounded size, so its pairs spread over tasks. Bands are chosen for `recall` at `similarity`.

    A NULL, empty or blank text has no n-grams: no links and a class of its own, with the document's key (a
    NULL key sorts last and gives a NULL class only if no member has one). Rows with equal key count as
    documents each.
    """
    bands = bands_for(recall, similarity)
    signed = store(signatures(docs, bands, text, key, n), "signatures")
    least = F.min(F.struct(F.col("key").isNull().alias("late"), "key", "version")).alias("least")
    sets = signed.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        least, F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    sets = store(sets.select("set_id", "least.key", "least.version", "copies", "size", "bands"), "sets")
    banded = sets.select("set_id", "size", F.posexplode("bands").alias("band", "bucket"))
    buckets = banded.groupBy("band", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("grams"),
        F.bit_xor(F.xxhash64("set_id")).alias("_a"), F.bit_xor(F.xxhash64(F.lit(1), "set_id")).alias("_b"),
    ).filter("n > 1")
    # Buckets with the same members have the same pairs: the one of the earliest band decides all of them.
    buckets = buckets.groupBy("_a", "_b", "n", "grams").agg(F.min(F.struct("band", "bucket")).alias("at"))
    blocks = F.greatest(F.ceil(F.col("grams") * 8 / BLOCK_BYTES), F.ceil(F.col("n") / BLOCK_ROWS)).cast("int")
    buckets = store(buckets.select("at.band", "at.bucket", blocks.alias("blocks")), "buckets")
    member = banded.drop("size").join(buckets, ["band", "bucket"])
    member = member.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    member = store(member, "members")
    wanted = member.select("set_id").distinct().join(sets.select("set_id", "key", "version"), "set_id")
    grams = _sets(docs, wanted, text, key, n).dropDuplicates(["set_id"])
    grams = grams.join(sets.select("set_id", "copies", "bands"), "set_id")
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = member.withColumn("_other", met).withColumns({"first": F.greatest("block", "_other"), "second": F.least("block", "_other")})
    paired = paired.select("set_id", "band", "bucket", "block", "first", "second").join(grams, "set_id")
    found = paired.groupBy("band", "bucket", "first", "second").applyInPandas(
        _verified(similarity), "set_id binary, other binary, texts long, documents long"
    )
    found = store(found, "links")
    links = found.filter(F.col("other").isNull()).groupBy("set_id").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    edges = found.filter(F.col("other").isNotNull()).select(F.col("set_id").alias("a"), F.col("other").alias("b"))
    roots = components(edges)
    classed = sets.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = classed.groupBy("root").agg(F.min("key").alias("class_id"))
    described = classed.join(least, "root").join(links, "set_id", "left").select(
        "set_id", "root", "class_id", F.coalesce("texts", F.lit(0)).alias("n_texts"),
        (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    rows = signed.select("key", "version", "set_id").join(described, "set_id", "left")
    return rows.select(
        "key",
        "version",
        "root",
        F.when(F.col("set_id").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def survivors(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """All columns of one row of each near-duplicate class: the smallest key, NULL last, then the smallest text hash.

    Texts without words are no class: all of them stay, but rows with equal key and text are one.
    """
    classed = near_duplicates(docs, text, key, **options)
    order = F.struct(F.col("key").isNull().alias("late"), "key", "version")
    best = classed.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min(order).alias("best")).select("best.key", "best.version")
    blank = classed.filter(F.col("root").isNull()).select("key", "version").distinct()
    kept = store(best.unionByName(blank).distinct().select(F.col("key").alias("_k"), F.col("version").alias("_v")), "kept")
    (mine,) = unused(docs, "_version")
    joined = docs.withColumn(mine, F.xxhash64(text_of(text))).join(
        kept, F.col(key).cast("long").eqNullSafe(F.col("_k")) & (F.col(mine) == F.col("_v"))
    )
    return joined.dropDuplicates(["_k", "_v"]).select(*docs.columns)
