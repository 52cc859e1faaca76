"""Passage dedup: hashed lines, sentences and runs of 50 words, of which only the earliest occurrence stays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from tidemark.llm.common import store, text_of, unused
from tidemark.llm.repeats import Grams, sliding_min

#: Every run of so many words is a unit, wherever it starts.
RUN = 50
#: Lines and sentences of more words are units. Shorter ones are notices and headings, which clean texts share.
MIN_WORDS = 24
#: Words that hash a place, the smallest of which in a run is the run's anchor.
GRAM = 16
PLACES = "key long, version long, start int, stop int, lo int, hi int, gram long, whole long"
RUNS = "key long, version long, start int, stop int, digest long, check int"
#: Hashes of words kept by a Python worker.
CACHE_WORDS = 500_000
NO_KEY = 2**63 - 1
#: Texts handled at a time by a Python worker.
TEXTS = 1000
#: White space by code point, as `str.split` has it; no code point above is white space.
BLANK = np.array([chr(c).isspace() for c in range(0x3001)] + [False])
#: Lowest bit of the hash of a word that ends a sentence.
END = np.uint64(1)


def version(text: Column) -> Column:
    """A hash that tells texts with one key apart."""
    return F.xxhash64(text)


def _picked(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("key"), version(text_of(text)).alias("version"), text_of(text).alias("text"))


class _WordHashes(dict):
    """Hashes of lower-case words; the lowest bit tells a word that ends with a full stop, `!` or `?`."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        self[word] = h = h >> 1 << 1 | (word[-1] in ".!?")
        return h


def _hashed(text: str, known: _WordHashes) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def _word_places(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters where words start and stop, and how many words stand before each line feed."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    inside = np.concatenate([[False], ~BLANK[np.minimum(points, len(BLANK) - 1)], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1]).astype(np.int32)
    return edges[::2], edges[1::2], np.searchsorted(edges[::2], np.flatnonzero(points == 10))


def _whole_units(words: np.ndarray, feeds: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) words of the lines and sentences of more than `min_words` and fewer than `RUN` words.

    Longer ones need no row: where one occurs earlier, so do all of its runs.
    """
    n = len(words)
    lines = np.unique(np.concatenate([[0], feeds, [n]]))
    ends = np.unique(np.concatenate([lines, np.flatnonzero(words & END) + 1]))
    several = np.diff(np.searchsorted(ends, lines)) > 1
    first, end = np.concatenate([ends[:-1], lines[:-1][several]]), np.concatenate([ends[1:], lines[1:][several]])
    fits = (end - first > min_words) & (end - first < RUN)
    return first[fits], end[fits]


def _other(x: np.ndarray) -> np.ndarray:
    """A second hash of each word, a one-to-one function of the first."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rows(kind: str, parts: list[tuple], keys: list, versions: list, sizes: list[int]) -> pd.DataFrame:
    """Columns of arrays, one tuple of them per text, as rows with the text's key and version."""
    names = [c.split()[0] for c in kind.split(", ")][2:]
    cols = zip(*parts) if parts else [[np.zeros(0, dtype=np.int64)] for _ in names]
    at = np.repeat(np.arange(len(sizes)), sizes)
    frame = {"key": pd.array(keys, dtype="Int64")[at], "version": np.array(versions, dtype=np.int64)[at]}
    return pd.DataFrame(frame | {n: np.concatenate(c) for n, c in zip(names, cols)})


class _Sums:
    """Hashes of any stretch of one text's words, by prefix sums modulo 2^64."""

    def __init__(self, values: np.ndarray, grams: Grams):
        grams(values)  # Makes its tables of powers long enough.
        self.down = grams.down
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum((values + np.uint64(1)) * grams.up[: len(values)])])

    def __call__(self, first: np.ndarray, end: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return _other((self.sums[end] - self.sums[first]) * self.down[first] + mark.astype(np.uint64)).view(np.int64)


def unit_places(picked: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per line and sentence of every whole text, and one per anchor of its runs; a single pass.

    The runs that start at words lo..hi of a text have the same smallest gram, their anchor. Equal runs have it
    at equal distance. `gram` hashes the anchor's words and `whole` all words of the runs and where the anchor
    is among them. Of a line or a sentence both hash all of its words, and lo and hi are -1. start..stop
    are the characters covered.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, grams, ones = _WordHashes(), Grams(GRAM), Grams(1)
        for b in (x.iloc[i : i + TEXTS] for x in batches for i in range(0, len(x), TEXTS)):
            parts, keys, versions, sizes = [], [], [], []
            for k, v, t in zip(b["key"].astype("Int64"), b["version"], b["text"]):
                words = _hashed(t, known)
                if len(words) <= min(min_words, RUN - 1):
                    continue
                starts, stops, feeds = _word_places(t)
                other = _Sums(_other(words), ones)
                first, end = _whole_units(words, feeds, min_words)
                none = np.full(len(first), -1)
                found = [(starts[first], stops[end - 1], none, none, _Sums(words, ones)(first, end, end - first), other(first, end, end - first))]
                n = len(words) - RUN + 1
                if n > 0:
                    hashes = grams(words)
                    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
                    at = (sliding_min(packed, RUN - GRAM + 1)[:n] & np.uint64(0xFFFFFFFF)).astype(np.int64)
                    lo = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                    hi, at = np.append(lo[1:], n) - 1, at[lo]
                    found.append((starts[lo], stops[hi + RUN - 1], lo, hi, hashes[at].view(np.int64), other(lo, hi + RUN, (at - lo) * RUN + hi - lo)))
                parts += found
                keys += [k] * len(found)
                versions += [v] * len(found)
                sizes += [len(x[0]) for x in found]
            yield _rows(PLACES, parts, keys, versions, sizes)

    return picked.mapInPandas(run, PLACES)


def run_units(picked: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row per run that starts at a word of the wanted ranges (key, version, lo, hi)."""
    lists = wanted.groupBy("key", "version").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")).toDF("_k", "_v", "ranges")
    joined = picked.join(lists, F.col("key").eqNullSafe(F.col("_k")) & (F.col("version") == F.col("_v"))).drop("_k", "_v")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, runs = _WordHashes(), Grams(RUN)
        for b in (x.iloc[i : i + TEXTS] for x in batches for i in range(0, len(x), TEXTS)):
            parts, keys, versions, sizes = [], [], [], []
            for k, v, t, ranges in zip(b["key"].astype("Int64"), b["version"], b["text"], b["ranges"]):
                words = _hashed(t, known)
                at = np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in ranges])
                starts, stops, _ = _word_places(t)
                digest, check = runs(words)[at].view(np.int64), runs(_other(words))[at].astype(np.uint32).view(np.int32)
                parts.append((starts[at], stops[at + RUN - 1], digest, check))
                keys.append(k)
                versions.append(v)
                sizes.append(len(at))
            yield _rows(RUNS, parts, keys, versions, sizes)

    return joined.mapInPandas(run, RUNS)


def _place() -> Column:
    return F.struct(F.coalesce("key", F.lit(NO_KEY)).alias("key"), "version", "start")


def repeated_units(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, version, start, stop) of units, or several runs that overlap, that occur earlier.

    Rows alone with their gram occur once. Where rows agree in `whole`, all units of the later ones occur
    earlier, and the first stands for them; only where a gram has several wholes are runs compared singly.
    """
    picked = _picked(docs, text, key)
    found = store(unit_places(picked, min_words), "places")
    grams = found.groupBy("gram").agg(F.min(_place()).alias("_a"), F.max(_place()).alias("_z"), F.min("whole").alias("_w"), F.max("whole").alias("_x"))
    grams = grams.filter(F.col("_a") != F.col("_z")).select("gram", (F.col("_w") != F.col("_x")).alias("mixed"))
    repeated = store(found.join(store(grams, "repeated-grams"), "gram"), "repeated-places")
    firsts = repeated.groupBy("gram", "whole").agg(F.min(_place()).alias("first")).toDF("_g", "_w", "first")
    firsts = store(firsts, "first-places")
    marked = repeated.join(firsts, (F.col("gram") == F.col("_g")) & (F.col("whole") == F.col("_w")))
    cover = ["key", "version", "start", "stop"]
    settled = marked.filter(F.col("first") != _place()).select(*cover)
    wanted = marked.filter((F.col("first") == _place()) & F.col("mixed") & (F.col("lo") >= 0))
    compared = _later(store(run_units(picked, wanted), "runs"))
    return settled.unionByName(compared.select(*cover))


def _later(found: DataFrame) -> DataFrame:
    """The runs that occur earlier.

    The earliest occurrence of a digest forms in the map tasks first, so a passage that a third of all texts
    share is one row per task; its join back is split by Spark where it is skewed.
    """
    firsts = found.groupBy("digest", "check").agg(F.min(_place()).alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1").select(F.col("digest").alias("_d"), F.col("check").alias("_c"), "first")
    # Stored, so that both sides of the join are read by a shuffle of their own and Spark can split a hot digest.
    firsts = store(firsts, "repeated")
    again = found.join(firsts, (F.col("digest") == F.col("_d")) & (F.col("check") == F.col("_c")))
    return again.filter(F.col("first") != _place())


def removed_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """(key, version, spans): character spans of all units that occur earlier, merged, per text that has any.

    Earlier is by (key, version, place), NULL keys last; `version` is a hash of the text, so rows that share
    a key are told apart, and equal rows count as one document.
    """
    again = repeated_units(docs, text, key, min_words)
    spans = F.sort_array(F.collect_set(F.shiftleft(F.col("start").cast("long"), 32) + F.col("stop")))
    merged = again.groupBy("key", "version").agg(spans.alias("spans")).withColumn("spans", _merged("spans"))
    pair = lambda x: F.struct(F.shiftright(x, 32).cast("int").alias("start"), x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("stop"))
    return merged.withColumn("spans", F.transform("spans", pair))


@F.pandas_udf(ArrayType(LongType()))
def _merged(spans: pd.Series) -> pd.Series:
    """Sorted spans, start * 2^32 + stop each, with the overlapping and touching ones joined."""

    def joined(x: np.ndarray) -> np.ndarray:
        start, stop = x >> 32, np.maximum.accumulate(x & 0xFFFFFFFF)
        first = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1] + 1]))
        return (start[first] << 32) + stop[np.append(first[1:], len(x)) - 1]

    return spans.map(joined)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows and columns of `docs`, the text without its repeated passages, plus `removed` and `n_removed`.

    `removed` holds the spans (start, stop) in characters of the original text, ascending; `n_removed` their
    total length. Units are whole lines and whole sentences (up to a word that ends with a full stop, `!` or `?`,
    or to the end of the line) of more than `min_words` words, and every run of `RUN` words, wherever it starts;
    equal are units of the same words, case and white space aside. So a passage of `RUN` words or more is found
    from its first word to its last, and of a shorter one the sentences that lie in it whole. Passages may overlap:
    of one word said over and over, or of any period, what stays is the first period.
    NULL, empty and shorter texts stay as they are, with no spans. Rows with equal key and text are one
    document: the same is removed from each. Columns of `docs` named `removed` or `n_removed` are replaced.
    """
    docs = docs.drop(*(c for c in ("removed", "n_removed") if c not in (text, key)))
    k, v, found, mine = unused(docs, "_k", "_v", "_found", "_version")
    spans = removed_spans(docs, text, key, min_words).toDF(k, v, found)
    joined = docs.withColumn(mine, version(text_of(text))).join(
        spans, F.col(key).cast("long").eqNullSafe(F.col(k)) & (F.col(mine) == F.col(v)), "left"
    )
    whole = F.col(text)

    def kept(s: Column) -> Column:
        before = lambda x, i: F.substring(whole, F.coalesce(F.get(s, i - 1)["stop"], F.lit(0)) + 1, x["start"] - F.coalesce(F.get(s, i - 1)["stop"], F.lit(0)))
        tail = F.substring(whole, F.get(s, F.size(s) - 1)["stop"] + 1, F.length(whole))
        return F.concat(F.array_join(F.transform(s, before), ""), tail)

    none = F.array().cast("array<struct<start:int,stop:int>>")
    total = F.aggregate(F.col(found), F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return joined.withColumns(
        {
            text: F.when(F.col(found).isNull(), whole).otherwise(kept(F.col(found))),
            "removed": F.coalesce(found, none),
            "n_removed": F.coalesce(total, F.lit(0).cast("long")),
        }
    ).drop(k, v, found, mine)
