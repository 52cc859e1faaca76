"""Pattern packing by non-negative least squares over the histogram of lengths."""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import store, text_of

CONTEXT = 2048
END = 0
CACHE_WORDS = 600_000
#: How byte-level vocabularies write bytes: printable ones as they are, the others from U+0100 on in order.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
#: Latin letters have one lower-case form and nothing to compose.
BEYOND_LATIN = re.compile("[^\x00-\u024f]|\u0130")
#: Texts that a vocabulary has to split at white space, and to which the short ways below have to do justice.
SPACED = ("one two", " Two\nThree.  four,\tfive! ", "ÉTÉ, Straße. ŁÓDŹ", "KADIKÖYİ, x", "a1 b-c 'd", "\u4f60\u597d \u0e01\u0e33,")
SHARES = (1.0, 0.8, 0.6, 0.4, 0.2)
RUN_ROWS = 100_000
PIECES = "key long, piece int, start long, length long, ids_crc32 long"


class WordIds(dict):
    """Ids of white-space separated words as little-endian bytes.

    The vocabulary's normaliser and splitter never join text across white space, so a text's ids are its
    words' ids one after another, and each distinct word needs to be encoded once.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        for text in SPACED:
            if self.text(text) != array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes():
                raise ValueError(f"{path} joins text across white space, or has another normaliser: {text!r}")

    def encode(self, text: str) -> bytes:
        if text.isalpha() and text.islower() and not BEYOND_LATIN.search(text):
            # One pre-token that the normaliser leaves as it is: only the merges are left to do.
            data = text.encode().decode("latin-1").translate(BYTE_LETTERS)
            return array("I", [t.id for t in self.tokenizer.model.tokenize(data)]).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        # Latin letters and a following comma or full stop are split in any case. Other letters may be: some are
        # written as two when they are made small, and the second goes with the stop.
        if word[-1] in ".," and word[:-1].isalpha() and not BEYOND_LATIN.search(word):
            return self[word[:-1]] + self[word[-1]]
        ids = self.encode(word)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def text(self, text: str) -> bytes:
        # str.split also splits at the separators 1C to 1F, which are no white space to the vocabulary.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.encode(text)
        if not BEYOND_LATIN.search(text):
            text = text.lower()
        return b"".join(map(self.__getitem__, text.split()))


@cache
def worker_words(path: str) -> WordIds:
    """One table of word ids per Python worker, kept over its tasks."""
    return WordIds(path)


def cut_documents(
    docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id", context: int = CONTEXT, keep_ids: bool = False
) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32[, ids]) of all texts: ids, then one end id, cut at `context`.

    A NULL or empty text has the end id alone. A NULL key stays NULL; rows that repeat a key give rows each.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = worker_words(vocabulary)
        end = np.array([END], dtype="<u4").tobytes()
        for b in batches:
            rows = []
            for k, t in zip(b["key"].astype(object), b["text"]):
                data = words.text(t) + end
                for piece, at in enumerate(range(0, len(data), 4 * context)):
                    ids = data[at : at + 4 * context]
                    rows.append((None if pd.isna(k) else int(k), piece, at // 4, len(ids) // 4, zlib.crc32(ids), ids))
            out = pd.DataFrame(rows, columns=["key", "piece", "start", "length", "ids_crc32", "ids"])
            out["key"] = out["key"].astype("Int64")
            yield out if keep_ids else out.drop(columns="ids")

    picked = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    return picked.mapInPandas(run, PIECES + (", ids binary" if keep_ids else ""))


def patterns(lengths: list[int], context: int = CONTEXT) -> list[tuple[int, ...]]:
    """All multisets of one to three of the lengths that fill a sequence exactly, longest documents first."""
    have = np.zeros(context + 1, dtype=bool)
    have[lengths] = True
    out: list[tuple[int, ...]] = [(context,)] if have[context] else []
    for a in sorted(set(lengths), reverse=True):
        rest = context - a
        if 0 < rest <= a and have[rest]:
            out.append((a, rest))
        second = np.arange(min(a, rest - 1), (rest + 1) // 2 - 1, -1) if rest >= 2 else np.array([], dtype=int)
        out += [(a, int(b), int(rest - b)) for b in second[have[second] & have[rest - second]]]
    return out


def fit_repeats(found: list[tuple[int, ...]], histogram: np.ndarray, sweeps: int = 3) -> list[float]:
    """Non-negative least squares of the histogram on the patterns, by coordinate descent.

    Each step sets one repeat count to its best value given the others. Counts that start at zero are only
    raised where length counts are left over, which keeps most of the many patterns at zero.
    """
    left = histogram.astype(float).tolist()
    repeats = [0.0] * len(found)
    weight = [sum(n * n for n in np.unique(p, return_counts=True)[1]) if len(set(p)) < len(p) else len(p) for p in found]
    for _ in range(sweeps):
        for j, p in enumerate(found):
            old = repeats[j]
            gradient = sum(left[n] for n in p)
            if gradient == 0.0 or (old == 0.0 and gradient < 0):
                continue
            new = max(0.0, old + gradient / weight[j])
            if new != old:
                repeats[j] = new
                for n in p:
                    left[n] -= new - old
    return repeats


def best_fit(histogram: np.ndarray, context: int = CONTEXT) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: longest first, each into the fullest open sequences that take it."""
    spaces: list[int] = []
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def put(space: int, pattern: tuple[int, ...], n: int) -> None:
        if not open_[space]:
            insort(spaces, space)
        open_[space].append((pattern, n))

    for length in np.flatnonzero(histogram)[::-1].tolist():
        n = int(histogram[length])
        while n:
            at = bisect_left(spaces, length)
            if at == len(spaces):
                each = min(context // length, n)
                put(context - each * length, (length,) * each, n // each)
                n %= each
                continue
            space = spaces[at]
            pattern, many = open_[space].pop()
            if not open_[space]:
                spaces.pop(at)
            each = min(space // length, n)
            used = min(many, n // each)
            if used < many:
                put(space, pattern, many - used)
            put(space - each * length, pattern + (length,) * each, used)
            n -= used * each
    return [x for space in spaces for x in open_[space]]


def plan(histogram: np.ndarray, context: int = CONTEXT) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, sequences) for a histogram of lengths 1 to `context`: rounded repeat counts, then the residual.

    Exact patterns use up the short documents that the rest needs as filling, so the counts are also tried
    at smaller shares, and the plan with the fewest sequences is taken.
    """
    found = patterns(np.flatnonzero(histogram).tolist(), context)
    repeats = fit_repeats(found, histogram)
    plans = [_rounded(found, repeats, histogram, share, context) for share in SHARES]
    return min(plans, key=lambda p: sum(n for _, n in p))


def _rounded(found: list[tuple[int, ...]], repeats: list[float], histogram: np.ndarray, share: float, context: int):
    left = histogram.astype(np.int64).copy()
    out = []
    for j in sorted((j for j, x in enumerate(repeats) if x * share >= 0.5), key=lambda j: (-found[j][0], -repeats[j])):
        lengths, counts = np.unique(found[j], return_counts=True)
        n = min(int(repeats[j] * share + 0.5), int((left[lengths] // counts).min()))
        if n:
            left[lengths] -= n * counts
            out.append((found[j], n))
    return out + best_fit(left, context)


def runs(planned: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset): the slots of the plan by rank."""
    next_rank: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for pattern, n in planned:
        offset = 0
        for length in pattern:
            first = next_rank[length]
            out.append((length, first, first + n - 1, sequence, offset))
            next_rank[length] += n
            offset += length
        sequence += n
    return out


def pack(pieces: DataFrame, length: str = "length", order: tuple[str, ...] = ("key", "piece"), context: int = CONTEXT) -> DataFrame:
    """All rows of a stored table of pieces with `sequence_id` and `offset`.

    Only the histogram (at most `context` rows) reaches the driver, and only the plan, whose size depends on
    the number of lengths and not of rows, is broadcast. Pieces are ranked within their length: lengths are
    split over salts, each salt is numbered on its own and shifted by the rows of the salts before it, so a
    length that a third of all pieces have is no single task. Rows equal in all of `order` are interchangeable.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy(F.col(length).cast("int")).count().collect()
    histogram = np.zeros(context + 1, dtype=np.int64)
    for size, n in counted:
        histogram[size] = n
    slots = spark.createDataFrame(runs(plan(histogram, context)), "_length int, _first long, _last long, _seq long, offset long")
    salts = int(histogram.sum() // RUN_ROWS) + 1
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    group = [F.col(length), F.col("_salt")]
    before = Window.partitionBy(length).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = salted.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    shifts = shifts.select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1
    numbered = salted.withColumn("_place", place).join(shifts, [length, "_salt"])
    numbered = numbered.withColumn("_rank", F.col("_place") + F.col("_shift"))
    fits = (numbered[length] == slots["_length"]) & numbered["_rank"].between(slots["_first"], slots["_last"])
    placed = numbered.join(F.broadcast(slots), fits)
    sequence = (F.col("_seq") + F.col("_rank") - F.col("_first")).alias("sequence_id")
    return placed.select(*pieces.columns, sequence, "offset")


def assemble(packed: DataFrame) -> DataFrame:
    """Sequences with their token ids, for pieces cut with `keep_ids`: (sequence_id, n_pieces, n_tokens, ids binary).

    A sequence holds at most `context` pieces, so the collected group is bounded.
    """
    part = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(part.alias("_parts"), F.count(F.lit(1)).alias("n_pieces"), F.sum("length").alias("n_tokens"))
    joined = F.aggregate("_parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.select("sequence_id", "n_pieces", "n_tokens", joined.alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str, text: str = "text", key: str = "doc_id", context: int = CONTEXT, keep_ids: bool = False) -> DataFrame:
    """Cut, store and pack all documents; see `cut_documents` and `pack`."""
    pieces = store(cut_documents(docs, vocabulary, text, key, context, keep_ids), "pieces")
    return pack(pieces, order=("key", "piece", "ids_crc32"), context=context)
