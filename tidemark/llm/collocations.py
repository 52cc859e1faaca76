"""Phrases whose words stand together more often than their parts alone would explain.

Occurrences are counted in the tasks that read the text, in a trie over word ids: its first levels are plain
tables from word id to what follows, below them are hash containers that hold all longer rests and burst into one
more level when they have grown too large. A trie with too many entries spills its largest subtrees as sorted
runs; runs travel by the leading words of their phrases and are merged per such partition.

Counting goes length by length, since a phrase is no more frequent than its parts: words first, then pairs of
frequent words, then phrases of three words and more in which all neighbours are frequent pairs. Which words and
pairs are frequent is known to the tasks from a bit table of fixed size. It may let a rare one pass, which costs
work and changes no result; it never holds back a frequent one.
"""

from __future__ import annotations

import gc
import itertools
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import store


class Limits(NamedTuple):
    """Bounds on what one task holds. They change how the work is cut, never the result."""

    #: Entries of the tries and words of a task, and entries of a container before it bursts.
    trie_entries: int = 600_000
    words: int = 1_000_000
    burst: int = 4096
    #: Tokens counted at once, bytes of one text split at once (a piece without an end is held, 8 bytes a word).
    block_tokens: int = 1_000_000
    slice_bytes: int = 1 << 20
    #: Bytes of text behind one partition of runs.
    part_bytes: int = 8 << 20
    #: Bits (as a power of two) of the table of frequent phrases: 16 MiB at any size of the input.
    sieve_bits: int = 27


LIMITS = Limits()
#: Words by which a run finds its partition.
PREFIX_WORDS = 3
#: Parts of a language in which its first phrases are sought before they are put together.
TOP_PARTS = 64

RUN = "lang string, part int, phrases binary, ends binary, counts binary"
COUNTED = "lang string, phrase string, words int, n long, cells array<int>"

_BREAK = -1
_PLAIN = bytearray(range(256))
_PLAIN[65:91] = range(97, 123)
_PLAIN[9] = 32
for _mark in b".,;:!?\x0a\x0b\x0c\x0d":
    _PLAIN[_mark] = 10
_PLAIN = bytes(_PLAIN)


_CUT = re.compile(rb"[ \t.,;:!?\x0a-\x0d]")


def words_of(text: bytes) -> Iterator[bytes]:
    """The words of a text in UTF-8, A-Z in lower case, with a line feed between pieces."""
    return filter(None, text.translate(_PLAIN).replace(b"\n", b" \n ").split(b" "))


class Vocabulary(dict):
    """Ids of words, given out as words are met."""

    def __init__(self, seed: int):
        super().__init__({b"\n": _BREAK})
        self.seed, self.names, self.hashes = seed, [], array("Q")

    def __missing__(self, word: bytes) -> int:
        self[word] = new = len(self.names)
        self.names.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        return new


class Container(dict):
    """Counts by the rest of a phrase."""


class Trie:
    """Counts of tuples of word ids."""

    END = None

    def __init__(self, burst: int):
        self.burst, self.root, self.entries = burst, {}, 0

    def add(self, phrase: tuple, n: int) -> None:
        node, depth = self.root, 0
        while depth < len(phrase):
            word = phrase[depth]
            below = node.get(word)
            if below is None:
                below = node[word] = Container()
            depth += 1
            if type(below) is Container:
                rest = phrase[depth:]
                before = below.get(rest, 0)
                below[rest] = before + n
                self.entries += not before
                # A container of single words gains nothing from one more level.
                if len(below) > self.burst and len(rest) > 1:
                    node[word] = self._levelled(below)
                return
            node = below
        self.entries += self.END not in node
        node[self.END] = node.get(self.END, 0) + n

    def _levelled(self, container: Container) -> dict:
        level: dict = {}
        for rest, n in container.items():
            if not rest:
                level[self.END] = n
            elif rest[0] in level:
                level[rest[0]][rest[1:]] = n
            else:
                level[rest[0]] = Container({rest[1:]: n})
        return level

    def add_sorted(self, phrases: np.ndarray, counts: np.ndarray) -> None:
        """Add distinct phrases of one length (rows of ids, in order): the containers of the first level fill in bulk."""
        bounds = np.flatnonzero(np.diff(phrases[:, 0], prepend=-1, append=-1))
        rests, counts = list(zip(*phrases[:, 1:].T.tolist())) or [()] * len(phrases), counts.tolist()
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            word = int(phrases[first, 0])
            below = self.root.get(word)
            if below is None:
                below = self.root[word] = Container()
            if type(below) is Container and (phrases.shape[1] <= 2 or len(below) + last - first <= self.burst):
                before, get = len(below), below.get
                for rest, n in zip(rests[first:last], counts[first:last]):
                    below[rest] = get(rest, 0) + n
                self.entries += len(below) - before
            else:
                for rest, n in zip(rests[first:last], counts[first:last]):
                    self.add((word, *rest), n)

    def take(self, keep: int) -> Iterator[tuple[tuple, dict]]:
        """Remove the largest subtrees until `keep` entries or fewer are left; gives prefixes and what follows them."""
        trees = sorted(((_size(below), word) for word, below in self.root.items()), reverse=True)
        for size, word in trees:
            if self.entries <= keep:
                return
            self.entries -= size
            yield from _walk((word,), self.root.pop(word))


def _size(below) -> int:
    if type(below) is Container:
        return len(below)
    return sum(1 if word is Trie.END else _size(next_) for word, next_ in below.items())


def _walk(prefix: tuple, below) -> Iterator[tuple[tuple, dict]]:
    if type(below) is Container:
        yield prefix, below
        return
    for word, next_ in below.items():
        if word is Trie.END:
            yield prefix, {(): next_}
        else:
            yield from _walk((*prefix, word), next_)


def _seed(lang: str) -> int:
    return zlib.crc32(lang.encode())


def _pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(hashes & np.uint64((1 << bits) - 1)).astype(np.int64), (hashes >> np.uint64(64 - bits)).astype(np.int64)]


class Sieve:
    """The frequent phrases of one length, as bits."""

    def __init__(self, bits: bytes):
        self.bits = np.frombuffer(bits, dtype=np.uint8)
        self.power = (len(bits) * 8).bit_length() - 1

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for cell in _cells(hashes, self.power):
            found &= (self.bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
        return found


class Tally:
    """The words and counts of one language in one task."""

    def __init__(self, lang: str, limits: Limits, widths: tuple[int, ...], words: Sieve | None, pairs: Sieve | None):
        self.limits = limits
        self.lang, self.widths, self.frequent, self.pairs = lang, widths, words, pairs
        self.vocabulary = Vocabulary(_seed(lang))
        self.waiting: list[int] = []
        self.trie = Trie(limits.burst)

    def read(self, text: bytes) -> None:
        first = 0
        while first < len(text):
            # Slices of a long text end at a space or the end of a piece, and follow one another without a break.
            cut = _CUT.search(text, first + self.limits.slice_bytes)
            last = cut.end() if cut else len(text)
            self.waiting.extend(map(self.vocabulary.__getitem__, words_of(text[first:last])))
            first = last
        self.waiting.append(_BREAK)
        if len(self.waiting) >= self.limits.block_tokens:
            self.count()

    def count(self) -> None:
        ids = np.array(self.waiting, dtype=np.int64)
        self.waiting.clear()
        hashes = np.array(self.vocabulary.hashes, dtype=np.uint64)
        if not len(ids) or not len(hashes):
            return
        known = np.ones(len(hashes), dtype=bool) if self.frequent is None else self.frequent.has(hashes)
        usable = (ids != _BREAK) & known[ids]
        # Numbers of the phrases of one length that start at each place: from those one word shorter.
        starts, kinds, names = usable, len(hashes), ids
        phrases = np.arange(len(hashes))[:, None]
        linked = usable[:-1] & usable[1:]
        if self.pairs is not None:
            linked[linked] = self.pairs.has(_pair_hash(hashes[ids[:-1][linked]], hashes[ids[1:][linked]]))
        for width in range(1, max(self.widths) + 1):
            if width > 1:
                # A phrase is one word longer where the last two words of the longer one go together.
                starts = starts[:-1] & linked[width - 2 :]
                names = np.where(starts, names[:-1], 0) * len(hashes) + np.where(starts, ids[width - 1 :], 0)
                own, place = np.unique(names[starts], return_inverse=True)
                phrases = np.column_stack([phrases[own // len(hashes)], own % len(hashes)])
                names = np.zeros(len(starts), dtype=np.int64)
                names[starts] = place
                kinds = len(own)
            if width in self.widths:
                counts = np.bincount(names[starts], minlength=kinds)
                present = np.flatnonzero(counts)
                self.trie.add_sorted(phrases[present], counts[present])

    def runs(self, parts: int, keep: int) -> Iterator[dict]:
        """The entries above `keep`, as one sorted run per partition."""
        ids: dict[int, list] = {width: [] for width in range(1, max(self.widths) + 1)}
        counts: dict[int, list] = {width: [] for width in ids}
        for prefix, below in self.trie.take(keep):
            for rest, n in below.items():
                ids[len(prefix) + len(rest)].append(prefix + rest)
                counts[len(prefix) + len(rest)].append(n)
        names, hashes = pa.array(self.vocabulary.names, pa.binary()), np.array(self.vocabulary.hashes, dtype=np.uint64)
        tables = []
        for width, rows in ids.items():
            if rows:
                columns = np.fromiter(itertools.chain.from_iterable(rows), np.int64, width * len(rows)).reshape(-1, width).T
                phrase = pc.binary_join_element_wise(*[names.take(pa.array(c)) for c in columns], b" ")
                part = np.zeros(len(rows), dtype=np.uint64)
                for c in columns[:PREFIX_WORDS]:
                    part = _pair_hash(part, hashes[c])
                part = (part % np.uint64(parts)).astype(np.int32)
                tables.append(pa.table({"part": part, "phrase": phrase, "n": np.array(counts[width], dtype=np.int64)}))
        if not tables:
            return
        table = pa.concat_tables(tables)
        table = table.sort_by([("part", "ascending"), ("phrase", "ascending")]).combine_chunks()
        part, n = table.column("part").to_numpy(), table.column("n").to_numpy()
        phrase = pa.concat_arrays(table.column("phrase").chunks)
        ends = np.frombuffer(phrase.buffers()[1], dtype=np.int32)[: len(phrase) + 1]
        data = phrase.buffers()[2].to_pybytes()
        bounds = np.flatnonzero(np.diff(part, prepend=-1, append=-1)).tolist()
        for first, last in zip(bounds[:-1], bounds[1:]):
            yield {
                "lang": self.lang,
                "part": int(part[first]),
                "phrases": data[ends[first] : ends[last]],
                "ends": (ends[first + 1 : last + 1] - ends[first]).tobytes(),
                "counts": n[first:last].tobytes(),
            }


def _counting(parts: int, limits: Limits, widths: tuple[int, ...], words=None, pairs=None) -> Callable:
    """Batches of (lang, text) to runs; `words` and `pairs` are broadcast bit tables."""
    schema = pa.schema([("lang", pa.string()), ("part", pa.int32()), *[(c, pa.binary()) for c in ("phrases", "ends", "counts")]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tables of numbers and tuples hold no cycles: collecting them again and again would only cost time.
        gc.disable()
        sieves = [s and Sieve(s.value) for s in (words, pairs)]
        tallies: dict[str, Tally] = {}

        def spilled(keep: int) -> Iterator[pa.RecordBatch]:
            for tally in tallies.values():
                tally.count()
                rows = list(tally.runs(parts, keep // len(tallies)))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            texts, langs = batch.column("text").cast(pa.binary()), batch.column("lang")
            for i in range(batch.num_rows):
                lang = langs[i].as_py()
                if lang not in tallies:
                    tallies[lang] = Tally(lang, limits, widths, *sieves)
                tallies[lang].read(texts[i].as_py())
                if i % 64 == 0 or len(tallies[lang].waiting) == 0:
                    if sum(len(t.vocabulary.names) + len(t.waiting) // 4 for t in tallies.values()) > limits.words:
                        yield from spilled(0)
                        tallies.clear()
                    elif sum(t.trie.entries for t in tallies.values()) > limits.trie_entries:
                        yield from spilled(limits.trie_entries // 2)
        yield from spilled(0)
        gc.enable()

    return count


def _merging(min_count: int, bits: int) -> Callable:
    """All runs of one partition to the phrases with enough occurrences, and one row (no phrase) with all of them."""

    def merge(runs: pa.Table) -> pa.Table:
        lang, phrases, counts = runs.column("lang")[0].as_py(), [], []
        for run in runs.select(["phrases", "ends", "counts"]).to_batches():
            for data, ends, n in zip(*[run.column(c).to_pylist() for c in run.schema.names]):
                offsets = np.concatenate([[0], np.frombuffer(ends, dtype=np.int32)]).astype(np.int32)
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
                phrases.append(pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers))
                counts.append(pa.array(np.frombuffer(n, dtype=np.int64)))
        merged = pa.table({"phrase": pa.chunked_array(phrases), "n": pa.chunked_array(counts)})
        merged = merged.group_by("phrase").aggregate([("n", "sum")])
        total = pc.sum(merged.column("n_sum")).as_py()
        merged = merged.filter(pc.greater_equal(merged.column("n_sum"), min_count))
        names = merged.column("phrase").to_pylist()
        parts, seed = [p.split(b" ") for p in names], _seed(lang)
        hashes = [np.array([xxhash.xxh64_intdigest(w, seed) for w in p], dtype=np.uint64) for p in parts]
        # Only words and pairs are looked up later.
        found = [h if len(h) == 1 else _pair_hash(h[:1], h[1:]) if len(h) == 2 else h[:0] for h in hashes]
        cells = [[int(c[0]) for c in _cells(h, bits)] if len(h) else [] for h in found]
        return pa.table(
            {
                "lang": pa.array([lang] * (len(names) + 1), pa.string()),
                "phrase": pa.array([p.decode() for p in names] + [None], pa.string()),
                "words": pa.array([len(p) for p in parts] + [0], pa.int32()),
                "n": pa.array(merged.column("n_sum").to_pylist() + [total], pa.int64()),
                "cells": pa.array([*cells, []], pa.list_(pa.int32())),
            }
        )

    return merge


def _counted(texts: DataFrame, parts: int, limits: Limits, min_count: int, widths: tuple[int, ...], words=None, pairs=None):
    runs = texts.mapInArrow(_counting(parts, limits, widths, words, pairs), RUN)
    return store(runs.groupBy("lang", "part").applyInArrow(_merging(min_count, limits.sieve_bits), COUNTED), "phrases")


def _sieve(counted: DataFrame, power: int):
    """The phrases of a counted table as a broadcast bit table of 2^power bits."""
    cells = counted.select(F.explode("cells").alias("cell"))
    blocks = cells.groupBy(F.shiftright("cell", 15).alias("block")).agg(
        F.bitmap_construct_agg(F.col("cell").bitwiseAND(F.lit(32767)).cast("long")).alias("bits")
    )
    bits = bytearray(1 << (power - 3))
    for row in blocks.toLocalIterator():
        bits[row.block * 4096 : (row.block + 1) * 4096] = row.bits
    return counted.sparkSession.sparkContext.broadcast(bytes(bits))


def count_phrases(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 30, max_words: int = 4, limits: Limits = LIMITS
) -> DataFrame:
    """(lang, phrase, words, n): phrases of up to `max_words` words with at least `min_count` occurrences per language.

    A-Z counts as a-z; texts are cut into pieces at `.,;:!?` and line ends, and no phrase crosses a cut. One row
    per language has no phrase: its n is the number of all its words. A NULL language is `und`, a NULL text is
    empty; a table without words gives no rows. Only `lang` and `text` are read.
    """
    texts = docs.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bounds = (max(1, -(-size // limits.part_bytes)), limits, min_count)
    one = _counted(texts, *bounds, (1,))
    found = [one.filter("phrase is not null")]
    if max_words > 1:
        words = _sieve(one, limits.sieve_bits)
        found.append(_counted(texts, *bounds, (2,), words).filter("phrase is not null"))
    if max_words > 2:
        pairs = _sieve(found[1], limits.sieve_bits)
        longer = _counted(texts, *bounds, tuple(range(3, max_words + 1)), words, pairs)
        found.append(longer.filter("phrase is not null"))
    totals = one.filter("phrase is null").groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    out = totals
    for table in found:
        out = out.unionByName(table.select("lang", "phrase", "words", "n"))
    return out


def _slice(phrase: Column, first: Column, words: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, words), " ")


def score_phrases(counted: DataFrame, cover: int = 80) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the phrases of two words and more that no longer one stands for.

    `counted` is a stored `count_phrases`. Of all cuts of a phrase into two parts the one with the lowest score
    counts, on ties the shortest first part. A phrase goes if a longer one that contains it has `cover` percent of
    its occurrences or more.
    """
    phrases = counted.filter("words >= 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    longer = phrases.filter("words >= 2")
    cut = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.withColumn("head", _slice(F.col("phrase"), F.lit(1), F.col("k")))
    cut = cut.withColumn("tail", _slice(F.col("phrase"), F.col("k") + 1, F.col("words") - F.col("k")))
    heads = phrases.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = phrases.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    exact = F.expr("(cast(a as decimal(20, 0)) * 2000000bd) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    scored = cut.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn("score", exact)
    lowest = scored.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = longer.filter("words >= 3").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = inner.select("lang", _slice(F.col("phrase"), F.col("first"), F.col("size")).alias("phrase"), F.col("a").alias("outer"))
    covered = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    left = lowest.join(covered, ["lang", "phrase"], "left").filter(F.expr(f"outer is null or 100 * outer < {cover} * a"))
    return left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def best_phrases(scored: DataFrame, top: int = 2000) -> DataFrame:
    """The first `top` of each language, with their rank: by score, occurrences and phrase, in UTF-8 byte order."""
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # First per part of a language, so that one with very many phrases is cut down before they meet.
    part = F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS))
    some = Window.partitionBy("lang", part).orderBy(*order)
    ahead = scored.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    ranked = ahead.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.filter(F.col("rank") <= top).withColumn("rank", F.col("rank").cast("long"))


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", min_count: int = 30, top: int = 2000, limits: Limits = LIMITS
) -> DataFrame:
    """The `top` phrases of two to four words per language with n, all its words, by the definitions of the functions above."""
    counted = store(count_phrases(docs, lang, text, min_count, limits=limits), "counted")
    totals = counted.filter("phrase is null").select("lang", "n")
    return best_phrases(score_phrases(counted), top).join(totals, "lang")
