"""Maximal repeats over anchored suffixes: a stack scan of an enhanced suffix array with left contexts."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store, text_of, unused

LENGTH = 400
GRAM = 64
BASE = 0x9E3779B97F4A7C15 | 1
ANCHORS = "tid binary, at int, lo int, hi int, key long, whole long"
CONTEXT = "key long, tid binary, at int, single boolean, before binary, after binary"
#: Texts handled at a time by a Python worker.
TEXTS = 1000
#: Surroundings of one key that one task compares; beyond it the key is split by longer keys.
CROWD = 20_000
#: Starts of strings, before an anchor, that share a key when a crowded key is split, and then split again.
WIDTHS = (40, 8, 1)
SPAN = "array<struct<start:int,stop:int>>"


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base, dtype=np.uint64)]))


class Grams:
    """Hashes of all runs of `size` bytes, by prefix sums modulo 2^64; tables of powers grow with the texts."""

    def __init__(self, size: int):
        self.size, self.up, self.down = size, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64)

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if len(self.up) <= n:
            self.up, self.down = _powers(BASE, 2 * n), _powers(pow(BASE, -1, 2**64), 2 * n)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n])])
        x = (sums[self.size :] - sums[: -self.size]) * self.down[: n - self.size + 1]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of w values, from minima within blocks of w."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(after[: n - w + 1], before[w - 1 : n])


def anchors_of(data: bytes, grams: Grams, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(at, lo, hi): the strings of `length` bytes that start in lo..hi have their anchor at `at`.

    The anchor is the place of the smallest gram hash among the grams that start in the string's first half,
    the first of equals, so equal strings have it at equal distance.
    """
    n = len(data)
    if n < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    hashes = grams(np.frombuffer(data, dtype=np.uint8))
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    at = (sliding_min(packed, length // 2)[: n - length + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    lo = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[lo], lo, np.append(lo[1:], len(at)) - 1


def text_id(text: Column) -> Column:
    """The first 16 bytes of the SHA-256 of the text."""
    return F.unhex(F.substring(F.sha2(F.encode(text, "utf-8"), 256), 1, 32))


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """One row per anchor of every whole text (tid, text).

    `key` hashes the bytes that all strings with this anchor have from it on; `whole` hashes everything that
    the strings lo..hi cover. Two rows with equal (key, whole), 128 bits together, are equal over all of it.
    """
    core = length - length // 2 + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = Grams(min(GRAM, core))
        for b in (x.iloc[i : i + TEXTS] for x in batches for i in range(0, len(x), TEXTS)):
            out = {c: [] for c in ("at", "lo", "hi", "key", "whole")}
            tids: list[bytes] = []
            for tid, text in zip(b["tid"], b["text"]):
                data = text.encode()
                at, lo, hi = anchors_of(data, grams, length)
                view = memoryview(data)
                tids += [tid] * len(at)
                for a, i, j in zip(at.tolist(), lo.tolist(), hi.tolist()):
                    out["key"].append(xxhash.xxh3_64_intdigest(view[a : a + core]))
                    out["whole"].append(xxhash.xxh3_64_intdigest(view[i : j + length], 1))
                for c, v in (("at", at), ("lo", lo), ("hi", hi)):
                    out[c].append(v)
            frame = {c: np.concatenate(out[c]) if out[c] else np.zeros(0, dtype=int) for c in ("at", "lo", "hi")}
            hashes = {c: np.array(out[c], dtype=np.uint64).view(np.int64) for c in ("key", "whole")}
            yield pd.DataFrame({"tid": tids, **frame, **hashes})

    return texts.mapInPandas(run, ANCHORS)


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def scan(right: list[bytes], left: list[bytes]) -> Iterator[tuple[int, int, int, int, list[tuple[int, int]]]]:
    """The interval tree of sorted suffixes `right`, children first: (first, last, depth, common left, news).

    `left` holds the reversed text before each suffix. A node's suffixes first..last agree in `depth` bytes;
    together with the `common left` bytes before all of them that is a repeat that can be extended on neither
    side, as its left extensions differ and its suffixes part. `news` lists members (index, bytes) whose
    longest left agreement with another member grew at this node. Members are kept sorted by left context and
    the smaller set goes into the larger one, so the work is n log^2 n.
    """
    n = len(right)
    best = [-1] * n

    def leaf(i: int) -> list[tuple[bytes, int]]:
        return [(left[i], i)]

    def merge(big: list, small: list, news: dict[int, int]) -> list:
        if len(big) < len(small):
            big, small = small, big
        for item in small:
            k = bisect_left(big, item)
            for j in (k - 1, k):
                if 0 <= j < len(big):
                    c = common(item[0], big[j][0])
                    for i in (item[1], big[j][1]):
                        if c > best[i]:
                            best[i] = news[i] = c
            big.insert(k, item)
        return big

    # Stack of open intervals: depth, first index, members, news.
    stack: list[list] = []
    for i in range(n + 1):
        depth = common(right[i - 1], right[i]) if 0 < i < n else -1
        node = [None, i - 1, leaf(i - 1), {}] if i else None
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            if node:
                top[2] = merge(top[2], node[2], top[3])
            yield top[1], i - 1, top[0], common(top[2][0][0], top[2][-1][0]), list(top[3].items())
            node = [None, top[1], top[2], {}]
        if depth < 0 or node is None:
            continue
        if stack and stack[-1][0] == depth:
            stack[-1][2] = merge(stack[-1][2], node[2], stack[-1][3])
        else:
            stack.append([depth, node[1], node[2], {}])


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one key after another, from batches sorted by key."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        keys = b["key"].to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(b)]
        for i, j in zip(cuts, cuts[1:]):
            part = b.iloc[i:j]
            if held and held[0]["key"].iloc[0] != part["key"].iloc[0]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Cut the bytes around the wanted anchors out of the texts: (key, tid, at, single, before, after)."""
    half, core = length // 2, length - length // 2 + 1
    lists = wanted.groupBy("tid").agg(F.collect_list(F.struct("key", "at", "single")).alias("places"))
    joined = texts.dropDuplicates(["tid"]).join(lists, "tid")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (x.iloc[i : i + TEXTS] for x in batches for i in range(0, len(x), TEXTS)):
            rows = []
            for tid, text, places in zip(b["tid"], b["text"], b["places"]):
                data = text.encode()
                for p in places:
                    at = p["at"]
                    before = data[max(0, at - half + 1) : at][::-1]
                    rows.append((p["key"], tid, at, p["single"], before, data[at + core : at + length]))
            yield pd.DataFrame(rows, columns=["key", "tid", "at", "single", "before", "after"])

    return joined.mapInPandas(run, CONTEXT)


def repeat_groups(contexts: DataFrame, length: int, spans: bool) -> DataFrame:
    """Scan each key's suffixes.

    spans: (tid, start, stop) of the parts of single anchors that another occurrence repeats; else the maximal
    repeats of `length` bytes or more, a row per occurrence: (key, first, last, size, tid, start). Groups nest;
    an occurrence is listed with its smallest group, and first..last are positions among the key's sorted
    suffixes, so a group's occurrences are the rows of the key whose own bounds lie within its bounds.
    """
    core = length - length // 2 + 1
    kind = "tid binary, start int, stop int" if spans else "key long, first int, last int, size int, tid binary, start int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for g in _groups(batches):
            key, tids, ats = int(g["key"].iloc[0]), g["tid"].tolist(), g["at"].tolist()
            single = g["single"].tolist()
            listed: set[int] = set()
            for first, last, depth, before, news in scan(g["after"].tolist(), g["before"].tolist()):
                reach = core + depth
                if spans:
                    out += [(tids[i], ats[i] - c, ats[i] + reach) for i, c in news if single[i] and c + reach >= length]
                elif before + reach >= length:
                    new = [i for i in range(first, last + 1) if i not in listed]
                    listed.update(new)
                    out += [(key, first, last, before + reach, tids[i], ats[i] - before) for i in new]
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=[c.split()[0] for c in kind.split(", ")])
                out = []
        yield pd.DataFrame(out, columns=[c.split()[0] for c in kind.split(", ")])

    ordered = contexts.repartition("key").sortWithinPartitions("key", "after", "tid", "at")
    return ordered.mapInPandas(run, kind)


def _split(rows: DataFrame, width: int, room: int) -> DataFrame:
    """Each row once per range of string starts: `key` and `whole` hash what all, and any, of its strings cover.

    A string that starts x bytes before the anchor has x bytes before and room - x after the anchor's core, so
    ranges are the same for all rows, and rows with equal strings meet under an equal key. Ranges divide the
    range that the row had. x_lo and x_hi bound the strings that the text has room for.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                for lo in range(r.lo, r.hi + 1, width):
                    hi = min(lo + width - 1, r.hi)
                    x_lo, x_hi = max(lo, room - len(r.after)), min(hi, len(r.before))
                    if x_lo <= x_hi:
                        tag = b"%d %d %d %d " % (r.base, lo, hi, min(lo, len(r.before)))
                        core = tag + r.before[:lo] + b" " + r.after[: room - hi]
                        key = xxhash.xxh3_64_intdigest(core)
                        whole = xxhash.xxh3_64_intdigest(b"%d %d " % (x_hi, x_lo) + r.before[:x_hi] + r.after[: room - x_lo], key)
                        ids = [v - 2**64 if v >= 2**63 else v for v in (key, whole)]
                        out.append((*ids, r.base, r.tid, r.at, r.single, r.before, r.after, lo, hi, x_lo, x_hi))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in kind.split(", ")])

    kind = f"key long, whole long, base long, {CONTEXT.removeprefix('key long, ')}, lo int, hi int, x_lo int, x_hi int"
    return rows.mapInPandas(run, kind)


def _uncrowded(contexts: DataFrame, length: int, crowd: int) -> tuple[DataFrame, DataFrame | None]:
    """Contexts whose keys have at most `crowd` rows, and spans settled on the way there.

    Crowded keys are split by ranges of string starts, each with a longer key: rows alone under theirs have no
    twin, rows that agree over all of theirs are settled by count, and what is still crowded is split again,
    down to one start per key, where counts settle everything. Nothing is dropped that could be a repeat.
    """
    room = length - (length - length // 2 + 1)

    def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        many = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > crowd).select("key")
        many = store(many, "crowded")
        return rows.join(many, "key", "left_anti"), rows.join(many, "key", "left_semi")

    calm, hot = parted(contexts)
    ready, settled = [calm], None
    hot = hot.withColumns({"base": F.col("key"), "lo": F.lit(0), "hi": F.lit(room)})
    for width in WIDTHS:
        if hot.isEmpty():
            break
        pieces = store(_split(hot, width, room), "split")
        place = F.struct("tid", "at")
        found = pieces.groupBy("key", "whole").agg((F.min(place) != F.max(place)).alias("twins"), F.min(place).alias("one"))
        found = store(found, "split-wholes")
        lone = found.groupBy("key").agg(F.count(F.lit(1)).alias("wholes"))
        spans = pieces.join(found.filter("twins").select("key", "whole"), ["key", "whole"]).filter("single")
        spans = spans.select("tid", (F.col("at") - F.col("x_hi")).alias("start"), (F.col("at") - F.col("x_lo") + length).alias("stop"))
        settled = spans if settled is None else settled.unionByName(spans)
        standing = pieces.join(found.withColumnRenamed("twins", "_twins"), ["key", "whole"]).filter(place == F.col("one"))
        standing = standing.withColumn("single", F.col("single") & ~F.col("_twins")).join(lone.filter("wholes > 1").select("key"), "key")
        standing = store(standing.drop("_twins", "one", "whole", "x_lo", "x_hi"), "split-rest")
        calm, hot = parted(standing)
        ready.append(calm.select(*contexts.columns))
    out = ready[0]
    for more in ready[1:]:
        out = out.unionByName(more)
    return out, settled


def _candidates(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(tid, start, stop) that are repeated as a whole, and the anchors whose surroundings must be compared.

    Most anchors of repeated text have twins that agree over all they cover: they are settled by hash counts
    alone, and one of them stands for all. Only anchors near the ends of repeats need their bytes.
    """
    found = store(anchors(texts, length), "anchors")
    place = F.struct("tid", "at")
    keys = found.groupBy("key").agg(F.min(place).alias("_a"), F.max(place).alias("_z"), F.min("whole").alias("_w"), F.max("whole").alias("_x"))
    keys = keys.filter(F.col("_a") != F.col("_z"))
    keys = store(keys.select("key", (F.col("_w") == F.col("_x")).alias("uniform")), "repeated-keys")
    repeated = store(found.join(keys, "key"), "repeated")
    cover = ["tid", F.col("lo").alias("start"), (F.col("hi") + length).cast("int").alias("stop")]
    uneven = repeated.filter(~F.col("uniform"))
    each = F.struct("tid", "at", "lo", "hi")
    wholes = uneven.groupBy("key", "whole").agg(F.min(each).alias("rep"), (F.min(place) == F.max(place)).alias("single"))
    wholes = store(wholes, "wholes")
    twins = uneven.join(wholes.filter(~F.col("single")).select("key", "whole"), ["key", "whole"])
    settled = repeated.filter("uniform").select(*cover).unionByName(twins.select(*cover))
    return settled, wholes.select("key", "single", "rep.tid", "rep.at")


def _texts(docs: DataFrame, text: str, length: int) -> DataFrame:
    whole = text_of(text)
    return docs.select(text_id(whole).alias("tid"), whole.alias("text")).filter(F.octet_length("text") >= length)


def maximal_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH) -> DataFrame:
    """Groups of maximal repeats around the anchors that need comparing, with all occurrences; see `repeat_groups`."""
    texts = _texts(docs, text, length)
    _, wanted = _candidates(texts, length)
    return repeat_groups(_contexts(texts, wanted, length), length, spans=False)


def remove_repeated_bytes(docs: DataFrame, text: str = "text", length: int = LENGTH, crowd: int = CROWD) -> DataFrame:
    """All rows and columns of `docs` with `n_bytes`, `removed` (spans in bytes, ascending, disjoint) and `kept`.

    Removed is every byte covered by a string of `length` bytes of this or another row that also starts
    anywhere else; strings lie within one text and are judged on the input. Texts that equal another row's
    text go whole if they have `length` bytes. A NULL text is empty; shorter texts keep everything. Columns of
    `docs` named like the added ones are replaced.

    Suffixes with one key (what follows the anchor) and different surroundings are scanned in one task, up to
    `crowd` of them; equal surroundings, however many, count once, and a key with more is split exactly.
    """
    docs = docs.drop(*(c for c in ("n_bytes", "removed", "kept") if c != text))
    mine, t, n, found, done = unused(docs, "_mine", "_t", "_n", "_found", "_done")
    texts = _texts(docs, text, length)
    settled, wanted = _candidates(texts, length)
    contexts, split = _uncrowded(store(_contexts(texts, wanted, length), "contexts"), length, crowd)
    partial = repeat_groups(contexts, length, spans=True)
    partial = partial if split is None else partial.unionByName(split)
    spans = settled.unionByName(partial).groupBy("tid").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    copies = texts.groupBy("tid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    known = store(spans.join(copies, "tid", "full"), "spans").toDF(t, found, n)

    @F.pandas_udf("struct<removed:array<struct<start:int,stop:int>>,kept:binary>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for data, spans in batches:
            rows = [_cut(d, s) for d, s in zip(data, spans)]
            yield pd.DataFrame(rows, columns=["removed", "kept"])

    data = F.encode(text_of(text), "utf-8")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("stop")))
    joined = docs.withColumn(mine, text_id(text_of(text))).withColumn("n_bytes", F.octet_length(text_of(text)).cast("long"))
    joined = joined.join(known, F.col(mine) == F.col(t), "left")
    spans = F.when(F.col(n).isNotNull(), whole).otherwise(F.coalesce(found, F.array().cast(SPAN)))
    parts = joined.withColumn(found, spans).withColumn(done, cut(data, found))
    return parts.select(*docs.columns, "n_bytes", F.col(done)["removed"].alias("removed"), F.col(done)["kept"].alias("kept"))


def _cut(data: bytes, spans) -> tuple[list[tuple[int, int]], bytes]:
    merged: list[list[int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([start, stop])
    kept, at = [], 0
    for start, stop in merged:
        kept.append(data[at:start])
        at = stop
    return [(a, b) for a, b in merged], b"".join([*kept, data[at:]])
