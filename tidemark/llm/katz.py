"""Katz backoff language model of order two: training, storage and scoring of all texts in one pass of blocks.

P(w | v) = d(c(v w)) c(v w) / (c(v) + 1)   if v w was seen in training,
           alpha(v) P(w)                   else, with alpha(v) = 1 for an unseen v,
P(w)     = d'(c(w)) c(w) / (N + 1)         if w was seen,
           what is left of the mass        for the class of all unknown words.

d and d' are Good-Turing discounts for counts up to 5. The virtual count in each denominator leaves every
context some mass, so alpha(v) = (1 - sum of P(w | v) over seen w) / (1 - sum of P(w) over the same w) is
positive and makes each distribution sum to one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store, table_path, text_of

K = 5
END = np.uint64(0x5E9D0FE0D5E9D0FE)
CHUNK_TOKENS = 5_000_000
BLOCK_TOKENS = 1_000_000
SLICE = 250_000
HOT_PART = 8
CACHE_WORDS = 500_000
BLOCK = "block int, chunk long, w2 binary, n2 binary, w1 binary, i1 binary, doc binary, train binary, ids binary, known binary, sizes binary"
COUNTS = [f"n{i}" for i in range(12)]
STATS = "kind int, key long, other long, x double, y double, " + ", ".join(f"{c} int" for c in COUNTS)
DOCS, CONTEXTS, UNSEEN, ROWS, TOTALS = range(1, 6)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, the letters A to Z in lower case."""
    return text.encode("utf-8", "replace").lower().split()


def block_of(w2: np.ndarray, w1: np.ndarray, hot: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each token: by its word, for a hot word by the word before it, too."""
    out = np.empty(len(w2), dtype=np.int32)
    for i in range(0, len(w2), SLICE):
        words = w2[i : i + SLICE]
        at = spread(words + np.uint64(1))
        if len(hot):
            common = hot[np.minimum(np.searchsorted(hot, words), len(hot) - 1)] == words
            at = np.where(common, spread(at ^ w1[i : i + SLICE]), at)
        out[i : i + SLICE] = at % np.uint64(blocks)
    return out


def spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_counts(docs: DataFrame, text: str, train: Column) -> DataFrame:
    """(h, n, trained): hash, tokens and training tokens of every word and of the end, over all texts."""

    def counted(held: list[np.ndarray], used: list[np.ndarray]) -> pd.DataFrame:
        h, at = np.unique(np.concatenate(held), return_inverse=True)
        flags = np.concatenate(used)
        return pd.DataFrame({"h": h.view(np.int64), "n": np.bincount(at, minlength=len(h)), "trained": np.bincount(at[flags], minlength=len(h))})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, held, flags, tokens = WordHashes(), [], [], 0
        for b in batches:
            for t, used in zip(b["text"], b["train"]):
                words = words_of(t)
                held.append(np.fromiter([*map(hashes.__getitem__, words), int(END)], dtype=np.uint64, count=len(words) + 1))
                flags.append(np.full(len(words) + 1, bool(used)))
                tokens += len(words) + 1
                if tokens >= BLOCK_TOKENS:
                    yield counted(held, flags)
                    held, flags, tokens = [], [], 0
        if held:
            yield counted(held, flags)

    picked = docs.select(text_of(text).alias("text"), train.alias("train")).mapInPandas(run, "h long, n long, trained long")
    return picked.groupBy("h").agg(F.sum("n").alias("n"), F.sum("trained").alias("trained"))


def hot_counts(docs: DataFrame, text: str, train: Column) -> tuple[dict[int, int], int, int]:
    """Training counts of the hot words by hash, all training tokens, and all tokens.

    Hot is each word with a `HOT_PART`th of a block of tokens, by exact counts: at most `HOT_PART` words a block.
    """
    counts = store(word_counts(docs, text, train), "word-counts")
    total = counts.agg(F.sum("trained").alias("trained"), F.sum("n").alias("n")).first()
    hot = counts.filter(F.col("n") * HOT_PART >= BLOCK_TOKENS).collect()
    return {r["h"]: r["trained"] for r in hot}, total["trained"] or 0, total["n"] or 0


def _narrow(x: np.ndarray) -> bytes:
    """Two or four bytes each, with the size in front."""
    return b"2" + x.astype("<u2").tobytes() if len(x) == 0 or x.max() < 2**16 else b"4" + x.astype("<u4").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u2" if data[:1] == b"2" else "<u4", offset=1).astype(np.int64)


def token_blocks(docs: DataFrame, text: str, key: str, train: Column, hot: list[int], blocks: int) -> DataFrame:
    """Bigram occurrences of all texts, a row per chunk of texts and block of words.

    Each token is in the block of its word; a hot word is dealt over all blocks by the word before it. Within
    a row, tokens are sorted by word: distinct words with run lengths, distinct words before and an index, and
    the text's number in the chunk. The chunk's texts themselves ride with one of its rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, part, chunks = WordHashes(), TaskContext.get().partitionId(), 0
        frequent = np.sort(np.array(hot, dtype=np.int64).view(np.uint64))
        held: list[tuple] = []
        tokens = 0
        for b in batches:
            for k, t, used in zip(b["key"].astype(object), b["text"], b["train"]):
                words = words_of(t)
                w = np.empty(len(words) + 1, dtype=np.uint64)
                w[:-1] = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
                w[-1] = END
                held.append((w, k, used))
                tokens += len(w)
                if tokens >= CHUNK_TOKENS:
                    yield from _chunk(held, (part << 20) + chunks, frequent, blocks)
                    held, tokens, chunks = [], 0, chunks + 1
        if held:
            yield from _chunk(held, (part << 20) + chunks, frequent, blocks)

    picked = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"), train.alias("train"))
    return picked.mapInPandas(run, BLOCK)


def _chunk(held: list[tuple], chunk: int, hot: np.ndarray, blocks: int) -> Iterator[pd.DataFrame]:
    """The rows of a chunk. `held` is emptied, and no more than one column is there twice at a time."""
    sizes = np.array([len(w) for w, _, _ in held])
    keys, used = [k for _, k, _ in held], [bool(u) for _, _, u in held]
    w2 = np.concatenate([w for w, _, _ in held])
    held.clear()
    w1 = np.empty_like(w2)
    w1[1:] = w2[:-1]  # a text begins after the end of the one before, and the first after an end as well
    w1[0] = END
    block = block_of(w2, w1, hot, blocks)
    order = np.lexsort((w2, block))
    bounds = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=blocks))])
    del block
    w2 = w2[order]
    w1 = w1[order]
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
    del order
    train = np.packbits(np.array(used)).tobytes()
    empty = pd.isna(pd.Series(keys, dtype=object)).to_numpy()
    ids = np.array([0 if e else int(k) for k, e in zip(keys, empty)], dtype="<i8").tobytes()
    for n in range(blocks):
        s = slice(bounds[n], bounds[n + 1])
        mine = n == chunk % blocks
        if s.start == s.stop and not mine:
            continue
        words, runs = np.unique(w2[s], return_counts=True)
        before, index = np.unique(w1[s], return_inverse=True)
        row = (n, chunk, words.tobytes(), _narrow(runs), before.tobytes(), _narrow(index), _narrow(doc[s]), train)
        row += (ids, np.packbits(~empty).tobytes(), _narrow(sizes)) if mine else (None, None, None)
        yield pd.DataFrame([row], columns=[c.split()[0] for c in BLOCK.split(", ")])


def _stats_of(hot: dict[int, int]):
    """Counts of one block: see the kinds in `collect_stats`."""
    names = np.array(sorted(np.array([*hot], dtype=np.int64).view(np.uint64).tolist()), dtype=np.uint64)
    known_counts = np.array([hot[int(h.view(np.int64))] for h in names], dtype=np.int64)

    def frame(kind: int, key=0, other=0, x=0.0, y=0.0, **counts) -> pd.DataFrame:
        out = pd.DataFrame({"key": key, "other": other, "x": x, "y": y, **counts}, index=None if np.ndim(key) else [0])
        for c in COUNTS:
            out[c] = np.asarray(out[c], dtype=np.int32) if c in out else np.int32(0)
        return out.assign(kind=kind)[["kind", "key", "other", "x", "y", *COUNTS]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each kind of rows goes out as it is there, the many unseen bigrams in slices.

        What is held goes by the block's tokens, not by the number of texts in the table.
        """
        parts = []
        for r in (r for g in batches for r in g.itertuples(index=False)):
            n = len(r.doc) // (2 if r.doc[:1] == b"2" else 4)
            w2 = np.repeat(np.frombuffer(r.w2, dtype=np.uint64), _wide(r.n2))
            w1 = np.frombuffer(r.w1, dtype=np.uint64)[_wide(r.i1)]
            d = _wide(r.doc)
            if r.ids is not None:
                ids = np.frombuffer(r.ids, dtype="<i8")
                train = np.unpackbits(np.frombuffer(r.train, dtype=np.uint8), count=len(ids))
                some = np.unpackbits(np.frombuffer(r.known, dtype=np.uint8), count=len(ids))
                yield frame(ROWS, (r.chunk << 24) + np.arange(len(ids)), ids, n0=1 - train.astype(int), n1=_wide(r.sizes), n2=1 - some.astype(int))
            used = np.unpackbits(np.frombuffer(r.train, dtype=np.uint8)).astype(bool)[d] if n else np.zeros(0, dtype=bool)
            parts.append((w2, w1, (r.chunk << 24) + d, used))
        w2, w1, d, used = (np.concatenate(x) for x in zip(*parts))
        del parts
        if not len(w2):
            return
        row_keys, d = np.unique(d, return_inverse=True)
        words, at2 = np.unique(w2, return_inverse=True)
        c2 = np.bincount(at2, weights=used, minlength=len(words)).astype(np.int64)
        hot_at = np.searchsorted(names, words)
        is_hot = np.zeros(len(words), dtype=bool)
        if len(names):
            is_hot = names[np.minimum(hot_at, len(names) - 1)] == words
            c2[is_hot] = known_counts[hot_at[is_hot]]
        _, one, at12 = np.unique(spread(w2 + np.uint64(1)) ^ spread(w1 * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)), return_index=True, return_inverse=True)
        c12 = np.bincount(at12, weights=used, minlength=len(one)).astype(np.int64)
        n1 = np.bincount(np.minimum(c2[~is_hot], K + 2), minlength=K + 3)
        n2 = np.bincount(np.minimum(c12, K + 2), minlength=K + 3)
        totals = {f"n{r}": int(n1[r]) for r in range(1, K + 2)} | {f"n{K + 1 + r}": int(n2[r]) for r in range(1, K + 1)} | {"n0": int(n2[K + 1])}
        yield frame(TOTALS, 0, int((c2[~is_hot] > 0).sum()), **totals)
        # Contexts: what their seen words have, in the model's two orders.
        seen = c12 > 0
        before, at1 = np.unique(w1[one[seen]], return_inverse=True)
        pair, low = c12[seen], c2[at2[one[seen]]]
        by = lambda weights: np.bincount(at1, weights=weights, minlength=len(before))
        counts = {f"n{r}": by(pair == r).astype(int) for r in range(1, K + 1)} | {f"n{K + 1 + r}": by(low == r).astype(int) for r in range(1, K + 1)}
        yield frame(CONTEXTS, before.view(np.int64), by(pair).astype(np.int64), by(np.where(low > K, low, 0)), **counts)
        del seen, before, at1, pair, low, counts, one
        # Texts: sums of logarithms, and how many tokens have which small count.
        e12, e2 = c12[at12], c2[at2]
        is_seen = e12 > 0
        per = lambda weights: np.bincount(d, weights=weights, minlength=len(row_keys))
        logs = np.where(is_seen, np.log10(np.maximum(e12, 1)) * (e12 > K), np.log10(np.maximum(e2, 1)) * (e2 > K))
        counts = {"n0": per(e2 > 0).astype(int)} | {f"n{r}": per(e12 == r).astype(int) for r in range(1, K + 1)}
        counts |= {f"n{K + 1 + r}": per(~is_seen & (e2 == r)).astype(int) for r in range(K + 1)}
        yield frame(DOCS, row_keys, per(~is_seen & (e2 > K)).astype(np.int64), per(np.log10(e2 + 1)), per(logs), **counts)
        del counts, logs, e12, e2, at12, at2
        new = np.flatnonzero(~is_seen)
        for i in range(0, len(new), SLICE):
            some = new[i : i + SLICE]
            yield frame(UNSEEN, w1[some].view(np.int64), row_keys[d[some]])

    return run


def discounts(n: list[int]) -> list[float]:
    """Good-Turing discounts of the counts 1 to K from the numbers n[r] of types with count r, r to K + 1.

    A discount that the numbers don't support (none of a count, or outside 0 to 1) is 1: no discount.
    """
    out = [1.0] * (K + 1)
    if not n[1]:
        return out
    tail = (K + 1) * n[K + 1] / n[1]
    for r in range(1, K + 1):
        if n[r] and tail < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail)
            if 0 < d <= 1:
                out[r] = d
    return out


def score(docs: DataFrame, train: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row, the model learnt where `train`.

    Texts are whole; tokens are words in lower case and one end, which is also the first token's context. A
    NULL or empty text is its end alone. A NULL `train` is held out; NULL and repeated keys are rows each.
    Words stand for 64-bit hashes. An empty table gives no rows.
    The counts (a block of words per task) and the context weights are stored in tables of the shared folder.
    """
    train = F.coalesce(train, F.lit(False))
    hot_count, n_train, n_all = hot_counts(docs, text, train)
    hot = [*hot_count]
    blocks = n_all // BLOCK_TOKENS + 1
    spark = docs.sparkSession
    dealt = token_blocks(docs, text, key, train, hot, blocks).repartition(blocks, "block")
    path = table_path(spark, "katz")
    # No folders by kind: Spark would sort all rows of a task by it. Rows of a kind lie together as they come.
    dealt.groupBy("block").applyInPandas(_stats_of(hot_count), STATS).write.parquet(path)
    stats = spark.read.schema(STATS).parquet(path)
    kind = lambda k: stats.filter(F.col("kind") == k)

    sums = kind(TOTALS).agg(F.sum("other"), *[F.sum(c) for c in COUNTS]).first()
    vocabulary, *n = [int(x or 0) for x in sums]
    vocabulary += sum(c > 0 for c in hot_count.values())
    ones = [0, *n[1 : K + 2]]
    for c in hot_count.values():
        if 0 < c <= K + 1:
            ones[c] += 1
    d1 = discounts(ones)
    d2 = discounts([0, *n[K + 2 :], n[0]])
    # What the discounts of known words and the virtual count leave to the unknown.
    unknown = (1 + sum((1 - d1[r]) * r * ones[r] for r in range(1, K + 1))) / (n_train + 1)

    count = lambda i: F.col(f"n{i}").cast("double")
    high = F.col("other") + sum((d2[r] - 1) * r * count(r) for r in range(1, K + 1))
    low = F.col("x") + sum(d1[r] * r * count(K + 1 + r) for r in range(1, K + 1))
    contexts = kind(CONTEXTS).select("key", "other", high.alias("high"), low.alias("low")).groupBy("key")
    contexts = contexts.agg(F.sum("other").alias("c"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    left = (1 - F.col("high") / (F.col("c") + 1)) / (1 - F.col("low") / (n_train + 1.0))
    contexts = store(contexts.select("key", F.log10(left * (F.col("c") + 1)).alias("weight")), "katz-contexts")
    backed = kind(UNSEEN).select(F.col("key").alias("w"), F.col("other").alias("row")).join(
        contexts.withColumnRenamed("key", "w"), "w", "left"
    ).groupBy("row").agg(F.sum(F.coalesce("weight", F.lit(0.0))).alias("weights"))

    log = lambda x: F.lit(float(np.log10(x)))
    value = F.col("y") + sum(count(r) * log(d2[r] * r) for r in range(1, K + 1))
    value += count(K + 1) * log(unknown) + sum(count(K + 1 + r) * log(d1[r] * r) for r in range(1, K + 1))
    value -= (F.col("other") + sum(count(K + 1 + r) for r in range(1, K + 1))) * log(n_train + 1)
    texts = kind(DOCS).select(F.col("key").alias("row"), F.col("x"), "n0", value.alias("value"))
    texts = texts.groupBy("row").agg(F.sum("x").alias("base"), F.sum("n0").alias("known"), F.sum("value").alias("value"))
    rows = kind(ROWS).select(F.col("key").alias("row"), "other", "n0", "n1", "n2")
    joined = rows.join(texts, "row").join(backed, "row", "left")
    return joined.select(
        F.when(F.col("n2") == 0, F.col("other")).alias("key"),
        (F.col("n0") == 1).alias("held_out"),
        F.col("n1").cast("long").alias("n_tokens"),
        F.col("known").cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n1") * log(n_train + vocabulary + 1)).alias("base_score"),
        (F.col("value") - F.col("base") + F.coalesce("weights", F.lit(0.0))).alias("score"),
    )
