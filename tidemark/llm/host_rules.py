"""Quality rules with host verdicts, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, let, store, text_of, word_list

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
HOST_LIMIT = 0.5
SYMBOLS = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five that occur twice or more in the array."""
    hashes = F.when(
        F.size(words) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def positions(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column, j: Column) -> Column:
            same = lambda k: F.coalesce(F.get(s, k)["h"] == F.get(s, j)["h"], F.lit(False))
            return same(j - 1) | same(j + 1)

        found = lambda s: F.filter(F.transform(s, lambda x, j: F.when(twice(s, j), x["i"])), lambda x: x.isNotNull())
        return F.sort_array(let(pairs, found))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, x: F.struct(
            x.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).cast("long").alias("n")
        )
        return F.aggregate(at, start, step, lambda acc: acc["n"])

    def count(h: Column) -> Column:
        # Most texts repeat no window; the sort is for the others.
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(positions(h)))

    return let(hashes, count)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, SPACE, "") != "")
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of `docs` with the five counts and `base_failed`.

    A NULL text counts as empty: no words, which fails. Windows are compared by a 64-bit hash of their words
    within one text. Columns of `docs` named like the added ones are replaced.
    """
    source = text_of(text)
    counts = let(
        word_list(source),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )
    out = docs.drop(*(c for c in (*MEASURES, "base_failed", "_counts") if c != text)).withColumn("_counts", counts)
    out = out.withColumns(
        {
            "n_words": F.col("_counts.n_words"),
            "word_chars": F.col("_counts.word_chars"),
            "n_symbols": F.regexp_count(source, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": _dup_lines(source),
            "n_repeat_words": F.col("_counts.n_repeat_words"),
        }
    ).drop("_counts")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def host_verdicts(measured: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: `host_docs`, `host_failed`, the shrunk failure rate `host_rate` and `host_ok`.

    The prior is a beta distribution with the mean and variance of the hosts' rates (weights of 1 to 10^6;
    without variance the largest), so a host with few documents stays near the average and one with many near
    its own rate. A host is refused if its shrunk rate is above `limit`. NULL is a host of its own.
    """
    hosts = measured.groupBy(F.col(host).alias("_host")).agg(
        F.count(F.lit(1)).alias("host_docs"), F.count_if(F.col("base_failed")).alias("host_failed")
    )
    hosts = store(hosts, "hosts")
    rate = F.col("host_failed") / F.col("host_docs")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, weight = mean or 0.0, (mean * (1 - mean) / var - 1 if var else 1e6)
    weight = max(1.0, min(1e6, weight))
    shrunk = (F.col("host_failed") + F.lit(mean * weight)) / (F.col("host_docs") + F.lit(weight))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_ok", F.col("host_rate") <= limit)


def judge(measured: DataFrame, hosts: DataFrame, host: str = "source") -> DataFrame:
    """Join the verdicts back: adds `host_docs`, `host_failed`, `host_rate`, `host_ok` and `kept`."""
    measured = measured.drop("_host", "host_docs", "host_failed", "host_rate", "host_ok", "kept")
    joined = measured.join(hosts, measured[host].eqNullSafe(hosts["_host"])).drop("_host")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_ok"))
