"""Mixing sources to target weights: repetition rates per source, whole copies plus one seeded coin per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, store, text_of, unused, word_count

CYCLE = (1, 2, 3)
MOST = 3.0


def coin(key: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that only depends on the key, the text and the seed: 52 bits of an MD5 digest.

    The text is part of it so that documents that share a key, or have none, decide one by one.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("null")), F.md5(text)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def source_sizes(sized: DataFrame, source: str, size: str) -> DataFrame:
    """One row per source: `source_size`. Sums form in the map tasks, so a hot source is no hot task."""
    return sized.groupBy(source).agg(F.sum(size).cast("long").alias("source_size"))


def cyclic_weights(sources: DataFrame, source: str, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Add `weight`: the cycle's values in turn along the sources in code-point order, NULL last."""
    values = F.array(*[F.lit(float(w)) for w in cycle])
    place = ranked(sources, F.col(source).asc_nulls_last(), "_place")
    return place.withColumn("weight", F.get(values, (F.col("_place") % len(cycle)).cast("int"))).drop("_place")


def targets(weighted: DataFrame, most: float = MOST) -> DataFrame:
    """Add `target`: shares of the total by weight, at most `most` times the source's size.

    What a capped source cannot take is shared again among the others by weight until none is above its cap:
    then every open source has level * weight, with one level for all. Each pass recomputes the level from
    one row of sums and can only cap more sources. `weighted` has one row per source and should be stored.
    """
    total = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    level, capped = (float(total[0]) / total[1] if total[1] else 0.0), -1
    cap = most * F.col("source_size")
    while True:
        over = cap <= F.lit(level) * F.col("weight")
        n, size, weight = weighted.agg(
            F.count_if(over), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if n == capped or not weight:
            break
        capped, level = n, (float(total[0]) - (size or 0.0)) / weight
    return weighted.withColumn("target", F.when(cap <= F.lit(level) * F.col("weight"), cap).otherwise(F.lit(level) * F.col("weight")))


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: DataFrame | None = None,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """All rows and columns of `docs` with `size`, `source_size`, `target` and `copies`.

    A source's rate is target / size; a document gets floor(rate) copies and one more with the probability of
    the rest, decided by its key and text, so reruns agree; only rows that are equal in both decide alike. `weights` is
    (source, weight), by default the cycle 1, 2, 3. A NULL or empty text has size 0 and counts for nothing; a
    source without words has target 0 and gets no copies; a NULL source is one source; a NULL key is
    the string "null" in the decision. Columns of `docs` named like the added ones are replaced.
    """
    docs = docs.drop(*(c for c in ("_source", "weight", "size", "source_size", "target", "copies") if c not in (text, source, key)))
    sized = docs.withColumn("size", word_count(text_of(text)))
    sources = source_sizes(sized.select(F.col(source).alias("_source"), "size"), "_source", "size")
    if weights is None:
        sources = cyclic_weights(sources, "_source")
    else:
        given = weights.select(F.col("source").alias("_given"), F.col("weight").cast("double"))
        sources = sources.join(given, F.col("_source").eqNullSafe(F.col("_given")), "left").drop("_given")
        sources = sources.fillna({"weight": 0.0})
    planned = targets(store(sources, "mix-sources"), most).drop("weight")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + (coin(F.col(key), text_of(text), seed) < rate - F.floor(rate)).cast("long")
    joined = sized.join(planned, sized[source].eqNullSafe(planned["_source"])).drop("_source")
    return joined.withColumn("copies", copies.cast("long"))


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as `copies` says."""
    (n,) = unused(mixed, "_n")
    repeated = mixed.filter(F.col("copies") > 0).withColumn(n, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*columns)
