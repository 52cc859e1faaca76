"""License scans in DataFrame expressions only: windows, MinHash bands against templates, exact containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import let, text_of, unused

SHINGLE = 5
BANDS = 32
CONTAINMENT = 0.8

#: Public notices of common licenses, five words or more.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "mit-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
    ),
    "gpl-3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}


def shingle_hashes(text: Column) -> Column:
    """Hashes of all runs of five words, in order: lower case, punctuation removed, split at white space."""
    plain = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\s]+", "")
    words = F.filter(F.split(plain, r"\s+"), lambda w: w != "")
    return let(
        words,
        lambda w: F.when(
            F.size(w) >= SHINGLE,
            F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])),
        ).otherwise(F.array().cast("array<bigint>")),
    )


def signature(shingles: Column) -> Column:
    """One minimum per band of one row each."""
    bands = F.sequence(F.lit(0), F.lit(BANDS - 1))
    return F.transform(bands, lambda b: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, b))))


def templates(spark: SparkSession, texts: dict[str, str] = TEMPLATES) -> DataFrame:
    """(license, shingles, grams): a table whose size is that of the given texts; shorter ones than five words are refused."""
    frame = spark.createDataFrame([*texts.items()], "license string, _text string")
    found = frame.select("license", shingle_hashes(F.col("_text")).alias("_all"))
    found = found.select("license", F.size("_all").alias("grams"), F.array_distinct("_all").alias("shingles"))
    if found.filter("grams = 0").count():
        raise ValueError(f"a template needs {SHINGLE} words")
    return found


def scan(docs: DataFrame, texts: dict[str, str] = TEMPLATES, text: str = "text", key: str = "doc_id", containment: float = CONTAINMENT) -> DataFrame:
    """(key, license, containment, first_shingle) for each text and template with enough of the template in one window.

    For templates of n shingles, windows have 2 n shingles and start at every s-th, s = n / 2 rounded up, so a template
    always lies in one window, also where up to n / 2 words are inserted. At `containment` 0.8 their Jaccard
    similarity is above 0.36, and 32 bands of one row miss such a window with a probability below 10^-6. Only windows
    that hold a shingle of a template are signed: others cannot share a minimum with one. What the bands
    retrieve is kept if the window has the given share of the template's distinct shingles, by exact sets.

    NULL, empty and short texts match nothing, and a text without match gives no row. Rows that repeat a key
    are one document: the best containment and its earliest place count. Rows without a key are documents of their own.
    """
    spark = docs.sparkSession
    known = templates(spark, texts)
    rows = known.collect()  # the given templates, a handful
    classes = {}
    for r in rows:
        classes.setdefault(r["grams"], set()).update(r["shingles"])
    lookup = sorted(set().union(*classes.values()))
    kinds = F.array(*[
        F.struct(
            F.lit(n).alias("grams"), F.lit(-(-n // 2)).alias("step"), F.array(*[F.lit(h) for h in sorted(hs)]).alias("own")
        )
        for n, hs in sorted(classes.items())
    ])
    all_, at = unused(docs, "_all", "_at")
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id()).alias("own_row")
    found = docs.select(F.col(key).alias("key"), own, shingle_hashes(text_of(text)).alias(all_))
    hits = F.filter(F.transform(all_, lambda h, i: F.when(h.isin(lookup), i)), lambda i: i.isNotNull())
    found = found.withColumn(at, hits).filter(F.size(at) > 0).withColumn("_kind", F.explode(kinds))
    step, width = F.col("_kind.step"), 2 * F.col("_kind.grams")
    starts = F.transform(at, lambda i: F.sequence(F.greatest(F.lit(0), F.ceil((i - width + 1) / step)).cast("int"), F.floor(i / step).cast("int")))
    windows = found.withColumn("_w", F.explode(F.array_distinct(F.flatten(starts))))
    windows = windows.select("key", "own_row", F.col("_kind.grams").alias("grams"), (F.col("_w") * step).alias("start"), F.col("_kind.own").alias("own"),
        F.slice(all_, F.col("_w") * step + 1, width).alias("window"))
    windows = windows.filter(F.arrays_overlap("window", "own")).drop("own")
    signed = windows.select("*", F.posexplode(signature(F.col("window"))).alias("band", "least"))
    bands = known.select("license", "grams", "shingles", F.posexplode(signature(F.col("shingles"))).alias("band", "least"))
    met = signed.join(F.broadcast(bands), ["grams", "band", "least"])
    share = F.size(F.array_intersect("window", "shingles")) / F.size("shingles")
    kept = met.select("key", "own_row", "license", "start", share.alias("containment")).filter(F.col("containment") >= containment)
    best = F.min(F.struct(-F.col("containment"), F.col("start"))).alias("best")
    return kept.groupBy("key", "own_row", "license").agg(best).select(
        "key", "license", (-F.col("best.col1")).alias("containment"), F.col("best.start").alias("first_shingle")
    )
