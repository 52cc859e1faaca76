"""Compression classifier: zstandard dictionaries of good and bad text, and a calibrated size difference."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

PIECE_BYTES = 4096
DICT_BYTES = 112 * 1024
LEVEL = 3
THRESHOLD = 0.7


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def pieces(text: str) -> list[bytes]:
    data = text.encode("utf-8", "replace")
    return [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


def _compressors(good: bytes, bad: bytes) -> list[zstandard.ZstdCompressor]:
    small = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    dicts = [zstandard.ZstdCompressionDict(d) for d in (good, bad)]
    for d in dicts:
        d.precompute_compress(level=LEVEL)
    return [zstandard.ZstdCompressor(level=LEVEL, dict_data=d, **small) for d in dicts] + [zstandard.ZstdCompressor(level=LEVEL, **small)]


def sizes(texts: pd.Series, compressors: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Per text: bytes, compressed bytes with the good, the bad and no dictionary, over all of its pieces."""
    out = np.zeros((len(texts), 4))
    for i, text in enumerate(texts):
        for piece in pieces(text):
            out[i] += (len(piece), *(len(c.compress(piece)) for c in compressors))
    return out


def features(s: np.ndarray) -> np.ndarray:
    """Normalised size difference, bytes left without and with a dictionary as shares, length; squares and products."""
    diff = 10 * (s[:, 2] - s[:, 1]) / np.maximum(s[:, 1] + s[:, 2], 1)
    alone, best = s[:, 3] / np.maximum(s[:, 0], 1), np.minimum(s[:, 1], s[:, 2]) / np.maximum(s[:, 0], 1)
    short = 100 / (s[:, 0] + 100)
    base = [diff, alone, best, short]
    return np.column_stack([np.ones(len(s)), *base, *(a * b for i, a in enumerate(base) for b in base[i:])])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    keep = ridge * np.eye(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + keep
        step = np.linalg.solve(h, x.T @ (p - y) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def sample_labels(labels: DataFrame, key: str, label: str, per_class: int) -> DataFrame:
    """At most `per_class` labelled keys of either class, those with the smallest digest: a bounded table.

    NULL keys and labels other than 0 and 1 take no part.
    """
    order = F.md5(F.concat(F.lit("label:"), F.col("_key").cast("string")))
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).filter(F.col("_key").isNotNull())
    picked = [known.filter(F.col("_label") == v).withColumn("_order", order).orderBy("_order").limit(per_class) for v in (0, 1)]
    return picked[0].unionByName(picked[1])


def fit(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
    per_class: int = 4000, pieces_per_class: int = 2000,
) -> Model:
    """Learn from at most `per_class` labelled rows of either class (the bound of the sample).

    Half of them give the dictionaries, from at most `pieces_per_class` pieces of 4 KiB each; the scores of
    the other half calibrate. Only those pieces, and two numbers per calibration row, reach the driver.
    """
    sample = sample_labels(labels, key, label, per_class)
    known = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text")).join(F.broadcast(sample), "_key")
    half = F.substring("_order", 32, 1) < "8"
    data = F.encode(F.col("_text"), "utf-8")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.octet_length("_text")), F.lit(PIECE_BYTES))
    cut = known.filter(half).select("_label", "_order", F.posexplode(starts).alias("_i", "_at"), data.alias("_data"))
    cut = cut.select("_label", F.md5(F.concat("_order", F.col("_i").cast("string"))).alias("_o"), F.expr(f"substring(_data, _at, {PIECE_BYTES})").alias("_piece"))
    dicts = []
    for value in (1, 0):
        rows = cut.filter(F.col("_label") == value).orderBy("_o").limit(pieces_per_class).collect()
        found = [bytes(r["_piece"]) for r in rows if r["_piece"]]
        dicts.append(_dictionary(found))
    good, bad = dicts
    measured = _measured(known.filter(~half).select(F.col("_label").cast("double").alias("_label"), "_text"), good, bad)
    rows = np.array([tuple(r) for r in measured.orderBy(*measured.columns).collect()], dtype=float).reshape(-1, 5)
    if len({*rows[:, 0]}) < 2:  # one class or none: only its share can be learnt
        share = (rows[:, 0].sum() + 1) / (len(rows) + 2)
        return Model(good, bad, (float(np.log(share / (1 - share))), *[0.0] * (features(np.zeros((1, 4))).shape[1] - 1)))
    return Model(good, bad, tuple(logistic(features(rows[:, 1:]), rows[:, 0]).tolist()))


def _dictionary(found: list[bytes]) -> bytes:
    """A trained dictionary; with too little text for training, the text itself serves as one."""
    try:
        return zstandard.train_dictionary(DICT_BYTES, found).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(found)[-DICT_BYTES:] or b"-" * 8


def _measured(rows: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressors = _compressors(good, bad)
        for b in batches:
            s = sizes(b["_text"], compressors)
            yield pd.DataFrame({"_label": b["_label"], "bytes": s[:, 0], "good": s[:, 1], "bad": s[:, 2], "alone": s[:, 3]})

    return rows.mapInPandas(run, "_label double, bytes double, good double, bad double, alone double")


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of `docs` with `score` and `predicted`; every whole text is compressed, piece by piece.

    A NULL or empty text scores 0. Columns of `docs` named like the added ones are replaced.
    """
    good, bad, weights = model.good, model.bad, np.array(model.weights)

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = _compressors(good, bad)
        for texts in batches:
            s = sizes(texts, compressors)
            p = 1 / (1 + np.exp(-np.clip(features(s) @ weights, -30, 30)))
            yield pd.Series(np.where(s[:, 0] > 0, p, 0.0))

    out = docs.drop(*(c for c in ("score", "predicted") if c != text)).withColumn("score", rate(text_of(text)))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
