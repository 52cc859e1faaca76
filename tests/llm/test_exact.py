from __future__ import annotations

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact


def brute(rows):
    """Groups of (doc_id, text) rows by normalised text: (size, the key that stays, digest)."""
    groups = collections.defaultdict(list)
    for key, text in rows:
        plain = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups[hashlib.sha256(plain.encode()).digest()].append(key)
    return {d: (len(ks), min(ks, key=lambda k: (k is None, k or 0))) for d, ks in groups.items()}


def hold(found, rows):
    expected, seen = brute(rows), collections.Counter()
    assert len(found) == len(rows)
    for r in found:
        size, keep = expected[bytes(r.digest)]
        assert (r.group_size, r.keep) == (size, keep)
        if r.kept:
            assert r.key == keep
            seen[bytes(r.digest)] += 1
    assert seen == {d: 1 for d in expected}


@pytest.mark.parametrize("bits, probes, broadcast, hot", [(16, 4, 64 << 20, 1000), (0.001, 1, 64 << 20, 2), (4096, 4, 0, 1)])
def test_one_row_of_each_text_stays_whatever_the_filter(awkward, monkeypatch, bits, probes, broadcast, hot):
    monkeypatch.setattr(exact, "BITS_PER_ROW", bits)
    monkeypatch.setattr(exact, "PROBES", probes)
    monkeypatch.setattr(exact, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(exact, "HOT_PARTS", hot)
    monkeypatch.setattr(exact, "blocks_for", lambda rows: max(1, int(rows * bits) // exact.BLOCK_BITS))
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    hold(exact.find_copies(awkward).collect(), rows)


def test_white_space_runs_are_equal_and_case_is_not(spark):
    rows = [(3, "a  b"), (1, "a\t\n b"), (2, "A b"), (4, " a b"), (5, "a b"), (6, "a b"), (7, ""), (8, None), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.key: (r.keep, r.group_size, r.kept) for r in exact.find_copies(docs).collect()}
    assert got[3] == (1, 3, False) and got[1] == (1, 3, True) and got[5] == (1, 3, False)
    assert all(got[k] == (k, 1, True) for k in (2, 4, 6, 9))
    assert got[7] == (7, 2, True) and got[8] == (7, 2, False)


def test_a_text_with_a_third_of_all_rows(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "the same").otherwise(F.concat(F.lit("text "), "id")).alias("text")
    )
    hold(exact.find_copies(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_rows_that_stay_keep_all_columns(spark, awkward, nothing):
    clash = awkward.withColumn("digest", F.lit("d")).withColumn("block", F.lit(1)).withColumn("maybe", F.lit(2)).withColumn("row", F.lit(3))
    kept = exact.drop_copies(clash)
    assert kept.columns == clash.columns
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(keep) for _, keep in brute(rows).values())
    assert exact.drop_copies(nothing).count() == 0 and exact.find_copies(nothing).count() == 0
    assert exact.find_copies(clash).count() == clash.count()


def test_only_possible_copies_are_shuffled(awkward):
    plan = exact.find_copies(awkward)._jdf.queryExecution().executedPlan().toString()
    passing = plan.split("Union")[1].split(":- Project")[1]
    assert "Exchange hash" not in passing
