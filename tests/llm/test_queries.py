"""Queries against SQL where SQL can express them, and against plain Python on the smallest tables where not."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from check import compare, connect
from tests.llm.brute import repeated_characters
from tidemark.llm import katz
from tidemark.llm.queries import QUERIES, TOKENIZER
from tidemark.llm.sql import SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(some):
    return {r.doc_id: r.text or "" for r in some.collect()}


def rows_of(spark, name, sf, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, sf).collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf, name):
    ok, note = compare(spark, connect(sf), name, sf, SQL[name])
    assert ok, note


def test_katz_agrees_with_plain_counts(spark, sf, texts, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 20_000)  # several blocks, with hot words over all of them
    got = rows_of(spark, "op1_katz_backoff", sf)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {k: [*WORD.findall(t.translate(lower)), None] for k, t in texts.items()}
    train = [k for k in texts if zlib.crc32(str(k).encode()) % 7 != 2]
    one, two = collections.Counter(), collections.Counter()
    for k in train:
        one.update(tokens[k])
        two.update(zip([None, *tokens[k]], tokens[k]))
    total, kinds = sum(one.values()), len(one)
    types = [collections.Counter(c.values()) for c in (one, two)]
    d1, d2 = (katz.discounts([n[i] for i in range(katz.K + 2)]) for n in types)
    p1 = {w: (d1[c] if c <= katz.K else 1) * c / (total + 1) for w, c in one.items()}
    unknown = 1 - sum(p1.values())
    after = collections.defaultdict(dict)
    for (v, w), c in two.items():
        after[v][w] = c
    p2 = {v: {w: (d2[c] if c <= katz.K else 1) * c / (sum(ws.values()) + 1) for w, c in ws.items()} for v, ws in after.items()}
    alpha = {v: (1 - sum(ws.values())) / (1 - sum(p1[w] for w in ws)) for v, ws in p2.items()}
    assert min(alpha.values()) > 0 and len(got) == len(texts)
    for k, ts in tokens.items():
        score = sum(
            math.log10(p2[v][w] if w in p2.get(v, ()) else alpha.get(v, 1.0) * p1.get(w, unknown)) for v, w in zip([None, *ts], ts)
        )
        base = sum(math.log10((one[w] + 1) / (total + kinds + 1)) for w in ts)
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (k not in train, len(ts), sum(w in one for w in ts), total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_neighbours_are_found(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in vectors])
    x = np.array([r.embedding for r in vectors], dtype=float)
    got = collections.defaultdict(list)
    for r in QUERIES["op2_multiprobe_neighbours"](spark, sf).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        near = x @ x[i]
        near[i] = -np.inf
        best = ids[np.lexsort((ids, -near))[:20]]
        found = got[ids[i]]
        assert [r.rank for r in found] == list(range(1, len(found) + 1))
        assert sorted(found, key=lambda r: (-r.score, r.vec_id)) == found
        hits += len({r.vec_id for r in found} & set(best.tolist()))
        total += len(best)
    assert hits / total >= 0.9


def test_packed_sequences_hold_every_token_once(spark, sf, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    places, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in QUERIES["op3_pattern_packing"](spark, sf).collect():
        places[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    tokens = 0
    for k, t in texts.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        tokens += len(ids)
        rows = sorted(by_doc[k], key=lambda r: r.piece)
        assert [r.start for r in rows] == list(range(0, len(ids), 2048))
        for r in rows:
            part = ids[r.start : r.start + 2048]
            assert (r.length, r.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    assert len(places) <= -(-tokens // 2048) * 1.02 + 1


def test_earliest_passage_stays(spark, sf, texts):
    got = rows_of(spark, "op4_passage_dedup", sf)
    want = repeated_characters(texts)
    assert sum(map(len, want.values())) > 1000
    for k, t in texts.items():
        spans = {i for s in got[k].removed for i in range(s.start, s.stop)}
        assert want[k] <= spans and all(t[i].isspace() for i in spans - want[k])
        assert got[k].text == "".join(c for i, c in enumerate(t) if i not in spans) and got[k].n_removed == len(spans)


def test_quality_is_learnt(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op5_compression_classifier"](spark, sf).collect()]
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert sum(p == q for p, q in held) >= 0.9 * len(held)


def test_licenses_are_found(spark, sf, texts):
    got = {(r.doc_id, r.license) for r in QUERIES["op7_license_scan"](spark, sf).collect()}
    lines = {
        "mit-notice": "Released under the MIT License.", "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
        "gpl-3-notice": "licensed under the GNU General Public License, version 3", "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    }
    assert got == {(k, name) for k, t in texts.items() for name, line in lines.items() if line in t}


def brute_links(texts: dict) -> tuple[dict, dict]:
    sets = {}
    for k, t in texts.items():
        w = WORD.findall(t.lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links, up = collections.Counter(), {k: k for k in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return links, {k: root(k) for k in keys}


def test_similar_texts_are_linked(spark, sf, texts):
    got = rows_of(spark, "op8_jaccard_join", sf)
    links, classes = brute_links(texts)
    assert {k: (r.class_id, r.n_links) for k, r in got.items()} == {k: (classes[k], links[k]) for k in texts}


def brute_bytes(texts: dict, n: int) -> dict:
    seen = collections.Counter(t[i : i + n] for t in texts.values() for i in range(len(t) - n + 1))
    out = {}
    for k, t in texts.items():
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - n + 1):
            if seen[t[i : i + n]] > 1:
                gone[i : i + n] = True
        gone = gone[:-1]
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out[k] = (len(t), int(gone.sum()), int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_repeated_bytes_go(spark, sf, texts):
    got = rows_of(spark, "op10_maximal_repeats", sf)
    want = brute_bytes({k: t.encode() for k, t in texts.items()}, 400)
    assert {k: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for k, r in got.items()} == want


def test_pipeline_stages(spark, sf, some):
    docs, columns = some, some.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf).cache()
        assert docs.columns == columns, name
        counts.append(docs.count())
        if name == "repeated passages":
            left, cut = ({r.doc_id: r.text or "" for r in x.collect()} for x in (before, docs))
            gone = repeated_characters(left)
            bare = lambda t: "".join(t.split())
            assert {k: bare(t) for k, t in cut.items()} == {k: bare("".join(c for i, c in enumerate(t) if i not in gone[k])) for k, t in left.items()}
    assert counts[0] > counts[1] > counts[2] == counts[3]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
    again = corpus_pipeline.run(spark, sf)
    digest = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert digest(again) == digest(last)
