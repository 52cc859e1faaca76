"""NULLs, empty and long texts, ties, repeated rows, empty tables, clashing columns; hot groups split exactly."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.brute import WORD, repeated_characters
from tests.llm.conftest import LEXICON, prose
from tests.llm.test_queries import brute_bytes, brute_links
from tidemark.llm import collocations, compression, exact, host_rules, jaccard, katz, licenses, mixing, multiprobe, packing, passages, repeats
from tidemark.llm.common import store
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES, TOKENIZER, crc_mod

CLASHES = ("size", "kept", "removed", "score", "n_words", "copies", "spans", "_spans", "key", "version", "_version", "_tid", "class_id", "_counts", "tid")


def clashing(docs):
    """The same rows with extra columns named like what operators add or use inside."""
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])


OPERATORS = {
    "katz": lambda d: katz.score(d, crc_mod(7) != 2),
    "packing": lambda d: packing.pack_documents(d, TOKENIZER),
    "passages": passages.remove_repeats,
    "compression": lambda d: compression.score(d, compression.fit(d, d.select("doc_id", (F.col("doc_id") % 2).alias("quality")))),
    "host_rules": lambda d: host_rules.judge(host_rules.measure(d), host_rules.host_verdicts(host_rules.measure(d))),
    "licenses": licenses.scan,
    "jaccard": jaccard.near_duplicates,
    "survivors": jaccard.survivors,
    "mixing": mixing.mix,
    "repeats": repeats.remove_repeated_bytes,
    "groups": repeats.maximal_repeats,
    "exact": exact.find_copies,
    "exact rows": exact.drop_copies,
    "collocations": lambda d: collocations.collocations(d, min_count=2, top=20),
}
PER_ROW = ("katz", "passages", "compression", "host_rules", "jaccard", "mixing", "repeats", "exact")


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables_give_no_rows(nothing, name):
    assert OPERATORS[name](nothing).count() == 0


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_and_clashing_columns(awkward, name):
    plain = OPERATORS[name](awkward)
    if name in PER_ROW:
        assert plain.count() == awkward.count()
    busy = OPERATORS[name](clashing(awkward))
    common = [c for c in plain.columns if c in busy.columns and c not in ("sequence_id", "offset")]
    text = lambda df: sorted(map(str, df.select(*common).collect()))
    assert text(plain) == text(busy)


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_awkward_and_empty_tables(spark, awkward, nothing, stage):
    run = corpus_pipeline.STAGES[stage][1]
    assert run(spark, nothing, "").count() == 0
    out = run(spark, clashing(awkward), "")
    if stage < 4:
        assert out.columns == clashing(awkward).columns
        assert out.filter(F.col("size") != "x").count() == 0
    assert out.count() > 0


def test_blank_texts(awkward):
    blank = "text is null or trim(translate(text, '\t\n', '  ')) = ''"
    ids = {r.doc_id for r in awkward.filter(blank).collect()}
    rows = [r for r in katz.score(awkward, F.lit(True)).collect() if r.key in ids - {None}]
    assert [r.n_tokens for r in rows] == [1] * len(rows) and len(rows) == 3
    assert [r.n_links for r in jaccard.near_duplicates(awkward).collect() if r.key in ids - {None}] == [0, 0, 0]
    assert not any(r.kept for r in OPERATORS["host_rules"](awkward).filter(blank).collect())
    assert {r.size for r in mixing.mix(awkward).filter(blank).collect()} == {0}
    assert {r.score for r in OPERATORS["compression"](awkward).filter("text is null or text = ''").collect()} == {0.0}


def test_copies_and_near_copies(awkward):
    got = {r.key: r for r in jaccard.near_duplicates(awkward.filter("doc_id <= 3 or doc_id = 15")).collect()}
    assert {k: (r.class_id, r.n_links, r.n_texts) for k, r in got.items()} == {1: (1, 4, 1), 2: (1, 4, 1), 3: (1, 4, 1), 15: (1, 4, 1)}
    kept = sorted(r.doc_id for r in jaccard.survivors(awkward.filter("doc_id <= 3 or doc_id >= 14")).collect())
    assert kept == [1, 14, 14]


def test_passage_inside_another_sentence(awkward):
    out = {r.doc_id: r for r in passages.remove_repeats(awkward.filter("doc_id in (8, 9)")).collect()}
    assert out[8].n_removed == 0
    whole = {r.doc_id: r.text for r in awkward.filter("doc_id in (8, 9)").collect()}
    shared = whole[9].split(" and then ")[1].split("\n")[0]
    assert out[9].n_removed > 0.8 * len(shared)


def test_rows_that_share_a_key_meet_only_their_own_sets(spark, monkeypatch):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join([*words, f"x{i}"]) for i in range(60)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(7, t) for t in texts[:5]], "doc_id long, text string")
    frames, whole = [], jaccard._sets

    def watched(*args):
        frames.append(whole(*args))
        return frames[-1]

    monkeypatch.setattr(jaccard, "_sets", watched)
    got = jaccard.near_duplicates(docs).collect()
    assert frames[0].count() == 60  # not 60 times 60
    assert {r.class_id for r in got} == {7} and {r.n_texts for r in got} == {59} and {r.n_links for r in got} == {64}


def test_large_blocks_are_split_exactly(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for k in range(60):
        words = list(base)
        for at in rng.integers(0, 150, size=int(rng.integers(0, 5))):
            words[at] = f"x{rng.integers(0, 1000)}"
        texts[k] = " ".join(words)
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 7)
    got = {r.key: (r.class_id, r.n_links) for r in jaccard.near_duplicates(docs).collect()}
    links, classes = brute_links(texts)
    assert got == {k: (classes[k], links[k]) for k in texts}


def test_crowded_keys_are_split_exactly(spark):
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghij klmn", dtype=np.uint8)
    passage = rng.choice(letters, 90).tobytes()
    texts = {}
    for k in range(80):
        part = passage[: int(rng.integers(40, 91))] if k % 3 else passage
        texts[k] = rng.choice(letters, int(rng.integers(0, 60))).tobytes() + part + rng.choice(letters, int(rng.integers(0, 60))).tobytes()
    texts[80] = b"ab" * 200
    docs = spark.createDataFrame([(k, t.decode()) for k, t in texts.items()], "doc_id long, text string")
    want = brute_bytes(texts, 50)
    for crowd in (1, 10, 20_000):
        cut = repeats.remove_repeated_bytes(docs, length=50, crowd=crowd)
        got = {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.removed)) for r in cut.collect()}
        assert got == {k: v[:3] for k, v in want.items()}


def test_interval_tree_gives_maximal_repeats(spark):
    rng = np.random.default_rng(6)
    letters = np.frombuffer(b"abcdefgh", dtype=np.uint8)
    shared = rng.choice(letters, 70).tobytes()
    texts = [rng.choice(letters, 30).tobytes() + shared + rng.choice(letters, 30).tobytes() for _ in range(5)]
    docs = spark.createDataFrame([(t.decode(),) for t in texts], "text string")
    rows = repeats.maximal_repeats(docs, length=50).collect()
    whole = set()
    for r in rows:  # occurrences of a group: those listed within its bounds
        whole.add((sum(o.key == r.key and r.first <= o.first and o.last <= r.last for o in rows), r.size))
    assert (5, 70) in whole, whole


def test_mix_comes_near_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i % 7), "abcdefgh"[min(7, int(12 * ((i * 37 % 1000) / 1000) ** 2))]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, second = (mixing.mix(docs).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target"), F.max("source_size").alias("size"), F.max("copies").alias("most")) for _ in range(2))
    a, b = sorted(first.collect()), sorted(second.collect())
    assert a == b
    assert sum(r.target for r in a) == pytest.approx(sum(r["size"] for r in a))
    assert all(abs(r.taken - r.target) <= 0.15 * r.target and r.most <= 3 and r.target <= 3 * r["size"] + 1e-6 for r in a)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 1.0]), (9, [-1.0, 0.0]), (1, [1.0, 0.0]), (40, None),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = multiprobe.search(vectors, vectors.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    got = collections.defaultdict(list)
    for r in found:
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert got == {0: [(1, 1, 1.0), (2, 20, 1.0), (3, 2, 0.5), (4, 9, -1.0)], 20: [(1, 0, 1.0), (2, 1, 1.0), (3, 2, 0.5), (4, 9, -1.0)]}
    assert multiprobe.search(vectors.limit(0), vectors.limit(0)).count() == 0


def test_equal_vectors_beyond_the_result(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(1000 + i, [float(i), 1.0]) for i in range(5)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = multiprobe.search(vectors, vectors.filter("vec_id = 280"), nearest=20).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [1004, *range(19)]  # ties go to the smaller ids


def broadcast(plan: str) -> str:
    """The lines of a plan that stand below a broadcast."""
    out, top = [], None
    for line in plan.splitlines():
        at = re.search("[A-Za-z]|$", line).start()
        top = None if top is not None and at <= top else top
        out += [line] if top is not None else []
        top = at if top is None and "BroadcastExchange" in line else top
    return "\n".join(out)


def test_probes_and_many_queries_are_not_broadcast(spark, monkeypatch):
    plans = {}

    def keep(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, purpose)

    monkeypatch.setattr(multiprobe, "store", keep)
    points = np.random.default_rng(8).standard_normal((400, 8)).tolist()
    vectors = spark.createDataFrame(list(enumerate(points)), "vec_id long, embedding array<float>")
    got = {}
    for most in (multiprobe.BROADCAST_BYTES, 0):
        monkeypatch.setattr(multiprobe, "BROADCAST_BYTES", most)
        found = multiprobe.search(vectors, vectors.filter("vec_id % 20 = 0"))
        assert "MapInPandas" in plans["found"] and "MapInPandas" not in broadcast(plans["found"])
        plans["result"] = found._jdf.queryExecution().executedPlan().toString()
        got[most] = sorted(found.collect())
    assert "vector" not in broadcast(plans["found"]) and "vector" not in broadcast(plans["result"])
    assert len(got[0]) == 400 and got[0] == got[max(got)]


def test_sample_is_the_smallest_digests(spark, monkeypatch):
    rows = spark.range(9000, numPartitions=12).select(F.col("id").alias("vec_id"), F.array(F.col("id").cast("float")).alias("vector"))
    want = sorted(range(9000), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[: multiprobe.SAMPLE]
    for slack in (multiprobe.SLACK, 0.5):  # with 0.5 too few rows lie below the bound
        monkeypatch.setattr(multiprobe, "SLACK", slack)
        assert [r.vec_id for r in multiprobe.sampled(rows, 9000)] == want
    assert {r.vec_id for r in multiprobe.sampled(rows.filter("vec_id < 3"), 3)} == {0, 1, 2}


def test_sequences_can_be_assembled(awkward):
    packed = packing.pack_documents(awkward, TOKENIZER, keep_ids=True)
    rows = packing.assemble(store(packed, "packed")).collect()
    assert all(len(r.ids) == 4 * r.n_tokens <= 4 * packing.CONTEXT for r in rows)
    assert sum(r.n_pieces for r in rows) == packed.count()


def test_word_ids_are_the_tokenizers(awkward):
    words = packing.WordIds(TOKENIZER)
    texts = [r.text for r in awkward.filter("text is not null").collect()]
    texts += ["Don't STOP, now.\x1cNext", "ΣΟΦΟΣ İstanbul äb <|endoftext|> x<|startoftext|>y", "3.14, a.b.   x"]
    for t in texts:
        assert words.text(t) == np.array(words.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_long_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}


def test_bands_keep_the_recall():
    bands = jaccard.bands_for()
    assert bands.recall(jaccard.SIMILARITY) >= jaccard.RECALL and bands.count * bands.rows <= 128


def later_words(texts, run=50):
    """By document, the words (places) of all runs of `run` words that occur earlier."""
    seen, out = set(), {}
    for k in sorted(texts):
        words = texts[k].lower().split()
        out[k] = set()
        for i in range(len(words) - run + 1):
            unit = tuple(words[i : i + run])
            if unit in seen:
                out[k].update(range(i, i + run))
            seen.add(unit)
    return out


def test_runs_of_50_words_are_found_whole(spark):
    rng = random.Random(8)
    bare = lambda n: " ".join(rng.choice(LEXICON) for _ in range(n))
    shared = [bare(50), bare(63), prose(rng, 52), prose(rng, 90), prose(rng, 50).replace(".", "").lower()]
    texts = {}
    for i in range(40):
        parts = [make(rng.randint(3, 60)) for make in (bare, lambda n: prose(rng, n))]
        parts.insert(rng.randint(0, 2), shared[i % 5])
        texts[i] = rng.choice([" ", "  \n"]).join(parts)
    texts[40] = "word " * 200
    long = shared[3].split()  # Parts of it, so that places of one gram agree in some words only.
    texts |= {41 + i: " ".join(long[i : i + 60]) + " " + bare(9) for i in range(0, 30, 7)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.removed for r in passages.remove_repeats(docs.repartition(3)).collect()}
    words = later_words(texts)
    want = repeated_characters(texts)
    assert sum(map(len, words.values())) > 1500
    for k, t in texts.items():
        gone = {i for s in got[k] for i in range(s.start, s.stop)}
        places = [m.span() for m in WORD.finditer(t)]
        assert all(gone.issuperset(range(*places[i])) for i in words[k]), k
        assert want[k] <= gone and all(t[i].isspace() for i in gone - want[k])


def test_nothing_goes_out_of_the_middle_of_a_sentence(spark):
    end = "The board will meet again in the next year."
    rows = [(1, f"Some words of the first text come here. {end}"), (2, f"Quite another text here, as the {end[4:]} More of it follows now."), (3, f"Third. {end} Last.")]
    got = {r.doc_id: r for r in passages.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), min_words=8).collect()}
    assert got[1].n_removed == got[2].n_removed == 0
    assert got[3].text == "Third.  Last."


def test_units_of_any_script_and_white_space(spark):
    line = "Ünï\u00a0cödé wörds\u2003stand \U0001f600 here, 你 好 İx and\x1cso on"
    rows = [(1, f"a\n{line}\nb"), (2, f"{line.upper()} \n tail"), (3, f"not a line {line}"), (4, f" \n\n{line}\r\n\n")]
    got = {r.doc_id: r.removed for r in passages.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), min_words=8).collect()}
    want = repeated_characters(dict(rows), min_words=8)
    assert {k for k, v in want.items() if v} == {2, 4}
    assert {k: {i for s in v for i in range(s.start, s.stop)} for k, v in got.items()} == want


def test_short_lines_stay_and_long_ones_go(spark):
    words = lambda n: " ".join(f"w{i}" for i in range(n))
    rows = [(k, f"text {k}\n{words(24)}\n{words(25)}\n{k} end") for k in (1, 2, None)]
    got = passages.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.text for r in got} == {k: f"text {k}\n{words(24)}\n{words(25) if k == 1 else ''}\n{k} end" for k in (1, 2, None)}


def test_spans_are_joined_in_order():
    spans = [(0, 5), (2, 3), (6, 9), (11, 12), (11, 30), (32, 33)]
    out = passages._merged.func(pd.Series([np.array([a << 32 | b for a, b in spans])]))[0]
    assert [(x >> 32, x & 0xFFFFFFFF) for x in out.tolist()] == [(0, 9), (11, 30), (32, 33)]


def test_versions_tell_texts_apart_by_64_bits(spark):
    docs = spark.createDataFrame([(None, f"text {i}") for i in range(200_000)], "doc_id long, text string")
    assert dict(docs.select(passages.version(F.col("text")).alias("v")).dtypes)["v"] == "bigint"
    assert docs.select(passages.version(F.col("text"))).distinct().count() == 200_000
    assert dict(passages.removed_spans(docs.limit(1)).dtypes)["version"] == "bigint"


def test_hot_words_come_from_exact_counts(spark, monkeypatch):
    # 3,000 copies of one text, and a word that is frequent in the others only.
    rows = [(i, "same old text") for i in range(3000)] + [(i, f"often a{i} b{i} c{i} often") for i in range(3000, 4000)]
    rows += [(i, "rare " * 400) for i in range(4000, 4001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    train = F.col("doc_id") % 2 == 0
    whole = {r.doc_id: (r.n_known, round(r.score, 9)) for r in katz.score(docs, train).withColumnRenamed("key", "doc_id").collect()}
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 8000)
    hashed = lambda w: int(np.array([katz.WordHashes()[w]], dtype=np.uint64).view(np.int64)[0])
    counts, trained, everything = katz.hot_counts(docs, "text", train)
    end = int(np.array([katz.END], dtype=np.uint64).view(np.int64)[0])
    assert counts == {hashed(b"same"): 1500, hashed(b"old"): 1500, hashed(b"text"): 1500, hashed(b"often"): 1000, end: 2001}
    assert (trained, everything) == (6000 + 3000 + 401, 12000 + 6000 + 401)
    parts = {r.doc_id: (r.n_known, round(r.score, 9)) for r in katz.score(docs, train).withColumnRenamed("key", "doc_id").collect()}
    assert parts == whole


def test_packing_ids_of_letters_written_as_two(spark):
    words = packing.worker_words(TOKENIZER)
    rng = random.Random(6)
    letters = "aZİıßÉŁẞกำ你̇ß.,'-1 \t\n\x1c"
    for text in ["KADIKÖYİ, x", *["".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(20_000)]]:
        expected = np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert words.text(text) == expected, repr(text)


def test_sources_of_documents_without_a_key_meet_their_targets(spark):
    rows = [(None if i % 3 == 0 else i, " ".join(["w"] * 9 + [str(i)]), "ab"[i % 2]) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = F.sum(F.col("copies") * F.col("size")).alias("taken")
    for r in mixing.mix(docs).groupBy("source").agg(taken, F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) < 0.05 * r.target


@pytest.mark.parametrize("name", ["mit-permission"])
def test_licenses_with_words_inserted_anywhere(spark, name):
    words = licenses.TEMPLATES[name].split()
    extra = [f"x{i}" for i in range(10)]
    rows = [(at, " ".join([f"before{i}" for i in range(at)] + words[:14] + extra + words[14:] + ["after"] * 30)) for at in range(40)]
    docs = spark.createDataFrame([*rows, (None, rows[0][1]), (None, rows[0][1])], "doc_id long, text string")
    got = [r.key for r in licenses.scan(docs).filter(F.col("license") == name).collect()]
    assert sorted(k for k in got if k is not None) == list(range(40)) and got.count(None) == 2


def test_rows_without_doc_id_are_held_out(spark, tmp_path, sf):
    for name in ("documents", "labels"):
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        table.unionByName(table.limit(1).withColumn("doc_id", F.lit(None).cast("long"))).write.parquet(f"{tmp_path}/{name}.parquet")
    scored = QUERIES["op5_compression_classifier"](spark, str(tmp_path))
    assert [r.held_out for r in scored.filter("doc_id is null").collect()] == [True]
    assert scored.filter("held_out is null").count() == 0


def test_katz_hands_out_a_block_in_slices(monkeypatch):
    monkeypatch.setattr(katz, "SLICE", 50)
    held = [(np.arange(i, i + 101, dtype=np.uint64), i, i == 0) for i in range(3)]
    held = [(np.append(w[:-1], katz.END), k, used) for w, k, used in held]
    chunk = pd.concat(katz._chunk(held, 0, np.array([], dtype=np.uint64), 2))
    assert not held
    for block, g in chunk.groupby("block"):
        frames = list(katz._stats_of({})(iter([g])))
        assert all(f["kind"].nunique() == 1 for f in frames)
        assert max(len(f) for f in frames if f["kind"].iloc[0] == katz.UNSEEN) <= 50
        assert list(frames[0].columns) == [c.split()[0] for c in katz.STATS.split(", ")]


def test_katz_holds_a_block_by_its_tokens_and_not_by_all_texts():
    far = 5_000_000
    words, train = np.array([7], dtype=np.uint64).tobytes(), np.packbits(np.ones(far + 1, dtype=bool)).tobytes()
    row = (0, 3, words, katz._narrow(np.array([2])), words, katz._narrow(np.array([0, 0])), katz._narrow(np.array([1, far])), train, None, None, None)
    g = pd.DataFrame([row], columns=[c.split()[0] for c in katz.BLOCK.split(", ")])
    tracemalloc.start()
    docs = pd.concat(f for f in katz._stats_of({})(iter([g])) if f["kind"].iloc[0] == katz.DOCS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(docs["key"]) == [(3 << 24) + 1, (3 << 24) + far] and list(docs["n0"]) == [1, 1]
    assert peak < 50e6
