from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations
from tidemark.llm.collocations import Limits, Trie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows):
    """Occurrences per language of all phrases of one to four words, and of all words."""
    counts = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return counts


def brute(rows, min_count, top):
    out = []
    for lang, f in brute_counts(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = [p for p, a in f.items() if len(p) > 1 and a >= min_count]
        covers = collections.Counter()
        for q in often:
            inner = {q[i:j] for i in range(len(q)) for j in range(i + 2, len(q) + 1)} - {q}
            for p in inner:
                covers[p] = max(covers[p], f[q])
        scored = []
        for p in often:
            if p in covers and 100 * covers[p] >= 80 * f[p]:
                continue
            score, _, l, r = min((2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -f[p], " ".join(p).encode(), l, r))
        for i, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def odd_rows():
    rng = random.Random(7)
    words = ["The", "of", "a", "é", "b-b", "c\x00d", "x y", "$", "zz"] + [f"w{i}" for i in range(30)]
    marks = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]
    rows = []
    for i in range(300):
        text = "".join(w + rng.choice(marks) for w in rng.choices(words, [9, 9, 6, 5, 4, 3, 3, 2, 2] + [1] * 30, k=rng.randint(0, 40)))
        rows.append((i, text + (" out of the blue" if i % 3 == 0 else ""), rng.choice(["en", "fr", None, "und"])))
    return [*rows, (None, None, None), (1, "", "en"), (2, " \t", "de"), (3, "only. one, word", "xx"), *rows[:5]]


SETTINGS = [
    Limits(),
    Limits(trie_entries=50, block_tokens=40, burst=3),
    Limits(words=10, slice_bytes=4),
    Limits(sieve_bits=16, part_bytes=500),
]


@pytest.mark.parametrize("limits", SETTINGS)
def test_phrases_agree_with_plain_counts(spark, limits):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    docs = docs.withColumn("phrase", F.lit(1)).withColumn("words", F.lit("w")).withColumn("part", F.lit(0))
    got = collocations.collocations(docs, min_count=4, top=40, limits=limits)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute([(lang, text) for _, text, lang in rows], 4, 40)
    assert sorted(tuple(r) for r in got.select(columns).collect()) == expected
    assert len({lang for lang, *_ in expected}) > 2


def test_tables_without_phrases(nothing, awkward):
    assert collocations.collocations(nothing).count() == 0
    counted = {(r.lang, r.phrase): r.n for r in collocations.count_phrases(awkward, min_count=1, max_words=1).collect()}
    plain = brute_counts([(r.lang, r.text) for r in awkward.collect()])
    assert counted == {
        **{(lang, " ".join(p)): n for lang, f in plain.items() for p, n in f.items() if len(p) == 1},
        **{(lang, None): sum(n for p, n in f.items() if len(p) == 1) for lang, f in plain.items() if f},
    }


def test_scores_pass_64_bits_exactly(spark):
    big = 3 * 10**13 + 1
    rows = [("en", "a", 1, big + 7), ("en", "b", 1, 5 * big + 3), ("en", "a b", 2, big), ("en", None, 0, 9 * big)]
    counted = spark.createDataFrame(rows, "lang string, phrase string, words int, n long")
    (row,) = collocations.score_phrases(counted).collect()
    assert row.score == 2000000 * big // (6 * big + 10) and 2000000 * big > 2**63


def held(subtrees):
    return {(*prefix, *rest): n for prefix, below in subtrees for rest, n in below.items()}


def test_trie_counts_survive_bursts_and_partial_spills():
    rng = random.Random(2)
    trie, plain, taken = Trie(burst=4), collections.Counter(), collections.Counter()
    for i in range(5000):
        phrase = tuple(min(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(rng.randint(1, 4)))
        trie.add(phrase, 1 + i % 3)
        plain[phrase] += 1 + i % 3
        if i % 100 == 0:
            several = sorted({tuple(rng.randint(0, 5) for _ in range(1 + i // 100 % 4)) for _ in range(20)})
            trie.add_sorted(np.array(several), np.arange(1, len(several) + 1))
            plain.update({p: n + 1 for n, p in enumerate(several)})
        if i % 1000 == 999:
            before = trie.entries
            spilled = held(trie.take(before // 2))
            assert trie.entries == before - len(spilled) <= before // 2
            taken.update(spilled)
    taken.update(held(trie.take(0)))
    assert taken == plain and trie.entries == 0 and not trie.root
