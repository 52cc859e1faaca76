from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations
from tidemark.llm.queries import QUERIES
from tidemark.llm.repair_paths import Costs, Grammar, whole_paths

SCHEMA = "conv_id long, turn long, role string, text string"
TOOLS = Grammar(
    5,
    ((0, "s", 1), (0, "u", 2), (1, "u", 2), (2, "a", 3), (2, "t", 4), (4, "a", 3), (3, "u", 2), (4, "t", 4)),
    (0, 3),
    ("user", "assistant", "tool"),
)


def cheapest(initials, must_go, truncated, grammar=Grammar(), costs=Costs()):
    """Cost and least audit by a search over (cost, audit)."""
    to = {(s, a): t for s, a, t in grammar.arcs}
    heap, seen, n = [(0, "", 0, 0)], {}, len(initials)
    while heap:
        cost, audit, p, s = heapq.heappop(heap)
        if (p, s) in seen:
            continue
        seen[p, s] = (cost, audit)
        steps = [(costs.insert, "I", p, to.get((s, r[0]))) for r in grammar.roles]
        if p < n:
            steps.append((costs.delete, "D", p + 1, s))
            if not must_go[p]:
                more = costs.truncated * truncated[p]
                steps.append((more, "K", p + 1, to.get((s, initials[p]))))
                steps += [(more + costs.rerole, "R", p + 1, to.get((s, r[0]))) for r in grammar.roles]
        for w, letter, q, t in steps:
            if t is not None:
                heapq.heappush(heap, (cost + w, audit + letter, q, t))
    return min(seen[n, s] for s in grammar.accept if (n, s) in seen)


def damage(rows):
    out, ids = {}, []
    for conv, turn, role, text in rows:
        ids.append(conv)
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind != 0:
            out.setdefault(conv, []).extend([(turn, role, text)] * (2 if kind == 3 else 1))
    return out, set(ids)


def brute(rows):
    """The contract, row by row."""
    live, ids = damage(rows)
    result = {}
    for conv in ids:
        own = sorted(live.get(conv, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        faults, seen = [], set()
        for _, role, text in own:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
            faults.append(fault)
            seen.add((role, text))
        initials = [role[:1] for _, role, _ in own]
        turns = {t for t, _, _ in own if t is not None}
        cost, audit = cheapest(initials, [f in ("blank", "duplicate") for f in faults], [f == "truncated" for f in faults])
        lines, i, state = [], 0, 0
        for letter in audit:
            role, text = ("", "") if letter == "I" else own[i][1:]
            if letter in "IR":
                role = "assistant" if state == 2 else "user"
            if letter != "D":
                lines.append(f"{role}:{text}")
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
            i += letter != "I"
        assert i == len(own) and re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        result[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return result


def as_dict(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("grammar, costs", [(Grammar(), Costs()), (TOOLS, Costs()), (TOOLS, Costs(1, 1, 1, 1)), (Grammar(), Costs(2, 2, 2, 2))])
def test_least_audits_of_many_sequences(grammar, costs):
    rng = random.Random(1)
    for _ in range(25):
        lengths = [rng.randint(0, 9) for _ in range(rng.randint(1, 30))]
        initials = [rng.choice("suauaauatx ") for _ in range(sum(lengths))]
        must_go = [rng.random() < 0.2 for _ in initials]
        truncated = [rng.random() < 0.3 for _ in initials]
        lattice, chunk, arc, _ = whole_paths(initials, must_go, truncated, lengths, grammar, costs)
        audits = [""] * len(lengths)
        for k, a in zip(chunk, arc):
            audits[k] += lattice.arcs[a].letter
        first = 0
        for i, n in enumerate(lengths):
            part = slice(first, first + n)
            assert (lattice.total[i], audits[i]) == cheapest(initials[part], must_go[part], truncated[part], grammar, costs)
            first += n


def test_query_agrees_with_the_contract_row_by_row(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(QUERIES["op12_conversation_repair"](spark, sf)) == brute(rows)


def odd_rows():
    rng = random.Random(3)
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "uncle"])
            text = rng.choice(["Yes.", "no", "", " \n", None, "A longer text, cut of", f"What is {turn}?", "ends here! \t"])
            rows.append((conv, None if rng.random() < 0.2 else turn * rng.choice([1, 1, 2]), role, text))
    rows += rows[:5] * 3 + [(99, None, None, None)]
    rows += [(7, t, "user" if t % 2 else "assistant", f"Turn {t % 150}." * (1 + t % 3)) for t in range(20, 400)]
    return rows


@pytest.mark.parametrize("block_bytes, chunk_rows", [(conversations.BLOCK_BYTES, 256), (6000, 4), (2000, 1)])
def test_conversations_solved_in_pieces(spark, block_bytes, chunk_rows):
    rows = [*odd_rows(), (500, 0, "user", "long " * 9000 + "."), (500, 1, "assistant", "é" * 40000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("live", F.lit(1)).withColumn("cid", F.lit("x"))
    solved = conversations.repair(conversations.damaged(docs), block_bytes=block_bytes, chunk_rows=chunk_rows)
    own = F.when(F.col("cid") != "null", F.expr("substring(cid, 2)")).cast("long")
    assert as_dict(solved.withColumn("conv_id", own)) == brute(rows)


def test_all_rows_dropped_and_no_rows(spark):
    keys = [k for k in range(300) if zlib.crc32(f"{k}:0".encode()) % 20 == 0][:3]
    docs = spark.createDataFrame([(k, 0, "user", "Hi.") for k in keys], SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert as_dict(conversations.repair_damaged(docs)) == {k: (0, 0, 0, 0, 0, 0, "", empty) for k in keys}
    assert conversations.repair_damaged(docs.limit(0)).count() == 0
