"""Repair of conversations: the cheapest edits that give an allowed order of roles.

Rows are dealt by ranges of (conversation, turn), so a conversation with very many rows is spread over many
tasks. Each task walks its rows in order and solves, many at once, the conversations that lie wholly inside one of
its blocks. What crosses the border of a task or is longer than a block is solved in chunks: cost matrices per
chunk, costs carried over the chunks of a conversation (one small row each), ranks per chunk for every order of the
states behind it, orders carried back, and the edits of each chunk. Only the SHA-256 of a conversation's repaired
text, which has no parts, is formed over all of it, as a stream.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store
from tidemark.llm.repair_paths import INF, Costs, Grammar, Lattice, accepting, unit, whole_paths

#: A block holds rows of this weight: bytes of text, and 1,024 for each row. A chunk has at most CHUNK_ROWS.
BLOCK_BYTES = 4 << 20
CHUNK_ROWS = 256
#: Characters of a chunk's repaired text in one row, so that a batch of rows stays small.
SLICE = 16_384

BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_COUNTS = [(c, pa.int64()) for c in RESULT]
SOLVED = pa.schema([("cid", pa.string()), *_COUNTS, ("audit", pa.string()), ("repaired_sha256", pa.string())])
EDGE = [
    ("piece", pa.int32()), ("block", pa.int32()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
    ("text", pa.string()), ("live", pa.bool_()), ("fault", pa.int32()),
]
MIXED = pa.schema([*SOLVED, *EDGE])
_DDL = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(cid, turn, role, text, live): rows damaged by crc32(`conv:turn`) % 20, and dropped rows with `live` false.

    0 drops a row, 1 empties its text, 2 removes its `.!?`, 3 repeats it, 4 makes its role user. NULL roles, texts
    and parts of the hashed key count as one space; `cid` is a text that tells a NULL conversation from all others.
    """
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv, turn, role, text))
    part = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    kind = F.crc32(F.concat_ws(":", part[0], part[1])) % 20
    changed = F.when(kind == 0, "").when(kind == 1, "").when(kind == 2, F.regexp_replace(part[3], "[.!?]", "")).otherwise(part[3])
    named = rows.select(
        F.when(conv.isNull(), "null").otherwise(F.concat(F.lit("k"), conv.cast("string"))).alias("cid"),
        turn.cast("long").alias("turn"),
        F.when(kind == 4, "user").when(kind == 0, "").otherwise(part[2]).alias("role"),
        changed.alias("text"),
        (kind != 0).alias("live"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return named.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copy", "copies")


def _fault(text: str) -> int:
    stripped = text.rstrip(_SPACE)
    return BLANK if not stripped else 0 if stripped[-1] in ".!?" else TRUNCATED


def _summary(rows: list[dict]) -> dict:
    """Counts of one chunk's rows in order, and what its neighbours need to know."""
    faults = [r["fault"] for r in rows]
    initials = [r["role"][:1] for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    return {
        "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE),
        "truncated": faults.count(TRUNCATED),
        "illegal": sum(a + b not in _LEGAL for a, b in itertools.pairwise(initials)),
        "ends": [initials[0], initials[-1]] if rows else None,
        "turns": [turns[0], turns[-1], len(set(turns))] if turns else None,
    }


def _joined(a: dict, b: dict) -> dict:
    """The summary of two chunks in a row."""
    out = {c: a[c] + b[c] for c in ("blank", "duplicate", "truncated", "illegal")}
    out["ends"], out["turns"] = a["ends"] or b["ends"], a["turns"] or b["turns"]
    if a["ends"] and b["ends"]:
        out["illegal"] += a["ends"][1] + b["ends"][0] not in _LEGAL
        out["ends"] = [a["ends"][0], b["ends"][1]]
    if a["turns"] and b["turns"]:
        same = a["turns"][1] == b["turns"][0]
        out["turns"] = [a["turns"][0], b["turns"][1], a["turns"][2] + b["turns"][2] - same]
    return out


def _counts(summary: dict, cost: int) -> dict:
    turns = summary["turns"]
    gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
    return {"gaps": gaps, "cost": cost, **{c: summary[c] for c in ("blank", "duplicate", "truncated", "illegal")}}


def _line(letter: str, role: str | None, row: dict | None) -> str | None:
    """What an edit leaves in the repaired conversation."""
    if letter == "D":
        return None
    return f"{role}:" if letter == "I" else f"{role or row['role']}:{row['text']}"


def _facts(chunks: list[list[dict]]) -> tuple:
    rows = [r for chunk in chunks for r in chunk]
    return (
        [r["role"][:1] for r in rows],
        [r["fault"] in (BLANK, DUPLICATE) for r in rows],
        [r["fault"] == TRUNCATED for r in rows],
        [len(chunk) for chunk in chunks],
    )


def _edits(lattice: Lattice, chunk, arc, row, chunks: list[list[dict]]) -> list[tuple[str, list[str]]]:
    """The audit and the repaired lines of each chunk."""
    rows = [r for c in chunks for r in c]
    audits: list[list[str]] = [[] for _ in chunks]
    lines: list[list[str]] = [[] for _ in chunks]
    for k, a, r in zip(chunk.tolist(), arc.tolist(), row.tolist()):
        edit = lattice.arcs[a]
        audits[k].append(edit.letter)
        line = _line(edit.letter, edit.role, rows[r] if edit.step else None)
        if line is not None:
            lines[k].append(line)
    return [("".join(a), text) for a, text in zip(audits, lines)]


def _solved(names: list[str], chunks: list[list[dict]], grammar: Grammar, costs: Costs) -> list[dict]:
    """Whole conversations, each with its rows in order."""
    chunks = [[r for r in chunk if r["live"]] for chunk in chunks]
    for chunk in chunks:
        seen = set()
        for r in chunk:
            known = (r["role"], r["text"])
            if known in seen and r["fault"] != BLANK:
                r["fault"] = DUPLICATE
            seen.add(known)
    lattice, *found = whole_paths(*_facts(chunks), grammar, costs)
    out = []
    for i, (audit, lines) in enumerate(_edits(lattice, *found, chunks)):
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = _counts(_summary(chunks[i]), int(lattice.total[i]))
        out.append({"cid": names[i], **counts, "audit": audit, "repaired_sha256": digest})
    return out


def _walk(grammar: Grammar, costs: Costs, block_bytes: int) -> Callable:
    """Sorted rows of one task to solved conversations, and to the rows of those that may go on elsewhere."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        piece = context.partitionId() if context else 0
        block = place = weight = 0
        open_end = True  # whether the first conversation held may have begun before its first row here
        held: list[tuple[str, list[dict]]] = []

        def edge(cid: str, rows: list[dict]) -> list[dict]:
            return [{"cid": cid, "piece": piece, "block": block, **r} for r in rows]

        def cut(final: bool) -> pa.RecordBatch | None:
            nonlocal held, open_end, block, weight
            out: list[dict] = []
            if open_end and held and (len(held) > 1 or final or weight >= block_bytes):
                # Begun before: it goes out in chunks, and may still go on if it is all there is.
                out += edge(*held[0])
                open_end = len(held) == 1 and not final
                held = [(held[0][0], [])] if open_end else held[1:]
            elif len(held) == 1 and weight >= block_bytes:
                out += edge(*held[0])
                open_end, held = True, [(held[0][0], [])]
            whole = held if not final or not held else held[:-1]
            if not final:
                whole, held = ([], held) if open_end else (held[:-1], held[-1:])
            elif held:
                out += edge(*held[-1])
                held = []
            if whole:
                out += _solved([c for c, _ in whole], [rows for _, rows in whole], grammar, costs)
            block += 1
            weight = sum(1024 + len(r["text"]) for _, rows in held for r in rows)
            return pa.RecordBatch.from_pylist(out, schema=MIXED) if out else None

        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                for r in batch.slice(first, 512).to_pylist():
                    cid = r.pop("cid")
                    if not held or held[-1][0] != cid:
                        held.append((cid, []))
                    held[-1][1].append({**r, "place": place, "fault": _fault(r["text"])})
                    place, weight = place + 1, weight + 1024 + len(r["text"])
                    if weight >= block_bytes and (out := cut(final=False)) is not None:
                        yield out
        if (out := cut(final=True)) is not None:
            yield out

    return walk


def _chunks(table: pa.Table) -> list[tuple[tuple, list[dict]]]:
    """The live rows of a group of rows by chunk (cid, piece, chunk), in order; a chunk may have none."""
    out: dict[tuple, list[dict]] = {}
    for r in sorted(table.to_pylist(), key=lambda r: (r["cid"], r["piece"], r["place"])):
        rows = out.setdefault((r["cid"], r["piece"], r["chunk"]), [])
        if r["live"]:
            rows.append(r)
    return list(out.items())


def _lattice(chunks: list[list[dict]], grammar: Grammar, costs: Costs) -> Lattice:
    return Lattice(*_facts(chunks), [False] * len(chunks), grammar, costs)


_CHUNK = [("cid", pa.string()), ("piece", pa.int32()), ("chunk", pa.int64())]


def _rows_by_chunk(keys, **columns) -> pa.Table:
    """One row per chunk, with its further columns as JSON."""
    named = {name: pa.array([k[i] for k in keys], t) for i, (name, t) in enumerate(_CHUNK)}
    return pa.table({**named, **{c: pa.array([json.dumps(v) for v in values], pa.string()) for c, values in columns.items()}})


def _matrices(grammar: Grammar, costs: Costs) -> Callable:
    def solve(table: pa.Table) -> pa.Table:
        keys, chunks = zip(*_chunks(table))
        costs_of = _lattice(list(chunks), grammar, costs).matrices().tolist()
        return _rows_by_chunk(keys, matrix=costs_of, summary=[_summary(c) for c in chunks])

    return solve


def _in_order(table: pa.Table) -> list[dict]:
    return sorted(table.to_pylist(), key=lambda r: (r["piece"], r["chunk"]))


#: The chunk that stands for the end of a conversation: after all others, without rows.
_CLOSE = (1 << 31) - 1


def _closing(grammar: Grammar, costs: Costs) -> Lattice:
    return Lattice([], [], [], [0], [True], grammar, costs)


def _carry_costs(grammar: Grammar, costs: Costs) -> Callable:
    """Cost matrices of one conversation's chunks to the costs before and behind each chunk."""

    def carry(table: pa.Table) -> pa.Table:
        rows = _in_order(table)
        close = _closing(grammar, costs)
        before = [unit(1, grammar)[0]]
        for r in rows:
            step = before[-1][:, None] + np.array(json.loads(r["matrix"]))
            before.append(np.minimum(step.min(axis=0), INF))
        behind = [close.backward(accepting(1, grammar))[0]]
        for r in reversed(rows):
            step = np.array(json.loads(r["matrix"])) + behind[-1][None, :]
            behind.append(np.minimum(step.min(axis=1), INF))
        total = json.loads(rows[0]["summary"])
        for r in rows[1:]:
            total = _joined(total, json.loads(r["summary"]))
        cost = int((before[-1] + behind[0]).min())
        keys = [(r["cid"], r["piece"], r["chunk"]) for r in rows] + [(rows[0]["cid"], _CLOSE, 0)]
        behind = behind[::-1][1:] + [accepting(1, grammar)[0]]
        costs_at = [[b.tolist(), c.tolist()] for b, c in zip(before, behind)]
        return _rows_by_chunk(keys, costs=costs_at, counts=[None] * len(rows) + [_counts(total, cost)])

    return carry


def _compact(rank: np.ndarray, on: np.ndarray) -> tuple:
    """Ranks of the states on cheapest paths: how many of them are smaller; -1 for the others."""
    return tuple(int(sum(rank[j] < rank[i] for j in np.flatnonzero(on))) if on[i] else -1 for i in range(len(rank)))


def _orders(on: np.ndarray) -> list[tuple]:
    """All orders, with ties, of the states that are on."""
    some = np.flatnonzero(on)
    found = set()
    for ranks in itertools.product(range(len(some)), repeat=len(some)):
        rank = np.zeros(len(on), dtype=np.int64)
        rank[some] = ranks
        found.add(_compact(rank, on))
    return sorted(found)


def _rank_maps(grammar: Grammar, costs: Costs) -> Callable:
    """For every order of the states behind a chunk: the order before it, and the state each state leads to."""

    def solve(table: pa.Table) -> pa.Table:
        keys, chunks = zip(*_chunks(table))
        at = {(r["cid"], r["piece"], r["chunk"]): json.loads(r["costs"]) for r in table.to_pylist()}
        entry, leave = (np.array([at[k][i] for k in keys]) for i in (0, 1))
        lattice = _lattice(list(chunks), grammar, costs)
        behind = lattice.forward(entry)[lattice.end] + leave
        tried = [(i, order) for i, b in enumerate(behind) for order in _orders((b == b.min()) & (leave[i] < INF))]
        which = [i for i, _ in tried]
        many = _lattice([chunks[i] for i in which], grammar, costs)
        many.solve(entry[which], leave[which], leave[which] < INF, np.array([order for _, order in tried]))
        exits = np.column_stack([many.paths(np.full(len(tried), s))[3] for s in range(grammar.states)])
        maps: list[list] = [[] for _ in keys]
        for n, (i, order) in enumerate(tried):
            maps[i].append([order, _compact(many.rank[many.base[n]], many.entered[n]), exits[n].tolist()])
        return _rows_by_chunk(keys, maps=maps)

    return solve


def _carry_orders(grammar: Grammar, costs: Costs) -> Callable:
    """Orders from the end of a conversation to its first chunk, then its states from the first chunk on."""

    def carry(table: pa.Table) -> pa.Table:
        *rows, end = _in_order(table)
        close = _closing(grammar, costs)
        entry, leave = (np.array([c]) for c in json.loads(end["costs"]))
        close.solve(entry, leave, leave == 0, np.zeros_like(leave))
        order, orders = _compact(close.rank[0], close.entered[0]), []
        for r in reversed(rows):
            orders.append(order)
            maps = {tuple(behind): (tuple(before), exits) for behind, before, exits in json.loads(r["maps"])}
            order = maps[order][0]
        state, states = 0, []
        for r, behind in zip(rows, reversed(orders)):
            states.append(state)
            state = next(exits for o, _, exits in json.loads(r["maps"]) if tuple(o) == behind)[state]
        (audit, lines), = _edits(close, *close.paths(np.array([state]))[:3], [[]])
        keys = [(r["cid"], r["piece"], r["chunk"]) for r in [*rows, end]]
        starts = [[s, list(o)] for s, o in zip(states, reversed(orders))] + [None]
        last = {"counts": json.loads(end["counts"]), **_parts(audit, lines)[0]}
        return _rows_by_chunk(keys, start=starts, close=[None] * len(rows) + [last])

    return carry


def _repaired(grammar: Grammar, costs: Costs) -> Callable:
    """The audit and the repaired lines of each chunk."""

    def solve(table: pa.Table) -> pa.Table:
        keys, chunks = zip(*_chunks(table))
        at = {(r["cid"], r["piece"], r["chunk"]): (json.loads(r["costs"]), json.loads(r["start"])) for r in table.to_pylist()}
        entry, leave = (np.array([at[k][0][i] for k in keys]) for i in (0, 1))
        lattice = _lattice(list(chunks), grammar, costs)
        lattice.solve(entry, leave, leave < INF, np.array([at[k][1][1] for k in keys]))
        chunk, arc, row, _ = lattice.paths(np.array([at[k][1][0] for k in keys]))
        done = [(k, part) for k, edits in zip(keys, _edits(lattice, chunk, arc, row, list(chunks))) for part in _parts(*edits)]
        return _rows_by_chunk([k for k, _ in done], close=[part for _, part in done], part=[part["part"] for _, part in done])

    return solve


def _parts(audit: str, lines: list[str]) -> list[dict]:
    """What the edits of a chunk leave, in slices; `begins` where the first line of a chunk begins."""
    text = "\n".join(lines)
    first = {"part": 0, "audit": audit, "text": text[:SLICE], "begins": bool(lines)}
    rest = range(SLICE, len(text), SLICE)
    return [first, *[{"part": i + 1, "audit": "", "text": text[at : at + SLICE], "begins": False} for i, at in enumerate(rest)]]


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in order to one row per conversation; only the hash and the audit of one are held."""
    cid, audit, digest, empty = None, [], hashlib.sha256(), True
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            name, close = batch.column("cid")[i].as_py(), json.loads(batch.column("close")[i].as_py())
            if name != cid:
                cid, audit, digest, empty = name, [], hashlib.sha256(), True
            audit.append(close["audit"])
            digest.update(("\n" if close["begins"] and not empty else "").encode() + close["text"].encode())
            empty = empty and not close["begins"]
            if "counts" in close:
                out.append({"cid": cid, **close["counts"], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=SOLVED)


def _in_chunks(edges: DataFrame, grammar: Grammar, costs: Costs, chunk_rows: int) -> DataFrame:
    """Conversations whose rows lie in several blocks or tasks, from (cid, EDGE)."""
    known = F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    # A chunk lies inside one block; chunks of a piece have rising numbers.
    chunk = F.shiftleft(F.col("block").cast("long"), 32) + F.floor(F.col("place") / chunk_rows)
    edges = edges.withColumn("chunk", chunk).withColumn("known", known)
    at = F.struct("piece", "place")
    again = edges.filter("live").groupBy("cid", "known").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    fault = F.when(F.col("live") & (F.col("fault") != BLANK) & (at > F.col("first")), DUPLICATE).otherwise(F.col("fault"))
    marked = edges.join(again.drop("n"), ["cid", "known"], "left").withColumn("fault", fault).drop("first", "known")
    rows = store(marked, "edge-rows")
    key, ddl = ["cid", "piece", "chunk"], "cid string, piece int, chunk long"
    narrow = rows.withColumn("role", F.left("role", F.lit(1))).drop("text")
    by_block = ("piece", "block")
    matrices = narrow.groupBy(*by_block).applyInArrow(_matrices(grammar, costs), f"{ddl}, matrix string, summary string")
    carried = matrices.groupBy("cid").applyInArrow(_carry_costs(grammar, costs), f"{ddl}, costs string, counts string")
    carried = store(carried, "edge-costs")
    ranked = narrow.join(carried.drop("counts"), key).groupBy(*by_block)
    maps = ranked.applyInArrow(_rank_maps(grammar, costs), f"{ddl}, maps string")
    steps = carried.join(maps, key, "left").groupBy("cid")
    starts = store(steps.applyInArrow(_carry_orders(grammar, costs), f"{ddl}, start string, close string"), "edge-starts")
    with_text = rows.join(carried.drop("counts"), key).join(starts.drop("close"), key).groupBy(*by_block)
    done = with_text.applyInArrow(_repaired(grammar, costs), f"{ddl}, close string, part string")
    closed = starts.filter(F.col("piece") == _CLOSE).select(*key, "close", F.lit("0").alias("part"))
    ordered = done.unionByName(closed).repartition("cid").sortWithinPartitions(*key, F.col("part").cast("int"))
    return ordered.drop("part").mapInArrow(_hashed, _ddl(SOLVED))


def repair(
    rows: DataFrame,
    grammar: Grammar = Grammar(),
    costs: Costs = Costs(),
    block_bytes: int = BLOCK_BYTES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per `cid` of (cid, turn, role, text, live): counts of faults, cost, audit and hash of the repair.

    A conversation's rows come by turn (NULL first), then role, then the MD5 of the text; equal rows are equal. A
    row's first fault counts: blank (only white space), duplicate (role and text seen earlier), truncated (ends
    without `.!?`). Blank and duplicate rows have to go. A role that is empty or has another initial than the
    grammar's may be replaced or deleted, not kept. Rows that are not live only keep their conversation in the
    result: without live rows it has zeros, an empty audit and the hash of the empty text. No rows give no rows.
    """
    marked = rows.withColumn("mark", F.md5("text")).withColumn("n", F.monotonically_increasing_id())
    order = [F.asc("cid"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("mark"), F.asc("n")]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order).select("cid", "turn", "role", "text", "live")
    mixed = store(dealt.mapInArrow(_walk(grammar, costs, block_bytes), _ddl(MIXED)), "conversations")
    names = [f.name for f in SOLVED]
    inside = mixed.filter("piece is null").select(names)
    edges = mixed.filter("piece is not null").select("cid", *[name for name, _ in EDGE])
    return inside.unionByName(_in_chunks(edges, grammar, costs, chunk_rows))


def repair_damaged(conversations: DataFrame, conv: str = "conv_id", **columns: str) -> DataFrame:
    """`repair` of `damaged` rows, with the conversations' own ids; other columns are not read."""
    solved = repair(damaged(conversations, conv, **columns))
    kind = conversations.select(F.col(f"`{conv}`").alias("conv")).schema["conv"].dataType
    name = F.when(F.col("cid") != "null", F.expr("substring(cid, 2)")).cast(kind).alias("conv_id")
    return solved.select(name, *RESULT, "audit", "repaired_sha256")
