"""Repair of conversation structure at least cost, with an audit of the edits.

A conversation's rows go by turn (nulls first; equal turns by role, then by the
text's first 64 characters, then by its SHA-256). A row's first fault counts:
blank (only white space), duplicate (role and text were seen earlier),
truncated (its last visible character is no full stop, exclamation or question
mark). The edits Keep (0), Rerole to user or assistant (2), Delete (3, required
for blank and duplicate rows) and Insert an empty user or assistant row (2)
must leave role initials ``(s?(ua)+)?``; a truncated row that is not deleted
costs 1 more. Of the cheapest edits those with the ASCII-least initials are taken.

Weights. A node of the graph is (row, what stands before it: nothing, system,
user, assistant). Its weight is one integer: the cost to the end in the high
digits, below it a fixed number of octal digits with the audit to the end, first
letter first (D 1, I 2, K 3, R 4: the order of their characters), zeros behind
its end. An edit in front adds its cost and letter to the weight whose audit is
moved down by one digit, so the integer minimum settles cost and ties at once;
between two rows at most two inserts can be of use, so the graph has no cycle.

Distribution. Rows are range partitioned by the whole order and sorted, and
become segments of at most ``SEGMENT`` rows or ``SEGMENT_BYTES`` of text. A
conversation inside one task is solved there and then. One that is cut, or that
may go on in the next task, is solved in two steps: each segment has its 4 x 4
matrix of costs from state to state, a walk from the last segment to the first
gives each segment the costs behind it, and with these as end weights each
segment is solved by itself for the four states it may begin in. That is exact:
all paths of a segment end with an edit of its last row, so none of their audits
begins with another one, and the first difference lies inside the segment.

Defined results: null roles and texts are one space; a null id is a conversation
of its own; equal rows are repeats of each other; texts are taken whole; a role
counts by its first character, so an unknown role may stand if that fits; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daypulse.llm.storage import materialise, share_code

#: A segment ends at so many rows, or at so many bytes of text.
SEGMENT, SEGMENT_BYTES = 1024, 4_000_000
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
OK, BLANK, DUPLICATE, TRUNCATED = range(4)
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: What an inserted or reroled row leads to from each state, and what a kept one does.
PAIR = (USER, USER, ASSISTANT, USER)
KEEP = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
D, I, K, R = 1, 2, 3, 4
_LETTER = {str(n): c for n, c in zip((D, I, K, R), "DIKR")}
#: Cost and letters that end a conversation from each state.
END = ((0, ""), (4, "II"), (2, "I"), (0, ""))
FAR = 1 << 60


def fault_of(role: str, text: str, seen: bool) -> int:
    end = text.rstrip(BLANKS)
    return BLANK if not end else DUPLICATE if seen else TRUNCATED if end[-1] not in ".!?" else OK


def edits(initial: str, fault: int) -> list[tuple[int, int, object]]:
    """(cost, letter, state -> state or nothing) of a row's own edits."""
    found = [(3, D, lambda s: s)]
    if fault not in (BLANK, DUPLICATE):
        more = int(fault == TRUNCATED)
        found += [(more, K, KEEP.get(initial, {}).get), (2 + more, R, PAIR.__getitem__)]
    return found


_EDITS = {(c, f): [(cost, letter, [go(s) for s in range(4)]) for cost, letter, go in edits(c, f)] for c in "sua-" for f in range(4)}


def _own(initial: str, fault: int) -> list:
    return _EDITS[initial if initial in ("s", "u", "a") else "-", fault]


def solve(items: list[tuple[str, int]], behind: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """(cost, audit) from each state the segment may begin in; ``behind``: cost
    and audit behind it from each state that it may end in."""
    width = 3 * len(items) + 3  # octal digits: a row and two inserts each, and two at the end
    high = 3 * width
    low, top = (1 << high) - 1, high - 3

    def code(cost: int, audit: str) -> int:
        digits = int("".join(str("DIKR".index(c) + 1) for c in audit).ljust(width, "0"), 8)
        return (cost << high) + digits

    def moved(w: int) -> int:  # the audit one digit further down, free for a letter in front
        return (w >> high << high) + ((w & low) >> 3)

    step = {(cost, letter): (cost << high) + (letter << top) for cost in range(4) for letter in (D, I, K, R)}
    weight = [code(*b) for b in behind]
    for initial, fault in reversed(items):
        after = [moved(w) for w in weight]
        bare = [min(after[to[s]] + step[cost, letter] for cost, letter, to in _own(initial, fault) if to[s] is not None)
                for s in range(4)]
        one = [min(bare[s], moved(bare[PAIR[s]]) + step[2, I]) for s in range(4)]
        weight = [min(bare[s], moved(one[PAIR[s]]) + step[2, I]) for s in range(4)]
    return [(w >> high, "".join(_LETTER[c] for c in format(w & low, "o").zfill(width).rstrip("0"))) for w in weight]


def matrix(items: list[tuple[str, int]]) -> list[int]:
    """Least cost from each state to each state over a segment, row by row."""
    costs = [[0 if s == t else FAR for t in range(4)] for s in range(4)]

    def least(options: list[tuple[int, list[int]]]) -> list[int]:
        return [min(c + v[t] for c, v in options) for t in range(4)]

    for initial, fault in reversed(items):
        bare = [least([(cost, costs[to[s]]) for cost, _, to in _own(initial, fault) if to[s] is not None]) for s in range(4)]
        one = [least([(0, bare[s]), (2, bare[PAIR[s]])]) for s in range(4)]
        costs = [least([(0, bare[s]), (2, one[PAIR[s]])]) for s in range(4)]
    return [min(c, FAR) for row in costs for c in row]


def apply_edits(audit: str, state: int, roles: list[str], texts: list[str]) -> tuple[int, list[tuple[str, str, str]]]:
    """The state after the edits, and the rows they leave: (role, text, letter)."""
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            state = PAIR[state]
            out.append(("user" if state == USER else "assistant", "", letter))
            continue
        if letter == "R":
            state = PAIR[state]
            out.append(("user" if state == USER else "assistant", texts[at], letter))
        elif letter == "K":
            state = KEEP[roles[at][0]][state]
            out.append((roles[at], texts[at], letter))
        at += 1
    return state, out


class Digest:
    """SHA-256 of ``role:text`` rows joined by line feeds, row after row."""

    def __init__(self) -> None:
        self.sha, self.any = hashlib.sha256(), False

    def add(self, rows: list[tuple[str, str, str]]) -> None:
        for role, text, _ in rows:
            self.sha.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True


_COUNTS = ["n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]
_SEGMENT_SCHEMA = ("c string, nil boolean, part int, seg int, whole boolean, " + ", ".join(f"{n} long" for n in _COUNTS)
                   + ", head string, tail string, step array<long>, turn array<long>, role array<string>, text array<string>, "
                     "fault array<int>, cost long, audit string, digest string")


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _segment(key: tuple, part: int, seg: int, whole: bool, rows: list[tuple]) -> dict:
    """One segment's row; ``rows`` are (turn, role, text, fault)."""
    turns, roles, texts, faults = (list(c) for c in zip(*rows))
    initials = [r[:1] for r in roles]
    known = [t for t in turns if t is not None]
    items = list(zip(initials, faults))
    out = {"c": key[0], "nil": key[1], "part": part, "seg": seg, "whole": whole, "n": len(rows),
           "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
           "illegal": sum(not legal(a, b) for a, b in zip(initials, initials[1:])), "turns": len(set(known)),
           "low": known[0] if known else None, "high": known[-1] if known else None, "head": initials[0], "tail": initials[-1],
           "step": None, "cost": None, "audit": None, "digest": None,
           "turn": turns, "role": roles, "text": texts, "fault": faults}
    if whole:
        out["cost"], out["audit"] = solve(items, list(END))[NOTHING]
        digest = Digest()
        digest.add(apply_edits(out["audit"], NOTHING, roles, texts)[1])
        out["digest"] = digest.sha.hexdigest()
    else:
        out["step"] = matrix(items)
    return out


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    """The Arrow schema of a simple DDL string."""
    kinds = {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64()}
    pairs = [p.strip().rsplit(" ", 1) for p in ddl.split(",")]
    return pa.schema([(n, pa.list_(kinds[k[6:-1]]) if k.startswith("array<") else kinds[k]) for n, k in pairs])


def _rows(batches: Iterator[pa.RecordBatch], at_once: int = 256) -> Iterator[dict]:
    for b in batches:
        for at in range(0, b.num_rows, at_once):
            yield from b.slice(at, at_once).to_pylist()


def _in_batches(rows: Iterator[dict], ddl: str, most: int = 500, most_rows: int = 8_192) -> Iterator[pa.RecordBatch]:
    """Rows as batches; a segment counts as its rows."""
    schema, got, size = _arrow(ddl), [], 0
    for r in rows:
        got.append(r)
        size += r.get("n") or 1
        if len(got) >= most or size >= most_rows:
            yield _batch(got, schema)
            got, size = [], 0
    yield _batch(got, schema)


def segments(rows: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             size: int = SEGMENT, size_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """One row for each segment: its rows with their faults, counts, and either
    its solution (``whole``) or its matrix. The id is ``c``, as text, and ``nil``."""
    share_code(rows.sparkSession)
    base = rows.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("c"), F.col(f"`{id_col}`").isNull().alias("nil"),
        F.coalesce(F.col(f"`{turn}`").cast("long"), F.lit(0)).alias("t"), F.col(f"`{turn}`").cast("long").isNull().alias("no_t"),
        *[F.coalesce(F.col(f"`{n}`").cast("string"), F.lit(" ")).alias(a) for n, a in ((role, "r"), (text, "x"))])
    # Equal rows become one with a count, so that no key below is held by more than one row.
    keys = ["c", "nil", "t", "no_t", "r", "d"]
    once = base.withColumn("d", F.sha2("x", 256)).groupBy(*keys).agg(F.min("x").alias("x"), F.count(F.lit(1)).alias("copies"))
    first = once.groupBy("c", "nil", "r", "d").agg(F.max("no_t").alias("no_t"), F.min(F.when(~F.col("no_t"), F.col("t"))).alias("t"))
    first = first.select("c", "nil", F.when(F.col("no_t"), F.lit(0)).otherwise(F.col("t")).alias("t"), "no_t", "r", "d",
                         F.lit(True).alias("first"))
    order = ["nil", "c", "turn", "r", "start", "d"]
    marked = once.join(first, keys, "left").select(
        "c", "nil", F.when(~F.col("no_t"), F.col("t")).alias("turn"), "r", "x", "copies",
        F.coalesce("first", F.lit(False)).alias("first"), F.substring("x", 1, 64).alias("start"), "d")
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("start", "d")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, key, run, seg, held, weight, cut_before = TaskContext.get().partitionId(), None, -1, 0, [], 0, False
        for r in _rows(batches):
            if (r["c"], r["nil"]) != key:
                if held:
                    yield _segment(key, part, seg, run > 0 and not cut_before, held)
                    seg += 1
                key, run, held, weight, cut_before = (r["c"], r["nil"]), run + 1, [], 0, False
            for copy in range(r["copies"]):
                fault = fault_of(r["r"], r["x"], copy > 0 or not r["first"])
                kept = r["x"] if fault in (OK, TRUNCATED) else ""  # the others are deleted
                if held and (len(held) >= size or weight + len(kept) > size_bytes):
                    yield _segment(key, part, seg, False, held)
                    seg, held, weight, cut_before = seg + 1, [], 0, True
                held.append((r["turn"], r["r"], kept, fault))
                weight += len(kept)
        if held:  # its conversation may go on in the next task
            yield _segment(key, part, seg, False, held)

    return dealt.mapInArrow(lambda b: _in_batches(cut(b), _SEGMENT_SCHEMA), _SEGMENT_SCHEMA)


_WAYS = ["audits array<string>", "costs array<long>", "last boolean"]


def _by_conversation(rows: DataFrame, *columns, last_first: bool = False) -> DataFrame:
    place = [F.col(c).desc() if last_first else F.col(c) for c in ("part", "seg")]
    return rows.select("c", "nil", "part", "seg", *columns).repartition("c", "nil").sortWithinPartitions("c", "nil", *place)


def _ways(open_segments: DataFrame) -> DataFrame:
    """The segments of conversations that may be cut, each solved for all
    states that it may begin in."""

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, cost = None, []
        for r in _rows(batches):
            last = (r["c"], r["nil"]) != key
            if last:
                key, cost = (r["c"], r["nil"]), [c for c, _ in END]
            yield {"part": r["part"], "seg": r["seg"], "behind": cost, "last": last}
            m = r["step"]
            cost = [min(m[4 * s + t] + cost[t] for t in range(4)) for s in range(4)]

    ddl = "part int, seg int, behind array<long>, last boolean"
    behind = _by_conversation(open_segments, "step", last_first=True).mapInArrow(lambda b: _in_batches(back(b), ddl), ddl)
    joined = open_segments.drop("step", "cost", "audit", "digest").join(behind, ["part", "seg"])
    names = [f"{n} {t.replace('bigint', 'long')}" for n, t in joined.drop("behind", "last").dtypes]
    out = ", ".join([*names, *_WAYS])

    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for r in _rows(batches):
            costs = r.pop("behind")
            end = list(END) if r["last"] else [(c, "") for c in costs]
            found = solve([(role[:1], f) for role, f in zip(r["role"], r["fault"])], end)
            yield r | {"audits": [a for _, a in found], "costs": [c for c, _ in found]}

    return joined.mapInArrow(lambda b: _in_batches(ways(b), out), out)


_REPORT = "c string, nil boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, digest string"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Conversations from their segments, which come in order."""
    key, total = None, {}

    def done() -> dict:
        known = total["high"] is not None
        return {**{n: total[n] for n in ("c", "nil", "blank", "duplicate", "truncated", "illegal", "cost")},
                "gaps": total["high"] - total["low"] + 1 - total["turns"] if known else 0,
                "audit": "".join(total["audit"]), "digest": total["digest"].sha.hexdigest()}

    state = NOTHING
    for r in _rows(batches, 16):
        if (r["c"], r["nil"]) != key:
            if key is not None:
                yield done()
            key, state = (r["c"], r["nil"]), NOTHING
            total = {"c": r["c"], "nil": r["nil"], "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None,
                     "high": None, "tail": None, "cost": r["costs"][NOTHING], "audit": [], "digest": Digest()}
        for n in ("blank", "duplicate", "truncated", "illegal", "turns"):
            total[n] += r[n]
        if total["tail"] is not None:
            total["illegal"] += not legal(total["tail"], r["head"])
        if r["low"] is not None:
            total["turns"] -= total["high"] == r["low"]
            total["low"], total["high"] = r["low"] if total["low"] is None else total["low"], r["high"]
        total["tail"] = r["tail"]
        total["audit"].append(r["audits"][state])
        state, rows = apply_edits(r["audits"][state], state, r["role"], r["text"])
        total["digest"].add(rows)
    if key is not None:
        yield done()


@dataclass
class Repair:
    """Solved segments: ``closed`` ones hold a conversation each, ``ways`` are
    those of conversations over more than one (or at a task's border)."""

    closed: DataFrame
    ways: DataFrame
    id_col: str
    id_type: str

    def _named(self, rows: DataFrame, *columns) -> DataFrame:
        return rows.select(F.when(~F.col("nil"), F.col("c").cast(self.id_type)).alias(self.id_col), *columns)

    def report(self) -> DataFrame:
        """Per conversation: the id, gaps (missing turns between its least and
        largest), blank, duplicate, truncated, illegal (adjacent roles), cost,
        audit (letters of all edits) and digest (SHA-256 of the repaired rows).
        A conversation's audit is one string, and SHA-256 one chain, so a cut
        conversation's segments pass one task, one after the other."""
        gaps = F.when(F.col("high").isNotNull(), F.col("high") - F.col("low") + 1 - F.col("turns")).otherwise(F.lit(0))
        columns = ["blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]
        closed = self.closed.select("c", "nil", gaps.alias("gaps"), *columns)
        cut = _by_conversation(self.ways, *[c for c in self.ways.columns if c not in ("c", "nil", "part", "seg")]).mapInArrow(
            lambda b: _in_batches(_walk(b), _REPORT), _REPORT)
        return self._named(closed.unionByName(cut), "gaps", *columns)

    def rows(self) -> DataFrame:
        """The repaired rows: the id, part, seg and place (their order within
        the conversation), role, text and the letter of the edit."""
        ddl = "part int, seg int, state int"

        def states(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            key, state = None, NOTHING
            for r in _rows(batches, 16):
                if (r["c"], r["nil"]) != key:
                    key, state = (r["c"], r["nil"]), NOTHING
                yield {"part": r["part"], "seg": r["seg"], "state": state}
                state = apply_edits(r["audits"][state], state, r["role"], [""] * len(r["role"]))[0]

        begun = _by_conversation(self.ways, "role", "audits").mapInArrow(lambda b: _in_batches(states(b), ddl), ddl)
        picked = self.ways.join(begun, ["part", "seg"]).withColumn("audit", F.element_at("audits", F.col("state") + 1))
        columns = ["c", "nil", "part", "seg", "state", "audit", "role", "text"]
        every = self.closed.withColumn("state", F.lit(NOTHING)).select(*columns).unionByName(picked.select(*columns))
        out = "c string, nil boolean, part int, seg int, place int, role string, text string, edit string"

        def left(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
            for r in _rows(batches, 16):
                for n, (role, text, letter) in enumerate(apply_edits(r["audit"], r["state"], r["role"], r["text"])[1]):
                    yield {**{k: r[k] for k in ("c", "nil", "part", "seg")}, "place": n, "role": role, "text": text, "edit": letter}

        return self._named(every.mapInArrow(lambda b: _in_batches(left(b), out), out), "part", "seg", "place", "role", "text", "edit")


def repair(rows: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           size: int = SEGMENT, size_bytes: int = SEGMENT_BYTES) -> Repair:
    found = materialise(segments(rows, id_col, turn, role, text, size, size_bytes), "conversation-segments")
    ways = materialise(_ways(found.where(~F.col("whole"))), "conversation-ways")
    return Repair(found.where("whole"), ways, id_col, rows.schema[id_col].dataType.simpleString())


def damage(rows: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with planted faults, by crc32(``id:turn``) mod 20: 0 drops the row,
    1 empties its text, 2 takes out its full stops, exclamation and question
    marks, 3 repeats it, 4 makes its role user. Nulls count as one space (the
    id and the turn only in the hash)."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", filled(id_col), filled(turn))) % 20
    words = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(filled(text), ".!?", "")).otherwise(filled(text))
    whole = rows.where(kind != 0).select(
        F.col(f"`{id_col}`").alias(id_col), F.col(f"`{turn}`").alias(turn),
        F.when(kind == 4, F.lit("user")).otherwise(filled(role)).alias(role), words.alias(text),
        F.when(kind == 3, F.lit(2)).otherwise(F.lit(1)).alias("__copies"))
    return whole.withColumn("__copies", F.explode(F.array_repeat(F.lit(0), F.col("__copies")))).drop("__copies")
