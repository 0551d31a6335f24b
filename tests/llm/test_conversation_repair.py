"""Conversation repair against a search over all short edit sequences."""

import hashlib
import heapq
import random
import re
import zlib

from helpers import rows_of, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from daypulse.llm import conversation_repair as cr

SF = "/root/testdata/sf0.001"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        visible = VISIBLE.findall(text)
        out.append("blank" if not visible else "duplicate" if (role, text) in seen else
                   "truncated" if visible[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, bad):
    """The least (cost, audit, repaired) by best-first search over whole audits."""
    heap, done = [(0, "", 0, "")], set()
    best = None
    while heap:
        cost, audit, at, initials = heapq.heappop(heap)
        if best and (cost, audit) > best[:2]:
            break
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            best = min(best or (cost, audit), (cost, audit))
            continue
        state = "" if not initials else initials[-1]
        if (at, state, audit) in done or (best and cost >= best[0]):
            continue
        done.add((at, state, audit))
        then = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 2, audit + "I", at, initials + then))
        if at < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, initials))
            if bad[at] not in ("blank", "duplicate"):
                more = int(bad[at] == "truncated")
                heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, initials + then))
                own = rows[at][1][:1]
                if own == then or (own == "s" and not initials):
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, initials + own))
    return best


def repaired(rows, audit):
    out, at = [], 0
    for letter in audit:
        then = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if letter == "I":
            out.append((then, ""))
            continue
        if letter in "KR":
            out.append((rows[at][1] if letter == "K" else then, rows[at][2]))
        at += 1
    assert at == len(rows)
    return out


def report(rows):
    """One conversation's row, without its id; rows are (turn, role, text), in order."""
    bad = faults(rows)
    cost, audit = cheapest(rows, bad)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, bad.count("blank"), bad.count("duplicate"),
            bad.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired(rows, audit)).encode()).hexdigest())


def ordered(rows):
    """Rows of one conversation in order, nulls as one space."""
    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.sha256(r[2].encode()).hexdigest()))


def expected(rows):
    by = {}
    for c, *r in rows:
        by.setdefault(c, []).append(tuple(r))
    return sorted(((c, *report(ordered(own))) for c, own in by.items()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("sua-"), st.sampled_from(range(4))), max_size=6))
def test_integer_weights_equal_the_search(items):
    names = {"s": "system", "u": "user", "a": "assistant", "-": "tool"}
    rows = [(n, names[c], "") for n, (c, _) in enumerate(items)]
    bad = [("", "blank", "duplicate", "truncated")[f] for _, f in items]
    assert cr.solve(items, list(cr.END))[cr.NOTHING] == cheapest(rows, bad)


def test_matrix_and_cut_solutions_equal_the_whole():
    r = random.Random(8)
    for _ in range(200):
        items = [(r.choice("suua-a"), r.choice((0, 0, 0, 1, 2, 3))) for _ in range(r.randrange(2, 30))]
        whole = cr.solve(items, list(cr.END))
        cuts = sorted(r.sample(range(1, len(items)), min(len(items) - 1, r.randrange(1, 4))))
        parts = [items[i:j] for i, j in zip([0, *cuts], [*cuts, len(items)])]
        behind, found = [c for c, _ in cr.END], []
        for n, part in enumerate(reversed(parts)):
            found.append(cr.solve(part, list(cr.END) if not n else [(c, "") for c in behind]))
            m = cr.matrix(part)
            behind = [min(m[4 * s + t] + behind[t] for t in range(4)) for s in range(4)]
        for begin in range(4):
            state, audit = begin, ""
            for part, ways in zip(parts, reversed(found)):
                audit += ways[state][1]
                state = cr.apply_edits(ways[state][1], state, [{"-": "tool"}.get(c, c) for c, _ in part], [""] * len(part))[0]
            assert (behind[begin], audit) == whole[begin]


TEXTS = ["Yes.", "No!", "why", "", " \t", "Yes.", "a longer text, cut", "Fin. "]


def some_rows(seed, n_conversations, most):
    r = random.Random(seed)
    rows = []
    for c in range(n_conversations):
        for t in range(r.randrange(1, most)):
            rows.append((c, r.choice([t, t, t, t + 2, None]), r.choice(["system", "user", "user", "assistant", "assistant", "tool", None]),
                         r.choice([*TEXTS, f"text {t}.", f"text {t}.", None])))
    return rows


def test_report_and_rows_equal_the_search_however_they_are_cut(spark):
    rows = some_rows(1, 40, 8)
    rows += [(None, 0, "user", "hello."), (None, 1, None, None), (7_000, None, None, None)]
    rows += [rows[0], rows[0], (3, 4, "user", "z" * 300 + "."), (3, 4, "user", "z" * 300 + "!")]
    want = expected(rows)
    df = spark.createDataFrame(rows, ROWS)
    for size, table in ((1024, df), (2, with_clashes(df).repartition(4)), (1, df)):
        found = cr.repair(table, size=size)
        assert rows_of(found.report().select(*COLUMNS)) == want
        own = {}
        for x in sorted(found.rows().collect(), key=lambda x: (x.part, x.seg, x.place)):
            own.setdefault(x.conv_id, []).append((x.role, x.text))
        for c, *_, audit, digest in want:
            text = "\n".join(f"{r}:{t}" for r, t in own.get(c, []))
            assert hashlib.sha256(text.encode()).hexdigest() == digest


def test_long_conversation_with_many_copies(spark):
    """A third of all rows in one conversation, many of them alike: cut over tasks."""
    rows = some_rows(3, 30, 8) + [(99, t // 2, ("user", "assistant")[t % 2], f"say {t}.") for t in range(400)]
    rows += [(99, 3, "user", "again.")] * 150
    own = ordered([r[1:] for r in rows if r[0] == 99])
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    got = {r.conv_id: r for r in cr.repair(df, size=16, size_bytes=200).report().collect()}
    bad = faults(own)
    cost, audit = cr.solve([(r[:1], ("", "blank", "duplicate", "truncated").index(f)) for (_, r, _), f in zip(own, bad)],
                           list(cr.END))[cr.NOTHING]
    assert (got[99].cost, got[99].audit, got[99].duplicate) == (cost, audit, 149)
    assert got[99].digest == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired(own, audit)).encode()).hexdigest()
    assert rows_of(spark.createDataFrame([tuple(got[c]) for c in got if c != 99], cr.repair(df).report().schema).select(*COLUMNS)) == \
        expected([r for r in rows if r[0] != 99])


def damaged(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (c, t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out += [] if kind == 0 else [row] * (2 if kind == 3 else 1)
    return out


def test_query(spark):
    got = entry.queries()["op12_conversation_repair"](spark, SF)
    assert got.columns == [*COLUMNS[:-1], "repaired_sha256"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    want = {w[0]: w for w in expected(damaged(rows))}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert rows_of(got) == sorted((want.get(c, (c, *empty)) for c in {r[0] for r in rows}), key=repr)


def test_damage_and_empty_table(spark):
    rows = some_rows(5, 60, 8) + [(None, None, None, None)]
    df = spark.createDataFrame(rows, ROWS)
    assert rows_of(cr.damage(with_clashes(df))) == sorted(damaged(rows), key=repr)
    found = cr.repair(df.limit(0))
    assert found.report().collect() == [] and found.rows().collect() == []
