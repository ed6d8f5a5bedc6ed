import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_repair as C

SPACE = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """Every edit sequence of a few rows, the whole audits compared: (cost, audit, states)."""
    best = None
    stack = [(0, 0, 0, "", ())]
    while stack:
        i, q, cost, audit, states = stack.pop()
        if i == len(rows) and q in (0, 3):
            best = min(best or (cost, audit, states), (cost, audit, states))
        if cost > 3 * len(rows):
            continue
        if audit[-2:] != "II":
            nxt = 3 if q == 2 else 2
            stack.append((i, nxt, cost + 2, audit + "I", states + (nxt,)))
        if i < len(rows):
            initial, fault = rows[i]
            stack.append((i + 1, q, cost + 3, audit + "D", states + (q,)))
            if fault in (0, C.TRUNCATED):
                late = fault == C.TRUNCATED
                keep = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(q)
                if keep:
                    stack.append((i + 1, keep, cost + late, audit + "K", states + (keep,)))
                nxt = 3 if q == 2 else 2
                stack.append((i + 1, nxt, cost + 2 + late, audit + "R", states + (nxt,)))
    return best


def test_trace_is_the_cheapest_with_the_least_audit():
    kinds = list(itertools.product("sua-", (0, 1, 3)))
    rng = random.Random(3)
    cases = [[k] for k in kinds] + [list(x) for x in itertools.product(kinds, repeat=2)] + [[rng.choice(kinds) for _ in range(5)] for _ in range(150)]
    for rows in [[], *cases]:
        edits = C.trace(rows, 0, None)
        cost, audit, states = cheapest(rows)
        assert (C.cost_of(rows, edits), "".join(c for c, _ in edits), tuple(s for _, s in edits)) == (cost, audit, states), rows


def test_runs_compose_to_the_same_edits_wherever_they_are_cut():
    kinds = list(itertools.product("sua-", (0, 1, 2, 3)))
    rng = random.Random(4)
    for _ in range(60):
        rows = [rng.choice(kinds) for _ in range(rng.randint(1, 40))]
        cuts = sorted(rng.choices(range(len(rows) + 1), k=4))
        runs = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        states = C.borders([C.part_of(r, [None] * len(r)) for r in runs], 0, None)
        edits = [e for r, (p, q) in zip(runs, states) for e in C.trace(r, p, q)]
        whole = C.trace(rows, 0, None)
        assert edits == whole[:len(edits)] and {c for c, _ in whole[len(edits):]} <= {"I"}


def brute(conversations):
    """The query's rows from (conv_id, turn, role, text) by plain Python."""
    out, groups = [], {}
    for conv, turn, role, text in conversations:
        rows = groups.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            row = (turn, "user" if kind == 4 else role,
                   "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text)
            rows += [row] * (2 if kind == 3 else 1)
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:64], r[2][:64], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, coded = set(), []
        for _, role, text in rows:
            bare = text.rstrip(SPACE)
            fault = C.BLANK if not bare else C.DUPLICATE if (role, text) in seen else C.TRUNCATED if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            coded.append((role[:1] if role[:1] in tuple("sua") else "-", fault))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[0] + b[0] for a, b in zip(coded, coded[1:])]
        # plain dynamic programme with whole audits
        path = {0: (0, "", ())}
        for (initial, fault), (_, role, text) in zip(coded, rows):
            new = {}
            for q, (cost, audit, lines) in path.items():
                x, added, extra = q, "", ()
                for _ in range(3):
                    nxt = 3 if x == 2 else 2
                    name = {2: "user", 3: "assistant"}[nxt]
                    options = [("D", x, 3, ())]
                    if fault in (0, C.TRUNCATED):
                        late = fault == C.TRUNCATED
                        keep = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(x)
                        options += [("R", nxt, 2 + late, (f"{name}:{text}",))] + ([("K", keep, late, (f"{role}:{text}",))] if keep else [])
                    for letter, to, more, line in options:
                        got = (cost + 2 * len(added) + more, audit + added + letter, lines + extra + line)
                        new[to] = min(new.get(to, got), got)
                    x, added, extra = nxt, added + "I", (*extra, f"{name}:")
            path = new
        ends = []
        for q, (cost, audit, lines) in path.items():
            more = {0: (), 1: ("user:", "assistant:"), 2: ("assistant:",), 3: ()}[q]
            ends.append((cost + 2 * len(more), audit + "I" * len(more), lines + more))
        cost, audit, lines = min(ends)
        out.append((conv, gaps, *(sum(f == k for _, f in coded) for k in (1, 2, 3)), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def rows(n=25):
    rng = random.Random(8)
    texts = ["Fine.", "Open", "ok!", " ", "", "Why? \n", "Same words.", None, "x" * 300, " ", "..", "a\x00b?"]
    roles = ["system", "user", "assistant", "tool", "", None, "u", "User"]
    out = [(c, rng.choice([t, t, t, t + 1, None]), rng.choice(roles[:3] + [rng.choice(roles)]), rng.choice(texts))
           for c in range(n) for t in range(rng.randint(1, 12))]
    out += [(None, t, "user" if t % 2 == 0 else "assistant", f"Null {t}.") for t in range(7)] + [(None, None, None, None)]
    out += [(100, t, ("user", "assistant")[t % 2], f"Turn {t % 90}.") for t in range(300)]       # one long conversation
    out += [(101, 0, "user", "Again.")] * 60
    drop = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return out + [(drop, 0, "user", "All of it goes.")]


@pytest.mark.parametrize("kw", [{}, {"chunk_rows": 3, "fan": 4}, {"chunk_bytes": 40, "fan": 100}])
def test_query_equals_brute_force(llm, kw):
    data = rows()
    df = llm.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumns(
        {c: F.lit("clash") for c in ("ord", "part", "seq", "copies", "fault", "digest", "kind", "p", "q", "new")}).repartition(5)
    pieces = C.repair(C.damaged(C.rows_of(df)), **kw)
    assert sorted((tuple(r) for r in C.summary(pieces).collect()), key=str) == brute(data)


def test_rows_and_empty_table(llm):
    df = llm.createDataFrame([(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    pieces = C.repair(C.rows_of(df))
    got = [(r.role, r.text) for r in C.repaired_rows(pieces).orderBy("ord", "place").collect()]
    assert got == [("user", ""), ("assistant", "Hello."), ("user", "Hi."), ("assistant", "")]
    assert [(r.cost, r.audit) for r in pieces.collect()] == [(4, "IKKI")]          # RR costs 4, too
    none = C.summary(C.repair(C.damaged(C.rows_of(df.limit(0)))))
    assert none.collect() == [] and none.columns[-1] == "repaired_sha256"
