"""Conversation structure repair by Hirschberg's divide and conquer over four states.

A repaired conversation reads ``(s?(ua)+)?`` in its roles' initials (system, user, assistant).  The states are
0 nothing yet, 1 after system, 2 after user, 3 after assistant; 0 and 3 are complete.  Edits: ``K`` keep
(costs 0), ``R`` rerole to user or assistant (2), ``D`` delete (3; required for blank and duplicate rows), ``I`` insert an
empty user or assistant row (2); a truncated row that stays adds 1.

``trace`` finds the cheapest edits with the least audit (the edits' letters in order): forward cost vectors from the left
and backward ones from the right meet in the middle, the crossing state with the least total and, among those, the least audit
is fixed, and both halves are solved alone.  A forward vector holds the *rank* of each state's audit beside its cost.
Audits that end with the same row's letter are never prefixes of each other, so the rank decides whatever
follows, and no audit is ever held for a comparison: space is linear in the rows.

On Spark a conversation may hold a third of all rows.  Rows are ranged by (conversation, turn, ...), so its rows are spread over tasks;
each task cuts its part into chunks of bounded size.  A conversation within one chunk (nearly all) is solved
there.  Chunks of the others give 4 x 4 matrices of costs and ranks, which compose associatively, ``FAN`` at
a time; the states at the chunks' borders come back down the same tree, and each chunk is traced alone.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

CHUNK_ROWS = 4096
CHUNK_BYTES = 4 << 20
FAN = 256                                      # matrices composed in one group
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3          # a row's first fault; 0 is none
SPACE = "\t\n\x0b\x0c\r "
INF = 1 << 60
STATES = range(4)
START, FINAL = 0, (0, 4, 2, 0)                 # cost of the inserts that complete a state
_KEEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_NEXT = (2, 2, 3, 2)                           # where a user or assistant row leads
_ROLE = {2: "user", 3: "assistant"}
Row = tuple[str, int]                          # a role's initial (other than s, u, a: ``-``) and the row's fault


@lru_cache(maxsize=4096)
def moves(row: Row) -> tuple[tuple[int, int, int, str], ...]:
    """``(state, next state, cost, letters)`` of the useful inserts before a row and its edit."""
    initial, fault = row
    out = []
    for q in STATES:
        x = q
        for k in range(3):
            out.append((q, x, 2 * k + 3, "I" * k + "D"))
            if fault not in (BLANK, DUPLICATE):
                late = 1 if fault == TRUNCATED else 0
                if (initial, x) in _KEEP:
                    out.append((q, _KEEP[initial, x], 2 * k + late, "I" * k + "K"))
                out.append((q, _NEXT[x], 2 * k + 2 + late, "I" * k + "R"))
            x = _NEXT[x]
    return tuple(out)


Vector = tuple[tuple[int, int], ...]           # per state: cost above the least one, rank of its audit


def origin(state: int) -> Vector:
    return tuple((0, 0) if q == state else (INF, 0) for q in STATES)


@lru_cache(maxsize=1 << 16)
def _forward(row: Row, vector: Vector) -> tuple[int, Vector]:
    best: dict = {}
    for q, to, cost, letters in moves(row):
        if vector[q][0] < INF:
            key = (vector[q][0] + cost, vector[q][1], letters)
            best[to] = min(best.get(to, key), key)
    return _normal(best)


def _normal(best: dict) -> tuple[int, Vector]:
    """``best`` has (cost, then what orders audits) per reached state."""
    least = min(v[0] for v in best.values())
    order = {q: i for i, q in enumerate(sorted(best, key=lambda q: best[q][1:]))}
    return least, tuple((best[q][0] - least, order[q]) if q in best else (INF, 0) for q in STATES)


def forward(rows: list[Row], lo: int, hi: int, vector: Vector) -> tuple[int, Vector]:
    base = 0
    for row in rows[lo:hi]:
        more, vector = _forward(row, vector)
        base += more
    return base, vector


@lru_cache(maxsize=1 << 16)
def _backward(row: Row, vector: tuple[int, ...]) -> tuple[int, ...]:
    out = [INF] * 4
    for q, to, cost, _ in moves(row):
        out[q] = min(out[q], cost + vector[to])
    least = min(out)
    return tuple(min(INF, c - least) if c < INF else INF for c in out)


def backward(rows: list[Row], lo: int, hi: int, vector: tuple[int, ...]) -> tuple[int, ...]:
    """Costs from each state before row ``lo`` to the end, above the least one."""
    for i in range(hi - 1, lo - 1, -1):
        vector = _backward(rows[i], vector)
    return vector


def crossing(ahead: Vector, behind: tuple[int, ...]) -> int:
    """The state of the least total cost; of those the one whose audit so far is least."""
    return min((c + b, rank, q) for q, ((c, rank), b) in enumerate(zip(ahead, behind)) if c < INF and b < INF)[2]


def trace(rows: list[Row], start: int, end: int | None) -> list[tuple[str, int]]:
    """The edits as (letter, state after it).  ``end`` is the state right after the last row's
    edit, or None where the conversation ends here; then completing inserts follow."""
    out: list[tuple[str, int]] = []
    if end is None:
        end = crossing(forward(rows, 0, len(rows), origin(start))[1], FINAL)
        tail = FINAL[end] // 2
    else:
        tail = 0

    def solve(lo: int, hi: int, p: int, q: int) -> None:
        if hi - lo == 1:
            _, letters = min((cost, letters) for at, to, cost, letters in moves(rows[lo]) if at == p and to == q)
            x = p
            for c in letters[:-1]:
                x = _NEXT[x]
                out.append((c, x))
            out.append((letters[-1], q))
        elif hi > lo:
            mid = (lo + hi) // 2
            r = crossing(forward(rows, lo, mid, origin(p))[1],
                         backward(rows, mid, hi, tuple(0 if s == q else INF for s in STATES)))
            solve(lo, mid, p, r)
            solve(mid, hi, r, q)
    solve(0, len(rows), start, end)
    for _ in range(tail):
        end = _NEXT[end]
        out.append(("I", end))
    return out


def cost_of(rows: list[Row], edits: list[tuple[str, int]]) -> int:
    at, total = iter(rows), 0
    for letter, _ in edits:
        total += {"K": 0, "R": 2, "D": 3, "I": 2}[letter]
        if letter != "I":
            fault = next(at)[1]
            total += letter != "D" and fault == TRUNCATED
    return total


class Part(NamedTuple):
    """What a run of consecutive rows contributes; ``join`` is associative."""
    rows: int
    matrix: list                               # per start state: (base, Vector) right after the last row's edit
    first: str
    last: str
    illegal: int
    counts: tuple                              # blank, duplicate, truncated
    low: int | None
    high: int | None
    distinct: int                              # turns that are not null
    first_turn: int | None
    last_turn: int | None


_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def part_of(rows: list[Row], turns: list) -> Part:
    known = [t for t in turns if t is not None]
    return Part(len(rows), [forward(rows, 0, len(rows), origin(p)) for p in STATES],
                rows[0][0] if rows else "", rows[-1][0] if rows else "",
                sum(pair not in _LEGAL for pair in zip((r[0] for r in rows), (r[0] for r in rows[1:]))),
                tuple(sum(f == kind for _, f in rows) for kind in (BLANK, DUPLICATE, TRUNCATED)),
                min(known, default=None), max(known, default=None), len(set(known)),
                turns[0] if turns else None, turns[-1] if turns else None)


def join(a: Part, b: Part) -> Part:
    if not a.rows or not b.rows:
        return b if not a.rows else a
    known = [x for x in (a.low, a.high, b.low, b.high) if x is not None]
    same = a.last_turn is not None and a.last_turn == b.first_turn
    return Part(a.rows + b.rows, [_through(a.matrix[p], b.matrix)[0] for p in STATES], a.first, b.last,
                a.illegal + b.illegal + ((a.last, b.first) not in _LEGAL), tuple(x + y for x, y in zip(a.counts, b.counts)),
                min(known, default=None), max(known, default=None), a.distinct + b.distinct - same, a.first_turn, b.last_turn)


def _through(ahead: tuple[int, Vector], matrix: list) -> tuple[tuple[int, Vector], dict]:
    """A forward vector carried over a run, and for each end state the state before the run."""
    base, vector = ahead
    best: dict = {}
    for r in STATES:
        if vector[r][0] < INF:
            more, row = matrix[r]
            for q in STATES:
                if row[q][0] < INF:
                    key = (vector[r][0] + more + row[q][0], vector[r][1], row[q][1], r)
                    best[q] = min(best.get(q, key), key)
    least, out = _normal(best)
    return (base + least, out), {q: key[3] for q, key in best.items()}


def borders(parts: list[Part], start: int, end: int | None) -> list[tuple[int, int | None]]:
    """(state before, state after) of each run between ``start`` and ``end``; the last run's ``None`` stays where ``end`` is."""
    live = [i for i, x in enumerate(parts) if x.rows]
    ahead, back = (0, origin(start)), []
    for i in live:
        ahead, came = _through(ahead, parts[i].matrix)
        back.append(came)
    state = crossing(ahead[1], FINAL) if end is None and live else start if end is None else end
    after: dict = {}
    for i, came in zip(reversed(live), reversed(back)):
        after[i] = (came[state], state)
        state = came[state]
    out, now = [], start
    for i in range(len(parts)):
        p, q = after.get(i, (now, now))
        out.append((p, q))
        now = q
    return out


# --- Spark ------------------------------------------------------------------------------------------

_CHUNK = ("conv_id long, part int, seq int, open boolean, turns array<long>, roles array<string>, texts array<string>, "
          "faults binary, digests binary")
_PART = ("rows long, base array<long>, costs array<long>, ranks array<int>, first string, last string, illegal long, "
         "blank long, duplicate long, truncated long, low long, high long, distinct long, first_turn long, last_turn long")
_TRACED = ("conv_id long, ord long, pieces long, gaps long, blank long, duplicate long, truncated long, illegal long, "
           "cost long, audit string, lines array<struct<role:string,text:string>>")


def rows_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copies``: null role and text are one space; a row counts ``copies`` times (1 here)."""
    return conversations.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), F.lit(1).alias("copies"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows_of`` output with every row damaged by its key: dropped (``copies`` 0, kept as a mark of its
    conversation), emptied, without sentence ends, repeated, or given the role user.  A null part of the key is one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    return rows.withColumn("kind", kind).select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in order of conversation and turn over all partitions.

    Rows of one turn follow by role, text and a digest of both.  Equal rows may be parted by a random
    number: their order does not matter, and a row that is repeated without end is spread over tasks.
    """
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    bare = F.rtrim("text", F.lit(SPACE))
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    keyed = rows.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"), digest.alias("digest"),
                        F.left("role", F.lit(64)).alias("r64"), F.left("text", F.lit(64)).alias("t64"), F.rand(11).alias("salt"))
    order = ["conv_id", "turn", "r64", "t64", "digest", "salt"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("r64", "t64", "salt")


def _chunks(rows_most: int, bytes_most: int):
    """Arrow batches of ordered rows to chunks.  ``open``: the conversation may have further chunks."""
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("open", pa.bool_()), ("turns", pa.list_(pa.int64())),
                        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("faults", pa.binary()), ("digests", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held, size = ([], [], [], [], []), 0
        conv, first, several, begun = None, True, False, False
        ready: list = []

        def close(open_: bool) -> None:
            nonlocal seq, size
            ready.append((conv, part, seq, open_, list(held[0]), list(held[1]), list(held[2]), bytes(held[3]), b"".join(held[4])))
            seq, size = seq + 1, 0
            for h in held:
                h.clear()

        def batch() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), schema.types)], schema=schema)
            ready.clear()
            return got
        weight = 0
        for b in batches:
            for c, turn, role, text, copies, fault, digest in zip(*(x.to_pylist() for x in b.columns)):
                if not begun or c != conv:
                    if begun:
                        close(first or several)
                        first = False
                    conv, several, begun = c, False, True
                for _ in range(copies):
                    if len(held[0]) >= rows_most or size >= bytes_most:
                        several = True
                        close(True)
                    for h, v in zip(held, (turn, role, text, fault, digest)):
                        h.append(v)
                    size += len(text)
                    weight += len(text) + 64
                if weight > bytes_most and ready:
                    yield batch()
                    weight = size
        if begun:
            close(True)
        if ready:
            yield batch()
    return run


def _initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") and role else "-"


def _codes(roles: list, faults: bytes, new) -> list[Row]:
    """Rows of a chunk; ``new[i]`` tells whether role and text are first seen there."""
    return [(_initial(r), DUPLICATE if f != BLANK and not n else f) for r, f, n in zip(roles, faults, new)]


def _first_seen(digests: bytes) -> list[bool]:
    seen: set = set()
    out = []
    for i in range(0, len(digests), 16):
        d = digests[i:i + 16]
        out.append(d not in seen)
        seen.add(d)
    return out


def _part_columns(parts: list[Part]) -> list[pa.Array]:
    cols = [(x.rows, [m[0] for m in x.matrix], [c for m in x.matrix for c, _ in m[1]], [r for m in x.matrix for _, r in m[1]], x.first, x.last,
             x.illegal, *x.counts, x.low, x.high, x.distinct, x.first_turn, x.last_turn) for x in parts]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string(), pa.string(), *[pa.int64()] * 9]
    return [pa.array([c[i] for c in cols], t) for i, t in enumerate(types)]


_PART_NAMES = [c.split()[0] for c in _PART.split(", ")]


def _part_from(r: dict) -> Part:
    cells = list(zip(r["costs"], r["ranks"]))
    matrix = [(r["base"][p], tuple(cells[4 * p:4 * p + 4])) for p in STATES]
    return Part(r["rows"], matrix, r["first"], r["last"], r["illegal"], (r["blank"], r["duplicate"], r["truncated"]),
                r["low"], r["high"], r["distinct"], r["first_turn"], r["last_turn"])


def _sorted_rows(t: pa.Table) -> list[dict]:
    return t.sort_by("ord").to_pylist()


def _compose(key: tuple, t: pa.Table) -> pa.Table:
    """One run for all of a group; ``key`` is (conversation, place in the next level)."""
    rows = _sorted_rows(t)
    whole = _part_from(rows[0])
    for r in rows[1:]:
        whole = join(whole, _part_from(r))
    return pa.Table.from_arrays([pa.array([rows[0]["conv_id"]], pa.int64()), pa.array([key[1].as_py()], pa.int64()),
                                 *_part_columns([whole])], names=["conv_id", "ord", *_PART_NAMES])


def _descend(t: pa.Table) -> pa.Table:
    """Border states of a group's runs from those of the whole group (columns ``p``, ``q`` of every row; null ``q``: its end)."""
    rows = _sorted_rows(t)
    got = borders([_part_from(r) for r in rows], rows[0]["p"], rows[0]["q"])
    return pa.Table.from_arrays([pa.array([r["conv_id"] for r in rows], pa.int64()), pa.array([r["ord"] for r in rows], pa.int64()),
                                 pa.array([p for p, _ in got], pa.int32()), pa.array([q for _, q in got], pa.int32())],
                                names=["conv_id", "ord", "p", "q"])


def _gaps(x: Part) -> int:
    return 0 if x.low is None else min(x.high - x.low + 1 - x.distinct, (1 << 63) - 1)


_LINE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _solved(roles: list, texts: list, rows: list[Row], start: int, end: int | None) -> tuple[int, str, list]:
    edits, at, lines = trace(rows, start, end), 0, []
    for letter, state in edits:
        if letter == "I":
            lines.append({"role": _ROLE[state], "text": ""})
            continue
        if letter != "D":
            lines.append({"role": roles[at] if letter == "K" else _ROLE[state], "text": texts[at]})
        at += 1
    return cost_of(rows, edits), "".join(c for c, _ in edits), lines


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks (with ``ord, pieces, new, p, q``; null ``new``: a whole conversation) to their repaired rows."""
    types = [*[pa.int64()] * 9, pa.string(), _LINE]
    names = [c.split()[0] for c in _TRACED.split(", ")[:-1]] + ["lines"]
    for b in batches:
        out = []
        for r in b.to_pylist():
            whole = r["new"] is None
            seen = set(r["new"] or ())
            new = _first_seen(r["digests"]) if whole else [i in seen for i in range(len(r["roles"]))]
            rows = _codes(r["roles"], r["faults"], new)
            x = part_of(rows, r["turns"]) if whole else None
            tail = r["ord"] + 1 == r["pieces"]
            cost, audit, lines = _solved(r["roles"], r["texts"], rows, r["p"], None if whole else r["q"])
            if tail and not whole:             # the chunks' borders stop right after the last row's edit
                state = r["q"]
                for _ in range(FINAL[state] // 2):
                    state = _NEXT[state]
                    lines.append({"role": _ROLE[state], "text": ""})
                    audit, cost = audit + "I", cost + 2
            out.append((r["conv_id"], r["ord"], r["pieces"], *((_gaps(x), *x.counts, x.illegal) if whole else (None,) * 5), cost, audit, lines))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)


def repair(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """Repaired conversations in pieces: ``conv_id, ord, pieces, gaps, blank, duplicate, truncated, illegal, cost, audit, lines``.

    ``rows`` is as from ``rows_of``.  Nearly every conversation is one row (``ord`` 0 of ``pieces`` 1) and its counts; of one with several
    pieces each row has its own cost, audit and lines, and the counts, of the whole, are on piece 0 (null on the others).
    Rows are ordered by turn, nulls first, rows of one turn by role and text (64 characters of each, then a digest of both).  A
    null ``conv_id`` is a conversation of its own.  A conversation whose rows all have ``copies`` 0 gives zeros, an
    empty audit and no lines.  Role and text of one space (null) are blank.  Gaps are counted over the turns that are not null, at most 2**63 - 1.
    Very long texts stay whole, in chunks of at most ``chunk_bytes`` characters plus one row.  An empty table gives no rows;
    other columns of the input are not read, whatever their names.
    """
    chunks = stage(_ordered(rows).mapInArrow(_chunks(chunk_rows, chunk_bytes), _CHUNK), "chunks")
    solo = (chunks.where("NOT open").withColumn("ord", F.lit(0).cast("long")).withColumn("pieces", F.lit(1).cast("long"))
            .withColumn("new", F.lit(None).cast("array<int>")).withColumn("p", F.lit(START)).withColumn("q", F.lit(None).cast("int")))
    # Which chunks belong together: the narrow columns only.
    of = Window.partitionBy("conv_id")
    numbered = (chunks.where("open").select("conv_id", "part", "seq")
                .withColumn("ord", F.row_number().over(of.orderBy("part", "seq")).cast("long") - 1)
                .withColumn("pieces", F.count(F.lit(1)).over(of)))
    places = stage(numbered, "places")
    opened = stage(chunks.where("open").join(places.drop("conv_id"), ["part", "seq"]), "open_chunks")
    # First places of role and text over a conversation's chunks, from digests.
    firsts = (opened.select("conv_id", "ord", F.posexplode(F.expr(
                  "transform(sequence(0, greatest(size(roles) - 1, 0)), i -> substring(digests, i * 16 + 1, 16))")).alias("i", "digest"))
              .where("length(digest) = 16").groupBy("conv_id", "digest").agg(F.min(F.expr("ord * 1048576L + i")).alias("at"))
              .groupBy("conv_id", F.expr("at div 1048576").alias("ord")).agg(F.collect_list(F.expr("CAST(at % 1048576 AS INT)")).alias("new")))
    first, other = firsts.alias("f"), opened.alias("o")
    known = stage(other.join(first, F.col("o.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("o.ord") == F.col("f.ord")), "left")
                  .select("o.*", F.coalesce("f.new", F.array().cast("array<int>")).alias("new")), "known")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rs = b.to_pylist()
            if rs:
                parts = [part_of(_codes(r["roles"], r["faults"], [i in seen for i in range(len(r["roles"]))]), r["turns"])
                         for r in rs for seen in (set(r["new"]),)]
                yield pa.RecordBatch.from_arrays([pa.array([r["conv_id"] for r in rs], pa.int64()), pa.array([r["ord"] for r in rs], pa.int64()),
                                                  *_part_columns(parts)], names=["conv_id", "ord", *_PART_NAMES])
    levels = [stage(known.select("conv_id", "ord", "turns", "roles", "faults", "new").mapInArrow(
        measure, f"conv_id long, ord long, {_PART}"), "level")]
    while (levels[-1].agg(F.max("ord")).first()[0] or 0) > 0:
        levels.append(stage(levels[-1].groupBy("conv_id", F.expr(f"ord div {fan}").alias("up"))
                            .applyInArrow(_compose, f"conv_id long, ord long, {_PART}"), "level"))
    whole = levels[-1]
    states = whole.select("conv_id", "ord", F.lit(START).alias("p"), F.lit(None).cast("int").alias("q"))
    for level in reversed(levels):
        up, down = states.alias("s"), level.alias("l")
        width = fan if level is not whole else 1
        group = down.join(up, F.col("l.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.expr(f"l.ord div {width}") == F.col("s.ord"))).select(
            "l.*", "s.p", "s.q")
        states = stage(group.groupBy("conv_id", F.expr(f"ord div {width}").alias("up")).applyInArrow(
            _descend, "conv_id long, ord long, p int, q int"), "states")
    s, k = states.alias("s"), known.alias("k")
    pieces = k.join(s, F.col("k.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("k.ord") == F.col("s.ord"))).select("k.*", "s.p", "s.q")
    cut = ["conv_id", "ord", "pieces", "turns", "roles", "texts", "faults", "digests", "new", "p", "q"]
    several = pieces.select(cut).mapInArrow(_traced, _TRACED)
    counts = whole.select(F.col("conv_id").alias("whole_id"), F.expr(
        "CASE WHEN low IS NULL THEN 0L ELSE CAST(least(CAST(high AS DECIMAL(38,0)) - low + 1 - distinct, 9223372036854775807) AS BIGINT) END").alias("wg"),
        *[F.col(c).alias(f"w_{c}") for c in ("blank", "duplicate", "truncated", "illegal")])
    several = several.join(counts, F.col("conv_id").eqNullSafe(F.col("whole_id")) & (F.col("ord") == 0), "left").select(
        "conv_id", "ord", "pieces", F.col("wg").alias("gaps"), *[F.col(f"w_{c}").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        "cost", "audit", "lines")
    return solo.select(cut).mapInArrow(_traced, _TRACED).unionAll(several)


def repaired_rows(pieces: DataFrame) -> DataFrame:
    """``conv_id, ord, place, role, text`` of the repaired rows; (``ord``, ``place``) is their order."""
    return pieces.select("conv_id", "ord", F.posexplode("lines").alias("place", "line")).select(
        "conv_id", "ord", "place", "line.role", "line.text")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of (conversation, ord), each conversation in one run, to one row a conversation.

    Lines pass through a running digest, so no conversation is held.
    """
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [*[pa.int64()] * 7, pa.string(), pa.string()]
    done: list = []
    conv, state, counts, cost, audit, lines = None, None, None, 0, [], 0

    def close() -> None:
        if state is not None:
            done.append((conv, *counts, cost, "".join(audit), state.hexdigest()))
    for b in batches:
        for r in b.to_pylist():
            if r["ord"] == 0:
                close()
                conv, state, counts, cost, audit, lines = r["conv_id"], hashlib.sha256(), [r[n] for n in names[1:6]], 0, [], 0
            for line in r["lines"]:
                state.update((b"\n" if lines else b"") + f"{line['role']}:{line['text']}".encode())
                lines += 1
            cost += r["cost"]
            audit.append(r["audit"])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
            done.clear()
    close()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)


def summary(pieces: DataFrame) -> DataFrame:
    """One row a conversation: its counts, cost, audit, and the SHA-256 of its repaired rows (``role:text``, joined by newlines)."""
    done = stage(pieces, "pieces")
    whole = done.where("pieces = 1").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(F.array_join(F.transform("lines", lambda x: F.concat(x.role, F.lit(":"), x.text)), "\n").cast("binary"), 256).alias("repaired_sha256"))
    several = done.where("pieces > 1").repartition("conv_id").sortWithinPartitions("conv_id", "ord").mapInArrow(
        _hashed, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
                 "repaired_sha256 string")
    return whole.unionAll(several)
