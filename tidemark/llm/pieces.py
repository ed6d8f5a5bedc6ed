"""SentencePiece encoding and decoding, giant documents by a max-plus scan.

Encoding is a best path in the lattice of pieces.  A path's weight is the sum of
its pieces' weights and of the weights of its adjacent pairs, in the max-plus
semiring.  For the public BPE vocabulary a piece weighs 0 and a pair weighs 0 if merging
the two pieces' text gives back just these two, else minus infinity: a path of finite
weight is then exactly the merge result.  A unigram vocabulary would weigh its pieces'
scores and no pairs; the scan is the same.

A document longer than ``chunk`` is cut at fixed places, wherever they fall.  What crosses a cut is
the piece that straddles it, so a boundary state is (how far that piece reaches into
the chunk, its length), a few dozen at most.  Each chunk yields alone its transfer
matrix from the states of its left cut to those of its right cut; matrices compose
associatively, first within blocks of chunks, then over a document's blocks; the best state
at every cut follows, and each chunk is traced back alone.  Within a chunk only the
words at its two ends depend on the cuts.  The words between are ordinary local encoding: the
sentencepiece library encodes each distinct word once per worker.
"""
from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, texts
from .words import Cached, located, start_task

CHUNK = 1 << 15
BLOCK = 256                                    # chunks composed by one task
CACHE_ENTRIES = 100_000
SPACE = "▁"
_NEVER = float("-inf")
State = tuple[int, int]                        # (reach beyond the cut, length of the piece); (0, 0) at a text's ends
Matrix = dict[State, dict[State, float]]


class Lattice:
    """Pieces with weights, and pair weights; ``syncs``: a piece never continues over a word's start."""

    def __init__(self, weights: dict[str, float], joins=None, syncs: bool = False, unknown: float = 0.0):
        self.weights, self.joins, self.syncs, self.unknown = weights, joins, syncs, unknown
        self.longest = max([1, *map(len, weights)])

    def weight(self, piece: str) -> float | None:
        w = self.weights.get(piece)
        return self.unknown if w is None and len(piece) == 1 else w

    def paths(self, text: str, pos: int, last: str, stop: int) -> dict[State, tuple[float, State | None]]:
        """Best weight and predecessor of every node (position, length of the piece before) from one node up to ``stop``.

        Nodes at or beyond ``stop`` are reached, not left.
        """
        nodes: dict[State, tuple[float, State | None]] = {(pos, len(last)): (0.0, None)}
        queue, at = {pos: [(pos, len(last))]}, pos
        while at < stop:
            for node in queue.pop(at, ()):
                before = last if node == (pos, len(last)) else text[at - node[1]:at]
                for n in range(1, min(self.longest, len(text) - at) + 1):
                    piece = text[at:at + n]
                    w = self.weight(piece)
                    if w is None or self.joins and before and not self.joins(before, piece):
                        continue
                    to, total = (at + n, n), nodes[node][0] + w
                    if to not in nodes:
                        queue.setdefault(at + n, []).append(to)
                    if to not in nodes or total > nodes[to][0]:
                        nodes[to] = (total, node)
            at += 1
        return nodes

    def entries(self, text: str, begin: int) -> list[State]:
        """States of the cut at ``begin``: pieces that start before it and end at or after it.

        At the text's ends, and where a word starts, nothing that lies before matters: one state (0, 0).
        """
        if begin == 0 or self._free(text, begin, False):
            return [(0, 0)]
        return [(reach, n) for reach in range(self.longest) for n in range(reach + 1, min(self.longest, begin + reach) + 1)
                if begin + reach <= len(text) and self.weight(text[begin + reach - n:begin + reach]) is not None]

    def sync(self, text: str, begin: int, end: int) -> tuple[int, int] | None:
        """First and last word start in ``[begin, end]``, if there is one."""
        if not self.syncs:
            return None
        first = begin
        while first <= end and not self._starts(text, first):
            first += 1
        if first > end:
            return None
        last = end
        while not self._starts(text, last):
            last -= 1
        return first, last

    def _free(self, text: str, end: int, final: bool) -> bool:
        return final or self.syncs and self._starts(text, end)

    @staticmethod
    def _starts(text: str, i: int) -> bool:
        return i > 0 and i < len(text) and text[i] == SPACE and text[i - 1] != SPACE

    def transfer(self, text: str, begin: int, end: int, final: bool) -> Matrix:
        """Transfer matrix of ``text[begin:end]``; ``text`` also holds the context beyond both cuts."""
        sync, tail, out = self.sync(text, begin, end), None, {}
        final = self._free(text, end, final)
        for state in self.entries(text, begin):
            at = begin + state[0]
            last = text[at - state[1]:at]
            if sync and at <= sync[0]:
                nodes = self.paths(text, at, last, sync[0])
                head = max((w for (p, _), (w, _) in nodes.items() if p == sync[0]), default=_NEVER)
                if head > _NEVER:
                    tail = tail if tail is not None else self._exits(self.paths(text, sync[1], "", end), text, end, final)
                    out[state] = {s: head + w for s, w in tail.items()}
            else:
                out[state] = self._exits(self.paths(text, at, last, end), text, end, final)
        return {s: row for s, row in out.items() if row}

    @staticmethod
    def _exits(nodes, text: str, end: int, final: bool) -> dict[State, float]:
        out: dict[State, float] = {}
        for (p, n), (w, _) in nodes.items():
            if final and p == end:
                out[0, 0] = max(w, out.get((0, 0), _NEVER))
            elif not final and p >= end:
                out[p - end, n] = w
        return out

    def trace(self, text: str, begin: int, end: int, final: bool, entry: State, leave: State, words) -> list:
        """Pieces after the entry piece up to the leaving one; ``words`` encodes the words between the ends at once."""
        at = begin + entry[0]
        last, sync = text[at - entry[1]:at], self.sync(text, begin, end)
        goal = None if self._free(text, end, final) else (end + leave[0], leave[1])
        if sync and at <= sync[0]:
            head = self._walk(self.paths(text, at, last, sync[0]), text, sync[0], None)
            return [*head, *words(text[sync[0]:sync[1]]), *self._walk(self.paths(text, sync[1], "", end), text, end, goal)]
        return self._walk(self.paths(text, at, last, end), text, end, goal)

    @staticmethod
    def _walk(nodes, text: str, end: int, goal: State | None) -> list[str]:
        node = goal or max((k for k in nodes if k[0] == end), key=lambda k: nodes[k][0])
        out = []
        while nodes[node][1] is not None:
            out.append(text[node[0] - node[1]:node[0]])
            node = nodes[node][1]
        return out[::-1]


def compose(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus product: best weight over the states in between."""
    out: Matrix = {}
    for s, row in a.items():
        best: dict[State, float] = {}
        for mid, w in row.items():
            for t, v in b.get(mid, {}).items():
                if w + v > best.get(t, _NEVER):
                    best[t] = w + v
        if best:
            out[s] = best
    return out


def best_states(matrices: list[Matrix], entry: State, leave: State) -> list[tuple[State, State]]:
    """(entry, exit) of each matrix on the best way from ``entry`` of the first to ``leave`` of the last."""
    reach = [{entry: 0.0}]
    for m in matrices:
        reach.append(compose({entry: reach[-1]}, m).get(entry, {}))
    states, state = [], leave
    for k in range(len(matrices) - 1, -1, -1):
        before = max((s for s in reach[k] if state in matrices[k].get(s, {})), key=lambda s: reach[k][s] + matrices[k][s][state])
        states.append((before, state))
        state = before
    return states[::-1]


def dump(m: Matrix) -> bytes:
    return np.array([(*s, *t, w) for s, row in m.items() for t, w in row.items()], "<f8").tobytes()


def load(data: bytes) -> Matrix:
    out: Matrix = {}
    for a, b, c, d, w in np.frombuffer(data, "<f8").reshape(-1, 5).tolist():
        out.setdefault((int(a), int(b)), {})[int(c), int(d)] = w
    return out


class Pieces:
    """A SentencePiece BPE model whose pieces hold the space mark only in front, with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        proto.normalizer_spec.add_dummy_prefix = False      # words come with their own space mark
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(len(names))]
        self.scores = {p: sp.get_score(i) for i, p in enumerate(names) if not special[i]}
        self.ids = {p: i for i, p in enumerate(names) if not special[i]}
        bad = [p for p in self.scores if SPACE in p.lstrip(SPACE) or "\n" in p]
        if bad:
            raise ValueError(f"pieces over word starts: {bad[:3]}")
        self.bytes_at = sp.piece_to_id("<0x00>")
        self.texts = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else bytes([int(p[3:5], 16)])
                      if sp.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        one = lambda s: array("I", sp.encode(s)).tobytes()
        self._bare, self._after = Cached(one), Cached(lambda s: one(" " + s))
        self._newline = one("\n")
        self._pairs: dict[tuple[str, str], bool] = {}
        self.lattice = Lattice(dict.fromkeys(self.scores, 0.0), self._joins, syncs=True)

    def merge(self, text: str) -> list[str]:
        """The merge rule itself, for short texts: the best scored pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, where = _NEVER, -1
            for i in range(len(parts) - 1):
                s = self.scores.get(parts[i] + parts[i + 1], _NEVER)
                if s > best:
                    best, where = s, i
            if where < 0:
                return parts
            parts[where:where + 2] = [parts[where] + parts[where + 1]]

    def _joins(self, a: str, b: str) -> bool:
        got = self._pairs.get((a, b))
        if got is None:
            if len(self._pairs) >= CACHE_ENTRIES:
                self._pairs.clear()
            got = self._pairs[a, b] = self.merge(a + b) == [a, b]
        return got

    def words(self, text: str) -> bytes:
        """Ids of whole words; ``text`` starts at a word and marks spaces by ``SPACE`` or blank."""
        text = text.replace(SPACE, " ")
        bare, after = self._bare, self._after
        if "  " in text:
            return b"".join([bare[u] for u in re.findall(" *[^ \n]+|\n| +", text)])
        lines = []
        for line in text.split("\n"):
            units = line.split(" ")
            lines.append(bare[units[0]] + b"".join([after[u] for u in units[1:]]))
        return self._newline.join(lines)

    def piece_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else [self.bytes_at + b for b in piece.encode()]

    def encode(self, text: str) -> bytes:
        return self.words(" " + text) if text else b""

    def trace(self, text: str, begin: int, end: int, final: bool, entry: State, leave: State) -> bytes:
        got = self.lattice.trace(text, begin, end, final, entry, leave, lambda t: [self.words(t)] if t else [])
        return b"".join(p if isinstance(p, bytes) else array("I", self.piece_ids(p)).tobytes() for p in got)

    def decode(self, ids: bytes) -> str:
        """Text of little-endian unsigned 32-bit ids: the space in front of the first word is not part of it."""
        a = array("I", ids)
        if not a:
            return ""
        text = b"".join(map(self.texts.__getitem__, a)).decode("utf-8", "replace")
        return text[1:] if self.texts[a[0]][:1] == b" " else text


_models: dict[str, Pieces] = {}


def model(path: str) -> Pieces:
    """The worker's model of a file (kept between tasks, its cache between those of a stage)."""
    start_task()
    if path not in _models:
        _models[path] = Pieces(located(path))
    return _models[path]


def _marked(text: str) -> str:
    return SPACE + text.replace(" ", SPACE)


def _cut(chunk: int, reach: int):
    """Rows of giant texts: each chunk with ``reach`` characters of context on both sides."""
    schema = pa.schema([("rid", pa.int64()), ("k", pa.int64()), ("last", pa.int64()), ("before", pa.int32()), ("size", pa.int32()), ("part", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, rid in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                text = _marked(text)
                n = -(-len(text) // chunk)
                for first in range(0, n, 64):          # a giant text leaves in batches
                    rows = []
                    for k in range(first, min(n, first + 64)):
                        begin, end = k * chunk, min(len(text), (k + 1) * chunk)
                        lead = max(0, begin - reach)
                        rows.append((rid, k, n - 1, begin - lead, end - begin, text[lead:end + reach]))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
           block: int = BLOCK) -> DataFrame:
    """``doc_id, rid, ids`` (little-endian unsigned 32-bit) of every row, equal to the library's own encoding.

    Null text counts as empty and has no ids; rows that repeat an id or a text are encoded
    each; an empty table gives no rows.  Texts of ``chunk`` characters or more are encoded in chunks, however long; other
    columns of the input, whatever their names, are not read.
    """
    rows = texts(docs, id_col, text_col)
    big = F.char_length("text") >= chunk

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([m.encode(t) for t in b.column(1).to_pylist()], pa.binary())],
                                             names=["doc_id", "rid", "ids"])
    out = "doc_id long, rid long, ids binary"
    return rows.where(~big).mapInArrow(small, out).unionAll(_giants(rows.where(big), path, chunk, block).select("doc_id", "rid", "ids"))


def _giants(rows: DataFrame, path: str, chunk: int, block: int) -> DataFrame:
    reach = max(1, model(path).lattice.longest)
    rows = stage(rows.select("doc_id", "text", "rid"), "giants")         # numbered once, however often they are read
    parts = stage(rows.mapInArrow(_cut(chunk, reach), "rid long, k long, last long, before int, size int, part string")
                  .repartition("rid", "k"), "giant_parts")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = model(path).lattice
        for b in batches:
            got = [dump(lattice.transfer(t, before, before + size, k == last))
                   for k, last, before, size, t in zip(*(c.to_pylist() for c in b.columns[1:]))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.binary())], names=["rid", "k", "m"])
    chunks = stage(parts.mapInArrow(matrices, "rid long, k long, m binary")
                   .withColumn("block", F.expr(f"k DIV {block}")), "giant_matrices")

    def composed(t: pa.Table) -> pa.Table:
        t = t.sort_by("k")
        ms = [load(m) for m in t.column("m").to_pylist()]
        while len(ms) > 1:                     # a balanced product: the grouping does not matter
            ms = [compose(*ms[i:i + 2]) if i + 1 < len(ms) else ms[i] for i in range(0, len(ms), 2)]
        return pa.table({"rid": t.column("rid").slice(0, 1), "block": t.column("block").slice(0, 1), "m": pa.array([dump(ms[0])], pa.binary())})
    blocks = chunks.groupBy("rid", "block").applyInArrow(composed, "rid long, block long, m binary")

    def ends(t: pa.Table, by: str, entry: State, leave: State) -> pa.Table:
        t = t.sort_by(by)
        got = best_states([load(m) for m in t.column("m").to_pylist()], entry, leave)
        flat = pa.array([[*a, *z] for a, z in got], pa.list_(pa.int32()))
        return pa.table({"rid": t.column("rid"), by: t.column(by), "ends": flat})
    fixed = stage(blocks.groupBy("rid").applyInArrow(lambda t: ends(t, "block", (0, 0), (0, 0)), "rid long, block long, ends array<int>"), "giant_blocks")

    def inner(t: pa.Table, e: pa.Table) -> pa.Table:
        a, b, c, d = e.column("ends")[0].as_py()
        return ends(t, "k", (a, b), (c, d))
    states = chunks.groupBy("rid", "block").cogroup(fixed.groupBy("rid", "block")).applyInArrow(inner, "rid long, k long, ends array<int>")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in batches:
            got = [m.trace(t, before, before + size, k == last, tuple(e[:2]), tuple(e[2:]))
                   for k, last, before, size, t, e in zip(*(c.to_pylist() for c in b.columns[1:]))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.binary())], names=["rid", "k", "ids"])
    ids = parts.join(states, ["rid", "k"]).select("rid", "k", "last", "before", "size", "part", "ends").mapInArrow(
        traced, "rid long, k long, ids binary")
    whole = ids.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts")).select(
        "rid", F.expr("unhex(array_join(transform(parts, p -> hex(p.ids)), ''))").alias("ids"))      # in proportion to the ids
    return rows.select("doc_id", "rid").join(whole, "rid")


def decode(ids: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``ids`` with a column ``decoded``; null ids give an empty text."""
    import pandas as pd
    run = F.pandas_udf(lambda s: pd.Series([model(path).decode(bytes(x)) for x in s]), "string")
    return ids.withColumn("decoded", run(F.coalesce(F.col(ids_col), F.lit(b""))))
