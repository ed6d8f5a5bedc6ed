"""Suffix-array dedup of byte strings by bucket-pointer refinement.

A byte is removed if it lies in a ``WINDOW``-byte string that also starts in a
document with a smaller id.  Sorting every suffix of a corpus would shuffle each byte many times,
so the suffixes that enter the buckets are sampled by content: in each window the 24-gram with
the least hash is its anchor.  Equal windows have the same anchor at the same place, hence
nothing is lost, and one position in about 14 remains.

1. Initial buckets: the anchors' 24-grams.  A bucket that only one document reaches is a singleton
   and leaves.  The survivors are marked in a bitmap of fixed size (it may let others through, never lose one).
2. Whole contexts: an anchor decides the windows that hold it, which lie within 26 bytes before and 50
   after it.  (Bucket, fingerprint of the context) pairs are reduced per unit of text, then over the corpus,
   to the smallest document; later copies of a context are settled by it, all windows at once.
3. Refinement: where a bucket holds several contexts, the first copy of each is compared bytewise
   with the others.  Every position's bucket of 8 bytes is refined by the bucket 8 bytes on, that
   by the one 16 bytes on, and that by the one 18 bytes on: the updated bucket numbers are
   the sort keys of the next step, and after three steps a bucket is a window of 50 bytes.  Singletons leave
   at each step.  The smallest document of a bucket settles its windows.

A bucket too large to gather (over ``HOT`` contexts) is refined first by the same rule on rows: into buckets
of the next bytes that all its windows hold, of half its offsets each where there are none, until it is small or one window.

Steps 2 and 3 never bring the text itself into a shuffle: texts are packed once into units of about
``UNIT_BYTES`` in the shared folder, with the places of their anchors, and a task that has to mark or look up places reads its unit.
"""
from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import is_empty, stage, texts

WINDOW = 50
Q = 24
SPAN = WINDOW - Q + 1                          # anchors a window can have
LEFT = WINDOW - Q                              # bytes before an anchor that its windows reach
CONTEXT = LEFT + WINDOW                        # 76
ROW = 80                                       # a context and its two clip lengths, in whole words
UNIT_BYTES = 1 << 21
UNITS_PER_TASK = 4
WINDOWS_SENT = 100_000                         # windows of large buckets that are sent to every task; more are joined by shuffle
SLICE = 1 << 20
FILTER_BITS = 27                               # the bitmap has 2**27 bits, 16 MB, whatever the corpus
HOT = 100_000
GATHER = 40_000                                # contexts in one refinement task
_NONE = np.iinfo(np.int64).max
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


class Unit:
    """Documents laid end to end, and the places of each."""

    def __init__(self, data: bytes, ids: list, lengths: list[int], places: np.ndarray | None = None):
        self.places = places
        self.bytes = np.frombuffer(data, np.uint8)
        self.ends = np.cumsum(np.array(lengths, np.int64))
        self.starts = self.ends - np.array(lengths, np.int64)
        self.ids = np.array([np.iinfo(np.int64).min if i is None else i for i in ids], np.int64)

    def anchors(self, marked: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and 24-gram hashes of the anchors (of those that the bitmap lets through)."""
        if self.places is None:
            at, h = self._found()
        else:                                  # known since the unit was written
            at, h = self.places, np.zeros(len(self.places), np.uint64)
            words = np.ndarray((max(0, len(self.bytes) - 7),), "<u8", self.bytes.data, 0, (1,))
            for k in range(0, Q, 8):
                h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[at + k])
            h |= np.uint64(1)
        if marked is not None:
            bit = h >> np.uint64(64 - FILTER_BITS)
            keep = (marked[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, h = at[keep], h[keep]
        return at, h

    def _found(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.bytes) - WINDOW + 1
        whole = np.ones(max(n, 0), bool)       # windows within one document
        cut = (self.ends[:, None] - np.arange(1, WINDOW)[None, :]).ravel()
        cut = cut[(cut >= np.repeat(self.starts, WINDOW - 1)) & (cut < n)]
        whole[cut] = False
        found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for s in range(0, n, SLICE):
            e = min(n, s + SLICE)
            size = e - s + SPAN - 1            # grams of these windows
            words = np.ndarray((size + Q - 8,), "<u8", self.bytes.data, s, (1,))
            h = np.zeros(size, np.uint64)
            for k in range(0, Q, 8):
                h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k:k + size])
            h |= np.uint64(1)
            least = h
            step = 1
            while 2 * step <= SPAN:
                least = np.minimum(least[:-step], least[step:])
                step *= 2
            if step < SPAN:
                least = np.minimum(least[:len(least) - (SPAN - step)], least[SPAN - step:])
            most = np.zeros(size + SPAN - 1, np.uint64)
            most[SPAN - 1:SPAN - 1 + e - s] = np.where(whole[s:e], least, np.uint64(0))
            step = 1
            while 2 * step <= SPAN:
                most = np.maximum(most[:-step], most[step:])
                step *= 2
            if step < SPAN:
                most = np.maximum(most[:len(most) - (SPAN - step)], most[SPAN - step:])
            at = np.nonzero(most[:size] == h)[0]
            h = h[at]
            found[0].append(at + s)
            found[1].append(h)
        at, h = np.concatenate(found[0]), np.concatenate(found[1])
        if len(at) and n > SLICE:              # neighbouring slices may both find one
            at, first = np.unique(at, return_index=True)
            h = h[first]
        return at, h

    def docs(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, "right")

    def contexts(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``ROW`` bytes (context, zero beyond the document, then both clip lengths), and the lengths."""
        doc = self.docs(at)
        left, right = np.minimum(LEFT, at - self.starts[doc]), np.minimum(WINDOW, self.ends[doc] - at)
        padded = np.concatenate([np.zeros(LEFT, np.uint8), self.bytes, np.zeros(ROW, np.uint8)])
        rows = np.lib.stride_tricks.sliding_window_view(padded, ROW)[at]
        rows[:, CONTEXT:] = 0
        cut = np.flatnonzero((left < LEFT) | (right < WINDOW))
        col = np.arange(ROW)[None, :]
        rows[cut] = np.where((col < LEFT - left[cut, None]) | (col >= LEFT + right[cut, None]), 0, rows[cut])
        rows[:, CONTEXT], rows[:, CONTEXT + 1] = left, right
        return rows, left, right

    def keys(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Context fingerprints, and the clip lengths."""
        fp, left, right = np.empty(len(at), np.uint64), np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        for s in range(0, len(at), 1 << 16):
            rows, left[s:s + (1 << 16)], right[s:s + (1 << 16)] = self.contexts(at[s:s + (1 << 16)])
            words = rows.view("<u8")
            total = np.zeros(len(rows), np.uint64)
            for k in range(words.shape[1]):
                total = _mix(total * np.uint64(0xD6E8FEB86659FD93) + words[:, k] + np.uint64(k + 1))
            fp[s:s + (1 << 16)] = total
        return fp, left, right


def refine(rows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Smallest document of every window, per context and offset before the anchor (``_NONE``: no smaller one).

    ``rows`` are contexts as from ``Unit.contexts``.  Bucket numbers of all positions are refined by
    those of later ones until a bucket is a window.
    """
    n = len(rows)
    left, right = rows[:, CONTEXT].astype(np.int64), rows[:, CONTEXT + 1].astype(np.int64)
    words = np.ndarray((n, CONTEXT - 7), "<u8", np.ascontiguousarray(rows).data, 0, (ROW, 1))
    _, bucket = np.unique(words.ravel(), return_inverse=True)
    bucket, alive = bucket.reshape(n, -1), None
    for step, width in ((8, CONTEXT - 15), (16, CONTEXT - 31), (18, SPAN)):
        here, there = bucket[:, :width], bucket[:, step:step + width]
        live = np.ones(here.shape, bool) if alive is None else alive[:, :width] & alive[:, step:step + width]
        pairs = here[live] * np.int64(bucket.max(initial=0) + 1) + there[live]
        _, number, count = np.unique(pairs, return_inverse=True, return_counts=True)
        bucket = np.zeros(here.shape, np.int64)
        bucket[live] = number
        alive = np.zeros(here.shape, bool)
        alive[live] = count[number] > 1
    start = np.arange(SPAN)[None, :]           # a window's start in the row; LEFT - start bytes before the anchor
    alive &= (LEFT - start <= left[:, None]) & (WINDOW - (LEFT - start) <= right[:, None])
    who = np.broadcast_to(docs[:, None], alive.shape)
    least = np.full(int(bucket.max(initial=0)) + 1, _NONE)
    np.minimum.at(least, bucket[alive], who[alive])
    first = np.where(alive, least[bucket], _NONE)
    return np.where(first < docs[:, None], first, _NONE)[:, ::-1]


def _runs(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, lowest offset, highest offset, document) of the runs of equal values along each row."""
    edge = np.ones((first.shape[0], first.shape[1] + 1), bool)
    edge[:, 1:-1] = first[:, 1:] != first[:, :-1]
    row, lo = np.nonzero(edge[:, :-1])
    _, hi = np.nonzero(edge[:, 1:])
    doc = first[row, lo]
    keep = doc != _NONE
    return row[keep], lo[keep], hi[keep], doc[keep]


_UNIT = "unit long, file string, at long, size long, rids array<long>, ids array<long>, lengths array<long>, places long"
_REPLY = "unit long, h long, fp long, lo int, hi int, first long"


def _pack(folder: str, unit_bytes: int, anchored: bool = False):
    """Texts to units in the shared folder; ``anchored``: with the anchors' places (``places`` bytes after the unit's)."""
    schema = pa.schema([("unit", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()),
                        ("rids", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("places", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        task, squeeze = TaskContext.get(), zstandard.ZstdCompressor(level=3)
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.bin"
        unit, at, out, held, size = task.partitionId() << 33, 0, None, ([], [], []), 0
        body: list[bytes] = []

        def flush() -> pa.RecordBatch:
            nonlocal unit, at, out, size
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/_{name}", compression=None)
            data = b"".join(body)
            frame, places = squeeze.compress(data), b""
            out.write(frame)
            if anchored:                       # four bytes a place, as distances
                found, _ = Unit(data, held[1], held[2]).anchors()
                places = squeeze.compress(np.diff(found, prepend=0).astype("<u4").tobytes())
                out.write(places)
            row = [[unit], [name], [at], [len(frame)], *([h] for h in held), [len(places)]]
            got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, schema.types)], schema=schema)
            unit, at, size = unit + 1, at + len(frame) + len(places), 0
            body.clear()
            for k in range(3):
                held[k].clear()
            return got
        for b in batches:
            for doc, text, rid in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist()):
                if size and size + len(text) > unit_bytes:
                    yield flush()
                body.append(text)
                for h, v in zip(held, (rid, doc, len(text))):
                    h.append(v)
                size += len(text)
        if body:
            yield flush()
        if out is not None:
            out.close()
            store.move(f"{root}/_{name}", f"{root}/{name}")
    return run


def _fetch(folder: str):
    """Reader of units by their handle; keeps the file opened last."""
    import zstandard
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(folder)
    opened: dict = {}

    def get(file: str, at: int, size: int, ids: list, lengths: list, places: int) -> Unit:
        if file not in opened:
            for f in opened.values():
                f.close()
            opened.clear()
            opened[file] = store.open_input_file(f"{root}/{file}")
        frame, unpack = opened[file].read_at(size + places, at), zstandard.ZstdDecompressor().decompress
        known = np.cumsum(np.frombuffer(unpack(frame[size:]), "<u4"), dtype=np.int64) if places else None
        return Unit(unpack(frame[:size]), ids, lengths, known)
    return get


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _each(run):
    """``mapInArrow`` over units, one at a time."""
    def outer(folder: str):
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            get = _fetch(folder)
            for b in batches:
                for unit, file, at, size, _, ids, lengths, places in zip(*(c.to_pylist() for c in b.columns)):
                    yield run(unit, get(file, at, size, ids, lengths, places))
        return over
    return outer


def _buckets(unit: int, u: Unit) -> pa.RecordBatch:
    """One row per bucket of the unit; two if two documents of the unit reach it."""
    at, h = u.anchors()
    doc = u.ids[u.docs(at)]
    order = np.argsort(h, kind="stable")
    h, doc = h[order], doc[order]
    new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    if len(new):
        several = np.minimum.reduceat(doc, new) < np.maximum.reduceat(doc, new)
        h = h[new]
        h = np.concatenate([h, h[several]])
    return pa.RecordBatch.from_arrays([pa.array((h >> np.uint64(16)).astype(np.int64))], names=["h"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_bytes: int = UNIT_BYTES,
                 hot: int = HOT, gather: int = GATHER) -> DataFrame:
    """One row per input row: ``doc_id, rid, n_bytes, n_removed, n_spans, kept`` (the remaining bytes).

    Null text counts as empty and keeps nothing; a null id is smaller than all others.  Rows that share
    an id do not remove from each other.  Overlapping windows count, windows are judged on the input, and
    none crosses documents.  A text is read whole by one task, however long.  An empty table gives no rows; other columns of the input,
    whatever their names, are not read.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "units")
    units = stage(texts(docs, id_col, text_col).mapInArrow(_pack(folder, unit_bytes, anchored=True), _UNIT), "unit_index")
    # A unit is a few hundred bytes here and seconds of work: the number of tasks follows the units.
    tasks = max(1, -(-units.count() // UNITS_PER_TASK))
    units = units.repartition(tasks, "unit")

    # 1. buckets that several documents reach
    reached = (units.mapInArrow(_each(_buckets)(folder), "h long").repartition("h").groupBy("h").count()
               .where("count > 1"))
    bit = F.expr(f"(h >> {48 - FILTER_BITS}) + 1")
    slices = reached.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("slice")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()   # at most 2**FILTER_BITS bits in all
    bitmap = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for s in slices:
        bitmap[(s["slice"] - 1) * 4096:s["slice"] * 4096] = np.frombuffer(bytes(s["bits"]), np.uint8)
    marked = spark.sparkContext.broadcast(bitmap)

    # 2. whole contexts
    def whole(unit: int, u: Unit) -> pa.RecordBatch:
        at, h = u.anchors(marked.value)
        fp, _, _ = u.keys(at)
        doc = u.ids[u.docs(at)]
        order = np.lexsort((fp, h))
        h, fp, doc = h[order], fp[order], doc[order]
        new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (fp[1:] != fp[:-1])]) if len(h) else np.zeros(0, np.int64)
        first = np.minimum.reduceat(doc, new) if len(new) else doc
        return pa.RecordBatch.from_arrays([_signed(h[new]), _signed(fp[new]), pa.array(np.full(len(new), unit, np.int64)),
                                           pa.array(first)], names=["h", "fp", "unit", "first"])
    same, bucket = Window.partitionBy("h", "fp"), Window.partitionBy("h")
    contexts = (units.mapInArrow(_each(whole)(folder), "h long, fp long, unit long, first long")
                .withColumn("least", F.min("first").over(same))
                .withColumn("several", F.min("fp").over(bucket) < F.max("fp").over(bucket))
                .withColumn("n", F.count(F.lit(1)).over(bucket)))
    judged = stage(contexts.where("least < first OR several")
                   .select("unit", "h", "fp", "first", "least", "several", "n"), "contexts")
    replies = judged.where("least < first").selectExpr(
        "unit", "h", "fp", "0 AS lo", f"{LEFT} AS hi", "least AS first")

    # 3. first copies of contexts whose bucket holds others
    asked = judged.where("several AND first = least")
    if not is_empty(asked):
        replies = replies.unionAll(_refined(stage(_fetched(units, asked.repartition(tasks, "unit"), folder, marked), "asked_contexts"), hot, gather))

    def final(t: pa.Table, r: pa.Table) -> pa.Table:
        return _remove(t, r, folder, marked)
    return units.groupBy("unit").cogroup(replies.repartition(tasks, "unit").groupBy("unit")).applyInArrow(
        final, "doc_id long, rid long, n_bytes long, n_removed long, n_spans long, kept binary")


def _open(t: pa.Table, folder: str) -> Unit:
    row = t.slice(0, 1).to_pylist()[0]
    return _fetch(folder)(row["file"], row["at"], row["size"], row["ids"], row["lengths"], row["places"])


def _combined(h: np.ndarray, fp: np.ndarray) -> np.ndarray:
    return _mix(h * np.uint64(0x9E3779B97F4A7C15) + fp)


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy().astype(np.int64, copy=False)


def _asked(u: Unit, r: pa.Table, marked) -> tuple[np.ndarray, np.ndarray]:
    """A place of each asked context in the unit, and the row of ``r`` that asks."""
    at, h = u.anchors(marked.value)
    fp, _, _ = u.keys(at)
    have, first = np.unique(_combined(h, fp), return_index=True)
    want = _combined(_column(r, "h").view(np.uint64), _column(r, "fp").view(np.uint64))
    where = np.minimum(np.searchsorted(have, want), max(0, len(have) - 1))
    ok = np.flatnonzero(have[where] == want) if len(have) else np.zeros(0, np.int64)
    return at[first[where[ok]]], ok


_ROWS = "h long, fp long, unit long, doc long, context binary"


def _fetched(units: DataFrame, asked: DataFrame, folder: str, marked) -> DataFrame:
    """The bytes of the asked contexts, from their units."""
    def fetch(t: pa.Table, r: pa.Table) -> pa.Table:
        names = ["h", "fp", "unit", "doc", "context"]
        if not r.num_rows:
            return pa.table([pa.array([], x) for x in (*[pa.int64()] * 4, pa.binary())], names=names)
        u = _open(t, folder)
        at, ok = _asked(u, r, marked)
        rows, _, _ = u.contexts(at)
        return pa.table([r.column("h").take(pa.array(ok)), r.column("fp").take(pa.array(ok)), r.column("unit").take(pa.array(ok)),
                         r.column("first").take(pa.array(ok)), pa.array([x.tobytes() for x in rows], pa.binary())], names=names)
    return units.groupBy("unit").cogroup(asked.groupBy("unit")).applyInArrow(fetch, _ROWS)


# What the contexts of a bucket share (``l`` bytes before the anchor, ``r`` from it on) and the offsets that it answers for.
State = tuple[int, int, int, int]              # l, r, lo, hi
START: State = (0, Q, 0, LEFT)


def narrower(state: State) -> list[State]:
    """The buckets that a large one is refined into: by the next bytes that all its windows hold, or half its offsets each."""
    l, r, lo, hi = state  # noqa: E741
    if r < WINDOW - hi:
        return [(l, min(r + 8, WINDOW - hi), lo, hi)]
    if l < lo:
        return [(min(l + 8, lo), r, lo, hi)]
    if lo == hi:
        return []                              # the bucket is a window
    mid = (lo + hi) // 2
    return [(l, r, lo, mid), (l, r, mid + 1, hi)]


def _narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of large buckets (with ``key, l, r, lo, hi``) to their rows in the narrower ones."""
    for b in batches:
        if not b.num_rows:
            continue
        rows = np.frombuffer(b"".join(b.column(b.schema.get_field_index("context")).to_pylist()), np.uint8).reshape(-1, ROW)
        state = np.stack([b.column(b.schema.get_field_index(c)).to_numpy() for c in ("l", "r", "lo", "hi")], 1)
        key = b.column(b.schema.get_field_index("key")).to_numpy().view(np.uint64)
        left, right = rows[:, CONTEXT].astype(np.int64), rows[:, CONTEXT + 1].astype(np.int64)
        for old in np.unique(state, axis=0).tolist():
            mine = np.flatnonzero((state == old).all(1))
            for part, new in enumerate(narrower(tuple(old))):
                # of these, the rows that have a window within their document at one of the offsets
                at = mine[(np.minimum(left[mine], new[3]) >= np.maximum(WINDOW - right[mine], new[2]))]
                k = _mix(key[at] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(part + 1))
                for place in (*range(LEFT - new[0], LEFT - old[0]), *range(LEFT + old[1], LEFT + new[1])):
                    k = _mix(k * np.uint64(0xD6E8FEB86659FD93) + rows[at, place].astype(np.uint64) + np.uint64(1))
                pick = b.take(pa.array(at)).select(["h", "fp", "unit", "doc", "context"])
                yield pa.RecordBatch.from_arrays([*pick.columns, pa.array(k.view(np.int64)), *(pa.array(np.full(len(at), v, np.int32)) for v in new)],
                                                 names=[*pick.schema.names, "key", "l", "r", "lo", "hi"])


def _refined(rows: DataFrame, hot: int, gather: int) -> DataFrame:
    """Replies for contexts that meet others in their bucket.

    A bucket of more than ``hot`` contexts is refined into narrower ones first, as often as it takes; a bucket that has
    become one window is answered by an aggregate.  The others are gathered, several to a task.
    """
    state = dict(zip(("l", "r", "lo", "hi"), START))
    open_ = rows.withColumns({"key": F.col("h"), **{c: F.lit(v) for c, v in state.items()}})
    replies = []
    schema = f"{_ROWS}, key long, l int, r int, lo int, hi int"
    while True:
        counts = stage(open_.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(f"n > {hot}").select("key"), "large_buckets")
        if is_empty(counts):
            replies.append(_gathered(open_, gather))
            break
        # few rows: each stands for more than ``hot`` contexts
        replies.append(_gathered(open_.join(counts, "key", "left_anti"), gather))
        large = open_.join(counts, "key", "left_semi")
        whole = F.expr(f"lo = hi AND l = lo AND r = {WINDOW} - lo")
        replies.append(_windows(large.where(whole)))
        open_ = stage(large.where(~whole).select([c.split()[0] for c in schema.split(", ")]).mapInArrow(_narrowed, schema), "narrower")
    return functools.reduce(DataFrame.unionAll, replies)


def _gathered(rows: DataFrame, gather: int) -> DataFrame:
    """Refinement replies of buckets small enough to gather, several buckets to a task."""
    tasks = max(1, -(-rows.count() // gather))

    def settle(t: pa.Table) -> pa.Table:
        some = np.frombuffer(b"".join(t.column("context").to_pylist()), np.uint8).reshape(-1, ROW)
        first = refine(some, _column(t, "doc"))
        offset = np.arange(SPAN)[None, :]
        first = np.where((offset >= _column(t, "lo")[:, None]) & (offset <= _column(t, "hi")[:, None]), first, _NONE)
        row, lo, hi, doc = _runs(first)
        pick = pa.array(row)
        return pa.table([t.column("unit").take(pick), t.column("h").take(pick), t.column("fp").take(pick),
                         pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(doc)],
                        names=["unit", "h", "fp", "lo", "hi", "first"])
    return rows.groupBy(F.expr(f"pmod(key, {tasks}L)").alias("task")).applyInArrow(settle, _REPLY)


def _windows(rows: DataFrame) -> DataFrame:
    """Replies of buckets that are one window each: the smallest document by the window's own bytes."""
    found = rows.select("h", "fp", "unit", "doc", "lo", F.expr(f"substring(context, {LEFT + 1} - lo, {WINDOW})").alias("bytes"))
    least = stage(found.groupBy("bytes").agg(F.min("doc").alias("first")), "least")
    side = F.broadcast(least) if least.count() <= WINDOWS_SENT else least.hint("merge")
    return found.join(side, "bytes").where("first < doc").selectExpr("unit", "h", "fp", "lo", "lo AS hi", "first")


def _remove(t: pa.Table, r: pa.Table, folder: str, marked) -> pa.Table:
    u = _open(t, folder)
    row = t.slice(0, 1).to_pylist()[0]
    gone = np.zeros(len(u.bytes), bool)
    at, h = u.anchors(marked.value)
    if len(at):
        fp, left, right = u.keys(at)
        doc = u.ids[u.docs(at)]
        have = _combined(h, fp)
        change = np.zeros(len(u.bytes) + 1, np.int32)
        # copies within the unit need no reply
        _, number = np.unique(have, return_inverse=True)
        least = np.full(int(number.max()) + 1, _NONE)
        np.minimum.at(least, number, doc)
        later = doc > least[number]
        np.add.at(change, (at - left)[later], 1)
        np.add.at(change, (at + right)[later], -1)
        want = _combined(_column(r, "h").view(np.uint64), _column(r, "fp").view(np.uint64))
        order = np.argsort(want, kind="stable")
        want = want[order]
        begin, end = np.searchsorted(want, have, "left"), np.searchsorted(want, have, "right")
        count = end - begin
        which = np.repeat(np.arange(len(at)), count)
        reply = order[np.repeat(begin - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(len(which))]
        lo = np.maximum(_column(r, "lo")[reply], WINDOW - right[which])
        hi = np.minimum(_column(r, "hi")[reply], left[which])
        ok = (hi >= lo) & (_column(r, "first")[reply] < doc[which])
        np.add.at(change, at[which[ok]] - hi[ok], 1)
        np.add.at(change, at[which[ok]] - lo[ok] + WINDOW, -1)
        gone = np.cumsum(change[:-1]) > 0
    opens = gone & ~np.r_[False, gone[:-1]] if len(gone) else gone
    inner = u.starts[u.starts < u.ends]
    opens[inner] = gone[inner]
    spans, lost = np.r_[0, np.cumsum(opens)], np.r_[0, np.cumsum(gone)]
    kept = [u.bytes[s:e].tobytes() if lost[e] == lost[s] else u.bytes[s:e][~gone[s:e]].tobytes() for s, e in zip(u.starts.tolist(), u.ends.tolist())]
    return pa.table([pa.array(row["ids"], pa.int64()), pa.array(row["rids"], pa.int64()), pa.array(row["lengths"], pa.int64()),
                     pa.array(lost[u.ends] - lost[u.starts], pa.int64()), pa.array(spans[u.ends] - spans[u.starts], pa.int64()),
                     pa.array(kept, pa.binary())], names=["doc_id", "rid", "n_bytes", "n_removed", "n_spans", "kept"])
