"""Substring dedup of word passages by prefix-partitioned suffix trees.

A word is removed if it lies in a window of ``WINDOW`` words that also starts in a document with a smaller id.

Equal windows have equal anchors: in each window the run of ``GRAM`` words with the least hash.  An anchor's
*context* (``LEFT`` words before, ``WINDOW`` from it on) holds all its windows, and the suffixes that start at them.

1. Leaves.  Per unit of text equal contexts become one leaf with its smallest document, and the leaves of all
   units meet by the anchor's hash.  A leaf whose whole context stands in a smaller document is settled: all its windows go.
2. Vertical partitioning.  Where an anchor stands in several contexts, the suffixes that start at the windows of each one's
   first copy go on.  Their prefix of one word decides a suffix's group; prefixes with more than ``GROUP`` suffixes
   are lengthened (4, 13 words) until every group fits into memory.  The long prefixes are marked in a bitmap of fixed size
   per length; a false mark lengthens a prefix more than needed, for all its suffixes alike.
3. Subtrees.  A task builds the suffix tree of its groups, from sorted suffixes and their common prefixes.  Its topmost nodes of
   depth ``WINDOW`` or more are the windows that repeat, deeper ones the longer repeats; the smallest document below
   a topmost node settles the windows of the others.  A window too frequent for a group is a node of its own
   and needs no tree: its smallest document is an aggregate.

Texts never enter a shuffle: they are packed once into units in the shared folder and read there.  Contexts are
compared by 128 bits (64 of the run, 64 of the words around it), suffixes word by word (words over ``WORD_BYTES`` by 128 bits).
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import is_empty, stage, texts
from .suffix_dedup import _UNIT as UNIT
from .suffix_dedup import _mix as mix
from .suffix_dedup import _pack as pack

WINDOW = 13
GRAM = 8
SPAN = WINDOW - GRAM + 1                       # anchors a window can have
LEFT = WINDOW - GRAM
ALL = (1 << SPAN) - 1                          # a window per word before the anchor: 0 .. LEFT
UNIT_BYTES = 1 << 21
UNITS_PER_TASK = 4
PREFIXES = (1, 4, WINDOW)
GROUP = 50_000                                 # suffixes of one prefix in a subtree task
GATHER = 50_000                                # suffixes in a subtree task, over several prefixes
FREQUENT = 100_000                             # windows too frequent for a group that are sent to every task; more are joined by shuffle
MARK_BITS = 24
SALTS = 64
WORD_BYTES = 64
HOLD = 1 << 20
_MUL = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, eight bytes at a time; of very long ones through a digest."""
    size = end - start
    out = size.astype(np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))
    live, at = np.flatnonzero(size <= 1024), 0
    while len(live):
        rest = size[live] - at
        word = eight[start[live] + at]
        short = rest < 8
        word[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[live] = mix(out[live] * _MUL + word)
        at += 8
        live = live[rest > 8]
    for i in np.flatnonzero(size > 1024).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=8).digest(), "little")
    return out


class Words:
    """Documents of a unit cut into words, and their anchors."""

    def __init__(self, data: bytes, ids: list, lengths: list[int]):
        self.bytes = np.frombuffer(data, np.uint8)
        ends = np.cumsum(np.array(lengths, np.int64))
        self.ids = np.array([np.iinfo(np.int64).min if i is None else i for i in ids], np.int64)
        space = (self.bytes == 0x20) | ((self.bytes >= 0x09) & (self.bytes <= 0x0D))
        edge = np.zeros(len(self.bytes) + 1, bool)                     # a document begins or ends here
        edge[ends] = True
        edge[0] = True
        word = ~space
        self.start = np.flatnonzero(word & (np.r_[True, space[:-1]] | edge[:-1])) if len(word) else np.zeros(0, np.int64)
        self.end = np.flatnonzero(word & (np.r_[space[1:], True] | edge[1:])) + 1 if len(word) else np.zeros(0, np.int64)
        self.last = np.searchsorted(self.start, ends)                  # first word after each document
        self.first = np.r_[0, self.last[:-1]] if len(ends) else self.last
        self.doc = np.repeat(np.arange(len(ends)), self.last - self.first)
        self.hash = word_hashes(self.bytes, self.start, self.end)

    def anchors(self) -> None:
        """Sets ``at, left, right, group`` of the anchors (``group``: equal contexts share one) and ``h, fp, who, one`` of the groups:
        both hashes, the smallest document and one anchor."""
        n = len(self.hash) - WINDOW + 1
        if n <= 0:
            self.at = self.left = self.right = self.group = self.who = self.one = np.zeros(0, np.int64)
            self.h = self.fp = np.zeros(0, np.uint64)
            return
        size = n + SPAN - 1
        h = np.zeros(size, np.uint64)
        for k in range(GRAM):
            h = mix(h * _MUL + self.hash[k:k + size])
        h |= np.uint64(1)
        least = np.minimum.reduce([h[k:k + n] for k in range(SPAN)])
        least[self.last[self.doc[:n]] - np.arange(n) < WINDOW] = 0     # the window would leave its document
        most = np.zeros(size, np.uint64)
        for k in range(SPAN):
            np.maximum(most[k:k + n], least, out=most[k:k + n])
        at = np.flatnonzero(most == h)
        doc = self.doc[at]
        left, right = np.minimum(LEFT, at - self.first[doc]), np.minimum(WINDOW, self.last[doc] - at)
        padded = np.concatenate([np.zeros(LEFT, np.uint64), self.hash, np.zeros(WINDOW, np.uint64)])
        fp = (left * 16 + right).astype(np.uint64)
        for k in (*range(-LEFT, 0), *range(GRAM, WINDOW)):
            inside = -k <= left if k < 0 else k < right
            fp = mix(fp * _MUL + np.where(inside, padded[at + LEFT + k], np.uint64(0)))
        h = h[at]
        order = np.lexsort((fp, h))
        sh, sf = h[order], fp[order]
        new = np.r_[True, (sh[1:] != sh[:-1]) | (sf[1:] != sf[:-1])] if len(order) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        self.group = np.empty(len(at), np.int64)
        self.group[order] = np.cumsum(new) - 1
        who = self.ids[doc[order]]
        self.at, self.left, self.right = at, left, right
        self.h, self.fp, self.one = sh[begin], sf[begin], order[begin]
        self.who = np.minimum.reduceat(who, begin) if len(begin) else who

    def suffixes(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
        """The suffixes that start at the windows of the given leaves: place of the leaf in the list, words before its anchor, words,
        and hashes of the prefixes."""
        one = self.one[leaves]
        at, left, right = self.at[one], self.left[one], self.right[one]
        which, back = np.nonzero((np.arange(SPAN) <= left[:, None]) & (WINDOW - np.arange(SPAN) <= right[:, None]))
        lo, hi = at[which] - back, (at + right)[which]
        total, hashes = np.zeros(len(lo), np.uint64), []
        for k in range(WINDOW):
            total = mix(total * _MUL + self.hash[lo + k])
            if k + 1 in PREFIXES:
                hashes.append(total.view(np.int64))
        # Words with one space between them, none of them very long, are one slice of the text.
        long = self.end - self.start > WORD_BYTES
        gap = np.zeros(len(self.start), bool)
        gap[:-1] = (self.start[1:] - self.end[:-1] != 1) | (self.bytes[self.end[:-1]] != 0x20)
        odd, wide = np.r_[0, np.cumsum(long)], np.r_[0, np.cumsum(gap)]
        plain = (odd[hi] == odd[lo]) & (wide[hi - 1] == wide[lo])
        data = self.bytes.tobytes()
        words = [data[s:e] if p else self._joined(data, i, j) for s, e, p, i, j in zip(
            self.start[lo].tolist(), self.end[hi - 1].tolist(), plain.tolist(), lo.tolist(), hi.tolist())]
        return which, back, words, np.stack(hashes, 1) if len(lo) else np.zeros((0, len(PREFIXES)), np.int64)

    def _joined(self, data: bytes, lo: int, hi: int) -> bytes:
        words = (data[s:e] for s, e in zip(self.start[lo:hi].tolist(), self.end[lo:hi].tolist()))
        return b" ".join(w if len(w) <= WORD_BYTES else w[:WORD_BYTES // 2] + b"\n" + hashlib.blake2b(w, digest_size=16).hexdigest().encode()
                         for w in words)       # no word holds a line break, so digests meet digests only


def nodes(rows: np.ndarray, depth: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Internal nodes ``(depth, lo, hi, parent's depth)`` of the suffix tree whose leaves are the sorted ``rows`` (word numbers,
    ``depth`` of each row valid); a node's leaves are rows ``lo`` to ``hi``, ``hi`` excluded."""
    n = len(rows)
    if n < 2:
        return []
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    common = np.minimum(common, np.minimum(depth[1:], depth[:-1])).tolist()
    out, stack = [], [(0, 0)]                  # (depth, first leaf) of the open nodes
    for i, c in enumerate([*common, 0], 1):
        lo = i - 1
        while stack[-1][0] > c:
            d, lo = stack.pop()
            out.append((d, lo, i, max(c, stack[-1][0])))
        if stack[-1][0] < c:
            stack.append((c, lo))
    return out


def tree_rows(suffixes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of the suffixes, their depths, and the order that sorts them."""
    number: dict = {}
    rows = np.full((len(suffixes), WINDOW + LEFT), -1, np.int64)
    depth = np.zeros(len(suffixes), np.int64)
    for i, s in enumerate(suffixes):
        words = s.split(b" ")
        depth[i] = len(words)
        rows[i, :len(words)] = [number.setdefault(w, len(number)) for w in words]
    return rows, depth, np.lexsort(rows.T[::-1])


def maximal_repeats(suffixes: list[bytes], least: int = WINDOW) -> list[tuple[bytes, int]]:
    """The repeats of ``least`` words or more that no further word prolongs, with their number of suffixes."""
    rows, depth, order = tree_rows(suffixes)
    return [(b" ".join(suffixes[order[lo]].split(b" ")[:d]), hi - lo) for d, lo, hi, _ in nodes(rows[order], depth[order]) if d >= least]


def repeated(suffixes: list[bytes], docs: np.ndarray) -> np.ndarray:
    """Which suffixes begin with a window that also begins a suffix of a smaller document."""
    rows, depth, order = tree_rows(suffixes)
    out = np.zeros(len(suffixes), bool)
    for d, lo, hi, above in nodes(rows[order], depth[order]):
        if d >= WINDOW > above:
            leaves = order[lo:hi]
            out[leaves] = docs[leaves] > docs[leaves].min()
    return out


def _reader(folder: str):
    """Units by their handle; the file opened last stays open."""
    import zstandard
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(folder)
    opened: dict = {}

    def get(file: str, at: int, size: int, ids: list, lengths: list) -> Words:
        if file not in opened:
            for f in opened.values():
                f.close()
            opened.clear()
            opened[file] = store.open_input_file(f"{root}/{file}")
        unit = Words(zstandard.ZstdDecompressor().decompress(opened[file].read_at(size, at)), ids, lengths)
        unit.anchors()
        return unit
    return get


def _leaves(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = _reader(folder)
        for b in batches:
            for unit, file, at, size, _, ids, lengths, _ in zip(*(c.to_pylist() for c in b.columns)):
                u = get(file, at, size, ids, lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.h.view(np.int64)), pa.array(u.fp.view(np.int64)), pa.array(u.who), pa.array(np.full(len(u.h), unit, np.int64)),
                     pa.array(np.arange(len(u.h), dtype=np.int32))], names=["h", "fp", "first", "unit", "leaf"])
    return run


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves sorted by (h, fp, first) to those that are settled and, where an anchor has several contexts, those to ask about.

    What is held of an anchor whose second context has not come is bounded: beyond ``HOLD`` leaves it is
    asked about without need, which costs rows only.
    """
    def reply(unit, leaf, ask: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(unit), pa.array(leaf), pa.array(np.full(len(unit), ask))], names=["unit", "leaf", "ask"])
    anchor, context, first, several, held = None, None, 0, False, []
    for b in batches:
        if not b.num_rows:
            continue
        h, fp, who, unit, leaf = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        other = np.r_[anchor is None or h[0] != anchor, h[1:] != h[:-1]]
        new = other | np.r_[anchor is None or fp[0] != context, fp[1:] != fp[:-1]]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
        least = np.where(begin >= 0, who[np.maximum(begin, 0)], first)
        settled = who > least
        number = np.cumsum(other)              # 0: the anchor of the batch before
        many = np.zeros(number[-1] + 1, bool)
        many[number[new & ~other]] = True
        many[0] |= several
        yield reply(unit[settled], leaf[settled], False)
        if held and (many[0] or sum(len(x) for x, _ in held) > HOLD):
            yield from (reply(u, g, True) for u, g in held)
            held = []
        elif number[-1]:
            held = []
        ask = ~settled & many[number]
        yield reply(unit[ask], leaf[ask], True)
        if not many[-1]:
            wait = ~settled & (number == number[-1])
            held.append((unit[wait], leaf[wait]))
        anchor, context, first, several = h[-1], fp[-1], least[-1], bool(many[-1])


def _open(t: pa.Table, folder: str) -> tuple[Words, dict]:
    row = t.slice(0, 1).to_pylist()[0]
    return _reader(folder)(row["file"], row["at"], row["size"], row["ids"], row["lengths"]), row


def _suffixes(folder: str):
    names = ["unit", "leaf", "back", "doc", "words", "prefixes"]

    def run(t: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not t.num_rows:
            return pa.table([pa.array([], x) for x in (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()))], names=names)
        u, row = _open(t, folder)
        leaves = asked.column("leaf").to_numpy()
        which, back, words, hashes = u.suffixes(leaves)
        return pa.table([pa.array(np.full(len(words), row["unit"])), pa.array(leaves[which].astype(np.int32)), pa.array(back.astype(np.int32)),
                         pa.array(u.who[leaves][which]), pa.array(words, pa.binary()),
                         pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * len(PREFIXES)), pa.array(hashes.ravel()))],
                        names=names)
    return run


def _marked(maps: list[np.ndarray], prefixes: np.ndarray) -> np.ndarray:
    """Per suffix the number of its leading prefixes that are marked as too frequent."""
    level = np.zeros(len(prefixes), np.int64)
    live = np.ones(len(prefixes), bool)
    for i, m in enumerate(maps):
        bit = (prefixes[:, i].view(np.uint64) >> np.uint64(64 - MARK_BITS)).astype(np.int64)
        live &= (m[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        level += live
    return level


def _keyed(maps: list[np.ndarray], columns: str):
    """``mapInArrow``: adds each suffix's group, the hash of its first prefix that is not too frequent, and that prefix's place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prefixes = np.array(b.column(b.schema.get_field_index("prefixes")).flatten()).reshape(-1, len(PREFIXES))
            level = _marked(maps, prefixes)
            key = prefixes[np.arange(len(level)), np.minimum(level, len(PREFIXES) - 1)]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in columns.split()), pa.array(key),
                                              pa.array(level.astype(np.int32))], names=[*columns.split(), "key", "level"])
    return run


def vertical(suffixes: DataFrame, group: int) -> list[np.ndarray]:
    """Bitmaps of the prefixes with more than ``group`` suffixes, one per prefix length, as long as there are such."""
    maps: list[np.ndarray] = []
    while len(maps) < len(PREFIXES):
        level = len(maps)
        counts = (suffixes.select("prefixes").mapInArrow(_keyed(maps, ""), "key long, level int").where(F.col("level") == level)
                  .groupBy("key").count().where(F.col("count") > group))
        bit = F.expr(f"shiftrightunsigned(key, {64 - MARK_BITS}) + 1")
        slices = counts.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("slice")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect()          # 2**MARK_BITS bits at most
        if not slices:
            break
        m = np.zeros(1 << (MARK_BITS - 3), np.uint8)
        for s in slices:
            m[(s["slice"] - 1) * 4096:s["slice"] * 4096] = np.frombuffer(bytes(s["bits"]), np.uint8)
        maps.append(m)
    return maps


def _subtrees(t: pa.Table) -> pa.Table:
    gone = repeated(t.column("words").to_pylist(), t.column("doc").to_numpy())
    return t.select(["unit", "leaf", "back"]).filter(pa.array(gone))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit_bytes: int = UNIT_BYTES,
                    group: int = GROUP, gather: int = GATHER) -> DataFrame:
    """One row per input row: ``doc_id, rid, n_words, n_removed, kept`` (the remaining words, joined by one space, UTF-8).

    Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return.  Null text has no
    words and keeps nothing; a null id is smaller than all others.  Rows that share an id do not remove from each other.  Windows are judged
    on the input, overlaps count, and none crosses documents.  A text is read whole by one task, however long.  An
    empty table gives no rows; other columns of the input, whatever their names, are not read.
    """
    folder = scratch_path(docs.sparkSession, "units")
    units = stage(texts(docs, id_col, text_col).mapInArrow(pack(folder, unit_bytes), UNIT), "unit_index")
    tasks = max(1, -(-units.count() // UNITS_PER_TASK))
    units = units.repartition(tasks, "unit")

    leaves = units.mapInArrow(_leaves(folder), "h long, fp long, first long, unit long, leaf int")
    judged = stage(leaves.repartition("h").sortWithinPartitions("h", "fp", "first").mapInArrow(
        _judged, "unit long, leaf int, ask boolean"), "judged")
    replies = judged.where("NOT ask").select("unit", "leaf", F.lit(ALL).alias("windows"))
    asked = judged.where("ask")
    if not is_empty(asked):
        suffixes = stage(units.groupBy("unit").cogroup(asked.repartition(tasks, "unit").groupBy("unit")).applyInArrow(
            _suffixes(folder), "unit long, leaf int, back int, doc long, words binary, prefixes array<long>"), "suffixes")
        replies = replies.unionAll(_settled(suffixes, group, gather))
    return units.groupBy("unit").cogroup(replies.repartition(tasks, "unit").groupBy("unit")).applyInArrow(
        _removal(folder), "doc_id long, rid long, n_words long, n_removed long, kept binary")


def _settled(suffixes: DataFrame, group: int, gather: int) -> DataFrame:
    """``unit, leaf, windows`` of the suffixes whose window a smaller document has, too."""
    maps = vertical(suffixes, group)
    columns = "unit leaf back doc words"
    keyed = suffixes.mapInArrow(_keyed(maps, columns), "unit long, leaf int, back int, doc long, words binary, key long, level int")
    tasks = max(1, -(-suffixes.count() // gather))
    found = (keyed.where(F.col("level") < len(PREFIXES)).groupBy(F.expr(f"pmod(key, {tasks}L)").alias("task"))
             .applyInArrow(_subtrees, "unit long, leaf int, back int"))
    if len(maps) == len(PREFIXES):
        # Windows that are too frequent themselves: the smallest document of each.
        window = F.expr(f"substring_index(decode(words, 'ISO-8859-1'), ' ', {WINDOW})")
        frequent = keyed.where(F.col("level") == len(PREFIXES)).select("unit", "leaf", "back", "doc", window.alias("window"))
        least = stage(frequent.groupBy("window").agg(F.min("doc").alias("least")), "frequent")
        if least.count() <= FREQUENT:          # each stands for more than ``group`` suffixes
            met = frequent.join(F.broadcast(least), "window")
        else:                                  # copied to every salt of its suffixes
            salts = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
            met = frequent.withColumn("salt", F.expr(f"pmod(xxhash64(unit, leaf), {SALTS}L)")).join(salts.hint("merge"), ["window", "salt"])
        found = found.unionAll(met.where("doc > least").select("unit", "leaf", "back"))
    return found.select("unit", "leaf", F.expr("shiftleft(1, back)").alias("windows"))


def _removal(folder: str):
    def run(t: pa.Table, r: pa.Table) -> pa.Table:
        u, row = _open(t, folder)
        n = len(u.start)
        change = np.zeros(n + 1, np.int64)
        if len(u.at):
            windows = np.zeros(len(u.h), np.int64)
            np.bitwise_or.at(windows, r.column("leaf").to_numpy(), r.column("windows").to_numpy().astype(np.int64))
            mine = windows[u.group]
            mine[u.ids[u.doc[u.at]] > u.who[u.group]] = ALL            # a copy within the unit
            for back in range(SPAN):
                at = np.flatnonzero((mine >> back & 1 == 1) & (back <= u.left) & (WINDOW - back <= u.right))
                change[u.at[at] - back] += 1       # anchors are distinct places
                change[u.at[at] - back + WINDOW] -= 1
        kept = np.cumsum(change[:-1]) == 0
        # A kept word takes the white space after it along, as one space, unless it is its document's last.
        order = np.flatnonzero(kept)
        follows = np.zeros(len(order), bool)
        if len(order):
            follows[:-1] = u.doc[order[1:]] == u.doc[order[:-1]]
        data, edges = u.bytes.copy(), np.zeros(len(u.bytes) + 2, np.int8)
        data[u.end[order[follows]]] = 0x20
        edges[u.start[order]] += 1
        edges -= np.bincount(u.end[order] + follows, minlength=len(edges)).astype(np.int8)
        stay = np.cumsum(edges[:len(data)], dtype=np.int8) > 0
        data, place = data[stay], np.r_[0, np.cumsum(stay)]
        ends = np.cumsum(np.array(row["lengths"], np.int64))
        lost = np.r_[0, np.cumsum(~kept)]
        texts_ = [data[s:e].tobytes() for s, e in zip(place[ends - np.array(row["lengths"], np.int64)].tolist(), place[ends].tolist())]
        return pa.table([pa.array(row["ids"], pa.int64()), pa.array(row["rids"], pa.int64()), pa.array(u.last - u.first, pa.int64()),
                         pa.array(lost[u.last] - lost[u.first], pa.int64()), pa.array(texts_, pa.binary())],
                        names=["doc_id", "rid", "n_words", "n_removed", "kept"])
    return run
