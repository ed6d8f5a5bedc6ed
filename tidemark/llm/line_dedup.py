"""Line dedup over content-defined chunks of lines.

A text is cut into lines at ``\\n``.  A line ends a chunk when a rolling hash over the
hashes of the last ``window`` lines falls on a fixed residue, so where a chunk ends
depends on nearby lines only: lines inserted before a shared passage shift
its chunks but do not change them.  A chunk has at least ``least`` and at most
``most`` lines (the last one of a text may be shorter).

Multi-line chunks whose hash occurs more than once are compared with the first
chunk of that hash byte by byte; equal ones, other than the first, are removed.
Chunks that share a hash but not the bytes are compared among themselves in turn.
First means smallest (doc_id, scan order, place in the text).

``line_dedup`` is that step alone.  Most texts have few lines, so a shared passage often
holds no whole chunk; ``passage_dedup`` therefore also looks up every window of two lines by the
same rolling hash.  Lines whose every neighbouring pair stands earlier form a run: it is what a
repeated chunk extends to at both ends, line by line, and it is removed without a
chunk as well if it has more than ``WORDS`` words.
"""
from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import is_empty, packed_texts, stage, unpack

WINDOW = 2
DIVISOR = 3
LEAST = 2
MOST = 64
WORDS = 50
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15


def line_chunks(lines: list[bytes], window: int = WINDOW, divisor: int = DIVISOR, least: int = LEAST,
                most: int = MOST) -> list[tuple[int, int]]:
    """Chunks as (first line, end line), covering all lines."""
    import xxhash
    drop = pow(_BASE, window, 1 << 64)
    rolled, first, chunks, seen = 0, 0, [], []
    for i, line in enumerate(lines):
        h = xxhash.xxh64_intdigest(line)
        seen.append(h)
        rolled = (rolled * _BASE + h) & _MASK
        if i >= window:
            rolled = (rolled - seen[i - window] * drop) & _MASK
        n = i + 1 - first
        if n >= most or n >= least and (rolled >> 32) % divisor == 0:
            chunks.append((first, i + 1))
            first = i + 1
    if first < len(lines):
        chunks.append((first, len(lines)))
    return chunks


def _chunker(args: tuple[int, int, int, int]):
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32()), ("n_lines", pa.int32()),
                        ("hash", pa.int64()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            cols: list[list] = [[] for _ in schema]
            for doc, packed, rid in zip(*(c.to_pylist() for c in b.columns)):
                lines = unpack(packed).split(b"\n")
                for k, (first, end) in enumerate(line_chunks(lines, *args)):
                    if end - first > 1:
                        body = b"\n".join(lines[first:end])
                        h = xxhash.xxh64_intdigest(body)
                        for c, v in zip(cols, (rid, doc, k, end - first, h - (1 << 64) if h >> 63 else h, body)):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
    return run


def _rebuilder(args: tuple[int, int, int, int]):
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("n_lines", pa.int64()), ("n_chunks", pa.int64()),
                        ("n_removed_lines", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for rid, doc, packed, gone, n in zip(*(c.to_pylist() for c in b.columns)):
                lines = unpack(packed).split(b"\n")
                chunks = line_chunks(lines, *args)
                gone = set(gone or ())
                kept = [x for k, (first, end) in enumerate(chunks) if k not in gone for x in lines[first:end]]
                for c, v in zip(out, (doc, rid, len(lines), len(chunks), n or 0, b"\n".join(kept).decode())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)
    return run


def _later_copies(again: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the units that equal the first one of their hash (``hash, place, first, body``) bytewise."""
    removed = []
    while True:
        firsts = again.where("place = first").select("hash", F.col("body").alias("first_body"))
        judged = stage(again.join(firsts, "hash").withColumn("same", F.expr("body = first_body"))
                       .withColumn("body", F.expr("CASE WHEN NOT same THEN body END")).drop("first_body"), "judged")
        removed.append(judged.where("same AND place <> first").select(*columns))
        others = judged.where("NOT same").drop("same", "first")      # equal hash, other bytes
        if is_empty(others):
            break
        again = stage(others.join(others.groupBy("hash").agg(F.min("place").alias("first")), "hash"), "copies")
    return reduce(DataFrame.unionAll, removed)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
               divisor: int = DIVISOR, least: int = LEAST, most: int = MOST) -> DataFrame:
    """One row per input row: ``doc_id, rid, n_lines, n_chunks, n_removed_lines, text`` (what is left).

    Null text counts as empty: one empty line, kept.  Rows that repeat a text keep
    its multi-line chunks once, in the first row.  A null id comes before all others.  A removed
    chunk goes with its line break; an empty table gives no rows.
    """
    rows = stage(packed_texts(docs, id_col, text_col), "line_docs")
    chunks = rows.mapInArrow(_chunker((window, divisor, least, most)),
                             "rid long, doc_id long, chunk int, n_lines int, hash long, body binary")
    # A chunk's place: document order, then number in the text.
    multi = chunks.withColumn("place", F.struct("doc_id", "rid", "chunk"))
    copies = stage(multi.select("hash", "place").groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).where("n > 1").drop("n"), "chunk_hashes")
    again = stage(multi.select("hash", "rid", "chunk", "n_lines", "place", "body")
                  .join(copies.hint("merge"), "hash"), "copies")
    removed = _later_copies(again, ["rid", "chunk", "n_lines"])
    gone = removed.groupBy("rid").agg(
        F.collect_set("chunk").alias("gone"), F.sum("n_lines").cast("long").alias("n_removed_lines"))
    # merge joins at every size: neither side has a size bound
    return rows.join(gone.hint("merge"), "rid", "left").mapInArrow(
        _rebuilder((window, divisor, least, most)),
        "doc_id long, rid long, n_lines long, n_chunks long, n_removed_lines long, text string")


def _words(line: bytes) -> int:
    """Words of a line; where white space does not part them, one for six bytes."""
    return max(len(line.split()), len(line) // 6)


def runs(lines: list[bytes], chunks: list[tuple[int, int]], gone: set[int], pairs: set[int], words: int = WORDS) -> list[tuple[int, int]]:
    """Runs to remove as (first line, end line): ``gone`` are repeated chunks, ``pairs`` first lines of repeated windows."""
    found: list[list[int]] = []
    for i in sorted(pairs):
        if found and found[-1][1] == i + 1:
            found[-1][1] = i + 2
        else:
            found.append([i, i + 2])
    if not found:
        return []
    held, k, ends = [False] * len(found), 0, sorted(chunks[c] for c in gone)
    for a, z in ends:                              # the pairs of a repeated chunk are repeated, so one run holds it
        while found[k][1] < z:
            k += 1
        held[k] = True
    return [(a, z) for (a, z), h in zip(found, held) if h or sum(map(_words, lines[a:z])) > words]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rolling hash of every two neighbouring lines and the place of the first."""
    import xxhash
    names = ["hash", "rid", "line"]
    for b in batches:
        hashes, rids, at = array("Q"), array("q"), array("i")
        for packed, rid in zip(*(c.to_pylist() for c in b.columns)):
            seen = [xxhash.xxh64_intdigest(x) for x in unpack(packed).split(b"\n")]
            n = len(seen) - 1
            hashes.extend([(x * _BASE + y) & _MASK for x, y in zip(seen, seen[1:])])
            rids.extend([rid] * n)
            at.extend(range(n))
        yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(c, t)) for c, t in
                                          zip((hashes, rids, at), (np.int64, np.int64, np.int32))], names=names)


def _candidates(args: tuple[int, int, int, int]):
    """Windows whose hash occurs again (``chunk`` is the first line), and chunks that consist of such windows."""
    schema = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("whole", pa.bool_()), ("chunk", pa.int32()),
                        ("hash", pa.int64()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            cols: list[list] = [[] for _ in schema]
            for doc, packed, rid, at in zip(*(c.to_pylist() for c in b.columns)):
                lines, again = unpack(packed).split(b"\n"), set(at)
                units = [(False, i, i, i + 2) for i in at]
                units += [(True, k, a, z) for k, (a, z) in enumerate(line_chunks(lines, *args))
                          if z - a > 1 and again.issuperset(range(a, z - 1))]
                for whole, k, a, z in units:
                    body = b"\n".join([b"C" if whole else b"W", *lines[a:z]])       # a chunk never equals a window
                    h = xxhash.xxh64_intdigest(body)
                    for c, v in zip(cols, (rid, doc, whole, k, h - (1 << 64) if h >> 63 else h, body)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)
    return run


def _without_runs(args: tuple[int, int, int, int], words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("n_lines", pa.int64()), ("n_chunks", pa.int64()),
                        ("n_removed_lines", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for rid, doc, packed, gone, pairs in zip(*(c.to_pylist() for c in b.columns)):
                lines = unpack(packed).split(b"\n")
                chunks = line_chunks(lines, *args)
                kept, at = [], 0
                for a, z in runs(lines, chunks, set(gone or ()), set(pairs or ()), words):
                    kept += lines[at:a]
                    at = z
                kept += lines[at:]
                for c, v in zip(out, (doc, rid, len(lines), len(chunks), len(lines) - len(kept), b"\n".join(kept).decode())):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)
    return run


def passage_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                  divisor: int = DIVISOR, least: int = LEAST, most: int = MOST, words: int = WORDS) -> DataFrame:
    """``line_dedup``, with repeated chunks extended and every repeated run of two or more lines and over ``words`` words removed.

    Same columns and rules.  Every removed line stands earlier, next to an equal neighbour.
    """
    args = (window, divisor, least, most)
    rows = stage(packed_texts(docs, id_col, text_col), "line_docs")
    windows = rows.select("text", "rid").mapInArrow(_windows, "hash long, rid long, line int")
    common = stage(windows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "window_hashes")
    at = windows.join(common.hint("merge"), "hash").groupBy("rid").agg(F.sort_array(F.collect_list("line")).alias("at"))
    units = stage(rows.join(at.hint("merge"), "rid").select("doc_id", "text", "rid", "at").mapInArrow(
        _candidates(args), "rid long, doc_id long, whole boolean, chunk int, hash long, body binary")
        .withColumn("place", F.struct("doc_id", "rid", "whole", "chunk")).drop("doc_id"), "units")
    firsts = stage(units.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first")).where("n > 1").drop("n"), "unit_hashes")
    later = _later_copies(stage(units.join(firsts.hint("merge"), "hash"), "copies"), ["rid", "whole", "chunk"])
    gone = later.groupBy("rid").agg(F.expr("collect_list(chunk) FILTER (WHERE whole)").alias("gone"),
                                    F.expr("collect_list(chunk) FILTER (WHERE NOT whole)").alias("pairs"))
    return rows.join(gone.hint("merge"), "rid", "left").select("rid", "doc_id", "text", "gone", "pairs").mapInArrow(
        _without_runs(args, words), "doc_id long, rid long, n_lines long, n_chunks long, n_removed_lines long, text string")
