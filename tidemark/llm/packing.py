"""First-fit decreasing packing with a tournament tree of bin capacities.

A document's ids are cut into pieces of exactly ``capacity`` ids and one shorter
tail.  A full piece fills a sequence by itself.  The tails are dealt at random (a hash of
document, cut and seed) to groups of about ``group_size``; each group is packed
alone: longest tails first, each into the first bin that still holds it, which a
tournament tree over the bins' free room finds in O(log bins).  Groups share nothing, so
they run in parallel and a lost one is packed again with the same result.  Only
(document, cut, length) rows are dealt; the ids stay in the written pieces.
"""
from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, texts
from .words import encoder

CAPACITY = 2048
GROUP_SIZE = 8192
SEED = 20


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length, which come in descending order; bins are numbered as they open.

    ``tree`` is a complete binary tree whose leaves are the free room of the bins
    (an unopened bin has it all) and whose inner nodes hold the larger child.
    """
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    placed = []
    for n in lengths:
        node = 1
        while node < leaves:                   # leftmost bin with room
            node *= 2
            if tree[node] < n:
                node += 1
        room = tree[node]
        placed.append((node - leaves, capacity - room))
        tree[node] = room - n
        node //= 2
        while node:
            tree[node] = max(tree[2 * node], tree[2 * node + 1])
            node //= 2
    return placed


def _cutter(tokenizer: str, end_id: int, capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                        ("doc_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, step = encoder(tokenizer), array("I", [end_id]).tobytes(), 4 * capacity
        for b in batches:
            rows: list[tuple] = []
            for doc, ids, rid in zip(b.column(0).to_pylist(), enc.encode_all(b.column(1)), b.column(2).to_pylist()):
                data = ids + end
                for at in range(0, len(data), step):
                    part = data[at:at + step]
                    rows.append((doc, rid, at // 4, len(part) // 4, len(data) // 4, part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)] if rows else [pa.array([], t) for t in schema.types],
                schema=schema)
    return run


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written pieces: ``doc_id, rid, start, length, doc_tokens, ids`` (little-endian unsigned 32-bit)."""
    return stage(texts(docs, id_col, text_col).mapInArrow(
        _cutter(tokenizer, end_id, capacity),
        "doc_id long, rid long, start long, length long, doc_tokens long, ids binary"), "pieces")


def _packer(capacity: int):
    schema = pa.schema([("rid", pa.int64()), ("start", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        order = table.sort_by([("length", "descending"), ("rid", "ascending"), ("start", "ascending")])
        group = order.column("group")[0].as_py() if order.num_rows else 0
        placed = first_fit_decreasing(order.column("length").to_pylist(), capacity)
        return pa.table([order.column("rid"), order.column("start"),
                         pa.array([2 * ((group << 32) + k) for k, _ in placed], pa.int64()),
                         pa.array([at for _, at in placed], pa.int64())], schema=schema)
    return run


def place(pieces: DataFrame, capacity: int = CAPACITY, group_size: int = GROUP_SIZE, seed: int = SEED) -> DataFrame:
    """``rid, start, sequence_id, offset`` of every piece (written columns ``rid, start, length`` suffice).

    Sequence ids are unique, not dense: odd for a full piece, even for a packed sequence.
    """
    keys = pieces.select("rid", "start", "length")
    full = keys.where(F.col("length") >= capacity).select(
        "rid", "start", (2 * F.monotonically_increasing_id() + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    tails = keys.where(F.col("length") < capacity)
    n = tails.count()
    groups = max(1, -(-n // group_size))
    packed = tails.withColumn("group", F.expr(f"pmod(xxhash64(rid, start, {seed}L), {groups})")).groupBy("group").applyInArrow(
        _packer(capacity), "rid long, start long, sequence_id long, offset long")
    return full.unionAll(packed)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                   group_size: int = GROUP_SIZE, seed: int = SEED, id_col: str = "doc_id",
                   text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(pieces, places)``: the cut ids and where each piece lies; they join on ``(rid, start)``.

    Null text counts as empty (one id, ``end_id``).  Rows that repeat an id are packed
    each (``rid`` tells them apart); a null id stays null.  An empty table gives no
    pieces.  Every id lies in exactly one piece; offsets in a sequence are gapless from 0.
    """
    pieces = cut_documents(docs, tokenizer, end_id, capacity, id_col, text_col)
    return pieces, place(pieces, capacity, group_size, seed)


def sequences(pieces: DataFrame, places: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The padded sequences themselves: ``sequence_id, length, ids`` (array of ``capacity`` ints, padded with ``pad_id``)."""
    def build(table: pa.Table) -> pa.Table:
        order = table.sort_by("offset")
        ids = b"".join(order.column("ids").to_pylist())
        n = len(ids) // 4
        full = array("I", ids) + array("I", [pad_id] * (capacity - n))
        return pa.table([order.column("sequence_id").slice(0, 1).combine_chunks(), pa.array([n], pa.int64()),
                         pa.array([full.tolist()], pa.list_(pa.int64()))], names=["sequence_id", "length", "ids"])
    return (pieces.select("rid", "start", "ids").join(places, ["rid", "start"]).select("sequence_id", "offset", "ids")
            .groupBy("sequence_id").applyInArrow(build, "sequence_id long, length long, ids array<long>"))
