"""Token ids in seekable Zstandard files.

A shard is a run of independent Zstandard frames, each of at most ``FRAME_BYTES``
of little-endian unsigned 32-bit ids, then a skippable frame with the seek table:
per frame its compressed size, its size and the low 32 bits of the XXH64 of its
contents, then a footer (number of frames, descriptor with the checksum flag,
magic number).  This is the public seekable format of Zstandard, so its other
readers can open a shard.  A reader of one document reads the table, fetches the
frames that hold the document's ids and checks each against its checksum.

Documents are range-partitioned and sorted by id, and every task encodes its
range and writes one shard, under a name of its own attempt that is renamed when complete; a
task that runs again after a lost executor leaves at most an unlisted file.  The
index (document → shard, first id, number of ids) is a Parquet table beside the shards.
"""
from __future__ import annotations

import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import texts
from .words import encoder

FRAME_BYTES = 1 << 18
LEVEL = 3
# Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
_ENTRY = struct.Struct("<III")
_FOOTER = struct.Struct("<IBI")


class ShardWriter:
    """Appends bytes to ``out``; cuts frames; ``close`` writes the seek table."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard
        self._out, self._frame_bytes = out, frame_bytes
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._pending, self._entries = bytearray(), []

    def write(self, data: bytes) -> None:
        self._pending += data
        while len(self._pending) >= self._frame_bytes:
            self._flush(self._frame_bytes)

    def _flush(self, n: int) -> None:
        import xxhash
        raw = bytes(self._pending[:n])
        del self._pending[:n]
        frame = self._zstd.compress(raw)
        self._out.write(frame)
        self._entries.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        if self._pending:
            self._flush(len(self._pending))
        table = b"".join(_ENTRY.pack(*e) for e in self._entries)
        table += _FOOTER.pack(len(self._entries), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class ShardReader:
    """Random access to the contents of a shard; keeps the frame read last."""

    def __init__(self, source):
        import zstandard
        self._src, self._zstd = source, zstandard.ZstdDecompressor()
        size = source.size()
        n, flags, magic = _FOOTER.unpack(source.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a seekable shard with checksums")
        at = size - _FOOTER.size - n * _ENTRY.size
        head = struct.unpack("<II", source.read_at(8, at - 8))
        if head != (SKIPPABLE_MAGIC, n * _ENTRY.size + _FOOTER.size):
            raise ValueError("seek table damaged")
        self._frames, begin, offset = [], 0, 0
        for packed, raw, check in _ENTRY.iter_unpack(source.read_at(n * _ENTRY.size, at)):
            self._frames.append((begin, raw, offset, packed, check))
            begin, offset = begin + raw, offset + packed
        self._starts = [f[0] for f in self._frames]
        self._last, self._raw = -1, b""

    def _frame(self, k: int) -> bytes:
        import xxhash
        if k != self._last:
            _, raw, offset, packed, check = self._frames[k]
            data = self._zstd.decompress(self._src.read_at(packed, offset), max_output_size=raw)
            if len(data) != raw or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} fails its checksum")
            self._last, self._raw = k, data
        return self._raw

    def read(self, begin: int, n: int) -> bytes:
        """``n`` bytes from ``begin``, decompressing the frames that hold them only."""
        from bisect import bisect_right
        parts, k = [], bisect_right(self._starts, begin) - 1
        if n and (not self._frames or begin < 0 or begin + n > sum(self._frames[-1][:2])):
            raise ValueError("beyond the end of the shard")
        while n > 0:
            at = begin - self._starts[k]
            part = self._frame(k)[at:at + n]
            parts.append(part)
            begin, n, k = begin + len(part), n - len(part), k + 1
        return b"".join(parts)


def _shard_tasks(folder: str, tokenizer: str, end_id: int, frame_bytes: int):
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("file", pa.string()),
                        ("at", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"ids-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.zst"
        enc, end, at, out = encoder(tokenizer), array("I", [end_id]).tobytes(), 0, None
        for b in batches:
            if out is None and b.num_rows:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/_{name}", compression=None)
                writer = ShardWriter(out, frame_bytes)
            ids, counts, ats = b.column(0), [], []
            for one in enc.encode_all(b.column(1)):
                data = one + end
                writer.write(data)
                ats.append(at)
                counts.append(len(data) // 4)
                at += counts[-1]
            yield pa.RecordBatch.from_arrays([
                ids, pa.array([task.partitionId()] * len(counts), pa.int32()), pa.array([name] * len(counts)),
                pa.array(ats, pa.int64()), pa.array(counts, pa.int64())], schema=schema)
        if out is not None:
            writer.close()
            out.close()
            store.move(f"{root}/_{name}", f"{root}/{name}")
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Encode every text, append ``end_id`` and write the ids in ascending ``doc_id`` order as shards.

    Returns the index, read back from ``folder/index``: ``doc_id, shard, file, at
    (ids of the shard before the document), n_tokens``.  Null text counts as empty (one
    id, ``end_id``); null ids come first; rows that repeat an id follow each other in the order of their
    texts (64 characters, then a hash) and are all written, by as many tasks as they fill.  An empty table gives an empty index and no
    shard.  ``folder`` is a URI of a shared store.
    """
    spark = docs.sparkSession
    order = ["doc_id", "head", "hash"]
    keyed = texts(docs, id_col, text_col).select("doc_id", "text", F.left("text", F.lit(64)).alias("head"), F.xxhash64("text").alias("hash"),
                                                 F.rand(5).alias("salt"))      # equal rows may be parted anywhere
    ordered = keyed.repartitionByRange(*order, "salt").sortWithinPartitions(*order, "text").select("doc_id", "text")
    ordered.mapInArrow(_shard_tasks(f"{folder}/shards", tokenizer, end_id, frame_bytes),
                       "doc_id long, shard int, file string, at long, n_tokens long"
                       ).write.parquet(f"{folder}/index")
    return read_index(spark, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("doc_id long, shard int, file string, at long, n_tokens long").parquet(f"{folder}/index")


def read_token_files(index: DataFrame, folder: str) -> DataFrame:
    """Ids of the documents in ``index`` (any subset), read from the shards: its columns and ``ids`` (binary)."""
    schema = pa.schema([("doc_id", pa.int64()), ("shard", pa.int32()), ("file", pa.string()),
                        ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(f"{folder}/shards")
        name, reader, source = None, None, None
        for b in batches:
            got = []
            for file, at, n in zip(*(b.column(k).to_pylist() for k in (2, 3, 4))):
                if file != name:
                    if source is not None:
                        source.close()
                    source = store.open_input_file(f"{root}/{file}")
                    name, reader = file, ShardReader(source)
                got.append(reader.read(4 * at, 4 * n))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.binary())], schema=schema)
        if source is not None:
            source.close()
    return index.select("doc_id", "shard", "file", "at", "n_tokens").mapInArrow(
        run, "doc_id long, shard int, file string, at long, n_tokens long, ids binary")


def starts(rows: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``rows`` (of the index, or read by it) with ``start``: the ids of all documents before each one.

    The running sum goes over one row per shard (as many as write tasks), never over documents; it is
    taken from the whole ``index``, so the files are not read for it.
    """
    totals = (rows if index is None else index).groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = totals.select("shard", (F.sum("_n").over(Window.orderBy("shard")) - F.col("_n")).alias("_before"))
    return rows.join(before, "shard").withColumn("start", F.col("_before") + F.col("at")).drop("_before")


def crc32_ids(data: str = "ids"):
    """Unsigned CRC-32 of a binary column, as a Spark expression."""
    return F.crc32(F.col(data)).cast("long")


def crc32(data: bytes) -> int:
    return zlib.crc32(data)
