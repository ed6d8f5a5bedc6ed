"""Exact top-k by inner product: no-random-access aggregation over sorted lists.

Each dimension is a list of the candidates in order of their component; a query reads it from its good end (the top for a positive
query component, the bottom for a negative one).  An entry that has not been read lies between the list's frontier and its far end, so a
candidate's score lies between its known part plus what the unread lists give at least, and plus what they give at most.  A query reads
its lists one after another, those first that can move a score most, each to its end: an unread list's frontier is then its first entry, and the
bounds of all candidates follow from their known parts by two numbers.

Known parts are carried on, and an entry is read once.  After each part of its lists, candidates whose upper bound does not reach
the query's k-th best lower bound leave, and nothing more is read of them; when few are left, no outsider can
qualify, and the finalists' scores are resolved.  The best scores of the candidates read before are the lower bounds for later ones.

Blocks of candidates and of queries are written once; a task has one block of queries and fetches its candidate blocks by their
place, so the shuffle holds block numbers and results only.  All numbers are integers: products run in floating
point only while every partial sum is exact there, else in wider integers, by the same steps.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import stage

SCALE = 256.0
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
BLOCKS_PER_TASK = 64
FINALISTS = 64
FIRST = 512                                    # candidates that are read first where nothing is known of the k-th score
PARTS = (0.88, 0.95, 0.98)                     # of what a query's lists can move a score, after which candidates are sorted out


def _numbers(x: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices in the narrowest kind of number that holds every partial sum exactly."""
    bound = x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0))
    if bound < 2 ** 53:
        kind = np.float32 if bound < 2 ** 24 else np.float64
        return x.astype(kind), q.astype(kind)
    whole = lambda a: np.array([[int(v) for v in r] for r in a], object).reshape(a.shape)
    return whole(x), whole(q)


class Best:
    """The k best of each query so far: scores and ids, scores from the largest."""

    def __init__(self, queries: int, k: int):
        self.k, self.found = k, [[] for _ in range(queries)]

    def floor(self, lowest) -> list:
        """A lower bound of each query's k-th best score."""
        return [f[-1][0] if len(f) == self.k else lowest for f in self.found]

    def add(self, query: int, scores, ids) -> None:
        some = [(int(s), int(i)) for s, i in zip(scores, ids)]
        self.found[query] = sorted(self.found[query] + some, key=lambda p: (-p[0], p[1]))[:self.k]


def top_block(x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, best: Best) -> int:
    """Adds a block's candidates to ``best`` as far as they qualify; returns how many entries were read (of
    ``len(x) * len(q) * width``)."""
    x, q = _numbers(x, q)
    first = FIRST if len(x) > FIRST and not all(len(f) == best.k for f in best.found) else 0
    read = _read(x[:first], ids[:first], q, qids, best) if first else 0      # a few candidates give the first lower bounds
    return read + _read(x[first:], ids[first:], q, qids, best)


def _read(x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, best: Best) -> int:
    (n, width), k = x.shape, best.k
    if not n or not len(q):
        return 0
    most, least = (x.max(0), x.min(0)) if width else (x[0], x[0])          # the ends of the lists
    high, low = np.maximum(q * most, q * least), np.minimum(q * most, q * least)
    order, cuts = _schedule((high - low).astype(float))
    # the first part of each query's lists, all queries at once: lists that wait count nothing
    waiting = np.ones(q.shape, bool)
    np.put_along_axis(waiting, order[:, :cuts[0]], False, axis=1)
    known = x @ np.where(waiting, 0, q).T.astype(x.dtype)
    read = n * len(q) * cuts[0]
    above = np.where(waiting, high, 0).sum(1)
    lowest = min(low.sum(1).min(), min((f[-1][0] for f in best.found if f), default=0))
    outside = lowest - abs(lowest) - 1         # below every score
    floor = np.array(best.floor(outside), object if x.dtype == object else np.float64)
    own = ids[:, None] == qids[None, :]
    known[own] = outside
    open_ = (known >= (floor - above)[None, :]) & ~own
    count = open_.sum(0)
    many = np.flatnonzero(count * 2 > n)       # nothing can stop here: the other lists, all at once
    if len(many):
        rest = x @ np.where(waiting[many], q[many], 0).T.astype(x.dtype)
        read += n * len(many) * (width - cuts[0])
    for place, c in enumerate(many.tolist()):
        scores = np.where(own[:, c], outside, known[:, c] + rest[:, place])
        _keep(best, c, scores, ids, floor[c], outside)
    for c in np.flatnonzero((count > 0) & (count * 2 <= n)).tolist():
        rows = np.flatnonzero(open_[:, c])
        part, at = known[rows, c], cuts[0]
        for cut in cuts[1:]:
            if len(rows) <= max(FINALISTS, k):
                cut = width                    # no outsider can qualify: the finalists' scores are resolved
            lists = order[c, at:cut]
            part = part + x[np.ix_(rows, lists)] @ q[c, lists]
            read += len(rows) * len(lists)
            at = cut
            if at == width:
                break
            stay = part + high[c, order[c, at:]].sum() >= floor[c]
            rows, part = rows[stay], part[stay]
        _keep(best, c, part, ids[rows], floor[c], outside)
    return read


def _schedule(moves: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Each query's lists by how far they can move a score, and after how many of them candidates are sorted out."""
    order = np.argsort(-moves, axis=1, kind="stable")
    total = moves.sum(1, keepdims=True)
    share = np.cumsum(np.take_along_axis(moves / np.where(total > 0, total, 1), order, 1), axis=1).mean(0)
    width = moves.shape[1]
    return order, [min(width, int(np.searchsorted(share, p)) + 1) for p in PARTS] + [width]


def _keep(best: Best, query: int, scores: np.ndarray, ids: np.ndarray, floor, outside) -> None:
    k = best.k
    if len(scores) > k:                        # ties at the k-th score stay
        floor = max(floor, np.partition(scores, len(scores) - k)[len(scores) - k])
    stay = (scores >= floor) & (scores > outside)
    best.add(query, scores[stay], ids[stay])


def vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``rid, vec_id, v`` with ``v = floor(scale * x)`` as doubles, of the rows that take part."""
    whole = "forall(x, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('inf'))"
    return (table.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("vec_id"),
                         F.col(vector_col).cast("array<double>").alias("x"))
            .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(whole)
            .select("rid", "vec_id", F.transform("x", lambda e: F.floor(e * scale).cast("double")).alias("v")))


def top_k(table: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = SCALE, candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best candidates of each row whose id is divisible by ``every``.

    Vectors that are null or hold a null or non-finite component, and rows without an id, take no
    part.  A query's own row, and any other row with its id, is no candidate.  Shorter vectors count as
    padded with zeros (an empty one scores 0).  Rows that repeat a query's id are queries of their own.
    Equal scores go to the smaller id.  A score beyond 64 bits
    ranks by its true value and is returned as the nearest long.  An empty table gives no rows; with fewer than k
    candidates all are returned.  Other columns of the input, whatever their names, are not read.
    """
    spark = table.sparkSession
    folder = scratch_path(spark, "vector-blocks")
    rows = vectors(table, id_col, vector_col, scale)
    blocks = _written(rows, folder, "c", candidate_block)
    n = blocks.count()
    asked = rows.where(F.col("vec_id") % every == 0)
    asks = _written(asked.repartition(max(1, -(-asked.count() // query_block))), folder, "q", query_block)
    m = asks.count()
    if not n or not m:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # a task: one block of queries with some blocks of candidates
    some = max(1, min(BLOCKS_PER_TASK, n * m // spark.sparkContext.defaultParallelism // 4))
    groups = blocks.groupBy(F.expr(f"number div {some}").alias("group")).agg(F.collect_list(F.struct("file", "at", "size")).alias("candidates"))
    pairs = groups.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))).join(asks, "number")
    tasks = -(-n // some) * m
    best = pairs.select("file", "at", "size", "candidates").repartition(min(tasks, MOST_TASKS)).mapInArrow(
        _aggregated(folder, k), "query_id long, q_row long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


MOST_TASKS = 20_000


def _written(rows: DataFrame, folder: str, kind: str, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors in files of the shared folder: ``number`` (from 0), ``file, at, size``."""
    schema = pa.schema([("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        task, pack = TaskContext.get(), zstandard.ZstdCompressor(level=1).compress
        name, at, out = f"{kind}-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}", 0, None
        held: list[pa.RecordBatch] = []

        def flush() -> pa.RecordBatch:
            nonlocal at, out
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(f"{root}/_{name}", compression=None)
            t = pa.Table.from_batches(held).combine_chunks()
            sizes = np.diff(t.column("v").combine_chunks().offsets.to_numpy()) if t.num_rows else np.zeros(0, np.int64)
            width = int(sizes.max(initial=0))
            matrix = np.zeros((t.num_rows, width))                     # shorter vectors count as padded with zeros
            matrix[np.arange(width)[None, :] < sizes[:, None]] = t.column("v").combine_chunks().flatten().to_numpy()
            ids = np.stack([t.column(c).to_numpy() for c in ("vec_id", "rid")])
            frame = pack(np.array([t.num_rows, width], np.int64).tobytes() + ids.tobytes() + matrix.tobytes())
            out.write(frame)
            got = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([at]), pa.array([len(frame)])], schema=schema)
            at += len(frame)
            held.clear()
            return got
        for b in batches:
            while b.num_rows:
                room = size - sum(h.num_rows for h in held)
                held.append(b.slice(0, room))
                b = b.slice(room)
                if sum(h.num_rows for h in held) == size:
                    yield flush()
        if held:
            yield flush()
        if out is not None:
            out.close()
            store.move(f"{root}/_{name}", f"{root}/{name}")
    index = stage(rows.mapInArrow(run, "file string, at long, size long"), "blocks")
    return index.withColumn("number", F.row_number().over(Window.orderBy("file", "at")).cast("long") - 1)


def _block(store, root: str, handle: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, row numbers and vectors of a written block."""
    import zstandard
    with store.open_input_file(f"{root}/{handle['file']}") as f:
        data = zstandard.ZstdDecompressor().decompress(f.read_at(handle["size"], handle["at"]))
    n, width = np.frombuffer(data, np.int64, 2).tolist()
    ids = np.frombuffer(data, np.int64, 2 * n, 16).reshape(2, n)
    return ids[0], ids[1], np.frombuffer(data, np.float64, n * width, 16 + 16 * n).reshape(n, width)


def _aggregated(folder: str, k: int):
    schema = pa.schema([("query_id", pa.int64()), ("q_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def wide(x: np.ndarray, width: int) -> np.ndarray:
        return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            for row in b.to_pylist():
                qids, qrows, q = _block(store, root, row)
                best = Best(len(qids), k)
                for handle in row["candidates"]:
                    ids, _, x = _block(store, root, handle)
                    width = max(x.shape[1], q.shape[1])
                    top_block(wide(x, width), ids, wide(q, width), qids, best)
                got = [(int(qids[i]), int(qrows[i]), v, max(-1 << 63, min((1 << 63) - 1, s))) for i, f in enumerate(best.found) for s, v in f]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), schema.types)] if got else [pa.array([], t) for t in schema.types],
                                                 schema=schema)
    return run
