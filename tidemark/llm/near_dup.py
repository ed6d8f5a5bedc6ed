"""MinHash near-dedup with BagMinHash signatures.

A document is the multiset of its ``SHINGLE``-word shingles (lower-cased words between white
space).  Similarity is the weighted Jaccard of two multisets: sum of minima over sum of maxima of the counts.

1. Documents with the same words are one class (128-bit fingerprint); only a representative goes on.
2. BagMinHash.  The weights' axis is cut into dyadic blocks (0,1], (1,2], (2,4], ...  Each (shingle, block)
   has its own Poisson process, seeded by both, whose rate grows with the block's width; a point has a
   time, a signature slot and a place within the block.  Points with a place up to the shingle's
   count belong to the document: whole blocks always, the block that holds the count by the place (the
   discretised weight).  A slot's value is its earliest point, so two
   documents agree in a slot with probability equal to their similarity.  Processes run in order of time and stop once
   they pass the latest slot, which is why long documents cost about one point per shingle.
3. Bands of ``ROWS`` slots give buckets.  Each bucket's first member is its centre; every member is verified against
   it by exact multiset overlap (the texts' own shingles), never pairwise.  Verified links give components.
4. Buckets that still hold several components (of buckets with the same members one): members outside the centre's component meet
   all members in blocks of bounded size inside a task, which counts the shingles that each outsider shares with every
   member through an inverted index of the block.  Every pair of different components is judged by its exact overlap; once two
   components are joined in a task, their pairs need no test, so a block gives fewer links than it has members and no pair becomes a row.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROW_ORDER, is_empty, packed_texts, stage, unpack
from .words import Cached, start_task

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 30
ROWS = 5
POINTS = 50_000                                # points drawn at once
BLOCK = 2048                                   # members of a bucket compared in one task
BLOCK_BYTES = 4 << 20                          # and their packed texts
KEPT_SHINGLES = 2 << 20                        # counted texts that a task keeps: 32 MB
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hash(word: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


_words = Cached(_word_hash)


def word_hashes(text: str) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """Shingle hashes of one document in order; fewer than ``SHINGLE`` words are one shingle."""
    n = len(words)
    if not n:
        return words
    if n < SHINGLE:
        words = np.concatenate([words, np.full(SHINGLE - n, n, np.uint64)])
        n = SHINGLE
    out = np.zeros(n - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        out = _mix(out * _GOLDEN + words[k:n - SHINGLE + 1 + k])
    return out


def counted(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingles(words), return_counts=True)


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard of two counted multisets; two empty ones are equal."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (total - both)


def signatures(doc: np.ndarray, key: np.ndarray, count: np.ndarray, docs: int, slots: int) -> np.ndarray:
    """BagMinHash signatures (docs × slots of times; infinite for a document without shingles)."""
    # (shingle, dyadic block) entries: lower end, width and whether the count covers the block
    entry_doc, entry_key, lower, width, whole, level = [doc], [key], [np.zeros(len(key))], [np.ones(len(key))], [np.ones(len(key), bool)], 1
    while True:
        more = np.flatnonzero(count > level)
        if not len(more):
            break
        entry_doc.append(doc[more])
        entry_key.append(_mix(key[more] + np.uint64(level * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF)))
        lower.append(np.full(len(more), float(level)))
        width.append(np.full(len(more), float(level)))
        whole.append(count[more] >= 2 * level)
        level *= 2
    top = [count.astype(np.float64)]
    level = 1
    while len(top) < len(entry_doc):
        top.append(count[count > level].astype(np.float64))
        level *= 2
    d, s, lo, wd, full, ct = map(np.concatenate, (entry_doc, entry_key, lower, width, whole, top))
    time = np.zeros(len(d))
    out = np.full(docs * slots, np.inf)
    step = np.zeros(len(d), np.uint64)
    while len(d):
        p = int(max(1, min(64, POINTS // len(d))))
        number = step[:, None] + np.arange(1, p + 1, dtype=np.uint64)[None, :]
        r = _mix(s[:, None] + number * _GOLDEN)
        gap = -np.log1p(-(r >> np.uint64(11)).astype(np.float64) * 2.0 ** -53) / wd[:, None]
        times = time[:, None] + np.cumsum(gap, axis=1)
        r = _mix(r ^ np.uint64(0xD6E8FEB86659FD93))
        slot = ((r >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
        place = np.ceil(lo[:, None] + wd[:, None] * ((r & np.uint64(0xFFFFFFFF)).astype(np.float64) + 1) * 2.0 ** -32)
        inside = full[:, None] | (place <= ct[:, None])
        np.minimum.at(out, (d[:, None] * slots + slot)[inside], times[inside])
        latest = out.reshape(docs, slots).max(axis=1)
        go = times[:, -1] < latest[d]
        d, s, lo, wd, full, ct, time, step = (x[go] for x in (d, s, lo, wd, full, ct, times[:, -1], step + np.uint64(p)))
    return out.reshape(docs, slots)


def _sketch(bands: int, rows: int):
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("text", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_task()
        for b in batches:
            words = [word_hashes(unpack(t).decode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()]
            prints = np.zeros((len(words), 2), np.uint64)
            bags = [counted(w) for w in words]
            for i, w in enumerate(words):
                place = np.arange(1, len(w) + 1, dtype=np.uint64) * _GOLDEN
                prints[i] = (_mix(w ^ place)).sum(dtype=np.uint64) + np.uint64(len(w)), _mix(_mix(w) + place).sum(dtype=np.uint64)
            sizes = np.array([len(x[0]) for x in bags], np.int64)
            doc = np.repeat(np.arange(len(bags)), sizes)
            sig = signatures(doc, np.concatenate([x[0] for x in bags]), np.concatenate([x[1] for x in bags]), len(bags), bands * rows)
            bits = sig.view(np.uint64).reshape(len(bags), bands, rows)
            band = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64)[None, :], bits.shape[:2]).copy()
            for k in range(rows):
                band = _mix(band * _GOLDEN + bits[:, :, k])
            keys = [x.view(np.int64) if n else np.zeros(0, np.int64) for x, n in zip(band, sizes)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(2), pa.array(prints[:, 0].copy().view(np.int64)), pa.array(prints[:, 1].copy().view(np.int64)),
                b.column(1), pa.array(keys, pa.list_(pa.int64()))], schema=schema)
    return run


class Bags:
    """Counted texts by row number; those met recently stay, up to ``KEPT_SHINGLES`` different shingles."""

    def __init__(self):
        self.kept: dict[int, tuple] = {}
        self.size = 0

    def get(self, rid: int, packed: bytes) -> tuple:
        got = self.kept.pop(rid, None)
        if got is None:
            got = counted(word_hashes(unpack(bytes(packed)).decode("utf-8", "surrogatepass")))
            self.size += len(got[0])
            while self.kept and self.size > KEPT_SHINGLES:
                self.size -= len(self.kept.pop(next(iter(self.kept)))[0])
        self.kept[rid] = got                   # the last one met goes last
        return got


def _overlap():
    """Similarity of two packed texts, row by row."""
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        start_task()
        bags = Bags()
        for batch in batches:
            yield pd.Series([similarity(bags.get(u, x), bags.get(v, y)) for u, x, v, y in zip(*batch)], dtype="float64")
    return F.pandas_udf(run, "double")


def _verified(pairs: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """Links (u, v) among candidate ``pairs`` whose texts overlap enough."""
    left = members.select(F.col("rid").alias("u"), F.col("text").alias("u_text"))
    right = members.select(F.col("rid").alias("v"), F.col("text").alias("v_text"))
    both = pairs.join(left, "u").join(right.hint("merge"), "v")
    return stage(both.select("u", "v", _overlap()("u", "u_text", "v", "v_text").alias("similarity"))
                 .where(F.col("similarity") >= least).select("u", "v"), "links")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, label`` (smallest node of the component) of every node with a link.

    Alternating large-star and small-star steps; each is an aggregate joined back, so a hub
    is reduced on the map side and no neighbourhood is gathered.  Every round is written, which cuts the lineage.
    """
    edges = stage(links.selectExpr("greatest(u, v) AS a", "least(u, v) AS b").where("a <> b").distinct(), name)
    seen = None
    while True:
        both = edges.unionAll(edges.selectExpr("b AS a", "a AS b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        large = both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b").where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("explode(array(struct(b AS a, m AS b), struct(a AS a, m AS b))) AS e").select("e.*")
        edges = stage(small.where("a <> b").distinct(), name)
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("coalesce(sum(CAST(xxhash64(a, b) AS DECIMAL(20,0))), 0)").alias("s")).first()
        if now == seen:
            break
        seen = now
    return edges.groupBy("a").agg(F.min("b").alias("label")).selectExpr("a AS node", "label").unionAll(
        edges.selectExpr("b AS node", "b AS label").distinct())


def block_links(outside: list[tuple], members: list[tuple], least: float) -> list[tuple[int, int]]:
    """Links (greater, smaller row) that join components: ``outside`` and ``members`` are (row, label, bag); exact overlap of every pair.

    Components that have met are one from then on, so there are fewer links than labels.
    """
    up: dict[int, int] = {}

    def find(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = x = up.get(up[x], up[x])
        return x
    key, owner = np.concatenate([b[0] for _, _, b in members]), np.repeat(np.arange(len(members)), [len(b[0]) for _, _, b in members])
    count = np.concatenate([b[1] for _, _, b in members])
    order = np.argsort(key, kind="stable")
    owner, count = owner[order], count[order]
    terms, first = np.unique(key[order], return_index=True)
    last = np.r_[first[1:], len(order)]
    size = np.array([int(b[1].sum()) for _, _, b in members])
    labels = np.array([label for _, label, _ in members])
    out = []
    for row, label, (shingle, times) in outside:
        place = np.minimum(np.searchsorted(terms, shingle), len(terms) - 1)
        met = np.flatnonzero(terms[place] == shingle)
        lo, n = first[place[met]], (last - first)[place[met]]
        at = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        both = np.bincount(owner[at], np.minimum(count[at], np.repeat(times[met], n)), len(members))
        total = int(times.sum()) + size
        for j in np.flatnonzero((both / np.maximum(total - both, 1) >= least) & (labels != label)).tolist():
            x, y = find(label), find(int(labels[j]))
            if x != y:
                up[max(x, y)] = min(x, y)
                out.append((max(row, members[j][0]), min(row, members[j][0])))
    return out


def _between(inside: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """Links (u > v) between components of a bucket.

    ``inside``: key, u, label, out (outside the centre's component).  Of buckets with the same members one is kept.  A bucket's outsiders
    and its members are dealt to blocks of bounded size; a task compares one block with one block.
    """
    same = inside.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.expr("sum(CAST(xxhash64(u) AS DECIMAL(38,0)))").alias("f1"),
                                     F.expr("bit_xor(xxhash64(u, 1))").alias("f2"))
    kept = same.groupBy("n", "f1", "f2").agg(F.min("key").alias("key")).select("key")
    texts = members.select(F.col("rid").alias("u"), "text")
    rows = stage(inside.join(kept, "key", "left_semi").join(texts, "u"), "split_members")
    blocks = lambda which: F.expr(f"CAST(ceil(greatest(sum({which}) / {BLOCK}, sum({which} * length(text)) / {BLOCK_BYTES})) AS INT)")
    sizes = stage(rows.groupBy("key").agg(blocks("1").alias("mb"), blocks("CAST(out AS INT)").alias("ob")).where("ob > 0"), "bucket_sizes")
    deal = lambda n: F.expr(f"CAST(pmod(xxhash64(u), {n}) AS INT)")
    rows = rows.join(sizes, "key")
    inner = rows.select("key", "u", "label", "text", deal("mb").alias("m"), F.explode(F.sequence(F.lit(0), F.col("ob") - 1)).alias("o"))
    outer = rows.where("out").select("key", "u", "label", "text", deal("ob").alias("o"), F.explode(F.sequence(F.lit(0), F.col("mb") - 1)).alias("m"))
    outer = outer.select(*[F.col(c).alias(c) for c in outer.columns])      # both sides come from the same rows
    bags = None

    def run(o: pa.Table, m: pa.Table) -> pa.Table:
        nonlocal bags
        if bags is None:
            start_task()
            bags = Bags()
        found: list[tuple[int, int]] = []
        if o.num_rows and m.num_rows:
            sides = [[(u, label, bags.get(u, text)) for u, label, text in zip(*(t.column(c).to_pylist() for c in ("u", "label", "text")))] for t in (o, m)]
            found = block_links(*sides, least)
        return pa.table([pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())], names=["u", "v"])
    by = ["key", "o", "m"]
    return outer.groupBy(*by).cogroup(inner.groupBy(*by)).applyInArrow(run, "u long, v long").distinct()


def near_dup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY,
             bands: int = BANDS, rows: int = ROWS, row_col: str | None = None) -> DataFrame:
    """One row per input row: ``doc_id, rid, class_id, class_size, kept``.

    Rows are in one class if links of similarity ``least`` or more connect them; ``class_id`` is the class's smallest
    ``doc_id`` and that row (the first in scan order among equal ids) is the one kept.  Rows without a word (null, empty,
    white space) are equal to each other and to nothing else.  A null id comes before all others and leaves
    the class named by null only if no member has an id.  A text is counted whole by one task, however long.  Other columns of the
    input, whatever their names, are not read.  An empty table gives no rows.  ``rid`` numbers the rows in scan order (or is ``row_col``).
    """
    base = stage(packed_texts(docs, id_col, text_col, row_col).mapInArrow(
        _sketch(bands, rows), "doc_id long, rid long, f1 long, f2 long, text binary, bands array<long>"), "sketches")
    classes = stage(base.groupBy("f1", "f2").agg(F.min("rid").alias("rep")), "classes")
    reps = base.join(classes.select(F.col("rep").alias("rid")), "rid", "left_semi")
    keys = stage(reps.select("rid", F.explode("bands").alias("key")), "band_keys")

    # 3. every bucket's members against its centre
    centres = stage(keys.groupBy("key").agg(F.min("rid").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "centres")
    shared = stage(keys.join(centres.hint("merge"), "key").selectExpr("key", "rid AS u", "v"), "shared")
    pairs = stage(shared.where("u <> v").select("u", "v").distinct(), "pairs")
    nodes = pairs.select(F.col("u").alias("rid")).unionAll(pairs.select(F.col("v").alias("rid"))).distinct()
    members = stage(base.select("rid", "text").join(nodes.hint("merge"), "rid", "left_semi"), "members")
    links = _verified(pairs, members, least)
    found = components(links)

    # 4. buckets that still hold several components
    placed = stage(shared.join(found.withColumnRenamed("node", "u"), "u", "left").withColumn("label", F.coalesce("label", "u")), "placed")
    split = stage(placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"),
                                            F.max(F.when(F.col("u") == F.col("v"), F.col("label"))).alias("c"))
                  .where("lo < hi AND n > 2").select("key", "c"), "split_buckets")
    if not is_empty(split):
        inside = stage(placed.join(split, "key").select("key", "u", "label", (F.col("label") != F.col("c")).alias("out")), "inside")
        late = stage(_between(inside, members, least), "late_links")
        if not is_empty(late):
            found = components(links.unionAll(late))

    labels = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "f1", "f2", F.coalesce("label", "rep").alias("label"))
    every = stage(base.select("doc_id", "rid", "f1", "f2", F.expr(ROW_ORDER).alias("ord")).join(stage(labels, "labels"), ["f1", "f2"])
                  .select("doc_id", "rid", "ord", "label"), "labelled")
    whole = stage(every.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
                                             F.min(F.expr("CASE WHEN doc_id IS NOT NULL THEN ord END")).alias("first"),
                                             F.min("ord").alias("first_any")), "near_classes")
    return every.join(whole, "label").select(
        "doc_id", "rid", "class_id", "class_size", (F.col("ord") == F.coalesce("first", "first_any")).alias("kept"))
