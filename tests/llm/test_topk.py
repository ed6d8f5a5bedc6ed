import math
import random

import numpy as np

from tidemark.llm import topk as T


def brute(rows, k=5, every=50):
    ok = [(i, [math.floor(256.0 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)
            out += [(q, r + 1, i, max(-1 << 63, min((1 << 63) - 1, -x))) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


def table(llm, rows):
    from pyspark.sql import functions as F
    return llm.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit(1) for c in ("rid", "v", "x", "cb", "qb", "score", "rank", "query_id")}).repartition(3)


def result(df, **kw):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in T.top_k(df, **kw).collect())


def test_matches_brute_force(llm):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(260)]
    rows += [(i, [0.5] * 8) for i in range(300, 340)]          # ties
    for kw in ({}, {"candidate_block": 40, "query_block": 3}, {"k": 1}):
        assert result(table(llm, rows), **kw) == brute(rows, kw.get("k", 5))


def test_odd_rows(llm):
    rows = [(0, [1.0, 2.0]), (50, []), (100, None), (150, [1.0, None]), (200, [float("nan"), 1.0]), (250, [float("inf")]),
            (None, [9.0, 9.0]), (1, [1.0]), (2, [1e9, 1e9]), (-50, [-3.0, 1e9, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])]
    assert result(table(llm, rows)) == brute(rows)
    assert result(table(llm, [])) == [] and result(table(llm, [(1, [1.0])])) == [] and result(table(llm, [(50, [1.0])])) == []


def found(x, ids, q, qids, k=5, size=None):
    """Results over blocks of ``size``, and the share of all entries that was read."""
    best, read = T.Best(len(q), k), 0
    for s in range(0, len(x), size or len(x)):
        read += T.top_block(x[s:s + (size or len(x))], ids[s:s + (size or len(x))], q, qids, best)
    return best.found, read / max(1, x.size * len(q))


def plain(x, ids, q, qids, k=5):
    out = []
    for r, i in zip(q, qids):
        s = sorted((-sum(int(a) * int(b) for a, b in zip(v, r)), int(j)) for v, j in zip(x, ids) if j != i)
        out.append([(-a, b) for a, b in s[:k]])
    return out


def test_reading_stops_early_and_stays_exact():
    rng = np.random.default_rng(4)
    scale = np.array([60, 40, 9, 3, 1, 1, 1, 1])
    x, ids = np.floor(rng.normal(0, 40, (3000, 8)) * scale), np.arange(3000)
    q, qids = np.floor(rng.normal(0, 40, (5, 8)) * scale), np.array([0, 50, 100, 150, 200])
    got, share = found(x, ids, q, qids)
    assert got == plain(x, ids, q, qids) and share < 0.6                     # most candidates leave after half of the lists
    assert found(x, ids, q, qids, size=500)[0] == got and found(x, ids, q, qids, size=500)[1] < 0.6


def test_every_entry_is_read_once_where_nothing_can_stop():
    rng = np.random.default_rng(5)
    x, ids = np.floor(rng.normal(0, 40, (400, 64))), np.arange(400)
    q, qids = np.floor(rng.normal(0, 40, (7, 64))), np.arange(7) * 50
    got, share = found(x, ids, q, qids)
    assert got == plain(x, ids, q, qids) and share <= 1.0


def test_blocks_of_ties_small_blocks_and_wide_numbers():
    rng = np.random.default_rng(6)
    for x in (np.floor(rng.integers(-2, 3, (300, 4))).astype(float), np.floor(rng.normal(0, 1e12, (120, 3))), np.zeros((90, 2)), np.zeros((20, 0)),
              np.floor(rng.normal(0, 9, (3, 4)))):
        ids = rng.permutation(len(x)) + 10
        q, qids = x[: min(6, len(x))].copy(), ids[: min(6, len(x))]
        for size in (None, 1, 7, 64):
            assert found(x, ids, q, qids, size=size)[0] == plain(x, ids, q, qids)
