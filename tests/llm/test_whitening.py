import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening as W
from tidemark.llm.queries import op13_embedding_whitening


def brute(vectors, components=4):
    """Rows by plain integers and the library's symmetric eigenvalue solver; the sign of a component is open."""
    rows = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in vectors
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in rows), default=0)
    rows = [(i, x + [0] * (width - len(x))) for i, x in rows]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    if not n or not width:
        return n, []
    centred = np.array(fit, float) - np.array(sums) / n
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1]
    values, basis = values[order], basis[:, order]
    out = []
    for i, x in rows:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        for k in range(min(components, width)):
            if values[k] > 1e-9 * values[0] > 0:
                out.append((i, k + 1, n, deviation, float((np.array(x) - np.array(sums) / n) @ basis[:, k] / math.sqrt(values[k])), values[k] / values.sum()))
    return n, out


def compare(got, want):
    key = lambda r: (str(r[0]), r[1], r[3], abs(r[4]))
    got, want = sorted((tuple(r) for r in got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for k in {r[1] for r in want}:
        a, b = (np.array([r[4] for r in rows if r[1] == k]) for rows in (got, want))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert all(r[6] < 1e-9 for r in got)


def table(llm, rows):
    return llm.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("x", "v", "n", "dim", "place")}).repartition(3)


def sample():
    rng = np.random.default_rng(6)
    rows = [(i, [float(c) for c in rng.standard_normal(9) * np.arange(1, 10) / 5]) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(50)] + [(7, rows[8][1]), (None, rows[9][1])]
    bad = [None, [1.0, None] + [0.0] * 7, [float("nan")] + [1.0] * 8, [float("inf")] + [1.0] * 8, [1e30] + [1.0] * 8]
    return rows, [(900 + i, v) for i, v in enumerate(bad)]


def test_equals_brute_force(llm):
    rows, bad = sample()
    compare(W.whiten(table(llm, rows + bad)).collect(), brute(rows)[1])


@pytest.mark.parametrize("rows", [
    [(1, [0.5, 0.25, 0.125])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, []), (2, [])], [],
    [(1, None), (2, [None])]])
def test_nothing_to_whiten(llm, rows):
    df = W.whiten(table(llm, rows))
    assert df.collect() == [] and df.columns[:3] == ["vec_id", "component", "n"]


def test_low_rank_and_ragged_vectors(llm):
    rows = [(i, [i * 1.0, 0.0, -2.0 * i, 1.0]) for i in range(6)] + [(10, [3.0]), (11, []), (12, [0.0, 7.0])]
    compare(W.whiten(table(llm, rows)).collect(), brute(rows)[1])
    line = [(i, [i * 1.0, 2.0 * i]) for i in range(6)]
    assert {r.component for r in W.whiten(table(llm, line)).collect()} == {1}


def test_deviations_stay_exact_beyond_doubles(llm):
    rows = [(i, [float(1 << 11) * (i % 7) + i, float(i * i)]) for i in range(200)]
    n, want = brute(rows)
    got = {(r.vec_id, r.component): r.deviation for r in W.whiten(table(llm, rows)).collect()}
    assert got == {r[:2]: r[3] for r in want} and max(got.values()) > 1 << 53
    far = [(0, [1e15]), (1, [-1e15]), (2, [0.0])]
    assert {r.deviation for r in W.whiten(table(llm, far)).collect()} == {None, 0}


def test_solver_on_clusters_and_groups_of_factors(llm, monkeypatch):
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    for values in (np.ones(30), np.r_[np.full(15, 4.0), np.full(15, 4.0 + 1e-13)], np.geomspace(1, 1e-12, 30), np.r_[np.arange(1.0, 20.0), np.zeros(11)]):
        r = np.linalg.qr(np.diag(values) @ basis, mode="r")
        got, vectors = W.directions(r, 30)
        assert np.allclose(got, np.sort(values ** 2)[::-1][:len(got)], rtol=1e-10, atol=1e-24)
        assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
        assert np.abs(r.T @ (r @ vectors) - vectors * got).max() < 1e-11 * got[0]
    monkeypatch.setattr(W, "FACTORS", 1)       # two factors at a time
    rows, _ = sample()
    compare(W.whiten(table(llm, rows).repartition(7)).collect(), brute(rows)[1])


def test_query_on_the_given_table(llm):
    got = op13_embedding_whitening(llm, "/root/testdata/sf0.001").collect()
    rows = [(r.vec_id, r.embedding) for r in llm.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    compare(got, brute(rows)[1])
