import random

import numpy as np
import pytest

from tidemark.llm import suffix_dedup as S


def brute(rows):
    first, rows = {}, [(d, (t or "").encode(), -1 << 63 if d is None else d) for d, t in rows]
    for _, b, k in rows:
        for i in range(len(b) - 49):
            first[b[i:i + 50]] = min(first.get(b[i:i + 50], k), k)
    out = []
    for d, b, k in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < k:
                gone[i:i + 50] = b"\1" * 50
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.suffix_dedup(df, **kw).collect()), key=str)


def sample(n=60):
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma ray", "x", "yy", "delta\n", "é"]
    some = lambda k: " ".join(rng.choice(words) for _ in range(k))
    pool = [some(30) for _ in range(6)]
    rows = [(rng.randint(0, 60) * 5, f"{some(rng.randint(0, 20))} {rng.choice(pool)[rng.randint(0, 40):rng.randint(60, 150)]} {some(rng.randint(0, 10))}")
            for _ in range(n)]
    return rows + [(None, "a" * 300), (7, "a" * 200), (None, None), (1000, ""), (1001, "ab" * 100), (1002, "ab" * 60),
                   (1003, "q" * 49), (1004, "q" * 50), (1005, "q" * 50), (1006, "\x00" * 60), (1007, "\x00" * 120)]


@pytest.mark.parametrize("kw", [{}, {"unit_bytes": 200, "gather": 7}, {"hot": 3}, {"hot": 1, "gather": 2}])
def test_matches_brute_force(make, kw):
    rows = sample()
    assert result(make(rows), **kw) == brute(rows)
    assert sum(r[2] for r in brute(rows)) > 1000


def test_odd_rows(make, odd_rows):
    assert result(make(odd_rows)) == brute(odd_rows)
    assert result(make([])) == []


def test_states_lead_to_every_window():
    """Refinement of a bucket: offsets are split among its parts, bytes only added, and the ends are the single windows."""
    todo, ends = [S.START], []
    while todo:
        state = todo.pop()
        parts = S.narrower(state)
        if not parts:
            ends.append(state)
            continue
        assert [o for x in parts for o in range(x[2], x[3] + 1)] == list(range(state[2], state[3] + 1))
        assert all(x[0] >= state[0] and x[1] >= state[1] and x[0] <= x[2] and x[1] <= S.WINDOW - x[3] and x != state for x in parts)
        todo += parts
    assert sorted(ends) == [(o, S.WINDOW - o, o, o) for o in range(S.SPAN)]


@pytest.mark.parametrize("kw, variants", [({"hot": 200, "gather": 500}, 60), ({}, 340)])
def test_a_bucket_of_very_many_contexts(make, kw, variants):
    """One 24-gram with other bytes around it in each document; by default more contexts than are gathered (``HOT``)."""
    rng = np.random.default_rng(7)
    letters = lambda k: bytes(rng.choice(np.frombuffer(b"abcd", np.uint8), k))
    pool = rng.integers(65, 91, 400_000).astype(np.uint8).tobytes()
    at, h = S.Unit(pool, [0], [len(pool)]).anchors()
    gram = pool[at[h.argmin()]:][:S.Q]                     # the least hash of all: an anchor wherever it stands
    tails, heads = [letters(6) for _ in range(40)], [letters(14) for _ in range(90)]
    left = [letters(14) + tails[i % 40] for i in range(variants)]
    right = [heads[i % 90] + letters(6) for i in range(variants)]
    rows = [(int(d), (left[i] + gram + right[j]).decode()) for d, (i, j) in zip(
        rng.permutation(variants * variants), ((i, j) for i in range(variants) for j in range(variants)))]
    assert not kw and len(rows) > S.HOT or kw
    assert result(make(rows), **kw) == brute(rows)


def test_slices_of_a_giant_document_find_the_same_anchors(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8).tobytes()
    unit = S.Unit(data, [1, 2], [3000, 2000])
    want = [x.tolist() for x in unit.anchors()]
    monkeypatch.setattr(S, "SLICE", 333)
    assert [x.tolist() for x in unit.anchors()] == want


def test_every_window_has_an_anchor():
    data = bytes(np.random.default_rng(2).integers(97, 123, 2000).astype(np.uint8))
    at = S.Unit(data, [1], [2000]).anchors()[0]
    for p in range(2000 - S.WINDOW + 1):
        assert np.any((at >= p) & (at < p + S.SPAN))
