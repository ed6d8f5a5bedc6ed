import random
import re

import numpy as np
import pytest

from tidemark.llm import substring_trees as S


def brute(rows):
    first, cut = {}, []
    for d, t in rows:
        cut.append((d, -1 << 63 if d is None else d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())))
    for _, k, w in cut:
        for i in range(len(w) - 12):
            first[tuple(w[i:i + 13])] = min(first.get(tuple(w[i:i + 13]), k), k)
    out = []
    for d, k, w in cut:
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < k:
                gone.update(range(i, i + 13))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in S.substring_dedup(df, **kw).collect()), key=str)


def sample(n=120):
    rng = random.Random(9)
    words = ["alpha", "beta", "é", "x", "yy", "a\x00", "a", "中文" * 30, "long" * 400, "\x1f"]
    some = lambda k: rng.choice([" ", "  ", "\n", "\t \r\n"]).join(rng.choice(words) for _ in range(k))
    pool = [some(40) for _ in range(6)]
    part = lambda: " ".join(rng.choice(pool).split()[(k := rng.randint(0, 20)):k + rng.randint(8, 30)])
    rows = [(rng.randint(0, 60) * 5, f"{some(rng.randint(0, 9))} {part()} {some(rng.randint(0, 5))} {part()}") for _ in range(n)]
    same = "w " * 13
    return rows + [(None, "a " * 60), (7, "a " * 40), (None, None), (1000, ""), (1001, "ab cd " * 50), (1002, "ab cd " * 20),
                   (1003, "q " * 12), (1004, "q " * 13), (1005, "q " * 14), (1006, same), (1006, same), (1007, same), (1008, "\v\f")]


@pytest.mark.parametrize("kw", [{}, {"unit_bytes": 300, "gather": 9, "group": 4}, {"unit_bytes": 1, "group": 1, "gather": 1}])
def test_equals_brute_force(make, odd_rows, kw):
    rows = sample() + [r for r in odd_rows if kw.get("unit_bytes") != 1 or len(r[1] or "") < 1000]
    assert result(make(rows), **kw) == brute(rows)


@pytest.mark.parametrize("frequent", [S.FREQUENT, 0])
def test_a_passage_in_very_many_documents(make, monkeypatch, frequent):
    """A window in more documents than a group may hold, with other words around it in each: prefixes grow to the whole window."""
    monkeypatch.setattr(S, "FREQUENT", frequent)
    passage = " ".join(f"p{i}" for i in range(15))
    rows = [(i, f"l{i} m{i} {passage} r{i}") for i in range(3000)] + [(i, f"{passage} t{i}") for i in range(5000, 5300)]
    assert result(make(rows), group=50, gather=500) == brute(rows)


def test_empty_table(make):
    df = S.substring_dedup(make([]))
    assert df.collect() == [] and df.columns == ["doc_id", "rid", "n_words", "n_removed", "kept"]


def test_nodes_are_those_of_the_suffix_tree():
    rng = random.Random(2)
    for _ in range(30):
        suffixes = [b" ".join(rng.choice([b"a", b"b"]) for _ in range(rng.randint(1, 6))) for _ in range(12)]
        rows, depth, order = S.tree_rows(suffixes)
        got = {(b" ".join(suffixes[order[lo]].split(b" ")[:d]), hi - lo) for d, lo, hi, _ in S.nodes(rows[order], depth[order])}
        want = set()
        cut = [tuple(s.split(b" ")) for s in suffixes]
        for w in {c[:k] for c in cut for k in range(1, len(c) + 1)}:
            under = [c for c in cut if c[:len(w)] == w]
            ends = {c[len(w)] if len(c) > len(w) else None for c in under}
            if len(under) > 1 and (len(ends) > 1 or ends == {None}):
                want.add((b" ".join(w), len(under)))
        assert got == want
    assert S.maximal_repeats([b"x y z", b"x y w", b"x q"], least=2) == [(b"x y", 2)]
    assert S.repeated([b"a " * 12 + b"a b", b"a " * 12 + b"a c", b"b"], np.array([2, 1, 0])).tolist() == [True, False, False]
