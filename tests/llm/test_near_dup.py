import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest

from tidemark.llm import near_dup as N


def bag(text):
    w = (text or "").lower().split()
    return Counter(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 1.0


def classes(rows):
    """Partition of row numbers by links of 0.8 or more."""
    bags, up = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, j in combinations(range(len(rows)), 2):
        if similarity(bags[i], bags[j]) >= 0.8:
            up[max(find(i), find(j))] = min(find(i), find(j))
    out = defaultdict(list)
    for i in range(len(rows)):
        out[find(i)].append(rows[i][0])
    want = []
    for ids in out.values():
        least = min((x for x in ids if x is not None), default=None)
        want += [(d, least, len(ids)) for d in ids]
    return sorted(want, key=str)


def result(df, **kw):
    rows = N.near_dup(df, **kw).collect()
    assert sum(r.kept for r in rows) == len(classes_of(rows))
    assert all(r.doc_id == r.class_id for r in rows if r.kept)
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in rows), key=str)


def classes_of(rows):
    count = Counter((r.class_id, r.class_size) for r in rows)
    return [k for k, n in count.items() for _ in range(n // k[1])]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(words)


def sample():
    rng = random.Random(8)
    rows = []
    for g in range(8):
        base = [f"t{rng.randrange(500)}" for _ in range(rng.randint(60, 300))]
        rows += [(1000 - 100 * g + k, edited(rng, base, rng.randint(0, max(1, len(base) // 60)))) for k in range(8)]
    rows += [(5000 + k, " ".join(f"t{rng.randrange(500)}" for _ in range(80))) for k in range(20)]
    repeats = ["line one two three four five"] * 30
    rows += [(6000, "\n".join(repeats)), (6001, "\n".join(repeats[:27])), (6002, "\n".join(repeats[:15]))]
    return rows


def test_matches_brute_force(make):
    rows = sample()
    assert result(make(rows)) == classes(rows)
    assert len({c for _, c, _ in classes(rows)}) < len(rows) - 20


def test_chain_whose_centre_is_far(make):
    """Consecutive documents are similar, distant ones are not: one class all the same."""
    words = [f"c{i}" for i in range(400)]
    rows = [(i, " ".join(words[12 * i:12 * i + 200])) for i in range(16)]
    assert result(make(rows)) == classes(rows)
    assert {c for _, c, _ in classes(rows)} == {0}


def test_odd_rows(make, odd_rows):
    rows = [(d, t if t is None or len(t) < 60000 else t[:2000]) for d, t in odd_rows]
    assert result(make(rows)) == classes(rows)
    assert N.near_dup(make([])).collect() == []


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    for _ in range(4):
        key = np.sort(rng.integers(1, 1 << 62, 80).astype(np.uint64))
        a = rng.integers(0, 12, 80)
        b = np.where(rng.random(80) < 0.7, a, rng.integers(0, 12, 80))
        sig = [N.signatures(np.zeros((w > 0).sum(), np.int64), key[w > 0], w[w > 0], 1, 4000)[0] for w in (a, b)]
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.04)


def test_signatures_do_not_depend_on_the_batch():
    key, w = np.arange(1, 50, dtype=np.uint64), np.arange(1, 50) % 4 + 1
    alone = N.signatures(np.zeros(49, np.int64), key, w, 1, 64)
    doc = np.repeat([0, 1, 2], 49)
    many = N.signatures(doc, np.concatenate([key + np.uint64(7), key, key]), np.concatenate([w, w, w]), 3, 64)
    assert (many[1] == alone[0]).all() and (many[2] == alone[0]).all()


def test_components(llm):
    rng = random.Random(1)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    up = list(range(200))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        up[max(find(a), find(b))] = min(find(a), find(b))
    df = llm.createDataFrame([(a, b) for a, b in pairs], "u long, v long")
    got = {r.node: r.label for r in N.components(df).collect()}
    want = {x: find(x) for p in pairs for x in p if p[0] != p[1]}
    assert got == want


def test_block_links_join_what_pairs_would(llm):
    """Exact overlap within a block: the same components as by all pairs, with fewer links than rows."""
    rng = random.Random(12)
    base = [f"t{rng.randrange(60)}" for _ in range(120)]
    rows = [(i, edited(rng, base, rng.randint(0, 9))) for i in range(60)] + [(60 + i, " ".join(f"t{rng.randrange(60)}" for _ in range(100))) for i in range(10)]
    bags = [N.counted(N.word_hashes(t)) for _, t in rows]
    labels = [i // 2 * 2 for i, _ in rows]                 # neighbours are joined already
    members = [(i, labels[i], bags[i]) for i, _ in rows]
    got = N.block_links([m for m in members if m[0] % 3], members, 0.8)
    assert all(N.similarity(bags[u], bags[v]) >= 0.8 and labels[u] != labels[v] and u > v for u, v in got) and len(got) < len(rows)
    up = {x: x for x in labels}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    def joined(pairs):
        up.update({x: x for x in labels})
        for u, v in pairs:
            x, y = find(labels[u]), find(labels[v])
            up[max(x, y)] = min(x, y)
        return [find(x) for x in labels]
    every = [(u, v) for u, v in combinations(range(len(rows)), 2) if (u % 3 or v % 3) and N.similarity(bags[u], bags[v]) >= 0.8]
    assert joined(got) == joined(every)


def test_large_bucket_in_many_blocks(make, monkeypatch):
    """Near copies around several centres share buckets; blocks of a few rows give the brute-force classes, too."""
    monkeypatch.setattr(N, "BLOCK", 7)
    rng = random.Random(15)
    base = [f"t{rng.randrange(90)}" for _ in range(100)]
    rows = [(i, edited(rng, base, rng.randint(0, 8))) for i in range(150)]
    assert result(make(rows)) == classes(rows)
