import hashlib
from collections import defaultdict

import pytest

from tidemark.llm.radix_dedup import exact_dedup


def normal(text):
    return (text or "").encode().lower()


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[normal(text)].append(doc)
    return sorted(((d, max((x for x in groups[normal(t)] if x is not None), default=None), len(groups[normal(t)]),
                    hashlib.sha256(normal(t)).hexdigest()) for d, t in rows), key=str)


@pytest.mark.parametrize("width,growth", [(64, 16), (1, 2), (3, 4)])
def test_matches_brute_force(make, odd_rows, width, growth):
    got = exact_dedup(make(odd_rows), first_width=width, growth=growth).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(odd_rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_common_prefixes_and_lengths(make):
    rows = [(i, "p" * 500 + str(i % 3) + "s" * (500 + i % 2)) for i in range(40)]
    got = exact_dedup(make(rows), first_width=8, growth=3).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute(rows)


def test_partitioning_does_not_matter(make, odd_rows):
    results = [sorted(map(str, exact_dedup(make(odd_rows, n)).select("doc_id", "keep_id", "group_size", "text_sha256").collect()))
               for n in (1, 7)]
    assert results[0] == results[1]


def test_empty_table(make):
    assert exact_dedup(make([])).collect() == []
