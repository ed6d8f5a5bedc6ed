import random
import zlib

import pytest

from tidemark.llm import quality as Q


def corpus(n=240):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice(["an", "ter", "ing", "o", "sel"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        bad = i % 4 == 0
        if bad and i % 8:
            words = [w.upper() + "!!" for w in words]
        elif bad:
            words = [w for w in words[:8] for _ in range(12)]
        rows.append((i, " ".join(words), 0 if bad else 1))
    return rows


@pytest.fixture(scope="module")
def tables(llm, make):
    rows = corpus()
    docs = make([(i, t) for i, t, _ in rows] + [(None, None), (9000, None), (9001, ""), (9002, " \n"), (9003, "é" * 5000)])
    labels = llm.createDataFrame([(i, y, 0) for i, _, y in rows] + [(None, 1, 0), (3, None, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def scores(docs, model):
    return {r.doc_id: (r.held, r.s) for r in docs.select("doc_id", Q.held_out().alias("held"), Q.score(docs, model).alias("s")).collect()}


def test_held_out_accuracy(tables):
    rows, docs, labels = tables
    model = Q.fit(docs, labels, per_label=100)
    assert len(model.labels) <= 200
    got = scores(docs, model)
    for i, _, _ in rows:
        assert got[i][0] == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [(i, y) for i, _, y in rows if got[i][0]]
    assert len(held) > 30 and sum((got[i][1] >= Q.THRESHOLD) == (y == 1) for i, y in held) >= 0.97 * len(held)
    assert got[9000][1] == got[9001][1] == got[None][1] == 0.0
    assert all(0 <= s <= 1 for _, s in got.values())


def test_held_out_labels_teach_nothing(llm, tables):
    rows, docs, labels = tables
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (scores(docs, Q.fit(docs, t, per_label=100)) for t in (labels, flipped))
    assert a == b


def test_no_labels_and_empty_tables(llm, make, tables):
    _, docs, labels = tables
    assert Q.fit(docs, labels.where("false")) is None
    assert {s for _, s in scores(docs, None).values()} == {1.0}
    assert Q.fit(make([]), labels) is None
    assert scores(make([]), Q.fit(docs, labels, per_label=20)) == {}


def test_vote_equals_plain_cosines():
    import numpy as np
    rng = np.random.default_rng(0)
    texts = [t.encode() for _, t, _ in corpus(40)]
    axes = np.linalg.qr(rng.normal(size=(Q.TERMS, 6)))[0].astype(np.float32)
    idf, labels = np.ones(Q.TERMS), rng.integers(0, 2, 25).astype(float)
    vectors = Q._unit(rng.normal(size=(25, 6)).astype(np.float32))
    got = Q.vote(Q.Model(idf, axes, vectors, labels), texts, neighbours=4)
    for t, s in zip(texts, got):
        x = np.sqrt(Q.term_counts(t) / max(Q.term_counts(t).sum(), 1))
        x = (x / np.linalg.norm(x)) @ axes
        cos = vectors @ (x / np.linalg.norm(x))
        near = np.argsort(-cos)[:4]
        w = np.maximum(cos[near], 0) ** Q.SHARPNESS
        assert s == pytest.approx((w * labels[near]).sum() / w.sum(), abs=1e-3)


def test_long_texts_are_counted_in_slices(monkeypatch):
    text = " ".join(t for _, t, _ in corpus(60)).encode()
    want = Q.term_counts(text)
    monkeypatch.setattr(Q, "_SLICE", 1000)
    assert (Q.term_counts(text) == want).all()
