"""The pipeline's stages against brute force, and the registered queries against their SQL."""
import os
import random
import zlib
from collections import defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from tidemark.llm.common import stage
from tidemark.llm.queries import ORACLE, QUERIES
from tidemark.llm.words import WordEncoder, located, pack
from tidemark.session import scratch_path

from .test_near_dup import bag, similarity
from .test_secret_scan import BASE

SF = "/root/testdata/sf0.001"


def documents():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice(["an", "ter", "ing", "o", "sel"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(120):
        words = [word() for _ in range(rng.randint(40, 90))]
        if i % 4 == 0:
            words = [w.upper() + "!!" for w in words]
        if i % 9 == 1:
            words.insert(5, "password=abcdef123")
        rows.append((i, " ".join(words), 0 if i % 4 == 0 else 1))
    good = [r for r in rows if r[2]]
    rows += [(1000 + k, good[k][1], None) for k in range(8)]                                   # exact copies
    rows += [(2000 + k, good[20 + k][1].replace(" ", " zz ", 1), None) for k in range(8)]      # near copies
    rows += [(3000, good[0][1], None), (3000, good[0][1], None), (None, good[1][1] + " end", None), (3001, None, None), (3002, "", None)]
    return rows


@pytest.fixture(scope="module")
def folder(llm):
    root, rows = scratch_path(llm, "pipeline"), documents()
    from pyspark.sql import functions as F
    docs = llm.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.withColumns({c: F.lit("x") for c in ("rid", "_tidemark_row", "_blob", "score", "kept")}).repartition(4).write.parquet(f"{root}/documents.parquet")
    llm.createDataFrame([(d, y, 0) for d, _, y in rows if y is not None], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def plain(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def redact(text):
    spans = sorted((m.start(), m.end()) for _, p, g, least in BASE for m in p.finditer(text) if len(m[g]) >= least)
    out, at = "", 0
    for a, z in spans:
        if a >= at:
            out, at = out + text[at:a] + "[SECRET]", z
        at = max(at, z)
    return out + text[at:]


def test_stages_equal_brute_force(llm, folder):
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, [plain(docs)]
    for _, fn in C.STAGES[:-1]:
        docs = stage(fn(llm, docs, folder), "test_stage")
        assert docs.columns == columns
        kept.append(plain(docs))
    start, quality, exact, near, secret = kept
    label = {d: y for d, _, y in documents() if y is not None}
    assert {d for d, _ in quality if d in label} == {d for d, y in label.items() if y == 1}      # rejects go, clean ones stay
    groups = defaultdict(list)
    for d, t in quality:
        groups[(t or "").encode().lower()].append((-1 << 63 if d is None else d, d, t))
    assert exact == sorted(((d, t) for g in groups.values() for _, d, t in [max(g, key=lambda x: x[0])]), key=str)
    bags = [bag(t) for _, t in exact]
    linked = {(i, j) for i in range(len(exact)) for j in range(i) if similarity(bags[i], bags[j]) >= 0.8}
    assert linked and len(near) == len(exact) - len(linked)                                     # here every class is a pair
    left = {str(x) for x in near}
    assert all((str(exact[i]) in left) != (str(exact[j]) in left) for i, j in linked)
    assert secret == sorted(((d, t if t is None else redact(t)) for d, t in near), key=str) and secret != near
    rows = C.STAGES[-1][1](llm, docs, folder).collect()
    enc = WordEncoder(located("word_bpe_49k.json"))
    want = sorted((str(d), zlib.crc32(ids[at:at + 8192]), at // 4) for d, t in secret for ids in [enc.encode(t or "") + pack([1])]
                  for at in range(0, len(ids), 8192))
    assert sorted((str(r.doc_id), r.ids_crc32, r.start) for r in rows) == want


def test_run_applies_all_stages(llm, folder):
    docs = llm.read.parquet(f"{folder}/documents.parquet")
    for _, fn in C.STAGES:
        docs = stage(fn(llm, docs, folder), "test_stage")
    key = lambda df: sorted(map(str, df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()))
    assert key(C.run(llm, folder)) == key(docs)


def test_empty_table(llm, folder):
    empty = llm.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, fn in C.STAGES:
        empty = stage(fn(llm, empty, folder), "test_stage")
    assert empty.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(llm, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    got, want = QUERIES[name](llm, SF), con.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)


def test_all_operators_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names
