"""Terms are counted in the task that reads a row; documents in several rows are added up."""
import collections
import random

from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import textmine as TX


def _plain(rows, singles, pairs):
    out: collections.Counter = collections.Counter()
    for k, text in rows:
        w = (text or "").split()
        out.update((k, t) for t in ([*w] if singles else []) + ([f"{a} {b}" for a, b in zip(w, w[1:])] if pairs else []))
    return sorted(((k, t, n) for (k, t), n in out.items()), key=str)


def test_counts_equal_plain_python_without_an_exchange(spark):
    rng = random.Random(9)
    rows = [(i if i else None, rng.choice([None, "", "one", " ".join(rng.choice(["a", "b", "é", "dd"]) for _ in range(rng.randint(1, 40)))])) for i in range(300)]
    for some, moved in ((rows, False), (rows + [(None, "a b"), (7, "a b a b"), (7, "é")], True)):
        df = spark.createDataFrame(some, "doc_id long, text string").repartition(4)
        for singles, pairs in ((True, True), (False, True), (True, False)):
            got = TX.count_terms(df, "doc_id", X.words("text"), singles, pairs)
            assert sorted(((r.doc_id, r.term, r.n) for r in got.collect()), key=str) == _plain(some, singles, pairs)
            assert ("Aggregate" in got._jdf.queryExecution().executedPlan().toString()) == moved


def test_vectors_are_built_in_slices(spark):
    """More texts in a batch than a slice; the memory of a slice is bounded."""
    from tidemark.operators import topicmodel as TM
    n = 2 * TM.SLICE_ROWS + 3
    df = spark.createDataFrame([(i, f"common w{i % 7} x{i % 5}") for i in range(n)], "k long, t string").coalesce(1)
    rows = TM.vectors(TM.hashed_terms(df, "k", "t")).collect()
    assert [r.key for r in rows] == list(range(n))
    assert all(abs(sum(x * x for x in r.w) - 1) < 1e-9 for r in rows)


def test_order_is_made_before_records_are_doubled(spark):
    """The messy file job exchanges records, not their two JSON lines, and keeps the later copy behind the first."""
    from tidemark.plans import registry as R
    from tidemark.schemas import BRONZE
    rows = [(f"v{i}", None, ("t", "d", "c", "ch", "2025-01-01T00:00:00Z", None), ("5", "1", "1"), ("PT1M",), "2025-01-01T01:00:00Z", None) for i in range(50)]
    b = spark.createDataFrame(rows, BRONZE).withColumn("_seq", F.monotonically_increasing_id())
    lines = R._messy_lines(b)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Exchange rangepartitioning")
    seqs = [(r._seq, r._again) for r in lines.collect()]
    assert seqs == sorted(seqs) and len(seqs) == 100


def test_file_job_writes_titles_once(spark, tmp_path):
    """No second table of whole rows beside the silver."""
    import json

    from tidemark.plans.jobs import clean_job
    (tmp_path / "bronze" / "youtube_raw_1").mkdir(parents=True)
    with open(tmp_path / "bronze" / "youtube_raw_1" / "part-0.json", "w") as f:
        for i in range(20):
            f.write(json.dumps({"id": f"v{i % 10}", "snippet": {"title": f"t{i}", "publishedAt": "2025-01-01T00:00:00Z"},
                                "statistics": {"viewCount": str(i)}, "_fetched_at": "2025-01-01T01:00:00Z"}) + "\n")
    out = clean_job(spark, str(tmp_path / "bronze"), str(tmp_path / "silver"))
    assert sorted((r.videoId, r.title_clean) for r in out.collect()) == sorted((f"v{i}", f"t{i + 10}") for i in range(10))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bronze", "silver"]


def test_weights_send_no_row_per_document_and_term(spark, monkeypatch):
    """Weights over several slices equal the plain formula, with null and repeated ids; what is written has no document column."""
    import math
    staged = []
    monkeypatch.setattr(TX, "stage", lambda df, *a, keep=TX.stage: (staged.append(df.columns), keep(df, *a))[1])
    monkeypatch.setattr(TX, "SLICE_BYTES", 200)
    rng = random.Random(2)
    rows = [(i % 70 if i % 11 else None, rng.choice([None, "", "Solo!", " ".join(rng.choice(["aa", "bb", "\u00e9\u00e9", "dd", "x"]) for _ in range(rng.randint(1, 20)))])) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tf: dict = collections.defaultdict(collections.Counter)
    for k, text in rows:
        w = [x for x in (text or "").lower().replace("!", "").split() if len(x) >= 2]
        tf[k].update(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
    df_of = collections.Counter(t for c in tf.values() for t in c)
    want = {}
    for k, c in tf.items():
        w = {t: n * (math.log((len(rows) + 1) / (df_of[t] + 1)) + 1) for t, n in c.items() if df_of[t] >= 2}
        want |= {(k, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    got = {(r.doc_id, r.term): r.weight for r in TX.tfidf(df).collect()}
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want)
    assert staged and not [c for c in staged if "doc_id" in c or "k" in c]
