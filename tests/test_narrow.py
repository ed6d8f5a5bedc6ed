"""Wide columns are carried for picked rows only; results equal the plain aggregates."""
import random

from pyspark.sql import functions as F

from tidemark.operators import clean
from tidemark.operators import textmine as TX
from tidemark.operators import topics as TP
from tidemark.operators.narrow import matching


def _rows(rng, n):
    pick = lambda *v: rng.choice(v)
    return [(pick("y", "t", None), pick(None, *"abcdefgh"), pick(None, 1, 2, 3), pick(1, 2, None), pick(None, "", "t1", "t2 t", "é"), pick(1.5, None, 2.5))
            for _ in range(n)]


def test_latest_equals_whole_row_aggregate_and_titles_are_not_aggregated(spark):
    """Nulls in every column, equal ranks and equal rows."""
    rows = _rows(random.Random(3), 400)
    df = spark.createDataFrame(rows, "platform string, videoId string, fetchedAt int, _seq int, title string, views double").repartition(5)
    rest = ["fetchedAt", "_seq", "title", "views"]
    want = df.groupBy("platform", "videoId").agg(F.max_by(F.struct(*rest), F.struct(*rest)).alias("r")).select("platform", "videoId", "r.*")
    got = clean.dedup_latest(df, order=["_seq"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    alone = clean.dedup_latest(df.dropDuplicates(["platform", "videoId", "fetchedAt", "_seq"]), order=["_seq"])
    assert "max_by" not in alone._jdf.queryExecution().toString()


def test_matching_treats_nulls_as_equal(spark):
    df = spark.createDataFrame(_rows(random.Random(5), 300), "a string, b string, c int, d int, e string, f double")
    wanted = df.where("c = 1 OR c IS NULL").select("a", "b", "c").distinct()
    assert matching(df, wanted, ["a", "b", "c"]).count() == df.where("c = 1 OR c IS NULL").count()


def test_sample_titles_equal_the_plain_aggregate(spark):
    df = spark.createDataFrame(_rows(random.Random(7), 300), "platform string, videoId string, ts_hour int, topic_id int, title_clean string, x double")
    df = df.dropDuplicates(["platform", "videoId", "ts_hour", "topic_id"]).localCheckpoint()
    keys = ["ts_hour", "topic_id"]
    want = df.groupBy(*keys).agg(TP.sample_title_expr().alias("sample_title"))
    got = TP.sample_titles(df, keys)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_label_counts_cover_frequent_pairs_only(spark):
    """Labels equal a plain count; of 20,000 pairs that occur once nearly none is counted by name."""
    rng = random.Random(11)
    rows = [(i % 3, i // 4 if i % 9 else None, " ".join([f"w{i}x{j}" for j in range(8)] + [rng.choice(["top pair", "next best", "ü é"])] + ["top pair"])) for i in range(2500)]
    df = spark.createDataFrame(rows, "topic_id int, n long, title_clean string").repartition(6).localCheckpoint()
    titles = df.select("topic_id", "n", F.split("title_clean", " ").alias("_w")).withColumn("_k", F.xxhash64("topic_id"))
    counts = {(r.topic_id, r._g): (r._cnt, tuple(r._first)) for r in TX._pair_counts(titles, "topic_id", ("n",), 3).collect()}
    assert len(counts) < 2000
    plain: dict = {}
    for t, n, text in rows:
        w = text.split(" ")
        for p in range(len(w) - 1):
            at = ((n is not None, n or 0), p)
            c, first = plain.get((t, f"{w[p]} {w[p + 1]}"), (0, at))
            plain[t, f"{w[p]} {w[p + 1]}"] = (c + 1, min(first, at))
    for t in range(3):
        best = sorted((kv for kv in plain.items() if kv[0][0] == t), key=lambda kv: (-kv[1][0], kv[1][1]))[:3]
        assert [counts[k][0] for k, _ in best] == [v[0] for _, v in best]
        assert [(counts[k][1][0], counts[k][1][1]) for k, _ in best] == [((v[1][0][1] if v[1][0][0] else None), v[1][1]) for _, v in best]
    got = {r.topic_id: r.topic_label for r in TX.topic_labels(df, order=("n",)).collect()}
    assert got == {t: ", ".join(g for (_, g), _ in sorted((kv for kv in plain.items() if kv[0][0] == t), key=lambda kv: (-kv[1][0], kv[1][1]))[:3]) for t in range(3)}
