"""Gold operators: golden formulas from the reference's committed output."""
import datetime as dt
import math
import statistics

from tidemark.operators import topics as TP
from tidemark.operators.textmine import topic_labels


def test_expanding_baseline_example(spark):
    t0 = dt.datetime(2025, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i), 1, v) for i, v in enumerate([5.0, 5.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "ts_hour timestamp, topic_id int, velocity_sum double")
    z = [r.zscore for r in TP.expanding_baseline(df).orderBy("ts_hour").collect()]
    sd4 = statistics.stdev([5.0, 5.0, 9.0])
    assert z[:3] == [5.0, 0.0, 4.0]
    assert math.isclose(z[3], (9 - 19 / 3) / sd4, rel_tol=1e-12)


def test_expanding_baseline_over_many_days(spark):
    """Against plain Python: days of one row and of many, equal values over days, large means with small spreads, a null topic."""
    import random
    rng = random.Random(5)
    t0, rows = dt.datetime(2025, 1, 1), []
    makes = {1: lambda i: rng.lognormvariate(3, 1), 2: lambda i: 0.1, 3: lambda i: 1e9 + rng.random(), 4: lambda i: float(i // 40), None: lambda i: 7.0 + i % 2}
    for topic, make in makes.items():
        hours = sorted(rng.sample(range(24 * 30), 200))
        rows += [(t0 + dt.timedelta(hours=h), topic, make(i)) for i, h in enumerate(hours)]
    df = spark.createDataFrame(rows, "ts_hour timestamp, topic_id int, velocity_sum double").repartition(5)
    got = {(r.topic_id, r.ts_hour): r.zscore for r in TP.expanding_baseline(df).collect()}
    assert len(got) == len(rows)
    for topic in makes:
        seen = []
        for t, _, v in (r for r in rows if r[1] == topic):
            sd = statistics.stdev(seen) if len(seen) > 1 else 1.0
            want = (v - (statistics.fmean(seen) if seen else 0.0)) / (sd or 1.0)
            assert math.isclose(got[topic, t], want, rel_tol=1e-6, abs_tol=1e-6), (topic, t)
            seen.append(v)


def test_leaders_alphabetical_top3(spark):
    t = dt.datetime(2025, 1, 1)
    rows = [(t, 1, "Z", 3.0), (t, 1, "A", 2.0), (t, 1, "M", 2.0), (t, 1, "B", 1.0), (t, 1, None, 9.0)]
    df = spark.createDataFrame(rows, "ts_hour timestamp, topic_id int, channelTitle string, decayed_velocity double")
    assert TP.leader_channels(df).first().leader_channels == "A, M, Z"


def test_hourly_aggregate_and_sample_title(spark):
    t = dt.datetime(2025, 1, 1)
    rows = [(t, 1, "youtube", "b", "UC1", "second", 1.0), (t, 1, "youtube", "a", "UC1", "first", 2.0),
            (t, 1, "youtube", "c", None, "", 4.0), (t, 1, "youtube", "a", "UC2", "first", 1.0)]
    df = spark.createDataFrame(rows, "ts_hour timestamp, topic_id int, platform string, videoId string, "
                                     "channelId string, title_clean string, decayed_velocity double")
    r = TP.hourly_aggregate(df).first()
    assert (r.velocity_sum, r.video_count, r.channel_count, r.sample_title) == (8.0, 3, 2, "second")


def test_topic_labels_bigram_then_unigram(spark):
    rows = [(1, "youtube", "a", "x y z"), (1, "youtube", "b", "x y"), (1, "youtube", "c", "w z"),
            (2, "youtube", "a", "solo"), (2, "youtube", "b", "solo"), (2, "youtube", "c", "other"),
            (3, "youtube", "a", ""), (4, "youtube", "a", "p q"), (4, "youtube", "b", "r")]
    df = spark.createDataFrame(rows, "topic_id int, platform string, videoId string, title_clean string")
    got = {r.topic_id: r.topic_label for r in topic_labels(df).collect()}
    assert got == {1: "x y, y z, w z", 2: "solo, other", 3: "", 4: "p q"}   # one bigram: no unigram fill


def test_topic_labels_read_every_title(spark):
    """Far more than 300 titles: the commonest pair stands in the late ones only."""
    rows = [(1, "youtube", f"v{i:05d}", f"early{i} one") for i in range(400)]
    rows += [(1, "youtube", f"w{i:05d}", "late pair" if i % 2 else "next best") for i in range(301)]
    df = spark.createDataFrame(rows, "topic_id int, platform string, videoId string, title_clean string").repartition(5)
    assert topic_labels(df).first().topic_label == "next best, late pair, early0 one"


def test_top_terms_by_bracketing(spark):
    """Ties at the cut, terms that are heads of others, more ties than are ever collected."""
    import random

    from tidemark.operators import textmine as TX
    rng = random.Random(3)
    terms = sorted({"".join(rng.choice("abé中") for _ in range(rng.randint(1, 6))) for _ in range(900)}, key=str.encode)
    rows = [(t, rng.choice([1, 1, 1, 2, 5])) for t in terms]
    df = spark.createDataFrame(rows, "term string, cnt long").repartition(3)
    order = sorted(rows, key=lambda r: (-r[1], r[0].encode()))
    for limit in (0, 1, 50, len(rows) // 2, len(rows) - 1, len(rows), 10**6):
        assert {r.term for r in TX.top_terms(df, limit).collect()} == {t for t, _ in order[:limit]}
    assert [TX.nth_term(df, n, most=1) for n in (0, 7, len(terms) - 1)] == [terms[0], terms[7], terms[-1]]


def test_tfidf_keeps_every_term(spark):
    from tidemark.operators import textmine as TX
    df = spark.createDataFrame([(1, "aa bb cc"), (2, "aa bb dd"), (3, "aa")], "doc_id long, text string")
    got = {(r.doc_id, r.term) for r in TX.tfidf(df, min_df=1).collect()}
    assert got == {(1, t) for t in ("aa", "bb", "cc", "aa bb", "bb cc")} | {(2, t) for t in ("aa", "bb", "dd", "aa bb", "bb dd")} | {(3, "aa")}
    assert {r.term for r in TX.tfidf(df, min_df=2, ngram_max=1).collect()} == {"aa", "bb"}
