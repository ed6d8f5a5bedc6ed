"""Dashboard filters and collector rules on small hand-made frames."""
import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import ingest as IG
from tidemark.plans import views as V

T0 = dt.datetime(2025, 1, 1, 10)


def _gold(spark):
    topics = spark.createDataFrame(
        [(T0, 1, 1, 3.0, 2), (T0 - dt.timedelta(hours=1), 1, 1, 1.0, 2), (T0 - dt.timedelta(hours=2), 2, 1, 5.0, 3),
         (T0, 3, 0, 9.0, 4)],
        "ts_hour timestamp, topic_id int, rising_flag int, velocity_sum double, video_count long")
    videos = spark.createDataFrame(
        [("a", 1, "en", None, T0), ("b", 2, None, "trends", T0), ("c", 3, "fr", "youtube", T0)],
        "videoId string, topic_id int, lang string, platform string, ts_hour timestamp")
    return topics, videos


def test_last_n_hours_inclusive(spark):
    topics, _ = _gold(spark)
    got = sorted(r.topic_id for r in V.last_n_hours(topics, 1).collect())
    assert got == [1, 1, 3]          # latest hour and the one before: inclusive lower bound


def test_language_and_platform_filters(spark):
    topics, videos = _gold(spark)
    f = V.WindowFilter(hours=24, rising_only=False)                   # all languages, all platforms
    assert sorted({r.topic_id for r in V.topic_window(topics, videos, f).collect()}) == [1, 3]   # topic 2: only null lang
    f = V.WindowFilter(hours=24, rising_only=True, langs=[], platforms=["youtube"])
    assert sorted({r.topic_id for r in V.topic_window(topics, videos, f).collect()}) == [1]      # null platform → youtube


def test_top_topics_order_and_min_videos(spark):
    rows = [(T0, 1, 10.0, 50.0, 1, 1, "s1", "l1", "A"), (T0, 2, 10.0, 60.0, 2, 1, "s2", "", "B"),
            (T0 - dt.timedelta(hours=1), 2, 30.0, 1.0, 1, 1, "old", "lbl", None)]
    sub = spark.createDataFrame(rows, "ts_hour timestamp, topic_id int, rising_score double, velocity_sum double, "
                                      "video_count long, channel_count long, sample_title string, topic_label string, "
                                      "leader_channels string")
    top = V.top_topics(sub, min_videos=2).collect()
    assert [r.topic_id for r in top] == [2]
    r = top[0]
    assert (r.rising_score, r.video_count, r.sample_title, r.topic_label, r.leader_channels, r.label) == \
        (20.0, 3, "s2", "lbl", "B", "lbl")


def test_lookback_cap_seen(spark):
    listing = spark.createDataFrame(
        [("UC1", "v1", T0, 1), ("UC1", "v2", T0 - dt.timedelta(days=1), 3), ("UC1", "v3", None, 2),
         ("UC1", "v4", T0 - dt.timedelta(days=9), 4), ("UC2", "v5", T0, 1),
         ("UC1", "v6", None, 5), ("UC1", "v7", T0, 6), (None, "v8", T0 - dt.timedelta(days=9), 1), (None, "v9", T0, 2)],
        "channelId string, videoId string, videoPublishedAt timestamp, position int")
    cutoff = F.lit(T0 - dt.timedelta(days=2))
    kept = IG.lookback(listing, cutoff)
    assert sorted(r.videoId for r in kept.collect()) == ["v1", "v2", "v3", "v5"]     # the walk ends at v4: v6 and v7 lie beyond
    assert kept.columns == listing.columns
    capped = IG.per_channel_cap(kept, cap=2)
    assert sorted(r.videoId for r in capped.collect()) == ["v1", "v3", "v5"]       # list position, time known or not
    assert IG.per_channel_cap(listing).count() == IG.lookback(listing).count() == 9  # off unless asked for
    seen = spark.createDataFrame([("v1",)], "videoId string")
    assert sorted(r.videoId for r in IG.skip_seen(capped, seen).collect()) == ["v3", "v5"]   # cap before seen filter
    assert sorted(r.videoId for r in IG.advance_seen(seen, capped).collect()) == ["v1", "v3", "v5"]
    channels = spark.createDataFrame([(" One ", " UC1 "), (None, "UC9")], "name string, channel_id string")
    resolved, unresolved = IG.resolve_channels(capped, channels)
    assert {r.channel_name for r in resolved.collect()} == {"One"}
    assert [r.channelId for r in unresolved.collect()] == ["UC9"]


def test_unpivot_interest(spark):
    wide = spark.createDataFrame([(T0, 5, None, False)], "ts timestamp, a int, b int, isPartial boolean")
    got = sorted((r.q, r.interest) for r in IG.unpivot_interest(wide).collect())
    assert got == [("a", 5), ("b", 0)]
    long = spark.createDataFrame([(T0, 1), (T0 - dt.timedelta(days=30), 2)], "ts timestamp, n int")
    assert IG.last_days(long).count() == 2 and IG.last_days(long, 7).count() == 1
    assert IG.last_days(long, 40).count() == 1         # hours are served for a week


def test_normalize_gold_and_export(spark):
    import os
    import tempfile

    topics = spark.createDataFrame([(T0, 1, 2.5, "s")], "ts_hour timestamp, topic_id int, zscore double, sample_title string")
    videos = spark.createDataFrame([("v1", "A", 1, T0, 2.0), ("v2", "B", 1, T0, 3.0)],
                                   "videoId string, channelTitle string, topic_id int, ts_hour timestamp, decayed_velocity double")
    th, vt = V.normalize_gold(topics, videos)
    r = th.first()
    assert (r.rising_score, r.leader_channels, r.topic_label) == (50.0, "A, B", "s")
    assert vt.first().platform == "youtube"
    root = tempfile.mkdtemp(prefix="tidemark-export-")
    paths = V.export({"top_topics": th}, root)
    back = spark.read.option("header", True).csv(paths["top_topics"])
    assert back.count() == 1 and "leader_channels" in back.columns
    assert os.path.isdir(paths["top_topics"])


def test_outputs_are_ordered(spark):
    """Row order, not just row sets."""
    from tidemark.operators import network as NW
    hours = [T0 + dt.timedelta(hours=h) for h in (3, 0, 2)]
    sub = spark.createDataFrame([(t, 1, 1.0, 2.0) for t in hours], "ts_hour timestamp, topic_id int, velocity_sum double, rising_score double").repartition(3)
    topic = spark.createDataFrame([(1,)], "topic_id int")
    assert [r.ts_hour for r in V.topic_history(sub, topic).collect()] == sorted(hours)
    rows = [("a", f"c{i % 13}", "t", "en", float(i % 7), T0, 1, "p" if i % 3 else "q") for i in range(60)]
    tv = spark.createDataFrame(rows, "videoId string, channelTitle string, title_clean string, lang string, decayed_velocity double, "
                                     "ts_hour timestamp, topic_id int, platform string").repartition(4)
    got = [r.decayed_velocity for r in V.topic_videos_search(tv).collect()]
    assert got == sorted(got, reverse=True)
    from tidemark.operators import videosets as VS
    numbers = VS.video_numbers(tv)
    mix = [r.momentum for r in V.platform_mix(VS.sets(tv, numbers, VS.TOPIC_SET)).collect()]
    assert mix == sorted(mix, reverse=True)
    window = spark.createDataFrame([(T0,)], "ts_hour timestamp")
    board = V.channel_leaderboard(window, VS.sets(tv, numbers, VS.CHANNEL_SET)).collect()
    assert [(-r.momentum, r.channelTitle) for r in board] == sorted((-r.momentum, r.channelTitle) for r in board) and {r.posts for r in board} == {1}
    top = V.channel_contributions(tv).collect()
    want = {}
    for r in rows:
        want[r[1]] = want.get(r[1], 0.0) + r[4]
    assert [(r.channelTitle, r.contrib, r["rank"]) for r in top] == [
        (c, v, i + 1) for i, (c, v) in enumerate(sorted(want.items(), key=lambda x: (-x[1], x[0]))[:10])]
    weights = [r.weight for r in NW.channel_strength(NW.edges(tv)).collect()]
    assert weights == sorted(weights, reverse=True) and len(weights) == 13
    options = [(r.option, r.value) for r in V.filter_options(sub, tv).collect()]
    assert options == sorted(options)
    few = spark.createDataFrame([(i, "l", float(i % 4), float(i)) for i in range(15)], "topic_id int, label string, rising_score double, velocity_sum double")
    assert [r.topic_id for r in V.top_chart(few).collect()] == [11, 7, 3, 14, 10, 6, 2, 13, 9, 5]


def test_window_filter_prunes_dates(spark):
    import os
    import tempfile
    root = os.path.join(tempfile.mkdtemp(prefix="tidemark-dates-"), "t")
    df = spark.createDataFrame([(T0 - dt.timedelta(days=d), d) for d in range(5)], "ts_hour timestamp, topic_id int")
    df.withColumn("date", F.to_date("ts_hour")).write.partitionBy("date").parquet(root)
    sub = V.local_date_range(spark.read.parquet(root), "2024-12-31", "2025-01-01")
    assert sub.count() == 2
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
