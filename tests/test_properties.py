"""Pipeline invariants on the sf0.001 tables."""
import math

from pyspark.sql import functions as F

from tidemark.operators import network as NW
from tidemark.operators import topics as TP
from tidemark.plans import pipeline as PL

SF = "/root/testdata/sf0.001"


def test_velocity_conserved_and_network_balanced(spark):
    th, vt = PL.topics_hourly(spark, SF), PL.videos_with_topics(spark, SF)
    s_topics = th.agg(F.sum("velocity_sum")).first()[0]
    s_videos = vt.agg(F.sum("decayed_velocity")).first()[0]
    assert math.isclose(s_topics, s_videos, rel_tol=1e-9)
    e = NW.edges(vt)
    a = NW.channel_strength(e).agg(F.sum("weight")).first()[0]
    b = NW.topic_strength(e).agg(F.sum("weight")).first()[0]
    s_named = vt.where(F.col("channelTitle").isNotNull()).agg(F.sum("decayed_velocity")).first()[0]
    assert math.isclose(a, b, rel_tol=1e-9) and math.isclose(a, s_named, rel_tol=1e-9)
    assert th.groupBy("ts_hour", "topic_id").count().where("count > 1").count() == 0
    assert th.where((F.col("rising_score") < 0) | (F.col("rising_score") > 100)).count() == 0


def test_zscores_independent_of_partitioning(spark):
    v = TP.with_hour(PL.silver(spark, SF))
    labels = PL.labels(spark, SF)
    a = {(r.ts_hour, r.topic_id): r.zscore for r in TP.topics_hourly(v, labels).collect()}
    b = {(r.ts_hour, r.topic_id): r.zscore for r in TP.topics_hourly(v.repartition(3, "videoId"), labels).collect()}
    assert a.keys() == b.keys()
    assert all(math.isclose(a[k], b[k], rel_tol=1e-9, abs_tol=1e-12) for k in a)
