"""End-to-end file jobs: bronze JSONL written from the test tables → silver → gold → views."""
import os
import tempfile

from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.plans import views as V
from tidemark.plans.pipeline import bronze
from tidemark.sinks import bronze_json_lines
from tidemark.schemas import SILVER_COLS, TOPICS_HOURLY_COLS, VIDEOS_WITH_TOPICS_COLS

SF = "/root/testdata/sf0.001"


def test_clean_topics_views(spark):
    root = tempfile.mkdtemp(prefix="tidemark-jobs-")
    lines = bronze_json_lines(bronze(spark, SF)).select("value")
    lines.write.text(os.path.join(root, "bronze", "youtube_raw_20240131T000000Z"))
    docs = spark.read.parquet(os.path.join(SF, "documents.parquet"))
    silver = jobs.clean_job(spark, os.path.join(root, "bronze"), os.path.join(root, "silver"), lang_profile=docs,
                            csv_path=os.path.join(root, "silver_csv"))
    assert silver.columns == SILVER_COLS
    n = silver.count()
    assert n > 0 and silver.groupBy("platform", "videoId").count().where("count > 1").count() == 0
    assert silver.where(F.col("lang").isNotNull()).count() > 0.9 * n
    th, vt = jobs.topics_job(spark, os.path.join(root, "silver"), os.path.join(root, "gold"))
    assert th.columns == [*TOPICS_HOURLY_COLS, "date"]
    assert vt.count() == n
    top = V.top_topics(V.topic_window(th, vt, V.WindowFilter(hours=None, rising_only=False, min_videos=1)), min_videos=1)
    assert 0 < top.count() <= 20


def test_clean_job_empty_bronze(spark):
    root = tempfile.mkdtemp(prefix="tidemark-jobs-")
    os.makedirs(os.path.join(root, "bronze"))
    silver = jobs.clean_job(spark, os.path.join(root, "bronze"), os.path.join(root, "silver"))
    assert silver.count() == 0 and silver.columns == SILVER_COLS


def test_topics_job_on_few_rows(spark):
    """A day without data gives empty gold with every column; one and two videos get topics."""
    import json
    for n in (0, 1, 2):
        root = tempfile.mkdtemp(prefix="tidemark-jobs-")
        d = os.path.join(root, "bronze", "youtube_raw_20250101T100000Z")
        os.makedirs(d)
        with open(os.path.join(d, "part-0.json"), "w") as f:
            for i in range(n):
                f.write(json.dumps({"id": f"video{i:06d}", "_fetched_at": "2025-01-01T10:00:00Z",
                                    "snippet": {"title": f"Some title no{i}", "publishedAt": "2025-01-01T09:00:00Z"}, "statistics": {"viewCount": "9"}}) + "\n")
        jobs.clean_job(spark, os.path.join(root, "bronze"), os.path.join(root, "silver"))
        th, vt = jobs.topics_job(spark, os.path.join(root, "silver"), os.path.join(root, "gold"))
        assert th.columns == [*TOPICS_HOURLY_COLS, "date"] and vt.columns == [*VIDEOS_WITH_TOPICS_COLS, "date"]
        assert sorted(r.topic_id for r in vt.collect()) == list(range(n))
        sub = V.topic_window(th, vt, V.WindowFilter(hours=None, rising_only=False, min_videos=1, langs=[]))
        assert V.kpis(sub, jobs.load_sets(spark, os.path.join(root, "gold"))[0], V.top_topics(sub, min_videos=1)).first().videos_in_window == n


def test_clean_job_tie_goes_to_later_file(spark):
    import json
    root = tempfile.mkdtemp(prefix="tidemark-jobs-")
    def dump(name, views):
        d = os.path.join(root, "bronze", name)
        os.makedirs(d)
        rec = {"id": "abcdefghijk", "platform": "youtube", "_fetched_at": "2025-01-01T10:00:00Z",
               "snippet": {"title": "t", "publishedAt": "2025-01-01T09:00:00Z"}, "statistics": {"viewCount": views}}
        with open(os.path.join(d, "part-0.json"), "w") as f:
            f.write(json.dumps(rec) + "\n")
    dump("youtube_raw_20250101T100000Z", "1")
    dump("youtube_raw_20250101T110000Z", "2")        # same fetch time, later dump
    silver = jobs.clean_job(spark, os.path.join(root, "bronze"), os.path.join(root, "silver"))
    assert [r.views for r in silver.collect()] == [2.0]


def test_clean_job_tie_in_one_file_goes_to_the_later_line(spark):
    """Equal stamps within a file, however the scan is split."""
    import json
    root = tempfile.mkdtemp(prefix="tidemark-jobs-")
    d = os.path.join(root, "bronze", "youtube_raw_20250101T100000Z")
    os.makedirs(d)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        for i in range(400):
            f.write(json.dumps({"id": f"video{i % 8:06d}", "_fetched_at": "2025-01-01T10:00:00Z",
                                "snippet": {"title": f"t{i}", "publishedAt": "2025-01-01T09:00:00Z"}, "statistics": {"viewCount": str(999 - i)}}) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        results = []
        for size in ("1m", "4k", "1500"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            silver = jobs.clean_job(spark, os.path.join(root, "bronze"), os.path.join(root, f"silver{size}"))
            results.append(sorted((r.videoId, r.title) for r in silver.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert results[0] == results[1] == results[2] == [(f"video{i:06d}", f"t{392 + i}") for i in range(8)]
