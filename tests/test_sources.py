"""Tolerant CSV, bronze JSON families, channels CSV."""
import os
import tempfile

from pyspark.sql import types as T

from tidemark.sources.bronze import load_diagnostics, read_bronze
from tidemark.sources.csv import csv_diagnostics, read_channels, read_csv_tolerant, tolerant_rows

SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                       T.StructField("c", T.DoubleType())])


def test_tolerant_csv(spark):
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    with open(os.path.join(d, "part-0.csv"), "w") as f:
        f.write('a,b,c\n1,2,3\n4,5\n6,7,8,9\na,b,c\n10,"multi\nline ""q""",1.5\n11,"",x\n')
    df = read_csv_tolerant(spark, d, SCHEMA, multiline=True)
    rows = sorted(tuple(r) for r in tolerant_rows(df).collect())
    # a quoted empty field reads as NULL, as in the reference's loader (blank → missing)
    assert rows == [(1, "2", 3.0), (4, "5", None), (10, 'multi\nline "q"', 1.5), (11, None, None)]
    diag = csv_diagnostics(df).first()
    assert (diag.rows, diag.skipped) == (4, 1)


def test_bronze_families_and_empty(spark):
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    os.makedirs(os.path.join(d, "youtube_raw_20250101T000000Z"))
    with open(os.path.join(d, "youtube_raw_20250101T000000Z", "part-0.json"), "w") as f:
        f.write('{"id": {"videoId": "abc"}, "snippet": {"title": "t"}, "_fetched_at": "2025-01-01T00:00:00Z"}\n{broken\n')
    got = read_bronze(spark, d)
    assert got.count() == 2
    assert load_diagnostics(got).first().skipped == 1
    assert got.where("_corrupt is null").first().id.replace(" ", "") == '{"videoId":"abc"}'
    empty = read_bronze(spark, tempfile.mkdtemp(prefix="tidemark-test-"))
    assert empty.count() == 0 and "snippet" in empty.columns


def test_channels_csv(spark):
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    p = os.path.join(d, "channels.csv")
    with open(p, "w") as f:
        f.write("name , channel_id\n News One , UC1 \n,UC2\n")
    rows = [tuple(r) for r in read_channels(spark, p).collect()]
    assert rows == [("News One", "UC1"), ("", "UC2")]


def test_csv_columns_by_name_and_exact_field_count(spark):
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    for name, text in (("1.csv", "b, a ,c\nx,1,0.5\n6,7,8,\n6,7,8,,5\n\"q,\"\"r\",2\n"), ("2.csv", "a,c\n3,2.5\n"),
                       ("3.csv", "c,extra,b,a\n1.5,z,y,4\nc,extra,b,a\n")):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    df = read_csv_tolerant(spark, d, SCHEMA)
    assert sorted(map(tuple, tolerant_rows(df).collect())) == [(1, "x", 0.5), (2, 'q,"r', None), (3, None, 2.5), (4, "y", 1.5)]
    assert {(os.path.basename(r._source_file), r.rows, r.skipped) for r in csv_diagnostics(df).collect()} == {
        ("1.csv", 2, 2), ("2.csv", 1, 0), ("3.csv", 1, 0)}


def test_header_scan_sorts_no_lines(spark):
    from tidemark.sources import csv
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    for k in range(3):
        spark.range(k * 40000, (k + 1) * 40000, 1, 1).selectExpr(f"id AS a{k % 2}", "repeat('x', 50) AS b").write.mode("append").option("header", True).csv(
            d, compression="gzip" if k else None)
    plans, spark_df = [], type(spark.range(1))
    collect = spark_df.collect
    spark_df.collect = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df)
    try:
        got = csv._headers(spark, d, "UTF-8")
    finally:
        spark_df.collect = collect
    assert [(names, len(files)) for names, files in got] == [(["a0", "b"], 2), (["a1", "b"], 1)]
    assert plans and not any("SortAggregate" in p or "Sort [file" in p for p in plans)
    assert csv.read_csv_tolerant(spark, d, T.StructType([T.StructField("a0", T.LongType())])).where("a0 IS NOT NULL").count() == 80000


def test_compressed_csv(spark):
    from tidemark import sinks
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    rows = [(1, 'a "b"\nc', 0.5), (2, None, None)]
    path = sinks.write_csv(spark.createDataFrame(rows, SCHEMA), os.path.join(d, "one"), compression="gzip")
    assert sorted(map(tuple, tolerant_rows(read_csv_tolerant(spark, path, SCHEMA, multiline=True)).collect())) == rows
    saved = sinks.repair_and_save(tolerant_rows(read_csv_tolerant(spark, path, SCHEMA, multiline=True)), os.path.join(d, "two"), "gzip")
    assert all(f.endswith(".gz") for f in os.listdir(saved) if f.startswith("part-"))
    assert sorted(map(tuple, tolerant_rows(read_csv_tolerant(spark, saved, SCHEMA, multiline=True)).collect())) == rows


def test_sinks(spark):
    import datetime as dt

    import pytest

    from tidemark import sinks
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    df = spark.createDataFrame([(1, "é"), (2, None)], "a int, b string")
    at = dt.datetime(2025, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)
    path = sinks.write_jsonl(df, d, "youtube_raw", at)
    assert os.path.basename(path) == "youtube_raw_20250102T030405Z"
    assert sorted(r.value for r in spark.read.text(path).collect()) == ['{"a":1,"b":"é"}', '{"a":2}']
    manifest = os.path.join(d, "manifest")
    for _ in range(2):
        sinks.append_manifest(spark.createDataFrame([("f", 3)], "file string, records int"), manifest)
    assert spark.read.option("header", True).csv(manifest).count() == 2
    for records, run in ((3, "20250101T000000Z"), (4, "20250102T000000Z"), (5, "20250101T000000Z")):
        sinks.append_manifest(spark.createDataFrame([("f", records)], "file string, records int"), manifest + "-runs", run)
    kept = spark.read.option("header", True).csv(manifest + "-runs")
    assert sorted((r.run, r.records) for r in kept.collect()) == [("20250101T000000Z", "5"), ("20250102T000000Z", "4")]
    one = sinks.write_csv(df.repartition(3), os.path.join(d, "one"), single_file=True)
    assert len([f for f in os.listdir(one) if f.startswith("part-")]) == 1
    back = sinks.repair_and_save(spark.read.option("header", True).csv(one), os.path.join(d, "two"))
    assert spark.read.option("header", True).csv(back).count() == 2
    with pytest.raises(ValueError):
        sinks.repair_and_save(spark.read.option("header", True).csv(one), one)


def test_wrong_types_keep_the_record(spark):
    from tidemark.sources.bronze import usable
    d = tempfile.mkdtemp(prefix="tidemark-test-")
    os.makedirs(os.path.join(d, "youtube_raw_1"))
    lines = ['{"id":"a","statistics":"n/a","snippet":{"title":"t"},"_fetched_at":"2025-01-01T00:00:00Z"}',
             '{"id":"b","contentDetails":"x","snippet":{"title":"t","localized":"x"},"_fetched_at":"2025-01-01T00:00:00Z"}',
             '{"id":"c","snippet":', '["no object"]', '17']
    with open(os.path.join(d, "youtube_raw_1", "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    got = {r.id: r.snippet.title for r in usable(read_bronze(spark, d)).collect()}
    assert got == {"a": "t", "b": "t"}
