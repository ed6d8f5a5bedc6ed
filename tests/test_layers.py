"""Layers hold no titles; silver with titles equals the plain job, also where events or documents come twice."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import clean
from tidemark.operators import textmine as TX
from tidemark.operators import topics as TP
from tidemark.plans import pipeline as PL


def _tables(spark, root, twice):
    rng = random.Random(4)
    at = dt.datetime(2024, 1, 1)
    events = [(i, at + dt.timedelta(minutes=rng.randint(0, 300)), rng.randint(1, 9), rng.choice(["view", "signup", "error", None]), rng.choice([None, float(i), 2.5]),
               rng.choice(['{"k": %d}' % (i % 40), None])) for i in range(400)]
    docs = [(i, rng.choice([None, "", f"Title  {i}\nmore words", f"t{i}"]), rng.choice(["en", None]), f"src{i % 3}") for i in range(60)]
    if twice:
        events += [(i, at, 3, "view", 1.0, '{"k": 5}') for i in range(0, 400, 7)] + events[:50]
        docs += [(i, f"again {i}", "fr", "src9") for i in range(0, 60, 5)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{root}/events.parquet")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{root}/documents.parquet")
    return str(root)


@pytest.mark.parametrize("twice", [False, True])
def test_silver_equals_the_plain_job_and_layers_hold_no_title(spark, tmp_path, twice):
    d = _tables(spark, tmp_path, twice)
    plain = clean.prepare(PL.bronze(spark, d), keep=["_seq", "_lang", "topic_id"], order=["_seq"], lang=F.col("_lang"))
    want = clean.finish(plain, clean.rate_caps(plain), extra=["topic_id"])
    got = PL.silver(spark, d)
    assert got.columns == want.columns and want.count() > 100
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    numbers = PL.silver_numbers(spark, d)
    assert numbers.columns == [c for c in want.columns if c not in PL.TEXTS]
    assert not {c for (_, _, _, name), path in PL._written.items() if name == "silver_pre" for c in spark.read.parquet(path).columns} & set(PL.TEXTS)
    a, b = TP.sample_titles(PL.hours(spark, d), texts=PL.texts(spark, d)), TP.sample_titles(TP.with_hour(want))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_labels_write_no_words(spark, monkeypatch):
    """Titles are cut into words where they are read; keys whose titles have one word at most still get their words."""
    staged = []
    monkeypatch.setattr(TX, "stage", lambda df, name, *a, keep=TX.stage: (staged.append((name, df.columns)), keep(df, name, *a))[1])
    df = spark.createDataFrame([(1, "y", "a", "x y x y"), (1, "y", "b", ""), (2, "y", "c", "solo"), (2, "y", "d", None), (3, "y", "e", "  "), (None, "y", "f", "one two")],
                               "topic_id int, platform string, videoId string, title_clean string")
    got = {r.topic_id: r.topic_label for r in TX.topic_labels(df).collect()}
    assert got[1] == "x y, y x" and got[2] == "solo" and got[3] == ""
    assert staged and not [name for name, columns in staged if "_w" in columns]
