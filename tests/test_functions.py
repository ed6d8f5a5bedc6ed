"""Scalar functions on literal rows (edge cases of FIXTURES.md §4)."""
import regex
from pyspark.sql import functions as F

from tidemark.functions import numeric as N
from tidemark.functions import parse as P
from tidemark.functions import text as X


def col1(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_iso_duration(spark):
    got = col1(spark, ["PT1M30S", "P1DT2H3M4S", "P", "PT", "1M30S", None, "PT45S", "P2D"], P.iso_duration_seconds)
    assert got == [90, 93784, 0, 0, None, None, 45, 172800]


def test_video_id(spark):
    got = col1(spark, ["abc", '{"videoId":"def"}', '{"kind":"x"}', None], P.video_id)
    assert got == ["abc", "def", None, None]


def test_pick_title(spark):
    df = spark.createDataFrame([("", "L"), (None, "L"), ("T", "L"), (None, None)], "t string, l string")
    assert [r[0] for r in df.select(P.pick_title("t", "l")).collect()] == ["L", "L", "T", None]


def test_lenient_parsing(spark):
    ts = col1(spark, ["2025-09-18T10:00:00Z", "2025-09-18T10:00:00.5+00:00", "2025-09-18T15:30:00+05:30", "bad"],
              P.lenient_timestamp)
    assert str(ts[0]) == "2025-09-18 10:00:00" and str(ts[2]) == "2025-09-18 10:00:00"
    assert ts[1].microsecond == 500000 and ts[3] is None
    assert col1(spark, ["123", "4.5", "n/a", None], P.lenient_double) == [123.0, 4.5, None, None]


def test_collapse_whitespace(spark):
    got = col1(spark, ["\t a 　b\x1c", None, "  x  y\n", "a​b"], X.collapse_whitespace)
    # U+200B is not whitespace for Python either
    assert got == ["a b", "", "x y", "a​b"]


def test_words_match_python_regex(spark):
    s = "ශ්‍රී අද 7.00 pm வணக்கம்"          # ZWJ inside a Sinhala word splits it; Tamil marks stay
    want = regex.findall(r"[\p{L}\p{M}\p{N}]+", s)
    assert len(want) == 7 and want[2] == "අද"
    assert col1(spark, [s], X.words)[0] == want
    assert col1(spark, [None], X.words)[0] == []


def test_nfc_by_quick_check(spark):
    """Every text comes out in NFC; only texts with a character that NFC may change take the Python branch."""
    import random
    import unicodedata
    rng = random.Random(1)
    odd = ["e\u0301", "\u212b", "\u1112\u1161\u11ab", "\u0b95\u0bc6\u0bbe", "\u0327\u0301", "\ufb1d", "\uf900", "\U0001d15e", "a\u0345\u0301"]
    plain = ["abc", "Été ÿ", "", "日本 한국", "ශ්රී", "x" * 300, "ß ſ"]
    texts = odd + plain + [None] + ["".join(chr(rng.choice([*range(32, 0x700), *range(0x1E00, 0x2000), *range(0x1100, 0x1200)])) for _ in range(9)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.t for r in X.with_nfc(df, "t").collect()}
    assert got == {i: t if t is None else unicodedata.normalize("NFC", t) for i, t in enumerate(texts)}
    flagged = {r.i for r in df.where(X.maybe_not_nfc("t")).collect()}
    assert flagged >= set(range(len(odd))) and not flagged & set(range(len(odd), len(odd) + 4))
    assert all(unicodedata.is_normalized("NFC", t) for i, t in enumerate(texts) if t is not None and i not in flagged)


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    assert [r[0] for r in df.select(X.bigrams("w")).collect()] == [["a b", "b c"], [], []]


def test_readable_label(spark):
    df = spark.createDataFrame([("a b cd", "sample"), ("New York", "s"), ("", "sample"), ("", ""), (None, None),
                                ("x, y, zz", "")], "l string, s string")
    got = [r[0] for r in df.select(X.readable_label("l", "s")).collect()]
    assert got == ["sample", "New York", "sample", "", "", "x, y, zz"]


def test_display_label_and_url(spark):
    df = spark.createDataFrame([("", "t" * 100, "youtube", "abcdefghijk"), ("lbl", "t", "trends", "abcdefghijk"),
                                (None, "s", "YouTube", "abcdefghij")], "l string, s string, p string, v string")
    rows = df.select(X.display_label("l", "s"), X.watch_url("p", "v")).collect()
    assert rows[0][0] == "t" * 80 and rows[0][1] == "https://www.youtube.com/watch?v=abcdefghijk"
    assert rows[1][0] == "lbl" and rows[1][1] is None
    assert rows[2][0] == "s" and rows[2][1] is None


def test_title_search(spark):
    df = spark.createDataFrame([("Hello World",), (None,), ("a.b",)], "t string")
    assert [r[0] for r in df.select(X.title_search("t", "WOR")).collect()] == [True, False, False]
    assert [r[0] for r in df.select(X.title_search("t", "a.b", literal=True)).collect()] == [False, False, True]


def test_rising_score_and_flag(spark):
    z = [-1.0, 2.069944, 1.234282, 7.0, 2.0]
    got = spark.createDataFrame([(v,) for v in z], "z double").select(N.rising_score("z"), N.rising_flag("z")).collect()
    assert [r[0] for r in got] == [0.0, 41.4, 24.7, 100.0, 40.0]
    assert [r[1] for r in got] == [0, 1, 0, 1, 1]


def test_winsorise_and_decay(spark):
    df = spark.createDataFrame([(-1.0, 10.0), (5.0, 3.0), (5.0, None), (5.0, 0.0)], "x double, hi double")
    assert [r[0] for r in df.select(N.winsorise("x", F.col("hi"))).collect()] == [0.0, 3.0, 5.0, 5.0]
    d = spark.createDataFrame([(10.0, 120.0)], "r double, a double").select(N.decay("r", "a")).first()[0]
    assert abs(d - 10.0 * 0.36787944117144233) < 1e-12


def test_duration_overflow_and_script_share(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.parse import iso_duration_seconds
    from tidemark.operators import langid
    df = spark.createDataFrame([("P99999999999999999D",), ("P99999999999999999999999D",), ("P1DT1S",), ("PT",)], "d string")
    assert [r[0] for r in df.select(iso_duration_seconds("d")).collect()] == [None, None, 86401, 0]
    rows = [(1, "plain words of one language and a letter அ", "en"), (2, "more plain words here", "en"), (3, "அஆஇஈஉ word", None), (4, "palabras de otra lengua", "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.fit_detect(docs).collect()}
    assert got == {1: "en", 2: "en", 3: "ta", 4: "es"}
    assert langid.fit_detect(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred IS NOT NULL AND doc_id <> 3").count() == 0
