"""Query registry: name → (Spark plan builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables (or layers Spark derived from them).  DOUBLE outputs are
rounded to 6 decimals on both sides (sums and ``exp`` differ in the last
bits between engines).
"""
from __future__ import annotations

import datetime as _dt
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import clean
from ..operators import sketch as SK
from . import pipeline as PL
from . import sql as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _r(expr: str, digits: int = 6) -> str:
    """SQL twin of ``pipeline.round_half_away``."""
    m = f"{10 ** digits}.0"
    return (f"(CASE WHEN abs({expr}) < 1e12 THEN sign({expr}) * floor(abs({expr}) * {m} + 0.5) / {m} "
            f"ELSE {expr} END)")


# ---------------------------------------------------------------- bronze → silver

_FLAT_COLS = ["platform", "videoId", "title", "description", "channelId", "channelTitle",
              "publishedAt", "fetchedAt", "views", "likes", "comments", "duration_sec"]


@query("bronze_flatten", S.with_(S.BRONZE_FLAT, "SELECT seq AS _seq, " + ", ".join(
    _r(c) + " AS " + c if c in ("views", "likes", "comments") else c for c in _FLAT_COLS) + " FROM flat"))
def q_bronze_flatten(spark, sf_dir):
    return PL.rounded(clean.flatten(PL.bronze(spark, sf_dir), keep=["_seq"]).select("_seq", *_FLAT_COLS))


@query("duration_seconds", S.with_(S.BRONZE_FLAT, "SELECT seq AS _seq, duration_sec FROM flat"))
def q_duration_seconds(spark, sf_dir):
    return clean.flatten(PL.bronze(spark, sf_dir), keep=["_seq"]).select("_seq", "duration_sec")


@query("key_filter_skew_cap", S.with_(S.SILVER, "SELECT seq AS _seq, platform, videoId, publishedAt, fetchedAt FROM keyed"))
def q_key_filter_skew_cap(spark, sf_dir):
    flat = clean.flatten(PL.bronze(spark, sf_dir), keep=["_seq"])
    return clean.cap_future_publish(clean.key_filter(flat)).select("_seq", "platform", "videoId", "publishedAt", "fetchedAt")


@query("dedup_latest", S.with_(S.SILVER, "SELECT platform, videoId, fetchedAt, seq AS _seq FROM ded"))
def q_dedup_latest(spark, sf_dir):
    return PL.silver_pre(spark, sf_dir).select("platform", "videoId", "fetchedAt", "_seq")


@query("title_clean", "SELECT doc_id, " + S.clean_ws("text") + " AS title_clean FROM documents")
def q_title_clean(spark, sf_dir):
    from ..sources.tables import table
    return table(spark, sf_dir, "documents", spread_rows=True).select("doc_id", X.collapse_whitespace("text").alias("title_clean"))


@query("rates_and_age", S.with_(S.SILVER, "SELECT platform, videoId, " + ", ".join(
    _r(a) + " AS " + b for a, b in [("views", "views"), ("likes", "likes"), ("comments", "comments"), ("age_min", "age_min"),
                                   ("vpm", "views_per_min"), ("lpm", "likes_per_min"), ("cpm", "comments_per_min")]) + " FROM pre2"))
def q_rates_and_age(spark, sf_dir):
    return PL.rounded(PL.silver_pre(spark, sf_dir).select(
        "platform", "videoId", "views", "likes", "comments", "age_min", *clean.RATE_COLS))


@query("winsorised_rates", S.with_(S.SILVER, "SELECT platform, videoId, " + ", ".join(
    _r(c) + " AS " + c for c in clean.RATE_COLS) + " FROM silver"))
def q_winsorised_rates(spark, sf_dir):
    return PL.rounded(PL.silver_numbers(spark, sf_dir).select("platform", "videoId", *clean.RATE_COLS))


@query("decayed_velocity", S.with_(S.SILVER, "SELECT platform, videoId, " + _r("decayed_velocity") + " AS decayed_velocity FROM silver"))
def q_decayed_velocity(spark, sf_dir):
    return PL.rounded(PL.silver_numbers(spark, sf_dir).select("platform", "videoId", "decayed_velocity"))


@query("silver_table", S.with_(S.SILVER, "SELECT platform, videoId, channelId, channelTitle, title, title_clean, description, "
       "lang, duration_sec, publishedAt, fetchedAt, " + ", ".join(
           _r(c) + " AS " + c for c in ["views", "likes", "comments", "age_min", "views_per_min", "likes_per_min",
                                         "comments_per_min", "decayed_velocity"]) + " FROM silver"))
def q_silver_table(spark, sf_dir):
    from ..schemas import SILVER_COLS
    return PL.rounded(PL.silver(spark, sf_dir).select(*SILVER_COLS))


@query("rows_by_platform", S.with_(S.SILVER, "SELECT platform, count(*) AS rows FROM silver GROUP BY platform"))
def q_rows_by_platform(spark, sf_dir):
    return PL.silver_numbers(spark, sf_dir).groupBy("platform").agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------- silver → gold

@query("hourly_topic_agg", S.with_(S.GOLD, "SELECT ts_hour, topic_id, " + _r("velocity_sum") +
       " AS velocity_sum, video_count, channel_count FROM agg"))
def q_hourly_topic_agg(spark, sf_dir):
    from ..operators import topics as TP
    agg = TP.hourly_aggregate(PL.hours(spark, sf_dir), PL.texts(spark, sf_dir))
    return PL.rounded(agg.select("ts_hour", "topic_id", "velocity_sum", "video_count", "channel_count"))


@query("sample_title", S.with_(S.GOLD, "SELECT ts_hour, topic_id, sample_title FROM agg"))
def q_sample_title(spark, sf_dir):
    from ..operators import topics as TP
    return TP.sample_titles(PL.hours(spark, sf_dir), texts=PL.texts(spark, sf_dir))


@query("leader_channels", S.with_(S.GOLD, "SELECT ts_hour, topic_id, leader_channels FROM leaders"))
def q_leader_channels(spark, sf_dir):
    from ..operators import topics as TP
    return TP.leader_channels(TP.with_hour(PL.silver_numbers(spark, sf_dir)))


@query("topic_label", S.with_(S.GOLD, "SELECT topic_id, topic_label FROM labels"))
def q_topic_label(spark, sf_dir):
    return PL.labels(spark, sf_dir)


@query("rising_score", S.with_(S.GOLD, "SELECT ts_hour, topic_id, " + _r("velocity_sum") + " AS velocity_sum, " +
       _r("zscore") + " AS zscore, rising_flag, rising_score FROM topics_hourly"))
def q_rising_score(spark, sf_dir):
    th = PL.topics_hourly(spark, sf_dir)
    return PL.rounded(th.select("ts_hour", "topic_id", "velocity_sum", "zscore", "rising_flag", "rising_score"))


@query("topics_hourly_full", S.with_(S.GOLD, "SELECT ts_hour, topic_id, topic_label, leader_channels, " +
       _r("velocity_sum") + " AS velocity_sum, video_count, channel_count, " + _r("zscore") +
       " AS zscore, rising_flag, rising_score, sample_title FROM topics_hourly"))
def q_topics_hourly_full(spark, sf_dir):
    return PL.rounded(PL.topics_hourly(spark, sf_dir))


@query("videos_with_topics", S.with_(S.GOLD, "SELECT videoId, channelId, channelTitle, title_clean, lang, " +
       _r("decayed_velocity") + " AS decayed_velocity, ts_hour, topic_id, platform FROM videos_with_topics"))
def q_videos_with_topics(spark, sf_dir):
    return PL.rounded(PL.videos_with_topics(spark, sf_dir))


# ---------------------------------------------------------------- dashboard views over gold

from . import views as V  # noqa: E402
from ..operators import network as NW  # noqa: E402

MAIN = V.WindowFilter(hours=None, rising_only=True, min_videos=2)     # custom range, default dates
TZ = "Asia/Colombo"
SEARCH_Q = "the|les"


def _gold(spark, sf_dir):
    """Topic hours, and videos without titles."""
    return PL.topics_hourly(spark, sf_dir), PL.videos_numbers(spark, sf_dir)


def _main(spark, sf_dir, f: V.WindowFilter = MAIN):
    th, vt = _gold(spark, sf_dir)
    return th, vt, V.topic_window(th, vt, f)


def _local(c: str) -> str:
    return f"timezone('{TZ}', timezone('UTC', {c}))"


def _utc(c: str) -> str:
    return f"timezone('UTC', timezone('{TZ}', {c}))"


def _sub_sql(name: str, hours: int | None = None, d1: str | None = None, d2: str | None = None,
             rising: bool = True, langs: list[str] | None = None, plats: list[str] | None = None) -> str:
    if hours is not None:
        win = (f"{name}_w AS (SELECT t.* FROM topics_hourly t, (SELECT max(ts_hour) AS m FROM topics_hourly) x "
               f"WHERE t.ts_hour >= x.m - INTERVAL {hours} HOUR)")
    elif d1 is None:
        win = (f"{name}_w AS (SELECT t.* FROM topics_hourly t, (SELECT min({_local('ts_hour')}) AS lo, "
               f"max({_local('ts_hour')}) AS hi FROM topics_hourly) b "
               f"WHERE t.ts_hour >= {_utc('CAST(CAST(b.lo AS DATE) AS TIMESTAMP)')} "
               f"AND t.ts_hour < {_utc('CAST(CAST(b.hi AS DATE) + INTERVAL 1 DAY AS TIMESTAMP)')})")
    else:
        win = (f"{name}_w AS (SELECT * FROM topics_hourly WHERE ts_hour >= {_utc(f'TIMESTAMP {chr(39)}{d1} 00:00:00{chr(39)}')} "
               f"AND ts_hour < {_utc(f'CAST(DATE {chr(39)}{d2}{chr(39)} + INTERVAL 1 DAY AS TIMESTAMP)')})")
    conds = []
    if rising:
        conds.append("rising_flag = 1")
    if langs is None or langs:
        lc = "lang IS NOT NULL" if langs is None else "lang IN (" + ", ".join(f"'{x}'" for x in langs) + ")"
        conds.append(f"topic_id IN (SELECT topic_id FROM videos_with_topics WHERE {lc})")
    if plats is None or plats:
        pc = "" if plats is None else " AND coalesce(platform, 'youtube') IN (" + ", ".join(f"'{x}'" for x in plats) + ")"
        conds.append(f"topic_id IN (SELECT topic_id FROM videos_with_topics WHERE topic_id IS NOT NULL{pc})")
    where = (" WHERE " + " AND ".join(conds)) if conds else ""
    return f",\n{win},\n{name} AS (SELECT * FROM {name}_w{where})"


_TOP_SQL = _sub_sql("sub") + r""",
top AS (
  SELECT topic_id, topic_label, sample_title, leader_channels, rising_score, velocity_sum, video_count, channel_count,
         substring(coalesce(nullif(topic_label, ''), sample_title), 1, 80) AS label
  FROM (
    SELECT topic_id, sum(velocity_sum) AS velocity_sum, avg(rising_score) AS rising_score,
           sum(video_count) AS video_count, sum(channel_count) AS channel_count,
           arg_max(nullif(sample_title, ''), ts_hour) FILTER (WHERE nullif(sample_title, '') IS NOT NULL) AS sample_title,
           arg_max(nullif(topic_label, ''), ts_hour) FILTER (WHERE nullif(topic_label, '') IS NOT NULL) AS topic_label,
           arg_max_null(leader_channels, ts_hour) AS leader_channels
    FROM sub GROUP BY topic_id) a
  WHERE video_count >= 2
  ORDER BY rising_score DESC, velocity_sum DESC, topic_id LIMIT 20),
sel AS (SELECT topic_id FROM top ORDER BY rising_score DESC, velocity_sum DESC, topic_id LIMIT 1),
tv AS (SELECT v.* FROM videos_with_topics v
       WHERE (v.topic_id, v.ts_hour) IN (SELECT s.topic_id, s.ts_hour FROM sub s WHERE s.topic_id IN (SELECT topic_id FROM sel)))"""


def _top_sql(body: str) -> str:
    return S.with_(S.GOLD + _TOP_SQL, body)


@query("window_last_n_hours", S.with_(S.GOLD + _sub_sql("sub", hours=24, rising=False, langs=[], plats=[]),
       "SELECT ts_hour, topic_id, " + _r("velocity_sum") + " AS velocity_sum FROM sub"))
def q_window_last_n_hours(spark, sf_dir):
    th, vt = _gold(spark, sf_dir)
    sub = V.topic_window(th, vt, V.WindowFilter(hours=24, rising_only=False, langs=[], platforms=[]))
    return PL.rounded(sub.select("ts_hour", "topic_id", "velocity_sum"))


@query("window_local_range", S.with_(S.GOLD + _sub_sql("sub", d1="2024-01-10", d2="2024-01-12", rising=False, langs=[], plats=[]),
       "SELECT ts_hour, topic_id, " + _r("velocity_sum") + " AS velocity_sum FROM sub"))
def q_window_local_range(spark, sf_dir):
    th, vt = _gold(spark, sf_dir)
    f = V.WindowFilter(hours=None, date_from="2024-01-10", date_to="2024-01-12", rising_only=False, langs=[], platforms=[])
    return PL.rounded(V.topic_window(th, vt, f).select("ts_hour", "topic_id", "velocity_sum"))


@query("topic_window_filters", S.with_(S.GOLD + _sub_sql("sub", rising=True, langs=["fr", "de"], plats=["trends"]),
       "SELECT ts_hour, topic_id, rising_score FROM sub"))
def q_topic_window_filters(spark, sf_dir):
    th, vt = _gold(spark, sf_dir)
    f = V.WindowFilter(hours=None, rising_only=True, langs=["fr", "de"], platforms=["trends"])
    return V.topic_window(th, vt, f).select("ts_hour", "topic_id", "rising_score")


@query("top_topics", _top_sql("SELECT topic_id, topic_label, sample_title, leader_channels, " + _r("rising_score") +
                              " AS rising_score, " + _r("velocity_sum") + " AS velocity_sum, video_count, channel_count, label FROM top"))
def q_top_topics(spark, sf_dir):
    th, vt, sub = _main(spark, sf_dir)
    return PL.rounded(V.top_topics(sub))


@query("kpis", _top_sql("SELECT (SELECT count(DISTINCT topic_id) FROM sub) AS topics_in_window, "
                        "(SELECT count(DISTINCT videoId) FROM videos_with_topics WHERE ts_hour IN (SELECT ts_hour FROM sub)) AS videos_in_window, "
                        "(SELECT " + _r("max(rising_score)") + " FROM top) AS top_rising_score"))
def q_kpis(spark, sf_dir):
    th, vt, sub = _main(spark, sf_dir)
    return PL.rounded(V.kpis(sub, PL.video_sets(spark, sf_dir), V.top_topics(sub)))


@query("topic_history", _top_sql("SELECT ts_hour, " + _local("ts_hour") + " AS ts_hour_local, " + _r("velocity_sum") +
                                 " AS velocity_sum, rising_score FROM sub WHERE topic_id IN (SELECT topic_id FROM sel)"))
def q_topic_history(spark, sf_dir):
    th, vt, sub = _main(spark, sf_dir)
    return PL.rounded(V.topic_history(sub, V.selected_topic(V.top_topics(sub))))


def _tv(spark, sf_dir, videos=PL.videos_numbers):
    th, vt, sub = _main(spark, sf_dir)
    return V.topic_videos(sub, videos(spark, sf_dir), V.selected_topic(V.top_topics(sub)))


@query("topic_videos_search", _top_sql(
    "SELECT " + _local("ts_hour") + " AS ts_hour_local, platform, channelTitle, title_clean, lang, " + _r("decayed_velocity") +
    " AS decayed_velocity, CASE WHEN lower(coalesce(platform, 'youtube')) = 'youtube' AND length(videoId) = 11 "
    "THEN 'https://www.youtube.com/watch?v=' || videoId END AS url, videoId FROM tv "
    f"WHERE coalesce(regexp_matches(lower(title_clean), '{SEARCH_Q}'), false)"))
def q_topic_videos_search(spark, sf_dir):
    return PL.rounded(V.topic_videos_search(_tv(spark, sf_dir, PL.videos_with_topics), SEARCH_Q))


@query("platform_mix", _top_sql("SELECT platform, " + _r("sum(decayed_velocity)") + " AS momentum, count(DISTINCT videoId) AS posts "
                                "FROM tv WHERE platform IS NOT NULL GROUP BY platform"))
def q_platform_mix(spark, sf_dir):
    _, _, sub = _main(spark, sf_dir)
    return PL.rounded(V.platform_mix(V.topic_videos(sub, PL.video_sets(spark, sf_dir), V.selected_topic(V.top_topics(sub)))))


@query("top_chart", _top_sql("SELECT topic_id, label, " + _r("rising_score") + " AS rising_score, CAST(rank AS INTEGER) AS rank FROM "
                             "(SELECT *, row_number() OVER (ORDER BY rising_score DESC, velocity_sum DESC, topic_id) AS rank FROM top) "
                             "WHERE rank <= 10"))
def q_top_chart(spark, sf_dir):
    th, vt, sub = _main(spark, sf_dir)
    return PL.rounded(V.top_chart(V.top_topics(sub)).select("topic_id", "label", "rising_score", "rank"))


@query("channel_contributions", _top_sql(
    "SELECT channelTitle, " + _r("contrib") + " AS contrib, CAST(rank AS INTEGER) AS rank FROM (SELECT channelTitle, contrib, "
    "row_number() OVER (ORDER BY contrib DESC, channelTitle) AS rank FROM (SELECT channelTitle, sum(decayed_velocity) AS contrib "
    "FROM tv WHERE channelTitle IS NOT NULL GROUP BY channelTitle)) WHERE rank <= 10"))
def q_channel_contributions(spark, sf_dir):
    return PL.rounded(V.channel_contributions(_tv(spark, sf_dir)))


@query("channel_leaderboard", _top_sql(
    "SELECT channelTitle, " + _r("momentum") + " AS momentum, posts FROM (SELECT channelTitle, sum(decayed_velocity) AS momentum, "
    "count(DISTINCT videoId) AS posts FROM videos_with_topics WHERE ts_hour IN (SELECT ts_hour FROM sub) AND channelTitle IS NOT NULL "
    "GROUP BY channelTitle ORDER BY momentum DESC, channelTitle LIMIT 25)"))
def q_channel_leaderboard(spark, sf_dir):
    th, vt, sub = _main(spark, sf_dir)
    return PL.rounded(V.channel_leaderboard(sub, PL.channel_sets(spark, sf_dir)))


@query("filter_options", S.with_(S.GOLD, "SELECT DISTINCT 'lang' AS option, lang AS value FROM videos_with_topics WHERE lang IS NOT NULL "
       "UNION ALL SELECT DISTINCT 'platform', coalesce(platform, 'youtube') FROM videos_with_topics "
       f"UNION ALL SELECT 'min_local_date', strftime(min({_local('ts_hour')}), '%Y-%m-%d') FROM topics_hourly "
       f"UNION ALL SELECT 'max_local_date', strftime(max({_local('ts_hour')}), '%Y-%m-%d') FROM topics_hourly"))
def q_filter_options(spark, sf_dir):
    th, vt = _gold(spark, sf_dir)
    return V.filter_options(th, vt)


@query("last_updated", S.with_(S.GOLD, "SELECT strftime(max(ts_hour), '%Y-%m-%d %H:%M') AS last_utc, "
       f"strftime(max({_local('ts_hour')}), '%Y-%m-%d %H:%M') AS last_local FROM topics_hourly"))
def q_last_updated(spark, sf_dir):
    th, _ = _gold(spark, sf_dir)
    return V.last_updated(th)


_EDGES = (",\nedges AS (SELECT channelTitle, topic_id, sum(decayed_velocity) AS weight FROM videos_with_topics "
          "WHERE channelTitle IS NOT NULL AND topic_id IS NOT NULL GROUP BY channelTitle, topic_id)")


@query("network_channel", S.with_(S.GOLD + _EDGES, "SELECT channelTitle, " + _r("sum(weight)") + " AS weight FROM edges GROUP BY channelTitle"))
def q_network_channel(spark, sf_dir):
    return PL.rounded(NW.channel_strength(NW.edges(PL.videos_numbers(spark, sf_dir))))


@query("network_topic", S.with_(S.GOLD + _EDGES, "SELECT topic_id, " + _r("sum(weight)") + " AS weight FROM edges GROUP BY topic_id"))
def q_network_topic(spark, sf_dir):
    return PL.rounded(NW.topic_strength(NW.edges(PL.videos_numbers(spark, sf_dir))))


# ---------------------------------------------------------------- text mining over documents

from ..operators import langid as LID  # noqa: E402
from ..operators import textmine as TX  # noqa: E402
from ..operators import topicmodel as TM  # noqa: E402
from . import topicsql as TQ  # noqa: E402
from ..sources.tables import table as _table  # noqa: E402


def _docs(spark, sf_dir):
    return _table(spark, sf_dir, "documents", spread_rows=True)


_WORDS_SQL = f"regexp_extract_all(text, '{S.WORD_RE2}')"


@query("tokens", f"SELECT doc_id, pos, w[pos + 1] AS word FROM (SELECT doc_id, w, unnest(generate_series(0, len(w) - 1)) AS pos "
                 f"FROM (SELECT doc_id, {_WORDS_SQL} AS w FROM documents))")
def q_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(X.words("text")).alias("pos", "word"))


@query("bigrams", f"SELECT doc_id, w[i] || ' ' || w[i + 1] AS gram, count(*) AS cnt FROM (SELECT doc_id, w, "
                  f"unnest(generate_series(1, len(w) - 1)) AS i FROM (SELECT doc_id, {_WORDS_SQL} AS w FROM documents)) GROUP BY ALL")
def q_bigrams(spark, sf_dir):
    return TX.count_terms(_docs(spark, sf_dir), "doc_id", X.words("text"), singles=False).select("doc_id", F.col("term").alias("gram"), F.col("n").alias("cnt"))


def _tfidf_sql(most: int | None = None) -> str:
    top = "" if most is None else f" QUALIFY row_number() OVER (ORDER BY cnt DESC, term) <= {most}"
    tok = f"list_filter(regexp_extract_all(lower(text), '{S.WORD_RE2}'), lambda t: length(t) >= 2)"
    return f"""WITH n AS (SELECT count(*) AS n FROM documents),
toks AS (SELECT doc_id, {tok} AS t FROM documents),
terms AS (SELECT doc_id, unnest(t) AS term FROM toks
          UNION ALL SELECT doc_id, t[i] || ' ' || t[i + 1] FROM (SELECT doc_id, t, unnest(generate_series(1, len(t) - 1)) AS i FROM toks)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
st AS (SELECT term, count(*) AS df, sum(tf) AS cnt FROM tf GROUP BY term),
vocab AS (SELECT term, ln((1.0 + n.n) / (df + 1.0)) + 1.0 AS idf FROM st, n
          WHERE df >= {TM.MIN_DF}{top}),
w AS (SELECT doc_id, tf.term, tf * idf AS w FROM tf JOIN vocab USING (term)),
nm AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
SELECT doc_id, term, {_r("w / norm")} AS weight FROM w JOIN nm USING (doc_id)"""


@query("tfidf_weights", _tfidf_sql())
def q_tfidf_weights(spark, sf_dir):
    return PL.rounded(TX.tfidf(_docs(spark, sf_dir), "doc_id", "text"))


MAX_FEATURES = 2000


@query("tfidf_max_features", _tfidf_sql(MAX_FEATURES))
def q_tfidf_max_features(spark, sf_dir):
    """Weights over the commonest terms only; the limit is the vocabulary's feature (ML-1)."""
    return PL.rounded(TX.tfidf(_docs(spark, sf_dir), "doc_id", "text", max_features=MAX_FEATURES))


_DOC_LABELS = S.labels_cte("documents", key="source", text="text", order="doc_id", name="dl", nfc=True)


@query("doc_topic_label", S.with_(_DOC_LABELS, "SELECT source, topic_label FROM dl"))
def q_doc_topic_label(spark, sf_dir):
    return TX.topic_labels(_docs(spark, sf_dir), key="source", text="text", order=("doc_id",))


@query("label_guard", S.with_(_DOC_LABELS + ",\nsamp AS (SELECT source, arg_max(nullif(text, ''), doc_id) AS sample_title "
                              "FROM documents GROUP BY source)",
                              "SELECT dl.source, " + S.readable_label_sql("dl.topic_label", "samp.sample_title") +
                              " AS topic_label FROM dl JOIN samp USING (source)"))
def q_label_guard(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    labels = TX.topic_labels(docs, key="source", text="text", order=("doc_id",))
    samp = docs.groupBy("source").agg(F.max_by(F.nullif("text", F.lit("")), "doc_id").alias("sample_title"))
    return labels.join(samp, "source").select("source", X.readable_label("topic_label", "sample_title").alias("topic_label"))


KMEANS_TOPICS = 32


def _kmeans_sql(**kw) -> str:
    model = TQ.topics_sql("documents", "doc_id", "text", str(KMEANS_TOPICS), seed_rounds=TM.SEED_ROUNDS, rounds=PL.KMEANS_ROUNDS, **kw)
    return S.with_(model, "SELECT key AS doc_id, topic_id, " + _r("sqrt(d2)") + " AS distance FROM topics")


@query("kmeans_topics", _kmeans_sql(min_df=TM.MIN_DF, ngram_max=TM.NGRAM_MAX, stop_words=False, smooth=1.0))
def q_kmeans_topics(spark, sf_dir):
    """Topic and distance of every document: words and pairs, smoothed weights (ML-5)."""
    return PL.rounded(TM.topics(_docs(spark, sf_dir), "doc_id", "text", KMEANS_TOPICS, TM.MIN_DF, TM.NGRAM_MAX, rounds=PL.KMEANS_ROUNDS))


def _langid_sql() -> str:
    strip = f"regexp_replace(regexp_replace(text, '^{S.WS_RE2}', ''), '{S.WS_RE2}$', '')"
    hashed = " + ".join(f"{m} * p[i + {k}]" for k, m in enumerate(LID.MULTIPLIERS))
    buckets = f"list_transform(range(1, len(p) - 1), lambda i: ({hashed}) % {LID.BUCKETS})"
    return f"""WITH d AS (SELECT doc_id, lang, text, lower({strip}) AS t FROM documents),
pt AS (SELECT doc_id, lang, list_transform(string_split(t, ''), lambda x: CAST(ord(x) AS BIGINT)) AS p FROM d WHERE length(t) >= 3),
dg AS (SELECT doc_id, lang, unnest({buckets}) AS gram FROM pt),
g AS MATERIALIZED (SELECT doc_id, lang, gram, count(*) AS n FROM dg GROUP BY ALL),
pc AS MATERIALIZED (SELECT lang, gram, sum(n) AS c FROM g WHERE lang IS NOT NULL GROUP BY ALL),
nv AS (SELECT count(DISTINCT gram) AS v FROM pc),
norms AS (SELECT lang, ln(sum(c) + (SELECT v FROM nv)) AS log_denom FROM pc GROUP BY lang),
prof AS (SELECT lang, gram, ln(c + 1.0) AS lc FROM pc),
tot AS (SELECT doc_id, sum(n) AS nn FROM g GROUP BY doc_id),
m AS (SELECT doc_id, prof.lang, sum(n * lc) AS s FROM g JOIN prof USING (gram) GROUP BY ALL),
sc AS (SELECT tot.doc_id, norms.lang, floor((tot.nn * norms.log_denom - coalesce(m.s, 0.0)) * 1e6 + 0.5) AS neg
       FROM tot CROSS JOIN norms LEFT JOIN m ON m.doc_id = tot.doc_id AND m.lang = norms.lang),
best AS (SELECT doc_id, arg_min(lang, (neg, lang)) AS best FROM sc GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL OR length({strip}) < 3 THEN NULL
                      WHEN len(regexp_extract_all(d.text, '[\\x{{0D80}}-\\x{{0DFF}}]')) * 2 > len(regexp_extract_all(d.text, '[\\p{{L}}\\p{{M}}]')) THEN 'si'
                      WHEN len(regexp_extract_all(d.text, '[\\x{{0B80}}-\\x{{0BFF}}]')) * 2 > len(regexp_extract_all(d.text, '[\\p{{L}}\\p{{M}}]')) THEN 'ta'
                      ELSE best.best END AS lang_pred
FROM d LEFT JOIN best USING (doc_id)"""


@query("lang_profile", _langid_sql())
def q_lang_profile(spark, sf_dir):
    return LID.fit_detect(_docs(spark, sf_dir))


# ---------------------------------------------------------------- collector semantics (re-aimed)

from ..operators import ingest as IG  # noqa: E402
from ..sources import fixtures as FX  # noqa: E402

RUN_AT = "2024-01-31 00:00:00"     # the collector's "now" is a parameter
LOOKBACK_DAYS = 14
CAP = 50
FETCHED_AT = "2024-01-31T00:00:00Z"

_LISTING_SQL = f"""nvid AS (SELECT greatest(1, CAST(floor(count(*) * 2 / 5) AS BIGINT)) AS nv FROM events),
listing AS (
  SELECT 'UC' || CAST(user_id AS VARCHAR) AS channelId, 'vid' || lpad(CAST(event_id % nv AS VARCHAR), CAST(greatest(8, length(CAST(event_id % nv AS VARCHAR))) AS INTEGER), '0') AS videoId,
         CASE WHEN event_id % 89 = 0 THEN NULL ELSE CAST(ts AS TIMESTAMP) END AS videoPublishedAt, -event_id AS position FROM events, nvid),
seen AS (SELECT DISTINCT 'vid' || lpad(CAST(event_id % nv AS VARCHAR), CAST(greatest(8, length(CAST(event_id % nv AS VARCHAR))) AS INTEGER), '0') AS videoId FROM events, nvid
         WHERE event_type = 'view' AND ts < TIMESTAMP '{RUN_AT}' - INTERVAL {LOOKBACK_DAYS} DAY),
walk AS (SELECT *, coalesce(bool_or(videoPublishedAt < TIMESTAMP '{RUN_AT}' - INTERVAL {LOOKBACK_DAYS} DAY)
           OVER (PARTITION BY channelId ORDER BY position, videoId ROWS UNBOUNDED PRECEDING), false) AS ended,
         row_number() OVER (PARTITION BY channelId ORDER BY position, videoId) AS rn FROM listing),
capped AS (SELECT channelId, videoId, videoPublishedAt FROM walk WHERE NOT ended AND rn <= {CAP}),
newl AS (SELECT * FROM capped WHERE videoId NOT IN (SELECT videoId FROM seen)),
unseen AS (SELECT * FROM listing WHERE videoId NOT IN (SELECT videoId FROM seen)),
details AS (SELECT 'vid' || lpad(CAST(event_id % nv AS VARCHAR), CAST(greatest(8, length(CAST(event_id % nv AS VARCHAR))) AS INTEGER), '0') AS videoId,
                   arg_max(value * 100, event_id) AS views FROM events, nvid WHERE event_type <> 'error' GROUP BY 1),
channels AS (SELECT trim(c_name) AS channel_name, trim('UC' || CAST(c_custkey AS VARCHAR)) AS channelId FROM customer)"""


def _listing(spark, sf_dir):
    return FX.listing_from_tables(spark, sf_dir)


def _seen(spark, sf_dir):
    return FX.seen_from_tables(spark, sf_dir, F.lit(RUN_AT).cast("timestamp") - F.make_dt_interval(days=F.lit(LOOKBACK_DAYS)))


def _new_listing(spark, sf_dir):
    """The collector's own listing step: the walk's end and the cap are its features."""
    cutoff = F.lit(RUN_AT).cast("timestamp") - F.make_dt_interval(days=F.lit(LOOKBACK_DAYS))
    listing = IG.per_channel_cap(IG.lookback(_listing(spark, sf_dir), cutoff), CAP)
    return IG.skip_seen(listing, _seen(spark, sf_dir))


def _unseen(spark, sf_dir):
    return IG.skip_seen(_listing(spark, sf_dir), _seen(spark, sf_dir))


@query("ingest_new_listing", f"WITH {_LISTING_SQL} SELECT channelId, videoId, videoPublishedAt FROM newl")
def q_ingest_new_listing(spark, sf_dir):
    return _new_listing(spark, sf_dir).select("channelId", "videoId", "videoPublishedAt")


@query("ingest_state_advance", f"WITH {_LISTING_SQL} SELECT videoId FROM seen UNION "
                               "SELECT videoId FROM unseen WHERE videoId IN (SELECT videoId FROM details)")
def q_ingest_state_advance(spark, sf_dir):
    fetched = IG.fetch_details(_unseen(spark, sf_dir), FX.details_from_tables(spark, sf_dir))
    return IG.advance_seen(_seen(spark, sf_dir), fetched)


@query("ingest_resolve_channels", f"WITH {_LISTING_SQL} SELECT n.channelId, c.channel_name, n.videoId, " + _r("d.views") + " AS views, "
                                  f"'{FETCHED_AT}' AS _fetched_at, 'youtube' AS platform "
                                  "FROM unseen n JOIN channels c USING (channelId) JOIN details d USING (videoId)")
def q_ingest_resolve_channels(spark, sf_dir):
    resolved, _ = IG.resolve_channels(_unseen(spark, sf_dir), FX.channels_from_tables(spark, sf_dir))
    got = IG.fetch_details(resolved, FX.details_from_tables(spark, sf_dir))
    return PL.rounded(IG.stamp(got, F.lit(FETCHED_AT)).select("channelId", "channel_name", "videoId", "views", "_fetched_at", "platform"))


@query("ingest_unresolved_channels", f"WITH {_LISTING_SQL} SELECT channelId, channel_name FROM channels "
                                     "WHERE channelId NOT IN (SELECT channelId FROM listing)")
def q_ingest_unresolved_channels(spark, sf_dir):
    _, unresolved = IG.resolve_channels(_listing(spark, sf_dir), FX.channels_from_tables(spark, sf_dir))
    return unresolved


_MANIFEST_SQL = """WITH runs AS (SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events WHERE event_type <> 'error')
SELECT 'youtube_raw_' || strftime(day, '%Y%m%dT%H%M%SZ') || '.jsonl' AS file, count(*) AS records,
       (SELECT count(*) FROM customer) AS channels,
       strftime(day - INTERVAL 2 DAY, '%Y-%m-%dT%H:%M:%SZ') AS published_after, strftime(day, '%Y-%m-%dT%H:%M:%SZ') AS fetched_at
FROM runs GROUP BY day"""


@query("ingest_manifest", _MANIFEST_SQL)
def q_ingest_manifest(spark, sf_dir):
    from ..sources.tables import events
    runs = events(spark, sf_dir).where(F.col("event_type") != "error").select(F.date_trunc("day", "ts").alias("day"))
    return IG.run_manifest(
        runs, "day", FX.channels_from_tables(spark, sf_dir),
        file=F.concat(F.lit("youtube_raw_"), F.date_format("day", "yyyyMMdd'T'HHmmss'Z'"), F.lit(".jsonl")),
        published_after=IG.iso_z(F.col("day") - F.make_dt_interval(days=F.lit(IG.DEFAULT_DAYS))),
        fetched_at=IG.iso_z("day"))


def _trends_sql(days: int | None = None) -> str:
    cut = "" if days is None else f" WHERE ts >= (SELECT max(ts) FROM h0) - INTERVAL {min(days, IG.INTEREST_DAYS_MOST)} DAY"
    return f"""WITH h0 AS (SELECT date_trunc('hour', CAST(ts AS TIMESTAMP)) AS ts, event_type FROM events WHERE event_type IS NOT NULL),
h AS (SELECT * FROM h0{cut}),
cnt AS (SELECT ts, event_type, count(*) AS interest FROM h GROUP BY ALL),
long AS (SELECT a.ts, b.event_type AS q, c.interest FROM (SELECT DISTINCT ts FROM h) a CROSS JOIN (SELECT DISTINCT event_type FROM h) b
         LEFT JOIN cnt c ON c.ts = a.ts AND c.event_type = b.event_type)
SELECT 'trends' AS platform, 'trends_' || q || '_' || CAST(epoch(ts) AS BIGINT) AS id, q AS title,
       'Google Trends interest for ''' || q || '''' AS description, 'trends:LK' AS channelId, 'Google Trends (LK)' AS channelTitle,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS publishedAt, CAST(coalesce(interest, 0) AS INTEGER) AS viewCount,
       0 AS likeCount, 0 AS commentCount, '{FETCHED_AT}' AS _fetched_at FROM long"""


@query("trends_last_days", _trends_sql(3))
def q_trends_last_days(spark, sf_dir):
    """The interest of the last three days (ING-13)."""
    return q_trends_unpivot(spark, sf_dir, 3)


@query("trends_unpivot", _trends_sql())
def q_trends_unpivot(spark, sf_dir, days=None):
    wide = FX.trends_wide_from_tables(spark, sf_dir, days)
    rec = IG.trends_records(IG.unpivot_interest(wide), F.lit(FETCHED_AT))
    return rec.select("platform", "id", F.col("snippet.title").alias("title"), F.col("snippet.description").alias("description"),
                      F.col("snippet.channelId").alias("channelId"), F.col("snippet.channelTitle").alias("channelTitle"),
                      F.col("snippet.publishedAt").alias("publishedAt"), F.col("statistics.viewCount").alias("viewCount"),
                      F.col("statistics.likeCount").alias("likeCount"), F.col("statistics.commentCount").alias("commentCount"),
                      "_fetched_at")


# ---------------------------------------------------------------- file sources and sinks (round trips)

from ..schemas import TOPICS_HOURLY, TOPICS_HOURLY_COLS  # noqa: E402
from ..session import scratch_path  # noqa: E402
from .. import sinks  # noqa: E402
from ..sinks import bronze_json_lines, write_csv  # noqa: E402
from ..sources.bronze import read_bronze, usable  # noqa: E402
from ..sources.csv import csv_diagnostics, read_channels, read_csv_tolerant, tolerant_rows  # noqa: E402

DUMP_STAMP = "20240131T000000Z"


_BAD_JSON = '{"id": "vidBROKEN", "snippet": {"title": "unterminated'


@query("json_union_sources", S.with_(S.BRONZE_FLAT, "SELECT " + ", ".join(
    _r(c) + " AS " + c if c in ("views", "likes", "comments") else c for c in _FLAT_COLS) + " FROM flat"))
def q_json_union_sources(spark, sf_dir):
    lines = bronze_json_lines(PL.bronze(spark, sf_dir))
    root = scratch_path(spark, "bronze_jsonl")
    bad = spark.createDataFrame([(_BAD_JSON,)], "value string")
    is_trends = F.coalesce(F.col("platform") == "Trends", F.lit(False))
    lines.where(~is_trends).select("value").unionByName(bad).write.text(f"{root}/youtube_raw_{DUMP_STAMP}", compression="gzip")
    lines.where(is_trends).select("value").unionByName(bad).write.text(f"{root}/trends_raw_{DUMP_STAMP}", compression="gzip")
    got = read_bronze(spark, root)
    return PL.rounded(clean.flatten(usable(got)).select(*_FLAT_COLS))


_CSV_EXTRA = [
    ",".join(TOPICS_HOURLY_COLS),
    ",".join(TOPICS_HOURLY_COLS),
    "2024-02-01T00:00:00.000Z,99,short row",
    "2024-02-01T01:00:00.000Z,98,too,many,fields,1,2,3,4,5,6,7,8,9",
    '2024-02-01T02:00:00.000Z,97,"two\nlines, ""quoted""",,1.5,2,1,0.25,0,5.0,sample',
    "2024-02-01T03:00:00.000Z,96,one field too many and empty,,1.5,2,1,0.25,0,5.0,sample,",
    "2024-02-01T03:00:00.000Z,95,two too many,,1.5,2,1,0.25,0,5.0,sample,,5",
]
# An older file: other order, spaces in the header, a column missing, one that is unknown.
_CSV_OLDER = [
    "topic_id, velocity_sum ,unknown,ts_hour,sample_title",
    "94,2.5,?,2024-02-01T04:00:00.000Z,older",
    "93,,?,2024-02-01T05:00:00.000Z",
]

_CSV_SQL = S.with_(S.GOLD, "SELECT ts_hour, topic_id, nullif(topic_label, '') AS topic_label, "
                   "nullif(leader_channels, '') AS leader_channels, " + _r("velocity_sum") +
                   " AS velocity_sum, video_count, channel_count, " + _r("zscore") +
                   " AS zscore, rising_flag, rising_score, nullif(sample_title, '') AS sample_title FROM topics_hourly "
                   "UNION ALL SELECT TIMESTAMP '2024-02-01 00:00:00', 99, 'short row', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL "
                   "UNION ALL SELECT TIMESTAMP '2024-02-01 02:00:00', 97, 'two' || chr(10) || 'lines, \"quoted\"', NULL, 1.5, 2, 1, "
                   "0.25, 0, 5.0, 'sample' "
                   "UNION ALL SELECT TIMESTAMP '2024-02-01 04:00:00', 94, NULL, NULL, 2.5, NULL, NULL, NULL, NULL, NULL, 'older' "
                   "UNION ALL SELECT TIMESTAMP '2024-02-01 05:00:00', 93, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL")


def _messy_csv(spark, sf_dir):
    root = write_csv(PL.topics_hourly(spark, sf_dir), scratch_path(spark, "topics_hourly_csv"), compression="gzip")
    for extra in (_CSV_EXTRA, _CSV_OLDER):
        spark.createDataFrame([("\n".join(extra),)], "value string").write.mode("append").text(root)
    return read_csv_tolerant(spark, root, TOPICS_HOURLY, multiline=True)


@query("csv_tolerant_roundtrip", _CSV_SQL)
def q_csv_tolerant_roundtrip(spark, sf_dir):
    return PL.rounded(tolerant_rows(_messy_csv(spark, sf_dir)))


@query("csv_skipped_counts", S.with_(S.GOLD, "SELECT count(*) + 4 AS rows, 3 AS skipped FROM topics_hourly"))
def q_csv_skipped_counts(spark, sf_dir):
    """Kept and skipped records over all files (SRC-11)."""
    return csv_diagnostics(_messy_csv(spark, sf_dir)).agg(F.sum("rows").alias("rows"), F.sum("skipped").alias("skipped"))


@query("csv_repaired", _CSV_SQL)
def q_csv_repaired(spark, sf_dir):
    """A tolerant read saved as clean CSV in a new folder, and read again (SNK-6)."""
    saved = sinks.repair_and_save(tolerant_rows(_messy_csv(spark, sf_dir)), scratch_path(spark, "repaired"), "gzip")
    return PL.rounded(tolerant_rows(read_csv_tolerant(spark, saved, TOPICS_HOURLY, multiline=True)))


@query("channels_roundtrip", "SELECT CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS name, 'UC' || CAST(c_custkey AS VARCHAR) AS channel_id FROM customer")
def q_channels_roundtrip(spark, sf_dir):
    """A channel file with blanks around names, ids and headers, and rows without a name, in one CSV file (SRC-3, SNK-4)."""
    c = _table(spark, sf_dir, "customer")
    messy = c.select(F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("  "), "c_name", F.lit(" "))).alias(" name"),
                     F.concat(F.lit(" UC"), F.col("c_custkey").cast("string"), F.lit(" ")).alias("channel_id "))
    return read_channels(spark, write_csv(messy, scratch_path(spark, "channels"), single_file=True))


@query("jsonl_dump_roundtrip", S.with_(S.GOLD, "SELECT videoId, channelTitle, title_clean, topic_id FROM videos_with_topics"))
def q_jsonl_dump_roundtrip(spark, sf_dir):
    """A timestamped JSON-lines dump, read again (SNK-1)."""
    vt = PL.videos_with_topics(spark, sf_dir).select("videoId", "channelTitle", "title_clean", "topic_id")
    path = sinks.write_jsonl(vt, scratch_path(spark, "dump"), "videos", _dt.datetime(2024, 1, 31, tzinfo=_dt.timezone.utc), "gzip")
    return spark.read.schema(vt.schema).json(path)


@query("views_export", _top_sql("SELECT topic_id, " + _r("rising_score") + " AS rising_score, video_count, sample_title FROM top"))
def q_views_export(spark, sf_dir):
    """The top list written as CSV, and read again (SNK-7)."""
    _, _, sub = _main(spark, sf_dir)
    paths = V.export({"top_topics": V.top_topics(sub)}, scratch_path(spark, "export"))
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(paths["top_topics"])
    return PL.rounded(back.select(F.col("topic_id").cast("int"), F.col("rising_score").cast("double"), F.col("video_count").cast("long"), "sample_title"))


_MANIFEST_SPLIT = "20240116"


@query("manifest_runs", _MANIFEST_SQL.replace("SELECT 'youtube_raw_'", "SELECT CASE WHEN strftime(day, '%Y%m%d') < '" + _MANIFEST_SPLIT + "' THEN 'first' ELSE 'second' END AS run, 'youtube_raw_'"))
def q_manifest_runs(spark, sf_dir):
    """Run summaries by run; the first run is repeated after it left half of its rows (SNK-5)."""
    rows = q_ingest_manifest(spark, sf_dir)
    early = F.substring("file", 13, 8) < _MANIFEST_SPLIT
    path = scratch_path(spark, "manifest")
    for part, run in ((rows.where(early & (F.col("records") % 2 == 0)), "first"), (rows.where(~early), "second"), (rows.where(early), "first")):
        sinks.append_manifest(part, path, run)
    back = spark.read.option("header", True).csv(path)
    return back.select("run", "file", F.col("records").cast("long"), F.col("channels").cast("long"), "published_after", "fetched_at")


@query("gold_normalized", S.with_(S.GOLD, "SELECT ts_hour, topic_id, sample_title AS topic_label, leader_channels, rising_score, "
       "(SELECT count(*) FROM videos_with_topics) AS youtube_videos FROM topics_hourly"))
def q_gold_normalized(spark, sf_dir):
    """Gold of an older layout: labels, leaders, scores and platforms are derived (PRJ-10, JN-11)."""
    th, vt = _gold(spark, sf_dir)
    th, vt = V.normalize_gold(th.drop("topic_label", "leader_channels", "rising_score"), vt.drop("platform"))
    return th.select("ts_hour", "topic_id", "topic_label", "leader_channels", "rising_score",
                     vt.where("platform = 'youtube'").agg(F.count("*")).scalar().alias("youtube_videos"))


@query("silver_valid_times", S.with_(S.SILVER, "SELECT platform, videoId FROM ded WHERE seq % 5 <> 0 AND seq % 7 <> 0"))
def q_silver_valid_times(spark, sf_dir):
    """Rows without a readable time leave before topics are built (FLT-2)."""
    s = PL.silver_pre(spark, sf_dir)
    gaps = s.withColumns({"publishedAt": F.when(F.col("_seq") % 5 != 0, F.col("publishedAt")), "fetchedAt": F.when(F.col("_seq") % 7 != 0, F.col("fetchedAt"))})
    return clean.valid_times(gaps).select("platform", "videoId")


# ---------------------------------------------------------------- the file job on messy records

_MESSY_SQL = (S.BRONZE_FLAT.replace("flat AS (", "flat_in AS (") + """,
flat AS (SELECT * REPLACE (CASE WHEN seq % 17 <> 0 THEN views + 1 END AS views, CASE WHEN seq % 17 <> 0 THEN likes END AS likes,
                           CASE WHEN seq % 17 <> 0 THEN comments END AS comments,
                           CASE WHEN seq % 19 <> 0 AND seq % 29 <> 0 THEN duration_sec END AS duration_sec,
                           CASE WHEN seq % 23 <> 0 OR seq % 50 NOT IN (0, 25) THEN title END AS title) FROM flat_in)"""
              + S.SILVER[len(S.BRONZE_FLAT):])


def _messy_lines(bronze):
    """Every record twice in a row with the same stamp (the second is the later one), some with fields of a wrong type."""
    seq = F.col("_seq")
    # records are put in order before they are doubled and formatted: half the rows to exchange, and no JSON
    b = bronze.repartitionByRange("_seq").sortWithinPartitions("_seq").withColumn("_again", F.explode(F.array(F.lit(0), F.lit(1))))
    b = b.withColumns({
        "statistics": F.col("statistics").withField("viewCount", (F.col("statistics.viewCount").cast("double") + F.col("_again")).cast("string")),
        "snippet": F.col("snippet").withField("localized", F.when(seq % 23 != 0, F.col("snippet.localized"))),
        "contentDetails": F.col("contentDetails").withField("duration", F.when(seq % 29 == 0, F.lit("P99999999999999999D"))
                                                            .otherwise(F.col("contentDetails.duration")))})
    line = F.col("value")
    line = F.when(seq % 17 == 0, F.regexp_replace(line, r'"statistics":\{[^}]*\}', '"statistics":"n/a"')).otherwise(line)
    line = F.when(seq % 19 == 0, F.regexp_replace(line, r'"contentDetails":\{[^}]*\}', '"contentDetails":"x"')).otherwise(line)
    line = F.when(seq % 23 == 0, F.regexp_replace(line, r'"snippet":\{', '"snippet":{"localized":"x",')).otherwise(line)
    return bronze_json_lines(b, keep=["_seq", "_again"]).withColumn("value", line)


@query("clean_job_messy", S.with_(_MESSY_SQL, "SELECT platform, videoId, title_clean, duration_sec, fetchedAt, " + ", ".join(
    _r(c) + " AS " + c for c in ("views", "likes", "views_per_min", "decayed_velocity")) + " FROM silver"))
def q_clean_job_messy(spark, sf_dir):
    """The file job over records that repeat a stamp, hold wrong types and a duration beyond 64 bits."""
    from .jobs import clean_job
    root = scratch_path(spark, "messy")
    lines = _messy_lines(PL.bronze(spark, sf_dir))
    trends = F.coalesce(F.col("platform") == "Trends", F.lit(False))
    lines.where(~trends).select("value").write.text(f"{root}/bronze/youtube_raw_{DUMP_STAMP}", compression="gzip")
    lines.where(trends).select("value").write.text(f"{root}/bronze/trends_raw_{DUMP_STAMP}", compression="gzip")
    silver = clean_job(spark, f"{root}/bronze", f"{root}/silver")
    return PL.rounded(silver.select("platform", "videoId", "title_clean", "duration_sec", "fetchedAt", "views", "likes",
                                    "views_per_min", "decayed_velocity"))


# ---------------------------------------------------------------- streaming (file source, availableNow runs)

from pyspark.sql import types as _T  # noqa: E402

from ..schemas import BRONZE  # noqa: E402
from ..streaming import stream as ST  # noqa: E402

STREAM_SPLIT = "2024-01-16 00:00:00"      # run 1 sees files before this day, run 2 the rest
STREAM_SCHEMA = _T.StructType(list(BRONZE.fields) + [_T.StructField("topic_id", _T.IntegerType()),
                                                     _T.StructField("_seq", _T.LongType())])


def _stream_input(spark, sf_dir, stage: int, root: str | None = None) -> str:
    """Write the bronze of one stage as JSONL files into the input folder."""
    root = root or scratch_path(spark, "stream_in")
    split = F.lit(STREAM_SPLIT).cast("timestamp")
    part = FX.bronze_from_tables(spark, sf_dir, F.col("ts") < split if stage == 1 else F.col("ts") >= split)
    bronze_json_lines(part, extra=["topic_id", "_seq"]).select("value").write.mode("append").text(root, compression="gzip")
    return root


_FLAT_KEYED = S.BRONZE_FLAT + r""",
keyed AS (SELECT * REPLACE (least(publishedAt, fetchedAt) AS publishedAt) FROM flat
          WHERE videoId IS NOT NULL AND publishedAt IS NOT NULL AND fetchedAt IS NOT NULL)"""

# An hour's caps come from the hours before it, by the buckets of operators/sketch.py.
_RATES_SQL = {"views_per_min": "views", "likes_per_min": "likes", "comments_per_min": "comments"}
_LN = repr(math.log(SK.GAMMA))
_HOURLY = _FLAT_KEYED + r""",
latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
             PARTITION BY date_trunc('hour', fetchedAt), platform, videoId ORDER BY fetchedAt DESC, seq DESC) AS rn FROM keyed) WHERE rn = 1),
aged AS (SELECT *, date_trunc('hour', fetchedAt) AS ts_hour, greatest((epoch_us(fetchedAt) - epoch_us(publishedAt)) / 60000000.0, 0.0001) AS age_min FROM latest),
rated AS (""" + " UNION ALL ".join(
    f"SELECT ts_hour, '{c}' AS name, coalesce({v}, 0.0) / age_min AS x FROM aged" for c, v in _RATES_SQL.items()) + r"""),
counted AS (SELECT ts_hour, name, CASE WHEN x <= 0 THEN """ + str(SK.LOW) + r""" ELSE CAST(ceil(ln(x) / """ + _LN + r""") AS INTEGER) END AS bucket, count(*) AS n
            FROM rated WHERE isfinite(x) GROUP BY ALL),
hs AS (SELECT DISTINCT ts_hour, name FROM rated),
past AS (SELECT h.ts_hour, name, bucket, sum(n) AS n FROM hs h JOIN counted c USING (name) WHERE c.ts_hour < h.ts_hour GROUP BY h.ts_hour, name, bucket),
upto AS (SELECT *, sum(n) OVER (PARTITION BY ts_hour, name ORDER BY bucket) AS c, sum(n) OVER (PARTITION BY ts_hour, name) AS total FROM past),
found AS (SELECT ts_hour, name, min(bucket) AS bucket, any_value(total) AS n FROM upto WHERE c * 1000 >= total * 999 GROUP BY ts_hour, name),
caps AS (SELECT h.ts_hour, h.name, f.bucket, CAST(coalesce(f.n, 0) AS BIGINT) AS n, CASE WHEN f.bucket = """ + str(SK.LOW) + r""" THEN 0.0
         ELSE pow(""" + repr(SK.GAMMA) + r""", f.bucket) * (2.0 / (""" + repr(SK.GAMMA) + r""" + 1.0)) END AS cap FROM hs h LEFT JOIN found f USING (ts_hour, name)),
clipped AS (SELECT a.*, coalesce(views, 0.0) / age_min AS raw, cap FROM aged a JOIN caps c ON a.ts_hour = c.ts_hour AND c.name = 'views_per_min'),
hourly AS (SELECT ts_hour, topic_id, sum(CASE WHEN cap > 0 THEN least(greatest(raw, 0.0), cap) ELSE raw END * exp(-age_min / 120.0)) AS velocity_sum,
                  count(*) AS video_count, count(DISTINCT channelId) AS channel_count FROM clipped GROUP BY ALL)"""


def _hourly_table(spark, sf_dir) -> str:
    """Folder of the hourly stream (two intakes, then a closing run); built once per session."""
    key = PL._key(spark, sf_dir, "stream_hourly")
    with PL._lock:
        if key not in PL._written:
            src = _stream_input(spark, sf_dir, 1)
            table, ckpt = scratch_path(spark, "stream_hourly"), scratch_path(spark, "ckpt_hourly")
            run = lambda: ST.run_hourly(ST.hourly_videos(
                ST.flat_stream(ST.bronze_stream(spark, src, STREAM_SCHEMA), keep=["topic_id", "_seq"], delay="2 hours"),
                order=["_seq"]), table, ckpt)
            run()
            _stream_input(spark, sf_dir, 2, src)
            run()
            spark.createDataFrame([(ST.closing_record(),)], "value string").write.mode("append").text(src)
            run()
            PL._written[key] = table
    return PL._written[key]


@query("stream_hourly", S.with_(_HOURLY, "SELECT ts_hour, topic_id, " + _r("velocity_sum") + " AS velocity_sum, video_count, channel_count FROM hourly"))
def q_stream_hourly(spark, sf_dir):
    return PL.rounded(ST.closed_hours(spark, _hourly_table(spark, sf_dir)))


@query("stream_rate_caps", S.with_(_HOURLY, "SELECT name, ts_hour, bucket, n, " + _r("cap") + " AS cap FROM caps"))
def q_stream_rate_caps(spark, sf_dir):
    """Each rate's cap for each closed hour, from the merged sketches of the hours before (STM-4, AGG-13)."""
    return PL.rounded(ST.hourly_caps(spark, _hourly_table(spark, sf_dir)))


def _stream_twice(spark, sf_dir, name: str, run) -> None:
    """``run(flat stream, checkpoint)`` over a first intake, then over a second one from the same checkpoint."""
    src, ckpt = _stream_input(spark, sf_dir, 1), scratch_path(spark, f"ckpt_{name}")
    flat = lambda: ST.flat_stream(ST.bronze_stream(spark, src, STREAM_SCHEMA), keep=["topic_id", "_seq"])
    run(flat(), ckpt)
    _stream_input(spark, sf_dir, 2, src)
    run(flat(), ckpt)


def _flat_schema(spark) -> _T.StructType:
    return ST.flat_stream(spark.createDataFrame([], STREAM_SCHEMA), keep=["topic_id", "_seq"]).schema


@query("stream_dedup", S.with_(_FLAT_KEYED, "SELECT platform, videoId, fetchedAt, seq AS _seq FROM keyed QUALIFY row_number() OVER ("
                                            f"PARTITION BY platform, videoId ORDER BY fetchedAt >= TIMESTAMP '{STREAM_SPLIT}', fetchedAt, seq) = 1"))
def q_stream_dedup(spark, sf_dir):
    """The first snapshot ever of each video, over two intakes."""
    table = scratch_path(spark, "stream_first_seen")
    _stream_twice(spark, sf_dir, "first_seen", lambda flat, ckpt: ST.run_first_seen(flat, table, ckpt, order=["_seq"]))
    return ST.seen_first(spark, table, _flat_schema(spark)).select("platform", "videoId", "fetchedAt", "_seq")


@query("stream_upsert", S.with_(S.SILVER, "SELECT platform, videoId, fetchedAt, seq AS _seq FROM ded"))
def q_stream_upsert(spark, sf_dir):
    """The latest snapshot of each video: a compacted table and the batches since."""
    table, base, schema = scratch_path(spark, "stream_snapshot"), scratch_path(spark, "stream_compacted"), _flat_schema(spark)

    def run(flat, ckpt):
        ST.upsert_latest(flat, table, ckpt, order=["_seq"])
        if ST.rows(spark, base, schema).isEmpty():
            ST.compact(spark, table, base, schema, order=["_seq"])
    _stream_twice(spark, sf_dir, "upsert", run)
    return ST.read_snapshot(spark, [base, table], schema, order=["_seq"]).select("platform", "videoId", "fetchedAt", "_seq")


TOPICS_PER_PART = 8


@query("stream_baseline", S.with_(_HOURLY + r""",
zb AS (SELECT *, (velocity_sum - coalesce(avg(velocity_sum) OVER w, 0.0)) /
                 (CASE WHEN stddev_samp(velocity_sum) OVER w IS NULL OR stddev_samp(velocity_sum) OVER w = 0
                       THEN 1.0 ELSE stddev_samp(velocity_sum) OVER w END) AS zscore
       FROM hourly WINDOW w AS (PARTITION BY topic_id ORDER BY ts_hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
    "SELECT ts_hour, topic_id, " + _r("velocity_sum") + " AS velocity_sum, " + _r("zscore") + " AS zscore FROM zb"))
def q_stream_baseline(spark, sf_dir):
    hourly = ST.closed_hours(spark, _hourly_table(spark, sf_dir))
    src, sink, ckpt = (scratch_path(spark, n) for n in ("baseline_in", "stream_baseline", "ckpt_baseline"))
    parts = -(-hourly.select("topic_id").distinct().count() // TOPICS_PER_PART)
    run = lambda: ST.run_available_now(ST.expanding_baseline_stream(
        spark.readStream.schema(hourly.schema).parquet(src)), sink, ckpt, partitions=max(1, parts))
    hourly.write.parquet(src)
    run()
    ST.hour_mark(spark, hourly.schema).write.mode("append").parquet(src)
    run()
    return PL.rounded(spark.read.parquet(sink).withColumnRenamed("value", "velocity_sum"))


# ---------------------------------------------------------------- the reference's full gold flow and run summary

_VT_TOPICS = S.VIDEOS + ",\nvk AS (SELECT *, platform || chr(1) || videoId AS vkey FROM vt),\n" + TQ.topics_sql(
    "vk", "vkey", "title_clean", TQ.topic_count_sql("(SELECT count(*) FROM vk)"), TM.MIN_DF, TM.NGRAM_MAX, False, 1.0,
    TM.SEED_ROUNDS, PL.KMEANS_ROUNDS) + """,
kv AS (SELECT vk.* EXCLUDE (topic_id), topics.topic_id FROM vk JOIN topics ON topics.key = vk.vkey)"""


@query("kmeans_topics_hourly", S.with_(_VT_TOPICS, "SELECT ts_hour, topic_id, " + _r("sum(decayed_velocity)") + " AS velocity_sum, "
       "count(DISTINCT videoId) AS video_count, count(DISTINCT channelId) AS channel_count FROM kv GROUP BY ts_hour, topic_id"))
def q_kmeans_topics_hourly(spark, sf_dir):
    """Silver titles → TF-IDF + k-means topics (their number by the rule) → gold, a row per topic and hour."""
    from ..operators import topics as TP
    videos = TP.with_hour(PL.silver_with_kmeans_topics(spark, sf_dir))
    gold = TP.topics_hourly(videos, texts=PL.texts(spark, sf_dir))
    return PL.rounded(gold.select("ts_hour", "topic_id", "velocity_sum", "video_count", "channel_count"))


@query("hashed_kmeans_topics", _kmeans_sql(min_df=1, ngram_max=1, stop_words=True, smooth=0.0))
def q_hashed_kmeans_topics(spark, sf_dir):
    """The variant on single words without stop words, weights ln((1 + n) / (1 + df)) (ML-3)."""
    return PL.rounded(TM.topics(_docs(spark, sf_dir), "doc_id", "text", KMEANS_TOPICS, 1, 1, stop_words=True, smooth=0.0, rounds=PL.KMEANS_ROUNDS))


@query("run_summary", S.with_(S.GOLD, "SELECT (SELECT count(DISTINCT topic_id) FROM topics_hourly) AS topics, (SELECT count(*) FROM silver) AS videos, "
                              + TQ.topic_count_sql("(SELECT count(*) FROM silver)") + " AS k"))
def q_run_summary(spark, sf_dir):
    """Topics and videos of a run, and the number of topics that the rule gives (AGG-15)."""
    th, s = PL.topics_hourly(spark, sf_dir), PL.silver_numbers(spark, sf_dir)
    n = s.count()
    return th.agg(F.count_distinct("topic_id").alias("topics"), F.lit(n).cast("long").alias("videos"), F.lit(TM.topic_count(n)).cast("long").alias("k"))


@query("topic_lang_videos", S.with_(S.GOLD, "SELECT topic_id, count(DISTINCT videoId) AS lang_vids FROM videos_with_topics "
                                            "WHERE lang IN ('en', 'es') GROUP BY topic_id"))
def q_topic_lang_videos(spark, sf_dir):
    """Distinct videos per topic in the selected languages (AGG-12)."""
    from ..operators.videosets import united
    some = PL.video_sets(spark, sf_dir).where(F.col("lang").isin("en", "es"))
    return united(some, "topic_id").select("topic_id", F.col("videos").alias("lang_vids"))
