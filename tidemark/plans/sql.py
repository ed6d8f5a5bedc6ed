"""ANSI SQL (DuckDB dialect) mirror of the pipeline, used as the oracle.

The fragments are CTE bodies composed by ``plans.registry``; each query's
SQL is self-contained over the driver's registered views.
"""
from __future__ import annotations

# Fixed values, mirrored from functions/text.py for RE2: Unicode White_Space
# plus U+001C..U+001F; the word class; the label rule constants.
WS_RE2 = r"[\t\n\x0b\f\r \x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
WORD_RE2 = r"[\p{L}\p{M}\p{N}]+"


def clean_ws(expr: str) -> str:
    return f"trim(regexp_replace(coalesce({expr}, ''), '{WS_RE2}', ' ', 'g'))"


BRONZE_FLAT = r"""
nd AS (SELECT count(*) AS n FROM documents),
nvid AS (SELECT greatest(1, CAST(floor(count(*) * 2 / 5) AS BIGINT)) AS nv FROM events),
b0 AS (
  SELECT e.event_id AS seq, e.event_type, e.user_id, e.value, CAST(e.ts AS TIMESTAMP) AS ts,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k, d.text, d.lang AS dlang, d.source, nvid.nv
  FROM events e CROSS JOIN nd CROSS JOIN nvid JOIN documents d ON d.doc_id = e.event_id % nd.n),
flat AS (
  SELECT seq,
    CASE WHEN event_type = 'signup' THEN 'trends' ELSE 'youtube' END AS platform,
    CASE WHEN seq % 331 = 0 THEN NULL ELSE 'vid' || lpad(CAST(seq % nv AS VARCHAR), CAST(greatest(8, length(CAST(seq % nv AS VARCHAR))) AS INTEGER), '0') END AS videoId,
    coalesce(nullif(CASE WHEN seq % 50 = 0 THEN NULL WHEN seq % 50 = 25 THEN '' ELSE text END, ''),
             CASE WHEN seq % 4 < 2 THEN source || ' ' || text END) AS title,
    'Interest in ' || source AS description,
    'UC' || CAST(user_id AS VARCHAR) AS channelId,
    CASE WHEN seq % 61 = 0 THEN NULL ELSE 'Channel ' || CAST(user_id AS VARCHAR) END AS channelTitle,
    CASE WHEN seq % 211 = 0 THEN NULL
         WHEN seq % 1009 = 0 THEN ts + INTERVAL 3 MINUTE
         ELSE ts - (k + 1) * INTERVAL 1 MINUTE END AS publishedAt,
    CASE WHEN seq % 97 = 0 THEN NULL ELSE ts END AS fetchedAt,
    value * 100 AS views,
    CASE WHEN seq % 13 = 0 THEN NULL ELSE value END AS likes,
    CASE WHEN seq % 10 = 0 THEN NULL ELSE value / 10 END AS comments,
    CAST(CASE k % 5 WHEN 0 THEN k * 60 + k % 60 WHEN 1 THEN (k % 3) * 86400 + (k % 24) * 3600
                    WHEN 2 THEN 0 WHEN 3 THEN k ELSE NULL END AS BIGINT) AS duration_sec,
    dlang AS lang,
    CAST(k % 24 AS INTEGER) AS topic_id
  FROM b0)"""

SILVER = BRONZE_FLAT + r""",
keyed AS (
  SELECT * REPLACE (least(publishedAt, fetchedAt) AS publishedAt) FROM flat
  WHERE videoId IS NOT NULL AND publishedAt IS NOT NULL AND fetchedAt IS NOT NULL),
ded AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY platform, videoId ORDER BY fetchedAt DESC, seq DESC) AS rn FROM keyed)
  WHERE rn = 1),
pre AS (
  SELECT * REPLACE (coalesce(views, 0.0) AS views, coalesce(likes, 0.0) AS likes, coalesce(comments, 0.0) AS comments),
    """ + clean_ws("title") + r""" AS title_clean,
    greatest((epoch_us(fetchedAt) - epoch_us(publishedAt)) / 60000000.0, 0.0001) AS age_min
  FROM ded),
pre2 AS (
  SELECT *, views / age_min AS vpm, likes / age_min AS lpm, comments / age_min AS cpm FROM pre),
caps AS (
  SELECT quantile_cont(vpm, 0.999) AS hv, quantile_cont(lpm, 0.999) AS hl, quantile_cont(cpm, 0.999) AS hc FROM pre2),
silver AS (
  SELECT p.platform, p.videoId, p.channelId, p.channelTitle, p.title, p.title_clean, p.description, p.lang,
         p.duration_sec, p.publishedAt, p.fetchedAt, p.views, p.likes, p.comments, p.age_min,
         CASE WHEN c.hv > 0 THEN least(greatest(p.vpm, 0), c.hv) ELSE p.vpm END AS views_per_min,
         CASE WHEN c.hl > 0 THEN least(greatest(p.lpm, 0), c.hl) ELSE p.lpm END AS likes_per_min,
         CASE WHEN c.hc > 0 THEN least(greatest(p.cpm, 0), c.hc) ELSE p.cpm END AS comments_per_min,
         CASE WHEN c.hv > 0 THEN least(greatest(p.vpm, 0), c.hv) ELSE p.vpm END * exp(-p.age_min / 120.0) AS decayed_velocity,
         p.topic_id
  FROM pre2 p CROSS JOIN caps c)"""

VIDEOS = SILVER + r""",
vt AS (SELECT *, date_trunc('hour', fetchedAt) AS ts_hour FROM silver)"""


def readable_label_sql(lbl: str, samp: str) -> str:
    parts = f"list_filter(string_split(trim(regexp_replace(coalesce({lbl}, ''), '{WS_RE2}', ' ', 'g')), ' '), lambda p: p <> '')"
    short = f"len(list_filter({parts}, lambda p: length(p) <= 1))"
    return (f"CASE WHEN len({parts}) = 0 OR {short} * 1.0 / len({parts}) > 0.4 "
            f"THEN CASE WHEN coalesce({samp}, '') <> '' THEN {samp} ELSE coalesce({lbl}, '') END "
            f"ELSE coalesce({lbl}, '') END")


def labels_cte(src: str, key: str = "topic_id", text: str = "title_clean", order: str = "platform, videoId",
               name: str = "labels", top: int = 3, nfc: bool = True) -> str:
    norm = f"nfc_normalize({text})" if nfc else text
    return f""",
{name}_d AS (
  SELECT {key}, doc, regexp_extract_all({norm}, '{WORD_RE2}') AS w FROM (
    SELECT {key}, {text}, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS doc
    FROM {src} WHERE {text} IS NOT NULL AND {text} <> '')),
{name}_u AS (SELECT {key}, doc, unnest(generate_series(1, len(w))) AS pos, w FROM {name}_d),
{name}_b AS (SELECT {key}, doc, unnest(generate_series(1, len(w) - 1)) AS pos, w FROM {name}_d),
{name}_g AS (
  SELECT {key}, 1 AS kind, doc, pos, w[pos] AS gram FROM {name}_u
  UNION ALL SELECT {key}, 2 AS kind, doc, pos, w[pos] || ' ' || w[pos + 1] AS gram FROM {name}_b),
{name}_c AS (SELECT {key}, kind, gram, count(*) AS cnt, min(doc * 1000000000 + pos) AS first
             FROM {name}_g GROUP BY {key}, kind, gram),
{name}_k AS (SELECT {key}, max(kind) AS kind FROM {name}_c GROUP BY {key}),
{name}_t AS (SELECT c.*, row_number() OVER (PARTITION BY c.{key} ORDER BY cnt DESC, first) AS rn
             FROM {name}_c c JOIN {name}_k k ON c.{key} = k.{key} AND c.kind = k.kind),
{name} AS (
  SELECT t.{key}, coalesce(string_agg(g.gram, ', ' ORDER BY g.rn), '') AS topic_label
  FROM (SELECT DISTINCT {key} FROM {src}) t LEFT JOIN {name}_t g ON g.{key} = t.{key} AND g.rn <= {top}
  GROUP BY t.{key})"""


GOLD = VIDEOS + labels_cte("vt") + r""",
agg AS (
  SELECT ts_hour, topic_id, sum(decayed_velocity) AS velocity_sum,
         count(DISTINCT videoId) AS video_count, count(DISTINCT channelId) AS channel_count,
         arg_max(title_clean, {'p': platform, 'v': videoId}) FILTER (WHERE title_clean <> '') AS sample_title
  FROM vt GROUP BY ts_hour, topic_id),
cw AS (SELECT ts_hour, topic_id, channelTitle, sum(decayed_velocity) AS weight
       FROM vt WHERE channelTitle IS NOT NULL GROUP BY ts_hour, topic_id, channelTitle),
lr AS (SELECT *, row_number() OVER (PARTITION BY ts_hour, topic_id ORDER BY weight DESC, channelTitle) AS rn FROM cw),
leaders AS (SELECT ts_hour, topic_id, string_agg(channelTitle, ', ' ORDER BY channelTitle) AS leader_channels
            FROM lr WHERE rn <= 3 GROUP BY ts_hour, topic_id),
th0 AS (
  SELECT a.ts_hour, a.topic_id, """ + readable_label_sql("l.topic_label", "a.sample_title") + r""" AS topic_label,
         ld.leader_channels, a.velocity_sum, a.video_count, a.channel_count, a.sample_title
  FROM agg a LEFT JOIN leaders ld ON a.ts_hour = ld.ts_hour AND a.topic_id = ld.topic_id
             LEFT JOIN labels l ON a.topic_id = l.topic_id),
th1 AS (
  SELECT *, (velocity_sum - coalesce(avg(velocity_sum) OVER w, 0.0)) /
            (CASE WHEN stddev_samp(velocity_sum) OVER w IS NULL OR stddev_samp(velocity_sum) OVER w = 0
                  THEN 1.0 ELSE stddev_samp(velocity_sum) OVER w END) AS zscore
  FROM th0 WINDOW w AS (PARTITION BY topic_id ORDER BY ts_hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
topics_hourly AS (
  SELECT ts_hour, topic_id, topic_label, leader_channels, velocity_sum, video_count, channel_count, zscore,
         CAST(zscore >= 2.0 AS INTEGER) AS rising_flag,
         roundbankers(least(greatest(zscore, 0.0), 5.0) / 5.0 * 100.0 * 10.0, 0) / 10.0 AS rising_score,
         sample_title
  FROM th1),
videos_with_topics AS (
  SELECT videoId, channelId, channelTitle, title_clean, lang, decayed_velocity, ts_hour, topic_id, platform FROM vt)"""


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip().lstrip(",") + "\n" + body
