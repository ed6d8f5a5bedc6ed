"""Registered queries of the ten operators over the driver tables, and their DuckDB SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import conversation_repair, line_dedup, near_dup, packing, pieces, quality, radix_dedup, seekable, suffix_dedup, topk
from . import secret_scan, substring_trees, whitening
from .common import prepare, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_dedup.passage_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_chunks", "n_removed_lines", F.sha2("text", 256).alias("kept_sha256"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = "piece_bpe_32k.model"
    ids = pieces.encode(table(spark, sf_dir, "documents"), path)
    return pieces.decode(ids, path).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), seekable.crc32_ids().alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs, ledger = table(spark, sf_dir, "documents"), scratch_path(spark, "ledger")
    secret_scan.scan_new(docs, ledger)
    found = secret_scan.findings(docs, ledger)
    count = lambda kind: F.size(F.filter("spans", lambda s: s.rule == kind)).cast("long")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(secret_scan.span_text(), 256).alias("base_sha256"),
                        secret_scan.span_text().alias("spans"))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dup.near_dup(table(spark, sf_dir, "documents")).drop("rid")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pieces, places = packing.pack_documents(table(spark, sf_dir, "documents"), "word_bpe_49k.json")
    return packed_rows(pieces, places)


def packed_rows(pieces: DataFrame, places: DataFrame) -> DataFrame:
    narrow = pieces.select("doc_id", "rid", "start", "length", seekable.crc32_ids().alias("ids_crc32"), "doc_tokens")
    return narrow.join(places, ["rid", "start"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return radix_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("rid")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    folder = scratch_path(spark, "token-files")
    index = seekable.write_token_files(table(spark, sf_dir, "documents"), folder, "byte_bpe_50k.json")
    read = seekable.read_token_files(index, folder).select(
        "doc_id", "shard", "at", "n_tokens", seekable.crc32_ids().alias("ids_crc32"))
    return seekable.starts(read, index).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select("doc_id", quality.held_out().alias("held_out"), quality.score(docs, model).alias("score")).withColumn(
        "predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows = conversation_repair.damaged(conversation_repair.rows_of(table(spark, sf_dir, "conversations")))
    return conversation_repair.summary(conversation_repair.repair(rows))


def op12_substring_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substring_trees.substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_secret_scans": op3_secret_scans,
    "op4_near_dup": op4_near_dup,
    "op5_exact_topk": op5_exact_topk,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_files": op8_token_files,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_substring_trees": op12_substring_trees,
    "op13_embedding_whitening": op13_embedding_whitening,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _secret_sql() -> str:
    kinds = []
    for k, r in enumerate(secret_scan.RULES):
        pattern = r.pattern.replace("'", "''")
        kinds.append(f"""SELECT doc_id, {k} AS kind, '{r.name}' AS name, {r.least} AS least,
            regexp_extract_all(t, '{pattern}', 0) AS whole, regexp_extract_all(t, '{pattern}', {r.group}) AS part,
            string_split_regex(t, '{pattern}') AS gaps FROM d WHERE regexp_matches(t, '{pattern}')""")
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(kinds)}),
e AS (SELECT doc_id, kind, name, least, unnest(whole) AS w, unnest(part) AS p, unnest(gaps[:len(whole)]) AS g,
      unnest(range(len(whole))) AS i FROM m),
s AS (SELECT *, sum(length(g) + length(w)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM e),
f AS (SELECT * FROM s WHERE length(p) >= least),
a AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
      count(*) FILTER (kind = 2) AS n_hex, string_agg(name || ':' || CAST(stop - length(w) AS BIGINT) || ':' || CAST(stop AS BIGINT), ','
      ORDER BY stop - length(w), kind) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""


# CRC-32 by its table, built in SQL; the key is ASCII.  Then the cheapest edits row by row, per state the least cost and audit.
_REPAIR_SQL = r"""WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8),
    lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS tab),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
d AS (SELECT k.*, xor(list_reduce([4294967295] || list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT)),
      lambda c, b: xor(c // 256, tab[xor(c % 256, b) + 1])), 4294967295) % 20 AS kind FROM k, crc),
e AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
      CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
      unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM d WHERE kind > 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64),
      md5(length(role) || ':' || role || text), copy) AS i FROM e),
f AS (SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '-' END AS init,
      regexp_replace(text, '[\x20\x09-\x0D]+\z', '') AS bare,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM o),
r AS (SELECT *, CASE WHEN bare = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM f),
ins(q, x, letters, lines) AS (VALUES
  (0, 0, '', ''), (0, 2, 'I', chr(10) || 'user:'), (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (1, 1, '', ''), (1, 2, 'I', chr(10) || 'user:'), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, '', ''), (2, 3, 'I', chr(10) || 'assistant:'), (2, 2, 'II', chr(10) || 'assistant:' || chr(10) || 'user:'),
  (3, 3, '', ''), (3, 2, 'I', chr(10) || 'user:'), (3, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
kept(init, x, nxt) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
turned(x, nxt, role) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
edit AS (SELECT q, letters || 'D' AS letters, lines, '-' AS act, x AS nxt, 2 * length(letters) + 3 AS cost, '*' AS init, '' AS role FROM ins
  UNION ALL SELECT q, letters || 'K', lines, 'K', nxt, 2 * length(letters), init, '' FROM ins JOIN kept USING (x)
  UNION ALL SELECT q, letters || 'R', lines, 'R', nxt, 2 * length(letters) + 2, '*', role FROM ins JOIN turned USING (x)),
path AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS lines FROM r WHERE i = 1
  UNION ALL SELECT conv_id, i, q, cost, audit, lines FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS best FROM (
    SELECT p.conv_id, r.i, edit.nxt AS q, p.cost + edit.cost + CASE WHEN r.fault = 3 AND act <> '-' THEN 1 ELSE 0 END AS cost,
           p.audit || edit.letters AS audit, p.lines || edit.lines || CASE act WHEN '-' THEN '' WHEN 'K' THEN chr(10) || r.role || ':' || r.text
             ELSE chr(10) || edit.role || ':' || r.text END AS lines
    FROM path p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
    JOIN edit ON edit.q = p.q AND (edit.init = '*' OR edit.init = r.init) AND (act = '-' OR r.fault IN (0, 3)))) WHERE best = 1),
c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
      count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated FROM r GROUP BY conv_id),
g AS (SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT conv_id,
      lag(init) OVER (PARTITION BY conv_id ORDER BY i) || init AS pair FROM r) GROUP BY conv_id),
z(q, more, letters, lines) AS (VALUES (0, 0, '', ''), (1, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
  (2, 2, 'I', chr(10) || 'assistant:'), (3, 0, '', '')),
b AS (SELECT p.conv_id, cost + more AS cost, audit || letters AS audit, p.lines || z.lines AS lines
      FROM path p JOIN c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i JOIN z USING (q)
      QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY cost + more, audit || letters) = 1),
a AS (SELECT DISTINCT conv_id FROM conversations)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(substr(lines, 2), '')) AS repaired_sha256
FROM a LEFT JOIN c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN g ON a.conv_id IS NOT DISTINCT FROM g.conv_id
LEFT JOIN b ON a.conv_id IS NOT DISTINCT FROM b.conv_id"""


_WINDOW_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, -9223372036854775808) AS o,
  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT r, o, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) > 12),
p AS (SELECT r, o, i, array_to_string(w[i:i + 12], ' ') AS words FROM s),
f AS (SELECT words, min(o) AS least FROM p GROUP BY words HAVING min(o) < max(o)),
g AS (SELECT r, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM p JOIN f USING (words) WHERE o > least GROUP BY r),
k AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g USING (r))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN len(gone) = 0 THEN w WHEN len(gone) = len(w) THEN []
         ELSE list_where(w, list_transform(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i))) END, ' '), '')) AS kept_sha256 FROM k"""


ORACLE = {
    "op12_substring_trees": _WINDOW_SQL,
    "op11_conversation_repair": _REPAIR_SQL,
    "op5_exact_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op3_secret_scans": _secret_sql(),
    "op7_exact_dedup": f"""WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM n""",
}
