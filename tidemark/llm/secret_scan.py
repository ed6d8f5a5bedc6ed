"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of a text is addressed by its content (SHA-256).  The ledger is
one Parquet table of the pairs (blob, rule, rule version) that have been scanned, each with
its spans, empty or not.  A scan lists the pairs of its input that the ledger lacks,
brings one copy of each such text to the rules, appends the pairs in one committed
write, and joins the ledger back to every path that holds the blob.  A second run
over the same texts scans nothing; a rule with a new version is the only one that runs again.

Spans come from two native functions: ``regexp_extract_all`` gives the matches of a
rule and ``split`` the gaps between them, so the running sum of both lengths is
each match's place in code points.  That sum is a window over the matches of one
blob and rule, never over more.
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage, texts

LEDGER = "blob binary, rule string, version int, spans array<struct<start:long,end:long>>"


class Rule(NamedTuple):
    """A match counts if its last ``group`` (0: all of it) has ``least`` code points or more."""
    name: str
    version: int
    pattern: str
    group: int
    least: int


def either_case(word: str) -> str:
    """A pattern for an ASCII word with letters in either case (no Unicode folding)."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


SECRET_WORDS = ("password", "passwd", "secret", "token", "api_?key")
# Built-in rules, in the order in which equal starts are listed.
RULES = (
    Rule("assign", 1, "(" + "|".join(map(either_case, SECRET_WORDS))
         + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, "[0-9a-f]+", 0, 24),
)


def _hits(rule: Rule, text):
    """Per match its gap before, its length and whether it counts; null when nothing matches (no text is split then)."""
    pattern = F.lit(rule.pattern)
    # A quick test first: most texts have no match that counts.
    quick = rule.pattern if rule.group else f"{rule.pattern.removesuffix('+')}{{{_rest(rule)},}}"
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    gaps = F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(whole))
    return F.when(text.rlike(quick), F.arrays_zip(
        F.transform(gaps, F.char_length).alias("gap"),
        F.transform(whole, F.char_length).alias("len"),
        F.transform(part, lambda v: F.char_length(v) >= rule.least).alias("ok")))


def _rest(rule: Rule) -> int:
    """Repeats of the last class that make ``least`` code points (the pattern's head is literal)."""
    head = rule.pattern[:rule.pattern.index("[")]
    return rule.least - len(head)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's pairs; empty where nothing has been written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def address(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, rid, blob``: the content address of every path's text."""
    return texts(docs, id_col, text_col).select("doc_id", "rid", F.unhex(F.sha2("text", 256)).alias("blob"))


def scan_new(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
             text_col: str = "text") -> int:
    """Scan what the ledger lacks and append it; returns the number of (blob, rule, version) pairs scanned."""
    spark = docs.sparkSession
    known = read_ledger(spark, ledger)
    pairs = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules]))
    unseen = stage(address(docs, id_col, text_col).select("blob").distinct()
                   .select("blob", pairs.alias("p")).select("blob", "p.rule", "p.version")
                   .join(known.select("blob", "rule", "version"), ["blob", "rule", "version"], "left_anti"), "unseen")
    n = unseen.count()
    if not n:
        return 0
    todo = unseen.groupBy("blob").agg(F.collect_set("rule").alias("todo"))
    # One text per blob, combined before the shuffle; the join then needs no other.
    blobs = (texts(docs, id_col, text_col).select(F.unhex(F.sha2("text", 256)).alias("blob"), "text")
             .groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob"))
    text = F.col("text")
    hits = stage(blobs.select("blob", *[
        F.when(F.array_contains("todo", r.name), _hits(r, text)).alias(f"hits{k}") for k, r in enumerate(rules)])
        .select("blob", F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"hits{k}").alias("hits"))
                                          for k, r in enumerate(rules)])).alias("h"))
        .select("blob", "h.rule", F.posexplode("h.hits").alias("pos", "hit"))
        .select("blob", "rule", "pos", "hit.*"), "hits")
    before = Window.partitionBy("blob", "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    ends = hits.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(before))
    spans = ends.where("ok").groupBy("blob", "rule").agg(F.sort_array(F.collect_list(
        F.struct((F.col("end") - F.col("len")).alias("start"), F.col("end").alias("end")))).alias("spans"))
    (unseen.join(spans, ["blob", "rule"], "left")
     .select("blob", "rule", "version", F.coalesce("spans", F.expr("CAST(array() AS array<struct<start:long,end:long>>)")).alias("spans"))
     .write.mode("append").option("compression", "zstd").parquet(ledger))
    return n


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, rid, blob, spans`` from the ledger, at the given rule versions.

    ``spans`` is an array of ``(start, kind, rule, end)`` by start, then rule as listed; code points, end exclusive;
    empty where nothing was found.  Null text counts as empty and has no span; rows that repeat a text all
    carry its spans; an empty table gives no rows.
    """
    found = _by_blob(read_ledger(docs.sparkSession, ledger), rules)
    empty = "CAST(array() AS array<struct<start:long,kind:int,rule:string,end:long>>)"
    return (address(docs, id_col, text_col).join(found, "blob", "left")
            .select("doc_id", "rid", "blob", F.coalesce("spans", F.expr(empty)).alias("spans")))


def _by_blob(ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, spans`` of the blobs in which the rules, at their versions, found something."""
    order = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))])
    wanted = F.lit(False)
    for r in rules:
        wanted = wanted | ((F.col("rule") == r.name) & (F.col("version") == r.version))
    return (ledger.where(wanted & (F.size("spans") > 0))
            .select("blob", "rule", F.explode("spans").alias("s"))
            .groupBy("blob").agg(F.sort_array(F.collect_set(F.struct(
                F.col("s.start").alias("start"), order[F.col("rule")].alias("kind"),
                F.col("rule").alias("rule"), F.col("s.end").alias("end")))).alias("spans")))


def redacted(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mark: str = "[SECRET]",
             chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with every finding in its text replaced by ``mark``; same columns and rows, null text stays null.

    ``chars_col``, if there, is set anew where a text changes.
    """
    found = _by_blob(read_ledger(docs.sparkSession, ledger), rules)
    blob, spans = _fresh(docs, "_blob"), _fresh(docs, "_spans")
    rows = docs.withColumn(blob, F.unhex(F.sha2(text_col, 256)))
    rows = rows.join(found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), blob, "left")
    hit = F.col(spans).isNotNull()
    rows = rows.withColumn(text_col, F.when(hit, redact(F.col(text_col), F.col(spans), mark)).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        kind = dict(docs.dtypes)[chars_col]
        rows = rows.withColumn(chars_col, F.when(hit, F.char_length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def _fresh(docs: DataFrame, name: str) -> str:
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def span_text(spans="spans"):
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", s.rule, s.start.cast("string"), s.end.cast("string"))), ",")


def redact(text, spans, mark: str = "[SECRET]"):
    """``text`` with every span replaced by ``mark`` (overlapping spans by one); ``spans`` as from ``findings``."""
    # Walk the spans in order: keep what lies between the end reached so far and the next start.
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, s):
        gap = F.substring(text, (acc.at + 1).cast("int"), (s.start - acc.at).cast("int"))
        return F.when(s.start >= acc.at, F.struct(F.concat(acc.out, gap, F.lit(mark)).alias("out"), s.end.alias("at"))
                      ).otherwise(F.struct(acc.out.alias("out"), F.greatest(acc.at, s.end).alias("at")))
    done = F.aggregate(spans, start, step)
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(done.out, F.substring(text, (done.at + 1).cast("int"), F.lit(2147483647))))
