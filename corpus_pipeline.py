"""Corpus pipeline: five stages applied one after the other to ``documents``.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its predecessor kept
and returns a DataFrame, which is written as Parquet and read back as the next
stage's ``docs``.  All but the last return the columns of ``docs`` (any further columns included).

1. quality classifier: documents that it rejects go (labels from ``sf_dir``).
2. exact dedup: of equal texts the row with the largest id stays.
3. MinHash near-dedup: of each class one document stays.
4. secret scans: every span found is replaced by a mark; no document goes.
5. packing: the pieces of all documents and their places in sequences.

Null text counts as empty, null ids and repeated rows are handled row by row, empty tables give empty results.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import near_dup, packing, quality, queries, radix_dedup, secret_scan
from tidemark.llm.common import prepare, stage, table
from tidemark.session import scratch_path

# A private name for the row number: a table that has this column already is served, too.
ROW = "_tidemark_row"


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written once with a row number under a name that no column has."""
    name = ROW
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _only(docs: DataFrame, row: str, kept: DataFrame) -> DataFrame:
    """Rows of numbered ``docs`` whose number is in ``kept`` (column ``n``), without the number."""
    return docs.join(kept, docs[row] == kept["n"], "left_semi").drop(row)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(docs, model) >= quality.THRESHOLD)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows, row = _numbered(docs)
    kept = radix_dedup.exact_dedup(rows, row_col=row).where("kept").select(F.col("rid").alias("n"))
    return _only(rows, row, kept)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    rows, row = _numbered(docs)
    kept = near_dup.near_dup(rows, row_col=row).where("kept").select(F.col("rid").alias("n"))
    return _only(rows, row, kept)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    ledger = scratch_path(spark, "ledger")
    secret_scan.scan_new(docs, ledger)
    return secret_scan.redacted(docs, ledger)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return queries.packed_rows(*packing.pack_documents(docs, "word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

# The classifier, the signatures and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last one."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
