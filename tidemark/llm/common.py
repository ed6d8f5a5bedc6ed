"""Session preparation and staging shared by the corpus operators.

Every intermediate lives in the folder that ``spark.checkpoint.dir`` names:
written as Parquet and read back, so lineage is cut and a lost executor
recomputes at most one written step.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import apply_runtime_conf, checkpoint_root, scratch_path, ship_package

# Rows and bytes in an Arrow batch handed to Python: documents are long, so batches are small.
ARROW_ROWS = 512
ARROW_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Runtime settings, checkpoint folder and package shipping; idempotent."""
    apply_runtime_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    checkpoint_root(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read through Spark only (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``(doc_id long, text string, rid long)``: null text is empty, ``rid`` numbers the scanned rows.

    ``row_col`` names a column that already numbers the rows.  Only the named columns
    are read, so other columns of the input, whatever their names, neither clash nor travel.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("rid"))


def packed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``texts`` with the text as one Zstandard frame of its UTF-8 bytes: it is to be written and shuffled."""
    def run(batches):
        import pyarrow as pa
        import zstandard
        pack = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([pack(t) for t in b.column(1).cast(pa.binary()).to_pylist()], pa.binary()), b.column(2)],
                names=["doc_id", "text", "rid"])
    return texts(docs, id_col, text_col, row_col).mapInArrow(run, "doc_id long, text binary, rid long")


def unpack(frame: bytes) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(frame)


# A row's place in the order (doc_id, rid) as one 38-digit number: unlike a struct it is a fixed-width
# aggregate buffer, so max() over it stays in the hash aggregate.  Null ids come first.
ROW_ORDER = ("CAST(coalesce(doc_id, -9223372036854775808) AS DECIMAL(38,0)) * 10000000000000000000BD"
             " + CAST(rid AS DECIMAL(19,0))")


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0
