"""Bronze JSONL scan (SRC-1, SRC-2, SRC-10, SRC-11)."""
from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRONZE

# The two bronze file families, in the order they are unioned.
FAMILIES = ("youtube_raw_*", "trends_raw_*")


def read_bronze(spark: SparkSession, root: str, families=FAMILIES, schema: T.StructType = BRONZE) -> DataFrame:
    """All bronze files of both families in one scan with an explicit schema.

    Lines that do not fit the schema carry their raw text in ``_corrupt`` (see
    ``usable``); ``_source_file``, ``_block`` and ``_line`` give a record's place: lines of one file
    in file order, however the scan is split.  A family with no files contributes nothing; no files at
    all gives an empty frame with the full schema.  Any other fault of the path is raised.
    """
    frames = []
    for fam in families:
        try:
            frames.append(spark.read.schema(schema)
                          .option("mode", "PERMISSIVE")
                          .option("columnNameOfCorruptRecord", "_corrupt")
                          .json(os.path.join(root, fam))
                          .withColumns({"_source_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
                                        "_line": F.monotonically_increasing_id()}))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    if not frames:
        empty = T.StructType(list(schema.fields) + [T.StructField("_source_file", T.StringType()), T.StructField("_block", T.LongType()),
                                                   T.StructField("_line", T.LongType())])
        return spark.createDataFrame([], empty)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def usable(bronze: DataFrame) -> DataFrame:
    """Records without the lines that are no JSON object.

    A record with a field of another type than the schema's keeps its other fields; that one is NULL.
    """
    raw = F.col("_corrupt")
    return bronze.where(raw.isNull() | (F.ltrim(raw).startswith("{") & F.get_json_object(raw, "$").isNotNull()))


def load_diagnostics(df: DataFrame, corrupt: str = "_corrupt", source: str = "_source_file") -> DataFrame:
    """Rows, malformed rows and rows carrying an id, per source file (SRC-11).

    (Spark rejects a raw-file scan that needs only the corrupt-record
    column; counting ids makes the scan read a real field as well.)
    """
    return df.groupBy(source).agg(F.count("*").alias("rows"), F.count_if(F.col(corrupt).isNotNull()).alias("skipped"),
                                  F.count("id").alias("with_id"))
