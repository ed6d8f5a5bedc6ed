"""Sinks: bronze JSONL dumps, CSV/Parquet tables, run-manifest appends (SNK-1..7)."""
from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dump_name(prefix: str, at: _dt.datetime | None = None) -> str:
    """``{prefix}_{YYYYMMDDTHHMMSSZ}`` (UTC) — the bronze dump naming rule."""
    at = at or _dt.datetime.now(_dt.timezone.utc)
    return f"{prefix}_{at.strftime('%Y%m%dT%H%M%SZ')}"


def write_jsonl(df: DataFrame, root: str, prefix: str, at: _dt.datetime | None = None, compression: str | None = None) -> str:
    """Timestamped JSON-lines dump (UTF-8, non-ASCII unescaped) (SNK-1); ``compression`` such as gzip, which readers undo."""
    path = os.path.join(root, dump_name(prefix, at))
    df.write.mode("errorifexists").json(path, compression=compression)
    return path


def write_csv(df: DataFrame, path: str, single_file: bool = False, compression: str | None = None) -> str:
    """CSV with header, overwrite, RFC-4180 quoting (SNK-2).  ``single_file`` (SNK-4) is opt-in:
    it funnels the whole table through one task.  ``compression`` such as gzip, which readers undo."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path, compression=compression)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Parquet table, overwrite (SNK-3); e.g. gold partitioned by date.  Zstandard: most of a table is text."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path, compression="zstd")
    return path


def append_manifest(manifest: DataFrame, path: str, run: str | None = None) -> str:
    """Append run-summary rows; the header is written with every part (SNK-5).

    With ``run`` the rows lie in a folder of that run, and the same run replaces them when it is repeated; readers get its name as
    a column ``run``.  A manifest uses one of the two forms throughout.
    """
    if run is None:
        manifest.write.mode("append").option("header", True).csv(path)
    else:
        manifest.write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/run={run}")
    return path


def repair_and_save(df: DataFrame, new_path: str, compression: str | None = None) -> str:
    """Rewrite a tolerant read as clean CSV into a *new* folder (SNK-6); a folder that exists is refused."""
    spark = df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new_path)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        raise ValueError(f"{new_path} exists; the input must not be overwritten")
    return write_csv(df, new_path, compression=compression)


def bronze_json_lines(b: DataFrame, extra: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Bronze records as JSON text lines (``value``) plus ``platform`` and the columns in ``keep``.

    An id holding a JSON object (search-shaped record) is emitted as an
    object, a plain id as a string; ``extra`` columns are appended as fields.
    """
    fields = ["platform", "snippet", "statistics", "contentDetails", "_fetched_at"] + list(extra or [])
    rest = F.to_json(F.struct(*fields))
    id_json = F.when(F.ltrim("id").startswith("{"), F.col("id")) \
               .otherwise(F.regexp_extract(F.to_json(F.struct(F.col("id").alias("x"))), r'^\{"x":(.*)\}$', 1))
    return b.select("platform", *(keep or []), F.concat(F.lit('{"id":'), id_json, F.lit(","), F.substring(rest, 2, 1 << 30)).alias("value"))
