"""Session construction and shared scratch locations.

Nothing in the library creates a session implicitly; operators take and
return DataFrames.  ``get_spark`` is a convenience for tests, the bench and
scripts.
"""
from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


# Rows per vectorized Parquet batch.  Layers carry whole texts; a 4096-row
# batch of long documents needs tens of MB of contiguous memory per task.
READER_BATCH_ROWS = 1024


def apply_runtime_conf(spark: SparkSession) -> None:
    """Runtime settings the pipeline relies on (safe to set on a live session)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(READER_BATCH_ROWS))


def get_spark(app: str = "tidemark", master: str | None = None,
              shuffle_partitions: int | None = None, driver_memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.driver.memory": driver_memory,           # only effective before the JVM starts
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # runtime confs: pin them even on a reused session
    apply_runtime_conf(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where the session names none is one set: with a local master, whose executors share the
    machine, below Java's temporary folder (as in tests); on a cluster in the warehouse,
    which the driver and the executors share by definition.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            base = sc._jvm.java.lang.System.getProperty("java.io.tmpdir")
        else:
            base = spark.conf.get("spark.sql.warehouse.dir")
        root = f"{base.rstrip('/')}/tidemark-checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


_folders: dict[str, str] = {}


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder of written intermediates; deleted when the driver's JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/tidemark-{app}-{uuid.uuid4().hex[:8]}")
        store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(path)
        store.deleteOnExit(path)
        _folders[app] = path.toString()
    return _folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path in the application's scratch folder for a written table."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable on executors (pandas UDFs, stateful streams).

    Zips the package in memory, writes the archive into the shared checkpoint
    folder through the Hadoop FileSystem API and registers it with
    ``addPyFile`` — what ``--py-files`` does on a cluster.  Idempotent per
    application.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    import io
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, base))
    target = scratch_path(spark, "pkg") + "/tidemark.zip"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of what has been written: Spark deletes them when the driver's JVM collects the plans they belong to."""
    spark.sparkContext._jvm.System.gc()


def stage(df, name: str, codec: str | None = None):
    """Write an intermediate used by several consumers once, and read it back.

    Different consumers prune a shared subtree differently, so Spark cannot
    reuse its exchange and would recompute it per consumer.  The written
    table lives in the shared checkpoint folder: lineage is cut and a lost
    executor does not force the expensive upstream to re-run.  ``codec``: a Parquet
    codec for tables of long texts, the session's unless given.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=codec)
    return spark.read.parquet(path)
