"""Session-level helpers: reading tables and cutting lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder that the cluster names; only a local session without one gets its own."""
    sc = spark.sparkContext
    shared = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="folioforge-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
        sc.setCheckpointDir(shared)
    return shared


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{scratch_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p, fs = _file_system(spark, path)
    fs.deleteOnExit(p)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    A lost executor then costs a re-read, not a recomputation.  ``discard``
    deletes the table; what is left goes when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``cut`` that nothing will read again."""
    for t in tables:
        p, fs = _file_system(t.sparkSession, t._scratch)
        fs.delete(p, True)
