"""Where landed objects are, and reading, writing and deleting them."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def chosen_prefix(env: Mapping[str, str] | None = None) -> str:
    """STORAGE_PREFIX, else CACHE_PREFIX, else the empty text."""
    env = os.environ if env is None else env
    return env.get("STORAGE_PREFIX") or env.get("CACHE_PREFIX") or ""


def resolve(prefix: str, root: str = ".") -> str:
    """A full location: URIs and absolute paths as they are, others under ``root``."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", prefix) or prefix.startswith("/"):
        return prefix.rstrip("/") or "/"
    return os.path.join(os.path.abspath(root), prefix).rstrip("/")


class Store:
    """Objects under a location that any Hadoop file system serves."""

    def __init__(self, spark: SparkSession, prefix: str, root: str = "."):
        self.spark, self.base = spark, resolve(prefix, root)
        if len(re.sub(r"^[A-Za-z0-9+.-]+:/+", "/", self.base)) <= 3:
            raise ValueError(f"{self.base!r} is too short for a store")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{path}")
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def read(self, path: str) -> bytes | None:
        """One object's bytes; None if it is missing."""
        p, fs = self._fs(path)
        if not fs.exists(p):
            return None
        return bytes(self.spark.read.format("binaryFile").load(str(p.toString())).first()["content"])

    def write(self, path: str, content: bytes) -> bool:
        p, fs = self._fs(path)
        out = fs.create(p, True)
        try:
            out.write(bytearray(content))
        finally:
            out.close()
        return True

    def delete(self, path: str) -> bool:
        """True also if there was nothing to delete."""
        p, fs = self._fs(path)
        return bool(fs.delete(p, False)) or not fs.exists(p)

    def files(self, pattern: str = "*") -> DataFrame:
        """``(path, content)`` of all landed text objects, paths relative to the store; read in parallel."""
        d = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(self.base)
        p, fs = self._fs("")
        base = fs.makeQualified(p).toString().rstrip("/")
        return d.select(F.replace(F.col("path"), F.lit(base + "/"), F.lit("")).alias("path"), F.decode("content", "UTF-8").alias("content"))


def missing(wanted: DataFrame, files: DataFrame, path_col: str = "path") -> DataFrame:
    """The wanted paths that are not landed yet."""
    return wanted.join(files.select(F.col("path").alias(path_col)), path_col, "left_anti")
