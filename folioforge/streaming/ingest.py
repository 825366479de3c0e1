"""The per-document plans over streams of landed files.

Every operator used is stateless for each document, so a stream needs no
watermark unless a caller aggregates by event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from folioforge.operators.chunking import CHUNK_SIZE, chunk_texts
from folioforge.operators.tags import tagged


def landed(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of parquet files as they land."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def chunk_stream(docs: DataFrame, id_cols: list[str], text_col: str, size: int = CHUNK_SIZE) -> DataFrame:
    return chunk_texts(docs, id_cols, text_col, size)


def tag_stream(docs: DataFrame, id_cols: list[str], text_col: str) -> DataFrame:
    return tagged(docs, id_cols, text_col)


def windowed_tags(docs: DataFrame, time_col: str, text_col: str, window: str = "1 day", late: str = "7 days") -> DataFrame:
    """``(window_start, documents, managers, trustees, amounts)`` by event time; rows later than the watermark are dropped by the engine."""
    t = tagged(docs.withWatermark(time_col, late), [time_col], text_col)
    return t.groupBy(F.window(time_col, window)).agg(
        F.count(F.lit(1)).alias("documents"), F.sum("manager_count").alias("managers"), F.sum("trustee_count").alias("trustees"), F.sum("money_count").alias("amounts")
    ).select(F.col("window.start").alias("window_start"), "documents", "managers", "trustees", "amounts")


def sink(df: DataFrame, path: str, checkpoint: str, trigger_once: bool = True) -> DataStreamWriter:
    """An exactly-once parquet sink."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return w.trigger(availableNow=True) if trigger_once else w
