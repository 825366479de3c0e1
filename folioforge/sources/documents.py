"""Readers and writers of catalogues, chunked documents, extracts and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.generic import tracked_names

CHUNKED = (
    "cik STRING, accession_number STRING, date_filed STRING, html_pages ARRAY<STRING>, text_chunks ARRAY<STRING>, "
    "text_chunk_refs ARRAY<INT>, chunk_tags ARRAY<MAP<STRING,BOOLEAN>>"
)
EXTRACT = (
    "text STRING, context_type STRING, entity_names_found ARRAY<STRING>, chunk_index INT, sentence_index INT, document_key STRING, quality_score DOUBLE"
)
EXTRACTS = f"ARRAY<STRUCT<{', '.join(c.replace(' ', ': ', 1) for c in EXTRACT.split(', '))}>>"


def read_catalog(spark: SparkSession, path: str, least: int = 0) -> DataFrame:
    """A parquet catalogue; with ``least`` it must have more rows than that."""
    df = spark.read.parquet(path)
    if least and df.limit(least + 1).count() <= least:
        raise ValueError(f"{path} has no more than {least} filings")
    return df


def read_ciks(spark: SparkSession, path: str, least: int = 0) -> DataFrame:
    """The ``cik`` column of a CSV file with a header."""
    df = spark.read.schema("cik BIGINT").csv(path, header=True)
    if least and df.limit(least + 1).count() <= least:
        raise ValueError(f"{path} has no more than {least} numbers")
    return df


def document_key(cik: str = "cik", accession: str = "accession_number"):
    return F.concat_ws("/", cik, accession).alias("document_key")


def write_chunked(df: DataFrame, path: str) -> None:
    """Chunked documents as JSON lines, one folder for each cik."""
    df.write.mode("overwrite").partitionBy("cik").json(path)


def read_chunked(spark: SparkSession, path: str) -> DataFrame:
    """Chunked documents; broken lines are left out."""
    d = spark.read.schema(CHUNKED + ", _broken STRING").option("columnNameOfCorruptRecord", "_broken").json(path)
    return d.where(F.col("_broken").isNull() & F.col("accession_number").isNotNull()).drop("_broken")


def extracts_as_json(df: DataFrame) -> DataFrame:
    """``(document_key, extracts)``: all extracts of a document as one JSON array, in order."""
    cols = [c.split(" ")[0] for c in EXTRACT.split(", ")]
    order = F.sort_array(F.collect_list(F.struct("chunk_index", (F.col("sentence_index") < 0).alias("block"), F.col("sentence_index").alias("i"), F.struct(*cols).alias("x"))))
    return df.groupBy("document_key").agg(F.to_json(F.transform(order, lambda s: s["x"])).alias("extracts"))


def extracts_from_json(df: DataFrame, json_col: str = "extracts") -> DataFrame:
    """The rows of stored arrays; a broken or null array gives none."""
    return df.select(F.explode(F.from_json(json_col, EXTRACTS)).alias("_x")).select("_x.*")


def write_predictions(df: DataFrame, name_col: str, path: str) -> None:
    """Distinct normal forms, ascending, one a line."""
    tracked_names(df, name_col).orderBy("name").select(F.col("name").alias("value")).write.mode("overwrite").text(path)
