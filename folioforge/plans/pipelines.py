"""Whole pipelines over landed data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.similarity import THRESHOLD
from folioforge.functions.text import normal_name
from folioforge.operators.chunking import CHUNK_SIZE, chunk_texts
from folioforge.operators.extraction import Extractor
from folioforge.operators.filings import body_paths
from folioforge.operators.generic import GenericNames
from folioforge.operators.html import html_text_udf, pages_udf, split_documents
from folioforge.operators.matching import batch_match, evaluation
from folioforge.runtime import cut

_KEY = ["cik", "accession_number"]


def chunk_rows(body: DataFrame, size: int = CHUNK_SIZE) -> DataFrame:
    """``(cik, accession_number, page_no, chunk_no, chunk)`` of bodies ``(cik, accession_number, path, content)``.

    HTML bodies go page by page, text bodies as a whole, with a null page.
    ``chunk_no`` counts within the page.
    """
    html = split_documents(body.where(F.col("path").endswith(".htm")), _KEY, "content")
    pages = html.select(*_KEY, "page_no", html_text_udf("page").alias("_text"))
    texts = body.where(F.col("path").endswith(".txt")).select(*_KEY, F.lit(None).cast("int").alias("page_no"), F.col("content").alias("_text"))
    return chunk_texts(pages.unionByName(texts), [*_KEY, "page_no"], "_text", size)


def chunked_documents(filings: DataFrame, files: DataFrame, doc_type: str = "485BPOS", size: int = CHUNK_SIZE) -> DataFrame:
    """Chunked documents of filings with ``cik, accession_number, date_filed, documents, index_headers_path``.

    Only the first body of a filing counts.  Text filings have neither pages
    nor references; filings without a body do not come out.
    """
    paths = body_paths(filings, doc_type, ["htm", "txt"], [*_KEY, "date_filed"])
    landed = files.where(F.length("content") > 0)
    # the first landed body is chosen by path, so contents of the others are never joined
    first = paths.join(landed.select("path"), "path", "left_semi").groupBy(*_KEY, "date_filed").agg(F.min_by("path", "body_no").alias("path"))
    first = first.join(landed.select("path", "content"), "path")
    is_html = F.col("path").endswith(".htm")
    # HTML is split once: a filing's pages stay one array beside its chunks
    split = first.select(*_KEY, "date_filed", F.when(is_html, pages_udf(F.when(is_html, F.col("content")))).alias("html_pages"), F.when(~is_html, F.col("content")).alias("_text"))
    split = cut(split)
    pages = split.select(*_KEY, F.posexplode("html_pages").alias("page_no", "_page")).select(*_KEY, "page_no", html_text_udf("_page").alias("_text"))
    texts = split.where(F.col("_text").isNotNull()).select(*_KEY, F.lit(None).cast("int").alias("page_no"), "_text")
    rows = chunk_texts(pages.unionByName(texts), [*_KEY, "page_no"], "_text", size)
    chunks = rows.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("page_no", "chunk_no", "chunk"))).alias("_c"))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    d = split.select(*_KEY, "date_filed", "html_pages").join(chunks, _KEY, "left")
    return d.select(
        *_KEY, "date_filed", F.coalesce("html_pages", none("string")).alias("html_pages"),
        F.coalesce(F.transform("_c", lambda x: x["chunk"]), none("string")).alias("text_chunks"),
        F.coalesce(F.filter(F.transform("_c", lambda x: x["page_no"]), lambda p: p.isNotNull()), none("int")).alias("text_chunk_refs"),
        none("map<string,boolean>").alias("chunk_tags"),
    )


def extracts_of(chunked: DataFrame, extractor: Extractor, with_sentences: bool = True, with_paragraphs: bool = True) -> DataFrame:
    """Extracts of chunked documents; tags go with their chunk where they are filled."""
    d = chunked.select(F.concat_ws("/", *_KEY).alias("document_key"), "chunk_tags", F.posexplode("text_chunks").alias("chunk_index", "chunk"))
    d = d.select("document_key", "chunk_index", "chunk", F.get("chunk_tags", F.col("chunk_index")).alias("_tag"))
    return extractor.extract(d, tags_col="_tag", with_sentences=with_sentences, with_paragraphs=with_paragraphs)


def evaluated(predicted: DataFrame, expected: DataFrame, by: str, name_col: str = "name", threshold: float = THRESHOLD, generic: GenericNames | None = None) -> DataFrame:
    """``(<by>, true_positives, false_positives, false_negatives, precision, recall)``.

    Names are compared in their distinct normal forms, in order; generic
    predictions are left out if a filter is given.
    """
    if generic is not None:
        predicted = generic.specific(predicted, name_col)

    def lists(df: DataFrame, name: str) -> DataFrame:
        norm = df.select(by, normal_name(F.col(name_col)).alias("_n")).where(F.col("_n") != "")
        return norm.groupBy(by).agg(F.sort_array(F.collect_set("_n")).alias(name))

    d = lists(predicted, "_p").join(lists(expected, "_e"), by, "full").select(by, batch_match(F.col("_p"), F.col("_e"), threshold).alias("_m"))
    counts = [F.col(f"_m.{c}").alias(c) for c in ("true_positives", "false_positives", "false_negatives")]
    return d.select(by, *counts, *evaluation(F.col("_m.true_positives"), F.col("_m.false_positives"), F.col("_m.false_negatives")))
