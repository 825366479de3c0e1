"""The queries of the training-data problems, over whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import encode, leak, lookalike, markup, neardup, quality, repeated_lines, sentences, spans, split
from folioforge.runtime import table

#: Where the public tokenizers' files are.
RANKS = os.environ.get("FOLIOFORGE_RANKS", encode.DEFAULT_RANKS)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    # clusters and dates by the method, documents as the case is stated
    return repeated_lines.repeated_lines(table(spark, d, "chunked_document"), units=repeated_lines.UNITS)


def p1_lines(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.line_counts(table(spark, d, "chunked_document"))


def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines.without_repeated_lines(table(spark, d, "chunked_document"), units=repeated_lines.UNITS)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    kinds = quality.text_kinds(table(spark, d, "extracted_text"))
    return kinds.where(F.col("kind").isin("list", "table", "junk")).select("extract_id", "kind")


def p2_figures(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_kinds(table(spark, d, "extracted_text"))


def _records(spark: SparkSession, d: str) -> DataFrame:
    return neardup.filing_records(table(spark, d, "chunked_document")).unionByName(neardup.extract_records(table(spark, d, "extracted_text")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_pairs(_records(spark, d), shingle=3, threshold=0.6)


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicate_groups(_records(spark, d), shingle=3, threshold=0.6)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    blocks = table(spark, d, "extracted_text").where((F.col("sentence_index") == -1) & (F.col("context_type") == "narrative"))
    # the end of a block ends its last sentence, with or without a mark
    return sentences.sentences(blocks).where(F.col("closed") | F.col("sentence").rlike(r"\p{L}")).select("extract_id", "start_pos", "end_pos")


def p4_sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(table(spark, d, "extracted_text"))


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "chunked_document")
    chunks = split.split_items(docs, "chunked_id", "text_chunks", split.CHUNK_LIMIT).withColumn("item_kind", F.lit("chunk"))
    pages = split.split_items(docs, "chunked_id", "html_pages", split.PAGE_LIMIT).withColumn("item_kind", F.lit("page"))
    return chunks.unionByName(pages)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    # an item was cut exactly if it has a second piece
    return p5_pieces(spark, d).where(F.col("piece_no") == 1).select("item_kind", "chunked_id", "item_no")


def p5_filings(spark: SparkSession, d: str) -> DataFrame:
    return split.split_filings(table(spark, d, "chunked_document"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.markup_residue(table(spark, d, "chunked_document")).select("chunked_id", "chunk_no", "markup")


def p6_chunks(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_chunks(table(spark, d, "chunked_document"))


def p6_pages(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_pages(table(spark, d, "chunked_document"))


def p6_chunk_wrappers(spark: SparkSession, d: str) -> DataFrame:
    return markup.chunk_wrappers(table(spark, d, "chunked_document"))


def p6_wrappers(spark: SparkSession, d: str) -> DataFrame:
    return markup.host_wrappers(table(spark, d, "chunked_document"))


def _places(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.places_of(table(spark, d, "chunked_document"), table(spark, d, "extracted_text"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_names(_places(spark, d), table(spark, d, "entity_name"))


def p7_texts(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.in_one_form(_places(spark, d), table(spark, d, "entity_name"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode.encode_texts(table(spark, d, "documents"), ranks_path=RANKS)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_item")).select("doc_id", "item_id")


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    return leak.without_leaks(table(spark, d, "documents"), table(spark, d, "eval_item"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_spans(table(spark, d, "documents"))


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_ratio(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        p1_found, p1_lines, p1_clean, p2_found, p2_figures, p3_found, p3_groups, p4_found, p4_sentences, p5_found, p5_pieces, p5_filings,
        p6_found, p6_chunks, p6_pages, p6_wrappers, p6_chunk_wrappers, p7_found, p7_texts, p8_ids, p9_found, p9_clean, p10_found, p10_shares,
    )
}
