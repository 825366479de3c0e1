"""Cutting items over a size limit at natural boundaries, with overlap.

One bounded-quantifier pattern does the cutting inside the JVM: its
alternatives stand in the order of boundary strength, each takes as much as
fits, and single characters are the last resort.  The overlap is a look back
into the piece before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.binding import let

CHUNK_LIMIT = 2_000
PAGE_LIMIT = 8_000
OVERLAP = 200


def cut_pattern(limit: int, overlap: int) -> str:
    """The pattern whose matches are the new parts of the pieces.

    Every match but the last has at least half of the room, which must exceed
    the overlap, so a piece's last characters are always its own.
    """
    room = limit - overlap
    least = room // 2
    if overlap < 0 or least <= overlap:
        raise ValueError("the limit must exceed three times the overlap")
    ends = [  # boundaries from strong to weak, with the most characters each can have
        (r"\n[ \t\r]{0,14}\n", 16),                                   # paragraph
        (r"</(?:p|div|table|tr|li|ul|ol|h[1-6])>", 8),                # block of markup
        (r"\n", 1),                                                   # line
        (r"(?:[.!?…؟।][\"'”’)\]]{0,4}\s|[。！？][」』”]{0,4})", 6),     # sentence
        (r"[;:,、，]\s?", 2),                                           # clause
        (r"\s", 1),                                                   # word
    ]
    natural = [rf".{{{least},{room - width}}}{end}" for end, width in ends]
    return "(?s)" + "|".join([rf".{{1,{room}}}\z", *natural, rf".{{1,{room}}}"])


def pieces_of(text: Column, limit: int, overlap: int = OVERLAP) -> Column:
    """ARRAY<STRUCT<piece_no, overlap_len, text>> of one text; null for null.

    A text within the limit is one piece, the empty text too.  The pieces
    without their first ``overlap_len`` characters are the text again.
    """
    news = F.regexp_extract_all(text, F.lit(cut_pattern(limit, overlap)), F.lit(0))

    def pieces(new: Column) -> Column:
        def piece(own: Column, no: Column) -> Column:
            back = F.when(no > 0, F.right(F.get(new, no - 1), F.lit(overlap))).otherwise(F.lit(""))
            return F.struct(
                no.cast("int").alias("piece_no"), F.length(back).alias("overlap_len"), F.concat(back, own).alias("text")
            )

        return F.transform(new, piece)

    whole = F.array(F.struct(F.lit(0).alias("piece_no"), F.lit(0).alias("overlap_len"), text.alias("text")))
    return F.when(text.isNull(), None).when(F.length(text) <= limit, whole).otherwise(let(news, pieces))


def split_items(
    df: DataFrame, id_col: str, items_col: str, limit: int, overlap: int = OVERLAP
) -> DataFrame:
    """``(<id_col>, item_no, n_pieces, piece_no, overlap_len, text)``: the
    ordered pieces of every item of an array column.

    Null arrays and null items have no pieces, an empty item has one empty
    piece; repeated rows are cut again.  No shuffle: rows are cut where they
    are read.
    """
    items = df.select(F.col(id_col).alias("_id"), F.posexplode(items_col).alias("item_no", "_item"))
    cut = items.select("_id", "item_no", pieces_of(F.col("_item"), limit, overlap).alias("_pieces"))
    return cut.select(
        F.col("_id").alias(id_col), "item_no", F.size("_pieces").alias("n_pieces"), F.explode("_pieces").alias("_p")
    ).select(id_col, "item_no", "n_pieces", "_p.piece_no", "_p.overlap_len", "_p.text")


def split_filings(
    df: DataFrame,
    id_col: str = "chunked_id",
    pages_col: str = "html_pages",
    chunks_col: str = "text_chunks",
    refs_col: str = "text_chunk_refs",
    page_limit: int = PAGE_LIMIT,
    chunk_limit: int = CHUNK_LIMIT,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``(<id_col>, html_pages, text_chunks, text_chunk_refs)`` with every item
    within its limit.

    A chunk's page reference is repeated for its pieces.  As pages are cut
    too, a reference to a page becomes one to that page's first piece.  A
    filing without references keeps its null or empty array; a reference
    outside the pages stays as it is.  Null items stay null in their place.
    """
    d = df.select(
        F.col(id_col).alias("_id"), F.col(pages_col).alias("_pages"),
        F.col(chunks_col).alias("_chunks"), F.col(refs_col).alias("_refs"),
    )
    none = F.array(F.lit(None).cast("string"))

    def parts(limit: int):
        return lambda x: F.coalesce(F.transform(pieces_of(x, limit, overlap), lambda p: p["text"]), none)

    d = d.select(
        "_id", "_refs",
        F.transform("_pages", parts(page_limit)).alias("_pages"),
        F.transform("_chunks", parts(chunk_limit)).alias("_chunks"),
    )

    def moved(ref: Column) -> Column:
        inside = ref.isNotNull() & (ref >= 0) & (ref < F.coalesce(F.size("_pages"), F.lit(0)))
        before = F.aggregate(F.slice("_pages", F.lit(1), ref), F.lit(0), lambda n, p: n + F.size(p))
        return F.when(inside, before).otherwise(ref)

    refs = F.flatten(
        F.transform("_refs", lambda r, i: F.array_repeat(moved(r), F.coalesce(F.size(F.get("_chunks", i)), F.lit(1))))
    )
    return d.select(
        F.col("_id").alias(id_col), F.flatten("_pages").alias("html_pages"),
        F.flatten("_chunks").alias("text_chunks"), refs.alias("text_chunk_refs"),
    )
