"""Lines that one source repeats over its documents.

Documents collapse first: rows of one accession number are one document, and
documents of one content are one cluster.  A line is then counted over
distinct documents, clusters and publication dates, never over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.binding import let
from folioforge.functions.classes import DIGIT, WS
from folioforge.runtime import cut


def line_form(line: Column) -> Column:
    """The form under which two lines are the same: trimmed, white space runs
    as one blank, lower case, every digit run as one sign."""
    text = F.regexp_replace(line, f"{WS}+", " ")
    return F.regexp_replace(F.lower(F.trim(text)), f"{DIGIT}+", "0")


def _lines(docs: DataFrame, min_letters: int) -> DataFrame:
    """(id, source, unit, chunk_no, line_no, key) of every line long enough.

    The key is a 64-bit hash of the line's form, so no line text is shuffled;
    lines of one source are equal if their keys are.
    """
    chunks = docs.select("_id", "_source", "_units", F.posexplode("_chunks").alias("chunk_no", "_chunk"))
    lines = chunks.where(F.col("_chunk").isNotNull()).select(
        "_id", "_source", "_units", "chunk_no",
        F.posexplode(F.split("_chunk", "\n", -1)).alias("line_no", "_line"),
    )
    long_enough = F.length("_line") >= min_letters
    letters = F.length(F.regexp_replace("_line", r"\P{L}+", ""))
    return lines.where(long_enough).where(letters >= min_letters).select(
        "_id", "_source", "_units", "chunk_no", "line_no", F.xxhash64(line_form(F.col("_line"))).alias("_key")
    )


#: What lines can be counted over.
UNITS = ("documents", "clusters", "dates")


def _with_units(df: DataFrame, id_col: str, source_col: str, document_col: str, date_col: str | None, chunks_col: str, units: tuple[str, ...]) -> DataFrame:
    """(_id, _source, _units, _chunks): ``_units`` holds each row's document, cluster and date, as asked for.

    A cluster is all documents of a source with one content, white space,
    letter case and digits aside; it is named by a hash of that.
    """
    date = F.col(date_col).cast("string") if date_col else F.lit(None).cast("string")
    d = df.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col(document_col).alias("_document"), F.col(chunks_col).alias("_chunks"), date.alias("_date"))
    d = d.where(F.col("_source").isNotNull())
    of = {"documents": F.col("_document").cast("string"), "dates": F.col("_date")}
    if "clusters" in units:
        # a document that was loaded again counts with the least of its contents
        content = d.select("_source", "_document", F.xxhash64(line_form(F.array_join("_chunks", " "))).alias("_content"))
        named = content.where(F.col("_document").isNotNull()).groupBy("_source", "_document").agg(F.min("_content").cast("string").alias("_cluster"))
        d = d.join(named, ["_source", "_document"], "left")
        of["clusters"] = F.col("_cluster")
    return d.select("_id", "_source", F.struct(*(of[u].alias(u) for u in units)).alias("_units"), "_chunks")


def _repeated(docs: DataFrame, lines: DataFrame, units: tuple[str, ...], least: int, min_share: float) -> DataFrame:
    """(_source, _key, <units>): lines that stand in enough of each unit of their source, with the counts."""
    out = None
    for unit in units:
        own = F.col(f"_units.{unit}")
        # distinct first, so both counts are partial aggregates and no group is gathered
        held = lines.where(own.isNotNull()).select("_source", "_key", own.alias("_unit")).distinct().groupBy("_source", "_key").agg(F.count(F.lit(1)).alias(unit)).where(F.col(unit) >= least)
        every = docs.where(own.isNotNull()).select("_source", own.alias("_unit")).distinct().groupBy("_source").agg(F.count(F.lit(1)).alias("_all"))
        # the tolerance only guards the product against rounding: counts are whole numbers
        enough = held.join(every, "_source").where(F.col(unit) >= F.col("_all") * F.lit(float(min_share)) - 1e-9).select("_source", "_key", unit)
        out = enough if out is None else out.join(enough, ["_source", "_key"])
    return out


def repeated_lines(
    df: DataFrame,
    id_col: str = "chunked_id",
    source_col: str = "cik",
    document_col: str = "accession_number",
    chunks_col: str = "text_chunks",
    date_col: str | None = "date_filed",
    units: tuple[str, ...] = ("clusters", "dates"),
    min_letters: int = 15,
    min_clusters: int = 5,
    min_share: float = 1 / 3,
) -> DataFrame:
    """All places of lines repeated within their source.

    Returns ``(<id_col>, chunk_no INT, line_no INT)``, counted from 0.  A line
    is repeated if, for each of ``units``, it stands in at least
    ``min_clusters`` of its source's and in at least ``min_share`` of them.
    Units are ``documents`` (distinct values of ``document_col``), ``clusters``
    (documents of one content are one) and ``dates`` (distinct publication
    dates, so what was republished on one day counts once).

    Nulls: a null chunk has no lines but keeps its number; a row with a null
    chunk array gives nothing; a null source is no source, so its rows give
    nothing; a null document or date adds to no count, though its lines are
    reported.  Empty tables give an empty result, repeated rows repeat their
    places.

    Scale: lines are cut once, into a scratch table of hashes.  All counts are
    partial aggregates over hashes.  The set of repeated lines holds at most
    ``1 / min_share`` times the mean number of lines of a document for each
    source; it joins the places by (source, key), where the runtime picks a
    broadcast if the set measures small and otherwise splits skewed keys.
    """
    docs = _with_units(df, id_col, source_col, document_col, date_col, chunks_col, units)
    lines = cut(_lines(docs, min_letters))
    repeated = _repeated(docs, lines, units, min_clusters, min_share).select("_source", "_key")
    places = lines.join(repeated, ["_source", "_key"], "left_semi")
    return places.select(F.col("_id").alias(id_col), "chunk_no", "line_no")


def line_counts(
    df: DataFrame, source_col: str = "cik", document_col: str = "accession_number", chunks_col: str = "text_chunks", date_col: str | None = "date_filed",
    min_letters: int = 15, min_clusters: int = 5, min_share: float = 1 / 3,
) -> DataFrame:
    """``(<source_col>, line, documents, clusters, dates)``: in how many of its source's
    documents, clusters and dates each line stands that passes by documents; null dates count as none."""
    docs = _with_units(df, source_col, source_col, document_col, date_col, chunks_col, UNITS)
    lines = cut(_lines(docs, min_letters))
    out = _repeated(docs, lines, ("documents",), min_clusters, min_share)
    for unit in UNITS[1:]:
        own = F.col(f"_units.{unit}")
        n = lines.where(own.isNotNull()).select("_source", "_key", own.alias("_unit")).distinct().groupBy("_source", "_key").agg(F.count(F.lit(1)).alias(unit))
        out = out.join(n, ["_source", "_key"], "left")
    return out.select(F.col("_source").alias(source_col), F.col("_key").alias("line"), "documents", *(F.coalesce(u, F.lit(0)).alias(u) for u in UNITS[1:]))


def without_repeated_lines(
    df: DataFrame,
    id_col: str = "chunked_id",
    source_col: str = "cik",
    document_col: str = "accession_number",
    chunks_col: str = "text_chunks",
    **limits,
) -> DataFrame:
    """``(<id_col>, <chunks_col>, lines_removed INT)``: every row of ``df``, its
    chunks without the repeated lines.

    Chunk numbers stay: a chunk that loses all lines becomes empty, a null
    chunk stays null, a null array stays null.  ``id_col`` must name a row;
    rows that repeat an id lose the same lines.
    """
    places = repeated_lines(df, id_col, source_col, document_col, chunks_col, **limits)
    by_chunk = places.groupBy(F.col(id_col).alias("_id"), "chunk_no").agg(F.array_sort(F.collect_set("line_no")).alias("_no"))
    gone = by_chunk.groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("chunk_no", "_no"))).alias("_gone"), F.sum(F.size("_no")).cast("int").alias("_n"))
    both = df.select(F.col(id_col).alias("_id"), F.col(chunks_col).alias("_chunks")).join(gone, "_id", "left")

    def clean(chunk: Column, no: Column) -> Column:
        def kept(of: Column) -> Column:
            # what stands between the removed lines, so the time is linear in the chunk
            return F.flatten(F.transform(F.slice(of["ends"], 1, F.size(of["ends"]) - 1), lambda end, j: F.slice(of["lines"], end + 2, F.get(of["ends"], j + 1) - end - 1)))

        lines = F.split(chunk, "\n", -1)
        ends = F.concat(F.array(F.lit(-1)), F.try_element_at("_gone", no), F.array(F.size(lines)))
        return F.when(F.try_element_at("_gone", no).isNull(), chunk).otherwise(F.array_join(let(F.struct(lines.alias("lines"), ends.alias("ends")), kept), "\n"))

    cleaned = F.when(F.col("_gone").isNull(), F.col("_chunks")).otherwise(F.transform("_chunks", clean))
    return both.select(F.col("_id").alias(id_col), cleaned.alias(chunks_col), F.coalesce("_n", F.lit(0)).alias("lines_removed"))
