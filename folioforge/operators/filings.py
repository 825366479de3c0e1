"""Resolving filings: paths, index parsing, choice of bodies, the catalogue."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators.html import Node, parsed

DOCUMENTS = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("sequence", T.StringType()), T.StructField("filename", T.StringType())]))
INDEX = T.StructType([T.StructField("date_filed", T.StringType()), T.StructField("documents", DOCUMENTS)])
_IDX = r"edgar/data/(\d+)/(.+)\.txt"


def filing_key(idx_filename: Column, strict: bool = False) -> tuple[Column, Column]:
    """(cik, accession_number) of an index path; null, or an error if ``strict``, for another form."""
    fits = idx_filename.rlike(_IDX)
    other = F.raise_error(F.concat(F.lit("not an index path: "), F.coalesce(idx_filename, F.lit("null")))).cast("string") if strict else F.lit(None).cast("string")
    part = lambda k: F.when(fits, F.regexp_extract(idx_filename, _IDX, k)).otherwise(other)
    return part(1).alias("cik"), part(2).alias("accession_number")


def index_path(idx_filename: Column) -> Column:
    """``.../A-B-C.txt`` -> ``.../ABC/A-B-C-index.html``."""
    folder = F.regexp_extract(idx_filename, r"^(.*)/[^/]*$", 1)
    name = F.replace(F.regexp_extract(idx_filename, r"([^/]*)$", 1), F.lit(".txt"), F.lit(""))
    return F.concat(folder, F.lit("/"), F.replace(name, F.lit("-"), F.lit("")), F.lit("/"), name, F.lit("-index.html"))


def headers_path(index_html_path: Column) -> Column:
    return F.replace(index_html_path, F.lit("-index.html"), F.lit("-index-headers.html"))


def resolved(df: DataFrame, strict: bool = False) -> DataFrame:
    """Filings with ``cik, accession_number, idx_filename, index_html_path, index_headers_path``.

    ``idx_filename`` wins over ``cik`` and ``accession_number``; if neither is
    complete the paths are null, or an error if ``strict``.
    """
    given = F.col("idx_filename").isNotNull() & (F.col("idx_filename") != "")
    both = F.col("cik").isNotNull() & F.col("accession_number").isNotNull() & (F.col("cik") != "") & (F.col("accession_number") != "")
    made = F.concat(F.lit("edgar/data/"), F.col("cik"), F.lit("/"), F.col("accession_number"), F.lit(".txt"))
    missing = F.raise_error(F.lit("a filing needs an index path, or a cik and an accession number")).cast("string") if strict else F.lit(None).cast("string")
    path = F.when(given, F.col("idx_filename")).when(both, made).otherwise(missing)
    cik, accession = filing_key(path)
    return df.select(
        cik.alias("cik"), accession.alias("accession_number"), path.alias("idx_filename"), index_path(path).alias("index_html_path"),
        headers_path(index_path(path)).alias("index_headers_path"),
    )


def parsed_headers(content: Column) -> Column:
    """STRUCT<date_filed, documents> of an index-headers page; empty date and no documents if it has no header.

    Only the first ``pre`` counts; its entities are undone once, so the values
    inside keep theirs.
    """
    pre = F.regexp_extract(F.coalesce(content, F.lit("")), r"(?is)<pre[^>]*>(.*?)</pre>", 1)
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        pre = F.replace(pre, F.lit(entity), F.lit(char))
    has = pre.rlike(r"(?i)<sec-header")
    day = F.regexp_extract(pre, r"FILED AS OF DATE:\s*(\d{8})", 1)
    date = F.when(has & (day != ""), F.concat_ws("-", F.substring(day, 1, 4), F.substring(day, 5, 2), F.substring(day, 7, 2))).otherwise(F.lit(""))
    blocks = F.regexp_extract_all(pre, F.lit(r"(?is)<document>(.*?)</document>"), F.lit(1))
    form = r"(?is)<type>\s*([^<\n]+?)\s*\n\s*<sequence>\s*([^<\n]+?)\s*\n\s*<filename>\s*([^<\n]+?)\s*\n\s*(?:<description>[^\n]*\n\s*)?<text>"
    docs = F.transform(
        F.filter(blocks, lambda b: b.rlike(form)),
        lambda b: F.struct(F.regexp_extract(b, form, 1).alias("type"), F.regexp_extract(b, form, 2).alias("sequence"), F.regexp_extract(b, form, 3).alias("filename")),
    )
    return F.struct(date.alias("date_filed"), F.when(has, docs).otherwise(F.array().cast(DOCUMENTS)).alias("documents"))


def _text(node: Node) -> str:
    return "".join(n.text for n in node.walk() if n.tag == "#text")


def _legacy(content: str | None) -> tuple[str, list[tuple]] | None:
    """Date and documents of a legacy index page; null documents without a table."""
    if not content:
        return "", []
    root = parsed(content)
    date = ""
    for node in root.walk():
        if node.tag == "div" and "infoHead" in node.get("class").split() and _text(node).strip() == "Filing Date":
            after = node.parent.children[node.parent.children.index(node) + 1 :]
            date = next((_text(n).strip() for n in after if n.tag == "div" and "info" in n.get("class").split()), "")
            break
    table = next((n for n in root.walk() if n.tag == "table" and "tableFile" in n.get("class").split()), None)
    if table is None:
        return date, None
    docs = []
    for row in [n for n in table.walk() if n.tag == "tr"][1:]:
        cells = [n for n in row.walk() if n.tag == "td"]
        if len(cells) < 5:
            continue
        link = next((n for n in cells[2].walk() if n.tag == "a"), None)
        if link is not None and _text(link):
            docs.append((_text(cells[3]).strip() or None, _text(cells[0]).strip() or None, _text(link)))
    return date, docs


@F.pandas_udf(INDEX)
def parsed_legacy(content: pd.Series) -> pd.DataFrame:
    rows = [_legacy(c) for c in content]
    return pd.DataFrame({
        "date_filed": [r[0] for r in rows],
        "documents": [None if r[1] is None else [dict(zip(("type", "sequence", "filename"), d, strict=True)) for d in r[1]] for r in rows],
    })


def filing_index(filings: DataFrame, files: DataFrame) -> DataFrame:
    """Filings with ``date_filed`` and ``documents``, from the headers page, else from the legacy page.

    ``files`` has ``path, content``.  A filing whose pages are missing has an
    empty date and no documents.
    """
    h = files.select(F.col("path").alias("index_headers_path"), parsed_headers(F.col("content")).alias("_h"))
    i = files.where(F.col("path").endswith("-index.html")).select(F.col("path").alias("index_html_path"), parsed_legacy("content").alias("_i"))
    d = filings.join(h, "index_headers_path", "left").join(i, "index_html_path", "left")
    empty = F.struct(F.lit("").alias("date_filed"), F.array().cast(DOCUMENTS).alias("documents"))
    index = F.when(F.size("_h.documents") > 0, F.col("_h")).otherwise(F.coalesce("_i", "_h", empty))
    return d.select(*filings.columns, index["date_filed"].alias("date_filed"), index["documents"].alias("documents"))


def document_paths(documents: Column, index_headers_path: Column, doc_type: str, strict: bool = False) -> Column:
    """Paths of the documents of a type, in index order; null, or an error if ``strict``, if there is none."""
    folder = F.regexp_extract(index_headers_path, r"^(.*)/[^/]*$", 1)
    paths = F.transform(F.filter(documents, lambda d: d["type"] == doc_type), lambda d: F.concat(folder, F.lit("/"), d["filename"]))
    none = F.raise_error(F.lit(f"no document of type {doc_type}")).cast("array<string>") if strict else F.lit(None).cast("array<string>")
    return F.when(F.size(paths) > 0, paths).otherwise(none)


def has_suffix(path: Column, file_types: list[str]) -> Column:
    """Whether what follows the last dot is one of the types; case counts."""
    return F.element_at(F.split(path, r"\."), -1).isin(file_types)


def body_paths(filings: DataFrame, doc_type: str, file_types: list[str], id_cols: list[str], strict: bool = False) -> DataFrame:
    """``(<id_cols>, body_no, path)``: where the bodies of a type are, in index order."""
    paths = document_paths(F.col("documents"), F.col("index_headers_path"), doc_type, strict)
    return filings.select(*id_cols, F.posexplode(paths).alias("body_no", "path")).where(has_suffix(F.col("path"), file_types))


def bodies(filings: DataFrame, files: DataFrame, doc_type: str, file_types: list[str], id_cols: list[str], strict: bool = False) -> DataFrame:
    """``(<id_cols>, body_no, path, content)``: the non-empty bodies of a type, in index order."""
    d = body_paths(filings, doc_type, file_types, id_cols, strict)
    return d.join(files.select("path", "content").where(F.length("content") > 0), "path").select(*id_cols, "body_no", "path", "content")


def shown(cik: Column, accession: Column, documents: Column) -> Column:
    return F.format_string("filing %s/%s: %d documents", F.coalesce(cik, F.lit("null")), F.coalesce(accession, F.lit("null")), F.coalesce(F.size(documents), F.lit(0)))


def interesting(catalog: DataFrame, ciks: DataFrame, cik_col: str = "cik") -> DataFrame:
    """Catalogue rows whose cik is in the list; padding zeros and null ciks do not match."""
    wanted = ciks.select(F.col("cik").cast("string").alias(cik_col))
    return catalog.join(wanted, cik_col, "left_semi")
