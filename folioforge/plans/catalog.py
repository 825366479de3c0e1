"""The queries of the core operators over the tables, and their SQL counterparts for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import (
    ABBREVIATIONS, is_empty_line, is_meaningful, is_table_row, needs_sentences, normal_name, sanitized, sentences_of, without_artifacts,
)
from folioforge.operators.chunking import GAP_WORDS, chunk_texts, chunk_with_context, content_lines, packed, pieces_of_lines, proportional_sentences
from folioforge.operators.extraction import HEADER, LIST, PARAGRAPH_MIN, SENTENCE_MIN, TABLE, context_type, names_of, paragraphs_of
from folioforge.operators.filings import filing_key, interesting, resolved, shown
from folioforge.operators.generic import DEFAULT_PATTERNS, GenericNames, tracked_names
from folioforge.operators.html import break_stats, html_text_udf, split_documents
from folioforge.operators.matching import best_matches, name_pairs
from folioforge.operators.tags import MANAGER, MONEY, PERSON, RANGES, TRUSTEE, role_counts, tagged
from folioforge.plans.pipelines import chunk_rows, evaluated
from folioforge.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with its SQL counterpart if SQL can express it."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# ---- SQL texts shared by several counterparts

_WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\pZ]"


def _sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _sql_norm(x: str) -> str:
    low = f"regexp_replace(lower(coalesce({x}, '')), '[\\n\\r\\t]+', ' ', 'g')"
    flat = f"translate({low}, '–—', '--')"
    words = rf"regexp_replace({flat}, '[^\pL\pN_\s\x{{0b}}\x{{1c}}-\x{{1f}}\x{{85}}\pZ.&\-'']+', ' ', 'g')"
    return _sql_strip(f"regexp_replace({words}, '{_WS}+', ' ', 'g')")


_SQL_EMPTY = rf"(s = '' OR (length(s) < 5 AND NOT regexp_matches(s, '\pL')) OR NOT regexp_matches(s, '[\pL\pN_]{{3}}'))"
_SQL_ROW = "(contains(s, '|') AND s <> '|')"
_SQL_SENT = (
    r"(length(s) >= 50 AND length(s) - length(replace(s, '|', '')) < 2 AND length(s) - length(replace(s, chr(9), '')) < 2"
    r" AND length(regexp_replace(s, '\P{Lu}+', '', 'g')) <= length(s) * 0.7 AND length(regexp_replace(s, '[^\pL\pN]+', '', 'g')) >= length(s) * 0.5"
    r" AND regexp_matches(s, '[.!?]'))"
)
_SQL_LINES = f"""lines AS (
  SELECT doc_id, ln - 1 AS line_no, {_sql_strip("parts[ln]")} AS s
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS ln FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL)))"""
_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_PLAIN = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")
#: Blanks whose compatibility form is the plain one.
_SPACES = "".join(map(chr, [0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000]))


def _sql_sanitized(x: str) -> str:
    """Compatibility forms for the characters the tables hold, then the steps of ``sanitized``."""
    signs = f"coalesce({x}, '')"
    for sign, form in (("…", "..."), ("ำ", "ํา"), ("™", "TM"), ("¼", "1⁄4"), ("½", "1⁄2"), ("¾", "3⁄4")):
        signs = f"replace({signs}, '{sign}', '{form}')"
    form = f"translate({signs}, '{_WIDE}{_SPACES}', '{_PLAIN}{" " * len(_SPACES)}')"
    shown = rf"regexp_replace(nfc_normalize({form}), '[^\PC\n\t]+', '', 'g')"
    plain = f"translate({shown}, '‐‑‒–—−®☐☑☒', '------')"
    joined = rf"regexp_replace({plain}, '\$[\s\x{{1c}}-\x{{1f}}\x{{85}}\pZ]+(\p{{Nd}})', '$\1', 'g')"
    blanks = f"regexp_replace({joined}, '[ \\t]+', ' ', 'g')"
    return _sql_strip(f"regexp_replace({blanks}, '{_WS}*\\n{_WS}*', chr(10), 'g')")


_SQL_ABBREVIATED = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)


def _sql_sentences(x: str) -> str:
    return rf"""list_filter(list_transform(string_split(replace(regexp_replace(regexp_replace({x}, '\b({_SQL_ABBREVIATED})\.(\s)', '\1' || chr(57345) || '\2', 'g'),
    '([.!?]["”’)\]]*)\s+([\p{{Lu}}0-9"“(«¿¡])', '\1' || chr(57344) || '\2', 'g'), chr(57345), '.'), chr(57344)), lambda x: {_sql_strip("x")}), lambda x: x <> '')"""


def _sql_chunks(source: str, size: int = 2000) -> str:
    """CTEs that end in ``chunks(id, chunk_no, chunk)`` of a relation ``source(id, text)``; the query must be RECURSIVE."""
    words = ", ".join(f"'{w}'" for w in GAP_WORDS)
    return rf"""
c_lines AS (SELECT id, ln, {_sql_strip("parts[ln]")} AS s FROM (
  SELECT id, parts, unnest(range(1, len(parts) + 1)) AS ln FROM (SELECT id, string_split({_sql_sanitized("text")}, chr(10)) AS parts FROM {source}))),
c_kept AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY ln) AS i, s, {_SQL_ROW} AS r, {_SQL_SENT} AS n FROM c_lines WHERE NOT {_SQL_EMPTY}),
c_runs AS (SELECT *, sum(CAST(r AS INTEGER)) OVER (PARTITION BY id ORDER BY i) AS run,
  sum(CASE WHEN r AND coalesce(lag_r, false) THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY i) AS g FROM (SELECT *, lag(r) OVER (PARTITION BY id ORDER BY i) AS lag_r FROM c_kept)),
c_batch AS (SELECT id, run, {_sql_sentences("string_agg(s, chr(10) ORDER BY i)")} AS found, sum(length(s)) AS total FROM c_runs WHERE n AND NOT r GROUP BY id, run),
c_share AS (SELECT l.id, l.run, l.i, l.s, b.found, CAST(greatest(floor(CAST(len(b.found) * length(l.s) AS DOUBLE) / b.total), 1) AS BIGINT) AS share
  FROM c_runs l JOIN c_batch b ON b.id = l.id AND b.run = l.run WHERE l.n AND NOT l.r),
c_start AS (SELECT *, sum(share) OVER (PARTITION BY id, run ORDER BY i) - share AS start, max(i) OVER (PARTITION BY id, run, s) AS last_i FROM c_share),
c_dealt AS (SELECT id, run, i, s, CASE WHEN start >= len(found) THEN [s] ELSE found[start + 1 : start + share] END AS own FROM c_start WHERE i = last_i),
c_parts AS (
  SELECT id, min(i) AS i, 0 AS k, string_agg(s, chr(10) ORDER BY i) AS piece FROM c_runs WHERE r GROUP BY id, g
  UNION ALL SELECT id, i, 0, s FROM c_runs WHERE NOT r AND NOT n
  UNION ALL SELECT id, i, k, own[k] FROM (SELECT t.id, t.i, d.own, unnest(range(1, len(d.own) + 1)) AS k FROM c_start t JOIN c_dealt d ON d.id = t.id AND d.run = t.run AND d.s = t.s)),
c_pieces AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY i, k) AS i, piece FROM c_parts),
c_walk AS (
  SELECT id, i, piece, CASE WHEN length(piece) > {size} THEN 1 ELSE 0 END AS k, length(piece) AS held FROM c_pieces WHERE i = 1
  UNION ALL
  SELECT n.id, n.i, n.piece, CASE WHEN w.held + length(n.piece) > {size} THEN w.k + 1 ELSE w.k END,
    CASE WHEN w.held + length(n.piece) > {size} THEN length(n.piece) ELSE w.held + length(n.piece) END
  FROM c_walk w JOIN c_pieces n ON n.id = w.id AND n.i = w.i + 1),
c_packed AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY k) - 1 AS chunk_no, c FROM (
  SELECT id, k, string_agg(piece, chr(10) || chr(10) ORDER BY i) AS c FROM c_walk GROUP BY id, k) WHERE length({_sql_strip("c")}) > 100),
c_out AS (SELECT id, chunk_no, j, line, {_sql_strip("line")} AS s FROM (
  SELECT id, chunk_no, parts, j, parts[j] AS line FROM (SELECT id, chunk_no, parts, unnest(range(1, len(parts) + 1)) AS j FROM (SELECT id, chunk_no, string_split(c, chr(10)) AS parts FROM c_packed)))),
c_gap AS (SELECT *, max(CASE WHEN {_SQL_ROW} THEN j END) OVER (PARTITION BY id, chunk_no ORDER BY j) AS a,
  min(CASE WHEN {_SQL_ROW} THEN j END) OVER (PARTITION BY id, chunk_no ORDER BY j ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM c_out),
c_wide AS (SELECT *, coalesce(a <> b AND b - a - 1 > 2, false) AS wide, length(s) > 10 AND lower(s) NOT IN ({words}) AS content FROM c_gap),
c_seen AS (SELECT *, coalesce(lag(s) OVER (PARTITION BY id, chunk_no, a ORDER BY j) <> '', true) AS after_content FROM c_wide WHERE wide AND (content OR s = '')),
c_left AS (SELECT id, chunk_no, a, j, CASE WHEN content THEN line ELSE '' END AS line, bool_or(content) OVER (PARTITION BY id, chunk_no, a) AS any_content,
  row_number() OVER (PARTITION BY id, chunk_no, a ORDER BY j) AS nth FROM c_seen WHERE content OR after_content),
c_final AS (
  SELECT id, chunk_no, j, line FROM c_wide WHERE NOT wide
  UNION ALL SELECT id, chunk_no, j, line FROM c_left WHERE any_content
  UNION ALL SELECT id, chunk_no, min(j), '' FROM c_wide WHERE wide GROUP BY id, chunk_no, a
    HAVING NOT bool_or(content)),
chunks AS (SELECT id, chunk_no, string_agg(line, chr(10) ORDER BY j) AS chunk FROM c_final GROUP BY id, chunk_no)"""


_SQL_GENERIC = "(length(n) <= 3 OR n IN (" + ", ".join(f"'{p}'" for p in sorted(DEFAULT_PATTERNS)) + "))"
_SQL_FOUND = "(SELECT extract_id, cik, unnest(entity_names_found) AS name FROM extracted_text)"


def _sql_any(x: str, patterns: list[str]) -> str:
    return "(" + " OR ".join("regexp_matches({}, '{}')".format(x, p.replace("(?mdi)", "(?mi)").replace("(?md)", "(?m)").replace("'", "''")) for p in patterns) + ")"


def _sql_context(text: str, names: str, tags: str = "") -> str:
    t = _sql_strip(text)
    tagged = "".join(f"WHEN coalesce({tags}['is_{k}'], false) THEN '{k}' " for k in ("table", "header", "list")) if tags else ""
    return f"""CASE {tagged}
  WHEN len(list_filter({names}, lambda n: contains({text}, '(' || n || ')') OR contains({text}, '(' || upper(n) || ')'))) > 0 THEN 'parenthetical'
  WHEN len(list_filter({names}, lambda n: len(list_filter(string_split({text}, chr(10)), lambda x: {_sql_strip("x")} <> '' AND contains(x, n)
       AND CAST(length(n) AS DOUBLE) / length({_sql_strip("x")}) > 0.6)) > 0)) > 0 THEN 'header'
  WHEN {_sql_any(t, TABLE)} THEN 'table' WHEN {_sql_any(t, HEADER)} THEN 'header' WHEN {_sql_any(t, LIST)} THEN 'list'
  WHEN length({t}) > 50 AND regexp_matches({t}, '[.!?]') THEN 'narrative' ELSE 'other' END"""


def _sql_count(x: str, patterns: list[str]) -> str:
    joined = "|".join(f"(?:{p})" for p in patterns).replace("'", "''")
    return f"CAST(len(regexp_extract_all({x}, '(?i){joined}')) AS INTEGER)"


_SQL_TOKENS = "list_distinct(list_filter(string_split({0}, ' '), lambda t: t <> ''))"
_SQL_OVERLAP = "coalesce(CAST(len(list_intersect(pt, et)) AS DOUBLE) / nullif(len(list_distinct(list_concat(pt, et))), 0), 0)"
_SQL_SCORED = f"""
p AS (SELECT DISTINCT name AS predicted, {_sql_norm("name")} AS pn FROM {_SQL_FOUND} WHERE {_sql_norm("name")} <> ''),
e AS (SELECT DISTINCT name AS expected, {_sql_norm("name")} AS en FROM entity_name WHERE {_sql_norm("name")} <> ''),
pe AS (SELECT *, {_SQL_TOKENS.format("pn")} AS pt, {_SQL_TOKENS.format("en")} AS et FROM p, e),
scored AS (
  SELECT predicted, expected,
    CASE WHEN pn = en THEN 1.0 WHEN contains(pn, en) OR contains(en, pn)
         THEN CAST(0.8 AS DOUBLE) + CAST(0.2 AS DOUBLE) * (CAST(least(length(pn), length(en)) AS DOUBLE) / greatest(length(pn), length(en))) ELSE {_SQL_OVERLAP} END AS score,
    CASE WHEN pn = en THEN 'exact' WHEN contains(pn, en) OR contains(en, pn) THEN 'substring' WHEN {_SQL_OVERLAP} >= 0.6 THEN 'token_overlap' ELSE 'no_match' END AS type
  FROM pe)"""


# ---- normal forms


@query(f"SELECT doc_id, {_sql_norm('text')} AS norm FROM documents")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", normal_name(F.col("text")).alias("norm"))


@query("SELECT doc_id, " + _sql_norm("translate(replace(replace(coalesce(text, ''), chr(0), ''), chr(65533), ''), '|【】〖〗™®©•▪○', '     ')") + " AS cleaned FROM documents")
def clean_artifacts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", without_artifacts(F.col("text")).alias("cleaned"))


@query(f"SELECT extract_id, text FROM extracted_text WHERE length({_sql_norm('text')}) >= 3")
def meaningful_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted_text").where(is_meaningful(F.col("text"))).select("extract_id", "text")


@query(f"SELECT doc_id, {_sql_sanitized('text')} AS sanitized FROM documents")
def sanitize_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", sanitized(F.col("text")).alias("sanitized"))


# ---- lines and chunks


@query(f"""WITH {_SQL_LINES}
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, {_SQL_EMPTY} AS is_empty, {_SQL_ROW} AS is_row, {_SQL_SENT} AS splits FROM lines""")
def line_stats(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "_s"))
    s = F.col("_s")
    return lines.select("doc_id", "line_no", is_empty_line(s).alias("is_empty"), is_table_row(s).alias("is_row"), needs_sentences(s).alias("splits"))


@query(f"""WITH {_SQL_LINES},
kept AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS i, s, {_SQL_ROW} AS r FROM lines WHERE NOT {_SQL_EMPTY}),
begun AS (SELECT *, CASE WHEN r AND lag(r) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS b FROM kept),
pieces AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM begun)
SELECT doc_id, CAST(g - 1 AS INTEGER) AS piece_no, string_agg(s, chr(10) ORDER BY i) AS piece FROM pieces GROUP BY doc_id, g""")
def table_runs(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", content_lines(F.col("text")).alias("_lines"))
    return docs.select("doc_id", F.posexplode(pieces_of_lines(F.col("_lines"), None)).alias("piece_no", "piece"))


@query(f"""WITH RECURSIVE {_SQL_LINES},
kept AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS i, s FROM lines WHERE NOT {_SQL_EMPTY}),
walk AS (
  SELECT doc_id, i, s, CASE WHEN length(s) > 500 THEN 1 ELSE 0 END AS k, length(s) AS held FROM kept WHERE i = 1
  UNION ALL
  SELECT n.doc_id, n.i, n.s, CASE WHEN w.held + length(n.s) > 500 THEN w.k + 1 ELSE w.k END, CASE WHEN w.held + length(n.s) > 500 THEN length(n.s) ELSE w.held + length(n.s) END
  FROM walk w JOIN kept n ON n.doc_id = w.doc_id AND n.i = w.i + 1),
packed AS (SELECT doc_id, k, string_agg(s, chr(10) || chr(10) ORDER BY i) AS chunk FROM walk GROUP BY doc_id, k)
SELECT doc_id, CAST(k AS INTEGER) AS chunk_no, chunk FROM packed
UNION ALL SELECT doc_id, 0, '' FROM walk WHERE i = 1 AND k = 1""")
def chunk_pack(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", content_lines(F.col("text")).alias("_lines"))
    return docs.select("doc_id", F.posexplode(packed(F.col("_lines"), 500)).alias("chunk_no", "chunk"))


@query(f"WITH RECURSIVE docs AS (SELECT doc_id AS id, text FROM documents), {_sql_chunks('docs')} SELECT id AS doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, chunk FROM chunks")
def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    return chunk_texts(table(spark, d, "documents"), ["doc_id"], "text")


@query("""SELECT chunked_id, CAST(k - 1 AS INTEGER) AS chunk_no,
  CASE WHEN k > 1 AND t[k - 1] IS NOT NULL THEN right(t[k - 1], 500) || chr(10) || chr(10) ELSE '' END
  || coalesce(t[k], '') || CASE WHEN k < len(t) AND t[k + 1] IS NOT NULL THEN chr(10) || chr(10) || left(t[k + 1], 500) ELSE '' END AS in_context
FROM (SELECT chunked_id, text_chunks AS t, unnest(range(1, len(text_chunks) + 1)) AS k FROM chunked_document)""")
def chunk_context(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "chunked_document").select("chunked_id", "text_chunks", F.posexplode("text_chunks").alias("chunk_no", "_c"))
    return docs.select("chunked_id", "chunk_no", chunk_with_context(F.col("text_chunks"), F.col("chunk_no")).alias("in_context"))


# ---- HTML


def _documents(spark: SparkSession, d: str) -> DataFrame:
    """Filings as single HTML documents: their pages in a row."""
    return table(spark, d, "chunked_document").where(F.size("html_pages") > 0).select("chunked_id", "cik", "accession_number", F.array_join("html_pages", "\n").alias("content"))


@query()
def split_html_pages(spark: SparkSession, d: str) -> DataFrame:
    return split_documents(_documents(spark, d), ["chunked_id"], "content")


@query()
def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "chunked_document").select("chunked_id", F.posexplode("html_pages").alias("page_no", "_page"))
    return pages.select("chunked_id", "page_no", html_text_udf("_page").alias("text"))


@query()
def page_break_stats(spark: SparkSession, d: str) -> DataFrame:
    return break_stats(_documents(spark, d), "chunked_id", "content")


@query()
def chunk_filings(spark: SparkSession, d: str) -> DataFrame:
    """HTML filings page by page, plain-text ones as a whole."""
    docs = _documents(spark, d).select(F.col("chunked_id").alias("cik"), "accession_number", F.lit("body.htm").alias("path"), "content")
    plain = table(spark, d, "chunked_document").where(F.coalesce(F.size("html_pages"), F.lit(0)) <= 0)
    texts = plain.select(F.col("chunked_id").alias("cik"), "accession_number", F.lit("body.txt").alias("path"), F.array_join("text_chunks", "\n\n").alias("content"))
    return chunk_rows(docs.unionByName(texts)).withColumnRenamed("cik", "chunked_id")


# ---- extraction


_SQL_PARAS = rf"""paras AS (
  SELECT chunked_id, k - 1 AS chunk_index, unnest(list_transform(string_split_regex(text_chunks[k], '\n{_WS}*\n'), lambda x: {_sql_strip("x")})) AS text
  FROM (SELECT chunked_id, text_chunks, unnest(range(1, len(text_chunks) + 1)) AS k FROM chunked_document) WHERE text_chunks[k] IS NOT NULL),
hits AS (SELECT DISTINCT p.chunked_id, p.chunk_index, p.text, n.name FROM paras p JOIN entity_name n ON contains(lower(p.text), lower(n.name)) WHERE length(p.text) >= 50),
found AS (SELECT chunked_id, chunk_index, text, list(name ORDER BY name) AS names FROM hits GROUP BY ALL)"""


@query(f"""WITH {_SQL_PARAS}
SELECT chunked_id, CAST(chunk_index AS INTEGER) AS chunk_index, text, array_to_string(names, '; ') AS names, {_sql_context("text", "names")} AS context_type FROM found""")
def paragraphs_with_entities(spark: SparkSession, d: str) -> DataFrame:
    chunks = table(spark, d, "chunked_document").select("chunked_id", F.posexplode("text_chunks").alias("chunk_index", "_c")).where(F.col("_c").isNotNull())
    paras = chunks.select("chunked_id", "chunk_index", F.explode(F.array_distinct(paragraphs_of(F.col("_c")))).alias("text")).where(F.length("text") >= PARAGRAPH_MIN)
    return _with_names(spark, d, paras, ["chunked_id", "chunk_index"])


_SQL_SENTS = f"""sents AS (
  SELECT doc_id, k - 1 AS sentence_index, found[k] AS text FROM (SELECT doc_id, found, unnest(range(1, len(found) + 1)) AS k FROM (SELECT doc_id, {_sql_sentences("text")} AS found FROM documents))),
hits AS (SELECT DISTINCT s.doc_id, s.sentence_index, s.text, n.name FROM sents s JOIN entity_name n ON contains(lower(s.text), lower(n.name)) WHERE length(s.text) >= 20),
found AS (SELECT doc_id, sentence_index, text, list(name ORDER BY name) AS names FROM hits GROUP BY ALL)"""


@query(f"""WITH {_SQL_SENTS}
SELECT doc_id, CAST(sentence_index AS INTEGER) AS sentence_index, text, array_to_string(names, '; ') AS names, {_sql_context("text", "names")} AS context_type FROM found""")
def sentences_with_entities(spark: SparkSession, d: str) -> DataFrame:
    sents = table(spark, d, "documents").select("doc_id", F.posexplode(sentences_of(F.col("text"))).alias("sentence_index", "text")).where(F.length("text") >= SENTENCE_MIN)
    return _with_names(spark, d, sents, ["doc_id", "sentence_index"])


def _with_names(spark: SparkSession, d: str, units: DataFrame, keys: list[str]) -> DataFrame:
    found = names_of(units, table(spark, d, "entity_name"), "text")
    return found.select(*keys, "text", F.array_join("names", "; ").alias("names"), context_type(F.col("text"), None, F.col("names")).alias("context_type"))


@query(f"SELECT extract_id, {_sql_context('coalesce(text, chr(0))', 'coalesce(entity_names_found, [])').replace('chr(0)', chr(39) * 2)} AS context_type FROM extracted_text")
def context_types(spark: SparkSession, d: str) -> DataFrame:
    names = F.filter(F.coalesce("entity_names_found", F.array().cast("array<string>")), lambda n: n.isNotNull())
    return table(spark, d, "extracted_text").select("extract_id", context_type(F.col("text"), None, names).alias("context_type"))


# ---- tags


@query(f"""SELECT doc_id, {_sql_count("coalesce(text, '')", MANAGER)} AS manager_count, {_sql_count("coalesce(text, '')", TRUSTEE)} AS trustee_count,
  {_sql_count("coalesce(text, '')", RANGES)} AS range_count, CAST((length(lower(coalesce(text, ''))) - length(replace(lower(coalesce(text, '')), 'none', ''))) / 4 AS INTEGER) AS none_count
FROM documents""")
def tag_counts(spark: SparkSession, d: str) -> DataFrame:
    c = role_counts(F.col("text"))
    return table(spark, d, "documents").select("doc_id", *(c[k].alias(k) for k in ("manager_count", "trustee_count", "range_count", "none_count")))


_SQL_PERSONS = "list_transform(regexp_extract_all(coalesce(text, ''), '" + PERSON.replace("'", "''") + "'), lambda x: " + _sql_strip("regexp_replace(regexp_replace(x, '^(?:Mr|Mrs|Ms|Dr|Prof)\\.?\\s+', ''), '^[|,.;:]+|[|,.;:]+$', '', 'g')") + ")"


@query(f"""SELECT doc_id, {_sql_count("coalesce(text, '')", MANAGER)} AS manager_count, {_sql_count("coalesce(text, '')", TRUSTEE)} AS trustee_count,
  CAST(len(list_distinct(list_transform(list_filter({_SQL_PERSONS}, lambda x: length(x) >= 2 AND NOT (length(x) <= 5 AND upper(x) = x AND lower(x) <> x)), lambda x: lower(x)))) AS INTEGER) AS person_unique,
  CAST(len(list_distinct(list_filter(list_transform(regexp_extract_all(coalesce(text, ''), '{MONEY}'), lambda x: {_sql_strip("x")}), lambda x: x <> ''))) AS INTEGER) AS money_count,
  {_sql_count("coalesce(text, '')", RANGES)} AS range_count, CAST((length(lower(coalesce(text, ''))) - length(replace(lower(coalesce(text, '')), 'none', ''))) / 4 AS INTEGER) AS none_count FROM documents""")
def tag_entities(spark: SparkSession, d: str) -> DataFrame:
    return tagged(table(spark, d, "documents"), ["doc_id"], "text")


@query(f"""SELECT lang, count(*) AS documents, CAST(sum({_sql_count("coalesce(text, '')", RANGES)}) AS BIGINT) AS ranges,
  CAST(sum(len(list_filter(string_split_regex(coalesce(text, ''), '\\n{_WS}*\\n'), lambda x: {_sql_strip("x")} <> ''))) AS BIGINT) AS paragraphs FROM documents GROUP BY lang""")
def tag_summary(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    paras = F.size(F.filter(paragraphs_of(F.col("text")), lambda p: p != ""))
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"), F.sum(role_counts(F.col("text"))["range_count"]).alias("ranges"), F.sum(paras).alias("paragraphs"))


# ---- names


def _found(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "extracted_text").select("extract_id", "cik", F.explode("entity_names_found").alias("name"))


@query(f"WITH {_SQL_SCORED} SELECT predicted, expected, round(score, 6) AS score, type FROM scored WHERE type <> 'no_match'")
def name_matches(spark: SparkSession, d: str) -> DataFrame:
    names = name_pairs(_found(spark, d), table(spark, d, "entity_name"), "name", "name")
    return names.where(F.col("type") != "no_match").withColumn("score", F.round("score", 6))


@query(f"""WITH {_SQL_SCORED},
best AS (SELECT predicted, expected, score, row_number() OVER (PARTITION BY predicted ORDER BY score DESC, expected) AS r FROM scored WHERE score >= 0.6)
SELECT a.name AS predicted, b.expected AS best, round(coalesce(b.score, 0), 6) AS score FROM (SELECT DISTINCT name FROM {_SQL_FOUND}) a LEFT JOIN best b ON b.predicted = a.name AND b.r = 1""")
def best_names(spark: SparkSession, d: str) -> DataFrame:
    best = best_matches(_found(spark, d), table(spark, d, "entity_name"), "name", "name")
    return best.withColumn("score", F.round("score", 6))


@query(f"""WITH RECURSIVE p AS (SELECT document_key, list_sort(list(DISTINCT n)) AS p FROM (SELECT document_key, {_sql_norm("name")} AS n FROM (SELECT document_key, unnest(entity_names_found) AS name FROM extracted_text)) WHERE n <> '' AND NOT {_SQL_GENERIC} GROUP BY document_key),
e AS (SELECT document_key, list_sort(list(DISTINCT {_sql_norm("name")})) AS e FROM (SELECT DISTINCT document_key, cik FROM extracted_text) JOIN entity_name USING (cik) WHERE {_sql_norm("name")} <> '' GROUP BY document_key),
g AS (
  SELECT document_key, coalesce(p, []) AS p, coalesce(e, []) AS e, 0 AS i, CAST([] AS BIGINT[]) AS taken FROM p FULL JOIN e USING (document_key)
  UNION ALL
  SELECT document_key, p, e, i + 1, CASE WHEN hit IS NULL THEN taken ELSE list_append(taken, hit) END FROM (
    SELECT *, list_filter(range(1, len(e) + 1), lambda j: NOT list_contains(taken, j) AND (p[i + 1] = e[j] OR contains(p[i + 1], e[j]) OR contains(e[j], p[i + 1])
      OR CAST(len(list_intersect({_SQL_TOKENS.format("p[i + 1]")}, {_SQL_TOKENS.format("e[j]")})) AS DOUBLE) / len(list_distinct(list_concat({_SQL_TOKENS.format("p[i + 1]")}, {_SQL_TOKENS.format("e[j]")}))) >= 0.6))[1] AS hit
    FROM g WHERE i < len(p))),
c AS (SELECT document_key, len(taken) AS tp, len(p) - len(taken) AS fp, len(e) - len(taken) AS fn FROM g WHERE i = len(p))
SELECT document_key, CAST(tp AS INTEGER) AS true_positives, CAST(fp AS INTEGER) AS false_positives, CAST(fn AS INTEGER) AS false_negatives,
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision, CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall FROM c""")
def name_evaluation(spark: SparkSession, d: str) -> DataFrame:
    """Names found in each document against the reference names of its filer."""
    x = table(spark, d, "extracted_text")
    found = x.select("document_key", F.explode("entity_names_found").alias("name"))
    known = table(spark, d, "entity_name").select("cik", "name")
    expected = x.select("document_key", "cik").distinct().join(known, "cik").select("document_key", "name")
    return evaluated(found, expected, "document_key", generic=GenericNames())


@query(f"SELECT extract_id, name FROM (SELECT *, {_sql_norm('name')} AS n FROM {_SQL_FOUND}) WHERE NOT {_SQL_GENERIC}")
def generic_filter(spark: SparkSession, d: str) -> DataFrame:
    return GenericNames().specific(_found(spark, d), "name").select("extract_id", "name")


@query(f"""SELECT kind, CAST(count(*) AS INTEGER) AS total, CAST(count(*) FILTER ({_SQL_GENERIC}) AS INTEGER) AS generic, CAST(count(*) FILTER (NOT {_SQL_GENERIC}) AS INTEGER) AS specific,
  CAST(count(*) FILTER ({_SQL_GENERIC}) AS DOUBLE) / count(*) AS filter_rate
FROM (SELECT 'part' AS kind, {_sql_norm('p_name')} AS n FROM part UNION ALL SELECT kind, {_sql_norm('kind')} FROM entity_name) GROUP BY kind""")
def filter_stats(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select(F.lit("part").alias("kind"), F.col("p_name").alias("name"))
    kinds = table(spark, d, "entity_name").select("kind", F.col("kind").alias("name"))
    return GenericNames().stats(parts.unionByName(kinds), "name", ("kind",))


@query(f"SELECT DISTINCT {_sql_norm('name')} AS name FROM {_SQL_FOUND} WHERE {_sql_norm('name')} <> ''")
def track_predictions(spark: SparkSession, d: str) -> DataFrame:
    return tracked_names(_found(spark, d), "name")


# ---- filings


@query("SELECT c.* FROM filing_catalog c SEMI JOIN (SELECT CAST(cik AS VARCHAR) AS cik FROM interested_cik) i ON c.cik = i.cik")
def semi_join_catalog(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "filing_catalog")
    return interesting(c, table(spark, d, "interested_cik")).select(*c.columns)


_SQL_PATH = "CASE WHEN coalesce(idx_filename, '') <> '' THEN idx_filename WHEN coalesce(cik, '') <> '' AND coalesce(accession_number, '') <> '' THEN 'edgar/data/' || cik || '/' || accession_number || '.txt' END"


@query(rf"""SELECT nullif(regexp_extract(p, 'edgar/data/(\d+)/(.+)\.txt', 1), '') AS cik, nullif(regexp_extract(p, 'edgar/data/(\d+)/(.+)\.txt', 2), '') AS accession_number, p AS idx_filename,
  f || '/' || replace(n, '-', '') || '/' || n || '-index.html' AS index_html_path, replace(f || '/' || replace(n, '-', '') || '/' || n || '-index.html', '-index.html', '-index-headers.html') AS index_headers_path
FROM (SELECT p, regexp_extract(p, '^(.*)/[^/]*$', 1) AS f, replace(regexp_extract(p, '([^/]*)$', 1), '.txt', '') AS n FROM (SELECT {_SQL_PATH} AS p FROM filing_catalog))""")
def filing_paths(spark: SparkSession, d: str) -> DataFrame:
    return resolved(table(spark, d, "filing_catalog"))


@query(r"""SELECT form_type, left(nullif(regexp_extract(idx_filename, '-(\d\d)-', 1), ''), 2) AS year, count(*) AS filings,
  count(DISTINCT nullif(regexp_extract(idx_filename, 'edgar/data/(\d+)/(.+)\.txt', 1), '')) AS ciks FROM filing_catalog GROUP BY ALL""")
def catalog_summary(spark: SparkSession, d: str) -> DataFrame:
    year = F.regexp_extract("idx_filename", r"-(\d\d)-", 1)
    cik, _ = filing_key(F.col("idx_filename"))
    c = table(spark, d, "filing_catalog").select("form_type", F.when(year != "", year).alias("year"), cik)
    return c.groupBy("form_type", "year").agg(F.count(F.lit(1)).alias("filings"), F.countDistinct("cik").alias("ciks"))


@query("SELECT chunked_id, 'filing ' || coalesce(cik, 'null') || '/' || coalesce(accession_number, 'null') || ': ' || coalesce(len(html_pages), 0) || ' documents' AS shown FROM chunked_document")
def filing_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunked_document").select("chunked_id", shown(F.col("cik"), F.col("accession_number"), F.col("html_pages")).alias("shown"))


