"""Queries over what the tables do not hold as such: stored files, index pages, whole HTML bodies.

Each builds its input from the tables by plain rules, which SQL can repeat,
and sends it through the same operators that serve landed filings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.providers import from_model
from folioforge.functions.text import needs_sentences, sanitized
from folioforge.operators.chunking import content_lines, proportional_sentences
from folioforge.operators.extraction import Extractor
from folioforge.operators.filings import bodies, filing_index, interesting, resolved
from folioforge.operators.generic import DEFAULT_PATTERNS, GenericNames
from folioforge.operators.html import break_stats, html_text_udf, split_documents
from folioforge.operators.tags import MONEY, PERSON, tagged
from folioforge.plans.catalog import (
    ORACLE, _SQL_EMPTY, _SQL_FOUND, _SQL_GENERIC, _SQL_SENT, _WS, _found, _sql_chunks, _sql_context, _sql_norm, _sql_sanitized, _sql_sentences, _sql_strip, query,
)
from folioforge.plans.pipelines import chunked_documents, extracts_of
from folioforge.runtime import scratch_path, table
from folioforge.sources.documents import (
    CHUNKED, document_key, extracts_as_json, extracts_from_json, read_catalog, read_chunked, read_ciks, write_chunked, write_predictions,
)
from folioforge.sources.fetch import fetch_missing
from folioforge.sources.storage import Store, chosen_prefix, missing

_NAMES = "array_to_string(list_filter(entity_names_found, lambda n: n IS NOT NULL), '; ')"


# ---- sources and sinks


@query("SELECT c.* FROM filing_catalog c SEMI JOIN (SELECT CAST(cik AS VARCHAR) AS cik FROM interested_cik) i ON c.cik = i.cik")
def catalog_scan(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue and a CSV list of ciks through their readers, with their least row counts."""
    path = scratch_path(spark, "ciks")
    table(spark, d, "interested_cik").select("cik").write.csv(path, header=True)
    catalog = read_catalog(spark, f"{d}/filing_catalog.parquet", least=10)
    return interesting(catalog, read_ciks(spark, path, least=10)).select(*catalog.columns)


@query("""SELECT concat_ws('/', cik, accession_number) AS document_key, date_filed, CAST(len(html_pages) AS INTEGER) AS pages, array_to_string(list_filter(text_chunks, lambda x: x IS NOT NULL), chr(10)) AS text,
  array_to_string(list_filter(text_chunk_refs, lambda x: x IS NOT NULL), ' ') AS refs FROM chunked_document WHERE accession_number IS NOT NULL""")
def stored_documents(spark: SparkSession, d: str) -> DataFrame:
    """Chunked documents written as JSON files by cik and read again."""
    path = scratch_path(spark, "chunked")
    write_chunked(table(spark, d, "chunked_document").select(*(c.split(" ")[0] for c in CHUNKED.split(", "))), path)
    refs = F.array_join(F.transform("text_chunk_refs", lambda r: r.cast("string")), " ")
    pages = F.when(F.col("html_pages").isNotNull(), F.size("html_pages"))
    return read_chunked(spark, path).select(document_key(), "date_filed", pages.alias("pages"), F.array_join("text_chunks", "\n").alias("text"), refs.alias("refs"))


@query(f"SELECT text, context_type, {_NAMES} AS names, chunk_index, sentence_index, document_key, quality_score FROM extracted_text")
def extraction_json(spark: SparkSession, d: str) -> DataFrame:
    """Extracts written as one JSON array for each document and read again."""
    back = extracts_from_json(extracts_as_json(table(spark, d, "extracted_text")))
    return back.select("text", "context_type", F.array_join("entity_names_found", "; ").alias("names"), "chunk_index", "sentence_index", "document_key", "quality_score")


@query(f"SELECT DISTINCT {_sql_norm('name')} AS name FROM {_SQL_FOUND} WHERE {_sql_norm('name')} <> ''")
def stored_predictions(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    write_predictions(_found(spark, d), "name", path)
    return spark.read.text(path).select(F.col("value").alias("name"))


@query("""SELECT 'nation/' || n_nationkey || '.txt' AS path, CASE WHEN n_regionkey <> 0 THEN n_name END AS content, CASE WHEN n_regionkey <> 0 THEN n_name END AS read_alone, n_regionkey = 0 AS is_missing FROM nation""")
def stored_objects(spark: SparkSession, d: str) -> DataFrame:
    """The nations as objects of a store: written, some deleted, read together and one by one, the missing ones told."""
    store = Store(spark, chosen_prefix({"STORAGE_PREFIX": "", "CACHE_PREFIX": scratch_path(spark, "store")}))
    nations = [(f"nation/{r.n_nationkey}.txt", r.n_name, r.n_regionkey) for r in table(spark, d, "nation").collect()]
    for path, name, _ in nations:
        store.write(path, name.encode())
    for path, _, region in nations:
        if region == 0 and not store.delete(path):
            raise OSError(path)
    alone = [(path, None if (found := store.read(path)) is None else found.decode()) for path, _, _ in nations]
    wanted = spark.createDataFrame(alone, "path string, read_alone string")
    files = store.files("*.txt")
    gone = missing(wanted, files).select("path", F.lit(True).alias("is_missing"))
    return wanted.join(files, "path", "left").join(gone, "path", "left").select("path", "content", "read_alone", F.coalesce("is_missing", F.lit(False)).alias("is_missing"))


def _answer(url: str, headers: dict[str, str]) -> tuple[int, str]:
    """A transport for tests of reading through: it knows no path of the year 12."""
    return (404, "") if "-12-" in url else (200, f"fetched {url}")


@query(r"""WITH p AS (SELECT idx_filename AS path, max(form_type = '485BPOS') AS landed FROM filing_catalog WHERE idx_filename IS NOT NULL AND idx_filename <> '' GROUP BY idx_filename)
SELECT path, CASE WHEN coalesce(landed, false) THEN 'landed' WHEN NOT contains(path, '-12-') THEN 'fetched base/' || path END AS content FROM p""")
def read_through(spark: SparkSession, d: str) -> DataFrame:
    """Landed objects, and the missing ones fetched."""
    paths = table(spark, d, "filing_catalog").select(F.col("idx_filename").alias("path"), "form_type").where(F.col("path") != "")
    landed = paths.where(F.col("form_type") == "485BPOS").select("path").distinct().withColumn("content", F.lit("landed"))
    fetched = fetch_missing(missing(paths.select("path").distinct(), landed), "base", "folioforge", get=_answer)
    return landed.unionByName(fetched)


# ---- index pages and bodies

# A filing is HTML if a row of it has pages, else text.  Filings whose cik ends
# in 7 have no index page, text filings whose cik ends in 3 one without a table.
_FILINGS = """filings AS (
  SELECT cik, accession_number, min(date_filed) AS day, max(coalesce(len(html_pages), 0)) AS n, min_by(text_chunks, chunked_id) AS chunks
  FROM chunked_document WHERE cik IS NOT NULL AND accession_number IS NOT NULL GROUP BY cik, accession_number)"""
_DAY = "CASE WHEN length(regexp_replace(day, '[^0-9]+', '', 'g')) = 8 THEN regexp_replace(regexp_replace(day, '[^0-9]+', '', 'g'), '(....)(..)(..)', '\\1-\\2-\\3') ELSE '' END"


def _filings(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "chunked_document").where(F.col("cik").isNotNull() & F.col("accession_number").isNotNull())
    pages = F.greatest(F.coalesce(F.size("html_pages"), F.lit(0)), F.lit(0))
    return rows.groupBy("cik", "accession_number").agg(F.min("date_filed").alias("day"), F.max(pages).alias("n"), F.min_by("text_chunks", "chunked_id").alias("chunks"))


def _escaped(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def _index_page(filings: DataFrame) -> DataFrame:
    """(path, content) of index pages of both forms."""
    def entry(kind: Column, no: Column, name: Column) -> Column:
        return F.concat(F.lit("<DOCUMENT>\n<TYPE>"), kind, F.lit("\n<SEQUENCE>"), no, F.lit("\n<FILENAME>"), name, F.lit("\n<DESCRIPTION>of a filing\n<TEXT>\n</DOCUMENT>\n"))

    extra = F.transform(F.sequence(F.lit(1), F.col("n")), lambda k: entry(F.concat(F.lit("EX-"), k), (k + 1).cast("string"), F.concat(F.lit("ex"), k, F.lit(".txt"))))
    day = F.regexp_replace("day", "[^0-9]+", "")
    sgml = F.concat(F.lit("<SEC-HEADER>\nFILED AS OF DATE:\t\t"), day, F.lit("\n</SEC-HEADER>\n"), entry(F.lit("485BPOS"), F.lit("1"), F.lit("main.htm")), F.array_join(extra, ""))
    headers = F.concat(F.lit("<html><!-- <SEC-HEADER> FILED AS OF DATE: 19990101 --><body><pre>"), _escaped(sgml), F.lit("</pre></body></html>"))
    filed = F.concat(F.lit('<div class="formGrouping"><div class="infoHead">Filing Date</div><div class="info"> '), F.coalesce("day", F.lit("")), F.lit(" </div></div>"))
    rows = '<tr><th>Seq</th></tr><tr><td>1</td><td>body</td><td><a href="x">file001.txt</a></td><td>485BPOS</td><td>9</td></tr><tr><td>&nbsp;</td><td>all</td><td><a>full.txt</a></td><td>&nbsp;</td><td>9</td></tr>'
    documents = F.when(F.col("cik").endswith("3"), F.lit("")).otherwise(F.lit(f'<table class="tableFile">{rows}</table>'))
    html = F.col("n") > 0
    with_page = filings.where(~F.col("cik").endswith("7"))
    return with_page.select(F.when(html, F.col("index_headers_path")).otherwise(F.col("index_html_path")).alias("path"), F.when(html, headers).otherwise(F.concat(filed, documents)).alias("content"))


def _resolved(spark: SparkSession, d: str) -> DataFrame:
    f = _filings(spark, d)
    named = resolved(f.select("cik", "accession_number", F.lit(None).cast("string").alias("idx_filename")), strict=True)
    return f.join(named, ["cik", "accession_number"])


@query(f"""WITH {_FILINGS}
SELECT cik, accession_number, CASE WHEN cik LIKE '%7' THEN '' WHEN n > 0 THEN {_DAY} ELSE trim(coalesce(day, '')) END AS date_filed,
  CASE WHEN cik LIKE '%7' THEN '' WHEN n > 0 THEN array_to_string(list_concat(['485BPOS 1 main.htm'], list_transform(range(1, n + 1), lambda k: 'EX-' || k || ' ' || (k + 1) || ' ex' || k || '.txt')), '; ')
       WHEN cik NOT LIKE '%3' THEN '485BPOS 1 file001.txt; - - full.txt' END AS documents FROM filings""")
def filing_indexes(spark: SparkSession, d: str) -> DataFrame:
    """Index pages of all filings, parsed: headers pages, legacy pages, pages without a table, no page."""
    f = _resolved(spark, d)
    index = filing_index(f.drop("day", "chunks"), _index_page(f))
    dash = F.lit("-")
    shown = F.array_join(F.transform("documents", lambda x: F.concat_ws(" ", F.coalesce(x["type"], dash), F.coalesce(x["sequence"], dash), x["filename"])), "; ")
    return index.select("cik", "accession_number", "date_filed", shown.alias("documents"))


def _bodies(f: DataFrame) -> DataFrame:
    """(path, content) of the bodies: chunks as pages between rules, or as plain text."""
    folder = F.regexp_extract("index_headers_path", r"^(.*)/[^/]*$", 1)
    pages = F.array_join(F.transform("chunks", lambda c: F.concat(F.lit("<p>"), _escaped(F.coalesce(c, F.lit(""))), F.lit("</p>"))), "<hr/>")
    text = F.array_join(F.filter("chunks", lambda c: c.isNotNull()), "\n\n")
    html = F.col("n") > 0
    main = f.select(F.concat(folder, F.when(html, F.lit("/main.htm")).otherwise(F.lit("/file001.txt"))).alias("path"), F.when(html, pages).otherwise(text).alias("content"))
    # an attachment beside the body is of another type and is not read
    return main.unionByName(f.where(html).select(F.concat(folder, F.lit("/ex1.txt")).alias("path"), F.lit("an exhibit").alias("content")))


_HAS_INDEX = "cik NOT LIKE '%7' AND (n > 0 OR cik NOT LIKE '%3')"
_SQL_ESC = "replace(replace(replace(coalesce(c, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(f"""WITH {_FILINGS}
SELECT * FROM (SELECT cik, accession_number, 0 AS body_no, 'edgar/data/' || cik || '/' || replace(accession_number, '-', '') || CASE WHEN n > 0 THEN '/main.htm' ELSE '/file001.txt' END AS path,
  CASE WHEN n > 0 THEN array_to_string(list_transform(chunks, lambda c: '<p>' || {_SQL_ESC} || '</p>'), '<hr/>') ELSE array_to_string(list_filter(chunks, lambda c: c IS NOT NULL), chr(10) || chr(10)) END AS content
FROM filings WHERE {_HAS_INDEX}) WHERE length(content) > 0""")
def filing_bodies(spark: SparkSession, d: str) -> DataFrame:
    """The bodies of the filings that have an index, found by type and suffix."""
    f = _resolved(spark, d)
    index = filing_index(f.drop("day", "chunks"), _index_page(f)).where(F.size("documents") > 0)
    return bodies(index, _bodies(f), "485BPOS", ["htm", "txt"], ["cik", "accession_number"], strict=True)


_PAGE_TEXT = _sql_strip("regexp_replace(regexp_replace(c, '[ \\t\\r\\n\\f]+', ' ', 'g'), '[ \\t]{2,}', ' ', 'g')")


@query(f"""WITH RECURSIVE {_FILINGS},
kept AS (SELECT *, cik || '/' || accession_number AS id FROM filings WHERE {_HAS_INDEX}),
pages AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY k) - 1 AS page_no, c, {_PAGE_TEXT} AS text FROM (SELECT id, k, coalesce(chunks[k], '') AS c FROM (SELECT id, chunks, unnest(range(1, len(chunks) + 1)) AS k FROM kept WHERE n > 0))
  WHERE {_sql_strip("c")} <> ''),
body AS (SELECT id || '#' || lpad(CAST(page_no AS VARCHAR), 6, '0') AS id, text FROM pages UNION ALL SELECT id || '#text', array_to_string(list_filter(chunks, lambda c: c IS NOT NULL), chr(10) || chr(10)) FROM kept WHERE n = 0),
{_sql_chunks('body')},
counted AS (SELECT id, count(*) AS n_pages FROM pages GROUP BY id)
SELECT f.cik, f.accession_number, CASE WHEN f.n > 0 THEN {_DAY} ELSE trim(coalesce(f.day, '')) END AS date_filed, CAST(coalesce(p.n_pages, 0) AS INTEGER) AS pages,
  CAST(row_number() OVER (PARTITION BY f.id ORDER BY c.id, c.chunk_no) - 1 AS INTEGER) AS chunk_no, CASE WHEN f.n > 0 THEN CAST(split_part(c.id, '#', 2) AS INTEGER) END AS page_no, c.chunk
FROM chunks c JOIN kept f ON f.id = split_part(c.id, '#', 1) LEFT JOIN counted p ON p.id = f.id""")
def built_filings(spark: SparkSession, d: str) -> DataFrame:
    """From index pages and bodies to chunked documents, HTML and text filings alike; one row for each chunk."""
    f = _resolved(spark, d)
    index = filing_index(f.drop("day", "chunks"), _index_page(f))
    docs = chunked_documents(index, _bodies(f))
    rows = docs.select("cik", "accession_number", "date_filed", F.size("html_pages").alias("pages"), "text_chunk_refs", F.posexplode("text_chunks").alias("chunk_no", "chunk"))
    return rows.select("cik", "accession_number", "date_filed", "pages", "chunk_no", F.get("text_chunk_refs", F.col("chunk_no")).alias("page_no"), "chunk")


# ---- HTML

_RULED = '<div style="width: 100%"><div style="border-top: 1px solid"></div></div>'
_HIDDEN = '<div style="display: none">not shown</div><!-- a note -->'
#: How chunk k begins, by k modulo 5: what stands before its text and after it.
_BREAKS = [
    ("<hr/><p>", "</p>"), ('<p style="page-break-before: always">', "</p>"), ('<div style="page-break-after: avoid"><p>', "</p></div>"),
    ('<div style="break-before: page"><p>', "</p></div>"), (_RULED + "<p>", "</p>"),
]


def _chunk_list(spark: SparkSession, d: str) -> DataFrame:
    kept = F.filter(F.coalesce("text_chunks", F.array().cast("array<string>")), lambda c: ~c.rlike(f"^{_WS}*$"))
    return table(spark, d, "chunked_document").select("chunked_id", kept.alias("_c"))


def _built_pages(spark: SparkSession, d: str) -> DataFrame:
    heads, tails = (F.array(*(F.lit(b[k]) for b in _BREAKS)) for k in (0, 1))

    def page(c: Column, k: Column) -> Column:
        head = F.when(k == 0, F.lit(_HIDDEN + "<p>")).otherwise(F.get(heads, k % 5))
        return F.concat(head, _escaped(c), F.when(k == 0, F.lit("</p>")).otherwise(F.get(tails, k % 5)))

    return _chunk_list(spark, d).select("chunked_id", F.array_join(F.transform("_c", page), "").alias("content"))


_SQL_LIST = f"SELECT chunked_id, list_filter(coalesce(text_chunks, []), lambda c: c IS NOT NULL AND NOT regexp_matches(c, '^{_WS}*$')) AS cs FROM chunked_document"
_HEADS = "[" + ", ".join("'" + h.removeprefix("<hr/>") + "'" for h, _ in _BREAKS) + "]"
_TAILS = "[" + ", ".join(f"'{t}'" for _, t in _BREAKS) + "]"


@query(f"""WITH lists AS ({_SQL_LIST}),
each_chunk AS (SELECT chunked_id, len(cs) AS n, k, cs[k + 1] AS c FROM (SELECT chunked_id, cs, unnest(range(0, len(cs))) AS k FROM lists))
SELECT chunked_id, CAST(k AS INTEGER) AS page_no, CASE WHEN n = 1 THEN '{_HIDDEN}<p>' ELSE CASE WHEN k = 0 THEN '<p>' ELSE {_HEADS}[k % 5 + 1] END END || {_SQL_ESC}
  || CASE WHEN k = 0 THEN '</p>' ELSE {_TAILS}[k % 5 + 1] END AS page FROM each_chunk
UNION ALL SELECT chunked_id, 0, '' FROM lists WHERE len(cs) = 0""")
def split_built_pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents with every kind of break, a hidden part and comments, split into their pages."""
    return split_documents(_built_pages(spark, d), ["chunked_id"], "content")


_KINDS = ["hr", "page-break-before", "page-break-after", "break-before: page"]


@query(f"""WITH lists AS ({_SQL_LIST}),
found AS (SELECT chunked_id, {"[" + ", ".join(f"'{k}'" for k in _KINDS) + ", NULL]"}[k % 5 + 1] AS selector FROM (SELECT chunked_id, unnest(range(1, len(cs))) AS k FROM lists))
SELECT selector, count(DISTINCT chunked_id) AS filings, count(*) AS elements FROM found WHERE selector IS NOT NULL GROUP BY selector""")
def built_break_stats(spark: SparkSession, d: str) -> DataFrame:
    return break_stats(_built_pages(spark, d), "chunked_id", "content")


@query(f"""SELECT entity_id, '## ' || n || chr(10) || chr(10) || 'See [' || n || '](#f' || entity_id || ') of ' || kind || chr(10) || chr(10) || '  * ' || kind || chr(10) || '  * ' || n || chr(10) || chr(10)
  || 'Name | Kind' || chr(10) || n || ' | ' || kind AS text FROM (SELECT entity_id, kind, {_sql_strip("regexp_replace(name, '[ \\t\\r\\n\\f]+', ' ', 'g')")} AS n FROM entity_name)""")
def built_page_text(spark: SparkSession, d: str) -> DataFrame:
    """Headings, links, emphasis, images, lists and tables of built pages, as text."""
    n, k = _escaped(F.col("name")), F.col("kind")
    page = F.concat(
        F.lit('<html><head><title>t</title></head><body><div style="display:none">x</div><h2>'), n, F.lit('</h2><p>See\n <a href="#f'), F.col("entity_id"), F.lit('">'), n, F.lit("</a> <b>of</b> "), k,
        F.lit('<img src="i.png"/></p><ul><li>'), k, F.lit("</li><li>"), n, F.lit("</li></ul><table><tr><th>Name</th><th>Kind</th></tr><tr><td>"), n, F.lit("</td><td>"), k, F.lit("</td></tr></table></body></html>"),
    )
    return table(spark, d, "entity_name").select("entity_id", html_text_udf(page).alias("text"))


# ---- sentences, extracts, generic names


@query(f"""WITH lines AS (SELECT doc_id, ln, {_sql_strip("parts[ln]")} AS s FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS ln FROM (SELECT doc_id, string_split({_sql_sanitized("text")}, chr(10)) AS parts FROM documents))),
kept AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS i, s FROM lines WHERE NOT {_SQL_EMPTY} AND {_SQL_SENT}),
batch AS (SELECT doc_id, {_sql_sentences("string_agg(s, chr(10) ORDER BY i)")} AS found, sum(length(s)) AS total FROM kept GROUP BY doc_id),
shares AS (SELECT k.doc_id, k.i, k.s, b.found, CAST(greatest(floor(CAST(len(b.found) * length(k.s) AS DOUBLE) / b.total), 1) AS BIGINT) AS share FROM kept k JOIN batch b USING (doc_id)),
starts AS (SELECT *, sum(share) OVER (PARTITION BY doc_id ORDER BY i) - share AS start FROM shares)
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, array_to_string(CASE WHEN start >= len(found) THEN [s] ELSE found[start + 1 : start + share] END, ' / ') AS sentences FROM starts""")
def batch_sentences(spark: SparkSession, d: str) -> DataFrame:
    """The long lines of each document split as one text, the sentences dealt out by length."""
    docs = table(spark, d, "documents").select("doc_id", F.filter(content_lines(sanitized(F.col("text"))), needs_sentences).alias("_lines"))
    dealt = docs.where(F.size("_lines") > 0).select("doc_id", F.posexplode(proportional_sentences(F.col("_lines"))).alias("line_no", "_s"))
    return dealt.select("doc_id", "line_no", F.array_join("_s", " / ").alias("sentences"))


@query(rf"""WITH chunked AS (SELECT chunked_id, concat_ws('/', cik, accession_number) AS document_key, k - 1 AS chunk_index, text_chunks[k] AS c, chunk_tags[k] AS tag
  FROM (SELECT *, unnest(range(1, len(text_chunks) + 1)) AS k FROM chunked_document) WHERE text_chunks[k] IS NOT NULL),
lists AS (SELECT *, {_sql_sentences("c")} AS sents, list_transform(string_split_regex(c, '\n{_WS}*\n'), lambda x: {_sql_strip("x")}) AS paras FROM chunked),
units AS (
  SELECT *, k - 1 AS sentence_index, sents[k] AS text FROM (SELECT *, unnest(range(1, len(sents) + 1)) AS k FROM lists) WHERE length(sents[k]) >= 20
  UNION ALL SELECT *, -1, paras[k] FROM (SELECT *, unnest(range(1, len(paras) + 1)) AS k FROM lists) WHERE length(paras[k]) >= 50),
hits AS (SELECT u.chunked_id, u.document_key, u.chunk_index, u.k, u.sentence_index, u.text, u.tag, list(n.name ORDER BY n.name) AS names
  FROM units u JOIN entity_name n ON contains(lower(u.text), lower(n.name)) GROUP BY ALL)
SELECT document_key, CAST(chunk_index AS INTEGER) AS chunk_index, CAST(sentence_index AS INTEGER) AS sentence_index, text, {_sql_context("text", "names", "tag")} AS context_type,
  array_to_string(names, '; ') AS names, CAST(0 AS DOUBLE) AS quality_score FROM hits""")
def extracted_segments(spark: SparkSession, d: str) -> DataFrame:
    """Sentences and paragraphs of all chunks that hold a reference name, with the chunks' tags."""
    names = sorted(r.name for r in table(spark, d, "entity_name").select("name").collect())  # a fixed table
    units = extracts_of(table(spark, d, "chunked_document"), Extractor(tuple(names)))
    return units.select("document_key", "chunk_index", "sentence_index", "text", "context_type", F.array_join("entity_names_found", "; ").alias("names"), "quality_score")


def _amounts():
    """A model for money, loaded by the workers."""
    import regex

    return regex.compile(MONEY).findall


def _persons():
    import regex

    title = regex.compile(r"^(?:Mr|Mrs|Ms|Dr|Prof)\.?\s+")
    person = regex.compile(PERSON)
    return lambda text: [title.sub("", p) for p in person.findall(text)]


@query(ORACLE["tag_entities"])
def tag_with_models(spark: SparkSession, d: str) -> DataFrame:
    """The tags of all documents with persons and money from models that each worker loads once."""
    return tagged(table(spark, d, "documents"), ["doc_id"], "text", persons=from_model("persons", _persons), money=from_model("amounts", _amounts))


_CHANGED = sorted((DEFAULT_PATTERNS | {"kestastitane series trust", "core"}) - {"bond fund"})


@query(f"""SELECT DISTINCT name FROM (SELECT name, {_sql_norm('name')} AS n FROM {_SQL_FOUND} UNION ALL SELECT name, {_sql_norm('name')} FROM entity_name UNION ALL SELECT p_name, {_sql_norm('p_name')} FROM part UNION ALL SELECT 'Bond Fund', 'bond fund' UNION ALL SELECT 'Money Fund', 'money fund')
WHERE NOT {_SQL_GENERIC[: _SQL_GENERIC.index('n IN (')]}n IN ({", ".join(f"'{p}'" for p in _CHANGED)}))""")
def changed_patterns(spark: SparkSession, d: str) -> DataFrame:
    """Distinct specific names under a pattern set with some added and one removed."""
    fewer, was_there = GenericNames(DEFAULT_PATTERNS).plus(spark, " Kestastitane  SERIES Trust").plus(spark, "core").minus(spark, "Bond Fund")
    if not was_there:
        raise ValueError("a default pattern is missing")
    more = spark.createDataFrame([("Bond Fund",), ("Money Fund",)], "name string")
    names = _found(spark, d).select("name").unionByName(table(spark, d, "entity_name").select("name")).unionByName(table(spark, d, "part").select(F.col("p_name").alias("name")))
    return fewer.specific_names(names.unionByName(more), "name")
