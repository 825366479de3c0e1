"""SQL counterparts of the queries that SQL can express, for DuckDB."""

_BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\pZ]"

_LINES = rf"""
lines AS (
  SELECT chunked_id, cik, accession_number, chunk_no, ln - 1 AS line_no,
         regexp_replace(lower(trim(regexp_replace(parts[ln], '{_BLANK}+', ' ', 'g'))), '\p{{Nd}}+', '0', 'g') AS form,
         length(regexp_replace(parts[ln], '\PL+', '', 'g')) AS letters
  FROM (SELECT chunked_id, cik, accession_number, chunk_no, parts, unnest(range(1, len(parts) + 1)) AS ln
        FROM (SELECT chunked_id, cik, accession_number, c - 1 AS chunk_no, string_split(text_chunks[c], chr(10)) AS parts
              FROM (SELECT *, unnest(range(1, len(text_chunks) + 1)) AS c FROM chunked_document)
              WHERE text_chunks[c] IS NOT NULL))
  WHERE cik IS NOT NULL
),
repeated AS (
  SELECT l.cik, l.form FROM lines l
  JOIN (SELECT cik, count(DISTINCT accession_number) AS n FROM chunked_document GROUP BY cik) t ON t.cik = l.cik
  WHERE l.letters >= 15 GROUP BY l.cik, l.form, t.n
  HAVING count(DISTINCT l.accession_number) >= 5 AND 3 * count(DISTINCT l.accession_number) >= t.n
)"""

_WORDS = r"regexp_extract_all(lower({0}), '[\pL\pN]+')"

ORACLE: dict[str, str] = {
    "p1_found": f"""WITH {_LINES}
SELECT chunked_id, CAST(chunk_no AS INTEGER) AS chunk_no, CAST(line_no AS INTEGER) AS line_no
FROM lines WHERE letters >= 15 AND (cik, form) IN (SELECT cik, form FROM repeated)""",
    "p3_found": f"""WITH records AS (
  SELECT 'filing' AS record_kind, chunked_id AS id, accession_number AS origin, 0 AS least,
         {_WORDS.format("array_to_string(list_filter(text_chunks, lambda x: x IS NOT NULL AND x <> ''), chr(10))")} AS w
  FROM chunked_document
  UNION ALL
  SELECT 'extract', extract_id, document_key, 20, {_WORDS.format("text")} FROM extracted_text WHERE text IS NOT NULL
),
runs AS (
  SELECT DISTINCT record_kind, id, origin, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run
  FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM records WHERE len(w) >= greatest(least, 3))
),
sizes AS (SELECT record_kind, id, count(*) AS n FROM runs GROUP BY ALL),
common AS (
  SELECT a.record_kind, a.id AS id_a, b.id AS id_b, count(*) AS k FROM runs a
  JOIN runs b ON a.record_kind = b.record_kind AND a.run = b.run AND a.id < b.id AND a.origin IS DISTINCT FROM b.origin
  GROUP BY ALL
)
SELECT c.record_kind, c.id_a, c.id_b FROM common c
JOIN sizes x ON x.record_kind = c.record_kind AND x.id = c.id_a
JOIN sizes y ON y.record_kind = c.record_kind AND y.id = c.id_b
WHERE 10 * c.k >= 6 * (x.n + y.n - c.k)""",
    "p5_found": """SELECT 'chunk' AS item_kind, chunked_id, CAST(c - 1 AS INTEGER) AS item_no
FROM (SELECT chunked_id, text_chunks AS items, unnest(range(1, len(text_chunks) + 1)) AS c FROM chunked_document) WHERE length(items[c]) > 2000
UNION ALL
SELECT 'page', chunked_id, CAST(c - 1 AS INTEGER)
FROM (SELECT chunked_id, html_pages AS items, unnest(range(1, len(html_pages) + 1)) AS c FROM chunked_document) WHERE length(items[c]) > 8000""",
    "p9_found": f"""WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL),
e AS (SELECT item_id, {_WORDS.format("text")} AS w FROM eval_item WHERE text IS NOT NULL),
dr AS (SELECT doc_id, array_to_string(w[i:i + 12], ' ') AS run FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d)),
er AS (SELECT item_id, array_to_string(w[i:i + 12], ' ') AS run FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM e))
SELECT DISTINCT doc_id, item_id FROM dr JOIN er USING (run)""",
    "p10_found": """WITH win AS (
  SELECT doc_id, i - 1 AS a, substring(text, i, 240) AS s
  FROM (SELECT doc_id, text, unnest(range(1, length(text) - 238)) AS i FROM documents WHERE length(text) >= 240)
),
hit AS (SELECT doc_id, a FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(DISTINCT doc_id) > 1)),
grp AS (SELECT *, sum(CASE WHEN a - 240 <= p THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY a) AS g
        FROM (SELECT *, lag(a) OVER (PARTITION BY doc_id ORDER BY a) AS p FROM hit))
SELECT doc_id, CAST(min(a) AS INTEGER) AS start_pos, CAST(max(a) + 240 AS INTEGER) AS end_pos FROM grp GROUP BY doc_id, g""",
}
