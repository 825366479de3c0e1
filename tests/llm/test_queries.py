"""Every training-data query over empty tables, and over tables with a row of nulls."""

import pytest

from folioforge.llm.queries import QUERIES

TABLES = {
    "chunked_document": "chunked_id bigint, cik string, accession_number string, date_filed string, html_pages array<string>, text_chunks array<string>, "
    "text_chunk_refs array<int>, chunk_tags array<map<string,boolean>>, loaded_at timestamp",
    "extracted_text": "extract_id bigint, document_key string, cik string, text string, context_type string, entity_names_found array<string>, chunk_index int, "
    "sentence_index int, quality_score double, extracted_at timestamp",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint, cik string, form_type string, date_filed string, fetched_at timestamp",
    "eval_item": "item_id bigint, task string, text string",
    "entity_name": "entity_id bigint, name string, cik string, kind string",
}
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
ROWS = {
    "chunked_document": [(None,) * 9, (1, "c", "a", "d", ["<p>x</p>", None], [WORDS, None, ""], [0, 0, None], None, None)],
    "extracted_text": [(None,) * 10, (1, "c/a", "c", WORDS + ".", "narrative", ["N", None], 0, -1, None, None), (2, "c/b", "c", None, "narrative", None, 0, -1, None, None)],
    "documents": [(None,) * 9, (1, WORDS, "en", None, None, None, None, None, None), (2, None, None, None, None, None, None, None, None)],
    "eval_item": [(None, None, None), (1, "t", WORDS), (2, "t", None)],
    "entity_name": [(None, None, None, None), (1, "Some Fund", "c", "Fund"), (2, None, None, None)],
}


@pytest.fixture(scope="module", params=["empty", "nulls"])
def folder(request, spark, tmp_path_factory):
    base = tmp_path_factory.mktemp(request.param)
    for name, schema in TABLES.items():
        rows = ROWS[name] if request.param == "nulls" else []
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return request.param, str(base)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_runs(spark, folder, name):
    kind, base = folder
    rows = QUERIES[name](spark, base).collect()
    if kind == "empty":
        assert rows == []
    if kind == "nulls" and name == "p9_found":
        assert [tuple(r) for r in rows] == [(1, 1)]
    if kind == "nulls" and name == "p8_ids":
        assert {r.doc_id: len(r.ids) for r in rows} == {None: 0, 1: 14, 2: 0}


def test_last_sentence_needs_no_mark(spark, tmp_path):
    texts = ["One is here. Two has no mark", "All of it without one", "One is here. 12 --"]
    rows = [(k, "c/a", "c", t, "narrative", None, 0, -1, None, None) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, TABLES["extracted_text"]).write.parquet(f"{tmp_path}/extracted_text.parquet")
    got = {tuple(r) for r in QUERIES["p4_found"](spark, str(tmp_path)).collect()}
    assert got == {(0, 0, 12), (0, 13, 28), (1, 0, 21), (2, 0, 12)}
