"""Core operators: tables of cases, brute force and odd rows."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge.functions import similarity, text
from folioforge.operators import chunking, extraction, filings, generic, html, matching, tags
from folioforge.plans import pipelines
from folioforge.sources import documents, fetch, storage


def one(spark, expr, **cols):
    """The value of an expression over one row of given columns."""
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in cols.items()))
    return df.select(expr.alias("v")).first()["v"]


def values(spark, rows, schema, expr):
    return [r["v"] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema).select("i", expr.alias("v")).orderBy("i").collect()]


# ---- normal forms


def test_normal_names(spark):
    cases = {
        "  American  Growth\tFund ": "american growth fund", "American\r\nGrowth": "american growth", "S&P 500 Fund": "s&p 500 fund",
        "Fund (A), [B]; {C}?": "fund a b c", "Investor's T. Rowe-Price": "investor's t. rowe-price", "A–B—C": "a-b-c",
        "American Growth Fund": "american growth fund", "• Growth ▪ Fund": "growth fund", "Élan 株式 Fund": "élan 株式 fund", "": "", None: "", " 　 ": "",
    }
    assert values(spark, [(k,) for k in cases], "s string", text.normal_name(F.col("s"))) == list(cases.values())


def test_artifacts_and_meaning(spark):
    cases = {"Gro\u0000wth™ Fund®": "growth fund", "A|B【C】": "a b c", "○ Bond�": "bond", None: ""}
    assert values(spark, [(k,) for k in cases], "s string", text.without_artifacts(F.col("s"))) == list(cases.values())
    assert values(spark, [("ab",), ("abc",), (None,), ("!!!!",)], "s string", text.is_meaningful(F.col("s"))) == [False, True, False, False]


def test_sanitized(spark):
    cases = {
        "ﬁne  print\t x": "fine print x", "a‑b−c": "a-b-c", "x​y­z": "xyz", "Fee $ 100": "Fee $100", "☐ yes ® no": "yes no",
        "a \n\n\n b\r\nc": "a\nb\nc", "lone\rreturn": "lonereturn", None: "", "  ": "", "１２％": "12%",
    }
    assert values(spark, [(k,) for k in cases], "s string", text.sanitized(F.col("s"))) == list(cases.values())


def test_line_predicates(spark):
    empty = {"": True, "  ": True, "1.2": True, "a": True, "---|---": True, "12 34 56": True, "abc": False, "12 345": False, "Fund |": False}
    assert values(spark, [(k,) for k in empty], "s string", text.is_empty_line(F.col("s"))) == list(empty.values())
    rows = {"a | b": True, "|": False, " | ": False, "a |": True, "none": False}
    assert values(spark, [(k,) for k in rows], "s string", text.is_table_row(F.col("s"))) == list(rows.values())
    prose = "The fund invests in bonds. It also holds some cash at all times."
    long = {prose: True, prose.upper(): False, prose.replace(".", ","): False, "short. one": False, "| a | " + prose: False, "$$ %% ## !! ** (( )) && ^^ @@ -- ++ == .. ,, ;; a": False}
    assert values(spark, [(k,) for k in long], "s string", text.needs_sentences(F.col("s"))) == list(long.values())


def test_sentences(spark):
    s = "Dr. Smith left. He paid 3.5% in Jan. 2020! Was “it?” Yes, e.g. now."
    assert one(spark, text.sentences_of(F.col("s")), s=s) == ["Dr. Smith left.", "He paid 3.5% in Jan. 2020!", "Was “it?”", "Yes, e.g. now."]
    assert values(spark, [(None,), ("",)], "s string", F.size(text.sentences_of(F.col("s")))) == [0, 0]


# ---- matching

MATCHES = [
    ("Global Fund", "Leuthold Global Fund", 0.6, True, "substring"), ("American Growth Fund", "American Growth Mutual Fund", 0.6, True, "token_overlap"),
    ("American Growth", "American International Fund", 0.6, False, "no_match"), ("American Fund", "International Fund", 0.3, True, "token_overlap"),
    ("American Fund", "International Fund", 0.8, False, "no_match"), ("", "American Fund", 0.6, False, "no_match"), (None, "A", 0.6, False, "no_match"),
    ("A", "American Fund", 0.6, True, "substring"), ("AMERICAN  growth", "American Growth", 0.6, True, "exact"), ("   ", "x", 0.6, False, "no_match"),
    ("American Growth", "American International Fund", 0.25, True, "token_overlap"),
]


def test_match_types(spark):
    df = spark.createDataFrame([(i, p, e, t) for i, (p, e, t, _, _) in enumerate(MATCHES)], "i int, p string, e string, t double")
    got = df.select("i", similarity.names_match(F.col("p"), F.col("e"), F.col("t")).alias("m"), similarity.name_match_type(F.col("p"), F.col("e"), F.col("t")).alias("k")).orderBy("i").collect()
    assert [(r.m, r.k) for r in got] == [(m, k) for *_, m, k in MATCHES]


def test_scores(spark):
    rows = [("Fund A", "fund a"), ("Bond", "Bond Fund"), ("a b", "a c"), ("", "x"), (None, None), ("x", "y")]
    got = values(spark, rows, "p string, e string", similarity.name_score(F.col("p"), F.col("e")))
    assert got == pytest.approx([1.0, 0.8 + 0.2 * 4 / 9, 1 / 3, 0.0, 0.0, 0.0])


NAMES = ["Alpha Growth Fund", "Growth", "alpha growth fund", "Beta Bond Fund", "Bond Fund Beta", "B", "Gamma & Co.", "Delta Income Trust Series", "Income Trust", None, "", "Éta Fund"]


@pytest.mark.parametrize("threshold", [0.3, 0.6, 0.9])
def test_pairs_without_cross_join(spark, threshold):
    a = spark.createDataFrame([(n, 1) for n in NAMES], "predicted string, score int")
    b = spark.createDataFrame([(n,) for n in reversed(NAMES)], "expected string")
    both = a.select("predicted").distinct().crossJoin(b.distinct())
    kind = similarity.name_match_type(F.col("predicted"), F.col("expected"), threshold)
    want = {(r.predicted, r.expected, r.k) for r in both.select("predicted", "expected", kind.alias("k")).where("k <> 'no_match'").collect()}
    got = matching.name_pairs(a, b, threshold=threshold)
    assert {(r.predicted, r.expected, r.type) for r in got.collect() if r.type != "no_match"} == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_best_match_takes_the_first_of_ties(spark):
    e = spark.createDataFrame([("Bond Fund X", 2), ("Bond Fund Y", 1), ("Zed", 0)], "expected string, pos int")
    p = spark.createDataFrame([("Bond Fund",), ("nothing like it",), (None,)], "predicted string")
    got = {r.predicted: (r.best, round(r.score, 3)) for r in matching.best_matches(p, e, order_col="pos").collect()}
    assert got == {"Bond Fund": ("Bond Fund Y", 0.964), "nothing like it": (None, 0.0), None: (None, 0.0)}


def test_batch_match_is_greedy_in_order(spark):
    df = spark.createDataFrame(
        [(1, ["Fund", "Growth Fund", "Other"], ["Growth Fund", "Fund"]), (2, None, ["x"]), (3, [], []), (4, ["American Fund"], ["International Fund"])],
        "i int, p array<string>, e array<string>",
    )
    got = {r.i: r.m for r in df.select("i", matching.batch_match(F.col("p"), F.col("e")).alias("m")).collect()}
    assert [(m.predicted, m.expected, m.type) for m in got[1].matches] == [("Fund", "Growth Fund", "substring"), ("Growth Fund", "Fund", "substring")]
    assert (got[1].true_positives, got[1].false_positives, got[1].false_negatives) == (2, 1, 0)
    assert got[1].matched_predictions == [0, 1] and got[1].matched_expectations == [0, 1]
    assert (got[2].true_positives, got[2].false_positives, got[2].false_negatives) == (0, 0, 1)
    assert (got[3].true_positives, got[3].false_negatives) == (0, 0)
    low = df.where("i = 4").select(matching.batch_match(F.col("p"), F.col("e"), 0.3).alias("m")).first().m
    assert [m.type for m in low.matches] == ["no_match"] and low.true_positives == 1


def test_evaluation(spark):
    p = spark.createDataFrame([(1, "Alpha Fund"), (1, "alpha  fund"), (1, "Gamma Trust"), (1, "the fund"), (2, None)], "doc int, name string")
    e = spark.createDataFrame([(1, "Alpha Fund"), (1, "Beta Series"), (3, "Solo Trust")], "doc int, name string")
    got = {r.doc: tuple(r)[1:] for r in pipelines.evaluated(p, e, "doc", generic=generic.GenericNames()).collect()}
    assert got == {1: (1, 1, 1, 0.5, 0.5), 3: (0, 0, 1, 0.0, 0.0)}


# ---- generic names


def test_generic_names(spark):
    g = generic.GenericNames()
    assert len(g.patterns) == 67
    names = ["Money Market Fund", "the FUNDS", "abc", "Leuthold Global Fund", None, "", "Money Fund", "money funds", "S&P 500 Index Fund"]
    df = spark.createDataFrame([(n, 1) for n in names], "name string, total int")
    assert [r.name for r in g.specific(df, "name").collect()] == ["Leuthold Global Fund", "money funds", "S&P 500 Index Fund"]
    assert g.specific_names(df.union(df), "name").count() == 3
    assert tuple(g.stats(df, "name").first()) == (9, 6, 3, pytest.approx(6 / 9)) and tuple(g.stats(df.limit(0), "name").first()) == (0, 0, 0, 0.0)
    more = g.plus(spark, "  Leuthold GLOBAL Fund ")
    assert more.specific(df, "name").count() == 2 and g.plus(spark, " ") is g
    less, was = g.minus(spark, "Bond Fund")
    assert was and len(less.patterns) == 66 and g.minus(spark, "nothing")[1] is False
    assert generic.GenericNames(set()).patterns == g.patterns
    assert sorted(r.name for r in generic.tracked_names(df, "name").collect())[:2] == ["abc", "leuthold global fund"]


# ---- tags


def test_tags(spark):
    rows = [
        (1, "The portfolio manager and an Independent Trustee own $10,000 - $50,000 or over $100,000. None or none.", 0),
        (2, None, 0), (3, "", 0), (4, "Mr. John A. Smith met MR. JOHN A. SMITH and Dr. Jane Doe; $5 million, $5 million and $7.", 0),
    ]
    df = spark.createDataFrame(rows, "id int, text string, none_count int")
    got = {r.id: r.asDict() for r in tags.tagged(df, ["id"], "text").collect()}
    assert {k: got[1][k] for k in ("manager_count", "trustee_count", "range_count", "none_count")} == {"manager_count": 2, "trustee_count": 1, "range_count": 3, "none_count": 2}
    assert all(v == 0 for k, v in got[2].items() if k != "id") and got[3] == {**got[2], "id": 3}
    assert got[4]["money_count"] == 2 and got[4]["person_unique"] == 2


def test_unique_persons(spark):
    df = spark.createDataFrame([(["Jane Doe", "jane doe ", "|IBM|", "J", "Al Gore,", "ABCDEF"],)], "n array<string>")
    assert df.select(tags.unique_persons(F.col("n")).alias("v")).first().v == 3


# ---- chunking


def packed_by_hand(pieces, size):
    out, held, n = [], [], 0
    for p in pieces:
        if n + len(p) > size:
            out.append("\n\n".join(held))
            held, n = [p], len(p)
        else:
            held.append(p)
            n += len(p)
    return [*out, "\n\n".join(held)] if held else out


def test_packing(spark):
    cases = [["aaa", "bbbb", "cc", "d" * 12, "e"], [], ["x" * 20], ["a", "b", "c"], ["a" * 5, "b" * 5, "c"]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, p array<string>")
    got = [r.c for r in df.select("i", chunking.packed(F.col("p"), 10).alias("c")).orderBy("i").collect()]
    assert got == [packed_by_hand(c, 10) for c in cases]


def test_tables_stay_together(spark):
    rows = "\n".join(f"Fund {k} | {k}00 | {k}.5%" for k in range(1, 6))
    body = "Some introduction to the table that follows here.\n" * 30 + rows + "\nAfter the table there is more text to read, and it goes on. " * 40
    df = spark.createDataFrame([(1, body, 9), (2, None, 9), (3, "short", 9), (4, "x" * 100, 9), (5, "x" * 101, 9)], "id int, body string, chunk_no int")
    got = chunking.chunk_texts(df.drop("chunk_no"), ["id"], "body", 500).orderBy("id", "chunk_no").collect()
    assert {r.id for r in got} == {1, 5} and sum("Fund 1 |" in r.chunk for r in got) == 1
    with_table = next(r.chunk for r in got if "Fund 1 |" in r.chunk)
    assert rows in with_table


def test_proportional_sentences(spark):
    df = spark.createDataFrame([(["One is. Two is.", "Three is. Four i."],), (["A", "B", "C"],), ([],)], "l array<string>")
    got = [r.s for r in df.select(chunking.proportional_sentences(F.col("l")).alias("s")).collect()]
    assert got[0] == [["One is."], ["Two is.", "Three is."]] and got[1] == [["A\nB\nC"], ["B"], ["C"]] and got[2] == []


def test_faithful_slices_and_whole_lines(spark):
    """Long lines of one run share its sentences by length and can lose some; line by line none is lost."""
    one = "A first sentence of some length stands here. A second one follows it. A third. A fourth one ends the line here."
    two = "Only a single sentence stands in this line, and it is about as long as the other line is, or nearly so here."
    df = spark.createDataFrame([(1, one + "\n" + two), (2, "aaa | bbb\n" + one), (3, None)], "id int, body string")
    slices = {r.id: r.chunk for r in chunking.chunk_texts(df, ["id"], "body").collect()}
    lines = {r.id: r.chunk for r in chunking.chunk_texts(df, ["id"], "body", faithful=False).collect()}
    assert slices[1].split("\n\n") == ["A first sentence of some length stands here.", "A second one follows it.", "A third.", "A fourth one ends the line here."]
    assert lines[1].split("\n\n") == [*slices[1].split("\n\n"), two]
    assert slices[2] == lines[2] == "aaa | bbb\n\n" + slices[1]


def test_table_gaps():
    gap = "a | b\n\n\n\nsome content line\n\nshort\nc | d\ntail\n\n\nend"
    assert chunking.close_table_gaps(gap) == "a | b\n\nsome content line\n\nc | d\ntail\n\n\nend"
    assert chunking.close_table_gaps("a | b\n\n\nc | d") == "a | b\n\n\nc | d"
    assert chunking.close_table_gaps("a | b\nx\ny\nz\nc | d") == "a | b\n\nc | d"
    assert chunking.close_table_gaps("plain\n\n\n\ntext") == "plain\n\n\n\ntext"


def test_context_around_chunks(spark):
    df = spark.createDataFrame([(["abcdef", "ghi", "jklmno"],)], "c array<string>")
    got = lambda s, e=None, n=2, **k: df.select(chunking.chunk_with_context(F.col("c"), F.lit(s), None if e is None else F.lit(e), n, **k).alias("v")).first().v
    assert got(1) == "ef\n\nghi\n\njk" and got(0) == "abcdef\n\ngh" and got(2) == "hi\n\njklmno"
    assert got(0, 2) == "abcdef\n\nghi\n\njklmno" and got(3) is None and got(2, 1) is None and got(-1) is None
    assert got(1, n=0) == "abcdef\n\nghi\n\n" and got(1, n=0, faithful=False) == "\n\nghi\n\n"


# ---- HTML


def test_page_splitting():
    assert html.split_pages("<p>one<!-- c --></p>") == ["<p>one<!-- c --></p>"] and html.split_pages(None) == []
    page = '<html><body><div style="display: none">x</div><p>one</p><hr/><div><b>two</b><p style="page-break-after: avoid">three</p></div><!-- gone --><hr><hr></body></html>'
    got = html.split_pages(page)
    assert [html.html_text(p) for p in got] == ["one", "two", "three"]
    assert all("<!--" not in p and "<hr" not in p and "display" not in p for p in got)
    ruled = '<div style="width: 100%"><div style="border-top: 1px">&nbsp;</div></div>'
    assert len(html.split_pages(f"<p>a</p>{ruled}<p>b</p>")) == 2
    assert len(html.split_pages(f"<p>a</p>{ruled.replace('100%', '90%')}<p>b</p>")) == 1
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000 + "<hr>" + "x"
    assert len(html.split_pages(deep)) == 2


def test_html_text():
    page = '<h2>Top</h2><p>See <a href="#x">this</a> <b>bold</b> &amp; <img src="i"> more</p><table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>2</td></tr></table><ul><li>x</li></ul>'
    got = html.html_text(page)
    assert "## Top" in got and "See [this](#x) bold & more" in got and "a | b\n1 | 2" in got and "* x" in got
    assert html.html_text("") == "" and html.html_text(None) == ""


def test_lists_keep_their_layout():
    page = '<ul><li>a<ul><li>b</li></ul></li><li><a href="t">c</a></li></ul><ol><li>x</li><li>y</li></ol>'
    lines = [line for line in html.html_text(page).split("\n") if line]
    assert lines == ["* a", "    * b", "  * [c](t)", "  1. x", "  2. y"] or lines == ["  * a", "    * b", "  * [c](t)", "  1. x", "  2. y"]


def test_break_stats(spark):
    df = spark.createDataFrame([(1, "<hr><hr>"), (2, '<hr><p style="page-break-before: always">x</p>'), (3, None), (4, "")], "id int, page string")
    assert [tuple(r) for r in html.break_stats(df, "id", "page").collect()] == [("hr", 2, 3), ("page-break-before", 1, 1)]
    assert html.split_documents(df, ["id"], "page").count() == 2


# ---- filings

HEADERS = """<html><!-- <SEC-HEADER> FILED AS OF DATE: 20010101 --><pre>&lt;SEC-HEADER&gt;x
FILED AS OF DATE:		20240429
&lt;/SEC-HEADER&gt;
&lt;DOCUMENT&gt;
&lt;TYPE&gt;485BPOS
&lt;SEQUENCE&gt;1
&lt;FILENAME&gt;main.htm
&lt;DESCRIPTION&gt;BODY
&lt;TEXT&gt;
&lt;/DOCUMENT&gt;
&lt;DOCUMENT&gt;
&lt;TYPE&gt;EX-99
&lt;SEQUENCE&gt;2
&lt;FILENAME&gt;ex.txt
&lt;TEXT&gt;
&lt;/DOCUMENT&gt;</pre></html>"""
LEGACY = """<div class="infoHead">Filing Date</div><div class="info"> 2004-04-30 </div><table class="tableFile"><tr><th>Seq</th></tr>
<tr><td>1</td><td>d</td><td><a href="x">file001.txt</a></td><td>485BPOS</td><td>9</td></tr><tr><td>&nbsp;</td><td>all</td><td><a>full.txt</a></td><td>&nbsp;</td><td>1</td></tr>
<tr><td>2</td><td>no link</td><td></td><td>X</td><td>1</td></tr><tr><td>short</td></tr></table>"""


def test_filing_paths(spark):
    rows = [("edgar/data/12/0001-24-05.txt", None, None), (None, "34", "0002-24-06"), ("junk", None, None), (None, None, "x"), ("", "5", "a-b")]
    got = filings.resolved(spark.createDataFrame(rows, "idx_filename string, cik string, accession_number string")).collect()
    assert [(r.cik, r.accession_number) for r in got] == [("12", "0001-24-05"), ("34", "0002-24-06"), (None, None), (None, None), ("5", "a-b")]
    assert got[0].index_html_path == "edgar/data/12/00012405/0001-24-05-index.html" and got[0].index_headers_path.endswith("0001-24-05-index-headers.html")
    with pytest.raises(Exception, match="needs an index path"):
        filings.resolved(spark.createDataFrame(rows[3:4], "idx_filename string, cik string, accession_number string"), strict=True).collect()


def test_filing_index_and_bodies(spark):
    f = filings.resolved(spark.createDataFrame([("edgar/data/1/a-1.txt",), ("edgar/data/2/b-2.txt",), ("edgar/data/3/c-3.txt",)], "idx_filename string").withColumns({"cik": F.lit(None).cast("string"), "accession_number": F.lit(None).cast("string")}))
    body = "<p>" + "A sentence about the growth of the fund. " * 10 + "</p><hr/><p>" + "Another page tells of bonds and income. " * 10 + "</p>"
    files = spark.createDataFrame(
        [("edgar/data/1/a1/a-1-index-headers.html", HEADERS), ("edgar/data/2/b2/b-2-index.html", LEGACY), ("edgar/data/1/a1/main.htm", body), ("edgar/data/2/b2/file001.txt", "Plain text of a fund with many words. " * 20), ("edgar/data/1/a1/ex.txt", "")],
        "path string, content string",
    )
    index = filings.filing_index(f, files)
    got = {r.cik: (r.date_filed, [tuple(d) for d in r.documents]) for r in index.collect()}
    assert got["1"] == ("2024-04-29", [("485BPOS", "1", "main.htm"), ("EX-99", "2", "ex.txt")])
    assert got["2"] == ("2004-04-30", [("485BPOS", "1", "file001.txt"), (None, None, "full.txt")]) and got["3"] == ("", [])
    assert [r.path for r in filings.bodies(index, files, "485BPOS", ["htm", "txt"], ["cik"]).orderBy("cik").collect()] == ["edgar/data/1/a1/main.htm", "edgar/data/2/b2/file001.txt"]
    docs = {r.cik: r for r in pipelines.chunked_documents(index, files).collect()}
    assert len(docs["1"].html_pages) == 2 and docs["1"].text_chunk_refs == [0, 1] and docs["2"].html_pages == [] and docs["2"].text_chunk_refs == [] and docs["2"].text_chunks
    units = pipelines.extracts_of(pipelines.chunked_documents(index, files), extraction.Extractor(("Income", "growth of the FUND"))).collect()
    assert {(u.chunk_index, u.sentence_index) for u in units if u.document_key == "1/a-1"} >= {(0, 0), (1, 0)}


def test_no_table_and_no_type(spark):
    assert filings._legacy("<p>nothing</p>") == ("", None) and filings._legacy(None) == ("", [])
    df = spark.createDataFrame([([("A", "1", "x.htm")], "d/i-index-headers.html")], "docs array<struct<type:string,sequence:string,filename:string>>, p string")
    assert df.select(filings.document_paths(F.col("docs"), F.col("p"), "A").alias("v")).first().v == ["d/x.htm"]
    assert df.select(filings.document_paths(F.col("docs"), F.col("p"), "B").alias("v")).first().v is None


def test_semi_join(spark):
    c = spark.createDataFrame([("1", "a"), ("001", "b"), (None, "c"), ("1", "d")], "cik string, x string")
    assert sorted(r.x for r in filings.interesting(c, spark.createDataFrame([(1,), (1,), (2,)], "cik bigint")).collect()) == ["a", "d"]


# ---- extraction


def test_context_types(spark):
    cases = [
        ("a | b | c", ["x"], "table"), ("see (Alpha Fund) now", ["Alpha Fund"], "parenthetical"), ("Alpha Fund\nmore text here", ["Alpha Fund"], "header"), ("1. Alpha", [], "header"),
        ("- alpha item", [], "list"), ("a) alpha item", [], "list"), ("This is about a fund that is named here and it ends so.", [], "narrative"), ("nothing", [], "other"), (None, [], "other"), ("ALL CAPS HERE", [], "header"),
    ]
    assert values(spark, [c[:2] for c in cases], "t string, n array<string>", extraction.context_type(F.col("t"), None, F.col("n"))) == [c[2] for c in cases]
    tagged = spark.createDataFrame([("x", {"is_list": True, "is_table": False})], "t string, g map<string,boolean>")
    assert tagged.select(extraction.context_type(F.col("t"), F.col("g"), F.array().cast("array<string>")).alias("v")).first().v == "list"


def test_extractor_and_mentions(spark):
    chunk = "The Alpha Fund pays income. It is small.\n\nA paragraph on beta trusts that is long enough to be kept, for sure.\n\nshort Alpha"
    df = spark.createDataFrame([("k", 0, chunk), ("k", 1, None), ("k", 2, "")], "document_key string, chunk_index int, chunk string")
    got = extraction.Extractor(("Alpha Fund", "Beta")).extract(df).collect()
    assert [(r.sentence_index, r.entity_names_found) for r in got] == [(0, ["Alpha Fund"]), (1, ["Beta"]), (-1, ["Beta"])] or {(r.sentence_index, tuple(r.entity_names_found)) for r in got} >= {(0, ("Alpha Fund",)), (-1, ("Beta",))}
    names = ["Alpha Fund", "alpha", "BETA", "pays income", "x", "fund pays", "(Alpha", None, "", "und p"]
    texts = spark.createDataFrame([(1, chunk), (2, None), (3, "preAlpha Fundamental; ALPHABET")], "id int, text string")
    want = {(i, n) for i, t in ((1, chunk), (3, "preAlpha Fundamental; ALPHABET")) for n in names if n and n.lower() in t.lower()}
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    for most in (0, 1000):
        assert {(r.id, r.name) for r in extraction.mentions(texts, listed, ["id"], "text", most_names=most).collect()} == want
    assert extraction.mentions(texts, listed.limit(0), ["id"], "text").count() == 0


def test_many_names_are_found_like_few(spark):
    names = tuple(["Beta", "alpha", "Alpha Fund", *(f"Name {k}" for k in range(40))])
    chunk = "The Alpha Fund pays income to name 7 today. It is small and of beta kind, so it stays."
    df = spark.createDataFrame([("k", 0, chunk), ("k", 1, None)], "document_key string, chunk_index int, chunk string")
    many = extraction.Extractor(names).extract(df).collect()
    assert [(r.sentence_index, r.entity_names_found) for r in many if r.sentence_index >= 0] == [(0, ["alpha", "Alpha Fund", "Name 7"]), (1, ["Beta"])]
    units = spark.createDataFrame([(1, chunk), (1, chunk), (2, "none"), (3, None)], "id int, text string")
    listed = spark.createDataFrame([(n,) for n in names], "name string")
    for most in (0, 1000):
        assert sorted((r.id, tuple(r.names)) for r in extraction.names_of(units, listed, "text", most_names=most).collect()) == [(1, ("Alpha Fund", "Beta", "Name 7", "alpha"))] * 2


def test_a_model_is_loaded_once_for_all_batches(spark):
    from folioforge.functions import providers

    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "id int, text string")
    words = providers.from_model("words", lambda: str.split)
    assert [r.w for r in df.select("id", words(F.col("text")).alias("w")).orderBy("id").collect()] == [["a", "b"], [], []]
    loads = []
    for _ in range(2):
        providers.shared("once", lambda: loads.append(1) or str.split)
    assert loads == [1]


# ---- sources and streams


def test_stored_documents(spark, tmp_path):
    row = ("7", "a-1", "2020-01-01", ["<p>é</p>"], ["chunk"], [0], [{"is_table": True}])
    df = spark.createDataFrame([row], documents.CHUNKED)
    documents.write_chunked(df, str(tmp_path / "c"))
    (tmp_path / "c" / "cik=8").mkdir()
    (tmp_path / "c" / "cik=8" / "broken.json").write_text("{not json\n")
    back = documents.read_chunked(spark, str(tmp_path / "c")).collect()
    assert len(back) == 1 and back[0].html_pages == ["<p>é</p>"] and str(back[0].cik) == "7" and back[0].chunk_tags == [{"is_table": True}]
    x = spark.createDataFrame([("t", "table", ["n"], 1, -1, "k", 0.0), ("s", None, None, 1, 0, "k", None)], documents.EXTRACT)
    stored = documents.extracts_as_json(x)
    assert [e["text"] for e in json.loads(stored.first().extracts)] == ["s", "t"]
    assert sorted(map(str, documents.extracts_from_json(stored).collect())) == sorted(map(str, x.collect()))
    documents.write_predictions(spark.createDataFrame([("B b",), ("a",), ("b  B",), (None,)], "n string"), "n", str(tmp_path / "p"))
    assert [r.value for r in spark.read.text(str(tmp_path / "p")).orderBy("value").collect()] == ["a", "b b"]
    (tmp_path / "ciks.csv").write_text("cik\n1\n2\n")
    assert documents.read_ciks(spark, str(tmp_path / "ciks.csv")).count() == 2
    with pytest.raises(ValueError, match="no more than 2"):
        documents.read_ciks(spark, str(tmp_path / "ciks.csv"), 2)


def test_store(spark, tmp_path):
    assert storage.chosen_prefix({"STORAGE_PREFIX": "a", "CACHE_PREFIX": "b"}) == "a" and storage.chosen_prefix({"CACHE_PREFIX": "b"}) == "b" and storage.chosen_prefix({}) == ""
    assert storage.resolve("gs://b/p/") == "gs://b/p" and storage.resolve("/x") == "/x" and storage.resolve("y", "/r") == "/r/y"
    with pytest.raises(ValueError, match="too short"):
        storage.Store(spark, "/a")
    s = storage.Store(spark, str(tmp_path))
    assert s.read("d/x.txt") is None and s.write("d/x.txt", "é".encode()) and s.read("d/x.txt") == "é".encode()
    assert [(r.path, r.content) for r in s.files("*.txt").collect()] == [("d/x.txt", "é")]
    wanted = spark.createDataFrame([("d/x.txt",), ("d/y.txt",)], "path string")
    assert [r.path for r in storage.missing(wanted, s.files("*.txt")).collect()] == ["d/y.txt"]
    assert s.delete("d/x.txt") and s.delete("d/x.txt")


def test_fetching():
    waits, answers = [], iter([(429, ""), (429, ""), (200, "ok")])
    assert fetch.fetched("u", "me", lambda *_: next(answers), sleep=waits.append) == "ok" and waits == [2.0, 4.0]
    assert fetch.fetched("u", "me", lambda *_: (404, "")) is None
    with pytest.raises(fetch.RateLimited):
        fetch.fetched("u", "me", lambda *_: (429, ""), sleep=waits.append)


def test_stream_equals_batch(spark, tmp_path):
    from folioforge.streaming import ingest

    df = spark.createDataFrame([(k, "The portfolio manager earns $5 million. " * 20) for k in range(4)], "id int, text string")
    df.write.parquet(str(tmp_path / "in"))
    src = ingest.landed(spark, str(tmp_path / "in"), "id int, text string")
    q = ingest.sink(ingest.chunk_stream(src, ["id"], "text", 300), str(tmp_path / "out"), str(tmp_path / "ck")).start()
    q.awaitTermination(120)
    want = chunking.chunk_texts(df, ["id"], "text", 300)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, want.collect()))


def test_sql_functions_equal_columns(spark):
    from folioforge.functions.register import register

    assert "ff_name_score" in register(spark)
    rows = [(p, e) for p, e, *_ in MATCHES] + [("S&P  500!", "s&p 500 index"), ("A–B", "a-b")]
    df = spark.createDataFrame(rows, "p string, e string")
    df.createOrReplaceTempView("name_rows")
    sql = spark.sql("SELECT ff_normal_name(p) AS n, ff_name_score(p, e) AS s, ff_name_match_type(p, e) AS t FROM name_rows").collect()
    col = df.select(text.normal_name(F.col("p")), similarity.name_score(F.col("p"), F.col("e")), similarity.name_match_type(F.col("p"), F.col("e"))).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in col]


def test_windowed_tags_stream(spark, tmp_path):
    import datetime as dt

    from folioforge.streaming import ingest

    at = lambda day, hour=1: dt.datetime(2024, 1, day, hour)
    rows = [(at(1), "a fund manager and $5"), (at(1, 5), "no role"), (at(3), "fund manager, fund manager"), (at(20), None)]
    spark.createDataFrame(rows, "fetched_at timestamp, text string").coalesce(1).write.parquet(str(tmp_path / "in"))
    src = ingest.landed(spark, str(tmp_path / "in"), "fetched_at timestamp, text string")
    t = ingest.windowed_tags(src, "fetched_at", "text")
    q = t.writeStream.format("memory").queryName("tag_windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.sql("SELECT * FROM tag_windows").collect())
    assert got == [(at(1, 0), 2, 1, 0, 1), (at(3, 0), 1, 2, 0, 0), (at(20, 0), 1, 0, 0, 0)]


def test_scans_read_only_what_they_need(spark, tmp_path):
    from folioforge.plans.catalog import QUERIES

    cols = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(1, "x", "en", "s", 1)], cols).write.parquet(str(tmp_path / "documents.parquet"))
    plan = QUERIES["tag_counts"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan and "Exchange" not in plan
