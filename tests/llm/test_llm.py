"""The training-data operators: brute force, round trips and odd rows."""

import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioforge.llm import encode, leak, lookalike, markup, neardup, quality, repeated_lines, sentences, spans, split

CHUNKED = (
    "chunked_id bigint, cik string, accession_number string, html_pages array<string>, text_chunks array<string>, "
    "text_chunk_refs array<int>, line_no int, _key string"
)


def chunked(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], CHUNKED)


ODD = [
    (1001, None, None, None, None, None),
    (1002, "c", "a", [], [], []),
    (1003, "c", "b", [None, ""], [None, ""], None),
    (1003, "c", "b", [None, ""], [None, ""], None),
]


# ---- repeated lines

BY_DOCUMENT = {"units": ("documents",), "date_col": None}


def test_repeated_lines_counts_clusters_not_rows(spark):
    notice = "  This  is a legal NOTICE no {} for all \t"
    rows = [(k, "c", f"a{k}", None, [notice.format(k) + f"\nown line number {chr(97 + k) * 20}", None], None) for k in range(5)]
    rows += [(9, "c", "a0", None, [notice.format(77)], None)]          # the same filing again
    rows += [(20 + k, "d", "only", None, ["this line is in one filing only"], None) for k in range(8)]
    got = {tuple(r) for r in repeated_lines.repeated_lines(chunked(spark, rows + ODD), **BY_DOCUMENT).collect()}
    assert got == {(k, 0, 0) for k in (0, 1, 2, 3, 4, 9)}


def test_repeated_lines_need_a_third(spark):
    rows = [(k, "c", f"a{k}", None, ["exactly this very long line" if k < 5 else f"other {k}"], None) for k in range(15)]
    assert repeated_lines.repeated_lines(chunked(spark, rows), **BY_DOCUMENT).count() == 5
    rows.append((99, "c", "a99", None, ["x"], None))
    assert repeated_lines.repeated_lines(chunked(spark, rows), **BY_DOCUMENT).count() == 0


def test_lines_are_removed(spark):
    rows = [(k, "c", f"a{k}", None, ["the very same boilerplate\nkeep me", None, ""], None) for k in range(6)] + ODD
    out = {r.chunked_id: (r.text_chunks, r.lines_removed) for r in repeated_lines.without_repeated_lines(chunked(spark, rows), **BY_DOCUMENT).collect()}
    assert out[0] == (["keep me", None, ""], 1)
    assert out[1001] == (None, 0) and out[1003] == ([None, ""], 0)
    assert repeated_lines.repeated_lines(chunked(spark, []), **BY_DOCUMENT).count() == 0


def test_lines_are_removed_wherever_they_stand(spark):
    notice = "the very same boilerplate"
    chunks = [f"{notice}\na\n{notice}\n{notice}\nb", f"a\n{notice}", notice, f"\n{notice}\n\n"]
    rows = [(k, "c", f"a{k}", None, chunks, None) for k in range(5)]
    out = repeated_lines.without_repeated_lines(chunked(spark, rows), **BY_DOCUMENT).collect()
    assert {(tuple(r.text_chunks), r.lines_removed) for r in out} == {(("a\nb", "a", "", "\n\n"), 6)}


def test_copies_and_dates_count_once(spark):
    """A line of five documents that are copies, or came out on one day, is no boilerplate; one of five texts on five days is."""
    schema = "chunked_id bigint, cik string, accession_number string, text_chunks array<string>, date_filed string"
    rows = [(k, "copied", f"a{k}", ["the text that was published again"], f"2020-01-0{k + 1}") for k in range(5)]
    rows += [(10 + k, "one day", f"a{k}", ["the notice of a single day", "own " + chr(97 + k) * 20], "2020-01-01") for k in range(5)]
    rows += [(20 + k, "real", f"a{k}", ["the notice of every filing", "own " + chr(97 + k) * 20], f"2020-01-0{k + 1}") for k in range(5)]
    df = spark.createDataFrame(rows, schema)
    assert {tuple(r) for r in repeated_lines.repeated_lines(df).collect()} == {(20 + k, 0, 0) for k in range(5)}
    by = lambda *units: {r[0] // 10 for r in repeated_lines.repeated_lines(df, units=units).collect()}
    assert by("documents") == {0, 1, 2} and by("clusters") == {1, 2} and by("dates") == {0, 2}
    counts = {r.cik: (r.documents, r.clusters, r.dates) for r in repeated_lines.line_counts(df).collect()}
    assert counts == {"copied": (5, 1, 5), "one day": (5, 5, 1), "real": (5, 5, 5)}


# ---- figures


def test_kinds_and_odd_rows(spark):
    prose = "The fund may invest in the bonds of any issuer, and the adviser should always review each holding. {}"
    rows = [(k, prose.format("It would not do otherwise.")) for k in range(60)]
    rows += [
        (100, "\n".join(f"- {w} reserve of growth income" for w in ("early", "late", "small", "large", "net"))),
        (101, "\n".join("Alpha fund | 3.1% | $4,000 | None" for _ in range(4))),
        (102, "%@ ?~- +/| :_! " * 3 + "Some Growth Fund " + "^^ ;% .| @~ " * 6),
        (103, None), (104, ""), (105, "   \n "), (106, "short."), (107, prose.format("a\n") * 200),
        (100, "\n".join(f"- {w} reserve of growth income" for w in ("early", "late", "small", "large", "net"))),
    ]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "extract_id bigint, text string, language string, words double")
    got = defaultdict(list)
    for r in quality.text_kinds(df).collect():
        got[r.extract_id].append(r.kind)
    assert got[0] == ["prose"] and got[107] == ["prose"]
    assert got[100] == ["list"] * 2 and got[101] == ["table"] and got[102] == ["junk"]
    assert {got[k][0] for k in (103, 104, 105, 106)} == {"short"}
    assert quality.text_kinds(df.limit(0)).count() == 0


# ---- near duplicates


def _jaccard_pairs(records, k, t):
    sets = defaultdict(list)
    for kind, rid, origin, text, least in records:
        w = re.findall(r"[^\W_]+", (text or "").lower())
        if len(w) >= max(k, least):
            sets[kind].append((rid, origin, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}))
    out = set()
    for kind, rows in sets.items():
        for (a, oa, x), (b, ob, y) in itertools.combinations(rows, 2):
            if (oa is None or ob is None or oa != ob) and len(x & y) >= t * len(x | y) - 1e-9:
                out.add((kind, min(a, b), max(a, b)))
    return out


RECORDS = "record_kind string, record_id bigint, origin string, text string, min_words int, _a string"


@pytest.mark.parametrize("k,t", [(3, 0.6), (5, 0.8)])
def test_pairs_match_brute_force(spark, k, t):
    rng = random.Random(5)
    vocabulary = [f"w{n}" for n in range(400)]
    records = []
    notice = [rng.choice(vocabulary) for _ in range(14)]
    for n in range(150):
        words = rng.choices(vocabulary, k=rng.randint(3, 120)) + notice
        records.append(("filing", len(records), f"o{n}", " ".join(words), 0))
        for _ in range(rng.randint(0, 3)):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                at = rng.randrange(len(copy) + 1)
                match rng.randrange(3):
                    case 0: copy.insert(at, rng.choice(vocabulary))
                    case 1: copy[at : at + 1] = []
                    case 2: copy = copy[at:] + copy[:at]
            records.append((rng.choice(["filing", "extract"]), len(records), rng.choice([f"o{n}", f"p{len(records)}", None]), " ".join(copy), 0))
    records += [("filing", 5000, None, None, 0), ("filing", 5001, "z", "", 0), ("extract", 5002, "z", "two words", 20), ("filing", None, "z", "a b c d e f", 0)]
    df = spark.createDataFrame([(*r, "x") for r in records + records[:5]], RECORDS)
    got = {tuple(r) for r in neardup.near_duplicate_pairs(df, k, t).collect()}
    assert got == _jaccard_pairs(records, k, t)


def test_frequent_grams_lose_no_pair(spark):
    """More near-copies of one text than an n-gram may have in the product."""
    rng = random.Random(2)
    base = [f"b{n}" for n in range(60)]
    records = []
    for n in range(150):
        words = list(base)
        words[rng.randrange(60)] = f"own{n}"
        words += [f"tail{n}x{j}" for j in range(rng.randint(0, 25))]
        records.append(("extract", n, f"o{n}", " ".join(words), 20))
    df = spark.createDataFrame([(*r, "x") for r in records], RECORDS)
    got = {tuple(r) for r in neardup.near_duplicate_pairs(df, 3, 0.6).collect()}
    assert got == _jaccard_pairs(records, 3, 0.6)
    with pytest.MonkeyPatch.context() as m:  # rows of the product in blocks give the same
        m.setattr(neardup, "BLOCK", 20)
        assert {tuple(r) for r in neardup.near_duplicate_pairs(df, 3, 0.6).collect()} == got


def test_evenly_cut_records_are_found(spark):
    """Blocks of eight words in another order: the most edits that the threshold leaves room for."""
    rng = random.Random(7)
    records = []
    for n in range(40):
        blocks = [[f"r{n}w{8 * b + j}" for j in range(8)] for b in range(rng.randint(4, 30))]
        records.append(("filing", 2 * n, f"a{n}", " ".join(w for b in blocks for w in b), 0))
        rng.shuffle(blocks)
        records.append(("filing", 2 * n + 1, f"b{n}", " ".join(w for b in blocks for w in b), 0))
    df = spark.createDataFrame([(*r, "x") for r in records], RECORDS)
    got = {tuple(r) for r in neardup.near_duplicate_pairs(df, 3, 0.6).collect()}
    want = _jaccard_pairs(records, 3, 0.6)
    assert len(want) > 20 and got == want


def test_bitmaps_never_rule_out_a_pair():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        every = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
        x, y = (np.sort(rng.choice(every, rng.integers(1, 400), replace=False)) for _ in range(2))
        assert neardup.unlike(neardup.bitmap(x), neardup.bitmap(y)) <= len(np.setxor1d(x, y))


def test_kinds_and_ids_are_carried_or_refused(spark):
    words = " ".join(f"w{k}" for k in range(30))
    rows = [("note", 1, "a", words, 0, "x"), ("note", 2, "b", words + " end", 0, "x"), ("memo", 1, "c", words, 0, "x"), ("note", 3, "b", words.replace("w7", "z"), 0, "x")]
    df = spark.createDataFrame(rows, RECORDS)
    assert {tuple(r) for r in neardup.near_duplicate_pairs(df, 3, 0.6).collect()} == {("note", 1, 2), ("note", 1, 3)}
    # an id in rows of two texts is one record
    both = spark.createDataFrame([("k", 1, "a", words, 0, "x"), ("k", 1, "a", words.upper().replace("W", "V"), 0, "x"), ("k", 0, "b", words.replace("w", "v") + " more", 0, "x")], RECORDS)
    assert {tuple(r) for r in neardup.near_duplicate_pairs(both, 3, 0.6).collect()} == {("k", 0, 1)}
    with pytest.raises(TypeError, match="whole number"):
        neardup.near_duplicate_pairs(df.withColumn("record_id", F.col("record_id").cast("string")))
    with pytest.raises(Exception, match="a record_id lies in"):
        neardup.near_duplicate_pairs(df.withColumn("record_id", -F.col("record_id"))).collect()


def test_groups(spark):
    words = [f"w{n}" for n in range(100)]
    texts = [words, words, [*words[:99], "x"], [*words[:96], "x", "y", "z", "q"], [f"o{n}" for n in range(50)]]
    df = spark.createDataFrame([("filing", k, f"o{k}", " ".join(t), 0, "x") for k, t in enumerate(texts)], RECORDS)
    got = {r.record_id: (r.group_id, r.links) for r in neardup.near_duplicate_groups(df, 3, 0.8).collect()}
    assert got == {0: (0, 2), 1: (0, 2), 2: (0, 2), 3: (0, 2), 4: (4, 0)}
    assert neardup.near_duplicate_groups(df.limit(0)).count() == 0


# ---- sentences

CASES = [
    ["The fund paid 3.5% in the U.S. market.", "Who knew?", "He said, “It is late. Go home.”", "(3) All is well, e.g. here."],
    ["La reserva limita el plazo según la Sra. Maramer.", "¿El emisor aplaza el cupón?", "Todo bajo el lema «Ralidor. Ahora.» sigue."],
    ["当基金は「Halimerは安全です。ご安心を。」と述べて監視します。", "運用会社は延期します？", "以上です。"],
    ["风险小组按月披露浮动票息（见第44.7节）而不通知Drinabedor？", "投资委员会逐步提高申购费用。"],
    ["ผู้ถือหน่วยประเมินตามข้อ41.10โดยไม่แจ้งTolibury", "กองทุนYarabesenDividendSeriesจำกัดภายใน31วัน"],
    ["Комитет публикует срок 23 марта 2013 г. по решению.", "Фонд снижает стоимость согласно п. 62 с 2010 года!"],
    ["Die Depotbank sichert das Risiko nach Nr. 80 am 15. März 2008.", "Der Beirat meldet die „Frist 20! Halt!“ ohne Prüfung."],
]


@pytest.mark.parametrize("parts", CASES)
def test_sentences_in_order(parts):
    glue = "" if any("぀" <= c <= "鿿" for c in parts[0]) else " "
    text = glue.join(parts)
    assert [text[a:b] for a, b, _ in sentences.sentence_spans(text)] == parts


def test_text_without_marks_is_tagged_by_character():
    chain = sentences.train([(sentences.character_features(t), g) for t, g in [sentences.stripped(["当基金上升。", "风险小组按月披露。", "当基金下降。"]), sentences.stripped(["风险小组按月披露。", "当基金上升。"])] * 3])
    text, gold = sentences.stripped(["当基金下降。", "风险小组按月披露。", "当基金上升。"])
    assert "。" not in text and chain.tags(sentences.character_features(text)) == gold
    # the trained chain reads text whose sentences stand without marks or blanks
    parts = ["投资委员会逐步提高申购费用", "风险小组按月披露浮动票息"]
    assert sentences.sentence_spans("".join(parts))[-1][1] == sum(map(len, parts))
    assert sentences.sentence_spans("  当 ") == [(2, 3, True)]


def test_long_quotations_stay_inside():
    inner = "He left. She stayed. " * 200
    text = f"The adviser wrote, “{inner}It ended.” and the fund closed. All is well."
    assert [text[a:b] for a, b, _ in sentences.sentence_spans(text)][-1] == "All is well." and len(sentences.sentence_spans(text)) == 2
    # an open mark ends at a blank line
    broken = "The adviser wrote, “It is.\n\nAll is well. It is so.” The end."
    assert [broken[a:b] for a, b, _ in sentences.sentence_spans(broken)][:2] == ["The adviser wrote, “It is.", "All is well."]


def test_sentence_rows(spark):
    df = spark.createDataFrame(
        [(1, "One is here. Two is there.", 0), (2, None, 0), (3, "", 0), (4, " \n ", 0), (5, "no mark at the end", 0), (1, "One is here. Two is there.", 0), (6, "Long one. " * 20000, 0)],
        "extract_id bigint, text string, start_pos int",
    )
    rows = sentences.sentences(df).collect()
    assert [(r.start_pos, r.end_pos) for r in rows if r.extract_id == 1] == [(0, 12), (13, 26)] * 2
    assert {r.extract_id for r in rows} == {1, 5, 6} and not next(r for r in rows if r.extract_id == 5).closed
    assert sum(r.extract_id == 6 for r in rows) == 20000
    assert sentences.sentences(df.limit(0)).count() == 0


def test_training_learns_an_abbreviation():
    blocks = [(f"Held by Acme Corp. {w} the year. The end of it.", [f"Held by Acme Corp. {w} the year.", "The end of it."]) for w in ("during", "after", "for")]
    chain = sentences.train([q for b, s in blocks for q in sentences.labelled(b, s)])
    text = "Held by Acme Corp. within the year. The end of it."
    assert [text[a:b] for a, b, _ in sentences.sentence_spans(text, chain)] == ["Held by Acme Corp. within the year.", "The end of it."]


# ---- splitting


def test_pieces_round_trip(spark):
    rng = random.Random(1)
    texts = [
        "".join(rng.choices(["word ", "x", ". ", "\n", "\n\n", "長い", "🙂", "</p>"], k=3000)),
        "a" * 5000, "🙂a" * 2500, "長" * 2001, "b" * 2000, "", "\n" * 4000,
    ]
    df = spark.createDataFrame([(k, [t, None], 1) for k, t in enumerate(texts)] + [(50, None, 1), (51, [], 1)], "chunked_id bigint, items array<string>, piece_no int")
    got = defaultdict(list)
    for r in split.split_items(df, "chunked_id", "items", 2000).orderBy("chunked_id", "piece_no").collect():
        got[r.chunked_id].append(r)
    for k, t in enumerate(texts):
        pieces = got[k]
        assert "".join(p.text[p.overlap_len :] for p in pieces) == t
        assert all(len(p.text) <= 2000 for p in pieces) and len(pieces) == pieces[0].n_pieces
        assert (len(pieces) > 1) == (len(t) > 2000)
        for a, b in itertools.pairwise(pieces):
            assert b.overlap_len == 200 and b.text[:200] == a.text[-200:]
    assert 50 not in got and 51 not in got


def test_cuts_are_natural(spark):
    df = spark.createDataFrame([(1, ["Some words stand here. " * 200])], "i bigint, items array<string>")
    assert all(p.text.rstrip().endswith(".") for p in split.split_items(df, "i", "items", 2000).collect())


def test_filings_keep_refs_in_step(spark):
    page = "p" * 20000
    rows = [(1, "c", "a", ["x", page, "y"], ["s", "t" * 4000, None], [0, 1, 2]), *ODD]
    out = {r.chunked_id: r for r in split.split_filings(chunked(spark, rows)).collect()}
    one = out[1]
    assert [len(x or "") for x in one.text_chunks] == [1, 1800, 2000, 600, 0] and len(one.html_pages) == 5
    assert one.text_chunk_refs == [0, 1, 1, 1, 4]
    assert out[1002].text_chunks == [] and out[1003].text_chunks == [None, ""] and out[1003].text_chunk_refs is None


# ---- markup


def test_markup_kinds_and_decoys(spark):
    chunks = [
        '<p class="c1">Text &amp; more</p>', "## Head\n**bold** and [a](#s-1)", "'''Note''' see [[Page|that]]", r"\textbf{Sum} is $\sigma_{1} \le 2$",
        "Amounts < $6,000 and > $300 at A & B, [3] * less ** see note 10 ______ #26", "a | b\n---|---\n- item\n1. item", None, "",
    ]
    rows = [(1, "c", "a", None, chunks, None), *ODD]
    got = {(r.chunked_id, r.chunk_no, r.markup) for r in markup.markup_residue(chunked(spark, rows)).collect()}
    assert got == {(1, 0, "html"), (1, 1, "markdown"), (1, 2, "wiki"), (1, 3, "latex")}
    text = {r.chunk_no: r.text for r in markup.clean_chunks(chunked(spark, rows[:1])).collect()}
    assert text[0].strip() == "Text & more" and text[1] == "# Head\nbold and a" and text[2] == "Note see that"
    assert text[3] == r"Sum is $\sigma_{1} \le 2$" and text[4] == chunks[4] and text[5] == chunks[5] and text[6] is None and text[7] == ""


def test_every_entity_is_decoded(spark):
    chunks = [
        "a &#8212; b &#8217; &#x2019; &#X201D; &sect; &eacute; &CounterClockwiseContourIntegral; &NBSP;&#xa0;&nbsp;|",
        "&amp;lt; &amp;#8212; &bogus; &notit; R&D; AT&T &#99999999; &copy 2020 &#128;", "<b>&lt;b&gt;</b>", None, "plain & simple;",
    ]
    text = {r.chunk_no: r.text for r in markup.clean_chunks(chunked(spark, [(1, "c", "a", None, chunks, None)])).collect()}
    assert text == {
        0: "a — b ’ ’ ” § é ∳    |", 1: "&lt; &#8212; &bogus; &notit; R&D; AT&T &#99999999; &copy 2020 €", 2: "<b>", 3: None, 4: "plain & simple;",
    }


def test_long_spans_are_markup(spark):
    x = "word " * 2000 + "end"
    cases = [
        (f"**{x}**", "markdown", x), (f"__{x}__", "markdown", x), (f"~~{x}~~", "markdown", x), (f"`{x}`", "markdown", f"`{x}`"), (f"[{x}](#s)", "markdown", x),
        (f"[[Page|{x}]]", "wiki", x), (f"{{{{{x}}}}} a", "wiki", "a"), (f"{3 * chr(39)}{x}{3 * chr(39)}", "wiki", x), (f"== {x} ==", "wiki", f"# {x}"),
        (f"$${x}$$", "latex", f"$${x}$$"), (f"$x_1 {x}$", "latex", f"$x_1 {x}$"), (f'<i title="{x}"', None, f'<i title="{x}"'), (f'<i title="{x}">', "html", ""),
        (f"H<sub>{x}</sub>", "html", f"H_{{{x}}}"), (f"<!--{x * 3}-->", "html", ""), ("&CounterClockwiseContourIntegral;", "html", "∳"),
        (f"paid $5 for a_b {x} and $6", None, f"paid $5 for a_b {x} and $6"),
    ]
    rows = chunked(spark, [(1, "c", "a", None, [c for c, _, _ in cases], None)])
    got = {(r.chunk_no, r.markup) for r in markup.markup_residue(rows).collect()}
    assert got == {(k, kind) for k, (_, kind, _) in enumerate(cases) if kind}
    assert {r.chunk_no: r.text for r in markup.clean_chunks(rows).collect()} == {k: t for k, (_, _, t) in enumerate(cases)}


def test_more_forms_are_cleaned(spark):
    cases = {
        r"\chapter{One} text": "# One text", "[[File:a.png|thumb|left|A caption]] x": "A caption x", "See [this][1] **now**\n[1]: http://x.y z\nend": "See this now\nend",
        "Title\n=====\n**bold**": "# Title\nbold", "{{Infobox\n| a = 1\n}}\n'''b'''": "\nb",
    }
    rows = chunked(spark, [(1, "c", "a", None, list(cases), None)])
    assert {r.chunk_no: r.text for r in markup.clean_chunks(rows).collect()} == dict(enumerate(cases.values()))


def test_chunk_wrappers_tell_the_markup(spark):
    odd = (2, None, "a", None, ["x <br/> y", r"\textbf{z}"], None)
    df = chunked(spark, [(1, "c", "a", None, ["<p>one</p>", "<p>two</p><p>three</p> **b**", "plain", None], None), odd, odd])
    got = {r.cik: (r.chunks, r.wrapper) for r in markup.chunk_wrappers(df).collect()}
    assert got["c"][0] == 2 and "html <p>" in got["c"][1] and "(markdown **)?" in got["c"][1] and got[None][0] == 4
    found = sorted((r.chunked_id, r.chunk_no, r.markup, tuple(r.tokens)) for r in markup.markup_residue(df).collect())
    assert found == [
        (1, 0, "html", ("<p>", "</p>")), (1, 1, "html", ("<p>", "</p>", "<p>", "</p>")), (1, 1, "markdown", ("**b**",)),
        *[(2, 0, "html", ("<br/>",))] * 2, *[(2, 1, "latex", (r"\textbf",))] * 2,
    ]
    again = {r.cik: (r.chunks, r.wrapper) for r in markup.chunk_wrappers(df.repartition(7, "text_chunks")).collect()}
    assert again == got


def test_page_text_keeps_structure():
    page = '<div><!-- x --><div style="display: none">no</div><h2>Top</h2><ul><li>a</li><li>b</li></ul><table><tr><td>1</td><td>2</td></tr></table><pre>x\n  y</pre>H<sub>2</sub>O &amp; c'
    assert markup.page_text(page) == "## Top\n\n- a\n- b\n\n1 | 2\n\n```\nx\n  y\n```\nH_{2}O & c"
    assert markup.page_text(None) is None and markup.page_text("") == ""


def test_wrappers(spark):
    pages = [["<div><h2>A</h2><p>one</p><p>two</p><small>Legal</small></div>", "<div><p>x</p><p>y</p><p>z</p><small>Legal</small></div>"], [None, ""], None]
    rows = [(k, "c" if k < 2 else None, "a", p, [], []) for k, p in enumerate(pages)]
    out = markup.host_wrappers(chunked(spark, rows)).collect()
    assert len(out) == 1 and out[0].pages == 2
    assert "(<p> # </p>)+" in out[0].wrapper and '"legal"' in out[0].wrapper and "(<h2>)?" in out[0].wrapper


def test_alignment_is_the_longest_common_subsequence():
    rng = random.Random(3)
    kinds = [["tag", "<p>", False], ["tag", "</p>", True], ["text", "a", False], ["slot", "", False], ["rep", [["text", "a", False]], False], ["rep", [["slot", "", False]], False]]
    for _ in range(300):
        a, b = ([rng.choice(kinds) for _ in range(rng.randrange(14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = best[i][j] + 1 if markup._same(a[i], b[j]) else max(best[i][j + 1], best[i + 1][j])
        out = markup.align(a, b)
        assert len(out) == len(a) + len(b) - best[-1][-1]


def test_long_wrappers_keep_their_end(spark):
    rng = random.Random(5)
    body = "".join(f"<{t}>{k}</{t}>" for k, t in enumerate(rng.choices("h1 h2 h3 p div li td th b i".split(), k=600)))
    rows = [(k, "c", "a", [f"<main>{body}</main>{more}<footer>Legal notice</footer>"], [], None) for k, more in enumerate(["", "<hr>", ""])]
    out = markup.host_wrappers(chunked(spark, rows)).collect()
    assert len(out) == 1 and out[0].pages == 3
    assert out[0].wrapper.endswith('</main> (<hr>)? <footer> "legal notice" </footer>') and out[0].wrapper.count('"0"') > 300


def test_long_texts_are_compared_whole(spark):
    same = "the same notice " * 20 + "ends here"
    pages = [f"<div><p>{same}</p><b>{same} {end}</b></div>" for end in ("in one way", "in another way")]
    out = markup.host_wrappers(chunked(spark, [(1, "c", "a", pages, [], None)])).collect()
    assert out[0].wrapper == f'<div> <p> "{same}" </p> <b> # </b> </div>'


# ---- look-alikes

NAMES = [(1, "Pelunebury-Taredor Mid Cap Growth Fund"), (2, "Yarilöw Income Trust"), (3, "Ostodañ Bond Trust"), (4, "Ostodáñ Bond Trust"), (5, None)]


def test_lookalikes(spark):
    places = [
        ("text", 1, 0, "of Pelunebury‐Taredor Mid Сар Growth Fund now"), ("text", 2, 0, "YARILÖW INCOME TRUST, Yarilow Income Trust, YarilöwIncomeTrust"),
        ("text", 3, 0, "Yarilo\u0308w Income Trust"), ("text", 4, 0, "Ｏstodáñ Bond\u00a0Trust"), ("name", 5, 1, "Yarilöw In\u200bcome Trust"),
        ("text", 6, 0, "Yarilöw Income Trust и Фонд сор"), ("text", 7, 0, None), ("text", 8, 0, ""), ("text", 9, 0, "Yarilöw Income Trusts\u00ad"),
        ("text", 11, 0, "и текст Үarilöw Incоme Trust и Уarilöw".replace("Ү", "Υ")), ("text", 12, 0, "Фонд сор и Оѕtоdаñ Воnd Тruѕt снова"),
        ("text", 10, 0, "กองทุนYarilöw\u2007Income Trustจำกัด"), ("text", 3, 0, "Yarilo\u0308w Income Trust"),
    ]
    df = spark.createDataFrame([(*p, "x") for p in places], "field string, record_id bigint, item_no int, text string, entity_id string")
    names = spark.createDataFrame(NAMES, "entity_id bigint, name string")
    got = sorted((r.record_id, r.entity_id) for r in lookalike.lookalike_names(df, names).collect())
    assert got == [(1, 1), (3, 2), (3, 2), (4, 4), (5, 2), (10, 2), (11, 2), (12, 3)]
    forms = {r.record_id: r.text for r in lookalike.in_one_form(df, names).collect()}
    assert forms[1] == "of Pelunebury-Taredor Mid Cap Growth Fund now" and forms[6].endswith("и Фонд сор")
    assert forms[3] == "Yarilöw Income Trust" and forms[7] is None and forms[8] == ""
    assert lookalike.lookalike_names(df.limit(0), names).count() == 0 and lookalike.lookalike_names(df, names.limit(0)).count() == 0


def test_doubles_of_many_scripts(spark):
    names = spark.createDataFrame([("p", "Palo Hill CoreBond Fund"), ("w", "Yarilow Income Trust")], "entity_id string, name string")
    same = [
        "Palo\u034f Hill CoreBond Fund", "Palo H\u3164ill CoreBond Fund", "Palo Hi\u180bll CoreBond Fund", "\u13e2alo Hill CoreBond Fund", "\ua4d1alo Hill CoreBond Fund",
        "Palo Hill \u2ca4oreBond Fund".replace("\u2ca4", "\u2ca4"), "Palo Hil\u04cf CoreBond Fund", "Palo \u04baill CoreBond Fund".replace("\u04ba", "\u041d"), "Palo Hill CoreBond Fund".replace("o", "\u0585"), "P\u0430lo" + " " * 300 + "x",
    ]
    df = spark.createDataFrame([("text", k, 0, t) for k, t in enumerate(same)], "field string, record_id bigint, item_no int, text string")
    got = {r.record_id: r.entity_id for r in lookalike.lookalike_names(df, names).collect()}
    assert {k for k in range(5)} <= set(got) and set(got.values()) == {"p"} and 7 in got and 8 in got
    # however far the words around stand, they decide what a word alone leaves open
    far = spark.createDataFrame([("text", 1, 0, "Фонд" + " " * 500 + "сор"), ("text", 2, 0, "Fund" + " " * 500 + "сор")], "field string, record_id bigint, item_no int, text string")
    assert {r.record_id: r.text[-3:] for r in lookalike.in_one_form(far, names).collect()} == {1: "сор", 2: "cop"}


def test_the_search_equals_that_over_every_path():
    rng = random.Random(11)
    doubles = {"а": "a", "о": "o", "с": "c", "І": "Il", "З": "3"}
    model = lookalike.Model(["Cola Alco", "Ill Oca"], doubles)

    def worth(text, path):
        total, last, script = 0.0, " ", ""
        for c, o in zip(text, path, strict=True):
            kind = lookalike._script(o)
            if kind and script and kind != script:
                total += lookalike._SCORES["switch"] * (1 if last == " " else 2)
            if c in doubles:
                total += (0.0 if o == c else lookalike._SCORES["double"]) + (0.3 * model.odds.get((last, o), -1.0) if kind == "L" else 0.0)
            last, script = (o if kind else " "), kind or script
        return total

    for _ in range(200):
        text = "".join(rng.choices("аосІЗlc жЖ1.", k=rng.randint(1, 8)))
        best = max(worth(text, p) for p in itertools.product(*((c, *doubles.get(c, "")) for c in text)))
        assert abs(worth(text, model.resolve(text)) - best) < 1e-9, text


# ---- encoding


def test_ids_round_trip_and_safe_pieces(spark):
    rng = random.Random(3)
    long = "".join(rng.choices(["word", " ", "  ", "'s", "12", "\n", "é", "ไทย", "🙂", "don't "], k=120_000))
    texts = [long, "x" * 250_000, "", None, "plain text", "<|endoftext|>"]
    df = spark.createDataFrame([(k, t, [0]) for k, t in enumerate(texts)], "doc_id bigint, text string, ids array<int>")
    got = {r.doc_id: r.ids for r in encode.encode_texts(df).collect()}
    assert got[2] == [] and got[3] == []
    assert got[0] == encode.encoding().encode_ordinary(long)
    for k in (0, 1, 4, 5):
        assert encode.text_of(got[k]) == texts[k]
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    assert got[0] == t.encode(long, add_special_tokens=False).ids


def test_every_safe_place_is_a_border():
    """Pieces of any length give the ids of the whole, also where no blank stands between letters."""
    rng = random.Random(9)
    parts = ["当基金", "。", "，", "ไทย", "abc", "A1b2", "42", "'s", "'ll", "'", " ", "  ", "\n", "\t\n ", "\u3000", "\x1c", "!", "…'", "é", "e\u0301", "½", "Ⅷ", "🙂", "_", "\u200b"]
    enc = encode.encoding()
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randint(1, 60)))
        for piece in (1, 3, 7):
            cuts = list(encode.safe_pieces(text, piece))
            assert "".join(cuts) == text and [i for c in cuts for i in enc.encode_ordinary(c)] == enc.encode_ordinary(text), (text, cuts)
    assert max(map(len, encode.safe_pieces("当前基金，" * 60_000, 1000))) < 1010


# ---- leaks


def test_lengths_are_those_of_each_item(spark):
    long = [f"w{k}" for k in range(40)]
    items = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(["other", *long[27:]])), (3, " ".join(long[5:20]))], "item_id int, text string")
    docs = spark.createDataFrame([("d", " ".join(["start", *long]))], "doc_id string, text string")
    got = {r.item_id: (r.longest_run, r.first_word, r.last_word) for r in leak.leaked_items(docs, items).collect()}
    assert got == {1: (40, 1, 40), 2: (13, 28, 40), 3: (15, 6, 20)}
    named = leak.leaked_items(docs, items.selectExpr("concat('i', item_id) AS item_id", "text"), block_words=20)
    assert {(r.item_id, r.longest_run) for r in named.collect()} == {("i1", 40), ("i2", 13), ("i3", 15)}
    # a capital that grows in lower case is the same for what is found and what is cleaned
    turkish = docs.select("doc_id", F.concat(F.lit("İ İ "), "text").alias("text"))
    assert leak.leaked_items(turkish, items).count() == 3 and leak.without_leaks(turkish, items, max_coverage=1.0).first().text == "İ İ start "



def test_leaks_match_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"v{n}" for n in range(30)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(5, 40)))) for k in range(40)] + [(98, None), (99, "")]
    docs = []
    for k in range(120):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if rng.random() < 0.6:
            w = (items[rng.randrange(40)][1]).split()
            a = rng.randrange(len(w))
            words[3:3] = w[a : a + rng.randint(8, 20)]
        docs.append((k, ", ".join(words).upper() if k % 3 else " ".join(words)))
    docs += [(500, None), (501, ""), docs[0]]
    runs = lambda t: {tuple(w[i : i + 13]) for w in [re.findall(r"[^\W_]+", (t or "").lower())] for i in range(len(w) - 12)}
    want = {(d, i) for d, x in docs for i, y in items if runs(x) & runs(y)}
    ddf = spark.createDataFrame([(*d, 0) for d in docs], "doc_id bigint, text string, item_id int")
    idf = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (50, 10**6):
        assert {(r[0], r[1]) for r in leak.leaked_items(ddf, idf, block_words=block).collect()} == want
    clean = leak.without_leaks(ddf, idf)
    assert clean.count() == len(docs) and leak.leaked_items(clean.where("not dropped"), idf).count() == 0
    assert leak.leaked_items(ddf, idf.limit(0)).count() == 0 and leak.leaked_items(ddf.limit(0), idf).count() == 0


# ---- shared spans


def test_spans_match_brute_force(spark):
    rng = random.Random(6)
    letters = "abcdeé🙂 "
    text = lambda n: "".join(rng.choices(letters, k=n))
    passages = [text(n) for n in (239, 240, 241, 500, 900)] + ["a" * 400, "ab" * 200]
    docs = []
    for k in range(60):
        t = text(rng.randint(0, 300))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(max(1, len(p) // 3))
            t += p[a:] + text(rng.randint(0, 60))
        docs.append((k, t))
    docs += [(900, None), (901, ""), (902, passages[3] * 2), (903, text(600)), (903, None)]
    own = defaultdict(set)
    for i, t in docs:
        for w in range(len(t or "") - 239):
            own[t[w : w + 240]].add(i)
    want = []
    for i, t in docs:
        reach = -1
        for w in range(len(t or "") - 239):
            if len(own[t[w : w + 240]]) > 1:
                if w <= reach:
                    want[-1] = (i, want[-1][1], w + 240)
                else:
                    want.append((i, w, w + 240))
                reach = w + 240
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id bigint, text string, start_pos int")
    assert sorted(tuple(r) for r in spans.shared_spans(df).collect()) == sorted(want)
    assert spans.shared_ratio(df).count() == len(docs)
    assert spans.shared_spans(df.limit(0)).count() == 0


def test_cutting_is_linear_in_an_item(spark):
    """Four times the characters may take about four times as long, not sixteen times."""
    import time

    took = {}
    for n in (1, 1, 4):
        df = spark.range(1).select(F.col("id"), F.array(F.repeat(F.lit("Some words stand here, and more.\n"), n * 10_000)).alias("items"))
        began = time.time()
        split.split_items(df, "id", "items", 2000).write.format("noop").mode("overwrite").save()
        took[n] = time.time() - began
    assert took[4] < 8 * took[1] + 1
