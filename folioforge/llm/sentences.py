"""Sentences of texts in many languages and scripts.

A linear chain runs over the places of a text where a sentence may end:
sentence marks with the closing marks behind them, and in scripts that write
no marks the blanks.  Each place is tagged boundary or inside; the best tag
sequence is found with Viterbi.  The weights are those of an averaged
structured perceptron.  ``fit`` trains it on two kinds of tagged text: blocks
in which extracted sentences have a known place, and, for languages that have
no such sentences, blocks tagged by general writing rules (``ruled``).

A text in a script without blanks between words that holds no such place at
all is tagged character by character by a second chain.  That one is trained
on text stripped of its marks and blanks (``stripped``), where only the
characters around a place are left to tell a boundary.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks that come in pairs, by the mark that opens.
PAIRS = {"(": ")", "[": "]", "“": "”", "„": "“", "«": "»", "「": "」", "『": "』", "（": "）", "《": "》"}
_OPEN_OF: dict[str, str] = defaultdict(str)
for _o, _c in PAIRS.items():
    _OPEN_OF[_c] += _o
_MARKS = r".!?…。！？؟।။።۔"
#: Scripts that write no sentence marks: Thai, Lao, Khmer.
_UNMARKED = "฀-๿຀-໿ក-៿"
_PLACE = re.compile(rf"[{_MARKS}]+|[;;]|(?<=[{_UNMARKED}])\s+(?=\S)|\s+(?=[{_UNMARKED}])|(?<=[{_UNMARKED}][A-Za-z0-9.])\s+(?=\S)")
_PAIRED = re.compile("[" + re.escape("".join(PAIRS) + "".join(PAIRS.values())) + '"]')
_GREEK = re.compile(r"[Ͱ-Ͽἀ-῿]{3}")
_TOKEN = r"(?:[^\W_]|[\u0300-\u036f\u0610-\u065f\u0900-\u0903\u093a-\u094f])+"
_TOKEN_BEFORE = re.compile(_TOKEN + "$")
_TOKEN_AFTER = re.compile(_TOKEN)
#: Abbreviations after which a sentence goes on, whatever follows.
JOINING = frozenset(
    "dr mr mrs ms prof hr fr st sr sra srta dra d dª mme mlle m mm me nr no nos art abs ziff tz lit rn s z bzw ca vgl inkl zzgl "
    "p pp ex ej cf env approx aprox núm pág cap fig sec vs vol jan feb mar apr jun jul aug sept sep oct nov dec gem evtl ggf usw "
    "п пп т стр гл рис им проф д-р ул д κ κα κος αρ σελ π د أ م ص ر डॉ रु श्री पृ सं ee".split()
)
#: Abbreviations after which a sentence goes on unless a capital follows.
ENDING = frozenset("inc ltd co corp plc llc gmbh ag kg nv sa a v uu u ee uu eu us uk г гг руб коп млн млрд тыс е др χ λπ etc bank jr".split())
MODEL_PATH = Path(__file__).with_name("sentence_model.json")


def _spans_of_pairs(text: str) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Matched marks: closing place -> opening place, and all (open, close) in order.

    A mark without a partner before the next blank line counts as none.
    """
    stack: list[tuple[str, int]] = []
    closed: dict[int, int] = {}
    blocks = [m.end() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    block = 0
    for m in _PAIRED.finditer(text):
        c, i = m.group(), m.start()
        if block < len(blocks) and i >= blocks[block]:
            stack.clear()
            while block < len(blocks) and i >= blocks[block]:
                block += 1
        if c == '"':
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == '"'), None)
        else:
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in _OPEN_OF.get(c, "")), None)
        if at is not None:
            closed[i] = stack[at][1]
            del stack[at:]
        elif c in PAIRS or c == '"':
            stack.append((c, i))
    return closed, sorted((o, c) for c, o in closed.items())


def _kind(c: str) -> str:
    if not c:
        return "end"
    if c.isupper():
        return "upper"
    if c.islower():
        return "lower"
    if c.isdigit():
        return "digit"
    if c.isalpha():
        return "letter"
    return "open" if c in PAIRS or c in '"¿¡' else "mark"


def places(text: str) -> list[tuple[int, list[str]]]:
    """(end of the mark, features) of each place where a sentence may end."""
    closed, pairs = _spans_of_pairs(text)
    greek = bool(_GREEK.search(text))
    n = len(text)
    capitals = text.isupper()
    out = []
    opened, reach = 0, []  # pairs are walked along with the places, so long texts stay linear
    for m in _PLACE.finditer(text):
        i, j = m.span()
        mark = m.group()
        if mark[0] in ";;" and not greek:
            continue
        blank = mark.isspace()
        end = i if blank else j
        shut = ""
        while not blank and end < n:
            if end in closed:
                shut += text[end]
                end += 1
            elif text[end] in "   " and end + 1 in closed and text[end + 1] == "»":
                shut += "»"
                end += 2
            elif text[end] in _MARKS and shut:
                end += 1
            else:
                break
        if out and end <= out[-1][0]:
            continue
        after = end
        while after < n and text[after].isspace():
            after += 1
        while opened < len(pairs) and pairs[opened][0] < i:
            reach.append(pairs[opened][1])
            opened += 1
        reach = [c for c in reach if c >= end]
        inside = len(reach)
        gap = text[end:after]
        following = text[after: after + 1]
        nxt = _kind(following)
        if capitals and nxt == "upper":
            nxt = "capitals"  # says nothing about a beginning
        glued = "glued" if not gap and following else "apart"
        before = _TOKEN_BEFORE.search(text, max(0, i - 30), i)  # 30 characters of a token tell that it is long
        token = before.group() if before else ""
        word = f"#{min(len(token), 4)}" if token.isdigit() else token.lower() if len(token) <= 6 else "long"
        initial = "initial" if len(token) == 1 and token.isupper() else ""
        dotted = "dotted" if initial and i - len(token) > 0 and text[i - len(token) - 1: i - len(token)] == "." else ""
        head = _TOKEN_AFTER.match(text, after)
        first = head.group().lower() if head else following
        sign = "blank" if blank else mark if len(mark) == 1 else "..." if set(mark) <= {".", "…"} else mark[-1]
        shape = f"{sign}|{nxt}|{glued}"
        feats = [
            f"s={shape}", f"j={'joining' if token.lower() in JOINING else 'ending' if token.lower() in ENDING else ''}|{sign}|{nxt}|{glued}", f"w={word}|{sign}", f"wn={word}|{nxt}", f"f={first}", f"wf={word}|{first}" if len(word) < 5 else "wf",
            f"in={min(inside, 1)}", f"shut={shut[-1:]}|{nxt}|{glued}", f"init={initial}{dotted}|{nxt}",
        ]
        if "\n" in gap:
            feats.append(f"line|{nxt}")
        if len(gap) > 1:
            feats.append(f"wide|{nxt}")
        out.append((end, feats))
    return out


class Chain:
    """Weights of the tag boundary against inside, and of tag transitions."""

    def __init__(self, weights: dict[str, float], moves: list[list[float]]):
        self.weights, self.moves = weights, moves

    def tags(self, features: list[list[str]]) -> list[int]:
        get, moves = self.weights.get, self.moves
        score = [0.0, 0.0]
        back: list[tuple[int, int]] = []
        for k, feats in enumerate(features):
            gain = 0.0
            for f in feats:
                gain += get(f, 0.0)
            if not k:
                score = [0.0, gain + moves[1][1]]
                back.append((1, 1))
                continue
            into = []
            for tag in (0, 1):
                a, b = score[0] + moves[0][tag], score[1] + moves[1][tag]
                into.append((a, 0) if a > b else (b, 1))
            score = [into[0][0], into[1][0] + gain]
            back.append((into[0][1], into[1][1]))
        if not features:
            return []
        tag = int(score[1] > score[0])
        out = [tag]
        for from0, from1 in reversed(back[1:]):
            tag = from1 if tag else from0
            out.append(tag)
        return out[::-1]


def train(sequences: list[tuple[list[list[str]], list[int]]], rounds: int = 8) -> Chain:
    """An averaged structured perceptron over tagged sequences, in their order."""
    weights: dict[str, float] = defaultdict(float)
    moves = [[0.0, 0.0], [0.0, 0.0]]
    sums: dict[str, float] = defaultdict(float)
    move_sums = [[0.0, 0.0], [0.0, 0.0]]
    step = 1
    for _ in range(rounds):
        for features, gold in sequences:
            guess = Chain(weights, moves).tags(features)
            if guess != gold:
                for feats, g, y in zip(features, guess, gold, strict=True):
                    if g != y:
                        for f in feats:
                            weights[f] += y - g
                            sums[f] += step * (y - g)
                for tags, sign in ((gold, 1.0), (guess, -1.0)):
                    for a, b in zip([1, *tags], tags, strict=False):
                        moves[a][b] += sign
                        move_sums[a][b] += step * sign
            step += 1
    mean = {f: round(w - sums[f] / step, 3) for f, w in weights.items()}
    return Chain(
        {f: w for f, w in mean.items() if w}, [[round(moves[a][b] - move_sums[a][b] / step, 3) for b in (0, 1)] for a in (0, 1)]
    )


def labelled(block: str, sentences: list[str]) -> list[tuple[list[list[str]], list[int]]]:
    """Tagged sequences of one block from sentences known to stand in it.

    Each known sentence tags its inner places, its own end and the end of the
    sentence before it; places between known sentences stay out.
    """
    found = places(block)
    tags: dict[int, int] = {}
    for s in sentences:
        a = block.find(s)
        if a < 0 or not s:
            continue
        b = a + len(s)
        for k, (end, _) in enumerate(found):
            if a < end < b:
                tags[k] = 0
            elif end == b or end <= a and not block[end:a].strip():
                tags[k] = 1
    out, k = [], 0
    while k < len(found):
        run = []
        while k < len(found) and k in tags:
            run.append(k)
            k += 1
        if run:
            out.append(([found[r][1] for r in run], [tags[r] for r in run]))
        k += 1
    return out


def ruled(block: str) -> list[tuple[list[list[str]], list[int]]]:
    """A tagged sequence of one block by general rules: no sentence ends inside
    paired marks, in a number or after a joining abbreviation, nor before a
    small letter; every other mark ends one, and so does a blank in scripts
    without marks."""
    found = places(block)
    tags = []
    closed, pairs = _spans_of_pairs(block)
    for end, _ in found:
        after = block[end:].lstrip()
        glued = block[end: end + 1].strip() != ""
        mark_at = end - 1
        while mark_at > 0 and (mark_at in closed or block[mark_at].isspace()) and block[mark_at] not in _MARKS + ";;":
            mark_at -= 1
        mark = block[mark_at]
        inside = any(o < mark_at and c >= end for o, c in pairs)
        shut = mark_at < end - 1
        before = _TOKEN_BEFORE.search(block, max(0, mark_at - 30), mark_at)
        token = before.group().lower() if before else ""
        kind = _kind(after[:1])
        if mark not in _MARKS + ";;":
            tag = 1  # a blank
        elif inside or kind == "lower" or shut and glued:
            tag = 0
        elif mark == "." and (glued or token in JOINING or token.isdigit() and len(token) < 3 and kind in ("upper", "digit")):
            tag = 0
        else:
            tag = 1
        tags.append(tag)
    return [([f for _, f in found], tags)] if found else []


#: Scripts that write no blanks between words: Han, kana, Thai, Lao, Khmer.
_DENSE = re.compile(rf"[\u3040-\u30ff\u3400-\u9fff{_UNMARKED}]")
STRIPPED_PATH = Path(__file__).with_name("stripped_model.json")


def character_features(text: str) -> list[list[str]]:
    """Features of the place behind each character of a stripped text: the characters before and after it."""
    pad = "\u0002\u0002" + text + "\u0003\u0003\u0003"
    out = []
    for k in range(2, len(text) + 2):
        a, b, c, d, e = pad[k - 1], pad[k], pad[k + 1], pad[k + 2], pad[k + 3]
        out.append([f"b{b}", f"ab{a}{b}", f"zab{pad[k - 2]}{a}{b}", f"c{c}", f"cd{c}{d}", f"cde{c}{d}{e}", f"bc{b}{c}", f"abcd{a}{b}{c}{d}"])
    return out


def stripped(sentences_in_order: list[str]) -> tuple[str, list[int]]:
    """Text of sentences without their marks and blanks, and a tag for each character: 1 for the last one of a sentence."""
    text, tags = [], []
    for s in sentences_in_order:
        bare = re.sub(rf"[\s{_MARKS}]+", "", s)
        text.append(bare)
        tags += [0] * (len(bare) - 1) + [1] if bare else []
    return "".join(text), tags


@cache
def stripped_model(path: str = "") -> Chain | None:
    file = Path(path or STRIPPED_PATH)
    if not file.exists():
        return None
    d = json.loads(file.read_text(encoding="utf-8"))
    return Chain(d["weights"], d["moves"])


def _tagged_by_character(text: str, chain: Chain) -> list[int]:
    """Ends of the sentences of a text without marks and blanks, but for its own end."""
    tags = chain.tags(character_features(text))
    return [k + 1 for k, tag in enumerate(tags[:-1]) if tag]


def training_rows(extracts: DataFrame, max_blocks: int = 30_000) -> list[tuple[str, list[str]]]:
    """Blocks and the single sentences extracted from them; at most ``max_blocks``."""
    single = extracts.where((F.col("sentence_index") >= 0) & F.col("context_type").isin("narrative", "parenthetical")).groupBy("document_key").agg(F.collect_set("text").alias("s"))
    block = extracts.where((F.col("sentence_index") == -1) & (F.col("context_type") == "narrative")).select("extract_id", "document_key", "text")
    rows = block.join(single, "document_key").orderBy(F.xxhash64("extract_id")).limit(max_blocks).collect()
    return [(r["text"], sorted(s for s in r["s"] if s and s in r["text"])) for r in rows]


@cache
def model(path: str = "") -> Chain:
    d = json.loads(Path(path or MODEL_PATH).read_text(encoding="utf-8"))
    return Chain(d["weights"], d["moves"])


def sentence_spans(text: str | None, chain: Chain | None = None) -> list[tuple[int, int, bool]]:
    """(start, end, closed) of the sentences of one text, in order, without
    white space around them; an unclosed one has no letters, or no mark at its end
    in a script that writes marks."""
    if not text:
        return []
    found = places(text)
    tags = (chain or model()).tags([f for _, f in found])
    bare = text.strip()
    if not found and len(_DENSE.findall(bare)) * 2 > len(bare) and (second := stripped_model()):
        first = len(text) - len(text.lstrip())
        cuts = [0, *_tagged_by_character(bare, second), len(bare)]
        return [(first + a, first + b, True) for a, b in zip(cuts, cuts[1:], strict=False)]
    out, start = [], 0

    def put(a: int, b: int, done: bool) -> None:
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            out.append((a, b, done and any(c.isalpha() for c in text[a:b])))

    for (end, _), tag in zip(found, tags, strict=True):
        if tag:
            put(start, end, True)
            start = end
    rest = text[start:]
    put(start, len(text), bool(re.search(f"[{_UNMARKED}]", rest)))
    return out


def sentences(df: DataFrame, id_col: str = "extract_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, sentence_no, start_pos, end_pos, closed, sentence)``.

    text[start_pos:end_pos] is the sentence, positions are code points.  Null,
    empty and blank texts have no sentences, repeated rows repeat theirs.  A
    narrow map; memory is bounded by an Arrow batch.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = T.StructType([
        T.StructField(id_col, rows.schema["_id"].dataType), T.StructField("sentence_no", T.IntegerType()), T.StructField("start_pos", T.IntegerType()),
        T.StructField("end_pos", T.IntegerType()), T.StructField("closed", T.BooleanType()), T.StructField("sentence", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = model()
        for batch in batches:
            at, cols = [], ([], [], [], [], [])
            for k, text in enumerate(batch.column(1).to_pylist()):
                for no, (a, b, done) in enumerate(sentence_spans(text, chain)):
                    at.append(k)
                    for col, v in zip(cols, (no, a, b, done, text[a:b]), strict=True):
                        col.append(v)
            types = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int32())), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=schema.names
            )

    return rows.mapInArrow(run, schema)


def ruled_rows(extracts: DataFrame, languages_with_sentences: tuple[str, ...] = ("en",), per_language: int = 150) -> list[str]:
    """Blocks of the other languages, at most ``per_language`` of each."""
    from pyspark.sql import Window

    from folioforge.llm.quality import text_figures

    block = extracts.where((F.col("sentence_index") == -1) & (F.col("context_type") == "narrative")).select("extract_id", "text")
    lang = text_figures(block).where(F.col("language").isNotNull() & ~F.col("language").isin(*languages_with_sentences)).where(F.col("end_ratio") + F.col("ends") > 0)
    thai = text_figures(block).where(F.col("language") == "th")
    order = Window.partitionBy("language").orderBy(F.xxhash64("extract_id"))
    ids = lang.unionByName(thai).select("extract_id", "language").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)
    return [r["text"] for r in block.join(ids, "extract_id").orderBy(F.xxhash64("extract_id")).collect()]


def fit(extracts: DataFrame, out: str, max_blocks: int = 30_000, per_language: int = 150) -> dict[str, float]:
    """Train on a bounded sample of blocks, write the model, return held-out accuracy.

    Every fifth block is held out; the model written is that of the others.
    """
    rows = [labelled(block, known) for block, known in training_rows(extracts, max_blocks)]
    rows += [ruled(block) for block in ruled_rows(extracts, per_language=per_language)]
    own = [q for k, qs in enumerate(rows) if k % 5 for q in qs]
    held = [q for k, qs in enumerate(rows) if not k % 5 for q in qs]
    chain = train(own)
    Path(out).write_text(json.dumps({"moves": chain.moves, "weights": dict(sorted(chain.weights.items()))}, ensure_ascii=False, indent=0) + "\n", encoding="utf-8")
    right = sum(a == b for f, gold in held for a, b in zip(chain.tags(f), gold, strict=True))
    total = sum(len(gold) for _, gold in held)
    return {"places": total, "accuracy": right / max(1, total), "trained_on": sum(len(g) for _, g in own)}


def fit_stripped(extracts: DataFrame, out: str, per_language: int = 300) -> dict[str, dict[str, float]]:
    """Train the chain for text without marks on a bounded sample; returns held-out precision and recall by language.

    The sentences come from the blocks' own marks, in Thai from the blanks,
    which stand between sentences only; both are gone from the training text.
    Every fifth block is held out.
    """
    own, held = [], defaultdict(list)
    for k, text in enumerate(ruled_rows(extracts, per_language=per_language)):
        dense = len(_DENSE.findall(text))
        if dense * 2 < len(text):
            continue
        language = "th" if re.search(f"[{_UNMARKED}]", text) else "ja" if re.search(r"[\u3040-\u30ff]", text) else "zh"
        bare, tags = stripped([text[a:b] for a, b, _ in sentence_spans(text)])
        if k % 5:
            own.append((character_features(bare), tags))
        else:
            held[language].append((character_features(bare), tags))
    chain = train(own, rounds=6)
    small = {f: w for f, w in chain.weights.items() if abs(w) >= 0.2}
    Path(out).write_text(json.dumps({"moves": chain.moves, "weights": dict(sorted(small.items()))}, ensure_ascii=False, indent=0) + "\n", encoding="utf-8")
    chain = Chain(small, chain.moves)
    figures = {}
    for language, rows in held.items():
        guess = [(g, y) for feats, gold in rows for g, y in zip(chain.tags(feats)[:-1], gold[:-1], strict=True)]
        right = sum(g and y for g, y in guess)
        figures[language] = {"blocks": len(rows), "precision": right / max(1, sum(g for g, _ in guess)), "recall": right / max(1, sum(y for _, y in guess))}
    return figures


if __name__ == "__main__":
    import sys

    from pyspark.sql import SparkSession

    session = SparkSession.builder.getOrCreate()
    rows = session.read.parquet(f"{sys.argv[1]}/extracted_text.parquet")
    if "stripped" not in sys.argv[2:]:
        print(fit(rows, str(MODEL_PATH)))
    print(fit_stripped(rows, str(STRIPPED_PATH)))
