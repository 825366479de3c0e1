"""One form for text that looks the same.

Characters first go through compatibility normalisation, and ignorable ones
vanish.  Every letter that has Latin doubles then spans a small lattice: the
letter itself or one of its doubles.  A Viterbi search over the whole text
takes the path of the best script-consistent character n-gram score, so a
look-alike inside a Latin word becomes Latin and a Cyrillic or Greek word
stays what it is.  The doubles are those of the public confusables table that
the JVM's Unicode library carries.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Letters whose doubles the table lacks, and signs that always stand for a hyphen.
OWN_DOUBLES = {"Ԛ": "Q", "Լ": "L", "օ": "o", "ո": "n", "ս": "u", "Օ": "O", "Տ": "S", "З": "3", "Ҽ": "e", "հ": "h", "Ꞷ": "W", "Ѡ": "W"}
HYPHENS = dict.fromkeys("‐‑−﹣", "-")

#: Characters that no double, mark, wide form or ignorable can hide behind: plain text needs no search.
PLAIN = r"\x09\x0a\x0d\x20-\x7e¡-§©«¬®°±¶·»¿À-ÿŒœŠšŽžŸ“”„‘’–—•▪…€™�"
_SCORES = {"switch": -4.0, "double": -0.5, "same": 0.0}


def doubles_of(spark: SparkSession) -> dict[str, str]:
    """Letter -> the Latin letters and digits that look like it.

    Two signs are doubles if the confusables table gives them one skeleton; a
    double is a letter or digit of ASCII, and ``I``, ``l`` and ``1`` share a
    skeleton, so a letter can have several.  Letters of scripts written from
    the right stand nowhere in Latin text and have none.
    """
    checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    plain = [chr(c) for c in range(0x30, 0x7B) if chr(c).isalnum()]
    letters = [c for c in map(chr, range(0x80, 0x20000)) if c.isalpha() and unicodedata.normalize("NFKC", c) == c and unicodedata.bidirectional(c) == "L" and not re.match(f"[{PLAIN}]", c)]
    skeletons = checker.getSkeleton("\n".join(plain + letters)).split("\n")
    by_skeleton: dict[str, str] = {}
    for c, form in zip(plain, skeletons, strict=False):
        by_skeleton[form] = by_skeleton.get(form, "") + c
    out = {c: by_skeleton[form] for c, form in zip(letters, skeletons[len(plain):], strict=True) if form in by_skeleton}
    for c, double in OWN_DOUBLES.items():
        out[c] = "".join(dict.fromkeys(double + out.get(c, "")))
    # a digit is no reading of a letter that has letters for doubles
    return {c: "".join(x for x in own if not x.isdigit()) or own for c, own in out.items()}


@lru_cache(maxsize=20_000)
def _script(c: str) -> str:
    if c.isascii():
        return "L" if c.isalpha() else ""
    if not c.isalpha():
        return ""
    name = unicodedata.name(c, "")
    return "L" if name.startswith("LATIN") else name.split(" ")[0]


@lru_cache(maxsize=50_000)
def _compatible(cluster: str) -> str:
    return "".join(HYPHENS.get(c, c) for c in unicodedata.normalize("NFKC", cluster))


#: Where a text is more than its characters one by one: marks and ignorable signs with what they follow, and signs beyond ASCII.
_SPECIAL = regex.compile(r"[^\p{M}\p{DI}]?[\p{M}\p{DI}]+|[^\x00-\x7f]", regex.DOTALL)
_IGNORABLE = regex.compile(r"\p{DI}")


@lru_cache(maxsize=50_000)
def _cluster(text: str) -> tuple[tuple[str, int, int], ...]:
    """(character, start, end) of the form of a base with its marks."""
    out: list[tuple[str, int, int]] = []
    base, start, end = "", 0, 0
    for i, c in enumerate(text):
        if _IGNORABLE.match(c):
            continue
        if base and unicodedata.combining(c):
            base += c
            end = i + 1
            continue
        out += [(x, start, end) for x in _compatible(base)] if base else []
        base, start, end = c, i, i + 1
    out += [(x, start, end) for x in _compatible(base)] if base else []
    return tuple(out)


def _clusters(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Normalised characters and the stretch of the text each comes from."""
    chars: list[str] = []
    at: list[tuple[int, int]] = []
    done = 0
    for m in _SPECIAL.finditer(text):
        a, b = m.span()
        chars += text[done:a]
        at += zip(range(done, a), range(done + 1, a + 1), strict=True)
        for c, start, end in _cluster(m.group()):
            chars.append(c)
            at.append((a + start, a + end))
        done = b
    chars += text[done:]
    at += zip(range(done, len(text)), range(done + 1, len(text) + 1), strict=True)
    return chars, at


class Model:
    """Character bigrams of the reference names, as log odds against chance."""

    def __init__(self, names: list[str], doubles: dict[str, str]):
        self.doubles = doubles
        self.letters = re.compile("[" + "".join(sorted(doubles)) + "]")
        pairs, ones = Counter(), Counter()
        for name in names:
            for word in re.findall(r"[^\W\d_]+", unicodedata.normalize("NFKC", name)):
                w = f" {word} "
                ones.update(w[:-1])
                pairs.update(zip(w, w[1:], strict=False))
        self.odds = {p: max(-2.0, min(2.0, log((n + 0.5) / (ones[p[0]] + 13.0) * 26))) for p, n in pairs.items()}

    def resolve(self, text: str) -> str:
        """The best path through the lattice of a text's characters.

        A state is the letter chosen and its script; what is not a letter
        carries the script on, so the script of the words around decides what
        a word alone leaves open.  Between two letters with doubles there is
        nothing to choose, so only the ends of that stretch are looked at.
        """
        hits = [m.start() for m in self.letters.finditer(text)]
        if not hits:
            return text
        switch, odds = _SCORES["switch"], self.odds
        states: dict[tuple[str, str], float] = {(" ", ""): 0.0}
        trail: list[dict] = []
        done = 0
        for at in hits:
            came: dict[tuple[str, str], tuple[str, str]] = {}
            if done < at:
                states, came = self._across(text, done, at, states)
            new: dict[tuple[str, str], float] = {}
            back: dict[tuple[str, str], tuple[tuple[str, str], str]] = {}
            c = text[at]
            for o in (c, *self.doubles[c]):
                kind = _script(o)
                cost = 0.0 if o == c else _SCORES["double"]
                for (last, script), total in states.items():
                    gain = total + cost
                    if kind and script and kind != script:  # worse inside a word than between words
                        gain += switch if last == " " else 2 * switch
                    if kind == "L":
                        gain += 0.3 * odds.get((last, o), -1.0)
                    key = (o if kind else " ", kind or script)
                    if key not in new or gain > new[key]:
                        new[key] = gain
                        back[key] = (came.get((last, script), (last, script)), o)
            trail.append(back)
            states, done = new, at + 1
        if done < len(text):  # what follows can still turn the last choice
            after, came = self._across(text, done, len(text), states)
            key = max(after, key=after.__getitem__)
            key = came[key]
        else:
            key = max(states, key=states.__getitem__)
        out = list(text)
        for at, back in zip(reversed(hits), reversed(trail), strict=True):
            key, out[at] = back[key]
        return "".join(out)

    def _across(self, text: str, a: int, b: int, states: dict[tuple[str, str], float]):
        """States behind the stretch text[a:b] that holds no letter with doubles, and the state each came from."""
        first = a
        while first < b and not text[first].isalpha():
            first += 1
        new: dict[tuple[str, str], float] = {}
        came: dict[tuple[str, str], tuple[str, str]] = {}
        if first == b:
            for (last, script), total in states.items():
                key = (" ", script)
                if key not in new or total > new[key]:
                    new[key], came[key] = total, (last, script)
            return new, came
        final = b - 1
        while not text[final].isalpha():
            final -= 1
        kind = _script(text[first])
        key = (text[final] if final == b - 1 else " ", _script(text[final]))
        for (last, script), total in states.items():
            if script and kind != script:
                total += _SCORES["switch"] if first > a or last == " " else 2 * _SCORES["switch"]
            if key not in new or total > new[key]:
                new[key], came[key] = total, (last, script)
        return new, came


def one_form(text: str, model: Model) -> tuple[str, list[tuple[int, int]]]:
    """The consistent form of a text and where each of its characters comes from."""
    chars, at = _clusters(text)
    return model.resolve("".join(chars)), at


class Names:
    """Reference names, found in consistent forms of text."""

    def __init__(self, names: list[tuple[object, str]], doubles: dict[str, str], block: int = 200_000):
        import ahocorasick

        self.model = Model([n for _, n in names], doubles)
        self.spelled: dict[str, list[tuple[object, str]]] = {}
        for key, name in names:
            self.spelled.setdefault(one_form(name, self.model)[0], []).append((key, name))
        forms = sorted(f for f in self.spelled if f)
        self.automata = []
        for a in range(0, len(forms), block):
            auto = ahocorasick.Automaton()
            for f in forms[a: a + block]:
                auto.add_word(f, f)
            auto.make_automaton()
            self.automata.append(auto)

    def found(self, text: str) -> Iterator[tuple[object, int, int, bool]]:
        """(key, start, end, exact) of each name of a text; a name inside a longer name is part of that."""
        form, at = one_form(text, self.model)
        hits = []
        for auto in self.automata:
            for end, f in auto.iter(form):
                a, b = end - len(f) + 1, end + 1
                before, after = form[a - 1: a], form[b: b + 1]
                if after and text[at[b][0]] in "™℠":  # signs whose form is letters
                    after = ""
                if (before.isdigit() or _script(before or " ") == "L") and form[a].isalnum():
                    continue
                if (after.isdigit() or _script(after or " ") == "L") and form[end].isalnum():
                    continue
                hits.append((a, b, f))
        hits.sort(key=lambda h: (h[0], -h[1]))
        reach = -1
        for a, b, f in hits:
            if b <= reach:
                continue
            reach = b
            start, end = at[a][0], at[b - 1][1]
            for key, name in self.spelled[f]:
                yield key, start, end, text[start:end] == name


_held: dict[str, Names] = {}


def _names_of(key: str, shared) -> Names:
    """The search structure of a worker, built once for each query."""
    if key not in _held:
        _held.clear()
        _held[key] = Names(*shared.value)
    return _held[key]


def _share(names: DataFrame, key_col: str, name_col: str, max_names: int):
    """The reference table on every worker; its size is checked first."""
    rows = names.select(F.col(key_col), F.col(name_col)).where(F.col(name_col).isNotNull())
    if (n := rows.count()) > max_names:
        raise ValueError(f"{n} reference names: raise max_names only if every worker can hold them")
    return names.sparkSession.sparkContext.broadcast(([(r[0], r[1]) for r in rows.collect()], doubles_of(names.sparkSession)))


def places_of(
    chunked: DataFrame | None = None, extracts: DataFrame | None = None
) -> DataFrame:
    """``(field, record_id, item_no, text)``: every text in which names stand."""
    parts = []
    if chunked is not None:
        parts.append(chunked.select(F.lit("chunk").alias("field"), F.col("chunked_id").alias("record_id"), F.posexplode("text_chunks").alias("item_no", "text")))
    if extracts is not None:
        parts.append(extracts.select(F.lit("text").alias("field"), F.col("extract_id").alias("record_id"), F.lit(0).alias("item_no"), F.col("text")))
        parts.append(extracts.select(F.lit("name").alias("field"), F.col("extract_id").alias("record_id"), F.posexplode("entity_names_found").alias("item_no", "text")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lookalike_names(
    places: DataFrame, names: DataFrame, key_col: str = "entity_id", name_col: str = "name", max_names: int = 5_000_000
) -> DataFrame:
    """``(field, record_id, item_no, <key_col>)``: places that hold a name which
    looks like a reference name but is not written as it.

    One row for each name and place.  Null and empty texts give nothing, as do
    null names; letter case, accents and missing blanks are visible and no
    look-alike.  Plain text (no character that can hide a difference) is
    dropped by a pattern before any Python; the rest is a narrow map.
    """
    shared, query = _share(names, key_col, name_col, max_names), uuid.uuid4().hex
    key_type = names.schema[key_col].dataType
    arrow_key = to_arrow_type(key_type)
    clean = all(re.fullmatch(f"[{PLAIN}]*", n) for _, n in shared.value[0])
    rows = places.select("field", "record_id", "item_no", "text").where(F.length("text") > 0)
    if clean:
        rows = rows.where(F.col("text").rlike(f"[^{PLAIN}]"))
    schema = T.StructType([*rows.schema.fields[:3], T.StructField(key_col, key_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _names_of(query, shared)
        for batch in batches:
            at, keys = [], []
            for k, text in enumerate(batch.column(3).to_pylist()):
                for key in dict.fromkeys(key for key, _, _, exact in known.found(text) if not exact):
                    at.append(k)
                    keys.append(key)
            take = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(take) for c in range(3)), pa.array(keys, arrow_key)],
                names=["field", "record_id", "item_no", key_col],
            )

    return rows.mapInArrow(run, schema)


def in_one_form(
    places: DataFrame, names: DataFrame, key_col: str = "entity_id", name_col: str = "name", max_names: int = 5_000_000
) -> DataFrame:
    """``(field, record_id, item_no, text)``: every text in its consistent form.

    Null texts stay null, empty ones empty; every row comes out.
    """
    shared, query = _share(names, key_col, name_col, max_names), uuid.uuid4().hex
    rows = places.select("field", "record_id", "item_no", "text")
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _names_of(query, shared)
        for batch in batches:
            texts = [t if not t or t.isascii() else one_form(t, known.model)[0] for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), pa.array(texts, pa.string())], names=columns)

    return rows.mapInArrow(run, rows.schema)
