"""Held-out passages that occur in a corpus.

The test items become one generalised suffix automaton over words.  Each
document streams through it once: the automaton holds the longest run of
words ending here that also stands in a row in some item, and its suffix
links lead to the shorter runs that other items share.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: A word: a maximal run of letters or digits.
WORD = re.compile(r"[^\W_]+")
#: Words of test items that one automaton holds, about; more items make more automata, each used in a pass of its own.
BLOCK_WORDS = 200_000


def folded(text: str) -> str:
    """Lower case of the same length: a capital that grows stays as it is."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[object, list[str]]], min_words: int):
        self.step: list[dict[str, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.min_words = min_words
        ends: list[tuple[int, object]] = []
        for item, words in items:
            last = 0
            for w in words:
                last = self._add(last, w)
                ends.append((last, item))
        held: dict[int, set] = {}
        for state, item in ends:
            if self.length[state] >= min_words:
                held.setdefault(state, set()).add(item)
        for s in sorted(range(1, len(self.step)), key=self.length.__getitem__, reverse=True):
            up = self.link[s]
            if s in held and self.length[up] >= min_words:
                held.setdefault(up, set()).update(held[s])
        #: Items that hold the runs which end a state, where those are long enough.
        self.items = {s: tuple(i) for s, i in held.items()}

    def _add(self, last: int, w: str) -> int:
        if w in self.step[last]:
            q = self.step[last][w]
            if self.length[q] == self.length[last] + 1:
                return q
            return self._clone(last, q, w)
        new = len(self.step)
        self.step.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return new

    def _clone(self, p: int, q: int, w: str) -> int:
        twin = len(self.step)
        self.step.append(dict(self.step[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = twin
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = twin
            p = self.link[p]
        return twin

    def runs(self, words: list[str]) -> Iterator[tuple[int, int, int]]:
        """(index of the last word, length, state) wherever the run that ends there is long enough."""
        step, link, length, least = self.step, self.link, self.length, self.min_words
        state = n = 0
        for i, w in enumerate(words):
            to = step[state].get(w)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = step[state].get(w)
            if to is None:
                n = 0
                continue
            state = to
            n += 1
            if n >= least:
                yield i, n, state


def leaks_of(auto: Automaton, text: str) -> dict[object, tuple[int, int, int]]:
    """item -> (longest run, first word, last word) of the runs that one text shares with it."""
    found: dict[object, tuple[int, int, int]] = {}
    least, link, length, items = auto.min_words, auto.link, auto.length, auto.items
    for i, n, state in auto.runs(WORD.findall(folded(text))):
        seen = 0
        while n >= least:
            # the items of a state are among those of its link, so only a growing set brings new ones
            if len(items[state]) > seen:
                for item in items[state]:
                    old = found.get(item)
                    if old is None:
                        found[item] = (n, i - n + 1, i)
                    elif old[2] < i or n > old[0]:
                        found[item] = (max(n, old[0]), min(old[1], i - n + 1), i)
                seen = len(items[state])
            state = link[state]
            n = length[state]
    return found


def spans_of(auto: Automaton, text: str) -> list[tuple[int, int]]:
    """Character spans of all leaked runs of one text, merged, in order."""
    low = folded(text)
    at = [m.span() for m in WORD.finditer(low)]
    words = [low[a:b] for a, b in at]
    return merged([(at[i - n + 1][0], at[i][1]) for i, n, _ in auto.runs(words)])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_held: dict[str, Automaton] = {}


def _automaton_of(key: str, shared, min_words: int) -> Automaton:
    """A worker's automaton, built once for each block and held alone."""
    if key not in _held:
        _held.clear()
        _held[key] = Automaton(shared.value, min_words)
    return _held[key]


def _blocks(items: DataFrame, item_id: str, item_text: str, min_words: int, block_words: int):
    """(key, rows on every worker) of blocks of items, about ``block_words`` words each.

    A count of the words decides how many blocks there are; an item's block
    follows from its text.  The driver sees one block of plain words at a
    time, the workers build the automata.
    """
    rows = items.select(F.col(item_id).alias("_item"), F.col(item_text).alias("_text")).where(F.col("_text").isNotNull() & F.col("_item").isNotNull())
    total = rows.agg(F.sum(F.regexp_count("_text", F.lit(r"[\p{L}\p{N}]+")))).first()[0] or 0
    n = max(1, -(-int(total) // block_words))
    for block in range(n):
        own = rows.where(F.pmod(F.xxhash64("_text"), F.lit(n)) == block) if n > 1 else rows
        words = [(r["_item"], WORD.findall(folded(r["_text"]))) for r in own.toLocalIterator()]
        words = [(item, w) for item, w in words if len(w) >= min_words]
        if words:
            yield uuid.uuid4().hex, items.sparkSession.sparkContext.broadcast(words)


def leaked_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = 13,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(<doc_id>, <item_id>, longest_run, first_word, last_word)``: the items
    of which a document holds at least ``min_words`` words in a row; the
    longest run shared with that item, and the first and last word of any.

    Ids may be of any type.  Null and empty texts and items too short to hold
    such a run give nothing; items that repeat an id are one item.  Repeated
    documents repeat their rows.  The documents are scanned once for each
    block of items and never shuffled.
    """
    d = docs.select(F.col(doc_id).alias("_doc"), F.col(doc_text).alias("_text"))
    schema = T.StructType([
        T.StructField(doc_id, d.schema["_doc"].dataType),
        T.StructField(item_id, items.schema[item_id].dataType),
        T.StructField("longest_run", T.IntegerType()), T.StructField("first_word", T.IntegerType()), T.StructField("last_word", T.IntegerType()),
    ])
    item_type = to_arrow_type(schema[item_id].dataType)

    def scan(key: str, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            auto = _automaton_of(key, shared, min_words)
            for batch in batches:
                at, rest = [], []
                for k, text in enumerate(batch.column(1).to_pylist()):
                    for item, found in leaks_of(auto, text).items() if text else ():
                        at.append(k)
                        rest.append((item, *found))
                cols = list(zip(*rest, strict=True)) or [()] * 4
                types = [item_type, *(pa.int32() for _ in range(3))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int32())), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=schema.names
                )

        return d.mapInArrow(run, schema)

    out = [scan(key, shared) for key, shared in _blocks(items, item_id, item_text, min_words, block_words)]
    if not out:
        return docs.sparkSession.createDataFrame([], schema)
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = 13,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(<doc_id>, text, removed_chars, dropped)``: every document without its
    leaked runs; one of which more than ``max_coverage`` leaked comes out
    empty and ``dropped``.  Null texts stay null, with 0 characters removed.

    Each block of items adds its spans to the rows in a pass of its own; the
    cut itself comes last.
    """
    spans = T.ArrayType(T.ArrayType(T.IntegerType()))
    d = docs.select(F.col(doc_id).alias("_doc"), F.col(doc_text).alias("_text"), F.array().cast(spans).alias("_spans"))

    def marked(rows: DataFrame, key: str, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            auto = _automaton_of(key, shared, min_words)
            for batch in batches:
                found = [
                    [*old, *map(list, spans_of(auto, text))] if text else old
                    for text, old in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, to_arrow_type(spans))], names=["_doc", "_text", "_spans"])

        return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:2], T.StructField("_spans", spans)]))

    for key, shared in _blocks(items, item_id, item_text, min_words, block_words):
        d = marked(d, key, shared)
    schema = T.StructType([
        T.StructField(doc_id, d.schema["_doc"].dataType), T.StructField("text", T.StringType()),
        T.StructField("removed_chars", T.IntegerType()), T.StructField("dropped", T.BooleanType()),
    ])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, dropped = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                spans = merged([tuple(x) for x in found])
                gone = sum(b - a for a, b in spans)
                out = bool(spans) and gone > max_coverage * len(text)
                removed.append(len(text) if out else gone)
                dropped.append(out)
                if spans and not out:
                    cuts = [0, *(x for s in spans for x in s), len(text)]
                    text = "".join(text[cuts[k]: cuts[k + 1]] for k in range(0, len(cuts), 2))
                texts.append("" if out else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(removed, pa.int32()), pa.array(dropped, pa.bool_())],
                names=schema.names,
            )

    return d.mapInArrow(clean, schema)
