"""Sentences and paragraphs that mention names, with their kind of context."""

from __future__ import annotations

import importlib.util
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.classes import WS
from folioforge.functions.text import sentences_of, stripped, text_or_empty
from folioforge.runtime import cut

#: Patterns of contexts, in order.
TABLE = [r"(?mdi)\|\s*[^|]+\s*\|", r"(?mdi)\t.*\t", r"(?mdi)^\s*\$[\d,]+\.?\d*\s*$", r"(?mdi)^\s*\d+\.\d+%\s*$", r"(?mdi)\b(?:Total|Subtotal|Sum)\b.*\$"]
HEADER = [r"(?md)^[A-Z\s]{3,}$", r"(?md)^\d+\.\s+[A-Z]", r"(?md)^[A-Z][^.!?]*:$", r"(?md)^PART\s+[IVX]+", r"(?md)^Item\s+\d+"]
LIST = [r"(?md)^\s*[•·▪▫]\s+", r"(?md)^\s*\d+\.\s+", r"(?md)^\s*[a-z]\)\s+", r"(?md)^\s*-\s+"]
SENTENCE_MIN, PARAGRAPH_MIN, PROMINENT = 20, 50, 0.6


def names_in(text: Column, names: Column) -> Column:
    """The names a text holds in any letter case, also inside words, in list order."""
    low = F.lower(text_or_empty(text))
    return F.filter(names, lambda n: F.contains(low, F.lower(n)))


def _any(text: Column, patterns: list[str]) -> Column:
    out = text.rlike(patterns[0])
    for p in patterns[1:]:
        out = out | text.rlike(p)
    return out


def context_type(text: Column, tags: Column | None, found: Column) -> Column:
    """table, header, list, parenthetical, narrative or other; the first rule that holds decides.

    Tags come first, then a name in parentheses, a line that is mostly a name,
    and the patterns of tables, headers and lists.
    """
    text = text_or_empty(text)
    t = stripped(text)
    tag = lambda k: F.coalesce(F.try_element_at(tags, F.lit(k)), F.lit(False)) if tags is not None else F.lit(False)
    bracketed = F.exists(found, lambda n: F.contains(text, F.concat(F.lit("("), n, F.lit(")"))) | F.contains(text, F.concat(F.lit("("), F.upper(n), F.lit(")"))))
    lines = F.filter(F.split(text, "\n", -1), lambda x: stripped(x) != "")
    prominent = F.exists(found, lambda n: F.exists(lines, lambda x: F.contains(x, n) & (F.length(n) / F.length(stripped(x)) > PROMINENT)))
    return (
        F.when(tag("is_table"), "table").when(tag("is_header"), "header").when(tag("is_list"), "list")
        .when(bracketed, "parenthetical").when(prominent, "header").when(_any(t, TABLE), "table").when(_any(t, HEADER), "header")
        .when(_any(t, LIST), "list").when((F.length(t) > 50) & t.rlike("[.!?]"), "narrative").otherwise("other")
    )


def paragraphs_of(text: Column) -> Column:
    """Stripped pieces between blank lines."""
    return F.transform(F.split(text_or_empty(text), rf"\n{WS}*\n", -1), stripped)


#: Names that are searched one by one; more make an automaton.
LITERAL_NAMES = 16


def _found_in(names: tuple[str, ...]) -> Callable[[Column], Column]:
    """``names_in`` of a given list, whatever its length."""
    if len(names) <= LITERAL_NAMES or importlib.util.find_spec("ahocorasick") is None:
        every = F.array(*(F.lit(n) for n in names)).cast("array<string>")
        return lambda text: names_in(text, every)
    held: list = []

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def find(texts: pd.Series) -> pd.Series:
        if not held:
            held.append(_finder(list(dict.fromkeys((n.lower(), k) for k, n in enumerate(names) if n))))
        return texts.map(lambda t: [names[k] for k in held[0](t.lower())] if t else [])

    return find


@dataclass(frozen=True)
class Extractor:
    """What to look for: names, and a provider of sentences."""

    names: tuple[str, ...]
    sentences: Callable[[Column], Column] = sentences_of

    def extract(
        self, chunks: DataFrame, key_col: str = "document_key", index_col: str = "chunk_index", text_col: str = "chunk", tags_col: str | None = None,
        with_sentences: bool = True, with_paragraphs: bool = True,
    ) -> DataFrame:
        """``(document_key, chunk_index, sentence_index, text, context_type, entity_names_found, quality_score)``.

        Sentences of at least 20 characters keep their index in the chunk,
        paragraphs of at least 50 have -1.  Null chunks have neither.  A few
        names are a literal of the plan, more are one search automaton in each
        worker; nothing is joined or shuffled.
        """
        found = _found_in(self.names)
        tags = F.col(tags_col) if tags_col else F.lit(None).cast("map<string,boolean>")
        d = chunks.where(F.col(text_col).isNotNull()).select(
            F.col(key_col).alias("document_key"), F.col(index_col).cast("int").alias("chunk_index"), F.col(text_col).alias("_chunk"), tags.alias("_tags")
        )
        # a chunk without any name has no unit with one
        d = d.where(F.size(found(F.col("_chunk"))) > 0)
        parts = []
        if with_sentences:
            s = d.select("document_key", "chunk_index", "_tags", F.posexplode(self.sentences(F.col("_chunk"))).alias("sentence_index", "text"))
            parts.append(s.where(F.length("text") >= SENTENCE_MIN))
        if with_paragraphs:
            p = d.select("document_key", "chunk_index", "_tags", F.lit(-1).alias("sentence_index"), F.explode(paragraphs_of(F.col("_chunk"))).alias("text"))
            parts.append(p.where(F.length("text") >= PARAGRAPH_MIN))
        if not parts:
            raise ValueError("ask for sentences, paragraphs or both")
        units = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        units = units.withColumn("entity_names_found", found(F.col("text"))).where(F.size("entity_names_found") > 0)
        return units.select(
            "document_key", "chunk_index", "sentence_index", "text", context_type(F.col("text"), F.col("_tags"), F.col("entity_names_found")).alias("context_type"),
            "entity_names_found", F.lit(0.0).alias("quality_score"),
        )


def _pieces(w: Column, k: int):
    return lambda i: F.concat(F.lit("in "), F.substring(w, i, F.lit(k)))


#: Characters of a word's end that are looked up; longer first words of names are cut to it.
_KEY = 64


#: Names that one automaton on every worker may hold.
MOST_NAMES = 200_000


def _searched(texts: DataFrame, names: DataFrame, text_col: str, name_col: str, most_names: int):
    """The names' (lower case, spelling) on every worker, or None if they are too many."""
    low = F.lower(F.col(name_col))
    n = names.select(F.col(name_col).alias("name"), low.alias("_low")).where(F.col("_low") != "").distinct()
    if importlib.util.find_spec("ahocorasick") is None or n.count() > most_names:
        return n, None
    return n, texts.sparkSession.sparkContext.broadcast([(r["_low"], r["name"]) for r in n.collect()])


def _finder(pairs: list[tuple[str, str]]):
    """A function that gives the names a lower-case text holds, in order."""
    import ahocorasick

    spellings: dict[str, list[str]] = {}
    for key, name in pairs:
        spellings.setdefault(key, []).append(name)
    if not spellings:
        return lambda text: []
    auto = ahocorasick.Automaton()
    for key, own in spellings.items():
        auto.add_word(key, own)
    auto.make_automaton()
    return lambda text: sorted({name for _, own in auto.iter(text) for name in own}) if text else []


def names_of(units: DataFrame, names: DataFrame, text_col: str, name_col: str = "name", most_names: int = MOST_NAMES) -> DataFrame:
    """``units`` that hold names, with them as ``names``, sorted; every row by itself.

    A name list that a count shows to be small goes to the workers as one
    search automaton, and nothing is shuffled.  A longer one is joined by key,
    over row numbers.  Null and empty names and texts have no mentions.
    """
    n, shared = _searched(units, names, text_col, name_col, most_names)
    if shared is None:
        numbered = cut(units.withColumn("_row", F.monotonically_increasing_id()))
        hits = _mentions_by_key(numbered.select("_row", F.lower(text_or_empty(F.col(text_col))).alias("_text")), n, ["_row"])
        found = hits.groupBy("_row").agg(F.array_sort(F.collect_set("name")).alias("names"))
        return numbered.join(found, "_row").select(*units.columns, "names")

    held: list = []

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def find(low: pd.Series) -> pd.Series:
        if not held:
            held.append(_finder(shared.value))
        return low.map(held[0])

    return units.withColumn("names", find(F.lower(text_or_empty(F.col(text_col))))).where(F.size("names") > 0)


def mentions(texts: DataFrame, names: DataFrame, id_cols: list[str], text_col: str, name_col: str = "name", most_names: int = MOST_NAMES) -> DataFrame:
    """``(<id_cols>, name)``: names that texts hold in any letter case, for name lists too long for a literal.

    Rows come out once for each distinct ``id_cols`` and name; see ``names_of``.
    """
    found = names_of(texts.select(*id_cols, F.col(text_col).alias("_text")), names, "_text", name_col, most_names)
    return found.select(*id_cols, F.explode("names").alias("name")).distinct()


def _mentions_by_key(t: DataFrame, n: DataFrame, id_cols: list[str]) -> DataFrame:
    """``mentions`` by an equi-join: where a name of several words stands, a word
    of the text ends with its first word; where a name of one word stands, a
    word holds its first three characters.  The whole name is then looked for.
    """
    word = r"[\p{L}\p{N}]+"
    first = F.regexp_extract("_low", word, 0)
    several = F.col("_low").rlike(rf"{word}[^\p{{L}}\p{{N}}]")
    n = n.select("name", "_low", F.when(several, F.concat(F.lit("end "), F.right(first, F.lit(_KEY)))).otherwise(F.concat(F.lit("in "), F.left(first, F.lit(3)))).alias("_key"))
    single = bool(n.where(F.startswith("_key", F.lit("in "))).limit(1).count())

    def keys(w: Column) -> Column:
        every = F.sequence(F.lit(1), F.length(w))
        tails = F.transform(F.filter(every, lambda i: i > F.length(w) - _KEY), lambda i: F.concat(F.lit("end "), F.substring(w, i, F.length(w))))
        if not single:
            return tails
        parts = F.transform(every, _pieces(w, 3))
        # names of one word may be shorter than three characters
        shorter = (F.transform(every, _pieces(w, k)) for k in (1, 2))
        return F.concat(tails, parts, *shorter)

    found = F.array_distinct(F.regexp_extract_all("_text", F.lit(word), F.lit(0)))
    keyed = t.select("*", F.explode(F.array_distinct(F.flatten(F.transform(found, keys)))).alias("_key"))
    return keyed.join(n, "_key").where(F.contains("_text", "_low")).select(*id_cols, "name").distinct()
