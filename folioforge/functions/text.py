"""Column expressions for text: normal forms, sanitising and line tests.

All of it runs in the JVM but compatibility normalisation, which Spark has
no builtin for; that one is an Arrow UDF and is skipped for ASCII text.
Null counts as the empty text everywhere.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.binding import let
from folioforge.functions.classes import BLANKS, WORD, WS


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def stripped(c: Column) -> Column:
    """Without white space at either end, all Unicode blanks counted."""
    return F.btrim(c, F.lit(BLANKS))


def normal_name(c: Column) -> Column:
    """The form in which names are compared: lower case, plain dashes, words and
    the marks ``. & ' -`` only, one blank between them."""
    low = F.lower(text_or_empty(c))
    flat = F.translate(F.regexp_replace(low, r"[\n\r\t]+", " "), "–—", "--")
    words = F.regexp_replace(flat, r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}.&\-']+", " ")
    return stripped(F.regexp_replace(words, f"{WS}+", " "))


#: Characters that damaged filings hold. Those without a partner below vanish.
_ARTIFACTS = "|【】〖〗\u0000�™®©•▪○"
_ARTIFACTS_BECOME = "     "


def without_artifacts(c: Column) -> Column:
    """The name form of a text freed of damage: signs and bullets dropped, pipes and wide brackets as blanks."""
    return normal_name(F.translate(text_or_empty(c), _ARTIFACTS, _ARTIFACTS_BECOME))


def is_meaningful(c: Column, min_length: int = 3) -> Column:
    return F.length(normal_name(c)) >= min_length


#: Dashes that become a hyphen, and signs that vanish.
_DASHES = "‐‑‒–—−"
_DROPPED = "™®☐☑☒"


@F.pandas_udf(T.StringType())
def _compatible(s: pd.Series) -> pd.Series:
    def one(t: str) -> str:
        if t.isascii() and t.isprintable():
            return t
        form = unicodedata.normalize("NFKC", t)
        return "".join(ch for ch in form if ch in "\n\t" or unicodedata.category(ch)[0] != "C")

    return s.map(one)


def sanitized(c: Column) -> Column:
    """A document's text for chunking: compatibility form, plain dashes, no
    control characters, joined amounts, single blanks, no blank lines."""
    t = F.translate(_compatible(text_or_empty(c)), _DASHES + _DROPPED, "-" * len(_DASHES))
    t = F.regexp_replace(t, r"\$[\s\x1c-\x1f\x85\p{Z}]+(?=\p{Nd})", r"\$")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    return stripped(F.regexp_replace(t, rf"{WS}*\n{WS}*", "\n"))


def is_empty_line(line: Column) -> Column:
    """Blank, or short without a letter, or made of words of one or two characters."""
    t = stripped(line)
    short = (F.length(t) < 5) & ~t.rlike(r"\p{L}")
    return (t == "") | short | ~t.rlike(WORD + "{3}")


def is_table_row(line: Column) -> Column:
    t = stripped(line)
    return F.contains(t, F.lit("|")) & (t != "|")


def needs_sentences(line: Column) -> Column:
    """Long prose lines: not tabular, not mostly capitals or signs, with a sentence mark."""

    def holds(t: Column) -> Column:
        n = F.length(t)
        capitals = F.length(F.regexp_replace(t, r"\P{IsUppercase}+", ""))
        solid = F.length(F.regexp_replace(t, r"[^\p{L}\p{N}]+", ""))
        return (
            (n >= 50) & t.rlike("[.!?]") & (F.regexp_count(t, F.lit(r"\|")) < 2) & (F.regexp_count(t, F.lit("\t")) < 2)
            & (capitals <= n * 0.7) & (solid >= n * 0.5)
        )

    return let(stripped(line), holds)


#: Abbreviations that end no sentence.
ABBREVIATIONS = "Mr Mrs Ms Dr Prof St Jr Sr No Nos Sec Art Fig Vol Inc Ltd Co Corp vs approx e.g i.e U.S p pp Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec".split()
_ABBREVIATED = r"\b(" + "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS) + r")\.(\s)"
#: Private signs that stand for a kept full stop and for a border.
KEPT, BORDER = "", ""


def sentences_of(c: Column) -> Column:
    """ARRAY of the sentences of a text, stripped, without empty ones.

    A border lies after a sentence mark, its closing marks and white space,
    before a capital of any script, a digit or an opening mark.  Abbreviations keep theirs.
    """
    t = F.regexp_replace(text_or_empty(c), _ABBREVIATED, f"$1{KEPT}$2")
    t = F.regexp_replace(t, r"([.!?][\"”’)\]]*)\s+([\p{Lu}0-9\"“(«¿¡])", f"$1{BORDER}$2")
    t = F.replace(t, F.lit(KEPT), F.lit("."))
    return F.filter(F.transform(F.split(t, BORDER, -1), stripped), lambda s: s != "")
