"""Per-text figures that tell prose from lists, tables and junk.

Every figure is a JVM expression.  For each language a mergeable quantile
sketch of each figure gives its middle and spread; a text's robust z-scores
against its own language then show which tail it lies in.  A script that
never ends its sentences with a mark, for example, makes no text an outlier
for lacking one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.runtime import cut

#: Scripts by which a language is told, in order; the first with enough letters counts.
SCRIPTS = {
    "ja": r"[\p{IsHiragana}\p{IsKatakana}]", "th": r"\p{IsThai}", "ar": r"\p{IsArabic}", "hi": r"\p{IsDevanagari}",
    "ko": r"\p{IsHangul}", "zh": r"\p{IsHan}", "ru": r"\p{IsCyrillic}", "el": r"\p{IsGreek}", "he": r"\p{IsHebrew}",
}
#: Frequent words of languages in Latin script.
COMMON = {
    "en": "the any each some every another its their this that of in by with under and for will would could should may might must can to from",
    "de": "der die das den dem des und ist im am bei um für ohne laut nach seit von bzw über",
    "fr": "le la les des du une est et pour sur avec sous depuis après en au par sans chaque",
    "es": "el la los las del una para con por sin según desde bajo hasta en al",
    "it": "il lo gli della delle un una per con senza secondo dal nel",
    "pt": "os as do da dos uma para com sem segundo desde até em ao",
    "nl": "het een van voor met zonder volgens sinds op bij de",
}
_CLOSERS = r"[\"'”’»」』)\]]*"
#: A sentence's last mark at the end of a line; in Greek the semicolon asks.
_END = rf"[.!?…。！？؟।؛]{_CLOSERS}$"
_END_GREEK = rf"[.!?…;;]{_CLOSERS}$"
_MARK = r"^\s*(?:[-•▪▫*–·◦‣+]|[0-9]{1,3}[.)]|\(?[a-z]{1,4}\)|\([0-9ivx]{1,5}\))\s"
_VOWELS = "aeiouyáéíóúàèìòùäöüâêîôûãõåæøœñç"
#: A word of natural shape: a run of an uncased script, or a cased word of three letters or more; Latin ones have a vowel.
_NATURAL = (
    r"[\p{Lo}\p{M}]{2,}"
    r"|(?<![\p{L}\p{N}])[\p{IsCyrillic}\p{IsGreek}]{2,}(?![\p{N}])"
    rf"|(?i)(?<![\p{{Lu}}\p{{Ll}}\p{{N}}])(?=\p{{IsLatin}}{{0,20}}[{_VOWELS}])(?-i:\p{{Lu}}?[\p{{Ll}}\p{{M}}]{{2,}}|\p{{Lu}}{{3,}})(?![\p{{Lu}}\p{{Ll}}\p{{N}}/+=])"
)
#: The spread a figure has at least, so that tiny differences make no outliers.
FLOORS = {
    "words": 20.0, "mean_word_length": 1.0, "symbol_ratio": 0.05, "digit_ratio": 0.05, "natural_ratio": 0.06,
    "end_ratio": 0.2, "ends": 0.2, "cell_ratio": 0.1, "mark_ratio": 0.1, "item_ratio": 0.02, "common_ratio": 0.06,
}


def _among(words: list[str]):
    return lambda w: w.isin(words)


_BLANKS = " \n\t\r\u00a0\u3000\u2007\u2009\u202f"


def text_figures(df: DataFrame, id_col: str = "extract_id", text_col: str = "text") -> DataFrame:
    """``(<id_col>, language, <figures>)`` of every row; null texts count as empty.

    The language comes from the script, then from frequent words; it is null
    if neither decides.  The words are cut out once and shared by the figures.
    """
    every = sorted({w for words in COMMON.values() for w in words.split()})
    d = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    d = d.select(
        "_id", "_text",
        F.regexp_extract_all(F.lower("_text"), F.lit(r"[\p{L}\p{N}\p{M}]+"), F.lit(0)).alias("_words"),
        F.filter(F.split("_text", "\n", -1), lambda x: F.trim(x) != "").alias("_lines"),
        F.length(F.translate("_text", _BLANKS, "")).alias("_n"),
    )
    d = d.select(
        "_id", "_text", "_n", F.array_join("_words", "").alias("_joined"),
        F.filter("_words", _among(every)).alias("_common"),
        F.transform("_lines", F.rtrim).alias("_lines"),
        F.greatest("_n", F.lit(1)).cast("double").alias("_chars"),
        F.greatest(F.size("_lines"), F.lit(1)).cast("double").alias("lines"),
        F.size("_words").cast("double").alias("words"),
    )
    ascii_only = F.octet_length("_text") == F.length("_text")
    d = d.select(
        "*", F.greatest(F.col("_n") - F.length("_joined"), F.lit(0)).alias("_symbols"),
        F.when(ascii_only, F.lit("")).otherwise(F.regexp_replace("_joined", r"[\p{IsLatin}\p{N}]+", "")).alias("_foreign"),
    )
    letters = F.length("_joined")
    script = F.lit(None).cast("string")
    for code, pattern in reversed(SCRIPTS.items()):
        n = F.length("_foreign") - F.length(F.regexp_replace("_foreign", pattern, ""))
        script = F.when(n >= F.length("_foreign") * (0.1 if code == "ja" else 0.5), F.lit(code)).otherwise(script)
    d = d.withColumn("_counts", F.array(*(F.size(F.filter("_common", _among(words.split()))) for words in COMMON.values())))
    most = F.array_max("_counts")
    latin = F.when(most > 1, F.get(F.array(*(F.lit(c) for c in COMMON)), (F.array_position("_counts", most) - 1).cast("int")))
    d = d.withColumn("language", F.when((F.length("_foreign") >= 8) & (F.length("_foreign") >= letters * 0.2), script).otherwise(latin))

    def share(holds) -> Column:
        return F.size(F.filter("_lines", holds)) / F.col("lines")

    def ended(x: Column) -> Column:
        tail = F.right(x, F.lit(6))
        return F.when(F.col("language") == "el", tail.rlike(_END_GREEK)).otherwise(tail.rlike(_END))

    def cells(x: Column) -> Column:
        some = F.contains(x, F.lit("|")) | F.contains(x, F.lit("\t")) | F.contains(x, F.lit("   "))
        return some & x.rlike(r"\S\s*\|\s*\S|\S\t+\S|\S {3,}\S")

    between = F.regexp_count("_text", F.lit(r"[;•▪·/|\-] "))
    natural = F.regexp_extract_all("_text", F.lit(_NATURAL), F.lit(0))
    words = F.greatest("words", F.lit(1.0))
    return d.select(
        F.col("_id").alias(id_col), "language", F.length("_text").cast("double").alias("chars"), "lines", "words",
        (letters / words).alias("mean_word_length"),
        (F.col("_symbols") / F.col("_chars")).alias("symbol_ratio"),
        ((F.length("_joined") - F.length(F.translate("_joined", "0123456789", ""))) / F.col("_chars")).alias("digit_ratio"),
        (F.length(F.array_join(natural, "")) / F.col("_chars")).alias("natural_ratio"),
        share(ended).alias("end_ratio"),
        F.coalesce(ended(F.try_element_at("_lines", F.lit(-1))), F.lit(False)).cast("double").alias("ends"),
        share(cells).alias("cell_ratio"),
        share(lambda x: x.rlike(_MARK)).alias("mark_ratio"),
        (between / words).alias("item_ratio"),
        (F.size("_common") / words).alias("common_ratio"),
    )


def sketches(figs: DataFrame, min_chars: int = 80, accuracy: int = 2000) -> DataFrame:
    """One row for each language, and one for all under null: middle and spread of each figure.

    Built over all rows of at least ``min_chars`` characters; partial
    sketches merge, so nothing but sketches is shuffled.
    """
    aggs = [F.percentile_approx(k, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy).alias(k) for k in FLOORS]
    rows = figs.where(F.col("chars") >= min_chars).select("language", *FLOORS)
    both = rows.select(F.explode(F.when(F.col("language").isNull(), F.array(F.lit("*"))).otherwise(F.array(F.lit("*"), "language"))).alias("_lang"), *FLOORS)
    s = both.groupBy("_lang").agg(F.count(F.lit(1)).alias("_rows"), *aggs)
    return s.select("_lang", "_rows", *(
        F.struct(F.get(k, F.lit(1)).alias("mid"), F.greatest((F.get(k, F.lit(2)) - F.get(k, F.lit(0))) / 1.349, F.lit(floor)).alias("spread")).alias(f"_{k}")
        for k, floor in FLOORS.items()
    ))


def _kind() -> Column:
    z = lambda k: F.col(f"z_{k}")
    symbols = (F.col("symbol_ratio") > 0.4) & (z("symbol_ratio") > 4)
    cells = (z("cell_ratio") > 4) & (F.col("cell_ratio") >= 0.5) & (F.col("lines") >= 2)
    # scripts without blanks join foreign names to runs that have no natural shape
    joined = F.coalesce(F.col("language").isin("th", "ja", "zh"), F.lit(False)) & (F.col("natural_ratio") >= 0.4)
    unnatural = ~joined & (z("natural_ratio") < -3) & ((F.col("natural_ratio") < 0.5) | (F.col("natural_ratio") < 0.68) & (F.col("common_ratio") < 0.12))
    unended = (z("ends") < -2) & ((F.col("common_ratio") < 0.2) | (F.col("mark_ratio") >= 0.5))
    itemised = (F.col("mark_ratio") >= 0.5) | (F.col("lines") >= 3) | (z("item_ratio") > 2)
    return (
        F.when(symbols & ~(cells & (F.col("natural_ratio") > 0.3)), "junk").when(cells, "table")
        .when(unnatural, "junk").when(unended & itemised, "list").when(unended, "junk").otherwise("prose")
    )


def text_kinds(
    df: DataFrame, id_col: str = "extract_id", text_col: str = "text", min_chars: int = 80, prior_rows: int = 20
) -> DataFrame:
    """``(<id_col>, language, <figures>, z_<figures>, kind)`` of every row.

    ``kind`` is ``prose``, ``list``, ``table`` or ``junk``; texts under
    ``min_chars`` characters, null and empty ones are ``short``.  A text
    is measured against the texts of its language and all texts together; of
    n texts of a language the first weigh n² / (n² + ``prior_rows``²), so a
    language of few texts leans on all, without a switch.
    An empty table gives an empty result, repeated rows repeat.

    The sketches have one row for each of the languages named in this module,
    which bounds what is broadcast.
    """
    figs = cut(text_figures(df, id_col, text_col))  # numbers only; each text is read once
    s = sketches(figs, min_chars)
    own = s.where(F.col("_lang") != "*")
    pooled = s.where(F.col("_lang") == "*").select(*(F.col(f"_{k}").alias(f"_all_{k}") for k in FLOORS))
    d = figs.join(F.broadcast(own), figs["language"] == own["_lang"], "left").join(F.broadcast(pooled), F.lit(True), "left")
    # a language counts for itself the more, the more texts it has
    rows = F.coalesce(F.col("_rows"), F.lit(0)).cast("double")
    weight = rows * rows / (rows * rows + float(prior_rows) ** 2)

    def blend(k: str, part: str) -> Column:
        pooled = F.col(f"_all_{k}")[part]
        return pooled + weight * (F.coalesce(F.col(f"_{k}")[part], pooled) - pooled)

    ref = {k: {part: blend(k, part) for part in ("mid", "spread")} for k in FLOORS}
    names = [id_col, "language", "chars", "lines", *FLOORS]
    d = d.select(*names, *((F.col(k) - ref[k]["mid"]).alias(f"_d_{k}") for k in FLOORS), *(ref[k]["spread"].alias(f"_s_{k}") for k in FLOORS))
    d = d.select(*names, *((F.col(f"_d_{k}") / F.col(f"_s_{k}")).alias(f"z_{k}") for k in FLOORS))
    return d.withColumn("kind", F.when(F.col("chars") < min_chars, "short").otherwise(_kind()))
