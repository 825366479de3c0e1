"""Matching predicted against expected names.

No cross join: a pair that matches is equal, or one name holds the other, or
enough words are common, and each of the three is found by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.binding import let
from folioforge.functions.similarity import THRESHOLD, overlap, score_of, tokens, type_of
from folioforge.functions.text import normal_name


def _named(df: DataFrame, col: str, name: str) -> DataFrame:
    """Distinct (raw name, normal form)."""
    return df.select(F.col(col).alias(name), normal_name(F.col(col)).alias(f"_{name}")).where(F.col(f"_{name}") != "").distinct()


def _grams(norm: Column, k: int) -> Column:
    at = F.sequence(F.lit(1), F.greatest(F.length(norm) - (k - 1), F.lit(1)))
    return F.array_distinct(F.transform(at, lambda i: F.substring(norm, i, F.lit(k))))


def name_pairs(
    predicted: DataFrame, expected: DataFrame, predicted_col: str = "predicted", expected_col: str = "expected",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(predicted, expected, score, type)`` of all pairs of distinct names that match.

    Null and empty names match nothing; the threshold must exceed 0.

    Names are short, so the blocking keys stay few: a held name is found by
    the rarest of its three-character pieces among those of the longer one,
    so a word that many names begin with is no key.  Names whose words overlap enough share one of their rarest words:
    of n words the n - ceil(threshold n) + 1 rarest are keys, so "fund" is
    none where others are left.
    """
    if threshold <= 0:
        raise ValueError("a threshold of 0 matches all with all")
    p, e = _named(predicted, predicted_col, "predicted"), _named(expected, expected_col, "expected")

    def held(short: DataFrame, s: str, long: DataFrame, o: str) -> DataFrame:
        parts = []
        for k in (1, 2, 3):
            size = F.length(f"_{s}")
            pieces = long.where(F.length(f"_{o}") >= k).select(o, f"_{o}", F.explode(_grams(F.col(f"_{o}"), k)).alias("_key"))
            own = short.where(size == k if k < 3 else size >= k).select(s, f"_{s}", F.explode(_grams(F.col(f"_{s}"), k)).alias("_key"))
            # of a name's pieces the one that the fewest longer names hold
            counted = own.join(pieces.groupBy("_key").agg(F.count(F.lit(1)).alias("_in")), "_key")
            keyed = counted.groupBy(s, f"_{s}").agg(F.min(F.struct("_in", "_key")).alias("_k"), F.count(F.lit(1)).alias("_met"))
            # a piece that no longer name holds rules the name out
            keyed = keyed.where(F.col("_met") == F.size(_grams(F.col(f"_{s}"), k))).select(s, f"_{s}", "_k._key")
            parts.append(keyed.join(pieces, "_key").where(F.contains(f"_{o}", f"_{s}")).select("predicted", "_predicted", "expected", "_expected"))
        return parts[0].unionByName(parts[1]).unionByName(parts[2])

    def words(df: DataFrame, side: str) -> DataFrame:
        return df.select(side, f"_{side}", F.explode(tokens(F.col(f"_{side}"))).alias("_key"))

    often = words(p, "predicted").select("_key").unionAll(words(e, "expected").select("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("_in"))

    def rarest(df: DataFrame, side: str) -> DataFrame:
        ranked = words(df, side).join(often, "_key").groupBy(side, f"_{side}").agg(F.sort_array(F.collect_list(F.struct("_in", "_key"))).alias("_w"))
        keep = F.size("_w") - F.ceil(F.size("_w") * F.lit(float(threshold)) - 1e-9).cast("int") + 1
        return ranked.select(side, f"_{side}", F.explode(F.slice("_w", F.lit(1), F.greatest(keep, F.lit(1)))).alias("_k")).select(side, f"_{side}", "_k._key")

    common = rarest(p, "predicted").join(rarest(e, "expected"), "_key").select("predicted", "_predicted", "expected", "_expected")
    common = common.where(overlap(F.col("_predicted"), F.col("_expected")) >= threshold)
    pairs = held(p, "predicted", e, "expected").unionByName(held(e, "expected", p, "predicted")).unionByName(common).distinct()
    return pairs.select(
        "predicted", "expected", score_of(F.col("_predicted"), F.col("_expected")).alias("score"),
        type_of(F.col("_predicted"), F.col("_expected"), threshold).alias("type"),
    )


def best_matches(
    predicted: DataFrame, expected: DataFrame, predicted_col: str = "predicted", expected_col: str = "expected",
    order_col: str | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """``(predicted, best, score)`` of every distinct prediction: its candidate of
    the highest score, the first in ``order_col`` (else by name) on ties; null
    and 0.0 if none reaches the threshold."""
    order = F.min(order_col if order_col else expected_col).alias("_order")
    firsts = expected.groupBy(F.col(expected_col).alias("expected")).agg(order)
    pairs = name_pairs(predicted, expected, predicted_col, expected_col, threshold).where((F.col("score") >= threshold) & (F.col("score") > 0))
    ranked = pairs.join(firsts, "expected").groupBy("predicted").agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("_order"), F.col("expected"))).alias("_best")
    )
    every = predicted.select(F.col(predicted_col).alias("predicted")).distinct()
    found = every.join(ranked, every["predicted"].eqNullSafe(ranked["predicted"]), "left").select(every["predicted"], "_best")
    return found.select("predicted", F.col("_best.expected").alias("best"), F.coalesce(-F.col("_best.s"), F.lit(0.0)).alias("score"))


def batch_match(predictions: Column, expectations: Column, threshold: float = THRESHOLD, typed_at: float = THRESHOLD) -> Column:
    """Greedy one-to-one matching of two arrays of one document, in array order.

    STRUCT<matches, true_positives, false_positives, false_negatives,
    matched_predictions, matched_expectations>.  Each prediction takes the
    first free expectation that matches at ``threshold``; the type is told at
    ``typed_at``, so a pair matched under a lower threshold may be
    ``no_match``.  Null arrays count as empty.
    """
    none = F.array().cast("array<string>")
    p, e = F.coalesce(predictions, none), F.coalesce(expectations, none)
    names = F.struct(p.alias("p"), e.alias("e"), F.transform(p, normal_name).alias("np"), F.transform(e, normal_name).alias("ne"))
    return let(names, lambda n: let(_greedy(n["np"], n["ne"], threshold), lambda taken: _outcome(n, taken, typed_at)))


def _greedy(np_: Column, ne: Column, threshold: float) -> Column:
    """ARRAY<STRUCT<i, j>>: each name takes the first free one it matches."""
    seed = F.array().cast("array<struct<i:int,j:int>>")

    def take(taken: Column, i: Column) -> Column:
        free = F.filter(
            F.sequence(F.lit(0), F.size(ne) - 1),
            lambda j: ~F.exists(taken, lambda t: t["j"] == j) & (type_of(F.get(np_, i), F.get(ne, j), threshold) != "no_match"),
        )
        return let(F.get(free, F.lit(0)), lambda hit: F.when(hit.isNull(), taken).otherwise(
            F.concat(taken, F.array(F.struct(i.cast("int").alias("i"), hit.cast("int").alias("j"))))
        ))

    return F.when((F.size(np_) == 0) | (F.size(ne) == 0), seed).otherwise(F.aggregate(F.sequence(F.lit(0), F.size(np_) - 1), seed, take))


def _outcome(n: Column, taken: Column, typed_at: float) -> Column:
    pairs = F.transform(taken, lambda t: F.struct(
        F.get(n["p"], t["i"]).alias("predicted"), F.get(n["e"], t["j"]).alias("expected"),
        score_of(F.get(n["np"], t["i"]), F.get(n["ne"], t["j"])).alias("score"), type_of(F.get(n["np"], t["i"]), F.get(n["ne"], t["j"]), typed_at).alias("type"),
    ))
    return F.struct(
        pairs.alias("matches"), F.size(taken).alias("true_positives"), (F.size(n["p"]) - F.size(taken)).alias("false_positives"),
        (F.size(n["e"]) - F.size(taken)).alias("false_negatives"), F.transform(taken, lambda t: t["i"]).alias("matched_predictions"),
        F.transform(taken, lambda t: t["j"]).alias("matched_expectations"),
    )


def evaluation(tp: Column, fp: Column, fn: Column) -> tuple[Column, Column]:
    """(precision, recall); 0 where nothing was predicted or expected."""
    ratio = lambda a, b: F.when(a + b > 0, a / (a + b)).otherwise(F.lit(0.0))
    return ratio(tp, fp).alias("precision"), ratio(tp, fn).alias("recall")
