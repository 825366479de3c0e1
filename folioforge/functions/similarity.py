"""Column expressions that compare two names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import normal_name

THRESHOLD = 0.6


def tokens(norm: Column) -> Column:
    """The set of words of a normal form."""
    return F.array_distinct(F.filter(F.split(norm, " "), lambda t: t != ""))


def overlap(a: Column, b: Column) -> Column:
    """Share of the union of two normal forms' words that both have; 0 without words."""
    x, y = tokens(a), tokens(b)
    union = F.size(F.array_union(x, y))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / union)


def score_of(a: Column, b: Column) -> Column:
    """1 for equal normal forms, 0.8 to 1 if one holds the other, else the overlap; 0 if one is empty."""
    la, lb = F.length(a), F.length(b)
    held = F.contains(a, b) | F.contains(b, a)
    return (
        F.when((a == "") | (b == ""), F.lit(0.0)).when(a == b, F.lit(1.0))
        .when(held, F.lit(0.8) + F.lit(0.2) * (F.least(la, lb) / F.greatest(la, lb))).otherwise(overlap(a, b))
    )


def type_of(a: Column, b: Column, threshold: float | Column = THRESHOLD) -> Column:
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (
        F.when((a == "") | (b == ""), F.lit("no_match")).when(a == b, F.lit("exact"))
        .when(F.contains(a, b) | F.contains(b, a), F.lit("substring")).when(overlap(a, b) >= limit, F.lit("token_overlap"))
        .otherwise(F.lit("no_match"))
    )


def matches(a: Column, b: Column, threshold: float | Column = THRESHOLD) -> Column:
    return type_of(a, b, threshold) != "no_match"


def name_score(predicted: Column, expected: Column) -> Column:
    return score_of(normal_name(predicted), normal_name(expected))


def name_match_type(predicted: Column, expected: Column, threshold: float | Column = THRESHOLD) -> Column:
    return type_of(normal_name(predicted), normal_name(expected), threshold)


def names_match(predicted: Column, expected: Column, threshold: float | Column = THRESHOLD) -> Column:
    return matches(normal_name(predicted), normal_name(expected), threshold)
