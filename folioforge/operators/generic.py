"""Telling generic fund names from specific ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import normal_name

#: The names that count as generic.
DEFAULT_PATTERNS = frozenset([
    "balanced fund",
    "balanced funds",
    "bond fund",
    "bond funds",
    "dividend fund",
    "dividend funds",
    "domestic fund",
    "domestic funds",
    "emerging market fund",
    "emerging market funds",
    "energy fund",
    "energy funds",
    "equity fund",
    "equity funds",
    "etf fund",
    "etf funds",
    "exchange traded fund",
    "exchange traded funds",
    "financial fund",
    "financial funds",
    "foreign fund",
    "foreign funds",
    "fund",
    "funds",
    "global fund",
    "global funds",
    "growth fund",
    "growth funds",
    "healthcare fund",
    "healthcare funds",
    "income fund",
    "income funds",
    "index fund",
    "index funds",
    "industry fund",
    "industry funds",
    "international fund",
    "international funds",
    "investment fund",
    "investment funds",
    "large cap fund",
    "large cap funds",
    "mid cap fund",
    "mid cap funds",
    "money fund",
    "money market fund",
    "money market funds",
    "mutual fund",
    "mutual funds",
    "retirement fund",
    "retirement funds",
    "sector fund",
    "sector funds",
    "small cap fund",
    "small cap funds",
    "stock fund",
    "stock funds",
    "target date fund",
    "target date funds",
    "technology fund",
    "technology funds",
    "the fund",
    "the funds",
    "value fund",
    "value funds",
    "yield fund",
    "yield funds",
])
SHORTEST = 3


class GenericNames:
    """A set of generic name patterns; immutable, every change gives a new one.

    An empty custom set means the defaults, as does none at all.
    """

    def __init__(self, patterns: frozenset[str] | set[str] | None = None):
        self.patterns = frozenset(patterns) if patterns else DEFAULT_PATTERNS

    def plus(self, spark: SparkSession, pattern: str) -> GenericNames:
        """With one more pattern, in its normal form; an empty one changes nothing."""
        norm = _normal(spark, pattern)
        return GenericNames(self.patterns | {norm}) if norm else self

    def minus(self, spark: SparkSession, pattern: str) -> tuple[GenericNames, bool]:
        """Without a pattern, and whether it was there."""
        norm = _normal(spark, pattern)
        return (GenericNames(self.patterns - {norm}), True) if norm in self.patterns else (self, False)

    def is_generic(self, name: Column) -> Column:
        """True for null, empty and short names and for the patterns."""
        norm = normal_name(name)
        return (F.length(norm) <= SHORTEST) | norm.isin(sorted(self.patterns))

    def specific(self, df: DataFrame, name_col: str) -> DataFrame:
        """The rows with specific names; order and repeats stay."""
        return df.where(~self.is_generic(F.col(name_col)))

    def specific_names(self, df: DataFrame, name_col: str) -> DataFrame:
        """The distinct specific names."""
        return df.select(name_col).distinct().where(~self.is_generic(F.col(name_col)))

    def stats(self, df: DataFrame, name_col: str, by: tuple[str, ...] = ()) -> DataFrame:
        """``(total, generic, specific, filter_rate)``, for each group if asked; rate 0 of nothing."""
        generic = F.count_if(self.is_generic(F.col(name_col)))
        total = F.count(F.lit(1))
        out = df.groupBy(*by).agg(total.cast("int").alias("total"), generic.cast("int").alias("generic"))
        return out.select(
            *by, "total", "generic", (F.col("total") - F.col("generic")).alias("specific"),
            F.when(F.col("total") > 0, F.col("generic") / F.col("total")).otherwise(0.0).alias("filter_rate"),
        )


def tracked_names(df: DataFrame, name_col: str) -> DataFrame:
    """``(name)``: the distinct normal forms of predictions, without the empty one."""
    return df.select(normal_name(F.col(name_col)).alias("name")).where(F.col("name") != "").distinct()


def _normal(spark: SparkSession, pattern: str) -> str:
    return spark.range(1).select(normal_name(F.lit(pattern)).alias("n")).first()["n"]
