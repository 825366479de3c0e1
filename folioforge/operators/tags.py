"""Counts of people, money and role words for each text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import stripped, text_or_empty

#: Patterns of roles and of dollar ranges, in order.
MANAGER = [r"\bportfolio manager\b", r"\bfund manager\b", r"\bindependent trustee\b", r"\binterested person\b"]
TRUSTEE = [r"\bindependent trustee\b", r"\binterested person\b", r"\bchairman of board\b", r"\bchairman of .* committee\b"]
RANGES = [
    r"\$?\s*10,?000", r"\$?\s*50,?000", r"\$?\s*100,?000", r"\$?\s*500,?000", r"\$?\s*1,?000,?000",
    r"over\s+\$?\s*[0-9,]+", r"\$?\s*[0-9,]+\s*[-–]\s*\$?\s*[0-9,]+",
]
#: Rules of the default entity providers: runs of capitalised words after a title or before a role, and amounts of money.
PERSON = r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof)\.?\s+)(?:\p{Lu}\.?\s+){0,3}\p{Lu}[\p{Ll}'’-]+(?:\s+\p{Lu}[\p{Ll}'’-]+){0,2}|\b\p{Lu}[\p{Ll}'’-]+\s+(?:\p{Lu}\.\s+){1,2}\p{Lu}[\p{Ll}'’-]+"
MONEY = r"(?:US)?[$€£¥]\s?[0-9][0-9,]*(?:\.[0-9]+)?(?:\s(?:hundred|thousand|million|billion|trillion))?|\b[0-9][0-9,]*(?:\.[0-9]+)?\s(?:dollars|euros|cents)\b"

Provider = Callable[[Column], Column]


def _any(patterns: list[str]) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


def role_counts(text: Column) -> dict[str, Column]:
    """The four counts that need no entity model."""
    t = text_or_empty(text)
    count = lambda p: F.regexp_count(t, F.lit("(?i)" + p)).cast("int")
    low = F.lower(t)
    return {
        "manager_count": count(_any(MANAGER)), "trustee_count": count(_any(TRUSTEE)), "range_count": count(_any(RANGES)),
        "none_count": ((F.length(low) - F.length(F.replace(low, F.lit("none"), F.lit("")))) / 4).cast("int"),
    }


def person_names(text: Column) -> Column:
    """The default person provider: rules, no model; an approximation."""
    return F.transform(F.regexp_extract_all(text_or_empty(text), F.lit(PERSON), F.lit(0)), lambda p: F.regexp_replace(p, r"^(?:Mr|Mrs|Ms|Dr|Prof)\.?\s+", ""))


def money_amounts(text: Column) -> Column:
    """The default money provider: rules, no model; an approximation."""
    return F.regexp_extract_all(text_or_empty(text), F.lit(MONEY), F.lit(0))


def unique_persons(names: Column) -> Column:
    """How many persons are left: border marks off, too short and short all-capital ones out, lower case, distinct."""
    bare = F.transform(names, lambda n: stripped(F.regexp_replace(n, r"^[|,.;:]+|[|,.;:]+$", "")))
    kept = F.filter(bare, lambda n: (F.length(n) >= 2) & ~((F.length(n) <= 5) & (F.upper(n) == n) & (F.lower(n) != n)))
    return F.size(F.array_distinct(F.transform(kept, F.lower)))


def unique_amounts(amounts: Column) -> Column:
    return F.size(F.array_distinct(F.filter(F.transform(amounts, stripped), lambda a: a != "")))


def tagged(df: DataFrame, id_cols: list[str], text_col: str, persons: Provider = person_names, money: Provider = money_amounts) -> DataFrame:
    """``(<id_cols>, manager_count, trustee_count, person_unique, money_count, range_count, none_count)``.

    Null texts have zeros.  ``persons`` and ``money`` give an array of strings
    for a text column and may be model-backed Arrow UDFs.
    """
    t = F.col(text_col)
    c = role_counts(t)
    return df.select(
        *id_cols, c["manager_count"].alias("manager_count"), c["trustee_count"].alias("trustee_count"),
        unique_persons(persons(t)).alias("person_unique"), unique_amounts(money(t)).alias("money_count"),
        c["range_count"].alias("range_count"), c["none_count"].alias("none_count"),
    )
