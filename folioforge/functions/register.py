"""The name functions for SQL users.

They are SQL functions, so the optimizer inlines their bodies; no UDF runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from folioforge.functions.similarity import THRESHOLD

_NORMAL = r"""btrim(regexp_replace(regexp_replace(translate(regexp_replace(lower(coalesce(name, '')), r'[\n\r\t]+', ' '), '–—', '--'),
  r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x85\p{Z}.&\-']+", ' '), r'[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' '))"""
_WORDS = "array_distinct(filter(split({}, ' '), t -> t <> ''))"
_OVERLAP = f"""coalesce(try_divide(size(array_intersect({_WORDS.format('a')}, {_WORDS.format('b')})), size(array_union({_WORDS.format('a')}, {_WORDS.format('b')}))), 0D)"""


def register(spark: SparkSession, prefix: str = "ff_") -> list[str]:
    """Create ``normal_name(name)``, ``name_score(p, e)`` and ``name_match_type(p, e)`` as
    temporary functions of a session; returns their names."""
    p = prefix
    bodies = {
        f"{p}normal_name(name STRING) RETURNS STRING": _NORMAL,
        f"{p}overlap(a STRING, b STRING) RETURNS DOUBLE": _OVERLAP,
        f"{p}score_of(a STRING, b STRING) RETURNS DOUBLE": f"""CASE WHEN a = '' OR b = '' THEN 0D WHEN a = b THEN 1D
            WHEN contains(a, b) OR contains(b, a) THEN 0.8D + 0.2D * (least(length(a), length(b)) / greatest(length(a), length(b))) ELSE {p}overlap(a, b) END""",
        f"{p}type_of(a STRING, b STRING) RETURNS STRING": f"""CASE WHEN a = '' OR b = '' THEN 'no_match' WHEN a = b THEN 'exact'
            WHEN contains(a, b) OR contains(b, a) THEN 'substring' WHEN {p}overlap(a, b) >= {THRESHOLD}D THEN 'token_overlap' ELSE 'no_match' END""",
        f"{p}name_score(p STRING, e STRING) RETURNS DOUBLE": f"{p}score_of({p}normal_name(p), {p}normal_name(e))",
        f"{p}name_match_type(p STRING, e STRING) RETURNS STRING": f"{p}type_of({p}normal_name(p), {p}normal_name(e))",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in bodies]
