"""Providers of sentences and entities that a model backs.

An operator takes a provider, a function from a text column to an array of
strings.  ``from_model`` makes one of any Python model: it is loaded once in
each worker, when the first text arrives, and shared by all batches there.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.functions.text import text_or_empty

#: What a loaded model does: the strings it finds in a text, in order.
Model = Callable[[str], list[str]]
_loaded: dict[str, Model] = {}


def shared(name: str, load: Callable[[], Model]) -> Model:
    """The model of a name; loaded at its first use in a process."""
    if name not in _loaded:
        _loaded[name] = load()
    return _loaded[name]


def from_model(name: str, load: Callable[[], Model]) -> Callable[[Column], Column]:
    """A provider backed by a model; null counts as the empty text, which no model sees."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def found(texts: pd.Series) -> pd.Series:
        model = shared(name, load)
        return pd.Series([list(model(t)) if t else [] for t in texts], dtype=object)

    return lambda text: found(text_or_empty(text))
