"""folioforge: a Spark-first engine for fund-filing text.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame
operators), ``sources`` (readers and writers), ``plans`` (whole pipelines),
``streaming`` (the same plans over file streams).  ``llm`` holds the
training-data operators and is optional: nothing here imports it.
"""

__version__ = "0.1.0"
