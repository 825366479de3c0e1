"""Operators for training-data work on filing texts.

Optional: nothing outside this package imports it.  Queries are in
``queries``, their SQL counterparts in ``oracle``.
"""
