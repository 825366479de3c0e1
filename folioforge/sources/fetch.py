"""Fetching what is not landed yet: a read-through cache over HTTP.

An ingest job, apart from the queries.  The transport is a parameter, so
tests need no network.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: (status, body) of a URL.
Get = Callable[[str, dict[str, str]], tuple[int, str]]


class RateLimited(Exception):
    """The server asked for fewer requests, five times in a row."""


def http_get(url: str, headers: dict[str, str]) -> tuple[int, str]:
    import urllib.error
    import urllib.request

    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=60) as r:
            return r.status, r.read().decode("utf-8", errors="replace")
    except urllib.error.HTTPError as e:
        return e.code, ""


def fetched(url: str, user_agent: str, get: Get = http_get, attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> str | None:
    """A body; None for any status but 200 and 429.  429 waits 2, 4, 8 ... seconds, 90 at most, and asks again."""
    for k in range(attempts):
        status, body = get(url, {"User-Agent": user_agent})
        if status == 200:
            return body
        if status != 429:
            return None
        if k + 1 < attempts:
            sleep(min(90.0, max(1.0, 2.0 ** (k + 1))))
    raise RateLimited(url)


def fetch_missing(paths: DataFrame, base_url: str, user_agent: str, get: Get = http_get) -> DataFrame:
    """``(path, content)`` of missing paths; the caller lands them beside the others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "content": [fetched(f"{base_url}/{p}", user_agent, get) for p in pdf["path"]]})

    return paths.select("path").mapInPandas(run, "path string, content string")
