"""External articles on events, kept in a folder by what was asked, so that each question is asked once."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from tidemill.sources.bundles import exists, read_small_json, write_json

KEEP, WAIT_S = 8, 5.5


def cache_key(query: str, start: str, end: str) -> str:
    return hashlib.sha256(f"{query}|{start}|{end}".encode()).hexdigest()[:16]


def articles(spark: SparkSession, folder: str, query: str, start: str, end: str, fetch: Callable[[str, str, str], str | list] | None = None, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """At most KEEP articles on a query between two stamps: kept ones, else what `fetch` answers, after a pause.

    Without `fetch`, as by default, nothing is asked and only kept answers are given. Answers that aren't JSON are empty.
    """
    path = f"{folder.rstrip('/')}/{cache_key(query, start, end)}.json"
    if exists(spark, path):
        return read_small_json(spark, path)
    if fetch is None:
        return []
    sleep(WAIT_S)
    got = fetch(query, start, end)
    if isinstance(got, str):
        try:
            got = json.loads(got)
        except ValueError:
            got = []
    found = list(got.get("articles", []) if isinstance(got, dict) else got or [])[:KEEP]
    write_json(spark, found, path)
    return found
