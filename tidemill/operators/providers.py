"""Map and reduce over batches of comments with a text provider; the built-in one works by rules, offline."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.salvage import salvage_array
from tidemill.session import cut

BATCH = 150


class Provider(Protocol):
    def __call__(self, numbered: list[tuple[int, str]]) -> str:
        """An answer in JSON, {"signals": [{"index": 1, "problem": ..., "want": ...}]}, to numbered texts."""


class RuleProvider:
    """Finds problems and wants by cue words, the same on every run."""

    PROBLEM = ("cannot", "never", "always red", "guilty", "nervous", "hates", "refuses", "fell apart")
    WANT = ("wish", "need", "anyone", "please tell", "should have")

    def __call__(self, numbered: list[tuple[int, str]]) -> str:
        found = []
        for i, text in numbered:
            low = text.lower()
            problem = next((c for c in self.PROBLEM if c in low), None)
            want = next((c for c in self.WANT if c in low), None)
            if problem or want:
                found.append({"index": i, "problem": problem, "want": want, "quote": text[:80]})
        return json.dumps({"signals": found})


def with_retries(provider: Provider, attempts: int = 3, wait: float = 1.5, fail: bool = True, sleep: Callable[[float], None] = time.sleep) -> Provider:
    """The provider tried again after a growing wait; at last it fails, or answers with nothing."""

    def call(numbered):
        for k in range(1, attempts + 1):
            try:
                return provider(numbered)
            except Exception:
                if k == attempts:
                    if fail:
                        raise
                    return '{"signals": []}'
                sleep(wait * k)

    return call


def numbered_batches(df: DataFrame, order: list, size: int = BATCH) -> DataFrame:
    """df with batch and index (from 1): rows in order, `size` to a batch.

    Rows are spread over ranges of the order and numbered within each, so batches never cross ranges
    and no task numbers the whole table. The result is computed once, as pointers into batches are
    resolved against it and another evaluation would draw other ranges.
    """
    s = df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    w = Window.partitionBy("__part").orderBy(*order)
    n = F.row_number().over(w) - 1
    return cut(s.withColumn("__n", n).withColumn("batch", F.concat_ws("-", "__part", F.floor(F.col("__n") / size))).withColumn("index", (F.col("__n") % size + 1).cast("int")).drop("__part", "__n"))


def extract_signals(batched: DataFrame, text: str, provider: Provider) -> DataFrame:
    """(batch, index, problem, want): the provider's pointers; any text it quotes is ignored."""

    def f(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("index")
        answer = salvage_array(provider(list(zip(rows["index"].tolist(), rows[text].fillna("").tolist()))), "signals")
        out = [(key[0], int(s["index"]), s.get("problem"), s.get("want")) for s in answer if isinstance(s, dict) and str(s.get("index", "")).isdigit()]
        return pd.DataFrame(out, columns=["batch", "index", "problem", "want"])

    return batched.select("batch", "index", text).groupBy("batch").applyInPandas(f, "batch string, index int, problem string, want string")  # BATCH rows a group


def resolve_pointers(signals: DataFrame, batched: DataFrame) -> DataFrame:
    """Signals joined to the rows they point at; invented pointers and empty signals are dropped."""
    real = signals.where("problem IS NOT NULL OR want IS NOT NULL").dropDuplicates(["batch", "index"])
    return real.join(batched, ["batch", "index"])


def reduce_signals(resolved: DataFrame, groups: int = 8) -> DataFrame:
    """Signals by problem and want in a two-level reduction: counts within groups of batches, then over all."""
    part = resolved.groupBy(F.pmod(F.xxhash64("batch"), F.lit(groups)).alias("group"), "problem", "want").agg(F.count("*").alias("n"), F.sum("likes").alias("likes"))
    return part.groupBy("problem", "want").agg(F.sum("n").alias("n"), F.sum("likes").alias("likes"))
