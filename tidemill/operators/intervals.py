"""Joins on time windows by equal day buckets, so that no engine compares all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def within_days(left: DataFrame, right: DataFrame, left_s: str, right_s: str, days: int, on: list[str] | None = None) -> DataFrame:
    """Pairs of rows whose times (seconds) are at most `days` apart, and equal in columns `on`.

    Each right row is sent to the buckets of `days` days it can reach (at most three), each left row
    to its own; within a bucket the exact distance decides. Column names must differ except in `on`.
    """
    size = days * 86400
    bucket = lambda c: F.floor(c / size)
    a = left.where(F.col(left_s).isNotNull()).withColumn("__bucket", bucket(F.col(left_s)))
    b = right.where(F.col(right_s).isNotNull()).withColumn("__bucket", F.explode(F.array(*[bucket(F.col(right_s)) + d for d in (-1, 0, 1)])))
    return a.join(b, ["__bucket", *(on or [])]).where(F.abs(F.col(left_s) - F.col(right_s)) <= size).drop("__bucket")


def nearest(left: DataFrame, right: DataFrame, key: str, left_s: str, right_s: str, right_id: str, days: int) -> DataFrame:
    """(key, right_id, gap_s): the right row nearest in time within `days`, at a tie the smaller right_id."""
    near = within_days(left.select(key, left_s), right.select(right_id, right_s), left_s, right_s, days)
    best = near.groupBy(key).agg(F.min(F.struct(F.abs(F.col(left_s) - F.col(right_s)).alias("gap_s"), right_id)).alias("b"))
    return best.select(key, F.col("b")[right_id].alias(right_id), F.col("b.gap_s").alias("gap_s"))


def days_between(a: Column, b: Column) -> Column:
    return F.abs(a - b) / 86400
