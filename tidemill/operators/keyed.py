"""Keyed stores: upsert, merge by rank and deduplication, without sorting groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, key: list[str], version: list[str]) -> DataFrame:
    """One row per key: the one of the highest version columns, in their order, nulls lowest.

    Rows of one version that differ otherwise are decided by the other columns' order, so the result
    doesn't depend on partitions. Copies meet in partial aggregation before the shuffle.
    """
    rest = [c for c in df.columns if c not in key and c not in version]
    best = df.groupBy(*key).agg(F.max(F.struct(*version, *rest)).alias("__best"))
    return best.select(*key, *[F.col("__best")[c].alias(c) for c in [*version, *rest]]).select(*df.columns)


STATUS_RANK = {"complete": 4, "partial": 3, "partial_unknown_target": 3, "failed": 2, "in_progress": 1}


def status_rank(status: Column) -> Column:
    out = F.lit(0)
    for name, rank in STATUS_RANK.items():
        out = F.when(status == name, rank).otherwise(out)
    return out


def merge_states(old: DataFrame, new: DataFrame, key: str, status: str = "status", kept: tuple[str, ...] = (), highest: tuple[str, ...] = ()) -> DataFrame:
    """Imported state merged into a store: the higher status rank wins the whole row, else the old row.

    Columns `kept` stay the old ones where they have a value; columns `highest` become the greater.
    Rows of either side alone are taken over.
    """
    a, b = old.alias("a"), new.alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    wins = F.col(f"a.{key}").isNull() | (F.col(f"b.{key}").isNotNull() & (status_rank(F.col(f"b.{status}")) > status_rank(F.col(f"a.{status}"))))
    out = []
    for c in old.columns:
        x, y = F.col(f"a.{c}"), F.col(f"b.{c}")
        if c == key or c in kept:
            out.append(F.coalesce(x, y).alias(c))
        elif c in highest:
            out.append(F.greatest(x, y).alias(c))
        else:
            out.append(F.when(wins, y).otherwise(x).alias(c))
    return both.select(*out)


def first_claims(claims: DataFrame, item: str, order: list[str]) -> DataFrame:
    """Of several claims on an item, the first in `order`."""
    return latest_first(claims, [item], order)


def latest_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in key and c not in order]
    best = df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("__best"))
    return best.select(*key, *[F.col("__best")[c].alias(c) for c in [*order, *rest]]).select(*df.columns)


def fold_states(states: DataFrame, key: str, order: str, status: str = "status", kept: tuple[str, ...] = (), highest: tuple[str, ...] = ()) -> DataFrame:
    """The states of each key merged in their order by the rule of merge_states, in one aggregation.

    The row of the highest status rank wins, the first at a tie; columns `kept` are the first row's, columns
    `highest` the greatest.
    """
    best = F.struct(-status_rank(F.col(status)), F.col(order))
    rest = [c for c in states.columns if c not in (key, *kept, *highest)]
    return states.groupBy(key).agg(*[F.min_by(c, F.col(order)).alias(c) for c in kept], *[F.max(c).alias(c) for c in highest], *[F.min_by(c, best).alias(c) for c in rest]).select(*states.columns)
