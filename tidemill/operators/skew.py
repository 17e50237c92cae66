"""Joins that stay level when one key holds a great part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut, small_enough

#: A key with more than this part of all rows is hot, so fewer keys than its inverse are.
HOT_PART = 1 / 1000
#: Right rows of a lookup (about 200 bytes each) up to which all are broadcast.
SENT_ROWS = 50_000


def hot_keys(df: DataFrame, on: list[str], part: float = HOT_PART) -> DataFrame:
    """The keys, null ones left out, that hold more than `part` of df's rows: fewer than 1 / part rows."""
    counts = cut(df.where(" AND ".join(f"`{c}` IS NOT NULL" for c in on)).groupBy(*on).agg(F.count("*").alias("__n")))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    return counts.where(F.col("__n") > total * part).select(*on)


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", part: float = HOT_PART, sent: int = SENT_ROWS) -> DataFrame:
    """left joined ("inner" or "left") with right, where every key stands at most once in right.

    Up to `sent` right rows are broadcast. Of more, the rows of hot keys meet their few right rows by
    broadcast, the others by shuffle, so no task gets a hot key's rows; rows of null keys are never
    shuffled. left may be read three times: cut it first.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    right = cut(right)
    if small_enough(right, sent):
        return left.join(F.broadcast(right), on, how)
    hot = cut(hot_keys(left, on, part))  # fewer than 1 / part rows, so they and their right rows may be broadcast
    whole = " AND ".join(f"`{c}` IS NOT NULL" for c in on)
    few = cut(right.join(F.broadcast(hot), on, "left_semi"))
    first = left.join(F.broadcast(hot), on, "left_semi").join(F.broadcast(few), on, how)
    rest = left.where(whole).join(F.broadcast(hot), on, "left_anti").join(right, on, how)
    out = first.unionByName(rest)
    if how == "left":
        absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in on]
        out = out.unionByName(left.where(f"NOT ({whole})").select(*left.columns, *absent))
    return out
