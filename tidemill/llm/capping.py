"""Capping the records of dominant contributors, keeping each one's best.

A share limit is met by water-filling: contributors are sorted by their count, the largest k are cut
to one common level, and k grows until the level lies between the k-th and the next count. With a
limit of `share`, k never exceeds 1 / share, so the solver needs the totals and only that many of
the largest counts, contributors of equal count together. Both limits, of a share of the rows that
come in and of those that go out, are solved so. Which records stay is decided by per-group bisection (top_n), so a contributor
with a third of all rows is neither sorted nor collected.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.top_n import _WITHIN, BROADCAST_GROUPS, group_cutoffs
from tidemill.session import cut, small_enough

ADDRESS = r"(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?(?://)?[^/?#]*(?:/[^/?#]+)*?/(?:p|reel|reels|tv)/([A-Za-z0-9_-]+)"


def shortcode(url: Column) -> Column:
    """The post's shortcode in an address, in its own case; null where there is none."""
    return F.nullif(F.regexp_extract(url, ADDRESS, 1), F.lit(""))


def water_fill(largest: list[tuple[int, int]], total: int, share: float, basis: str = "input", base: int | None = None) -> tuple[int, int]:
    """(level, k): the level to which the k contributors above it are cut so that no share is over the limit.

    largest: (count, contributors with it) in falling order, covering at least 1 / share contributors or
    all; total: the sum of all counts. Contributors are taken from the largest; with k of them cut to one
    level, the level is `share` of the base, and the shares are consistent as soon as the next count is
    within it. basis "input": the base is `base` (default: total) rows, those cut included. basis
    "output": it is what remains, k * level + the others' rows; where the share is below one over the
    number of contributors, no level above 0 is.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    if basis not in ("input", "output"):
        raise ValueError("basis is input or output")
    num, den = _ratio(share)
    whole = total if base is None else base
    k, rest = 0, total
    for count, same in [*largest, (0, 0)]:
        level = whole * num // den if basis == "input" else num * rest // (den - k * num) if k * num < den else None
        if level is not None and count <= level:
            return level, k
        if level is None:
            break
        rest -= count * same
        k += same
    return 0, k


def _ratio(share: float) -> tuple[int, int]:
    """A share such as 0.02 as the fraction it was written as."""
    f = Fraction(str(share))
    return f.numerator, f.denominator


def cap_contributors(df: DataFrame, contributor: Column, record_id: str, quality: str, share: float | None = None, basis: str = "input", max_count: int | None = None) -> DataFrame:
    """df with a column `kept`: false for records over their contributor's limit.

    The limit is the smaller of max_count and the level of `share` (water_fill; all rows of df are
    its base, also those without contributor). A contributor keeps its records of highest quality
    (null counts as 0), at a tie the smaller record_id. Records without contributor or record_id are
    kept. Rows of one contributor with one record_id are one record, of their highest quality. An
    empty df has no limits.
    """
    if share is None and max_count is None:
        raise ValueError("give share or max_count")
    rows = df.withColumns({"__g": contributor, "__id": F.col(record_id).cast("bigint"), "__score": F.coalesce(F.col(quality).cast("bigint"), F.lit(0))})
    named = "__g IS NOT NULL AND __id IS NOT NULL"
    items = cut(rows.where(named).groupBy(F.col("__g").alias("g"), F.col("__id").alias("id")).agg(F.max("__score").alias("score"), F.count("*").alias("copies")))
    repeated = bool(items.where("copies > 1").take(1))
    items = items.drop("copies")
    sizes = cut(items.groupBy("g").count())
    level = max_count
    if share is not None:
        num, den = _ratio(share)
        # contributors of one count are one row, so there are at most about sqrt(2 * rows) and at most 1 / share + 2
        largest = [(r["count"], r.same) for r in sizes.groupBy("count").agg(F.count("*").alias("same")).orderBy(F.desc("count")).limit(math.ceil(den / num) + 1).collect()]
        total = sizes.agg(F.sum("count")).first()[0] or 0
        solved, _ = water_fill(largest, total, share, basis, df.count() if basis == "input" else None)
        level = solved if max_count is None else min(solved, max_count)
    over = sizes.where(F.col("count") > level)
    sent = small_enough(over, BROADCAST_GROUPS)
    if level < 1:
        found = [(items, over.select("g", F.lit((1 << 63) - 1).alias("cut_score"), F.lit(-(1 << 63)).alias("cut_id")), sent)]
    else:
        found = group_cutoffs(items, sizes, cut(over.select("g", F.lit(level).cast("bigint").alias("n"))))
    if sent and not repeated:  # as always with a share alone: fewer than 1 / share contributors are over the level
        cuts = found[0][1].withColumnsRenamed({c: f"__{c}" for c in ("g", "cut_score", "cut_id")})
        judged = rows.join(F.broadcast(cuts), "__g", "left")
        within = (F.col("__score") > F.col("__cut_score")) | ((F.col("__score") == F.col("__cut_score")) & (F.col("__id") <= F.col("__cut_id")))
        kept = F.col("__id").isNull() | F.col("__cut_score").isNull() | within
        return judged.select(*[F.col(c) for c in df.columns], kept.alias("kept"))
    # a record is found again by contributor and identifier, so no contributor's records meet in one task
    dropped = reduce(DataFrame.unionByName, [part.join(F.broadcast(cuts) if own else cuts, "g").where(f"NOT ({_WITHIN})").select("g", "id") for part, cuts, own in found])
    dropped = dropped.select(F.col("g").alias("__g"), F.col("id").alias("__id"), F.lit(False).alias("__kept"))
    out = rows.where(named).join(dropped, ["__g", "__id"], "left")
    free = rows.where(f"NOT ({named})").withColumn("__kept", F.lit(True))
    return out.select(*rows.columns, "__kept").unionByName(free).select(*[F.col(c) for c in df.columns], F.coalesce("__kept", F.lit(True)).alias("kept"))
