"""Top-k per group for small k: Spark keeps k rows of each group in every task before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import cut


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group, numbered from 1. `order` must decide every tie."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def top_values(df: DataFrame, group: list[str], value: str, k: int) -> DataFrame:
    """(group, value, n, rank): the k most frequent values of each group, ties by value."""
    counts = df.groupBy(*group, value).agg(F.count("*").alias("n"))
    if group:
        return top_k(counts, group, [F.desc("n"), F.asc(value)], k)
    best = counts.orderBy(F.desc("n"), F.asc(value)).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), F.asc(value))))  # k rows


def concentration(top1: Column, top3: Column) -> Column:
    """How far a few contributors dominate: high, moderate or broad."""
    return F.when((top1 >= 0.15) | (top3 >= 0.30), "high").when((top1 >= 0.08) | (top3 >= 0.18), "moderate").otherwise("broad")


def grouped_quantiles(df: DataFrame, group: str, value: str, ps: tuple[float, ...], low: float, high: float, bins: int = 4096) -> DataFrame:
    """(group, p, q): exact quantiles of each group with linear interpolation, for values from low to high.

    Values are counted by bin; only the rows of the bins in which a quantile's neighbours lie are ranked, some
    thousandth of a group, so no task holds a group's values. Null values are left out.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    rows = cut(rows.withColumn("bin", F.least(F.greatest(F.floor((F.col("v") - low) / (high - low) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")))
    counts = rows.groupBy("g", "bin").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # at most `bins` rows a group
    held = cut(counts.withColumn("before", before))
    sizes = held.groupBy("g").agg(F.sum("n").alias("size"))
    places = F.array(*[F.struct(F.lit(p).alias("p"), (F.lit(p) * (F.col("size") - 1)).alias("at")) for p in ps])
    wanted = cut(sizes.select("g", F.explode(places).alias("x")).select("g", "x.p", "x.at"))
    hit = held.join(wanted, "g").where("before <= ceil(at) AND before + n > floor(at)").select("g", "bin", "before").distinct()
    near = rows.join(hit, ["g", "bin"])
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("g", "bin").orderBy("v")) - 1 + F.col("before")).select("g", "v", "rank")
    j = wanted.join(ranked, "g").where("rank = floor(at) OR rank = ceil(at)")
    part = F.col("at") - F.floor("at")
    return j.groupBy(F.col("g").alias(group), "p").agg((F.max(F.when(F.col("rank") == F.floor("at"), F.col("v") * (1 - part))) + F.max(F.when(F.col("rank") == F.ceil("at"), F.when(part == 0, 0.0).otherwise(F.col("v") * part)))).alias("q"))
