"""The N best items of every group by simultaneous bisection of per-group cutoffs.

An item's code is its score followed by its identifier, ordered so that a larger score and, at equal
scores, a smaller identifier come first. Where the collection's scores and identifiers fit 63 bits
together the code is one number; otherwise it is two, the second bisected among ties of the first. All
groups larger than N narrow their cutoff at once: each round counts, by one partial aggregation, the
rows above the 2 ** ROUND_BITS - 1 midpoints of each group's open interval (ROUND_BITS bisections in one
pass), until the interval is one code. No group is ever sorted or collected; a window sees only a
group's few counts.

Groups of more than 1 / HOT_GROUPS of all rows, fewer than HOT_GROUPS, meet their cutoffs by broadcast
in place; the other groups, none of which can fill a task, by shuffle on the group, unless they are few
enough to be broadcast as well. Rows are read from one checkpoint in every round; only the groups'
intervals are written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import cut, small_enough

ROUND_BITS = 6
#: States of at most so many groups (about 60 bytes each) are broadcast.
BROADCAST_GROUPS = 50_000
HOT_GROUPS = 50_000


def _bits(lo: Column, hi: Column) -> Column:
    """How many low bits of the codes between lo and hi are open."""
    return F.when(lo == hi, 0).otherwise(F.length(F.bin(lo.bitwiseXOR(hi))))


def _nth(rows: DataFrame, need: DataFrame, sent: bool) -> DataFrame:
    """(g, cut, left): the largest v with at least `need` rows at or above it, and need minus those above it.

    rows: (g, v bigint), need: (g, need), where every g of `need` has at least need >= 1 rows. sent:
    whether the groups' states are few enough to be broadcast.
    """
    held = lambda state: F.broadcast(state) if sent else state
    state = cut(rows.join(held(need), "g").groupBy("g", "need").agg(F.min("v").alias("lo"), F.max("v").alias("hi")))
    done = []
    while True:
        done.append(state.where("lo = hi").select("g", F.col("lo").alias("cut"), F.col("need").alias("left")))
        state = state.where("lo < hi")
        if not state.take(1):
            break
        open_rows = rows.join(held(state.select("g", "lo", "hi")), "g").where("v >= lo AND v <= hi").select("g", "v", _bits(F.col("lo"), F.col("hi")).alias("bits"))
        # the open bits' highest ROUND_BITS say between which midpoints a code lies; the flipped sign orders negative codes first
        flipped, rest = F.col("v").bitwiseXOR(F.lit(-(1 << 63))), F.greatest(F.col("bits") - ROUND_BITS, F.lit(0))
        part = F.call_function("shiftrightunsigned", flipped, rest).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.least(F.col("bits"), F.lit(ROUND_BITS))) - 1)
        counted = open_rows.groupBy("g", part.alias("part")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        above = F.coalesce(F.sum("n").over(Window.partitionBy("g").orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        joined = counted.withColumn("above", above).join(held(state.select("g", "need")), "g")
        state = cut(joined.where("above < need AND need <= above + n").select("g", (F.col("need") - F.col("above")).alias("need"), "lo", "hi"))
    return cut(reduce(DataFrame.unionByName, done))


def _cutoffs(items: DataFrame, limits: DataFrame, sent: bool) -> DataFrame:
    held = lambda state: F.broadcast(state) if sent else state
    ends = items.agg(*[f(c).alias(f"{k}_{c}") for c in ("score", "id") for k, f in (("lo", F.min), ("hi", F.max))]).first()
    need = limits.select("g", F.col("n").alias("need"))
    if ends.lo_score is not None:
        id_bits = (ends.hi_id - ends.lo_id).bit_length()
        if (ends.hi_score - ends.lo_score).bit_length() + id_bits <= 63:
            code = F.call_function("shiftleft", F.col("score") - F.lit(ends.lo_score), F.lit(id_bits)) + (F.lit(ends.hi_id) - F.col("id"))
            found = _nth(items.select("g", code.alias("v")), need, sent)
            score = F.call_function("shiftright", F.col("cut"), F.lit(id_bits)) + F.lit(ends.lo_score)
            rest = F.col("cut").bitwiseAND(F.lit((1 << id_bits) - 1))
            return found.select("g", score.alias("cut_score"), (F.lit(ends.hi_id) - rest).alias("cut_id"))
    by_score = _nth(items.select("g", F.col("score").alias("v")), need, sent)
    ties = items.join(held(by_score), "g").where("score = cut").select("g", F.expr("~id").alias("v"))
    by_id = _nth(cut(ties), by_score.select("g", F.col("left").alias("need")), sent)
    return by_score.select("g", F.col("cut").alias("cut_score")).join(by_id.select("g", F.expr("~cut").alias("cut_id")), "g")


def _parts(items: DataFrame, sizes: DataFrame, limits: DataFrame) -> list[tuple[DataFrame, DataFrame, bool]]:
    """(items, limits, whether they may be broadcast) of all limited groups at once, or of hot ones and of the others."""
    if small_enough(limits, BROADCAST_GROUPS):
        return [(items, limits, True)]
    total = sizes.agg(F.sum("count")).first()[0] or 0
    hot = cut(limits.join(sizes, "g").where(F.col("count") * HOT_GROUPS > total).select("g", "n"))  # fewer than HOT_GROUPS rows
    rest = cut(items.join(F.broadcast(hot.select("g")), "g", "left_anti").repartition("g"))
    return [(items, hot, True), (rest, limits.join(F.broadcast(hot.select("g")), "g", "left_anti"), False)]


def group_cutoffs(items: DataFrame, sizes: DataFrame, limits: DataFrame) -> list[tuple[DataFrame, DataFrame, bool]]:
    """[(items, (g, cut_score, cut_id), sent)]: an item of a group with a cutoff is among its `n` best iff score > cut_score
    or score = cut_score and id <= cut_id. sent: whether the cutoffs are few enough to be broadcast.

    items: (g, score bigint, id bigint), none null, each id once in its group, read several times;
    sizes: (g, count) of all groups; limits: (g, n bigint >= 1) of groups with more than n items.
    """
    return [(part, _cutoffs(part, own, sent), sent) for part, own, sent in _parts(items, sizes, limits)]


_WITHIN = "score > cut_score OR (score = cut_score AND id <= cut_id)"


def best_items(items: DataFrame, sizes: DataFrame, limits: DataFrame) -> DataFrame:
    """The items among their group's n best; those of groups without limit are all kept. Arguments as of group_cutoffs."""
    found = group_cutoffs(items, sizes, limits)
    limited = [part.join(F.broadcast(cuts) if sent else cuts, "g").where(_WITHIN).select(*items.columns) for part, cuts, sent in found]
    sent = all(s for *_, s in found)
    free = items.join(F.broadcast(limits.select("g")) if sent else limits.select("g"), "g", "left_anti")
    return reduce(DataFrame.unionByName, [free, *limited])


def top_n(df: DataFrame, group: str, item_id: str, score: str, n: int) -> DataFrame:
    """(group, item_id, score): the n best distinct items of every group.

    Copies of an item in a group count once, with their highest score; a null score counts as 0. At
    equal scores the smaller identifier wins. Groups of at most n items are kept whole. Rows without
    group or identifier are no items. n must be at least 1.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    items = cut(
        df.select(F.col(group).alias("g"), F.col(item_id).cast("bigint").alias("id"), F.coalesce(F.col(score).cast("bigint"), F.lit(0)).alias("score"))
        .where("g IS NOT NULL AND id IS NOT NULL")
        .groupBy("g", "id")
        .agg(F.max("score").alias("score"))
    )
    sizes = cut(items.groupBy("g").count())
    large = sizes.where(F.col("count") > n).select("g", F.lit(n).cast("bigint").alias("n"))
    kept = best_items(items, sizes, large)
    return kept.select(F.col("g").alias(group), F.col("id").alias(item_id), F.col("score").alias(score))
