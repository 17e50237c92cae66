"""Evidence that isn't all from one post or author: greedy selection over candidates that suffice for it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ranking import top_k


def select_diverse(df: DataFrame, group: str, item: str, post: str, author: str, score: str, limit: int) -> DataFrame:
    """(group, item, score, place): up to `limit` items of each group, best first, posts and authors not repeated while others are left.

    An item whose post or author already stands is skipped in a first pass; a second pass fills up by
    score alone. Null is one post, or author, like any other; of several rows of an item the best counts.

    The candidates of a group are cut, in parallel, without loss. Of one post and author the first pass
    can only take the best item. When it takes an item of a post, all better ones there are of authors
    that already stand, fewer than `limit`; so only a post's best `limit` authors matter, and an author's
    best `limit` posts likewise. Among these, each item taken rules out 2 limit - 1 others and itself, so the k-th
    is one of the best 2 limit (k - 1) + 1. The second pass needs the `limit` best of all.
    """
    best = [F.desc(score), F.asc(item)]
    rows = df.groupBy(group, item).agg(F.max(F.struct(score, post, author)).alias("h")).select(group, item, *[F.col("h")[c].alias(c) for c in (post, author, score)])
    heads = top_k(rows, [group, post, author], best, 1, "__r").drop("__r")
    few = top_k(top_k(heads, [group, post], best, limit, "__r"), [group, author], best, limit, "__r").drop("__r")
    wide = top_k(few, [group], best, max(limit - 1, 0) * (2 * limit - 1) + 1, "__r").unionByName(top_k(rows, [group], best, limit, "__r")).drop("__r").dropDuplicates([group, item])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([score, item], ascending=[False, True])
        chosen, posts, authors = [], set(), set()
        for r in rows.to_dict("records"):
            p, a = (None if pd.isna(r[c]) else r[c] for c in (post, author))
            if len(chosen) < limit and p not in posts and a not in authors:
                chosen.append(r)
                posts.add(p), authors.add(a)
        taken = {r[item] for r in chosen}
        chosen += [r for r in rows.to_dict("records") if r[item] not in taken][: limit - len(chosen)]
        return pd.DataFrame([(r[group], r[item], r[score], k) for k, r in enumerate(chosen, 1)], columns=[group, item, score, "place"])

    return wide.select(group, item, post, author, score).groupBy(group).applyInPandas(pick, f"{group} {kinds[group]}, {item} {kinds[item]}, {score} {kinds[score]}, place int")  # at most 2 limit**2 rows a group
