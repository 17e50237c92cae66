"""The score that links a post with an event near it in time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def proximity(days: Column) -> Column:
    return F.when(days <= 1, 25).when(days <= 3, 18).when(days <= 7, 10).otherwise(0)


def link_score(days: Column, entities: Column, located: Column, captions: Column, phrases: Column, tags: Column, mentioned: Column, markers: Column, captured_ratio: Column, likes_ratio: Column, salience: Column) -> Column:
    """Points for nearness and evidence; 0 beyond a week.

    Nearness and shared entities (8 each) reach 49 at most, 57 within three days. Then a shared place 12,
    caption terms and comment phrases 8 each up to three, hashtags 10 each up to two, 8 for a term said
    in comments where no entity is shared, 7 for two emoji markers, 5 for each unusual activity, 6 for
    a salient event.
    """
    near = proximity(days)
    shared = F.least(near + 8 * entities, F.when(days <= 3, 57).otherwise(49))
    worth = lambda cond, n: F.when(cond, n).otherwise(0)
    total = (
        shared + worth(located, 12) + 8 * F.least(captions, F.lit(3)) + 8 * F.least(phrases, F.lit(3)) + 10 * F.least(tags, F.lit(2)) + worth(mentioned & (entities == 0), 8)
        + worth(markers >= 2, 7) + worth(captured_ratio >= 1.5, 5) + worth(likes_ratio >= 1.5, 5) + worth(salience >= 0.75, 6)
    )
    return F.when(near == 0, 0).otherwise(total)


def confidence(score: Column, evidence: Column) -> Column:
    """The band of a link; without evidence beyond nearness it is temporal only."""
    return F.when(~evidence, "temporal_only").when(score >= 65, "strong").when(score >= 42, "moderate").when(score >= 25, "weak").otherwise("temporal_only")


def reason_slug(prefix: str, value: Column) -> Column:
    """A reason's code: white space becomes _, a leading # becomes hashtag_."""
    return F.concat(F.lit(prefix + ":"), F.regexp_replace(F.regexp_replace(value, r"\s+", "_"), "^#", "hashtag_"))
