"""Collector state over the posts and the telemetry: recovery, claims, statuses, requeueing and termination replayed."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tidemill.plans.base import COMMENTS, comments, posts
from tidemill.plans.catalog import query
from tidemill.plans.collector import _EVENTS, NOW_S, telemetry
from tidemill.streaming import state as S

# Each post's state is read from its captures and page: a reason by its shortcode's length, as the tables hold none.
_STATE = (
    COMMENTS
    + """
    , n AS (SELECT post, count(*) AS captured FROM c GROUP BY post), u AS (SELECT p.post, coalesce(captured, 0) AS captured, total_comments AS target, CASE length(p.post) % 4 WHEN 0 THEN 'comments_exhausted_bottom_reached' WHEN 1 THEN 'tab_load_timeout' WHEN 2 THEN 'post_unavailable' ELSE 'max_post_runtime_reached' END AS reason,
        CASE WHEN view_count > 0 THEN 'view_all_comments_text' ELSE 'og_description' END AS source, like_count > 0 AS active, length(p.post) % 3 AS attempts FROM p LEFT JOIN n ON p.post = n.post WHERE p.post IS NOT NULL),
    st AS (SELECT *, CASE WHEN (target > 0 AND captured >= target) OR (coalesce(target, 0) <= 0 AND reason = 'comments_exhausted_bottom_reached' AND captured >= 50) THEN 'complete' WHEN coalesce(target, 0) <= 0 AND captured > 0 AND reason <> 'post_unavailable' THEN 'partial_unknown_target'
        WHEN captured > 0 AND reason <> 'post_unavailable' THEN 'partial' ELSE 'failed' END AS status FROM u)
    """
)


def post_states(spark, root):
    n = comments(spark, root).groupBy("post").agg(F.count("*").alias("captured"))
    size = F.length("post")
    reason = F.when(size % 4 == 0, "comments_exhausted_bottom_reached").when(size % 4 == 1, "tab_load_timeout").when(size % 4 == 2, "post_unavailable").otherwise("max_post_runtime_reached")
    p = posts(spark, root).where("post IS NOT NULL").join(n, "post", "left").select("post", F.coalesce("captured", F.lit(0)).alias("captured"), F.col("total_comments").alias("target"), reason.alias("reason"), F.when(F.col("view_count") > 0, "view_all_comments_text").otherwise("og_description").alias("source"), (F.col("like_count") > 0).alias("active"), (size % 3).alias("attempts"))
    return p.withColumn("status", S.final_status(F.col("captured"), F.col("target"), F.col("reason")))


@query(_STATE + " SELECT status, reason, count(*) AS posts, CAST(sum(captured) AS BIGINT) AS captured FROM st GROUP BY ALL")
def final_statuses(spark, root):
    """Posts by the status their collection ended with, and why."""
    return post_states(spark, root).groupBy("status", "reason").agg(F.count("*").alias("posts"), F.sum("captured").alias("captured"))


@query(_STATE + " SELECT post, status, status IN ('partial', 'partial_unknown_target') AND attempts < 2 OR status = 'failed' AS claimable, coalesce(target > 0 AND source = 'view_all_comments_text' AND captured / target >= 0.9, false) OR (coalesce(target, 0) <= 0 AND captured >= 50) AS covered, status = 'failed' AND captured = 0 AND NOT coalesce(active, false) AND reason = 'tab_load_timeout' AS requeued, captured > 0 OR coalesce(active, false) OR (status = 'failed' AND reason <> 'tab_load_timeout') AS meaningful FROM st")
def claimable_posts(spark, root):
    """Which posts may be claimed again, need no collecting, go back to the queue, and were really attempted."""
    s = post_states(spark, root)
    c = F.col
    active, yes = F.coalesce(c("active"), F.lit(False)), F.lit(True)
    return s.select(
        "post", "status", S.claimable(c("status"), c("attempts"), yes, yes).alias("claimable"), S.covered(c("captured"), c("target"), c("source"), skip_unknown=True).alias("covered"),
        S.requeued(c("status"), c("captured"), active, c("reason")).alias("requeued"), S.meaningful(c("captured"), active, c("status"), c("reason")).alias("meaningful"),
    )


@query(_STATE + " SELECT CASE WHEN NOT (captured > 0 OR coalesce(active, false) OR (status = 'failed' AND reason <> 'tab_load_timeout')) THEN 'preload' ELSE status END AS bucket, reason, count(*) AS n FROM st WHERE status IN ('failed', 'partial', 'partial_unknown_target') GROUP BY ALL")
def failures_by_bucket(spark, root):
    """Failed and partial posts by reason; those never really attempted are a bucket of their own."""
    s = post_states(spark, root).where("status IN ('failed', 'partial', 'partial_unknown_target')")
    c = F.col
    tried = S.meaningful(c("captured"), F.coalesce(c("active"), F.lit(False)), c("status"), c("reason"))
    return s.groupBy(F.when(~tried, "preload").otherwise(c("status")).alias("bucket"), "reason").agg(F.count("*").alias("n"))


@query(
    _EVENTS
    + """, l AS (SELECT worker, max_by(kind, struct_pack(a := at_s, b := event_id)) AS kind, max(CASE WHEN kind = 'click' THEN at_s END) AS beat_s, max(at_s) AS updated_s, count(*) FILTER (kind = 'purchase') AS runs FROM e GROUP BY worker)
    SELECT worker, CASE WHEN kind = 'error' THEN 'not_running' WHEN runs % 5 = 0 THEN 'active_run' WHEN 1706745600 - coalesce(beat_s, updated_s) <= 90 THEN 'recent' ELSE 'stale' END AS state, CASE WHEN kind <> 'error' AND runs % 5 <> 0 AND 1706745600 - coalesce(beat_s, updated_s) > 90 THEN 'stopped' ELSE 'running' END AS status FROM l"""
)
def recovery_states(spark, root):
    """Every worker's run by its heartbeat, else its last update; stale ones are marked as interrupted."""
    last = telemetry(spark, root).groupBy("worker").agg(F.max_by("kind", F.struct("at_s", "event_id")).alias("kind"), F.max(F.when(F.col("kind") == "click", F.col("at_s"))).alias("beat_s"), F.max("at_s").alias("updated_s"), F.count_if(F.col("kind") == "purchase").alias("runs"))
    age = F.lit(NOW_S) - S.heartbeat(F.col("beat_s"), F.col("updated_s"))
    s = last.withColumns({"state": S.recovery_state(F.col("kind") != "error", age, F.col("runs") % 5 == 0), "status": F.lit("running")})
    return S.interrupted(s, F.col("state") == "stale", F.lit(NOW_S)).select("worker", "state", "status")


@query(_STATE + ", q AS (SELECT post, status, row_number() OVER (ORDER BY post) AS position FROM st WHERE status = 'failed') SELECT post, position FROM q ORDER BY position LIMIT 1")
def next_claimable(spark, root):
    """The first post of the queue that waits."""
    s = post_states(spark, root).where("status = 'failed'").orderBy("post").limit(1)
    return s.select("post", F.lit(1).alias("position"))


_HOURS = _EVENTS + ", h AS (SELECT session, CAST(floor(at_s / 3600) AS BIGINT) AS hour, count(*) FILTER (kind = 'signup') AS added, CAST(sum(captured) AS BIGINT) AS top FROM e GROUP BY ALL)"


@query(
    _HOURS
    + """, r AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY hour) AS n, lag(top, 1, -1) OVER (PARTITION BY session ORDER BY hour) AS before FROM h),
    g AS (SELECT *, count(*) FILTER (added > 0) OVER (PARTITION BY session ORDER BY hour) AS grp, count(*) FILTER (NOT (top <= before + 2 AND added = 0)) OVER (PARTITION BY session ORDER BY hour) AS moves, sum(added) OVER (PARTITION BY session ORDER BY hour) AS total FROM r),
    i AS (SELECT *, count(*) FILTER (added = 0) OVER (PARTITION BY session, grp ORDER BY hour) AS idle, count(*) FILTER (top <= before + 2 AND added = 0) OVER (PARTITION BY session, moves ORDER BY hour) AS stuck FROM g),
    s AS (SELECT *, CASE WHEN total >= 60 THEN 'max_posts_discovery_limit_60' WHEN idle >= 3 THEN 'no_new_posts_after_3_rounds' WHEN stuck >= 2 THEN 'profile_scroll_stuck' WHEN n >= 20 THEN 'profile_max_rounds_reached_20' END AS reason FROM i)
    SELECT session, min(hour) AS hour, arg_min(reason, hour) AS reason FROM s WHERE reason IS NOT NULL GROUP BY session"""
)
def discovery_termination(spark, root):
    """When, and why, each session's discovery would have ended: an hour is a round, sign-ups are posts found."""
    hours = telemetry(spark, root).groupBy("session", F.floor(F.col("at_s") / 3600).alias("hour")).agg(F.count_if(F.col("kind") == "signup").alias("added"), F.sum("captured").alias("top"))

    def replay(rows: pd.DataFrame) -> pd.DataFrame:
        d = S.Discovery(no_new=3, stuck=2, max_rounds=20, max_posts=60)
        for r in rows.sort_values("hour").itertuples():
            if d.round(int(r.added), float(r.top)):
                return pd.DataFrame([(r.session, r.hour, d.reason)], columns=["session", "hour", "reason"])
        return pd.DataFrame([], columns=["session", "hour", "reason"])

    return hours.groupBy("session").applyInPandas(replay, "session bigint, hour bigint, reason string")  # at most 24 rows a session


@query(_EVENTS + ", r AS (SELECT event_id, worker, kind, captured, row_number() OVER (PARTITION BY worker ORDER BY at_s, event_id) - 1 AS round FROM e) SELECT worker, count(*) FILTER (round <= 5 OR captured > 50 OR round % 5 = 0 OR kind = 'error') AS kept, count(*) AS snapshots FROM r GROUP BY worker")
def snapshot_sampling(spark, root):
    """How many of each worker's snapshots are kept."""
    from pyspark.sql import Window

    w = Window.partitionBy("worker").orderBy("at_s", "event_id")
    r = telemetry(spark, root).withColumn("round", F.row_number().over(w) - 1)
    kept = S.sampled(F.col("round"), F.when(F.col("captured") > 50, 1).otherwise(0), F.when(F.col("kind") == "error", F.col("kind")))
    return r.groupBy("worker").agg(F.count_if(kept).alias("kept"), F.count("*").alias("snapshots"))
