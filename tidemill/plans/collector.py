"""Collector state replayed in batches: fencing, leases, heartbeats, status and throughput.

The telemetry is the events table: user_id is a worker, event_type what it reports, the day of ts its
run session, and props.k what it captured.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.values import seconds
from tidemill.plans.base import COMMENTS, comments, posts
from tidemill.plans.catalog import query
from tidemill.sources.tables import table
from tidemill.streaming.state import fenced, freshness, recovery_state

NOW_S = 1706745600  # the end of the telemetry: the replay's clock, given rather than read
_EVENTS = """
    WITH e AS (SELECT event_id, user_id AS worker, event_type AS kind, CAST(floor(epoch(ts)) AS BIGINT) AS at_s, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS session, CAST(json_extract_string(props, '$.k') AS BIGINT) AS captured FROM events)
"""


def telemetry(spark, root):
    e = table(spark, root, "events")
    at = seconds(F.col("ts"))
    return e.select("event_id", F.col("user_id").alias("worker"), F.col("event_type").alias("kind"), at.alias("at_s"), F.floor(at / 86400).alias("session"), F.get_json_object("props", "$.k").cast("bigint").alias("captured"))


@query(_EVENTS + " SELECT kind, count(*) AS n, count(DISTINCT worker) AS workers, CAST(sum(captured) AS BIGINT) AS captured FROM e GROUP BY kind")
def failure_reason_histogram(spark, root):
    """Reports by reason."""
    return telemetry(spark, root).groupBy("kind").agg(F.count("*").alias("n"), F.count_distinct("worker").alias("workers"), F.sum("captured").alias("captured"))


@query(_EVENTS + ", a AS (SELECT worker, max(session) AS active FROM e GROUP BY worker) SELECT event_id, e.worker, session = active AS accepted FROM e JOIN a ON e.worker = a.worker")
def session_fencing(spark, root):
    """Which messages a worker's latest session accepts; those of older sessions are fenced off."""
    e = telemetry(spark, root)
    active = e.groupBy("worker").agg(F.max("session").alias("active"))
    return fenced(e, active, "worker", "session").select("event_id", "worker", "accepted")


@query(_EVENTS + ", l AS (SELECT worker, max(at_s) AS last_s, CAST(sum(captured) AS BIGINT) AS captured FROM e GROUP BY worker) SELECT worker, CASE WHEN 1706745600 - last_s <= 1800 THEN 'leased' WHEN captured > 0 THEN 'partial' ELSE 'queued' END AS status FROM l")
def lease_expiry(spark, root):
    """Leases older than half an hour end: partial if anything was captured, else queued again."""
    last = telemetry(spark, root).groupBy("worker").agg(F.max("at_s").alias("last_s"), F.sum("captured").alias("captured"))
    return last.select("worker", F.when(NOW_S - F.col("last_s") <= 1800, "leased").when(F.col("captured") > 0, "partial").otherwise("queued").alias("status"))


@query(
    _EVENTS
    + """, l AS (SELECT worker, max_by(kind, struct_pack(a := at_s, b := event_id)) AS kind, max(at_s) AS last_s FROM e GROUP BY worker)
    SELECT worker, CASE WHEN kind = 'error' THEN 'not_running' WHEN 1706745600 - last_s <= 90 THEN 'recent' ELSE 'stale' END AS state FROM l"""
)
def heartbeat_recovery(spark, root):
    """Each worker by its last heartbeat: not running, recent or stale."""
    last = telemetry(spark, root).groupBy("worker").agg(F.max_by("kind", F.struct("at_s", "event_id")).alias("kind"), F.max("at_s").alias("last_s"))
    return last.select("worker", recovery_state(F.col("kind") != "error", F.lit(NOW_S) - F.col("last_s")).alias("state"))


@query(_EVENTS + ", s AS (SELECT session, min(at_s) AS a, max(at_s) AS z, CAST(sum(captured) AS BIGINT) AS captured, count(*) AS n FROM e GROUP BY session) SELECT session, n, captured, round(captured * 3600.0 / greatest(z - a, 1), 2) AS per_hour, CASE WHEN 1706745600 - z < 5 THEN 'live' WHEN 1706745600 - z < 30 THEN 'fresh' WHEN 1706745600 - z < 120 THEN 'quiet' ELSE 'silent' END AS freshness FROM s")
def throughput_live_status(spark, root):
    """Capture rate and freshness of every session."""
    s = telemetry(spark, root).groupBy("session").agg(F.min("at_s").alias("a"), F.max("at_s").alias("z"), F.sum("captured").alias("captured"), F.count("*").alias("n"))
    return s.select("session", "n", "captured", F.round(F.col("captured") * 3600.0 / F.greatest(F.col("z") - F.col("a"), F.lit(1)), 2).alias("per_hour"), freshness(F.lit(NOW_S) - F.col("z")).alias("freshness"))


@query()
def adaptive_concurrency(spark, root):
    """How many workers each session would have been allowed, hour by hour, as limits came and went."""
    from tidemill.streaming.state import replay_concurrency

    hour = F.floor(F.col("at_s") / 3600)
    hours = telemetry(spark, root).groupBy("session", hour.alias("hour")).agg(F.count("*").alias("n"), F.count_if(F.col("kind") == "error").alias("limited"))
    return hours.groupBy("session").applyInPandas(replay_concurrency, "session bigint, hour bigint, limited bigint, allowed int")  # at most 24 rows a session


@query(
    COMMENTS
    + """
    , n AS (SELECT post, count(*) AS n FROM c GROUP BY post)
    SELECT p.post, CASE WHEN total_comments > 0 THEN coalesce(n, 0) >= 0.9 * total_comments ELSE coalesce(n, 0) >= 50 END AS covered FROM p LEFT JOIN n ON p.post = n.post
    """
)
def skip_ledger(spark, root):
    """Posts covered well enough not to be collected again."""
    n = comments(spark, root).groupBy("post").agg(F.count("*").alias("n"))
    have = F.coalesce("n", F.lit(0))
    return posts(spark, root).join(n, "post", "left").select("post", F.when(F.col("total_comments") > 0, have >= 0.9 * F.col("total_comments")).otherwise(have >= 50).alias("covered"))


@query(
    """
    WITH r AS (SELECT post_shortcode AS post, count(*) AS attempts, count(*) FILTER (extraction_source IS NULL) AS unknown, max(scraped_at) IS NOT NULL AS active FROM raw_comments GROUP BY 1)
    SELECT post, attempts, unknown, active OR attempts > 0 AS meaningful FROM r
    """
)
def meaningful_attempts(spark, root):
    """Posts for which an attempt brought anything."""
    r = table(spark, root, "raw_comments").groupBy(F.col("post_shortcode").alias("post")).agg(F.count("*").alias("attempts"), F.count_if(F.col("extraction_source").isNull()).alias("unknown"), F.max("scraped_at").isNotNull().alias("active"))
    return r.select("post", "attempts", "unknown", (F.col("active") | (F.col("attempts") > 0)).alias("meaningful"))


@query("SELECT post_shortcode AS post, worker_id, batch_id, count(*) AS captures, count(DISTINCT comment_id) AS comments FROM raw_comments GROUP BY ALL")
def capture_counts(spark, root):
    """Captures by post, worker and batch."""
    return table(spark, root, "raw_comments").groupBy(F.col("post_shortcode").alias("post"), "worker_id", "batch_id").agg(F.count("*").alias("captures"), F.count_distinct("comment_id").alias("comments"))
