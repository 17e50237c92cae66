"""Lists, orders and set relations that reports are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import text as T
from tidemill.operators.ranking import top_k
from tidemill.plans.base import COMMENTS, comments, posts
from tidemill.plans.catalog import query
from tidemill.plans.collector import _EVENTS, telemetry
from tidemill.plans.features import _CLUSTERED, AFFECT, FEATURES, STANCE, TENSIONS, clustered, features
from tidemill.plans.scores import SCORED, scored
from tidemill.plans.states import _STATE, post_states
from tidemill.sources.tables import table


@query(COMMENTS + r", e AS (SELECT comment_id, unnest(regexp_extract_all(lower(text), '#([\p{L}\p{N}_]+)', 1)) AS tag FROM c) SELECT tag, count(*) AS n, min(comment_id) AS first_seen FROM e GROUP BY tag ORDER BY n DESC, first_seen, tag LIMIT 25")
def hashtags_first_seen(spark, root):
    """The 25 most frequent hashtags anywhere in a text, repeats counted; at a tie the one seen first."""
    e = comments(spark, root).select("comment_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"#([\p{L}\p{N}_]+)"), 1)).alias("tag"))
    return e.groupBy("tag").agg(F.count("*").alias("n"), F.min("comment_id").alias("first_seen")).orderBy(F.desc("n"), F.asc("first_seen"), F.asc("tag")).limit(25)


@query(_STATE + " SELECT max(post) FILTER (status IN ('complete', 'partial', 'partial_unknown_target')) AS last_collected, max(post) FILTER (status = 'failed') AS last_failed FROM st")
def last_collected_post(spark, root):
    """The last post, in the queue's order, that was collected, and the last that failed."""
    s = post_states(spark, root)
    return s.agg(F.max_by(F.col("post"), F.when(F.col("status") != "failed", F.col("post"))).alias("last_collected"), F.max_by(F.col("post"), F.when(F.col("status") == "failed", F.col("post"))).alias("last_failed"))


@query(_EVENTS + " SELECT event_id, worker, kind FROM e ORDER BY at_s DESC, event_id DESC LIMIT 40")
def event_log_tail(spark, root):
    """The last forty events (a report)."""
    return telemetry(spark, root).orderBy(F.desc("at_s"), F.desc("event_id")).limit(40).select("event_id", "worker", "kind")


@query(
    COMMENTS
    + """, n AS (SELECT p.post, count(c.comment_id) AS n, any_value(title) AS title, any_value(posted_s) AS posted_s FROM p LEFT JOIN c ON p.post = c.post WHERE p.post IS NOT NULL GROUP BY p.post),
    q AS (SELECT 'no_comments' AS list, post FROM n WHERE n = 0 UNION ALL SELECT 'no_caption', post FROM n WHERE title IS NULL UNION ALL SELECT 'no_date', post FROM n WHERE posted_s IS NULL) SELECT list, post FROM q"""
)
def quality_lists(spark, root):
    """Posts that lack comments, a caption or a date, by what they lack."""
    n = comments(spark, root).groupBy("post").agg(F.count("*").alias("n"))
    p = posts(spark, root).where("post IS NOT NULL").join(n, "post", "left")
    lacks = F.array_compact(F.array(F.when(F.col("n").isNull(), "no_comments"), F.when(F.col("title").isNull(), "no_caption"), F.when(F.col("posted_at").isNull(), "no_date")))
    return p.select(F.explode(lacks).alias("list"), "post")


@query(_STATE + ", b AS (SELECT status, reason, count(*) AS n FROM st WHERE status <> 'complete' GROUP BY ALL) SELECT status, list(reason || '=' || n ORDER BY reason) AS reasons FROM b GROUP BY status")
def failure_reason_maps(spark, root):
    """The reasons of each status that isn't complete with their counts, as one list (from a map of counters)."""
    n = post_states(spark, root).where("status <> 'complete'").groupBy("status", "reason").agg(F.count("*").alias("n"))
    m = n.groupBy("status").agg(F.map_from_entries(F.collect_list(F.struct("reason", "n"))).alias("m"))  # a few reasons
    return m.select("status", F.transform(F.array_sort(F.map_entries("m")), lambda x: F.concat_ws("=", x["key"], x["value"])).alias("reasons"))


@query(
    FEATURES
    + f""", s AS (SELECT comment_id, affect, stance FROM f) SELECT comment_id, len(list_filter(['delight', 'awe'], lambda x: NOT list_contains(affect, x))) = 0 AS all_delight, list_has_any(affect, ['grief', 'worry']) AS any_sorrow,
    len(list_filter({list(STANCE)!r}, lambda x: list_contains(stance, x))) AS stances FROM s WHERE len(affect) > 0"""
)
def tag_set_tests(spark, root):
    """Comments with affect tags: whether they have all of one set, any of another, and how many stances."""
    f = features(spark, root).where(F.size("affect") > 0)
    own = lambda xs: F.array(*map(F.lit, xs))
    return f.select("comment_id", (F.size(F.array_except(own(["delight", "awe"]), "affect")) == 0).alias("all_delight"), F.arrays_overlap("affect", own(["grief", "worry"])).alias("any_sorrow"), F.size(F.array_intersect(own(STANCE), "stance")).alias("stances"))


@query(SCORED + " SELECT count(*) AS comments FROM h WHERE NOT generic AND comment_id NOT IN (SELECT comment_id FROM h WHERE high AND comment_id IS NOT NULL)")
def eligible_not_selected(spark, root):
    """Comments that could be evidence and weren't chosen (a difference of sets)."""
    h = scored(spark, root)
    return h.where("NOT generic").select("comment_id").join(h.where("high").select("comment_id"), "comment_id", "left_anti").agg(F.count("*").alias("comments"))


@query(
    _CLUSTERED
    + ", tn AS ("
    + " UNION ALL ".join(f"SELECT cluster, '{t}' AS tension, count(*) FILTER (list_has_any(list_concat(affect, stance), {x!r})) AS a, count(*) FILTER (list_has_any(list_concat(affect, stance), {y!r})) AS b FROM k GROUP BY cluster" for t, (x, y) in TENSIONS.items())
    + "), r AS (SELECT cluster, tension, least(a, b) AS weaker_side, row_number() OVER (PARTITION BY cluster ORDER BY least(a, b) DESC, tension) AS rank FROM tn WHERE a >= 8 AND b >= 8) SELECT * FROM r WHERE rank <= 4"
)
def strongest_tensions(spark, root):
    """The four tensions of each cluster whose weaker side is strongest."""
    from tidemill.plans.features import cluster_tensions

    t = cluster_tensions(spark, root).select("cluster", "tension", F.least("first_side", "second_side").alias("weaker_side"))
    return top_k(t, ["cluster"], [F.desc("weaker_side"), F.asc("tension")], 4)


@query(_CLUSTERED + ", n AS (SELECT cluster, count(*) AS size, count(DISTINCT post) AS posts FROM k GROUP BY cluster) SELECT cluster, size, posts, row_number() OVER (ORDER BY size DESC, cluster) AS rank FROM n ORDER BY size DESC, cluster LIMIT 40")
def clusters_by_size(spark, root):
    """The forty largest clusters by rank; a cluster's name doesn't change with it."""
    from pyspark.sql import Window

    n = clustered(spark, root).groupBy("cluster").agg(F.count("*").alias("size"), F.count_distinct("post").alias("posts"))
    best = n.orderBy(F.desc("size"), F.asc("cluster")).limit(40)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("size"), F.asc("cluster"))))  # forty rows


@query(
    """WITH t AS (SELECT lower(trim(regexp_replace(label, '[\\s]+', ' ', 'g'))) AS label, count_estimate AS n FROM themes WHERE label IS NOT NULL), s AS (SELECT label, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n, count(*) AS merged FROM t GROUP BY label)
    SELECT label, n, merged, CASE WHEN n >= 15 THEN 'high' WHEN n >= 6 THEN 'medium' ELSE 'low' END AS band FROM s"""
)
def synthesis_merge(spark, root):
    """Themes of one label merged, their counts summed and banded: arithmetic that no model is asked to do."""
    t = table(spark, root, "themes").where("label IS NOT NULL").select(F.lower(F.trim(F.regexp_replace("label", r"[\s]+", " "))).alias("label"), F.coalesce("count_estimate", F.lit(0)).alias("n"))
    s = t.groupBy("label").agg(F.sum("n").alias("n"), F.count("*").alias("merged"))
    return s.withColumn("band", F.when(F.col("n") >= 15, "high").when(F.col("n") >= 6, "medium").otherwise("low"))


@query(_STATE + " SELECT count(*) AS discovered, count(*) FILTER (status IN ('complete', 'partial', 'partial_unknown_target', 'failed')) AS ended, least(100, greatest(0, CAST(round(100.0 * count(*) FILTER (status = 'complete') / count(*)) AS INTEGER))) AS percent_complete, greatest(0, 500 - count(*) FILTER (attempts > 0)) AS budget_left FROM st")
def run_progress(spark, root):
    """How far a run has come, and how many attempts its budget of 500 posts leaves."""
    from tidemill.functions.fields import progress

    done = F.count_if(F.col("status") == "complete")
    s = post_states(spark, root).agg(F.count("*").alias("discovered"), F.count_if(F.col("status").isNotNull()).alias("ended"), done.alias("done"), F.count_if(F.col("attempts") > 0).alias("tried"))
    return s.select("discovered", "ended", progress(F.col("done"), F.col("discovered")).alias("percent_complete"), F.greatest(F.lit(0), F.lit(500) - F.col("tried")).alias("budget_left"))


@query(
    COMMENTS
    + f""", w AS (SELECT post, count(*) AS n, max(likes) AS top FROM c GROUP BY post), m AS (SELECT max(n) AS most FROM w) SELECT post, n, CAST(greatest(6, round(100.0 * n / most)) AS BIGINT) AS bar, top FROM w, m"""
)
def relative_bars(spark, root):
    """The width of each post's bar against the largest, six at least."""
    w = comments(spark, root).groupBy("post").agg(F.count("*").alias("n"), F.max("likes").alias("top"))
    most = w.agg(F.max("n").alias("most"))
    return w.join(F.broadcast(most)).select("post", "n", F.greatest(F.lit(6), F.round(100.0 * F.col("n") / F.col("most")).cast("bigint")).alias("bar"), "top")  # one row


@query(FEATURES + f", t AS (SELECT comment_id, unnest(affect) AS tag FROM f), d(tag, ord) AS (VALUES {', '.join(f"('{k}', {i})" for i, k in enumerate(AFFECT))}) SELECT d.tag, ord, count(t.comment_id) AS comments FROM d LEFT JOIN t ON d.tag = t.tag GROUP BY ALL")
def affect_lookup(spark, root):
    """Every affect tag of the lexicon with its comments, none left out (a dimension's lookup)."""
    d = spark.createDataFrame([(k, i) for i, k in enumerate(AFFECT)], "tag string, ord int")
    n = features(spark, root).select(F.explode("affect").alias("tag")).groupBy("tag").agg(F.count("*").alias("comments"))
    return n.join(F.broadcast(d), "tag", "right").select("tag", "ord", F.coalesce("comments", F.lit(0)).alias("comments"))  # the lexicon


@query(COMMENTS + r" SELECT comment_id, len(regexp_extract_all(lower(text), '@([A-Za-z0-9_.]+)', 1)) AS anywhere, len(list_distinct(regexp_extract_all(lower(text), '(?:^|[^A-Za-z0-9_.@])@([A-Za-z0-9_.]+)', 1))) AS bounded FROM c WHERE contains(text, '@')")
def mention_dialects(spark, root):
    """Mentions read either way: anywhere with repeats, or bounded and distinct."""
    c = comments(spark, root).where(F.contains("text", F.lit("@")))
    return c.select("comment_id", F.size(F.regexp_extract_all(F.lower("text"), F.lit(r"@([A-Za-z0-9_.]+)"), 1)).alias("anywhere"), F.size(T.mentions(F.col("text"))).alias("bounded"))
