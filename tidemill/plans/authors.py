"""Commenters: controls, behaviour segments and concentration."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators.ranking import concentration, top_k
from tidemill.plans.base import COMMENTS
from tidemill.plans.catalog import query
from tidemill.plans.scores import FORMATTED, SCORED, formats, scored

_VOLUME = "CASE WHEN n >= 50 THEN 'prolific' WHEN n >= 10 THEN 'regular' WHEN n >= 2 THEN 'returning' ELSE 'casual' END"


def volume_segment(n):
    return F.when(n >= 50, "prolific").when(n >= 10, "regular").when(n >= 2, "returning").otherwise("casual")


_AUTHORS = ", a AS (SELECT author, count(*) AS n, count(DISTINCT post) AS posts, CAST(sum(likes) AS BIGINT) AS likes, count(*) FILTER (generic) AS generic, count(*) FILTER (list_contains(topics, 'food')) AS food, count(*) FILTER (list_contains(topics, 'emotion')) AS emotion FROM h WHERE author IS NOT NULL GROUP BY author)"


def authors(spark, root):
    has = lambda x: F.count_if(F.array_contains("topics", x))
    return (
        scored(spark, root).where("author IS NOT NULL").groupBy("author")
        .agg(F.count("*").alias("n"), F.count_distinct("post").alias("posts"), F.sum("likes").alias("likes"), F.count_if("generic").alias("generic"), has("food").alias("food"), has("emotion").alias("emotion"))
    )


@query(SCORED + _AUTHORS + f" SELECT author, n, posts, likes, {_VOLUME} AS segment FROM a")
def author_controls(spark, root):
    """Every author's comments, posts, likes and volume segment."""
    return authors(spark, root).select("author", "n", "posts", "likes", volume_segment(F.col("n")).alias("segment"))


@query(SCORED + _AUTHORS + f", w AS (SELECT sum(n) AS total FROM a) SELECT author, n, round(n / total, 4) AS share, {_VOLUME} AS segment FROM a, w ORDER BY n DESC, posts DESC, likes DESC, author LIMIT 12")
def top_authors(spark, root):
    """The twelve authors of most comments, with their share of all."""
    a = authors(spark, root)
    total = a.agg(F.sum("n").alias("total"))
    best = a.orderBy(F.desc("n"), F.desc("posts"), F.desc("likes"), F.asc("author")).limit(12)
    return best.join(F.broadcast(total)).select("author", "n", F.round(F.col("n") / F.col("total"), 4).alias("share"), volume_segment(F.col("n")).alias("segment"))  # one row


_BEHAVIOUR = "CASE WHEN n = 1 THEN 'single' WHEN n >= 50 THEN 'prolific' WHEN food * 2 >= n THEN 'food_focused' WHEN emotion * 2 >= n THEN 'emotional' WHEN generic / n >= 0.65 THEN 'reactor' ELSE 'general' END"


def behaviour(n="n"):
    return (
        F.when(F.col(n) == 1, "single").when(F.col(n) >= 50, "prolific").when(F.col("food") * 2 >= F.col(n), "food_focused").when(F.col("emotion") * 2 >= F.col(n), "emotional")
        .when(F.col("generic") / F.col(n) >= 0.65, "reactor").otherwise("general")
    )


@query(SCORED + _AUTHORS + f", b AS (SELECT *, {_BEHAVIOUR} AS segment FROM a) SELECT segment, count(*) AS authors, CAST(sum(n) AS BIGINT) AS comments, CAST(sum(likes) AS BIGINT) AS likes, round(avg(generic / n), 4) AS mean_generic_share FROM b GROUP BY segment")
def author_behaviour_segments(spark, root):
    """Authors by behaviour, the first rule that fits deciding, and what each segment wrote."""
    b = authors(spark, root).withColumn("segment", behaviour())
    return b.groupBy("segment").agg(F.count("*").alias("authors"), F.sum("n").alias("comments"), F.sum("likes").alias("likes"), F.round(F.avg(F.col("generic") / F.col("n")), 4).alias("mean_generic_share"))


@query(
    SCORED
    + FORMATTED
    + """
    , n AS (SELECT format, author, count(*) AS n FROM h JOIN f ON h.post = f.post WHERE author IS NOT NULL GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY format ORDER BY n DESC, author) AS rank FROM n),
    u AS (SELECT format, CAST(sum(n) AS BIGINT) AS comments, count(*) AS authors, sum(n) FILTER (rank = 1) / sum(n) AS t1, sum(n) FILTER (rank <= 3) / sum(n) AS t3 FROM r GROUP BY format)
    SELECT format, comments, authors, round(t1, 4) AS top1_share, round(t3, 4) AS top3_share, CASE WHEN t1 >= 0.15 OR t3 >= 0.30 THEN 'high' WHEN t1 >= 0.08 OR t3 >= 0.18 THEN 'moderate' ELSE 'broad' END AS concentration FROM u
    """
)
def cluster_author_profile(spark, root):
    """How far each post format's comments come from few authors; only three authors are ranked."""
    n = scored(spark, root).where("author IS NOT NULL").join(formats(spark, root).select("post", "format"), "post").groupBy("format", "author").agg(F.count("*").alias("n"))
    best = top_k(n, ["format"], [F.desc("n"), F.asc("author")], 3).groupBy("format").agg(F.sum(F.when(F.col("rank") == 1, F.col("n"))).alias("one"), F.sum("n").alias("three"))
    j = n.groupBy("format").agg(F.sum("n").alias("comments"), F.count("*").alias("authors")).join(best, "format")
    one, three = F.col("one") / F.col("comments"), F.col("three") / F.col("comments")
    return j.select("format", "comments", "authors", F.round(one, 4).alias("top1_share"), F.round(three, 4).alias("top3_share"), concentration(one, three).alias("concentration"))


@query(
    COMMENTS
    + """
    , a AS (SELECT author, count(*) AS n FROM c WHERE author IS NOT NULL GROUP BY author)
    SELECT comment_id, c.author, n AS author_comments, CASE WHEN n >= 50 THEN 'prolific' WHEN n >= 10 THEN 'regular' WHEN n >= 2 THEN 'returning' ELSE 'casual' END AS segment FROM c JOIN a ON c.author = a.author
    """
)
def author_totals_on_comments(spark, root):
    """Every comment with its author's totals, by an aggregate and a join rather than a sort per author."""
    from tidemill.plans.base import comments

    c = comments(spark, root).where("author IS NOT NULL")
    n = c.groupBy("author").agg(F.count("*").alias("author_comments"))
    return c.join(n, "author").select("comment_id", "author", "author_comments", volume_segment(F.col("author_comments")).alias("segment"))


@query(
    """
    WITH e AS (SELECT user_id, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, event_type FROM events),
    d AS (SELECT DISTINCT * FROM e)
    SELECT a.event_type AS first, b.event_type AS second, count(*) AS user_days FROM d a JOIN d b ON a.user_id = b.user_id AND a.day = b.day AND a.event_type < b.event_type GROUP BY ALL
    """
)
def tag_cooccurrence(spark, root):
    """Pairs of event types on one user's day; types of a day are gathered first (there are few)."""
    from tidemill.functions.values import seconds
    from tidemill.sources.tables import table

    e = table(spark, root, "events")
    day = F.floor(seconds(F.col("ts")) / 86400)
    t = e.groupBy("user_id", day.alias("day")).agg(F.array_sort(F.collect_set("event_type")).alias("t"))
    pairs = F.expr("flatten(transform(t, (x, i) -> transform(slice(t, i + 2, size(t)), y -> struct(x as first, y as second))))")
    return t.select(F.explode(pairs).alias("p")).groupBy("p.first", "p.second").agg(F.count("*").alias("user_days"))


@query(
    SCORED
    + """
    , g AS (SELECT post, high, count(*) AS n FROM h GROUP BY GROUPING SETS ((post, high), (post), ()))
    SELECT post, high, n FROM g
    """
)
def post_signal_rollup(spark, root):
    """Comments by post and signal, by post, and in all (grouping sets)."""
    h = scored(spark, root).select("post", "high")
    return h.rollup("post", "high").agg(F.count("*").alias("n")).select("post", "high", "n")
