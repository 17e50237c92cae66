"""The canonical posts and comments, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.values import likes, moment, shortcode
from tidemill.operators.keyed import latest_by_key
from tidemill.sources.tables import table


def comments(spark: SparkSession, root: str) -> DataFrame:
    """One row a comment, its latest capture: comment_id, post, author, text, likes, depth, parent."""
    raw = table(spark, root, "raw_comments")
    rows = raw.select(
        "comment_id", "scraped_at", "batch_id", F.col("post_shortcode").alias("post"), F.lower("comment_author").alias("author"),
        F.coalesce("comment_text", F.lit("")).alias("text"), likes(F.col("comment_likes")).alias("likes"), F.coalesce("comment_depth", F.lit(0)).alias("depth"), F.col("parent_comment_id").alias("parent"),
    )
    return latest_by_key(rows, ["comment_id"], ["scraped_at", "batch_id"]).drop("scraped_at", "batch_id")


def posts(spark: SparkSession, root: str) -> DataFrame:
    """One row a post: post (shortcode), id, title, posted_at and the counts read from its page."""
    p = table(spark, root, "posts")
    return p.select(shortcode(F.col("permalink_url")).alias("post"), "id", "title", moment(F.col("posted_date")).alias("posted_at"), "total_comments", "like_count", "captured_comments", "view_count")


_NUMBER = "regexp_replace(lower(trim(comment_likes)), ',', '', 'g')"
_PATTERN = r"'^([0-9]+(?:\.[0-9]+)?) ?([kmb])?(?:$|[^a-z0-9.]|[ ])'"

COMMENTS = f"""
    WITH captured AS (
        SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY scraped_at DESC NULLS LAST, batch_id DESC NULLS LAST) AS rn FROM raw_comments
    ),
    c AS (
        SELECT comment_id, post_shortcode AS post, lower(comment_author) AS author, coalesce(comment_text, '') AS text, coalesce(comment_depth, 0) AS depth, parent_comment_id AS parent,
            coalesce(CAST(round(TRY_CAST(nullif(regexp_extract({_NUMBER}, {_PATTERN}, 1), '') AS DOUBLE)
                * CASE regexp_extract({_NUMBER}, {_PATTERN}, 2) WHEN 'k' THEN 1000 WHEN 'm' THEN 1000000 WHEN 'b' THEN 1000000000 ELSE 1 END) AS BIGINT), 0) AS likes
        FROM captured WHERE rn = 1
    ),
    p AS (
        SELECT nullif(regexp_extract(permalink_url, '(?i)/(p|reel|reels|tv)/([A-Za-z0-9_-]+)', 2), '') AS post, id, title, CAST(epoch(TRY_CAST(posted_date AS TIMESTAMPTZ)) AS BIGINT) AS posted_s,
            total_comments, like_count, captured_comments, view_count
        FROM posts
    )
"""
