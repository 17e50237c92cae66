"""Summaries of posts and of the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.values import post_kind, short_number, shortcode
from tidemill.operators.keyed import fold_states
from tidemill.operators.ranking import top_k
from tidemill.plans.base import COMMENTS, comments, posts
from tidemill.plans.catalog import query
from tidemill.session import cut
from tidemill.sources.pages import linked_posts, page_record
from tidemill.sources.tables import table


@query(
    COMMENTS
    + """
    , s AS (SELECT post, count(*) AS comments, count(DISTINCT author) AS authors, sum(likes) AS likes, avg(likes) AS mean, median(likes) AS med FROM c GROUP BY post)
    SELECT p.post, coalesce(comments, 0) AS comments, coalesce(authors, 0) AS authors, CAST(coalesce(likes, 0) AS BIGINT) AS likes, round(coalesce(mean, 0), 2) AS mean_likes, coalesce(med, 0.0) AS median_likes,
        CASE WHEN total_comments > 0 THEN round(coalesce(comments, 0) / total_comments, 4) END AS capture_rate
    FROM p LEFT JOIN s ON p.post = s.post
    """
)
def post_comment_summary(spark, root):
    """Per post: comments, distinct authors, likes and capture rate; posts without comments are kept."""
    s = comments(spark, root).groupBy("post").agg(
        F.count("*").alias("comments"), F.count_distinct("author").alias("authors"), F.sum("likes").alias("likes"), F.avg("likes").alias("mean"), F.percentile("likes", F.lit(0.5)).alias("med")
    )
    j = posts(spark, root).join(s, "post", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return j.select(
        "post", zero("comments").alias("comments"), zero("authors").alias("authors"), zero("likes").alias("likes"), F.round(zero("mean"), 2).alias("mean_likes"), F.coalesce("med", F.lit(0.0)).alias("median_likes"),
        F.when(F.col("total_comments") > 0, F.round(zero("comments") / F.col("total_comments"), 4)).alias("capture_rate"),
    )


@query(
    COMMENTS
    + """
    SELECT count(*) AS comments, count(DISTINCT post) AS posts, count(DISTINCT author) AS authors, CAST(sum(likes) AS BIGINT) AS likes, median(likes) AS median_likes,
        count(*) FILTER (depth > 0) AS replies, count(*) FILTER (post NOT IN (SELECT post FROM p)) AS comments_of_unknown_posts FROM c
    """
)
def overall_corpus_summary(spark, root):
    """One row for the whole corpus."""
    known = posts(spark, root).select("post", F.lit(True).alias("known"))
    return (
        comments(spark, root).join(known, "post", "left")
        .agg(F.count("*").alias("comments"), F.count_distinct("post").alias("posts"), F.count_distinct("author").alias("authors"), F.sum("likes").alias("likes"), F.percentile("likes", F.lit(0.5)).alias("median_likes"),
             F.count_if(F.col("depth") > 0).alias("replies"), F.count_if(F.col("known").isNull()).alias("comments_of_unknown_posts"))
    )


@query(
    COMMENTS
    + """
    , r AS (SELECT post, comment_id, likes, row_number() OVER (PARTITION BY post ORDER BY likes DESC, comment_id) AS rank FROM c)
    SELECT * FROM r WHERE rank <= 5
    """
)
def top_comments_per_post(spark, root):
    """The five most liked comments of every post."""
    return top_k(comments(spark, root).select("post", "comment_id", "likes"), ["post"], [F.desc("likes"), F.asc("comment_id")], 5)


@query(
    COMMENTS
    + """
    , t AS (SELECT post, max(likes) AS top FROM c GROUP BY post)
    SELECT id, title, total_comments, CASE WHEN like_count >= coalesce(top, 0) THEN like_count ELSE 0 END AS like_count, captured_comments FROM p LEFT JOIN t ON p.post = t.post
    """
)
def import_projection_like_sanity(spark, root):
    """Posts for import; a like count below that of the post's best comment was misread and becomes 0."""
    top = comments(spark, root).groupBy("post").agg(F.max("likes").alias("top"))
    sane = F.when(F.col("like_count") >= F.coalesce("top", F.lit(0)), F.col("like_count")).otherwise(0)
    return posts(spark, root).join(top, "post", "left").select("id", "title", "total_comments", sane.alias("like_count"), "captured_comments")


@query(
    COMMENTS
    + """
    , n AS (SELECT post, count(*) AS n FROM c GROUP BY post),
    s AS (SELECT p.post, CASE WHEN coalesce(n, 0) = 0 THEN 'failed' WHEN total_comments IS NULL OR total_comments = 0 THEN 'partial_unknown_target' WHEN n >= 0.9 * total_comments THEN 'complete' ELSE 'partial' END AS status,
        title IS NULL AS no_title, posted_s IS NULL AS no_date FROM p LEFT JOIN n ON p.post = n.post)
    SELECT status, count(*) AS posts, count(*) FILTER (no_title) AS no_title, count(*) FILTER (no_date) AS no_date, min(post) FILTER (no_date) AS first_without_date FROM s GROUP BY status
    """
)
def collection_status_quality(spark, root):
    """Posts by collection status, with what their pages lacked."""
    n = comments(spark, root).groupBy("post").agg(F.count("*").alias("n"))
    p = posts(spark, root).join(n, "post", "left")
    status = (
        F.when(F.coalesce("n", F.lit(0)) == 0, "failed").when(F.coalesce("total_comments", F.lit(0)) == 0, "partial_unknown_target")
        .when(F.col("n") >= 0.9 * F.col("total_comments"), "complete").otherwise("partial")
    )
    no_date = F.col("posted_at").isNull()
    return p.groupBy(status.alias("status")).agg(F.count("*").alias("posts"), F.count_if(F.col("title").isNull()).alias("no_title"), F.count_if(no_date).alias("no_date"), F.min(F.when(no_date, F.col("post"))).alias("first_without_date"))


@query(
    COMMENTS
    + """
    , q AS (SELECT post, row_number() OVER (ORDER BY posted_s NULLS LAST, id) AS position, captured_comments FROM p)
    SELECT post, position, coalesce(captured_comments, 0) = 0 AS queued FROM q
    """
)
def queue_positions(spark, root):
    """The collection queue: position by time of posting, and whether a post still waits.

    Positions come from per-range counts, so no task sorts the whole queue.
    """
    p = posts(spark, root).select("post", "id", F.coalesce(F.unix_seconds("posted_at"), F.lit((1 << 62))).alias("at"), "captured_comments")
    return _numbered(p, ["at", "id"], "position").select("post", "position", (F.coalesce("captured_comments", F.lit(0)) == 0).alias("queued"))


def _numbered(df, order, into):
    """Row numbers from 1 over a total order: a range sort, a count per range, and an offset each."""
    from pyspark.sql import Window

    s = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id())
    s = cut(s)  # read twice below; evaluated twice, the ranges would differ
    s = s.withColumn("__at", F.col("__at") - F.shiftleft(F.col("__part").cast("bigint"), 33) + 1)
    sizes = s.groupBy("__part").agg(F.count("*").alias("__n"))  # one row a partition
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("__part", "__before")
    return s.join(F.broadcast(before), "__part").withColumn(into, F.col("__at") + F.col("__before")).drop("__part", "__at", "__before")


@query(
    r"""
    SELECT quote_id, nullif(regexp_extract(post_url, '(?i)/(p|reel|reels|tv)/([A-Za-z0-9_-]+)', 2), '') AS shortcode,
        CASE lower(regexp_extract(post_url, '(?i)/(p|reel|reels|tv)/([A-Za-z0-9_-]+)', 1)) WHEN 'reels' THEN 'reel' WHEN '' THEN NULL ELSE lower(regexp_extract(post_url, '(?i)/(p|reel|reels|tv)/([A-Za-z0-9_-]+)', 1)) END AS kind
    FROM quotes WHERE post_url IS NOT NULL
    """
)
def post_address_parts(spark, root):
    """Kind and shortcode of every quoted post address."""
    q = table(spark, root, "quotes").where("post_url IS NOT NULL")
    return q.select("quote_id", shortcode(F.col("post_url")).alias("shortcode"), post_kind(F.col("post_url")).alias("kind"))


@query(
    COMMENTS
    + r"""
    , s AS (SELECT post, count(*) AS comments, count(DISTINCT nullif(trim(regexp_replace(author, '[\s]+', ' ', 'g')), '')) AS authors, count(DISTINCT author) AS author_names, count(DISTINCT coalesce(author, 'unknown')) AS authors_or_unknown, CAST(sum(likes) AS BIGINT) AS likes, round(avg(likes), 2) AS mean_likes, median(likes) AS median_likes, max(likes) AS most_likes,
        count(*) FILTER (likes = 0) AS without_likes, count(*) FILTER (depth > 0) AS replies, count(*) FILTER (depth = 0) AS top_level, count(*) FILTER (text = '') AS empty_texts, CAST(sum(length(text)) AS BIGINT) AS characters, round(avg(length(text)), 2) AS mean_characters, max(length(text)) AS longest,
        count(*) FILTER (contains(text, '?')) AS questions, count(*) FILTER (regexp_matches(text, '[^\x00-\x7f]')) AS not_ascii, count(*) FILTER (regexp_matches(text, '(?:^|[^A-Za-z0-9_.@])@[A-Za-z0-9_.]+')) AS with_mention, count(*) FILTER (regexp_matches(text, '(?:^|[^A-Za-z0-9_&#])#[\p{L}\p{N}_]+')) AS with_hashtag FROM c GROUP BY post),
    k AS (SELECT post, list(likes ORDER BY r) AS top_likes, list(comment_id ORDER BY r) AS top_comments FROM (SELECT *, row_number() OVER (PARTITION BY post ORDER BY likes DESC, comment_id) AS r FROM c) WHERE r <= 5 GROUP BY post)
    SELECT p.post, p.id, p.title AS caption, substring(p.title, 1, 160) AS caption_preview, length(p.title) AS caption_characters, p.posted_s, p.total_comments, p.like_count, p.view_count, p.captured_comments AS captured_reported, coalesce(s.comments, 0) AS comments, s.* EXCLUDE (post, comments),
        CASE WHEN p.total_comments > 0 THEN round(coalesce(s.comments, 0) / p.total_comments, 4) END AS capture_rate, p.title IS NULL AS no_caption, p.posted_s IS NULL AS no_date, coalesce(s.comments, 0) = 0 AS no_comments, k.top_likes, k.top_comments
    FROM p LEFT JOIN s ON p.post = s.post LEFT JOIN k ON p.post = k.post
    """
)
def post_summary(spark, root):
    """The whole summary of each post: its page, its comments' counts, likes, lengths and signs, what is missing, and its best comments."""
    c, t, n = comments(spark, root), F.col("text"), F.col("likes")
    tidy = F.nullif(F.trim(F.regexp_replace("author", r"[\s]+", " ")), F.lit(""))
    s = c.groupBy("post").agg(
        F.count("*").alias("comments"), F.count_distinct(tidy).alias("authors"), F.count_distinct("author").alias("author_names"), F.count_distinct(F.coalesce("author", F.lit("unknown"))).alias("authors_or_unknown"), F.sum(n).alias("likes"), F.round(F.avg(n), 2).alias("mean_likes"),
        F.percentile(n, F.lit(0.5)).alias("median_likes"), F.max(n).alias("most_likes"), F.count_if(n == 0).alias("without_likes"), F.count_if(F.col("depth") > 0).alias("replies"), F.count_if(F.col("depth") == 0).alias("top_level"), F.count_if(t == "").alias("empty_texts"),
        F.sum(F.length(t)).alias("characters"), F.round(F.avg(F.length(t)), 2).alias("mean_characters"), F.max(F.length(t)).alias("longest"), F.count_if(t.contains("?")).alias("questions"), F.count_if(t.rlike(r"[^\x00-\x7f]")).alias("not_ascii"),
        F.count_if(t.rlike(r"(?:^|[^A-Za-z0-9_.@])@[A-Za-z0-9_.]+")).alias("with_mention"), F.count_if(t.rlike(r"(?:^|[^A-Za-z0-9_&#])#[\p{L}\p{N}_]+")).alias("with_hashtag"),
    )
    best = top_k(c.select("post", "comment_id", "likes"), ["post"], [F.desc("likes"), F.asc("comment_id")], 5).groupBy("post").agg(F.array_sort(F.collect_list(F.struct("rank", "likes", "comment_id"))).alias("k"))
    top = best.select("post", F.transform("k", lambda x: x["likes"]).alias("top_likes"), F.transform("k", lambda x: x["comment_id"]).alias("top_comments"))
    j = posts(spark, root).join(s, "post", "left").join(top, "post", "left").withColumn("comments", F.coalesce("comments", F.lit(0)))
    return j.select(
        "post", "id", F.col("title").alias("caption"), F.substring("title", 1, 160).alias("caption_preview"), F.length("title").alias("caption_characters"), F.unix_seconds("posted_at").alias("posted_s"), "total_comments", "like_count", "view_count", F.col("captured_comments").alias("captured_reported"),
        *[x for x in s.columns if x != "post"], F.when(F.col("total_comments") > 0, F.round(F.col("comments") / F.col("total_comments"), 4)).alias("capture_rate"), F.col("title").isNull().alias("no_caption"), F.col("posted_at").isNull().alias("no_date"), (F.col("comments") == 0).alias("no_comments"), "top_likes", "top_comments",
    )


@query(
    """
    WITH n AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS n, o_orderkey % 4 AS form FROM orders)
    SELECT o_orderkey, CASE form WHEN 0 THEN n WHEN 1 THEN n // 1000 * 1000 WHEN 2 THEN n % 1000 * 1000000 ELSE n % 100 * 1000000000 END AS value FROM n
    """
)
def short_number_forms(spark, root):
    """Numbers written with commas, K, M and B, read back."""
    n = F.floor("o_totalprice")
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.format_number(n, 0)).when(k == 1, F.concat(F.floor(n / 1000), F.lit("k"))).when(k == 2, F.concat(n % 1000, F.lit(".0M likes"))).otherwise(F.concat(n % 100, F.lit(" B")))
    return table(spark, root, "orders").select("o_orderkey", short_number(text).alias("value"))


@query(
    r"""
    WITH g AS (SELECT post_id, quote_id, post_url FROM quotes WHERE post_id IS NOT NULL AND post_url IS NOT NULL), x AS (SELECT post_id, quote_id, nullif(regexp_extract(post_url, '(?i)/(p|reel|reels|tv)/([A-Za-z0-9_-]+)', 2), '') AS shortcode FROM g)
    SELECT quote_id, shortcode FROM x WHERE shortcode IS NOT NULL
    """
)
def link_extraction(spark, root):
    """Posts linked from pages: each quote's address put into a page of other links and repeated."""
    q = table(spark, root, "quotes").where("post_id IS NOT NULL AND post_url IS NOT NULL")
    html = F.concat(F.lit('<a href="/about/">x</a><a class=y href=\''), F.trim("post_url"), F.lit("'>z</a><a href=\""), F.trim("post_url"), F.lit('">again</a>'))
    return linked_posts(q.select("quote_id", html.alias("html")), "quote_id", "html").select("quote_id", "shortcode")


@query(COMMENTS + " SELECT comment_id, author, trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g')) AS text FROM c WHERE author IS NOT NULL AND regexp_matches(author, '^[a-z0-9._]+$') AND regexp_matches(text, '^[A-Za-z ,.!?]+$') AND length(trim(text)) > 0 AND lower(trim(text)) <> author")
def html_record_extraction(spark, root):
    """Comments read back from pages made of them."""
    c = comments(spark, root).where("author IS NOT NULL").where(F.col("author").rlike("^[a-z0-9._]+$") & F.col("text").rlike("^[A-Za-z ,.!?]+$") & (F.length(F.trim("text")) > 0) & (F.lower(F.trim("text")) != F.col("author")))
    html = F.concat(F.lit('<meta property="og:title" content="t"><ul><li><a href="/'), "author", F.lit('/">'), "author", F.lit("</a><span>"), "text", F.lit("</span></li></ul>"))
    r = c.select("comment_id", page_record(html).alias("r")).select("comment_id", F.get("r.comments", F.lit(0)).alias("k"))
    return r.select("comment_id", "k.author", "k.text")


@query(COMMENTS + " SELECT post, comment_id, author, likes FROM c")
def comment_upsert(spark, root):
    """The keyed store after replaying every capture: each comment once, its latest capture."""
    return comments(spark, root).select("post", "comment_id", "author", "likes")


@query(
    """
    SELECT post_shortcode AS post, lower(comment_author) AS author, lower(trim(comment_text)) AS said, min(comment_id) AS comment_id, count(*) AS copies
    FROM raw_comments WHERE comment_text IS NOT NULL AND comment_author IS NOT NULL GROUP BY 1, 2, 3
    """
)
def content_dedupe(spark, root):
    """Comments with one author and text on one post fall together."""
    r = table(spark, root, "raw_comments").where("comment_text IS NOT NULL AND comment_author IS NOT NULL")
    key = [F.col("post_shortcode").alias("post"), F.lower("comment_author").alias("author"), F.lower(F.trim("comment_text")).alias("said")]
    return r.groupBy(*key).agg(F.min("comment_id").alias("comment_id"), F.count("*").alias("copies"))


@query(
    """
    WITH s AS (SELECT post_shortcode AS post, batch_id, count(*) AS captured, CASE WHEN count(*) >= 10 THEN 'complete' WHEN count(*) >= 3 THEN 'partial' ELSE 'in_progress' END AS status, min(worker_id) AS worker FROM raw_comments WHERE batch_id IS NOT NULL GROUP BY 1, 2),
    r AS (SELECT *, CASE status WHEN 'complete' THEN 4 WHEN 'partial' THEN 3 ELSE 1 END AS rank FROM s), o AS (SELECT *, row_number() OVER (PARTITION BY post ORDER BY rank DESC, batch_id) AS rn FROM r)
    SELECT post, min(batch_id) AS batch_id, max(status) FILTER (rn = 1) AS status, max(captured) AS captured, max(worker) FILTER (rn = 1) AS worker FROM o GROUP BY post
    """
)
def merge_import_state(spark, root):
    """All batches' states of each post merged in their order: the highest status wins, the first at a tie."""
    n = F.count("*")
    status = F.when(n >= 10, "complete").when(n >= 3, "partial").otherwise("in_progress")
    s = table(spark, root, "raw_comments").where("batch_id IS NOT NULL").groupBy(F.col("post_shortcode").alias("post"), "batch_id").agg(n.alias("captured"), status.alias("status"), F.min("worker_id").alias("worker"))
    return fold_states(s, "post", "batch_id", kept=("batch_id",), highest=("captured",)).select("post", "batch_id", "status", "captured", "worker")


@query(
    COMMENTS
    + """
    SELECT 1 AS step, 'captures' AS stage, (SELECT count(*) FROM raw_comments) AS n UNION ALL SELECT 2, 'comments', (SELECT count(*) FROM c)
    UNION ALL SELECT 3, 'quotes', (SELECT count(*) FROM quotes) UNION ALL SELECT 4, 'quotes_with_comment', (SELECT count(*) FROM quotes q WHERE q.comment_id IN (SELECT comment_id FROM c))
    UNION ALL SELECT 5, 'themes', (SELECT count(DISTINCT id) FROM themes)
    """
)
def funnel_counts(spark, root):
    """How many records are left at each step from capture to theme."""
    quotes, c = table(spark, root, "quotes"), comments(spark, root)
    steps = [
        table(spark, root, "raw_comments").agg(F.count("*").alias("n")).select(F.lit(1).alias("step"), F.lit("captures").alias("stage"), "n"),
        c.agg(F.count("*").alias("n")).select(F.lit(2).alias("step"), F.lit("comments").alias("stage"), "n"),
        quotes.agg(F.count("*").alias("n")).select(F.lit(3).alias("step"), F.lit("quotes").alias("stage"), "n"),
        quotes.join(c.select("comment_id"), "comment_id", "left_semi").agg(F.count("*").alias("n")).select(F.lit(4).alias("step"), F.lit("quotes_with_comment").alias("stage"), "n"),
        table(spark, root, "themes").agg(F.count_distinct("id").alias("n")).select(F.lit(5).alias("step"), F.lit("themes").alias("stage"), "n"),
    ]
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out
