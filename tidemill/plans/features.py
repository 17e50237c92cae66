"""Comment features and what they tell of clusters, motifs and authors. Post formats stand for clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import text as T
from tidemill.operators.ranking import concentration, top_k
from tidemill.plans.base import COMMENTS, comments, posts
from tidemill.plans.catalog import query
from tidemill.plans.scores import FORMATTED, formats
from tidemill.plans.timeline import _LINKS, links

#: The engine's own default lexicons: tag to (terms, emoji). Functions take others.
AFFECT = {
    "delight": (["love", "adorable", "joy", "so cute"], ["😍", "🥰", "❤️"]),
    "grief": (["passed away", "miss", "goodbye", "memory"], ["🌈", "😢"]),
    "gratitude": (["thank", "thanks", "grateful", "bless"], ["🙏"]),
    "humour": (["haha", "lol", "clumsy", "funny"], ["😂", "🤣"]),
    "awe": (["gorgeous", "beautiful", "golden", "brave"], ["✨", "🙌"]),
    "worry": (["nervous", "guilty", "allergy", "pain"], ["😬"]),
    "food": (["treats?", "kibble", "sardine", "jerky", "raw"], ["🦴"]),
    "anger": (["never again", "fell apart", "angry"], ["😡"]),
    "longing": (["wish", "someday", "want one"], []),
}
STANCE = {
    "question": (["anyone", "where", "has anyone", "how do"], []),
    "request": (["please", "tell me", "need it"], []),
    "advice": (["we switched", "try", "the trainer", "should"], []),
    "action": (["adopt", "share", "donate", "sign"], ["📣"]),
    "testimony": (["we tried", "i tried", "my dog", "our"], []),
    "price": (["afford", "costs?", "money", "spending"], ["💸"]),
    "praise": (["good boy", "best face", "this dog"], ["👏"]),
    "complaint": (["never arrived", "upset", "ripped"], []),
}
#: Emoji motifs: the last holds the comments of emoji only.
MOTIFS = {"hearts": ["❤️", "💕", "😍", "🥰"], "applause": ["👏", "🙌"], "prayer": ["🙏"], "paws": ["🐾", "🐶", "🐕", "🐕‍🦺"], "fire": ["🔥"], "laughter": ["😂", "🤣"], "emoji_only": None}
#: Tensions: the affect and stance tags (any of them) of either side.
TENSIONS = {"delight_against_grief": (["delight", "awe"], ["grief"]), "wish_against_price": (["longing", "request"], ["price"]), "advice_against_worry": (["advice"], ["worry"]), "praise_against_complaint": (["praise"], ["complaint", "anger"])}
SHORT = r"^(so|too|very|what an?|such an?|my|omg|aww*|wow|cute|adorable|love|beautiful|sweet|perfect|good)\b"
CREATOR = "barknotes"


def _quoted(x):
    return f"'{x}'"


def tag_names(text, emoji, definitions):
    """The tags of which a term stands in the text or an emoji among its emoji."""
    return F.array_compact(F.array(*[F.when(T.has_any(text, terms) | (F.arrays_overlap(emoji, F.array(*map(F.lit, own))) if own else F.lit(False)), F.lit(k)) for k, (terms, own) in definitions.items()]))


def short_affective(stripped, emoji):
    """Nothing but emoji; or at most five words with emoji or an opening word of feeling."""
    few = T.word_count(stripped) <= 5
    return F.when(stripped == "", F.size(emoji) > 0).otherwise(few & ((F.size(emoji) > 0) | F.lower(stripped).rlike(SHORT)))


def features(spark, root, affect=AFFECT, stance=STANCE):
    """A row for each comment: its emoji, tags and what it may be used for."""
    t = F.col("text")
    c = comments(spark, root).withColumns({"emoji": T.emojis(t), "stripped": T.without_emoji(t)})
    c = c.withColumns({"emoji_only": (F.size("emoji") > 0) & (F.col("stripped") == ""), "short": short_affective(F.col("stripped"), F.col("emoji")), "affect": tag_names(t, F.col("emoji"), affect), "stance": tag_names(t, F.col("emoji"), stance)})
    eligible = ~F.col("emoji_only") & ~F.col("short") & (T.letter_count(F.col("stripped")) >= 8) & (F.length("stripped") >= 12)
    return c.withColumns({"eligible": eligible, "repeated": T.repeats(F.col("emoji")), "feature_id": F.substring(F.sha1("comment_id"), 1, 16)})


def _tags_sql(definitions):
    one = lambda k, terms, own: f"CASE WHEN regexp_matches(lower(text), '{T.bounded(terms)}')" + (f" OR list_has_any(emoji, [{', '.join(map(_quoted, own))}])" if own else "") + f" THEN '{k}' END"
    return "list_filter([" + ", ".join(one(k, *v) for k, v in definitions.items()) + "], lambda x: x IS NOT NULL)"


_WORDS = r"len(regexp_extract_all(stripped, '[\p{L}\p{N}_'']+'))"
_BARE = f"trim(regexp_replace(regexp_replace(text, '{T.EMOJI}|{T.EMOJI_GLUE}', ' ', 'g'), '[\\s\\x{{a0}}\\x{{feff}}]+', ' ', 'g'))"
FEATURES = (
    COMMENTS
    + f"""
    , f0 AS (SELECT *, regexp_extract_all(text, '{T.EMOJI_CLUSTER}') AS emoji, {_BARE} AS stripped FROM c),
    f1 AS (SELECT *, len(emoji) > 0 AND stripped = '' AS emoji_only, CASE WHEN stripped = '' THEN len(emoji) > 0 ELSE {_WORDS} <= 5 AND (len(emoji) > 0 OR regexp_matches(lower(stripped), '{SHORT}')) END AS short, {_tags_sql(AFFECT)} AS affect, {_tags_sql(STANCE)} AS stance FROM f0),
    f AS (SELECT *, NOT emoji_only AND NOT short AND length(regexp_replace(stripped, '[^\\p{{L}}]', '', 'g')) >= 8 AND length(stripped) >= 12 AS eligible,
        len(emoji) > 1 AND len(list_filter(range(2, len(emoji) + 1), lambda i: emoji[i] = emoji[i - 1])) > 0 AS repeated FROM f1)
    """
)
#: FORMATTED names a CTE f too; here it is the clusters'.
CLUSTERS = FORMATTED.replace("    f AS (SELECT post", "    fmt AS (SELECT post")


@query(FEATURES + " SELECT substr(sha1(comment_id), 1, 16) AS feature_id, comment_id, len(emoji) AS emoji, emoji_only, short, eligible, repeated, affect, stance FROM f")
def comment_features(spark, root):
    """Every comment's tags and flags."""
    return features(spark, root).select("feature_id", "comment_id", F.size("emoji").alias("emoji"), "emoji_only", "short", "eligible", "repeated", "affect", "stance")


def clustered(spark, root):
    return features(spark, root).join(formats(spark, root).select("post", F.col("format").alias("cluster")), "post")


_CLUSTERED = FEATURES + CLUSTERS + ", k AS (SELECT f.*, fmt.format AS cluster FROM f JOIN fmt ON f.post = fmt.post)"


@query(
    _CLUSTERED
    + """
    , e AS (SELECT cluster, 'affect' AS kind, unnest(affect) AS tag FROM k UNION ALL SELECT cluster, 'stance', unnest(stance) FROM k), n AS (SELECT cluster, kind, tag, count(*) AS n FROM e GROUP BY ALL),
    z AS (SELECT cluster, count(*) AS size FROM k GROUP BY cluster), r AS (SELECT n.*, round(n / size, 4) AS share, row_number() OVER (PARTITION BY n.cluster, kind ORDER BY n DESC, tag) AS rank FROM n JOIN z ON n.cluster = z.cluster)
    SELECT * FROM r WHERE rank <= 10
    """
)
def affect_stance_profile(spark, root):
    """The ten most frequent affect and stance tags of each cluster, with their share of its comments."""
    k = clustered(spark, root)
    pair = lambda c, kind: F.transform(c, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("tag")))
    n = k.select("cluster", F.explode(F.concat(pair("affect", "affect"), pair("stance", "stance"))).alias("x")).groupBy("cluster", "x.kind", "x.tag").agg(F.count("*").alias("n"))
    size = k.groupBy("cluster").agg(F.count("*").alias("size"))
    s = n.join(size, "cluster").select("cluster", "kind", "tag", "n", F.round(F.col("n") / F.col("size"), 4).alias("share"))
    return top_k(s, ["cluster", "kind"], [F.desc("n"), F.asc("tag")], 10)


_MOTIF_SQL = "list_filter([" + ", ".join(f"CASE WHEN {'emoji_only' if v is None else 'list_has_any(emoji, [' + ', '.join(map(_quoted, v)) + '])'} THEN '{k}' END" for k, v in MOTIFS.items()) + "], lambda x: x IS NOT NULL)"


def motifs_of(emoji, only, motifs=MOTIFS):
    return F.array_compact(F.array(*[F.when(only if v is None else F.arrays_overlap(emoji, F.array(*map(F.lit, v))), F.lit(k)) for k, v in motifs.items()]))


@query(
    FEATURES
    + f"""
    , m AS (SELECT post, comment_id, emoji, emoji_only, unnest({_MOTIF_SQL}) AS motif FROM f), en AS (SELECT motif, emoji, count(*) AS n FROM (SELECT motif, unnest(emoji) AS emoji FROM m) GROUP BY ALL),
    er AS (SELECT *, row_number() OVER (PARTITION BY motif ORDER BY n DESC, emoji) AS r FROM en), t AS (SELECT motif, list(emoji ORDER BY r) AS top_emoji FROM er WHERE r <= 14 GROUP BY motif)
    SELECT m.motif, count(*) AS comments, count(DISTINCT post) AS posts, count(*) FILTER (emoji_only) AS emoji_only, count(*) FILTER (NOT emoji_only) AS with_text, any_value(top_emoji) AS top_emoji FROM m JOIN t ON m.motif = t.motif GROUP BY m.motif
    """
)
def motif_rollup(spark, root):
    """Each emoji motif's comments, posts and most frequent emoji."""
    m = features(spark, root).select("post", "emoji", "emoji_only", F.explode(motifs_of(F.col("emoji"), F.col("emoji_only"))).alias("motif"))
    n = m.select("motif", F.explode("emoji").alias("e")).groupBy("motif", "e").agg(F.count("*").alias("n"))
    best = top_k(n, ["motif"], [F.desc("n"), F.asc("e")], 14).groupBy("motif").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "e"))), lambda x: x["e"]).alias("top_emoji"))
    sums = m.groupBy("motif").agg(F.count("*").alias("comments"), F.count_distinct("post").alias("posts"), F.count_if("emoji_only").alias("emoji_only"), F.count_if(~F.col("emoji_only")).alias("with_text"))
    return sums.join(best, "motif")


@query(FEATURES + ", s AS (SELECT array_to_string(emoji, '') AS sequence, count(*) AS n FROM f WHERE len(emoji) > 0 GROUP BY ALL) SELECT sequence, n FROM s ORDER BY n DESC, sequence LIMIT 20")
def top_emoji_sequences(spark, root):
    """The twenty most frequent emoji sequences of comments."""
    s = features(spark, root).where(F.size("emoji") > 0).groupBy(F.array_join("emoji", "").alias("sequence")).agg(F.count("*").alias("n"))
    return s.orderBy(F.desc("n"), F.asc("sequence")).limit(20)


@query(_LINKS + f", fe AS (SELECT comment_id, post, regexp_extract_all(text, '{T.EMOJI_CLUSTER}') AS emoji, {_BARE} = '' AS bare FROM c), mo AS (SELECT post, unnest({_MOTIF_SQL.replace('emoji_only THEN', '(len(emoji) > 0 AND bare) THEN')}) AS motif FROM fe) SELECT motif, event_id, count(*) AS comments FROM mo JOIN l ON mo.post = l.post GROUP BY ALL")
def motif_events(spark, root):
    """How often a motif's comments stand on posts linked with each event, a comment counting for every link."""
    m = features(spark, root).select("post", F.explode(motifs_of(F.col("emoji"), F.col("emoji_only"))).alias("motif"))
    per_post = m.groupBy("post", "motif").agg(F.count("*").alias("n"))
    return per_post.join(links(spark, root).select("post", "event_id"), "post").groupBy("motif", "event_id").agg(F.sum("n").alias("comments"))


@query(
    _CLUSTERED
    + "".join(
        f"{'UNION ALL' if i else ''} SELECT '{t}' AS tension, cluster, count(*) FILTER (a) AS first_side, count(*) FILTER (b) AS second_side, count(*) FILTER (a AND b) AS both_sides FROM (SELECT cluster, list_has_any(list_concat(affect, stance), {x!r}) AS a, list_has_any(list_concat(affect, stance), {y!r}) AS b FROM k) GROUP BY cluster HAVING count(*) FILTER (a) >= 8 AND count(*) FILTER (b) >= 8"
        for i, (t, (x, y)) in enumerate(TENSIONS.items())
    )
)
def cluster_tensions(spark, root):
    """Tensions of which either side is voiced by eight or more of a cluster's comments."""
    tags = F.concat("affect", "stance")
    has = lambda xs: F.arrays_overlap(tags, F.array(*map(F.lit, xs)))
    sides = F.array(*[F.struct(F.lit(t).alias("tension"), has(x).alias("a"), has(y).alias("b")) for t, (x, y) in TENSIONS.items()])
    n = clustered(spark, root).select("cluster", F.explode(sides).alias("s")).groupBy("s.tension", "cluster")
    return n.agg(F.count_if("s.a").alias("first_side"), F.count_if("s.b").alias("second_side"), F.count_if(F.col("s.a") & F.col("s.b")).alias("both_sides")).where("first_side >= 8 AND second_side >= 8")


_RULES = f"""CASE WHEN author = '{CREATOR}' THEN 'creator' WHEN n = 1 THEN 'single' WHEN n >= 50 THEN 'prolific' WHEN food >= 2 OR advice >= 3 THEN 'food_and_advice' WHEN request >= 2 OR action >= 2 THEN 'action'
    WHEN grief >= 2 OR gratitude >= 3 THEN 'grief_and_prayer' WHEN emoji_share >= 0.65 OR short_share >= 0.65 THEN 'reactor' ELSE 'general' END"""
_ACTS = """
    , a AS (SELECT coalesce(author, 'unknown') AS author, count(*) AS n, count(DISTINCT post) AS posts, CAST(sum(likes) AS BIGINT) AS likes, round(count(*) FILTER (len(emoji) > 0) / count(*), 4) AS emoji_share, round(count(*) FILTER (short) / count(*), 4) AS short_share,
        count(*) FILTER (list_contains(affect, 'food')) AS food, count(*) FILTER (list_contains(affect, 'grief')) AS grief, count(*) FILTER (list_contains(affect, 'gratitude')) AS gratitude,
        count(*) FILTER (list_contains(stance, 'advice')) AS advice, count(*) FILTER (list_contains(stance, 'request')) AS request, count(*) FILTER (list_contains(stance, 'action')) AS action FROM f GROUP BY 1)
"""


def behaviours(f, creator=CREATOR):
    """Each author's activity and the first behaviour rule that fits."""
    has = lambda c, x: F.count_if(F.array_contains(c, x))
    n = F.count("*")
    a = f.groupBy(F.coalesce("author", F.lit("unknown")).alias("author")).agg(
        n.alias("n"), F.count_distinct("post").alias("posts"), F.sum("likes").alias("likes"), F.round(F.count_if(F.size("emoji") > 0) / n, 4).alias("emoji_share"), F.round(F.count_if("short") / n, 4).alias("short_share"),
        has("affect", "food").alias("food"), has("affect", "grief").alias("grief"), has("affect", "gratitude").alias("gratitude"), has("stance", "advice").alias("advice"), has("stance", "request").alias("request"), has("stance", "action").alias("action"),
    )
    c = F.col
    rule = (
        F.when(c("author") == creator, "creator").when(c("n") == 1, "single").when(c("n") >= 50, "prolific").when((c("food") >= 2) | (c("advice") >= 3), "food_and_advice").when((c("request") >= 2) | (c("action") >= 2), "action")
        .when((c("grief") >= 2) | (c("gratitude") >= 3), "grief_and_prayer").when((c("emoji_share") >= 0.65) | (c("short_share") >= 0.65), "reactor").otherwise("general")
    )
    return a.withColumn("segment", rule)


@query(FEATURES + _ACTS + f" SELECT author, n, posts, likes, emoji_share, short_share, {_RULES} AS segment FROM a")
def author_behaviour(spark, root):
    """Every author's activity and behaviour segment by ordered rules."""
    return behaviours(features(spark, root)).select("author", "n", "posts", "likes", "emoji_share", "short_share", "segment")


@query(
    FEATURES
    + _ACTS
    + f""", b AS (SELECT *, {_RULES} AS segment FROM a), r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY n DESC, posts DESC, likes DESC, author) AS r FROM b), t AS (SELECT segment, list(author ORDER BY r) AS authors FROM r WHERE r <= 8 GROUP BY segment)
    SELECT b.segment, count(*) AS authors_in_all, CAST(sum(n) AS BIGINT) AS comments, round(sum(n) / count(*), 2) AS comments_each, round(sum(posts) / count(*), 2) AS posts_each, any_value(t.authors) AS authors FROM b JOIN t ON b.segment = t.segment GROUP BY b.segment"""
)
def community_segments(spark, root):
    """What each behaviour segment wrote, and its eight most active authors."""
    b = behaviours(features(spark, root))
    best = top_k(b, ["segment"], [F.desc("n"), F.desc("posts"), F.desc("likes"), F.asc("author")], 8).groupBy("segment").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "author"))), lambda x: x["author"]).alias("authors"))
    each = lambda c: F.round(F.sum(c) / F.count("*"), 2)
    return b.groupBy("segment").agg(F.count("*").alias("authors_in_all"), F.sum("n").alias("comments"), each("n").alias("comments_each"), each("posts").alias("posts_each")).join(best, "segment")


@query(
    FEATURES
    + _ACTS
    + f""", b AS (SELECT author, {_RULES} AS segment FROM a), e AS (SELECT segment, unnest(affect) AS tag FROM f JOIN b ON coalesce(f.author, 'unknown') = b.author), n AS (SELECT segment, tag, count(*) AS n FROM e GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY n DESC, tag) AS rank FROM n) SELECT * FROM r WHERE rank <= 8"""
)
def segment_affect_tags(spark, root):
    """The most frequent affect tags of each segment: counters of authors added up by segment."""
    f = features(spark, root)
    author = F.coalesce("author", F.lit("unknown")).alias("author")
    per = f.select(author, F.explode("affect").alias("tag")).groupBy("author", "tag").agg(F.count("*").alias("n"))
    n = per.join(behaviours(f).select("author", "segment"), "author").groupBy("segment", "tag").agg(F.sum("n").alias("n"))
    return top_k(n, ["segment"], [F.desc("n"), F.asc("tag")], 8)


_PROFILE = f"""
    , an AS (SELECT coalesce(author, 'unknown') AS author, count(*) AS total FROM f GROUP BY 1), ca AS (SELECT cluster, coalesce(author, 'unknown') AS author, count(*) AS n FROM k GROUP BY 1, 2), cp AS (SELECT cluster, post, count(*) AS n FROM k GROUP BY 1, 2),
    ar AS (SELECT ca.*, total, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, ca.author) AS r FROM ca JOIN an ON ca.author = an.author),
    pr AS (SELECT cluster, CAST(sum(n) AS BIGINT) AS size, count(*) AS authors, sum(n) FILTER (r = 1) / sum(n) AS top1, sum(n) FILTER (r <= 3) / sum(n) AS top3, coalesce(sum(n) FILTER (total >= 50), 0) / sum(n) AS prolific, coalesce(sum(n) FILTER (author = '{CREATOR}'), 0) / sum(n) AS creator FROM ar GROUP BY cluster),
    po AS (SELECT cluster, count(*) AS posts, max(n) / sum(n) AS top_post FROM cp GROUP BY cluster), cl AS (SELECT pr.*, posts, top_post FROM pr JOIN po ON pr.cluster = po.cluster)
"""
_FLAGS = "list_filter([CASE WHEN top1 >= 0.15 THEN 'high_single_author' END, CASE WHEN top3 >= 0.3 THEN 'high_top_3_authors' END, CASE WHEN prolific >= 0.3 THEN 'repeat_commenters' END, CASE WHEN top_post >= 0.55 THEN 'single_post' END, CASE WHEN posts < 3 THEN 'thin_posts' END, CASE WHEN authors < 25 THEN 'thin_authors' END], lambda x: x IS NOT NULL)"


def profiles(spark, root, creator=CREATOR):
    """(cluster, size, authors, top1, top3, prolific, creator, posts, top_post): how far few authors or one post make a cluster."""
    f = features(spark, root).withColumn("author", F.coalesce("author", F.lit("unknown")))
    k = f.select("post", "author").join(formats(spark, root).select("post", F.col("format").alias("cluster")), "post")
    total = f.groupBy("author").agg(F.count("*").alias("total"))
    ca = k.groupBy("cluster", "author").agg(F.count("*").alias("n")).join(total, "author")
    best = top_k(ca, ["cluster"], [F.desc("n"), F.asc("author")], 3).groupBy("cluster").agg(F.sum(F.when(F.col("rank") == 1, F.col("n"))).alias("one"), F.sum("n").alias("three"))
    part = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) / F.sum("n")
    sums = ca.groupBy("cluster").agg(F.sum("n").alias("size"), F.count("*").alias("authors"), part(F.col("total") >= 50).alias("prolific"), part(F.col("author") == creator).alias("creator"))
    by_post = k.groupBy("cluster", "post").agg(F.count("*").alias("n")).groupBy("cluster").agg(F.count("*").alias("posts"), (F.max("n") / F.sum("n")).alias("top_post"))
    j = sums.join(best, "cluster").join(by_post, "cluster")
    return j.select("cluster", "size", "authors", (F.col("one") / F.col("size")).alias("top1"), (F.col("three") / F.col("size")).alias("top3"), "prolific", "creator", "posts", "top_post")


def risk_flags(coherence=None, noise=None):
    """What speaks against a cluster; coherence (median similarity) and noise (share without cluster) where they are known."""
    c = F.col
    rules = [(c("top1") >= 0.15, "high_single_author"), (c("top3") >= 0.3, "high_top_3_authors"), (c("prolific") >= 0.3, "repeat_commenters"), (c("top_post") >= 0.55, "single_post"), (c("posts") < 3, "thin_posts"), (c("authors") < 25, "thin_authors")]
    rules += [(coherence < 0.35, "low_coherence")] if coherence is not None else []
    rules += [(noise >= 0.35, "high_noise")] if noise is not None else []
    return F.array_compact(F.array(*[F.when(x, F.lit(k)) for x, k in rules]))


@query(
    _CLUSTERED
    + _PROFILE
    + f""", v AS (SELECT *, {_FLAGS} AS flags FROM cl) SELECT cluster, size, authors, posts, round(top1, 4) AS top1_share, round(top3, 4) AS top3_share, round(prolific, 4) AS prolific_share, round(creator, 4) AS creator_share, round(top_post, 4) AS top_post_share, flags,
    CASE WHEN top1 >= 0.15 OR top3 >= 0.30 THEN 'high' WHEN top1 >= 0.08 OR top3 >= 0.18 THEN 'moderate' ELSE 'broad' END AS concentration,
    CASE WHEN len(flags) > 0 THEN 'needs_review' WHEN size >= 250 AND posts >= 8 AND authors >= 100 THEN 'broad_candidate' ELSE 'candidate' END AS status FROM v"""
)
def cluster_validation(spark, root):
    """Each cluster's authors and posts, the risks they carry, and whether it may stand as a signal."""
    r = lambda c: F.round(c, 4).alias(f"{c}_share")
    p = profiles(spark, root).withColumn("flags", risk_flags())
    c = F.col
    status = F.when(F.size("flags") > 0, "needs_review").when((c("size") >= 250) & (c("posts") >= 8) & (c("authors") >= 100), "broad_candidate").otherwise("candidate")
    return p.select("cluster", "size", "authors", "posts", r("top1"), r("top3"), r("prolific"), r("creator"), r("top_post"), "flags", concentration(c("top1"), c("top3")).alias("concentration"), status.alias("status"))


def confidence_score(size, coherence, posts_n, noise, languages, top1, top3, prolific, top_post):
    """0 to 100: size, coherence, spread over posts and languages, less noise and concentration."""
    lit = F.lit
    penalty = F.when(top1 >= 0.15, 12).when(top1 >= 0.08, 6).otherwise(0) + F.when(top3 >= 0.3, 8).otherwise(0) + F.when(prolific >= 0.3, 8).otherwise(0) + F.when(top_post >= 0.65, 10).when(top_post >= 0.45, 5).otherwise(0)
    gain = F.least(lit(28.0), F.log10(F.greatest(size, lit(1))) * 14) + F.greatest(lit(0.0), F.least(lit(34.0), (coherence - 0.15) * 80)) + F.least(lit(24.0), posts_n / 2) + F.least(lit(8), languages * 2)
    return F.greatest(lit(0.0), F.least(lit(100.0), gain - F.least(lit(16.0), noise * 22) - penalty))


@query(
    _CLUSTERED
    + _PROFILE
    + """, el AS (SELECT cluster, count(*) FILTER (eligible) / count(*) AS coherence FROM k GROUP BY cluster), sc AS (SELECT count(*) FILTER (NOT regexp_matches(text, '[A-Za-z]')) / count(*) AS noise FROM f),
    lg AS (SELECT cluster, CAST(max(CASE WHEN regexp_matches(text, '\\p{Latin}') THEN 1 ELSE 0 END) + max(CASE WHEN regexp_matches(text, '\\p{Cyrillic}') THEN 1 ELSE 0 END) + max(CASE WHEN regexp_matches(text, '\\p{Han}') THEN 1 ELSE 0 END) AS BIGINT) AS langs FROM k GROUP BY cluster),
    g AS (SELECT cl.*, least(28, log10(greatest(size, 1)) * 14) + greatest(0, least(34, (coherence - 0.15) * 80)) + least(24, posts / 2.0) + least(8, langs * 2) - least(16, noise * 22)
        - CASE WHEN top1 >= 0.15 THEN 12 WHEN top1 >= 0.08 THEN 6 ELSE 0 END - CASE WHEN top3 >= 0.3 THEN 8 ELSE 0 END - CASE WHEN prolific >= 0.3 THEN 8 ELSE 0 END - CASE WHEN top_post >= 0.65 THEN 10 WHEN top_post >= 0.45 THEN 5 ELSE 0 END AS s
        FROM cl JOIN el ON cl.cluster = el.cluster JOIN lg ON cl.cluster = lg.cluster, sc)
    SELECT cluster, round(greatest(0, least(100, s)), 4) AS score, CASE WHEN s >= 72 THEN 'strong' WHEN s >= 50 THEN 'moderate' ELSE 'weak' END AS level FROM g"""
)
def cluster_confidence_score(spark, root):
    """The full confidence of each cluster; the share of comments fit for a model stands for coherence, scripts for languages."""
    k = clustered(spark, root)
    t = F.col("text")
    script = lambda s: F.max(t.rlike(rf"\p{{Is{s}}}").cast("int"))
    own = k.groupBy("cluster").agg((F.count_if("eligible") / F.count("*")).alias("coherence"), (script("Latin") + script("Cyrillic") + script("Han")).alias("langs"))
    noise = features(spark, root).agg((F.count_if(~t.rlike("[A-Za-z]")) / F.count("*")).alias("noise"))
    j = profiles(spark, root).join(own, "cluster").join(F.broadcast(noise))  # one row
    c = F.col
    s = confidence_score(c("size"), c("coherence"), c("posts"), c("noise"), c("langs"), c("top1"), c("top3"), c("prolific"), c("top_post"))
    return j.select("cluster", F.round(s, 4).alias("score"), F.when(s >= 72, "strong").when(s >= 50, "moderate").otherwise("weak").alias("level"))


_REP = "round(least(likes, 50) / 50.0 * 0.2 + least(len(emoji), 3) / 3.0 * 0.15 + least(" + _WORDS + ", 40) / 40.0 * 0.1, 6)"


def packet_scores():
    """Scores of the kinds of evidence of a packet; a similarity column `similarity` counts where a model gave one."""
    n = F.col("likes")
    words = T.word_count(F.col("stripped"))
    weight = F.round(F.coalesce("similarity", F.lit(0.0)) * 0.55 + F.least(n, F.lit(50)) / 50.0 * 0.2 + F.least(F.size("emoji"), F.lit(3)) / 3.0 * 0.15 + F.least(words, F.lit(40)) / 40.0 * 0.1, 6)
    return {"representative": (weight, 8, F.lit(True)), "high_engagement": (n.cast("double"), 5, F.lit(True)), "short_affective": (F.round(F.size("emoji") * 0.5 + F.least(n, F.lit(25)) / 25.0 * 0.5, 6), 5, F.col("short") & ((F.size("emoji") > 0) | (n > 0)))}


@query()
def cluster_packets(spark, root):
    """The evidence of each cluster: representative, most liked and short affective comments from different posts and authors, and the least central."""
    from tidemill.operators.diverse import select_diverse
    from tidemill.session import cut

    k = cut(clustered(spark, root).withColumn("similarity", F.lit(None).cast("double")).select("cluster", "comment_id", "post", F.coalesce("author", F.lit("unknown")).alias("author"), "likes", "emoji", "stripped", "short", "similarity"))
    out = []
    for kind, (score, limit, use) in packet_scores().items():
        own = k.where(use).select("cluster", "comment_id", "post", "author", score.alias("score"))
        out.append(select_diverse(own, "cluster", "comment_id", "post", "author", "score", limit).withColumn("kind", F.lit(kind)))
    # least central first: of a cluster's n members the max(10, min(40, n / 5)) of least weight
    sizes = k.groupBy("cluster").agg(F.greatest(F.lit(10), F.least(F.lit(40), F.floor(F.count("*") / 5))).alias("most"))
    low = top_k(k.withColumn("score", packet_scores()["representative"][0]), ["cluster"], [F.asc("score"), F.asc("comment_id")], 40).join(sizes, "cluster").where("rank <= most")
    out.append(select_diverse(low.select("cluster", "comment_id", "post", "author", (-F.col("score")).alias("score")), "cluster", "comment_id", "post", "author", "score", 4).withColumn("kind", F.lit("counterevidence")))
    done = out[0]
    for x in out[1:]:
        done = done.unionByName(x)
    return done.select("cluster", "kind", "place", "comment_id", "score")


@query(
    FEATURES
    + r"""
    , e AS (SELECT post, title, left(title, 160) AS preview, length(title) AS letters FROM p)
    SELECT f.comment_id, substr(concat_ws(' ', f.text, left(e.title, 280)), 1, 1000) AS embedding_text FROM f LEFT JOIN e ON f.post = e.post WHERE eligible
    """
)
def embedding_texts(spark, root):
    """What an embedding model is given of each eligible comment: its text and the beginning of its post's caption."""
    p = posts(spark, root).select("post", F.substring("title", 1, 280).alias("caption"))
    f = features(spark, root).where("eligible").join(p, "post", "left")
    return f.select("comment_id", F.substring(F.concat_ws(" ", "text", "caption"), 1, 1000).alias("embedding_text"))
