"""Lexicon topics, comment scores, post formats and their rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import text as T
from tidemill.operators.ranking import top_k
from tidemill.plans.base import COMMENTS, comments, posts
from tidemill.plans.catalog import query
from tidemill.plans.texts import _GENERIC, _PLAIN, _WORDS, generic_short

#: The engine's own default lexicons: topic to terms. A deployment gives its own.
TOPICS = {
    "food": ["food", "kibble", "treats?", "diet", "feed", "biscuits?", "stew", "recipe", "eat"],
    "health": ["vet", "allergy", "pain", "heal", "sick", "medicine", "paw", "teeth", "upset"],
    "behaviour": ["nervous", "shy", "barked", "training", "trainer", "shakes", "taught", "picky"],
    "purchase": ["bought", "buy", "cost", "afford", "money", "spending", "sell", "price"],
    "care": ["groomer", "brush", "coat", "walk", "shelter", "rescue", "adopted"],
    "emotion": ["cry", "guilty", "joy", "miss", "love", "passed away", "soul"],
    "gear": ["harness", "leash", "ramp", "bandana", "blanket", "collar", "ball"],
    "travel": ["trip", "beach", "moved", "park", "winter", "afternoon"],
    "senior": ["years old", "old soul", "seniorpup", "weeks", "brave"],
}
INTENT = ["want", "need", "wish", "looking for", "where", "recommend", "try", "tried", "help"]
FIRST_PERSON = ["i", "my", "me", "we", "our", "mine"]
#: Ordered post formats: the first of equal scores wins.
FORMATS = {
    "question": ["anyone", "asked", "question", "answered", "replies"],
    "story": ["memory", "afternoon", "uncle", "watches", "wrote"],
    "portrait": ["light", "golden", "picture", "photos", "photo"],
    "community": ["everybody", "people", "thread", "comments", "tagged"],
    "advice": ["trainer", "recommend", "switch", "try"],
    "rescue": ["rescue", "adopted", "shelter", "home"],
    "celebration": ["birthday", "won", "party", "years old"],
}

_TOPIC_SQL = ", ".join(f"CASE WHEN regexp_matches(lower(text), '{T.bounded(v)}') THEN '{k}' END" for k, v in TOPICS.items())
_PLAIN_WORDS = _WORDS.replace("(text,", f"({_PLAIN},")
_HITS_OF = "CASE topic " + " ".join(f"WHEN '{k}' THEN " + " + ".join(f"CASE WHEN regexp_matches(lower(text), '{T.bounded([x])}') THEN 1 ELSE 0 END" for x in v) for k, v in TOPICS.items()) + " END"
_SCORE = f"""round(least(10, 1.4 * log2(likes + 1)) + CASE WHEN {_PLAIN_WORDS} >= 12 THEN 2 ELSE 0 END + CASE WHEN {_PLAIN_WORDS} >= 28 THEN 2 ELSE 0 END + CASE WHEN contains(text, '?') THEN 2 ELSE 0 END
    + CASE WHEN regexp_matches(lower(text), '{T.bounded(FIRST_PERSON)}') THEN 1 ELSE 0 END + CASE WHEN regexp_matches(lower(text), '{T.bounded(INTENT)}') THEN 2 ELSE 0 END
    + CASE WHEN len(topics) > 0 THEN 2 + len(topics) ELSE 0 END - CASE WHEN generic THEN 4 ELSE 0 END, 2)"""
SCORED = (
    COMMENTS
    + f"""
    , t AS (SELECT *, list_filter([{_TOPIC_SQL}], lambda x: x IS NOT NULL) AS topics, {_GENERIC} AS generic FROM c),
    s AS (SELECT *, {_SCORE} AS score FROM t), h AS (SELECT *, score >= 4 OR likes >= 8 AS high FROM s)
    """
)


def topics(text, lexicon=TOPICS):
    """The topics whose lexicon has a term in the text."""
    return F.array_compact(F.array(*[F.when(T.has_any(text, terms), F.lit(k)) for k, terms in lexicon.items()]))


def topic_hits(text, topic, lexicon=TOPICS):
    """How many different terms of a topic the text holds."""
    hits = lambda terms: sum((T.has_any(text, [x]).cast("int") for x in terms[1:]), T.has_any(text, terms[:1]).cast("int"))
    out = F.lit(0)
    for k, terms in lexicon.items():
        out = F.when(topic == k, hits(terms)).otherwise(out)
    return out


def scored(spark, root, lexicon=TOPICS):
    """Comments with topics, generic flag, signal score and high-signal flag."""
    t, n = F.col("text"), F.col("likes")
    c = comments(spark, root).withColumns({"topics": topics(t, lexicon), "generic": generic_short(t, n)})
    add = lambda cond, x: F.when(cond, x).otherwise(0)
    words = T.word_count(T.plain(t))
    score = (
        F.least(F.lit(10.0), 1.4 * F.log2(n + 1)) + add(words >= 12, 2) + add(words >= 28, 2) + add(t.contains("?"), 2) + add(T.has_any(t, FIRST_PERSON), 1)
        + add(T.has_any(t, INTENT), 2) + add(F.size("topics") > 0, 2 + F.size("topics")) - add(F.col("generic"), 4)
    )
    c = c.withColumn("score", F.round(score, 2))
    return c.withColumn("high", (F.col("score") >= 4) | (n >= 8))


@query(SCORED + " SELECT comment_id, score, high FROM h")
def comment_signal_score(spark, root):
    """How much a comment tells: likes, length, questions, intent and topics, less generic praise."""
    return scored(spark, root).select("comment_id", "score", "high")


@query(SCORED + " SELECT post, count(*) AS comments, count(*) FILTER (high) AS high_signal, round(count(*) FILTER (high) / count(*), 4) AS rate FROM h GROUP BY post")
def high_signal_rate_by_post(spark, root):
    """High-signal comments of every post."""
    n, k = F.count("*"), F.count_if("high")
    return scored(spark, root).groupBy("post").agg(n.alias("comments"), k.alias("high_signal"), F.round(k / n, 4).alias("rate"))


@query(
    SCORED
    + f"""
    , e AS (SELECT post, likes, high, unnest(topics) AS topic FROM h), d AS (SELECT unnest([{", ".join(f"'{k}'" for k in TOPICS)}]) AS topic)
    SELECT d.topic, count(e.topic) AS comments, count(DISTINCT e.post) AS posts, count(*) FILTER (e.high) AS high_signal, CAST(coalesce(sum(e.likes), 0) AS BIGINT) AS likes, coalesce(median(e.likes), 0.0) AS median_likes
    FROM d LEFT JOIN e ON d.topic = e.topic GROUP BY d.topic
    """
)
def lexicon_topic_rollup(spark, root):
    """Comments, posts and likes by topic; topics without comments are kept."""
    e = scored(spark, root).select("post", "likes", "high", F.explode("topics").alias("topic"))
    a = e.groupBy("topic").agg(F.count("*").alias("comments"), F.count_distinct("post").alias("posts"), F.count_if("high").alias("high_signal"), F.sum("likes").alias("likes"), F.percentile("likes", F.lit(0.5)).alias("median_likes"))
    d = spark.createDataFrame([(k,) for k in TOPICS], "topic string")
    return d.join(a, "topic", "left").na.fill(0, ["comments", "posts", "high_signal", "likes"]).na.fill(0.0, ["median_likes"])


@query(SCORED + " SELECT a.topic AS first, b.topic AS second, count(*) AS comments FROM (SELECT comment_id, unnest(topics) AS topic FROM h) a JOIN (SELECT comment_id, unnest(topics) AS topic FROM h) b ON a.comment_id = b.comment_id AND a.topic < b.topic GROUP BY ALL")
def topic_cooccurrence(spark, root):
    """Unordered pairs of topics in one comment, paired within the row."""
    t = scored(spark, root).select(F.array_sort("topics").alias("t")).where("size(t) > 1")
    pairs = F.expr("flatten(transform(t, (x, i) -> transform(slice(t, i + 2, size(t)), y -> struct(x as first, y as second))))")
    return t.select(F.explode(pairs).alias("p")).groupBy("p.first", "p.second").agg(F.count("*").alias("comments"))


_HITS = ", ".join(f"8 * sum(CASE WHEN regexp_matches(lower(coalesce(title, '')), '{T.bounded(v)}') THEN 1 ELSE 0 END) AS t_{k}" for k, v in FORMATS.items())
_COMMENT_HITS = ", ".join(f"sum(CASE WHEN regexp_matches(lower(text), '{T.bounded(v)}') THEN 1 ELSE 0 END) AS c_{k}" for k, v in FORMATS.items())
_BEST = " ".join(f"WHEN s_{k} = m THEN '{k}'" for k in FORMATS)
FORMATTED = f"""
    , ch AS (SELECT post, {_COMMENT_HITS} FROM c GROUP BY post), ph AS (SELECT post, {_HITS} FROM p GROUP BY post),
    fs AS (SELECT ph.post, {", ".join(f"t_{k} + coalesce(c_{k}, 0) AS s_{k}" for k in FORMATS)} FROM ph LEFT JOIN ch ON ph.post = ch.post),
    fm AS (SELECT *, greatest({", ".join(f"s_{k}" for k in FORMATS)}) AS m FROM fs),
    f AS (SELECT post, CASE WHEN m = 0 THEN 'general' {_BEST} END AS format, CAST(m AS BIGINT) AS hits, CASE WHEN m >= 8 THEN 'medium' ELSE 'weak' END AS confidence FROM fm)
"""


def formats(spark, root, rules=FORMATS, said=None):
    """The format of every post: eight for a term in its caption, one for each comment with one."""
    c = (comments(spark, root) if said is None else said).groupBy("post").agg(*[F.count_if(T.has_any(F.col("text"), v)).alias(f"c_{k}") for k, v in rules.items()])
    j = posts(spark, root).join(c, "post", "left")
    hit = {k: F.when(T.has_any(F.col("title"), v), 8).otherwise(0) + F.coalesce(f"c_{k}", F.lit(0)) for k, v in rules.items()}
    j = j.select("post", *[x.cast("bigint").alias(f"s_{k}") for k, x in hit.items()])
    m = F.greatest(*[F.col(f"s_{k}") for k in rules])
    best = F.when(m == 0, "general")
    for k in rules:
        best = best.when(F.col(f"s_{k}") == m, k)
    return j.select("post", best.alias("format"), m.alias("hits"), F.when(m >= 8, "medium").otherwise("weak").alias("confidence"))


@query(COMMENTS + FORMATTED + " SELECT * FROM f")
def post_format_classification(spark, root):
    """What kind of post each is, by its caption and comments."""
    return formats(spark, root)


@query(
    SCORED
    + FORMATTED
    + """
    , e AS (SELECT post, likes, high, unnest(topics) AS topic FROM h)
    SELECT format, topic, count(*) AS comments, count(*) FILTER (high) AS high_signal, CAST(sum(likes) AS BIGINT) AS likes, count(DISTINCT e.post) AS posts FROM e JOIN f ON e.post = f.post GROUP BY ALL
    """
)
def format_topic_crosstab(spark, root):
    """Comments by post format and topic; comments of unknown posts are left out."""
    e = scored(spark, root).select("post", "likes", "high", F.explode("topics").alias("topic"))
    j = e.join(formats(spark, root).select("post", "format"), "post")
    return j.groupBy("format", "topic").agg(F.count("*").alias("comments"), F.count_if("high").alias("high_signal"), F.sum("likes").alias("likes"), F.count_distinct("post").alias("posts"))


@query(
    SCORED
    + FORMATTED
    + """
    SELECT format, count(DISTINCT f.post) AS posts, count(h.comment_id) AS comments, count(*) FILTER (high) AS high_signal, CAST(coalesce(sum(likes), 0) AS BIGINT) AS likes FROM f LEFT JOIN h ON f.post = h.post GROUP BY format
    """
)
def format_rollup(spark, root):
    """Posts, comments and likes by post format."""
    h = scored(spark, root).groupBy("post").agg(F.count("*").alias("c"), F.count_if("high").alias("h"), F.sum("likes").alias("l"))
    j = formats(spark, root).join(h, "post", "left")
    z = lambda c: F.sum(F.coalesce(c, F.lit(0)))
    return j.groupBy("format").agg(F.count("*").alias("posts"), z("c").alias("comments"), z("h").alias("high_signal"), z("l").alias("likes"))


@query(
    SCORED
    + f"""
    , e AS (SELECT comment_id, likes, score, text, unnest(topics) AS topic, len(topics) AS n, substr(lower(trim(text)), 1, 120) AS said FROM h WHERE NOT generic),
    a AS (SELECT topic, comment_id, likes, said, round(score + 4 * ({_HITS_OF}) - 1.5 * (n - 1), 2) AS fit FROM e),
    d AS (SELECT *, row_number() OVER (PARTITION BY topic, said ORDER BY fit DESC, likes DESC, comment_id) AS copy FROM a),
    r AS (SELECT topic, comment_id, fit, row_number() OVER (PARTITION BY topic ORDER BY fit DESC, likes DESC, comment_id) AS rank FROM d WHERE copy = 1)
    SELECT * FROM r WHERE rank <= 10
    """
)
def representative_comments(spark, root):
    """Ten comments that stand for each topic; one of those that say the same."""
    from tidemill.operators.keyed import latest_first

    e = scored(spark, root).where("NOT generic").select("comment_id", "likes", "score", "text", F.explode("topics").alias("topic"), F.size("topics").alias("n"), F.substring(F.lower(F.trim("text")), 1, 120).alias("said"))
    a = e.select("topic", "said", (-F.round(F.col("score") + 4 * topic_hits(F.col("text"), F.col("topic")) - 1.5 * (F.col("n") - 1), 2)).alias("minus"), (-F.col("likes")).alias("fewer"), "comment_id")
    d = latest_first(a, ["topic", "said"], ["minus", "fewer", "comment_id"])
    return top_k(d, ["topic"], [F.asc("minus"), F.asc("fewer"), F.asc("comment_id")], 10).select("topic", "comment_id", (-F.col("minus")).alias("fit"), "rank")


@query(
    SCORED
    + r"""
    SELECT count(*) AS comments, count(*) FILTER (regexp_matches(text, '(?:^|[^A-Za-z0-9_.@])@[A-Za-z0-9_.]+')) AS with_mention, count(*) FILTER (regexp_matches(text, '(?:^|[^A-Za-z0-9_&#])#[\p{L}\p{N}_]+')) AS with_hashtag,
        count(*) FILTER (contains(text, '?')) AS questions, count(*) FILTER (generic) AS generic, count(*) FILTER (high) AS high_signal, count(*) FILTER (depth > 0) AS replies, count(*) FILTER (len(topics) = 0) AS without_topic FROM h
    """
)
def social_signal_counters(spark, root):
    """Counters over all comments in one pass."""
    t = F.col("text")
    return scored(spark, root).agg(
        F.count("*").alias("comments"), F.count_if(t.rlike(r"(?:^|[^A-Za-z0-9_.@])@[A-Za-z0-9_.]+")).alias("with_mention"), F.count_if(t.rlike(r"(?:^|[^A-Za-z0-9_&#])#[\p{L}\p{N}_]+")).alias("with_hashtag"),
        F.count_if(t.contains("?")).alias("questions"), F.count_if("generic").alias("generic"), F.count_if("high").alias("high_signal"), F.count_if(F.col("depth") > 0).alias("replies"), F.count_if(F.size("topics") == 0).alias("without_topic"),
    )


@query(COMMENTS + " SELECT comment_id, list_contains(list_transform(['eat', 'vet', 'cost'], lambda w: contains(lower(text), w)), true) AS matched FROM c")
def substring_topic_filter(spark, root):
    """The unbounded profile: any term anywhere, also within words."""
    low = F.lower("text")
    return comments(spark, root).select("comment_id", F.exists(F.array(*[F.lit(w) for w in ("eat", "vet", "cost")]), lambda w: F.contains(low, w)).alias("matched"))


#: Two-sided tensions: topics that pull against each other.
TENSIONS = {"wish_against_cost": ("food", "purchase"), "care_against_fear": ("care", "behaviour"), "joy_against_illness": ("emotion", "health")}


@query(
    SCORED
    + "".join(
        f"{'UNION ALL ' if i else ''}SELECT '{k}' AS tension, post, count(*) FILTER (list_contains(topics, '{a}')) AS first_side, count(*) FILTER (list_contains(topics, '{b}')) AS second_side, count(*) FILTER (list_contains(topics, '{a}') AND list_contains(topics, '{b}')) AS both_sides FROM h GROUP BY post HAVING count(*) FILTER (list_contains(topics, '{a}')) >= 3 AND count(*) FILTER (list_contains(topics, '{b}')) >= 3 "
        for i, (k, (a, b)) in enumerate(TENSIONS.items())
    )
)
def tension_detection(spark, root):
    """Posts under which both sides of a tension are voiced, and by how many at once."""
    h = scored(spark, root).select("post", "topics")
    has = lambda x: F.array_contains("topics", x)
    sides = F.array(*[F.struct(F.lit(k).alias("tension"), has(a).alias("a"), has(b).alias("b")) for k, (a, b) in TENSIONS.items()])
    e = h.select("post", F.explode(sides).alias("s")).where("s.a OR s.b")
    n = e.groupBy("s.tension", "post").agg(F.count_if(F.col("s.a")).alias("first_side"), F.count_if(F.col("s.b")).alias("second_side"), F.count_if(F.col("s.a") & F.col("s.b")).alias("both_sides"))
    return n.where("first_side >= 3 AND second_side >= 3")


@query(SCORED + ", e AS (SELECT post, unnest(topics) AS topic, likes, high FROM h), n AS (SELECT post, topic, count(*) AS comments, count(*) FILTER (high) AS high_signal, CAST(sum(likes) AS BIGINT) AS likes FROM e GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY high_signal DESC, comments DESC, post) AS rank FROM n) SELECT * FROM r WHERE rank <= 6")
def representative_posts(spark, root):
    """The six posts that stand for each topic: most high-signal comments, then most comments."""
    e = scored(spark, root).select("post", F.explode("topics").alias("topic"), "likes", "high")
    n = e.groupBy("post", "topic").agg(F.count("*").alias("comments"), F.count_if("high").alias("high_signal"), F.sum("likes").alias("likes"))
    return top_k(n, ["topic"], [F.desc("high_signal"), F.desc("comments"), F.asc("post")], 6)


#: Fixed words of the substring profile; a deployment gives its own.
DIET = ["eat", "food", "feed", "diet", "kibble", "treat", "recipe", "stew", "raw", "grain", "paste", "sardine", "jerky", "bite", "chicken", "pumpkin", "carrot", "stick", "water", "bowl", "upset", "allerg", "vet", "cost", "price", "meal", "snack", "liver", "bone", "biscuit"]
_DIET = "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in DIET) + ")"
_DIET_WORDS = _WORDS


@query(
    COMMENTS
    + f""", m AS (SELECT *, {_DIET} AS matched FROM c), s AS (SELECT *, CASE WHEN trim(text) = '' THEN false ELSE least(10, 1.4 * log2(likes + 1)) + CASE WHEN {_DIET_WORDS} >= 12 THEN 2 ELSE 0 END + CASE WHEN {_DIET_WORDS} >= 28 THEN 2 ELSE 0 END
    + CASE WHEN contains(text, '?') THEN 2 ELSE 0 END + CASE WHEN matched THEN 3 ELSE 0 END >= 4 OR likes >= 8 END AS high FROM m) SELECT comment_id, matched, high FROM s WHERE matched"""
)
def diet_high_signal(spark, root):
    """The substring profile's own measure of telling comments: flat points for a match, never for an empty text."""
    t, n = F.col("text"), F.col("likes")
    low = F.lower(t)
    c = comments(spark, root).withColumn("matched", F.exists(F.array(*map(F.lit, DIET)), lambda w: F.contains(low, w))).where("matched")
    add = lambda cond, x: F.when(cond, x).otherwise(0)
    words = T.word_count(t)
    points = F.least(F.lit(10.0), 1.4 * F.log2(n + 1)) + add(words >= 12, 2) + add(words >= 28, 2) + add(t.contains("?"), 2) + 3
    return c.select("comment_id", "matched", F.when(F.trim(t) == "", False).otherwise((points >= 4) | (n >= 8)).alias("high"))


@query(
    COMMENTS
    + FORMATTED
    + """, n AS (SELECT post, count(*) AS captured FROM c GROUP BY post), r AS (SELECT f.format, f.post, coalesce(captured, 0) AS captured, row_number() OVER (PARTITION BY format ORDER BY coalesce(captured, 0) DESC, f.post) AS rank FROM f LEFT JOIN n ON f.post = n.post) SELECT * FROM r WHERE rank <= 8"""
)
def format_top_posts(spark, root):
    """The eight posts of most comments of each format."""
    n = comments(spark, root).groupBy("post").agg(F.count("*").alias("captured"))
    f = formats(spark, root).join(n, "post", "left").select("format", "post", F.coalesce("captured", F.lit(0)).alias("captured"))
    return top_k(f, ["format"], [F.desc("captured"), F.asc("post")], 8)


_REGEX_FORMATS = {"question": "(anyone|asked|question)", "story": "(memory|afternoon|uncle)", "rescue": "(rescue|adopted|shelter)", "portrait": "(light|golden|photo)"}


@query(
    COMMENTS
    + f""", r AS (SELECT post, text, row_number() OVER (PARTITION BY post ORDER BY comment_id) AS n FROM c), x AS (SELECT post, string_agg(lower(text), chr(10) ORDER BY n) AS said FROM r WHERE n <= 60 GROUP BY post), a AS (SELECT p.post, lower(coalesce(title, '')) || chr(10) || coalesce(said, '') AS said FROM p LEFT JOIN x ON p.post = x.post)
    SELECT post, CASE {" ".join(f"WHEN regexp_matches(said, '{v}') THEN '{k}'" for k, v in _REGEX_FORMATS.items())} ELSE 'general' END AS format FROM a"""
)
def post_format_first_match(spark, root):
    """The first format whose pattern stands in a post's caption or first sixty comments."""
    first = top_k(comments(spark, root).select("post", "comment_id", "text"), ["post"], [F.asc("comment_id")], 60, "n")
    hit = first.groupBy("post").agg(*[F.max(F.lower("text").rlike(v)).alias(k) for k, v in _REGEX_FORMATS.items()])
    j = posts(spark, root).join(hit, "post", "left")
    caption = F.lower(F.coalesce("title", F.lit("")))
    out = F.lit(None).cast("string")
    for k, v in reversed(_REGEX_FORMATS.items()):
        out = F.when(caption.rlike(v) | F.coalesce(k, F.lit(False)), k).otherwise(out)
    return j.select("post", F.coalesce(out, F.lit("general")).alias("format"))


@query(SCORED + f", tops AS (SELECT 'hashtag' AS kind, unnest(list_distinct(regexp_extract_all(lower(text), '(?:^|[^A-Za-z0-9_&#])#([\\p{{L}}\\p{{N}}_]+)', 1))) AS value FROM c UNION ALL SELECT 'mention', unnest(list_distinct(regexp_extract_all(lower(text), '(?:^|[^A-Za-z0-9_.@])@([A-Za-z0-9_.]+)', 1))) FROM c UNION ALL SELECT 'emoji', unnest(regexp_extract_all(text, '{T.EMOJI_CLUSTER}')) FROM c), n AS (SELECT kind, value, count(*) AS n FROM tops GROUP BY ALL), rk AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, value) AS rank FROM n) SELECT * FROM rk WHERE rank <= 20")
def social_signal_top(spark, root):
    """The twenty most frequent hashtags, mentions and emoji."""
    t = F.col("text")
    one = lambda k, v: F.transform(v, lambda x: F.struct(F.lit(k).alias("kind"), x.alias("value")))
    e = comments(spark, root).select(F.explode(F.concat(one("hashtag", T.hashtags(t)), one("mention", T.mentions(t)), one("emoji", T.emojis(t)))).alias("x"))
    return top_k(e.groupBy("x.kind", "x.value").agg(F.count("*").alias("n")), ["kind"], [F.desc("n"), F.asc("value")], 20)
