"""Posts on a timeline: events near them, baselines around them and links between."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F

from tidemill.functions import text as T
from tidemill.functions.values import day_offset, seconds
from tidemill.operators.intervals import days_between, nearest, within_days
from tidemill.operators.linking import confidence, link_score, reason_slug
from tidemill.operators.ranking import top_k
from tidemill.plans.base import COMMENTS, comments, posts
from tidemill.plans.catalog import query
from tidemill.plans.scores import FORMATTED, formats
from tidemill.session import cut
from tidemill.sources.tables import table

@dataclass(frozen=True)
class Event:
    """An event that posts may be linked with; at: seconds since 1970."""

    event_id: str
    at: int
    terms: tuple[str, ...]
    entities: tuple[str, ...] = ()
    locations: tuple[str, ...] = ()
    markers: tuple[str, ...] = ()
    salience: float = 0.5
    pattern: str = "Comments show a response that may belong to the event."


#: Examples; functions take others.
EVENTS = (
    Event("spring_show", 1714557600, ("golden", "picture", "#walkies"), ("show",), ("farmers market",), ("😍", "🏆", "🐶"), 0.9),
    Event("summer_heat", 1722470400, ("heat", "summer", "#zoomies"), ("heat wave",), ("beach",), ("🔥", "🥵"), 0.6),
    Event("autumn_move", 1729036800, ("autumn", "the move", "#couchking"), ("move",), ("juniper hill",), ("📦", "😢"), 0.8),
    Event("winter_walk", 1736899200, ("winter", "walk", "#seniorpup"), (), ("harbor field",), ("🐾", "👏"), 0.7),
    Event("rescue_week", 1748736000, ("rescue", "adopted", "#rescuedog"), ("shelter", "rescue"), ("shelter",), ("🙏", "💕"), 0.95),
)
#: What stands for an entity or a place in texts: label to terms.
ENTITIES = {"show": ["show", "parade"], "heat wave": ["heat wave", "hot day"], "move": ["moved", "the move"], "shelter": ["shelter", "kennel"], "rescue": ["rescue", "adopted", "adoption"], "vet": ["vet"]}
PLACES = {"beach": ["beach"], "farmers market": ["farmers market"], "juniper hill": ["juniper hill"], "harbor field": ["harbor field"], "shelter": ["shelter"], "park": ["park"]}
#: A comment counts at most once for each group of terms.
TERM_GROUPS = {"grief": ["miss", "passed away", "memory"], "joy": ["love", "joy", "happy"], "food": ["treats?", "food", "recipe"], "request": ["where", "anyone", "please"]}
WINDOWS = (1, 3, 7)
TOP_PHRASES, TOP_EMOJI = 16, 12


def _listed(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]" if xs else "CAST([] AS VARCHAR[])"


_SEED_SQL = "s(event_id, event_s, terms, entities, locations, markers, salience) AS (VALUES " + ", ".join(f"('{e.event_id}', CAST({e.at} AS BIGINT), {_listed(e.terms)}, {_listed(e.entities)}, {_listed(e.locations)}, {_listed(e.markers)}, {e.salience})" for e in EVENTS) + ")"


def seeds(spark, events=EVENTS):
    rows = [(e.event_id, e.at, list(e.terms), list(e.entities), list(e.locations), list(e.markers), e.salience) for e in events]
    a = "array<string>"
    return spark.createDataFrame(rows, f"event_id string, event_s bigint, terms {a}, entities {a}, locations {a}, markers {a}, salience double")


def dated(spark, root):
    return posts(spark, root).where("posted_at IS NOT NULL").withColumn("posted_s", F.unix_seconds("posted_at"))


_DATED = COMMENTS + ", d AS (SELECT * FROM p WHERE posted_s IS NOT NULL), " + _SEED_SQL


@query(_DATED + " SELECT event_id, w AS days, count(d.post) AS posts FROM s CROSS JOIN (SELECT unnest([1, 3, 7]) AS w) LEFT JOIN d ON abs(posted_s - event_s) <= w * 86400 GROUP BY ALL")
def event_window_candidates(spark, root):
    """Posts within one, three and seven days of each event; windows without posts are kept."""
    near = within_days(dated(spark, root).select("post", "posted_s"), seeds(spark).select("event_id", "event_s"), "posted_s", "event_s", 7)
    gap = F.abs(F.col("posted_s") - F.col("event_s"))
    w = near.select("event_id", F.explode(F.filter(F.array(F.lit(1), F.lit(3), F.lit(7)), lambda x: gap <= x * 86400)).alias("days")).groupBy("event_id", "days").agg(F.count("*").alias("posts"))
    windows = seeds(spark).select("event_id", F.explode(F.array(F.lit(1), F.lit(3), F.lit(7))).alias("days"))
    return windows.join(w, ["event_id", "days"], "left").na.fill(0, ["posts"])


@query(_DATED + ", n AS (SELECT post, event_id, abs(posted_s - event_s) AS gap_s, row_number() OVER (PARTITION BY post ORDER BY abs(posted_s - event_s), event_id) AS rn FROM d JOIN s ON abs(posted_s - event_s) <= 30 * 86400) SELECT post, event_id, gap_s FROM n WHERE rn = 1")
def nearest_event_asof(spark, root):
    """The event nearest to each post within thirty days."""
    return nearest(dated(spark, root), seeds(spark), "post", "posted_s", "event_s", "event_id", 30)


_BASELINE = """
    , g AS (SELECT d.post, d.posted_s, d.like_count, d.captured_comments, f.format FROM d JOIN f ON d.post = f.post),
    same AS (SELECT a.post, count(*) AS n, avg(b.captured_comments) AS captured, avg(b.like_count) AS likes FROM g a JOIN g b ON a.format = b.format AND a.post <> b.post AND abs(a.posted_s - b.posted_s) <= 45 * 86400 GROUP BY a.post),
    anyp AS (SELECT a.post, count(*) AS n, avg(b.captured_comments) AS captured, avg(b.like_count) AS likes FROM g a JOIN g b ON a.post <> b.post AND abs(a.posted_s - b.posted_s) <= 21 * 86400 GROUP BY a.post),
    b AS (SELECT g.post, CASE WHEN coalesce(same.n, 0) >= 3 THEN 'same_format' ELSE 'nearby' END AS basis, coalesce(CASE WHEN same.n >= 3 THEN same.n ELSE anyp.n END, 0) AS posts,
        round(coalesce(CASE WHEN same.n >= 3 THEN same.captured ELSE anyp.captured END, 0), 2) AS captured, round(coalesce(CASE WHEN same.n >= 3 THEN same.likes ELSE anyp.likes END, 0), 2) AS likes
        FROM g LEFT JOIN same ON g.post = same.post LEFT JOIN anyp ON g.post = anyp.post)
"""


def baselines(spark, root, posts_with=None, sums=(), said=None):
    """Each post's baseline: posts of its format within 45 days if there are three, else any within 21.

    The window's posts are summed by range frames over seconds, and the post's own share taken off.
    posts_with: columns by post to join; of those in `sums` the sum over the baseline's posts is given.
    """
    from pyspark.sql import Window

    g = dated(spark, root).join(formats(spark, root, said=said).select("post", "format"), "post").select("post", "posted_s", "like_count", "captured_comments", "format")
    if posts_with is not None:
        g = g.join(posts_with, "post", "left").na.fill(0, list(sums))

    def around(keys, days):
        # posts of one second are summed first, so a partition holds at most 3 * days * 86,400 rows;
        # each second is copied to the buckets its window reaches, and looked up in its own
        size = days * 86400
        at = g.groupBy(*keys, "posted_s").agg(F.count("*").alias("n"), *[f(c).alias(f"{k}_{c}") for c in ("captured_comments", "like_count", *sums) for k, f in (("k", F.count), ("s", F.sum))])
        b = F.floor(F.col("posted_s") / size)
        spread = at.withColumn("__b", F.explode(F.array(b - 1, b, b + 1))).withColumn("__own", F.col("__b") == b)
        w = Window.partitionBy(*keys, "__b").orderBy("posted_s").rangeBetween(-size, size)
        seconds = spread.select(*keys, "posted_s", "__own", *[F.sum(c).over(w).alias(c) for c in at.columns if c not in (*keys, "posted_s")]).where("__own").drop("__own")
        j = g.join(seconds, [*keys, "posted_s"])
        rest = lambda c: F.coalesce(F.col(f"s_{c}"), F.lit(0)) - F.coalesce(F.col(c), F.lit(0))
        mean = lambda c: rest(c) / F.nullif(F.col(f"k_{c}") - F.col(c).isNotNull().cast("int"), F.lit(0))
        return j.select("post", (F.col("n") - 1).alias("n"), mean("captured_comments").alias("captured"), mean("like_count").alias("likes"), rest("captured_comments").alias("comments"), *[rest(c).alias(f"sum_{c}") for c in sums])

    more = ["comments", *[f"sum_{c}" for c in sums]]
    same = around(["format"], 45).select("post", F.col("n").alias("sn"), F.col("captured").alias("sc"), F.col("likes").alias("sl"), *[F.col(c).alias(f"s_{c}") for c in more])
    near = around([], 21).select("post", F.col("n").alias("an"), F.col("captured").alias("ac"), F.col("likes").alias("al"), *[F.col(c).alias(f"a_{c}") for c in more])
    j = g.join(same, "post").join(near, "post")
    enough = F.col("sn") >= 3
    pick = lambda a, b: F.round(F.coalesce(F.when(enough, F.col(a)).otherwise(F.col(b)), F.lit(0.0)), 2)
    either = [F.when(enough, F.col(f"s_{c}")).otherwise(F.col(f"a_{c}")).alias(c) for c in more]
    out = j.select("post", F.when(enough, "same_format").otherwise("nearby").alias("basis"), F.when(enough, F.col("sn")).otherwise(F.col("an")).alias("posts"), pick("sc", "ac").alias("captured"), pick("sl", "al").alias("likes"), *either)
    return out if sums else out.drop("comments")


@query(_DATED + FORMATTED + _BASELINE + " SELECT * FROM b")
def baseline_same_cluster_or_nearby(spark, root):
    """What is usual around each post: its format's posts nearby in time, else any posts nearby."""
    return baselines(spark, root)


@query(_DATED + FORMATTED + _BASELINE + " SELECT b.post, round(d.captured_comments - b.captured, 2) AS captured_delta, round(d.like_count - b.likes, 2) AS likes_delta, CASE WHEN b.likes > 0 THEN round(d.like_count / b.likes, 4) END AS likes_ratio FROM b JOIN d ON b.post = d.post")
def baseline_deltas(spark, root):
    """How far each post is from its baseline."""
    d = dated(spark, root).select("post", "captured_comments", "like_count")
    j = baselines(spark, root).join(d, "post")
    return j.select("post", F.round(F.col("captured_comments") - F.col("captured"), 2).alias("captured_delta"), F.round(F.col("like_count") - F.col("likes"), 2).alias("likes_delta"), F.when(F.col("likes") > 0, F.round(F.col("like_count") / F.col("likes"), 4)).alias("likes_ratio"))


def _labels_sql(text, labels):
    return "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower({text}), '{T.bounded(v)}') THEN '{k}' END" for k, v in labels.items()) + "], lambda x: x IS NOT NULL)"


def labels_of(text, labels):
    """The labels of which a term stands in the text."""
    return F.array_compact(F.array(*[F.when(T.has_any(text, v), F.lit(k)) for k, v in labels.items()]))


_TAGS = f"""
    , src AS (SELECT post, coalesce(title, '') AS text, 'caption' AS place FROM p UNION ALL SELECT post, text, 'comment' FROM c),
    tag AS (SELECT DISTINCT post, kind, value FROM (
        SELECT post, 'hashtag' AS kind, unnest(regexp_extract_all(lower(text), '(?:^|[^A-Za-z0-9_&#])#([\\p{{L}}\\p{{N}}_]+)', 1)) AS value FROM src
        UNION ALL SELECT post, 'mention', unnest(regexp_extract_all(lower(text), '(?:^|[^A-Za-z0-9_.@])@([A-Za-z0-9_.]+)', 1)) FROM src
        UNION ALL SELECT post, 'entity', unnest({_labels_sql("text", ENTITIES)}) FROM src UNION ALL SELECT post, 'place', unnest({_labels_sql("text", PLACES)}) FROM src))
"""


def tags(spark, root, said=None):
    """(post, kind, value): the distinct hashtags, mentions, entities and places of a post's caption and comments."""
    said = posts(spark, root).select("post", F.coalesce("title", F.lit("")).alias("text")).unionByName((comments(spark, root) if said is None else said).select("post", "text"))
    t = F.col("text")
    kinds = {"hashtag": T.hashtags(t), "mention": T.mentions(t), "entity": labels_of(t, ENTITIES), "place": labels_of(t, PLACES)}
    named = lambda k: lambda x: F.struct(F.lit(k).alias("kind"), x.alias("value"))
    each = F.flatten(F.array(*[F.transform(v, named(k)) for k, v in kinds.items()]))
    return said.select("post", F.explode(each).alias("x")).select("post", "x.kind", "x.value").distinct()


@query(COMMENTS + _TAGS + " SELECT * FROM tag")
def post_tags(spark, root):
    """What a post's caption and comments name, each once: hashtags, mentions, entities and places."""
    return tags(spark, root)


_LOOSE = r"trim(regexp_replace(regexp_replace(regexp_replace(lower(text), 'https?://[^\s]+|www\.[^\s]+', ' ', 'g'), '[^\p{L}\p{N}#@''\s-]', ' ', 'g'), '[\s\x{a0}\x{feff}]+', ' ', 'g'))"
_TOPS = (
    r"""
    , lw AS (SELECT post, list_filter(string_split(""" + _LOOSE + r""", ' '), lambda t: length(t) >= 3 AND NOT regexp_matches(t, '^[0-9]+$') AND NOT starts_with(t, '@')) AS w FROM c),
    lp AS (SELECT post, unnest(list_concat([w[i] || ' ' || w[i + 1] for i in range(1, len(w))], [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])) AS phrase FROM lw),
    ln AS (SELECT post, phrase, count(*) AS n FROM lp GROUP BY ALL), lr AS (SELECT *, row_number() OVER (PARTITION BY post ORDER BY n DESC, phrase) AS r FROM ln),
    tph AS (SELECT post, list(phrase ORDER BY r) AS phrases FROM lr WHERE r <= 16 GROUP BY post),
    em AS (SELECT post, regexp_extract_all(text, '""" + T.EMOJI_CLUSTER + r"""') AS e FROM c), en AS (SELECT post, emoji, count(*) AS n FROM (SELECT post, unnest(e) AS emoji FROM em) GROUP BY ALL),
    er AS (SELECT *, row_number() OVER (PARTITION BY post ORDER BY n DESC, emoji) AS r FROM en), et AS (SELECT post, list(emoji ORDER BY r) AS emoji FROM er WHERE r <= 12 GROUP BY post)
"""
)


def top_phrases(c, k=TOP_PHRASES):
    """(post, phrases): the k most frequent two- and three-word phrases of a post's comments."""
    w = c.select("post", T.loose_words(F.col("text")).alias("w"))
    n = w.select("post", F.explode(F.concat(T.ngrams(F.col("w"), 2), T.ngrams(F.col("w"), 3))).alias("phrase")).groupBy("post", "phrase").agg(F.count("*").alias("n"))
    best = top_k(n, ["post"], [F.desc("n"), F.asc("phrase")], k)
    return best.groupBy("post").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "phrase"))), lambda x: x["phrase"]).alias("phrases"))  # k a post


def top_emoji(c, k=TOP_EMOJI):
    """(post, emoji): the k most frequent emoji of a post's comments."""
    n = c.select("post", F.explode(T.emojis(F.col("text"))).alias("emoji")).groupBy("post", "emoji").agg(F.count("*").alias("n"))
    best = top_k(n, ["post"], [F.desc("n"), F.asc("emoji")], k)
    return best.groupBy("post").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "emoji"))), lambda x: x["emoji"]).alias("emoji"))  # k a post


_GROUPS = ", ".join(f"count(*) FILTER (regexp_matches(lower(text), '{T.bounded(v)}')) AS {k}" for k, v in TERM_GROUPS.items())


def term_counts(c):
    return c.groupBy("post").agg(F.count("*").alias("comments"), *[F.count_if(T.has_any(F.col("text"), v)).alias(k) for k, v in TERM_GROUPS.items()])


@query(
    COMMENTS
    + _TAGS
    + _TOPS
    + f"""
    , tc AS (SELECT post, count(*) AS comments, {_GROUPS} FROM c GROUP BY post),
    tk AS (SELECT post, count(*) FILTER (kind = 'hashtag') AS hashtags, count(*) FILTER (kind = 'mention') AS mentions, list(value ORDER BY value) FILTER (kind = 'entity') AS entities, list(value ORDER BY value) FILTER (kind = 'place') AS places FROM tag GROUP BY post)
    SELECT p.post, posted_s, title AS caption, coalesce(comments, 0) AS comments, coalesce(hashtags, 0) AS hashtags, coalesce(mentions, 0) AS mentions, entities, places, phrases, emoji, {", ".join(f"coalesce({k}, 0) AS {k}" for k in TERM_GROUPS)}
    FROM p LEFT JOIN tc ON p.post = tc.post LEFT JOIN tk ON p.post = tk.post LEFT JOIN tph ON p.post = tph.post LEFT JOIN et ON p.post = et.post
    """
)
def post_timeline(spark, root):
    """Every post with what its caption and comments name, say most and show most. Hashtags and mentions are in post_tags."""
    c = cut(comments(spark, root).select("post", "text"))  # read four times below
    t = tags(spark, root, c)
    few = F.array_sort(F.collect_set(F.when(F.col("kind").isin("entity", "place"), F.struct("kind", "value"))))  # at most the labels
    held = t.groupBy("post").agg(F.count_if(F.col("kind") == "hashtag").alias("hashtags"), F.count_if(F.col("kind") == "mention").alias("mentions"), few.alias("few"))
    of = lambda k: F.transform(F.filter("few", lambda x: x["kind"] == k), lambda x: x["value"])
    some = lambda x: F.when(F.size(x) > 0, x)
    j = posts(spark, root).join(term_counts(c), "post", "left").join(held, "post", "left").join(top_phrases(c), "post", "left").join(top_emoji(c), "post", "left")
    j = j.na.fill(0, ["comments", "hashtags", "mentions", *TERM_GROUPS])
    return j.select("post", F.unix_seconds("posted_at").alias("posted_s"), F.col("title").alias("caption"), "comments", "hashtags", "mentions", some(of("entity")).alias("entities"), some(of("place")).alias("places"), "phrases", "emoji", *TERM_GROUPS)


@query(
    _DATED
    + """
    , w AS (SELECT event_id, event_s, unnest([1, 3, 7]) AS days FROM s)
    SELECT event_id, days, strftime(make_timestamp((event_s - days * 86400) * 1000000), '%Y-%m-%d') AS first_day, strftime(make_timestamp((event_s + days * 86400) * 1000000), '%Y-%m-%d') AS last_day,
        strftime(make_timestamp((event_s - days * 86400) * 1000000), '%Y%m%d%H%M%S') AS stamp FROM w
    """
)
def event_windows(spark, root):
    """The days around each event, and the compact stamp that external sources are asked with."""
    w = seeds(spark).select("event_id", "event_s", F.explode(F.array(*map(F.lit, WINDOWS))).alias("days"))
    return w.select("event_id", "days", day_offset(F.col("event_s"), -F.col("days")).alias("first_day"), day_offset(F.col("event_s"), F.col("days")).alias("last_day"), day_offset(F.col("event_s"), -F.col("days"), "yyyyMMddHHmmss").alias("stamp"))


_LINKS = (
    _DATED
    + FORMATTED
    + _BASELINE
    + _TAGS
    + _TOPS
    + """
    , tl AS (SELECT post, list(value) FILTER (kind = 'hashtag') AS hashtags, list(value) FILTER (kind = 'entity') AS found, list(value) FILTER (kind = 'place') AS places FROM tag GROUP BY post),
    x0 AS (SELECT d.post, s.event_id, abs(posted_s - event_s) / 86400.0 AS days, salience, lower(coalesce(title, '')) AS cap, list_transform(terms, lambda t: regexp_replace(t, '^#', '')) AS bare, terms, s.entities, s.locations, s.markers,
        coalesce(hashtags, []) AS hashtags, coalesce(found, []) AS found, coalesce(places, []) AS places, coalesce(phrases, []) AS phrases, coalesce(emoji, []) AS emoji,
        d.captured_comments / greatest(b.captured, 1) AS cr, d.like_count / greatest(b.likes, 1) AS lr, b.posts AS around
        FROM d JOIN s ON abs(posted_s - event_s) <= 7 * 86400 JOIN b ON d.post = b.post LEFT JOIN tl ON d.post = tl.post LEFT JOIN tph ON d.post = tph.post LEFT JOIN et ON d.post = et.post),
    x AS (SELECT *, list_filter(entities, lambda e: len(list_filter(found, lambda f: contains(f, e))) > 0) AS shared, list_filter(locations, lambda l: list_contains(places, l)) AS located,
        list_filter(bare, lambda t: contains(cap, t)) AS captions, list_filter(bare, lambda t: len(list_filter(phrases, lambda f: contains(f, t))) > 0) AS said, list_filter(bare, lambda t: len(list_filter(hashtags, lambda f: contains(f, t))) > 0) AS tags,
        list_filter(bare, lambda t: len(list_filter(list_concat(found, phrases, hashtags), lambda f: contains(f, t))) > 0) AS mentioned, len(list_filter(emoji, lambda e: list_contains(markers, e))) AS marks,
        around > 0 AND cr >= 1.5 AS loud, around > 0 AND lr >= 1.5 AS liked FROM x0),
    y AS (SELECT *, least(CASE WHEN days <= 1 THEN 25 WHEN days <= 3 THEN 18 ELSE 10 END + 8 * len(shared), CASE WHEN days <= 3 THEN 57 ELSE 49 END) + CASE WHEN len(located) > 0 THEN 12 ELSE 0 END + 8 * least(len(captions), 3) + 8 * least(len(said), 3) + 10 * least(len(tags), 2)
        + CASE WHEN len(mentioned) > 0 AND len(shared) = 0 THEN 8 ELSE 0 END + CASE WHEN marks >= 2 THEN 7 ELSE 0 END + CASE WHEN loud THEN 5 ELSE 0 END + CASE WHEN liked THEN 5 ELSE 0 END + CASE WHEN salience >= 0.75 THEN 6 ELSE 0 END AS points,
        len(shared) + len(located) + len(captions) + len(said) + len(tags) + len(mentioned) + CASE WHEN marks >= 2 THEN 1 ELSE 0 END > 0 AS evidence FROM x),
    l AS (SELECT post, event_id, round(days, 4) AS days, least(points, 100) AS score, CASE WHEN NOT evidence THEN 'temporal_only' WHEN points >= 65 THEN 'strong' WHEN points >= 42 THEN 'moderate' WHEN points >= 25 THEN 'weak' ELSE 'temporal_only' END AS confidence,
        list_concat(['temporal_proximity'], list_transform(shared, lambda v: 'entity_overlap:' || replace(v, ' ', '_')), list_transform(located[1:1], lambda v: 'location_overlap:' || replace(v, ' ', '_')), list_transform(captions[1:3], lambda v: 'caption_overlap:' || replace(v, ' ', '_')),
        list_transform(said[1:3], lambda v: 'comment_phrase:' || replace(v, ' ', '_')), list_transform(tags[1:2], lambda v: 'comment_hashtag:' || replace(v, ' ', '_')), CASE WHEN len(shared) = 0 THEN list_transform(mentioned[1:1], lambda v: 'comment_entity:' || replace(v, ' ', '_')) ELSE [] END,
        list_filter([CASE WHEN marks >= 2 THEN 'emoji_shift:event_markers' END, CASE WHEN loud THEN 'volume_shift:captured_comments' END, CASE WHEN liked THEN 'volume_shift:likes' END, CASE WHEN salience >= 0.75 THEN 'news_salience' END], lambda z: z IS NOT NULL)) AS reasons FROM y)
    """
)


def links(spark, root, events=EVENTS):
    """(post, event_id, days, score, confidence, reasons): posts within a week of an event, by all their evidence."""
    d = dated(spark, root)
    c = cut(comments(spark, root).select("post", "text"))  # read four times below; the store is made up once
    bare = sorted({t.lstrip("#") for e in events for t in e.terms})
    t = tags(spark, root, c).where(F.col("kind") != "mention")
    # of hashtags only the terms they hold are kept, so a post has at most the configured terms and labels
    hit = F.when(F.col("kind") == "hashtag", F.filter(F.array(*map(F.lit, bare)), lambda x: F.contains(F.col("value"), x))).otherwise(F.array("value"))
    held = t.select("post", "kind", F.explode(hit).alias("value")).distinct().groupBy("post").agg(*[F.collect_list(F.when(F.col("kind") == k, F.col("value"))).alias(n) for k, n in (("hashtag", "hashtags"), ("entity", "found"), ("place", "places"))])
    near = within_days(d.select("post", "posted_s", "title", "captured_comments", "like_count"), seeds(spark, events), "posted_s", "event_s", 7).join(baselines(spark, root, said=c), "post")
    j = near.join(held, "post", "left").join(top_phrases(c), "post", "left").join(top_emoji(c), "post", "left")
    none = F.array().cast("array<string>")
    j = j.withColumns({k: F.coalesce(k, none) for k in ("hashtags", "found", "places", "phrases", "emoji")})
    j = j.withColumns({"bare": F.transform("terms", lambda x: F.regexp_replace(x, "^#", "")), "cap": F.lower(F.coalesce("title", F.lit("")))})
    within = lambda xs, x: F.exists(xs, lambda f: F.contains(f, x))
    some = lambda c, n: (F.col("posts") > 0) & (F.col(c) / F.greatest(F.col(n), F.lit(1)) >= 1.5)
    x = j.select(
        "post", "event_id", days_between(F.col("posted_s"), F.col("event_s")).alias("days"), "salience", F.filter("entities", lambda e: within("found", e)).alias("shared"), F.filter("locations", lambda v: F.array_contains("places", v)).alias("located"),
        F.filter("bare", lambda v: F.contains(F.col("cap"), v)).alias("captions"), F.filter("bare", lambda v: within("phrases", v)).alias("said"), F.filter("bare", lambda v: within("hashtags", v)).alias("tags"),
        F.filter("bare", lambda v: within(F.concat("found", "phrases", "hashtags"), v)).alias("mentioned"), F.size(F.filter("emoji", lambda e: F.array_contains("markers", e))).alias("marks"),
        F.coalesce(some("captured_comments", "captured"), F.lit(False)).alias("loud"), F.coalesce(some("like_count", "likes"), F.lit(False)).alias("liked"),
    )
    n = lambda k: F.size(k)
    ratio = lambda k: F.when(F.col(k), 2.0).otherwise(0.0)
    points = link_score(F.col("days"), n("shared"), n("located") > 0, n("captions"), n("said"), n("tags"), n("mentioned") > 0, F.col("marks"), ratio("loud"), ratio("liked"), F.col("salience"))
    evidence = (n("shared") + n("located") + n("captions") + n("said") + n("tags") + n("mentioned") > 0) | (F.col("marks") >= 2)
    code = lambda k, most, prefix: F.transform(F.slice(k, 1, most), lambda v: reason_slug(prefix, v))
    rest = F.array_compact(F.array(F.when(F.col("marks") >= 2, "emoji_shift:event_markers"), F.when(F.col("loud"), "volume_shift:captured_comments"), F.when(F.col("liked"), "volume_shift:likes"), F.when(F.col("salience") >= 0.75, "news_salience")))
    reasons = F.concat(
        F.array(F.lit("temporal_proximity")), code("shared", 99, "entity_overlap"), code("located", 1, "location_overlap"), code("captions", 3, "caption_overlap"), code("said", 3, "comment_phrase"), code("tags", 2, "comment_hashtag"),
        F.when(n("shared") == 0, code("mentioned", 1, "comment_entity")).otherwise(none), rest,
    )
    y = x.withColumn("points", points).where("points > 0")
    return y.select("post", "event_id", F.round("days", 4).alias("days"), F.least("points", F.lit(100)).alias("score"), confidence(F.col("points"), evidence).alias("confidence"), reasons.alias("reasons"))


@query(_LINKS + " SELECT * FROM l")
def post_event_links(spark, root):
    """Posts linked with events within a week, with score, confidence and reasons, from captions, comments, emoji and activity."""
    return links(spark, root)


_SHARES = ", ".join(f"round(round(coalesce({k}, 0) / greatest(captured_comments, 1), 4) - CASE WHEN bc > 0 THEN round(b_{k} / bc, 4) ELSE 0 END, 4) AS {k}_delta" for k in TERM_GROUPS)


@query(
    _DATED
    + FORMATTED
    + f"""
    , tc AS (SELECT post, {_GROUPS} FROM c GROUP BY post), g AS (SELECT d.post, d.posted_s, coalesce(d.captured_comments, 0) AS captured_comments, f.format, {", ".join(f"coalesce({k}, 0) AS {k}" for k in TERM_GROUPS)} FROM d JOIN f ON d.post = f.post LEFT JOIN tc ON d.post = tc.post),
    same AS (SELECT a.post, count(*) AS n, sum(b.captured_comments) AS bc, {", ".join(f"sum(b.{k}) AS b_{k}" for k in TERM_GROUPS)} FROM g a JOIN g b ON a.format = b.format AND a.post <> b.post AND abs(a.posted_s - b.posted_s) <= 45 * 86400 GROUP BY a.post),
    near AS (SELECT a.post, count(*) AS n, sum(b.captured_comments) AS bc, {", ".join(f"sum(b.{k}) AS b_{k}" for k in TERM_GROUPS)} FROM g a JOIN g b ON a.post <> b.post AND abs(a.posted_s - b.posted_s) <= 21 * 86400 GROUP BY a.post),
    z AS (SELECT g.*, coalesce(CASE WHEN same.n >= 3 THEN same.bc ELSE near.bc END, 0) AS bc, {", ".join(f"coalesce(CASE WHEN same.n >= 3 THEN same.b_{k} ELSE near.b_{k} END, 0) AS b_{k}" for k in TERM_GROUPS)} FROM g LEFT JOIN same ON g.post = same.post LEFT JOIN near ON g.post = near.post)
    SELECT post, {_SHARES} FROM z
    """
)
def term_share_deltas(spark, root):
    """How much more of a post's comments say the terms of each group than around it."""
    keys = list(TERM_GROUPS)
    counts = term_counts(comments(spark, root)).drop("comments")
    b = baselines(spark, root, counts, tuple(keys))
    j = dated(spark, root).select("post", "captured_comments").join(counts, "post", "left").join(b.drop("posts", "basis", "captured", "likes"), "post")
    own = lambda k: F.round(F.coalesce(k, F.lit(0)) / F.greatest(F.coalesce("captured_comments", F.lit(0)), F.lit(1)), 4)
    usual = lambda k: F.when(F.col("comments") > 0, F.round(F.col(f"sum_{k}") / F.col("comments"), 4)).otherwise(0.0)
    return j.select("post", *[F.round(own(k) - usual(k), 4).alias(f"{k}_delta") for k in keys])


_QUOTES = """
    , lk AS (SELECT l.post, l.event_id, l.score, l.confidence, l.reasons, s.terms FROM l JOIN s ON l.event_id = s.event_id WHERE confidence <> 'temporal_only'),
    eq AS (SELECT lk.event_id, lk.post, c.comment_id, c.author, c.likes, c.text FROM lk JOIN c ON lk.post = c.post WHERE len(list_filter(lk.terms, lambda t: contains(lower(c.text), regexp_replace(t, '^#', '')))) > 0),
    eqr AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY likes DESC, length(text) DESC, comment_id) AS rank FROM eq)
"""


def quotes_of_events(spark, root, linked, k=8):
    """(event_id, post, comment_id, author, likes, text, rank): the k best comments on posts linked with an event that say its terms."""
    t = linked.where("confidence <> 'temporal_only'").select("event_id", "post").join(F.broadcast(seeds(spark).select("event_id", "terms")), "event_id")  # the configured events
    said = t.join(comments(spark, root).select("post", "comment_id", "author", "likes", "text"), "post")
    said = said.where(F.exists("terms", lambda x: F.contains(F.lower("text"), F.regexp_replace(x, "^#", "")))).drop("terms")
    return top_k(said, ["event_id"], [F.desc("likes"), F.desc(F.length("text")), F.asc("comment_id")], k)


@query(_LINKS + _QUOTES + " SELECT event_id, post, comment_id, author, likes, rank FROM eqr WHERE rank <= 8")
def event_evidence_quotes(spark, root):
    """The eight most liked comments that say an event's terms on posts linked with it."""
    return quotes_of_events(spark, root, links(spark, root)).drop("text").select("event_id", "post", "comment_id", "author", "likes", "rank")


@query(_LINKS + _QUOTES + " SELECT lk.event_id, lk.post, lk.score, lk.confidence, lk.reasons, list(q.comment_id ORDER BY q.rank) FILTER (q.comment_id IS NOT NULL) AS quotes FROM lk LEFT JOIN (SELECT * FROM eqr WHERE rank <= 8) q ON lk.event_id = q.event_id AND lk.post = q.post GROUP BY ALL")
def event_evidence_packets(spark, root):
    """One packet for each link with evidence: its score, reasons and those of the event's quotes that stand on its post."""
    linked = cut(links(spark, root).where("confidence <> 'temporal_only'"))
    q = quotes_of_events(spark, root, linked).groupBy("event_id", "post").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "comment_id"))), lambda x: x["comment_id"]).alias("quotes"))  # at most 8 an event
    return linked.join(q, ["event_id", "post"], "left").select("event_id", "post", "score", "confidence", "reasons", "quotes")


@query(
    _LINKS
    + """
    , k AS (SELECT l.*, CASE confidence WHEN 'strong' THEN 3 WHEN 'moderate' THEN 2 ELSE 1 END AS band, d.captured_comments - b.captured AS more, d.like_count - b.likes AS liked FROM l JOIN d ON l.post = d.post JOIN b ON l.post = b.post WHERE confidence <> 'temporal_only')
    SELECT event_id, CASE max(band) WHEN 3 THEN 'strong' WHEN 2 THEN 'moderate' ELSE 'weak' END AS confidence, count(*) AS linked_posts, round(avg(more), 2) AS captured_delta, round(avg(liked), 2) AS likes_delta FROM k GROUP BY event_id
    """
)
def event_resonance(spark, root):
    """Events with evidence: their best band, linked posts and how far these are above what is usual around them."""
    band = F.when(F.col("confidence") == "strong", 3).when(F.col("confidence") == "moderate", 2).otherwise(1)
    d = dated(spark, root).select("post", "captured_comments", "like_count")
    j = links(spark, root).where("confidence <> 'temporal_only'").withColumn("band", band).join(d, "post").join(baselines(spark, root).select("post", "captured", "likes"), "post")
    g = j.groupBy("event_id").agg(F.max("band").alias("band"), F.count("*").alias("linked_posts"), F.round(F.avg(F.col("captured_comments") - F.col("captured")), 2).alias("captured_delta"), F.round(F.avg(F.col("like_count") - F.col("likes")), 2).alias("likes_delta"))
    return g.select("event_id", F.when(F.col("band") == 3, "strong").when(F.col("band") == 2, "moderate").otherwise("weak").alias("confidence"), "linked_posts", "captured_delta", "likes_delta")


@query(_LINKS + " SELECT event_id, count(*) AS posts, count(*) FILTER (confidence <> 'temporal_only') AS with_evidence, max(score) AS best_score, round(avg(score), 2) AS mean_score FROM l GROUP BY event_id")
def event_rollup(spark, root):
    """What each event's links amount to."""
    return links(spark, root).groupBy("event_id").agg(F.count("*").alias("posts"), F.count_if(F.col("confidence") != "temporal_only").alias("with_evidence"), F.max("score").alias("best_score"), F.round(F.avg("score"), 2).alias("mean_score"))


@query(_LINKS + ", r AS (SELECT event_id, unnest(reasons) AS reason FROM l) SELECT event_id, reason, count(*) AS n FROM r GROUP BY ALL")
def event_reason_codes(spark, root):
    """How often each reason links posts with each event."""
    return links(spark, root).select("event_id", F.explode("reasons").alias("reason")).groupBy("event_id", "reason").agg(F.count("*").alias("n"))


@query("SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, event_type, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY ALL")
def tumbling_event_counts(spark, root):
    """Events by hour and type (an extension: tumbling windows)."""
    e = table(spark, root, "events")
    hour = F.floor(seconds(F.col("ts")) / 3600)
    return e.groupBy(hour.alias("hour"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("value"))
