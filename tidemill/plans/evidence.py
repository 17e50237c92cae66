"""Signals, themes and quotes: pointers that must resolve, claims, bands and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators.diverse import select_diverse
from tidemill.operators.keyed import first_claims
from tidemill.operators.providers import RuleProvider, extract_signals, numbered_batches, reduce_signals, resolve_pointers
from tidemill.operators.ranking import top_k
from tidemill.plans.base import COMMENTS, comments, posts
from tidemill.plans.catalog import query
from tidemill.plans.scores import SCORED, scored
from tidemill.session import cut
from tidemill.sources.tables import table


@query(COMMENTS + " SELECT q.quote_id, q.comment_id, c.post, c.likes AS comment_likes, q.text = c.text AS verbatim FROM quotes q JOIN c ON q.comment_id = c.comment_id")
def pointer_join_signals(spark, root):
    """Quotes joined to the comments they point at; those that point nowhere are dropped."""
    q = table(spark, root, "quotes").select("quote_id", "comment_id", F.col("text").alias("said"))
    c = comments(spark, root)
    return q.join(c, "comment_id").select("quote_id", "comment_id", "post", F.col("likes").alias("comment_likes"), (F.col("said") == F.col("text")).alias("verbatim"))


@query(COMMENTS + " SELECT count(*) AS quotes, count(*) FILTER (comment_id IS NULL) AS without_pointer FROM quotes q WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.comment_id = q.comment_id)")
def orphan_quotes(spark, root):
    """Quotes whose comment is unknown."""
    o = table(spark, root, "quotes").join(comments(spark, root).select("comment_id"), "comment_id", "left_anti")
    return o.agg(F.count("*").alias("quotes"), F.count_if(F.col("comment_id").isNull()).alias("without_pointer"))


_CLAIMS = "WITH e AS (SELECT DISTINCT id AS theme_id, theme_row_id, unnest(representative_quotes).quote_id AS quote_id FROM themes WHERE id IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY quote_id ORDER BY theme_row_id, theme_id) AS rn FROM e WHERE quote_id IS NOT NULL)"


def _claims(spark, root):
    e = table(spark, root, "themes").where("id IS NOT NULL").select(F.col("id").alias("theme_id"), "theme_row_id", F.explode("representative_quotes.quote_id").alias("quote_id"))
    return e.where("quote_id IS NOT NULL").distinct()


@query(_CLAIMS + " SELECT quote_id, theme_id, theme_row_id FROM k WHERE rn = 1")
def first_claim_wins_merge(spark, root):
    """Each quote goes to the theme row that claimed it first."""
    return first_claims(_claims(spark, root), "quote_id", ["theme_row_id", "theme_id"]).select("quote_id", "theme_id", "theme_row_id")


@query(_CLAIMS + ", s AS (SELECT theme_id, count(DISTINCT quote_id) AS n FROM e WHERE quote_id IS NOT NULL GROUP BY theme_id) SELECT theme_id, n AS quotes, CASE WHEN n >= 80 THEN 'high' WHEN n >= 25 THEN 'medium' ELSE 'low' END AS strength FROM s")
def theme_strength_bands(spark, root):
    """Themes by the number of their quotes, over all their rows."""
    s = _claims(spark, root).groupBy("theme_id").agg(F.count_distinct("quote_id").alias("quotes"))
    return s.withColumn("strength", F.when(F.col("quotes") >= 80, "high").when(F.col("quotes") >= 25, "medium").otherwise("low"))


@query(
    _CLAIMS
    + """, s AS (SELECT theme_id, count(DISTINCT quote_id) AS n FROM e WHERE quote_id IS NOT NULL GROUP BY theme_id),
    a AS (SELECT 'top' AS side, theme_id, n AS quotes, row_number() OVER (ORDER BY n DESC, theme_id) AS rank FROM s UNION ALL SELECT 'bottom', theme_id, n, row_number() OVER (ORDER BY n, theme_id) FROM s)
    SELECT * FROM a WHERE rank <= 10"""
)
def theme_top_bottom(spark, root):
    """The ten largest and the ten smallest themes (a report)."""
    s = theme_strength_bands(spark, root).select("theme_id", "quotes")
    top = top_k(s.orderBy(F.desc("quotes"), "theme_id").limit(10).withColumn("side", F.lit("top")), ["side"], [F.desc("quotes"), F.asc("theme_id")], 10)
    low = top_k(s.orderBy("quotes", "theme_id").limit(10).withColumn("side", F.lit("bottom")), ["side"], [F.asc("quotes"), F.asc("theme_id")], 10)
    return top.unionByName(low).select("side", "theme_id", "quotes", "rank")


@query(
    """
    WITH t AS (SELECT theme_row_id, id, lower(trim(regexp_replace(label, '[\\s]+', ' ', 'g'))) AS label FROM themes WHERE id IS NOT NULL AND label IS NOT NULL)
    SELECT id AS theme_id, count(DISTINCT label) AS labels, count(*) AS theme_rows, arg_min(label, theme_row_id) AS first_label FROM t GROUP BY id
    """
)
def theme_label_merge(spark, root):
    """Labels of one theme in one spelling, the first row's leading."""
    t = table(spark, root, "themes").where("id IS NOT NULL AND label IS NOT NULL")
    label = F.lower(F.trim(F.regexp_replace("label", r"[\s]+", " ")))
    return t.groupBy(F.col("id").alias("theme_id")).agg(F.count_distinct(label).alias("labels"), F.count("*").alias("theme_rows"), F.min_by(label, "theme_row_id").alias("first_label"))


@query("SELECT trigger, count(DISTINCT id) AS themes FROM (SELECT id, unnest(emotional_triggers) AS trigger FROM themes) GROUP BY trigger")
def trigger_rollup(spark, root):
    """Themes by emotional trigger."""
    t = table(spark, root, "themes").select("id", F.explode("emotional_triggers").alias("trigger"))
    return t.groupBy("trigger").agg(F.count_distinct("id").alias("themes"))


@query(
    SCORED
    + """
    , d AS (SELECT min(comment_id) AS comment_id, text, count(*) AS copies FROM h WHERE NOT generic GROUP BY text)
    SELECT h.comment_id, d.comment_id AS encoded_as, d.copies FROM h JOIN d ON h.text = d.text WHERE NOT generic
    """
)
def dedupe_encode_join(spark, root):
    """Distinct texts are encoded once and joined back to all comments that say them."""
    h = scored(spark, root).where("NOT generic").select("comment_id", "text")
    d = h.groupBy("text").agg(F.min("comment_id").alias("encoded_as"), F.count("*").alias("copies"))
    return h.join(d, "text").select("comment_id", "encoded_as", "copies")


@query()
def diverse_evidence(spark, root):
    """Eight telling comments of each topic, from different posts and authors while there are any."""
    e = scored(spark, root).where("NOT generic AND author IS NOT NULL").select(F.explode("topics").alias("topic"), "comment_id", "post", "author", "score")
    return select_diverse(e, "topic", "comment_id", "post", "author", "score", 8)


@query(COMMENTS + " SELECT count(*) AS comments, count(DISTINCT post) AS posts FROM c WHERE EXISTS (SELECT 1 FROM p WHERE p.post = c.post AND p.title IS NOT NULL)")
def comments_on_titled_posts(spark, root):
    """Comments on posts with a caption (semi-join)."""
    return comments(spark, root).join(posts(spark, root).where("title IS NOT NULL").select("post"), "post", "left_semi").agg(F.count("*").alias("comments"), F.count_distinct("post").alias("posts"))


def _cues(cues):
    return "CASE " + " ".join(f"WHEN contains(lower(text), '{c}') THEN '{c}'" for c in cues) + " END"


_SIGNALS = SCORED + f", g0 AS (SELECT comment_id, post, likes, text, {_cues(RuleProvider.PROBLEM)} AS problem, {_cues(RuleProvider.WANT)} AS want FROM h WHERE high), g AS (SELECT *, coalesce(problem, '-') || ' / ' || coalesce(want, '-') AS label FROM g0 WHERE problem IS NOT NULL OR want IS NOT NULL)"


def signals(spark, root, provider=None):
    """(signal_id, comment_id, post, likes, text, problem, want, label): what the provider points at in the telling comments."""
    c = scored(spark, root).where("high").select("comment_id", "post", "likes", "text")
    b = numbered_batches(c, [F.desc("likes"), F.asc("comment_id")])
    r = resolve_pointers(extract_signals(b, "text", provider or RuleProvider()), b)
    label = F.concat_ws(" / ", F.coalesce("problem", F.lit("-")), F.coalesce("want", F.lit("-")))
    return r.withColumns({"signal_id": F.concat(F.lit("s_"), "comment_id"), "label": label})


@query(_SIGNALS + " SELECT problem, want, count(*) AS n, CAST(sum(likes) AS BIGINT) AS likes FROM g GROUP BY ALL")
def map_reduce_signals(spark, root):
    """Problems and wants by provider over batches, pointers resolved, reduced in two levels."""
    return reduce_signals(signals(spark, root))


def built_themes(spark, root):
    from tidemill.operators import themes as H

    s = cut(signals(spark, root).select("signal_id", "comment_id", "likes", "text", "label"))
    p = H.RuleThemes()
    return s, H.theme_table(H.merged_themes(cut(H.candidate_themes(s, p)), p), s)


_THEMES = _SIGNALS + """
    , k AS (SELECT label, count(*) AS signals, CAST(sum(likes) AS BIGINT) AS likes FROM g GROUP BY label), gr AS (SELECT label, comment_id, row_number() OVER (PARTITION BY label ORDER BY likes DESC, comment_id) AS r FROM g), gq AS (SELECT label, list(comment_id ORDER BY r) AS quotes FROM gr WHERE r <= 6 GROUP BY label),
    th AS (SELECT k.*, CASE WHEN signals >= 80 THEN 'high' WHEN signals >= 25 THEN 'medium' ELSE 'low' END AS strength, quotes FROM k JOIN gq ON k.label = gq.label)
"""


@query(_THEMES + " SELECT label, signals, likes, strength, quotes FROM th")
def themes_from_signals(spark, root):
    """Themes that a provider makes of groups of signals and then of their candidates, with all signals and six quotes."""
    return built_themes(spark, root)[1].drop("theme_id")


@query(_THEMES + """, an AS (SELECT label, unnest(['problem', 'want', 'proof', 'objection', 'story', 'comparison']) AS angle, string_split(label, ' / ')[1] AS phrase FROM th),
    ho AS (SELECT an.label, angle, arg_min(comment_id, struct_pack(a := -likes, b := comment_id)) AS source FROM an JOIN g ON an.label = g.label AND contains(lower(text), phrase) GROUP BY ALL)
    SELECT an.label, an.angle, phrase, source AS source_comment_id, source IS NOT NULL AS verified FROM an LEFT JOIN ho ON an.label = ho.label AND an.angle = ho.angle""")
def theme_angles(spark, root):
    """Six angles of each theme with the comment their phrase comes from; phrases that no comment holds are unverified."""
    from tidemill.operators import themes as H

    s, t = built_themes(spark, root)
    t = cut(t)
    texts = t.select("theme_id", "label").join(s, "label").select("theme_id", "comment_id", "text", "likes")
    found = H.borrowed(H.angles(t, H.RuleThemes()), texts)
    return found.join(t.select("theme_id", "label"), "theme_id").select("label", "angle", "phrase", "source_comment_id", "verified")


@query(_THEMES + ", b AS (SELECT label, signals FROM th ORDER BY signals DESC, label LIMIT 10) SELECT label, unnest(['hook', 'explanation', 'solution', 'social_proof', 'call_to_action']) AS part FROM b")
def structured_angles(spark, root):
    """The five parts of an angle for the ten largest themes."""
    from tidemill.operators import themes as H

    t = cut(built_themes(spark, root)[1].withColumn("theme_id", F.col("label")))
    return H.structured(t, H.RuleThemes()).select(F.col("theme_id").alias("label"), "part")


@query(_THEMES + " SELECT label AS id, label || ': ' || signals || ' after ' || label || ': ' || signals AS text, CASE WHEN signals > 0 THEN 'ok' ELSE 'empty' END AS audit FROM th")
def packet_interpretations(spark, root):
    """Themes interpreted in two passes, and audited."""
    from tidemill.operators import themes as H

    packets = cut(built_themes(spark, root)[1].select(F.col("label").alias("id"), "label", F.col("signals").alias("size")))
    p = H.RuleThemes()
    return H.interpretations(packets, p).join(H.audits(packets, p).withColumnRenamed("text", "audit"), "id")
