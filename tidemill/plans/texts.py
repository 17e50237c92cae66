"""Text features of comments: forms, tokens, phrases, scripts, emoji and short texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import text as T
from tidemill.functions.fields import fnv1a
from tidemill.functions.values import short_number
from tidemill.operators.ranking import top_k
from tidemill.plans.base import _NUMBER, _PATTERN, COMMENTS, comments
from tidemill.plans.catalog import query
from tidemill.sources.tables import table

_WS = r"[\s\x{a0}\x{feff}]+"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}', ' ', 'g'))"


_PLAIN = _collapse(r"regexp_replace(regexp_replace(regexp_replace(text, 'https?://[^\s]+|www\.[^\s]+', ' ', 'g'), '[@#][\p{L}\p{N}_.]+', ' ', 'g'), '[^\p{L}\p{N}''\s-]', ' ', 'g')")
_STOPS = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
TOKENS = rf"""
    , k AS (SELECT *, list_filter(list_transform(string_split(lower({_PLAIN}), ' '), lambda t: regexp_replace(t, '^''+|''+$', '', 'g')),
        lambda t: length(t) >= 3 AND NOT regexp_matches(t, '^[0-9]+$') AND t NOT IN ({_STOPS})) AS tokens FROM c)
"""


@query(COMMENTS + f" SELECT comment_id, length({_collapse('text')}) AS collapsed, length({_PLAIN}) AS plain, length(text) AS raw FROM c")
def normalize_text_lengths(spark, root):
    """Lengths of each comment as captured, with white space collapsed, and in plain form."""
    c = comments(spark, root)
    return c.select("comment_id", F.length(T.collapse(F.col("text"))).alias("collapsed"), F.length(T.plain(F.col("text"))).alias("plain"), F.length("text").alias("raw"))


@query(COMMENTS + TOKENS + ", t AS (SELECT unnest(list_distinct(tokens)) AS term FROM k) SELECT term, count(*) AS documents FROM t GROUP BY term")
def token_document_frequency(spark, root):
    """In how many comments each token stands."""
    t = comments(spark, root).select(F.explode(F.array_distinct(T.tokens(F.col("text")))).alias("term"))
    return t.groupBy("term").agg(F.count("*").alias("documents"))


@query(
    COMMENTS
    + TOKENS
    + """
    , g AS (SELECT unnest(list_concat([tokens[i] || ' ' || tokens[i + 1] for i in range(1, len(tokens))], [tokens[i] || ' ' || tokens[i + 1] || ' ' || tokens[i + 2] for i in range(1, len(tokens) - 1)])) AS phrase FROM k),
    n AS (SELECT phrase, count(*) AS n FROM g GROUP BY phrase HAVING count(*) >= 3)
    SELECT phrase, n FROM n
    """
)
def phrase_counts(spark, root):
    """Two- and three-word phrases said at least three times."""
    words = T.tokens(F.col("text"))
    g = comments(spark, root).select(words.alias("w")).select(F.explode(F.concat(T.ngrams(F.col("w"), 2), T.ngrams(F.col("w"), 3))).alias("phrase"))
    return g.groupBy("phrase").agg(F.count("*").alias("n")).where("n >= 3")


@query(
    COMMENTS
    + TOKENS
    + """
    , g AS (SELECT post, unnest([tokens[i] || ' ' || tokens[i + 1] for i in range(1, len(tokens))]) AS phrase FROM k),
    n AS (SELECT post, phrase, count(*) AS n FROM g GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY post ORDER BY n DESC, phrase) AS rank FROM n)
    SELECT * FROM r WHERE rank <= 3
    """
)
def top_phrases_per_post(spark, root):
    """The three most frequent two-word phrases under every post."""
    g = comments(spark, root).select("post", T.tokens(F.col("text")).alias("w")).select("post", F.explode(T.ngrams(F.col("w"), 2)).alias("phrase"))
    n = g.groupBy("post", "phrase").agg(F.count("*").alias("n"))
    return top_k(n, ["post"], [F.desc("n"), F.asc("phrase")], 3)


_MENTIONS = r"list_distinct(regexp_extract_all(lower(text), '(?:^|[^A-Za-z0-9_.@])@([A-Za-z0-9_.]+)', 1))"
_HASHTAGS = r"list_distinct(regexp_extract_all(lower(text), '(?:^|[^A-Za-z0-9_&#])#([\p{L}\p{N}_]+)', 1))"


@query(
    COMMENTS
    + f"""
    , m AS (SELECT post, 'mention' AS kind, unnest({_MENTIONS}) AS value FROM c UNION ALL SELECT post, 'hashtag', unnest({_HASHTAGS}) FROM c)
    SELECT kind, value, count(*) AS comments, count(DISTINCT post) AS posts FROM m GROUP BY ALL
    """
)
def mentions_hashtags(spark, root):
    """Every mention and hashtag with its comments and posts."""
    c = comments(spark, root)
    one = lambda kind, f: c.select("post", F.lit(kind).alias("kind"), F.explode(f(F.col("text"))).alias("value"))
    return one("mention", T.mentions).unionByName(one("hashtag", T.hashtags)).groupBy("kind", "value").agg(F.count("*").alias("comments"), F.count_distinct("post").alias("posts"))


@query(
    COMMENTS
    + "SELECT "
    + ", ".join(rf"count(*) FILTER (regexp_matches(text, '\p{{{s}}}')) AS {k}" for k, s in T.SCRIPTS.items())
    + r", count(*) FILTER (regexp_matches(text, '[^\x00-\x7f]')) AS not_ascii FROM c"
)
def script_cues(spark, root):
    """How many comments have letters of each script."""
    c = comments(spark, root)
    return c.agg(*[F.count_if(F.col("text").rlike(rf"\p{{Is{s}}}")).alias(k) for k, s in T.SCRIPTS.items()], F.count_if(F.col("text").rlike(r"[^\x00-\x7f]")).alias("not_ascii"))


#: A word of praise and nothing else makes a comment generic.
PRAISE = ["cute", "adorable", "beautiful", "lovely", "sweet", "perfect", "amazing", "love", "omg", "aww+", "wow", "gorgeous"]
_WORDS = r"len(regexp_extract_all(text, '[\p{L}\p{N}_'']+'))"
_LETTERS = r"length(regexp_replace(text, '[^\p{L}]', '', 'g'))"
_GENERIC = f"""CASE WHEN trim(text) = '' OR {_LETTERS} = 0 THEN true WHEN {_WORDS} <= 3 AND regexp_matches(lower(text), '{T.bounded(PRAISE)}') THEN likes < 10 ELSE false END"""


def generic_short(text, likes):
    """Nothing but pictures, digits and marks, or at most three words with praise and few likes."""
    return F.when((F.trim(text) == "") | (T.letter_count(text) == 0), True).when((T.word_count(text) <= 3) & T.has_any(text, PRAISE), likes < 10).otherwise(False)


@query(COMMENTS + f" SELECT comment_id, {_GENERIC} AS generic, {_WORDS} AS words, {_LETTERS} AS letters FROM c")
def short_text_filter(spark, root):
    """Which comments are too short and generic to tell anything."""
    t = F.col("text")
    return comments(spark, root).select("comment_id", generic_short(t, F.col("likes")).alias("generic"), T.word_count(t).alias("words"), T.letter_count(t).alias("letters"))


@query(
    f"""
    SELECT comment_id, comment_likes, count(*) AS captures, CAST(round(TRY_CAST(nullif(regexp_extract({_NUMBER}, {_PATTERN}, 1), '') AS DOUBLE) * CASE regexp_extract({_NUMBER}, {_PATTERN}, 2) WHEN 'k' THEN 1000 WHEN 'm' THEN 1000000 WHEN 'b' THEN 1000000000 ELSE 1 END) AS BIGINT) AS likes
    FROM raw_comments GROUP BY ALL
    """
)
def parse_short_numbers(spark, root):
    """Like counts in any spelling as numbers."""
    r = table(spark, root, "raw_comments").groupBy("comment_id", "comment_likes").agg(F.count("*").alias("captures"))
    return r.select("comment_id", "comment_likes", "captures", short_number(F.col("comment_likes")).alias("likes"))


_EMOJI = f", em AS (SELECT post, text, regexp_extract_all(text, '{T.EMOJI_CLUSTER}') AS e, trim(regexp_replace(regexp_replace(text, '{T.EMOJI}|{T.EMOJI_GLUE}', ' ', 'g'), '{_WS}', ' ', 'g')) AS bare FROM c)"


@query(
    COMMENTS
    + _EMOJI
    + """, g AS (SELECT post, count(*) FILTER (len(e) > 0) AS with_emoji, count(*) FILTER (len(e) > 0 AND bare = '') AS only_emoji, count(*) FILTER (len(e) > 0 AND bare <> '') AS mixed, count(*) FILTER (len(e) > 1 AND len(list_filter(range(2, len(e) + 1), lambda i: e[i] = e[i - 1])) > 0) AS repeated FROM em GROUP BY post),
    n AS (SELECT post, emoji, count(*) AS n FROM (SELECT post, unnest(e) AS emoji FROM em) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY post ORDER BY n DESC, emoji) AS rank FROM n), t AS (SELECT post, list(emoji ORDER BY rank) AS top, list(n ORDER BY rank) AS top_n FROM r WHERE rank <= 5 GROUP BY post)
    SELECT g.*, t.top, t.top_n FROM g LEFT JOIN t ON g.post = t.post"""
)
def emoji_summary_per_post(spark, root):
    """Per post: comments with emoji, of emoji only, with repeats, and the most frequent emoji."""
    c = comments(spark, root).select("post", "text", T.emojis(F.col("text")).alias("e"))
    has, only = F.size("e") > 0, (F.size("e") > 0) & (T.without_emoji(F.col("text")) == "")
    sums = c.groupBy("post").agg(F.count_if(has).alias("with_emoji"), F.count_if(only).alias("only_emoji"), F.count_if(has & ~only).alias("mixed"), F.count_if(T.repeats(F.col("e"))).alias("repeated"))
    n = c.select("post", F.explode("e").alias("emoji")).groupBy("post", "emoji").agg(F.count("*").alias("n"))
    best = top_k(n, ["post"], [F.desc("n"), F.asc("emoji")], 5).groupBy("post").agg(F.sort_array(F.collect_list(F.struct("rank", "emoji", "n"))).alias("k"))
    best = best.select("post", F.transform("k", lambda x: x["emoji"]).alias("top"), F.transform("k", lambda x: x["n"]).alias("top_n"))
    return sums.join(best, "post", "left")


@query(COMMENTS + _EMOJI + ", d AS (SELECT list_sort(list_distinct(e)) AS e FROM em WHERE len(list_distinct(e)) > 1), p2 AS (SELECT unnest(flatten(list_transform(range(1, len(e)), lambda i: list_transform(range(i + 1, len(e) + 1), lambda j: {'first': e[i], 'second': e[j]})))) AS x FROM d) SELECT x.first AS first, x.second AS second, count(*) AS comments FROM p2 GROUP BY ALL")
def emoji_cooccurrence(spark, root):
    """Unordered pairs of different emoji in one comment."""
    e = comments(spark, root).select(F.array_sort(F.array_distinct(T.emojis(F.col("text")))).alias("e")).where("size(e) > 1")
    pairs = F.expr("flatten(transform(e, (x, i) -> transform(slice(e, i + 2, size(e)), y -> struct(x as first, y as second))))")
    return e.select(F.explode(pairs).alias("p")).groupBy("p.first", "p.second").agg(F.count("*").alias("comments"))


@query(
    COMMENTS
    + TOKENS
    + """, g AS (SELECT unnest(list_concat(tokens, [tokens[i] || ' ' || tokens[i + 1] for i in range(1, len(tokens))], [tokens[i] || ' ' || tokens[i + 1] || ' ' || tokens[i + 2] for i in range(1, len(tokens) - 1)])) AS phrase FROM k), n AS (SELECT phrase, count(*) AS n FROM g GROUP BY phrase HAVING count(*) >= 5)
    SELECT phrase, n FROM n ORDER BY n DESC, phrase LIMIT 4000"""
)
def vocabulary_phrases(spark, root):
    """The 4,000 most frequent one- to three-word phrases without stop words (a model's vocabulary)."""
    g = comments(spark, root).select(T.tokens(F.col("text")).alias("w")).select(F.explode(F.concat("w", T.ngrams(F.col("w"), 2), T.ngrams(F.col("w"), 3))).alias("phrase"))
    return g.groupBy("phrase").agg(F.count("*").alias("n")).where("n >= 5").orderBy(F.desc("n"), F.asc("phrase")).limit(4000)


@query("SELECT comment_id, substr(sha1(comment_id), 1, 16) AS feature_id, format('{:08x}', list_reduce(list_prepend(CAST(2166136261 AS HUGEINT), list_transform(string_split(comment_id, ''), lambda x: CAST(unicode(x) AS HUGEINT))), lambda h, x: (xor(h, x) * 16777619) & 4294967295)) AS hash FROM (SELECT DISTINCT comment_id FROM raw_comments WHERE comment_id IS NOT NULL)")
def comment_hashes(spark, root):
    """Short identifiers of comments: the beginning of a digest, and a 32-bit hash."""
    ids = table(spark, root, "raw_comments").select("comment_id").where("comment_id IS NOT NULL").distinct()
    return ids.select("comment_id", F.substring(F.sha1("comment_id"), 1, 16).alias("feature_id"), fnv1a(F.col("comment_id")).alias("hash"))
