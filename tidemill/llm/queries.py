"""Queries over the test tables for the operators of this package, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.capping import cap_contributors, shortcode
from tidemill.llm.languages import fit, language_segments
from tidemill.llm.leakage import leaking_documents, leaks
from tidemill.llm.packing import fill, token_counts, utilisation
from tidemill.llm.personal_information import find_personal, sanitise
from tidemill.llm.subjects import MAX_SUBJECTS, SHARE, parsed, subject_shares
from tidemill.llm.subjects import fit as fit_subjects
from tidemill.llm.term_counts import term_counts
from tidemill.llm.top_n import top_n
from tidemill.llm.uniform_text import look_alike_members, look_alike_pairs, uniform_text
from tidemill.session import cut
from tidemill.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query()
def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of quotes that look the same and differ in their characters."""
    return look_alike_pairs(table(spark, root, "quotes"), "quote_id").select(F.col("id_a").alias("quote_id_a"), F.col("id_b").alias("quote_id_b"))


@query()
def p1_classes(spark: SparkSession, root: str) -> DataFrame:
    """Every quote that others look like, with its class, the copies of its spelling and its links to other spellings."""
    rows = look_alike_members(table(spark, root, "quotes"), "quote_id")
    return rows.select(F.col("id").alias("quote_id"), F.lower(F.hex("form")).alias("class"), "copies", "links")


@query()
def p1_uniform_text(spark: SparkSession, root: str) -> DataFrame:
    """Every quote in its one consistent form."""
    return uniform_text(table(spark, root, "quotes").select("quote_id", "text")).select("quote_id", "uniform_text")


_SHORTCODE = "nullif(regexp_extract(post_url, '(?i)/(?:p|reel|reels|tv)/([A-Za-z0-9_-]+)', 1), '')"


@query(
    f"""
    WITH q AS (SELECT quote_id, {_SHORTCODE} AS post, coalesce(likes, 0) AS likes FROM quotes),
    r AS (SELECT quote_id, row_number() OVER (PARTITION BY post ORDER BY likes DESC, quote_id) AS rn FROM q WHERE post IS NOT NULL)
    SELECT quote_id FROM r WHERE rn > (SELECT count(*) // 50 FROM quotes)
    """
)
def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Quotes over their post's share of a fiftieth of all quotes."""
    quotes = table(spark, root, "quotes").select("quote_id", "likes", "post_url")
    return cap_contributors(quotes, shortcode(F.col("post_url")), "quote_id", "likes", share=0.02).where("NOT kept").select("quote_id")


@query(
    f"""
    WITH q AS (SELECT quote_id, {_SHORTCODE} AS post, coalesce(likes, 0) AS likes FROM quotes), o AS (SELECT * FROM q WHERE post IS NOT NULL),
    c AS (SELECT post, count(*) AS n FROM o GROUP BY post), k AS (SELECT n, row_number() OVER (ORDER BY n DESC, post) - 1 AS k, (SELECT count(*) FROM o) AS total FROM c UNION ALL SELECT 0, (SELECT count(*) FROM c), (SELECT count(*) FROM o)),
    r AS (SELECT *, total - coalesce(sum(n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM k),
    l AS (SELECT coalesce((SELECT CAST(rest // (50 - k) AS BIGINT) FROM r WHERE k < 50 AND n <= rest // (50 - k) ORDER BY k LIMIT 1), 0) AS level),
    b AS (SELECT quote_id, row_number() OVER (PARTITION BY post ORDER BY likes DESC, quote_id) AS rn FROM o)
    SELECT quote_id FROM b WHERE rn <= (SELECT level FROM l) UNION ALL SELECT quote_id FROM q WHERE post IS NULL
    """
)
def p2_share_of_output(spark: SparkSession, root: str) -> DataFrame:
    """Quotes kept when no post may hold more than a fiftieth of what is kept."""
    quotes = table(spark, root, "quotes").select("quote_id", "likes", "post_url")
    kept = cap_contributors(quotes, shortcode(F.col("post_url")), "quote_id", "likes", share=0.02, basis="output")
    return kept.where("kept").select("quote_id")


_TERMS = r"""
    WITH t AS (SELECT quote_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+')) AS term FROM quotes),
    c AS (SELECT term, count(*) AS occurrences, count(DISTINCT quote_id) AS documents FROM t GROUP BY term),
    m AS (SELECT *, CASE WHEN documents <= 2 THEN 'rare' WHEN documents * 10 > (SELECT count(*) FROM quotes) THEN 'common' END AS mark FROM c)
"""


@query(_TERMS + " SELECT term, mark FROM m WHERE mark IS NOT NULL")
def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """Terms held by too few or too many quotes."""
    return term_counts(table(spark, root, "quotes"), "quote_id").where("mark IS NOT NULL").select("term", "mark")


@query(_TERMS + " SELECT term, occurrences, documents, mark FROM m")
def p3_term_counts(spark: SparkSession, root: str) -> DataFrame:
    """Every term with its occurrences, quotes and mark."""
    return term_counts(table(spark, root, "quotes"), "quote_id")


@query(
    """
    WITH e AS (SELECT id AS theme_id, unnest(representative_quotes) AS q FROM themes WHERE id IS NOT NULL),
    c AS (SELECT theme_id, q.quote_id AS quote_id, max(coalesce(q.likes, 0)) AS likes FROM e WHERE q.quote_id IS NOT NULL GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY theme_id ORDER BY likes DESC, quote_id) AS rn FROM c)
    SELECT theme_id, quote_id FROM r WHERE rn <= 6
    """
)
def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """The six most liked candidate quotes of every theme."""
    themes = table(spark, root, "themes")
    candidates = themes.select(F.col("id").alias("theme_id"), F.explode("representative_quotes").alias("q")).select("theme_id", "q.quote_id", "q.likes")
    return top_n(candidates, "theme_id", "quote_id", "likes", 6).select("theme_id", "quote_id")


@query()
def p7_fill(spark: SparkSession, root: str) -> DataFrame:
    """Every document's place in containers of every capacity."""
    sized = token_counts(table(spark, root, "documents").select("doc_id", "text")).select("doc_id", "tokens")
    return fill(sized, table(spark, root, "containers"), "doc_id", "tokens", "container_kind", "capacity_tokens")


@query()
def p7_utilisation(spark: SparkSession, root: str) -> DataFrame:
    """How many containers of each capacity the documents take, and how full they are."""
    return utilisation(p7_fill(spark, root), table(spark, root, "containers"), "container_kind", "capacity_tokens")


@query()
def p8_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents with the evaluation items they leak."""
    return leaking_documents(table(spark, root, "documents"), table(spark, root, "eval_items"), "doc_id", "item_id")


@query()
def p8_leaks(spark: SparkSession, root: str) -> DataFrame:
    """Documents with the evaluation items they leak, and how much of each."""
    return leaks(table(spark, root, "documents"), table(spark, root, "eval_items"), "doc_id", "item_id")


def _segments(spark: SparkSession, root: str) -> DataFrame:
    quotes = table(spark, root, "quotes").select("quote_id", "text", "lang")
    profiles = fit(table(spark, root, "lang_samples").select("text", "lang"), quotes)
    return language_segments(quotes, profiles, "quote_id", carry=("lang",))


@query()
def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """Segments of the quotes that mix languages or whose label is missing or wrong."""
    wrong = (F.col("segments") > 1) | ~F.col("lang").eqNullSafe(F.col("lang_found"))
    return _segments(spark, root).where(wrong).select("quote_id", "seg_no", F.col("lang_found").alias("lang"))


@query()
def p4_segments(spark: SparkSession, root: str) -> DataFrame:
    """Every language segment of every quote with its confidence."""
    return _segments(spark, root).select("quote_id", "seg_no", "segments", F.col("lang_found").alias("lang"), "confidence", "cosine")


def _personal(spark: SparkSession, root: str) -> DataFrame:
    return find_personal(table(spark, root, "quotes").select("quote_id", "text"), table(spark, root, "given_names"), "quote_id")


@query()
def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Every piece of personal information in the quotes."""
    return _personal(spark, root).select("quote_id", "kind", "start_at")


@query()
def p5_sanitised(spark: SparkSession, root: str) -> DataFrame:
    """The quotes with personal information replaced by placeholders."""
    quotes = table(spark, root, "quotes").select("quote_id", "text")
    return sanitise(quotes, _personal(spark, root), "quote_id").select("quote_id", "clean_text")


def _subject_shares(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    names = sorted(r.subject for r in table(spark, root, "subject_areas").select("subject").dropna().distinct().limit(MAX_SUBJECTS + 1).collect())
    said = cut(parsed(docs, "doc_id"))
    model = fit_subjects(table(spark, root, "subject_samples"), docs, names, said=said)
    return subject_shares(docs, model, "doc_id", said=said)


@query()
def p9_found(spark: SparkSession, root: str) -> DataFrame:
    """Documents with the subjects that at least one in six of their sentences concerns."""
    return _subject_shares(spark, root).where(F.col("share") >= SHARE).select("doc_id", "subject")


@query()
def p9_composition(spark: SparkSession, root: str) -> DataFrame:
    """Documents by subject, one document counting for each of its subjects."""
    about = _subject_shares(spark, root).where(F.col("share") >= SHARE)
    return about.groupBy("subject").agg(F.count("*").alias("documents"), F.round(F.avg("share"), 4).alias("mean_share"))
