"""Fields read from the texts of pages: counts, names, labels and their provenance, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.text import collapse
from tidemill.functions.values import short_number

# Labels and messages of the pages, and the collector's codes for them.
AGE = r"(?i)^[0-9]+[dhwmy]$"
LIKES = r"(?i)^[0-9]+ likes?$"
LABELS = r"(?i)^(reply|see translation)$"
VIEW_ALL = r"(?i)^(view all|hide all)\s+[0-9]+"
LIMITATIONS = [("sorry, this page isn't available", "post_unavailable"), ("try again later", "rate_limited_try_again_later"), ("we restrict certain activity", "rate_limited_activity_restricted"), ("please wait a few minutes", "rate_limited_wait")]
NAVIGATION = [("timeout", "navigation_error:timeout"), ("net::err_internet_disconnected", "navigation_error:offline"), ("net::err", "navigation_error:network"), ("no tab", "navigation_error:tab_gone"), ("cannot access", "navigation_error:forbidden")]


def without_verified(c: Column) -> Column:
    """A name without the badge's label at its end."""
    return F.trim(F.regexp_replace(collapse(c), r"(?i)Verified$", ""))


def is_verified(c: Column) -> Column:
    return collapse(c).rlike(r"(?i)Verified$")


def is_user_name(c: Column) -> Column:
    """Whether a text may be an account's name."""
    s = F.regexp_replace(collapse(c), r"(?i)Verified$", "")
    return F.coalesce((F.length(s) > 0) & (F.length(s) <= 30) & ~s.rlike(r"\s") & ~s.rlike(AGE) & ~s.rlike(LIKES) & ~s.rlike(r"(?i)^(reply|see translation|view all)$"), F.lit(False))


def is_comment_text(c: Column, author: Column) -> Column:
    """Whether a text of a comment's row may be its words rather than a label, an age, a count or its author."""
    a = F.coalesce(author, F.lit(""))
    return F.coalesce((c != "") & (c != a) & (without_verified(c) != a) & ~c.rlike(AGE) & ~c.rlike(LIKES) & ~c.rlike(LABELS) & ~c.rlike(VIEW_ALL), F.lit(False))


def caption_text(c: Column, author: Column) -> Column:
    """A caption without its author's name, badge and age before it."""
    a = F.coalesce(collapse(author), F.lit(""))
    quoted = F.concat(F.lit(r"(?i)^\Q"), a, F.lit(r"\E(?:Verified)?\s*[0-9]+[smhdwmy]\s*"))
    s = collapse(c)
    return F.when(a == "", s).otherwise(F.regexp_replace(s, quoted, F.lit("")))


def short_numbers(c: Column) -> Column:
    """All short numbers above 0 of a text, in order."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?i)(?:^|[^A-Za-z0-9_.])([0-9][0-9,.]*\s?[KMB]?)(?=$|[^A-Za-z0-9_.])"), 1)
    return F.filter(F.transform(found, lambda x: short_number(F.regexp_replace(x, r"\.$", ""))), lambda n: n > 0)


def roughly(a: Column, b: Column) -> Column:
    """Whether a count is within 50 or 8 % of another above 0."""
    return (b > 0) & (F.abs(a - b) <= F.greatest(F.lit(50.0), b * 0.08))


def repost_count(numbers: Column, likes: Column, comments: Column) -> Column:
    """The number after the first two neighbours that are roughly the likes and the comments; else null."""
    at = F.sequence(F.lit(0), F.size(numbers) - 3)
    hit = F.filter(at, lambda i: roughly(F.get(numbers, i), likes) & roughly(F.get(numbers, i + 1), comments))
    return F.when(F.size(numbers) >= 3, F.get(numbers, F.get(hit, F.lit(0)) + 2))


def author_in_description(c: Column) -> Column:
    """The account named in a page's description."""
    found = F.regexp_extract(collapse(c), r"(?i)-\s*([A-Za-z0-9._]{1,30})\s+on\s+[A-Za-z]+:", 1)
    return F.nullif(found, F.lit(""))


def _first(c: Column, pattern: str) -> Column:
    return short_number(F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, 1), F.lit("")))


def displayed_comments(hint: Column, body: Column, description: Column) -> Column:
    """(count, source) of the comments a page says it has: its button's number, else its text's, else its description's."""
    said, meta = _first(body, r"(?i)view all\s+([0-9,.]+[KMB]?)\s+comments?"), _first(description, r"(?i)([0-9,.]+[KMB]?)\s+Comments?")
    source = F.when(hint > 0, "view_all_comments_button").when(said.isNotNull(), "view_all_comments_text").when(meta.isNotNull(), "og_description_mixed_platform")
    return F.struct(F.when(hint > 0, hint.cast("bigint")).otherwise(F.coalesce(said, meta)).alias("count"), source.alias("source"))


def like_count(description: Column, section: Column, spans: Column) -> Column:
    """A post's likes: its description's, else its section's, else those of the first span that says them, else 0."""
    last = F.get(F.filter(F.transform(spans, lambda x: _first(x, r"(?i)^([0-9,.]+[KMB]?)\s*likes?$")), lambda n: n.isNotNull()), F.lit(0))
    return F.coalesce(_first(description, r"(?i)^([0-9,.]+[KMB]?)\s+Likes?"), _first(section, r"(?i)([0-9,.]+[KMB]?)\s*likes?"), last, F.lit(0))


def comment_likes(texts: Column) -> Column:
    """A comment's likes: of the first text of its row that says them, else 0."""
    found = F.transform(texts, lambda x: F.regexp_replace(F.regexp_extract(x, r"(?i)^([0-9][0-9,]*)\s*likes?$", 1), ",", "").try_cast("bigint"))
    return F.coalesce(F.get(F.filter(found, lambda n: n.isNotNull()), F.lit(0)), F.lit(0))


def limitation(text: Column, path: Column, has_article: Column) -> Column:
    """What keeps a page from being read; null if nothing does. The first rule that holds decides."""
    low, at = F.lower(F.coalesce(text, F.lit(""))), F.lower(F.coalesce(path, F.lit("")))
    out = F.when(at.contains("/accounts/login"), "login_wall").when(at.contains("/challenge"), "challenge_required").when(low.contains("log in to") & ~has_article, "login_wall")
    for words, code in LIMITATIONS:
        out = out.when(low.contains(words), code)
    return out


def navigation_error(message: Column) -> Column:
    """A code for a navigation's error message."""
    low = F.lower(F.coalesce(message, F.lit("")))
    out = F.when(low == "", None)
    for words, code in NAVIGATION:
        out = out.when(low.contains(words), code)
    return out.otherwise("navigation_error:other")


def native_id(link: Column) -> Column:
    """The identifier in a comment's permalink; null for other links."""
    return F.nullif(F.regexp_extract(F.coalesce(link, F.lit("")), r"/c/([0-9]+)", 1), F.lit(""))


def absolute(link: Column, base: str) -> Column:
    """A link with its host."""
    return F.when(link.rlike(r"(?i)^https?://"), link).when(F.startswith(link, F.lit("//")), F.concat(F.lit("https:"), link)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(link, "^/+", "")))


def user_name(text: Column, link: Column) -> Column:
    """An account's name from a link's text, else from its path, else unknown."""
    return F.coalesce(F.nullif(collapse(text), F.lit("")), F.nullif(F.regexp_extract(link, r"^/([^/]+)/?$", 1), F.lit("")), F.lit("unknown"))


def profile_url(handle: Column, base: str) -> Column:
    return F.concat(F.lit(base.rstrip("/") + "/"), handle, F.lit("/"))


def first_handle(*sources: Column) -> Column:
    """The first source that isn't empty."""
    return F.coalesce(*[F.nullif(F.trim(s), F.lit("")) for s in sources])


def fnv1a(c: Column) -> Column:
    """The 32-bit FNV-1a hash of a text's code points, as eight hexadecimal digits."""
    codes = F.filter(F.split(F.coalesce(c, F.lit("")), ""), lambda x: x != "")
    h = F.aggregate(codes, F.lit(2166136261).cast("bigint"), lambda a, x: (a.bitwiseXOR(F.ascii(x)) * F.lit(16777619)).bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.lower(F.lpad(F.hex(h), 8, "0"))


def comment_id(post: Column, author: Column, text: Column, posted_at: Column, prefix: str = "c") -> Column:
    """A comment's key by what it says: one author's same words on one post are one comment."""
    whole = F.concat_ws("|", *[F.coalesce(x.cast("string"), F.lit("")) for x in (post, F.lower(author), F.lower(text), posted_at)])
    return F.concat_ws("_", F.lit(prefix), post, F.substring(F.sha2(whole, 256), 1, 16))


def without_formula(c: Column) -> Column:
    """A hook's formula without its comment after a dash and without quotes around it."""
    return F.regexp_replace(F.trim(F.get(F.split(c, " — "), F.lit(0))), "^[\"'“”]+|[\"'“”]+$", "")


def progress(done: Column, all_: Column) -> Column:
    """Percent done, rounded, from 0 to 100."""
    return F.least(F.greatest(F.coalesce(F.round(100 * done / F.nullif(all_, F.lit(0))), F.lit(0.0)), F.lit(0.0)), F.lit(100.0)).cast("int")


def duration(seconds: Column) -> Column:
    """Hours and minutes, as 1h 05m or 12m."""
    m = F.floor(seconds / 60)
    h = F.floor(m / 60)
    return F.when(h > 0, F.format_string("%dh %02dm", h, m % 60)).otherwise(F.format_string("%dm", m))


def preview(c: Column, letters: int = 160) -> Column:
    return F.substring(c, 1, letters)
