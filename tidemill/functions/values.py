"""Numbers, addresses and times that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POST_PATH = r"(?i)/(p|reel|reels|tv)/([A-Za-z0-9_-]+)"


def short_number(c: Column) -> Column:
    """1,234 or 1.2K, 3M, 2B (a unit word may follow) as a whole number; null where there is none."""
    s = F.regexp_replace(F.lower(F.trim(c)), ",", "")
    number = F.regexp_extract(s, r"^([0-9]+(?:\.[0-9]+)?) ?([kmb])?(?:$|[^a-z0-9.]|[ ])", 1)
    unit = F.regexp_extract(s, r"^([0-9]+(?:\.[0-9]+)?) ?([kmb])?(?:$|[^a-z0-9.]|[ ])", 2)
    times = F.when(unit == "k", 1_000).when(unit == "m", 1_000_000).when(unit == "b", 1_000_000_000).otherwise(1)
    return F.round(F.nullif(number, F.lit("")).try_cast("double") * times).cast("bigint")


def likes(c: Column) -> Column:
    """A like count as text in any spelling; unreadable and missing counts are 0."""
    return F.coalesce(short_number(c), F.lit(0).cast("bigint"))


def shortcode(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, POST_PATH, 2), F.lit(""))


def post_kind(url: Column) -> Column:
    kind = F.lower(F.nullif(F.regexp_extract(url, POST_PATH, 1), F.lit("")))
    return F.when(kind == "reels", "reel").otherwise(kind)


def handle(c: Column) -> Column:
    """An account name from a name, @name or profile address, in lower case; null for post addresses."""
    s = F.lower(F.trim(c))
    s = F.regexp_replace(s, r"^https?://[^/]*/?|^@", "")
    first = F.regexp_extract(s, r"^([a-z0-9._]+)", 1)
    return F.when(first.isin("p", "reel", "reels", "tv", "explore", "stories", ""), None).otherwise(first)


def moment(c: Column) -> Column:
    """Dates as text with any zone suffix as a UTC time; unreadable ones are null."""
    return c.try_cast("timestamp")


def epoch_day(ts: Column) -> Column:
    return F.floor(F.unix_seconds(ts) / 86400)


def roughly_equal(a: Column, b: Column) -> Column:
    """Whether two counts differ by at most 50 or 8 % of the second."""
    return F.abs(a - b) <= F.greatest(F.lit(50.0), b * 0.08)


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole rounded; 0 where whole is 0 or null."""
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))


def seconds(ts: Column) -> Column:
    """Seconds since 1970 of a time without zone, read as UTC whatever the session's zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def day_offset(at_s: Column, days: Column, pattern: str = "yyyy-MM-dd") -> Column:
    """The UTC day (or stamp) some days from a time in seconds."""
    return F.date_format(F.timestamp_seconds(at_s + days * 86400), pattern)
