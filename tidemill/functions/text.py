"""Text functions as column expressions; boundaries and classes are spelt so that every engine agrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The query engine's default stop words, a closed class of English function words.
STOP_WORDS = (
    "the and for are but not you your all any can had her was one our out has him his how its may new now old "
    "see two way who did get let she too use that this with from they them then than when what which will would "
    "have been were there their about into just like more over some such only also very"
).split()

URL = r"https?://[^\s]+|www\.[^\s]+"


def collapse(c: Column) -> Column:
    """White space collapsed to single spaces and trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s\x{a0}\x{feff}]+", " "))


def plain(c: Column) -> Column:
    """Text without addresses, mentions, hashtags and marks; letters, digits, ' and - stay."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), URL, " ")
    s = F.regexp_replace(s, r"[@#][\p{L}\p{N}_.]+", " ")
    return collapse(F.regexp_replace(s, r"[^\p{L}\p{N}'\s-]", " "))


def tokens(c: Column) -> Column:
    """Lower-case tokens of three or more characters that are neither stop words nor numbers."""
    parts = F.split(F.lower(plain(c)), " ")
    parts = F.transform(parts, lambda t: F.regexp_replace(t, r"^'+|'+$", ""))
    return F.filter(parts, lambda t: (F.length(t) >= 3) & ~t.rlike(r"^[0-9]+$") & ~t.isin(*STOP_WORDS))


def loose(c: Column) -> Column:
    """Lower-case text without addresses; letters, digits, #, @, ' and - stay."""
    s = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), URL, " ")
    return collapse(F.regexp_replace(s, r"[^\p{L}\p{N}#@'\s-]", " "))


def loose_words(c: Column) -> Column:
    """Words of three or more characters of the loose form, function words among them; numbers and mentions are left out."""
    return F.filter(F.split(loose(c), " "), lambda t: (F.length(t) >= 3) & ~t.rlike(r"^[0-9]+$") & ~F.startswith(t, F.lit("@")))


def ngrams(words: Column, n: int) -> Column:
    """The n-grams of an array of words, in order."""
    count = F.greatest(F.size(words) - (n - 1), F.lit(0))
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(F.array().cast("array<string>"))


def mentions(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(?:^|[^A-Za-z0-9_.@])@([A-Za-z0-9_.]+)"), 1))


def hashtags(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"(?:^|[^A-Za-z0-9_&#])#([\p{L}\p{N}_]+)"), 1))


def word_count(c: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[\p{L}\p{N}_']+"), 0))


def letter_count(c: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}]", ""))


def has_any(c: Column, terms: list[str]) -> Column:
    """Whether lower-cased text holds any term between characters that are neither a-z nor 0-9."""
    return F.lower(F.coalesce(c, F.lit(""))).rlike(bounded(terms))


def bounded(terms: list[str]) -> str:
    return "(^|[^a-z0-9])(?:" + "|".join(terms) + ")([^a-z0-9]|$)"


SCRIPTS = {"latin": "Latin", "cyrillic": "Cyrillic", "greek": "Greek", "han": "Han", "hangul": "Hangul", "arabic": "Arabic", "hebrew": "Hebrew"}

#: Code points shown as pictures by default or by a selector, as one character class.
EMOJI = r"[\x{2600}-\x{27BF}\x{2B50}\x{2B55}\x{1F1E6}-\x{1F1FF}\x{1F300}-\x{1FAFF}]"
EMOJI_GLUE = r"[\x{200D}\x{FE0F}\x{1F3FB}-\x{1F3FF}]"
#: A picture with its selectors, skin tones and joined pictures; flags are pairs.
EMOJI_CLUSTER = r"[\x{1F1E6}-\x{1F1FF}]{2}|" + EMOJI + r"[\x{FE0F}\x{1F3FB}-\x{1F3FF}]*(?:\x{200D}" + EMOJI + r"[\x{FE0F}\x{1F3FB}-\x{1F3FF}]*)*"


def emojis(c: Column) -> Column:
    """The emoji of a text in order, joined sequences kept whole."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(EMOJI_CLUSTER), 0)


def without_emoji(c: Column) -> Column:
    return collapse(F.regexp_replace(F.coalesce(c, F.lit("")), EMOJI + "|" + EMOJI_GLUE, " "))


def repeats(values: Column) -> Column:
    """Whether any array element equals the one before it."""
    return F.when(F.size(values) > 1, F.exists(F.sequence(F.lit(1), F.size(values) - 1), lambda i: F.get(values, i) == F.get(values, i - 1))).otherwise(F.lit(False))
