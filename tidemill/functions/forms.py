"""Unicode forms of text, as Arrow-batched functions where no built-in one exists."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.text import URL, bounded, collapse, loose, plain


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility form; null stays null."""
    return s.map(lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def graphemes(s: pd.Series) -> pd.Series:
    """Grapheme clusters; null and empty texts have none."""
    import regex

    return s.map(lambda t: regex.findall(r"\X", t) if t else [])


@F.pandas_udf(T.StringType())
def demojised(s: pd.Series) -> pd.Series:
    """Text with each emoji as its Unicode name between colons."""
    import regex

    name = lambda m: " :" + unicodedata.name(m.group()[0], "emoji").lower().replace(" ", "_") + ": "
    return s.map(lambda t: regex.sub(r"\p{Extended_Pictographic}(?:\p{M}|‍\p{Extended_Pictographic})*", name, t) if not t.isascii() else t, na_action="ignore")


def normal_text(c: Column) -> Column:
    """The plain form of the compatibility form."""
    return plain(nfkc(F.coalesce(c, F.lit(""))))


def normal_loose(c: Column) -> Column:
    return loose(nfkc(F.coalesce(c, F.lit(""))))


def normal_space(c: Column) -> Column:
    return collapse(nfkc(F.coalesce(c, F.lit(""))))


def embedding_text(text: Column, hashtags: Column, caption: Column) -> Column:
    """What an embedding model is given: text with emoji named, hashtags and the caption's beginning, 1,000 characters at most."""
    return F.substring(F.concat_ws(" ", text, demojised(text), F.array_join(hashtags, " "), F.substring(caption, 1, 280)), 1, 1000)


def hit_terms(c: Column, terms: list[str]) -> Column:
    """The distinct terms of a lexicon that a text holds."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.array_compact(F.array(*[F.when(low.rlike(bounded([t])), F.lit(t)) for t in terms]))


def caption_mode(c: Column, places: list[str]) -> Column:
    """A caption without the words of places and streets, which are no topics."""
    low = F.lower(F.coalesce(c, F.lit("")))
    s = F.regexp_replace(F.regexp_replace(low, URL, " "), "(^|[^a-z0-9])(?:" + "|".join(places) + ")(?=[^a-z0-9]|$)", " ")
    return collapse(F.regexp_replace(s, r"(^|[^a-z0-9])[a-z0-9]+ (?:street|avenue|road|lane|hill|park)(?=[^a-z0-9]|$)", " "))


@F.pandas_udf(T.StringType())
def language_hint(s: pd.Series) -> pd.Series:
    """emoji_only, und, und_non_latin or latin, by the letters of a text."""
    import regex

    def one(t: str | None) -> str:
        letters = regex.findall(r"\p{L}", t or "")
        if not letters:
            return "emoji_only" if regex.search(r"\p{Extended_Pictographic}", t or "") else "und"
        return "latin" if sum(bool(regex.match(r"\p{Latin}", c)) for c in letters) * 2 > len(letters) else "und_non_latin"

    return s.map(one)
