"""Documents that hold passages of held-out evaluation items, by a prefix-filtered set join.

Text is reduced to words without regard to case, punctuation, white space, markup, look-alike or
invisible characters. An item counts as leaked where a document holds `window` consecutive words of
it. Every window of an item is the set of its window - SHINGLE + 1 word shingles; as all of them
must be present, one is a sufficient prefix. Shingles are ordered by their rarity among all items, ties
by hash, and a window's prefix is its first in that order, so neighbouring windows mostly share theirs
and a line that opens many items is avoided.

The prefixes are known before documents are read. Tasks get a filter of their hashes (at most
word_arrays.FILTER_BITS bits, whatever the items) and pass on only the places of documents where a prefix may stand,
with the words around it that a window could cover. A place and a window meet on the prefix, which fixes
where in the document the window would begin (positional bound; windows that would begin before the
document or end after it, or in a document shorter than `window` words, are out: length bound), and the
pair stands only if all words of the window are there (exact containment).
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.uniform_text import skeleton
from tidemill.llm.word_arrays import CHUNK, Words, hash_filter, passing, signed
from tidemill.session import cut, small_enough, spread

SHINGLE = 5
#: Up to so many windows (about 200 bytes each) are sent to the tasks that verify; beyond that they are joined.
SENT_WINDOWS = 100_000
#: Parts into which the places of one prefix are dealt when windows are joined.
SALT = 16

_BREAK_TAG = re.compile(r"</?(?:br|p|div|li|ul|ol|h[1-6]|tr|td|th|table|blockquote|hr)\b[^<>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>|<!--.*?-->", re.S)
_LINK = re.compile(r"\]\([^()\s]*\)")
_QUOTES = re.compile("['’‘`´ʼ\"“”„«»]")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")


def words(text: str | None) -> list[str]:
    """The words of a text as compared; null and empty texts have none."""
    if not text:
        return []
    s = skeleton(text)
    if "<" in s:
        s = _TAG.sub("", _BREAK_TAG.sub(" ", s))
    if "&" in s:
        s = skeleton(html.unescape(s))
    if "](" in s:
        s = _LINK.sub(" ", s)
    return _WORD.findall(_QUOTES.sub("", s).lower())


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every shingle; a text is one sentence of w."""
    n = len(w.word) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(w.sentence[:n] == w.sentence[SHINGLE - 1 :])
    with np.errstate(over="ignore"):
        h = np.zeros(len(at), np.uint64)
        for k in range(SHINGLE):
            h = (h ^ w.word[at + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return at, h


def _windows(window: int):
    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for item, text in zip(b["item"], b["text"]):
                said = words(text)
                whole = " ".join(said)
                of = hashlib.blake2b(whole.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
                _, h = shingles(Words([whole]))
                h = signed(h).tolist()
                for i in range(len(said) - window + 1):
                    out.append((item, of, i, " ".join(said[i : i + window]), h[i : i + window - SHINGLE + 1]))
            yield pd.DataFrame(out, columns=["item", "of", "at", "said", "shingles"])

    return f


def prefixes(items: DataFrame, item_type: str, window: int) -> DataFrame:
    """(item, of, at, said, off, h): every window of every item with the place and hash of its prefix."""
    windows = cut(items.mapInPandas(_windows(window), f"item {item_type}, of string, at int, said string, shingles array<bigint>").dropDuplicates(["item", "of", "at"]))
    parts = windows.select("item", "of", "at", F.posexplode("shingles").alias("off", "h"))
    rarity = parts.select("item", "of", (F.col("at") + F.col("off")).alias("place"), "h").distinct().groupBy("h").agg(F.count("*").alias("n"))
    first = parts.join(rarity, "h").groupBy("item", "of", "at").agg(F.min(F.struct("n", "h", "off")).alias("p"))
    return cut(windows.drop("shingles").join(first, ["item", "of", "at"]).select("item", "of", "at", "said", "p.off", "p.h"))


def _places(window: int, sent):
    reach = window - SHINGLE

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = sent.value
        for b in batches:
            said = [" ".join(words(t)) for t in b["text"]]
            sizes = np.cumsum([len(x) for x in said]) // CHUNK
            for k in np.unique(sizes):
                own = np.flatnonzero(sizes == k)
                w = Words([said[i] for i in own])
                at, h = shingles(w)
                use = passing(table, h)
                at, h = at[use], h[use]
                text = w.sentence[at]
                first, end = w.first[text], np.r_[w.first[1:], len(w.word)][text]
                a, z = np.maximum(first, at - reach), np.minimum(end, at + window)
                around = [w.text[x:y] for x, y in zip(w.start[a].tolist(), w.end[z - 1].tolist())]
                doc = b["doc"].to_numpy()[own[w.doc[text]]] if len(at) else b["doc"].to_numpy()[:0]
                yield pd.DataFrame({"doc": doc, "pos": (at - first).astype(np.int32), "h": signed(h), "lead": (at - a).astype(np.int32), "around": pd.Series(around, dtype=object)})

    return f


def leaked_windows(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str = "text", window: int = 10) -> DataFrame:
    """(doc, item, pos, of, at): the window of `item` that begins at its word `at` stands at word `pos` of `doc`.

    Items and documents of fewer than `window` words, and rows without identifier, have none. A repeated
    row counts once; an item of several texts has the windows of each, told apart by `of`.
    """
    if window < SHINGLE:
        raise ValueError(f"a window has at least {SHINGLE} words")
    docs = spread(docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL AND text IS NOT NULL"))
    items = items.select(F.col(item_id).alias("item"), F.col(text).alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    doc_type, item_type = docs.schema["doc"].dataType.simpleString(), items.schema["item"].dataType.simpleString()
    prefix = prefixes(items, item_type, window)
    sent = docs.sparkSession.sparkContext.broadcast(hash_filter(prefix.select("h").distinct()))  # at most FILTER_BITS
    places = docs.mapInPandas(_places(window, sent), f"doc {doc_type}, pos int, h bigint, lead int, around string")
    wanted = prefix.select("item", "of", "at", "off", "h", "said")
    if small_enough(wanted, SENT_WINDOWS):
        met = places.join(F.broadcast(wanted), "h")
    else:
        dealt = places.withColumn("salt", F.pmod(F.xxhash64("doc", "pos"), F.lit(SALT)))
        met = dealt.join(wanted.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALT - 1).cast("bigint")))), ["h", "salt"])
    begin = F.col("lead") - F.col("off")
    held = F.array_join(F.slice(F.split("around", " "), F.greatest(begin, F.lit(0)) + 1, window), " ")
    return met.where((begin >= 0) & (held == F.col("said"))).select("doc", "item", (F.col("pos") - F.col("off")).alias("pos"), "of", "at").distinct()


def leaks(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str = "text", window: int = 10) -> DataFrame:
    """(doc_id, item_id, windows, item_words): each document with each item it leaks.

    windows: distinct windows of the item it holds; item_words: distinct words' places of the item
    covered by them.
    """
    w = leaked_windows(docs, items, doc_id, item_id, text, window).select("doc", "item", "of", "at").distinct()
    covered = w.select("doc", "item", "of", F.explode(F.sequence(F.col("at"), F.col("at") + window - 1)).alias("place"))
    words_held = covered.groupBy("doc", "item").agg(F.count_distinct("of", "place").alias("item_words"))
    counts = w.groupBy("doc", "item").agg(F.count("*").alias("windows"))
    return counts.join(words_held, ["doc", "item"]).select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "windows", "item_words")


def leaking_documents(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str = "text", window: int = 10) -> DataFrame:
    """(doc_id, item_id): each document with each item it leaks."""
    w = leaked_windows(docs, items, doc_id, item_id, text, window)
    return w.select(F.col("doc").alias(doc_id), F.col("item").alias(item_id)).distinct()
