"""One consistent form for text that looks the same but differs in its characters.

A rule table is built once, checked for conflicts and compiled into a longest-match transducer. It has
two kinds of rules: a character's symbols (widths, letter-like forms, spaces, look-alike letters, and
none for invisible characters), and joins of several symbols into one letter (a letter and its accents).
The transducer reads the decomposed characters of a grapheme cluster, turns each into its symbols and
emits the output of the longest join that the symbols make, all in one pass: an accent is joined with
its letter whether that letter was plain, wide or a look-alike, and whatever invisible character stood
between them. Clusters recur, so a cluster's output is remembered.

Defined results: null stays null; empty text stays empty; case, accents, punctuation and emoji as
shown are kept; joiners that shape an emoji or a letter of a joining script are kept.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.skew import lookup
from tidemill.session import cut, spread

# Letters of other scripts that readers cannot tell from a Latin letter.
LOOK_ALIKES = {
    # Cyrillic
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p",
    "ԛ": "q", "ѕ": "s", "ԝ": "w", "х": "x", "у": "y",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O",
    "Р": "P", "Ԛ": "Q", "Ѕ": "S", "Т": "T", "Ԝ": "W", "Х": "X", "У": "Y", "Ү": "Y",
    # Greek
    "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ϲ": "C", "Ε": "E", "Η": "H", "Ι": "I", "Ϳ": "J", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Υ": "Y", "Ζ": "Z",
    # Armenian and Latin extensions
    "օ": "o", "ս": "u", "հ": "h", "Օ": "O", "ɑ": "a", "ɡ": "g", "ǃ": "!",
    # marks that look like ASCII punctuation
    "‐": "-", "‑": "-", "․": ".", "…": "...", "꞉": ":",
}

# Blocks whose compatibility forms look like their plain form: letter-like signs, number forms,
# Latin ligatures, half and full widths, mathematical letters.
COMPATIBLE = ((0x2100, 0x214F), (0x2160, 0x217F), (0xFB00, 0xFB06), (0xFF01, 0xFFEE), (0x1D400, 0x1D7FF))
INVISIBLE = (0x00AD, 0x034F, 0x061C, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), 0x3164, 0xFEFF, 0xFFA0)
ZWJ, ZWNJ, VS16 = "‍", "‌", "️"
_PICTURE = regex.compile(r"\p{Extended_Pictographic}|\p{Emoji_Modifier}|\p{Regional_Indicator}")
_JOINING = regex.compile(r"[\p{Arabic}\p{Syriac}\p{Mongolian}\p{Devanagari}\p{Bengali}\p{Gurmukhi}\p{Gujarati}\p{Oriya}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}\p{Khmer}\p{Tibetan}\p{Myanmar}]")


class Transducer:
    """Longest-match rewriting in one pass. symbols: character to what it is read as (other characters are
    read as they are); joins: sequences of symbols to their output (other symbols are copied)."""

    def __init__(self, symbols: dict[str, str], joins: dict[str, str] | None = None):
        self.symbols = symbols
        self.next: list[dict[str, int]] = [{}]
        self.out: list[str | None] = [None]
        for left, right in sorted((joins or {}).items()):
            if not left:
                raise ValueError("a rule without input")
            at = 0
            for c in left:
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.out.append(None)
                at = self.next[at][c]
            self.out[at] = right

    def __call__(self, s: str) -> str:
        get = self.symbols.get
        read = [x for c in s for x in get(c, c)]
        done, i, n = [], 0, len(read)
        while i < n:
            at, j, best, end = 0, i, read[i], i + 1
            while j < n and (to := self.next[at].get(read[j])) is not None:
                at, j = to, j + 1
                if self.out[at] is not None:
                    best, end = self.out[at], j
            done.append(best)
            i = end
        return "".join(done)


def rules(look_alikes: dict[str, str] | None = None) -> dict[str, str]:
    """The symbols of characters, decomposed on either side, checked for conflicts."""
    found: dict[str, str] = {}

    def add(left: str, right: str) -> None:
        if found.setdefault(left, right) != right:
            raise ValueError(f"two outputs for {left!r}: {found[left]!r} and {right!r}")

    hidden = set(INVISIBLE)  # some have a visible compatibility form that no reader sees
    for first, last in COMPATIBLE:
        for cp in range(first, last + 1):
            c = chr(cp)
            plain = unicodedata.normalize("NFD", unicodedata.normalize("NFKC", c))
            if cp not in hidden and plain != c and unicodedata.normalize("NFD", c) == c and not plain.startswith(" "):
                add(c, plain)
    for cp in range(0x80, 0x3001):
        if unicodedata.category(chr(cp)) == "Zs":
            add(chr(cp), " ")
    for cp in INVISIBLE:
        add(chr(cp), "")
    alike = LOOK_ALIKES if look_alikes is None else look_alikes
    for left, right in alike.items():
        add(left, right)
    for left, right in list(found.items()):  # close chains, so that one pass is enough
        seen = {left}
        while any(c in found for c in right):
            if seen & set(right):
                raise ValueError(f"rules for {left!r} run in a circle")
            seen |= set(right) & set(found)
            right = "".join(found.get(c, c) for c in right)
        found[left] = right
    for left, right in found.items():
        if left.isascii():
            raise ValueError(f"{left!r} is already plain")
        if any(c in found for c in right):
            raise ValueError(f"{left!r} needs a second pass")
    return found


def joins(symbols: dict[str, str]) -> dict[str, str]:
    """Sequences of symbols that make one letter: every canonical composition, checked against the symbols."""
    found: dict[str, str] = {}
    for cp in (*range(0xC0, 0x3100), *range(0xAC00, 0xD7A4), *range(0xF900, 0xFFFE), *range(0x11000, 0x12000)):
        c = chr(cp)
        apart = unicodedata.normalize("NFD", c)
        if len(apart) > 1 and unicodedata.normalize("NFC", apart) == c and not any(x in symbols for x in apart):
            if found.setdefault(apart, c) != c:
                raise ValueError(f"two outputs for {apart!r}")
    for left, right in found.items():
        if unicodedata.normalize("NFD", right) != left:
            raise ValueError(f"{left!r} doesn't come back from {right!r}")
    return found


@lru_cache(maxsize=1)
def _compiled() -> tuple[Transducer, dict[str, str]]:
    symbols = rules()
    return Transducer(symbols, joins(symbols)), {}


_HIDDEN = "[" + "".join(f"\\u{cp:04x}" for cp in INVISIBLE) + "]"
_RUN = re.compile(r"[\x00-\x7f]?[^\x00-\x7f]+")
#: A grapheme cluster with the accents that follow it after invisible characters.
_CLUSTER = regex.compile(rf"\X(?:{_HIDDEN}+\p{{M}}+)*")
_HIDDEN_RUN = regex.compile(_HIDDEN)


def _cluster(c: str) -> str:
    run, _ = _compiled()
    if ZWJ in c and _PICTURE.search(c):  # keep the joiners between two pictures
        c = regex.sub(rf"{ZWJ}(?!\p{{Extended_Pictographic}})|(?<![\p{{Extended_Pictographic}}\p{{Emoji_Modifier}}{VS16}]){ZWJ}", "", c)
        return ZWJ.join(run(unicodedata.normalize("NFD", p)) for p in c.split(ZWJ))
    if (ZWJ in c or ZWNJ in c) and _JOINING.search(c):
        return unicodedata.normalize("NFC", c)
    return run(unicodedata.normalize("NFD", _HIDDEN_RUN.sub("", c)))  # accents come in their one order


def _run(m: re.Match) -> str:
    _, known = _compiled()
    out = []
    for c in _CLUSTER.findall(m.group()):
        if (r := known.get(c)) is None:
            if len(known) > 200_000:
                known.clear()
            r = _cluster(c)
            if len(c) < 32:
                known[c] = r
        out.append(r)
    return "".join(out)


def skeleton(text: str | None) -> str | None:
    """The form in which look-alike texts are equal: look-alike letters become Latin."""
    return text if text is None or text.isascii() else _RUN.sub(_run, text)


_WORD = regex.compile(r"[\p{L}\p{M}]+")
_CYRILLIC = regex.compile(r"\p{Cyrillic}")
_BACK = {LOOK_ALIKES[k]: k for k in "асеорхуАВСЕНКМОРТХУ"}  # those of the Russian alphabet
_BACK_TABLE = str.maketrans(_BACK)


def uniform(text: str | None) -> str | None:
    """The one form of a text, readable: in words that are plainly Cyrillic, shared letters are Cyrillic.

    A word of shared letters only follows the nearest decided word before it, else after it. The
    result depends on the skeleton alone, so texts of equal skeleton have equal uniform text.
    """
    s = skeleton(text)
    if s is None or s.isascii() or not _CYRILLIC.search(s):
        return s
    spans, kinds = [], []
    for m in _WORD.finditer(s):
        w = unicodedata.normalize("NFD", m.group())
        latin = [c for c in w if c.isalpha() and not _CYRILLIC.match(c)]
        fits = all(c in _BACK for c in latin)
        kinds.append(("C" if fits else "L") if len(latin) < sum(map(str.isalpha, w)) else ("?" if fits else "L"))
        spans.append(m.span())
    if "C" not in kinds:
        return s
    last = next(k for k in kinds if k != "?")
    for i, k in enumerate(kinds):
        if k == "?":
            kinds[i] = last
        last = kinds[i]
    out, at = [], 0
    for (a, b), k in zip(spans, kinds):
        out.append(s[at:a])
        out.append(unicodedata.normalize("NFC", unicodedata.normalize("NFD", s[a:b]).translate(_BACK_TABLE)) if k == "C" else s[a:b])
        at = b
    return "".join([*out, s[at:]])


@F.pandas_udf(T.StringType())
def skeleton_udf(s: pd.Series) -> pd.Series:
    return s.map(skeleton, na_action="ignore")


@F.pandas_udf(T.StringType())
def uniform_udf(s: pd.Series) -> pd.Series:
    return s.map(uniform, na_action="ignore")


def uniform_text(df: DataFrame, text: str = "text", into: str = "uniform_text") -> DataFrame:
    """df with the consistent form of column `text` in column `into`."""
    return df.withColumn(into, uniform_udf(F.col(text)))


def _digest(c: Column) -> Column:
    return F.unhex(F.md5(c))


#: Rows of one spelling are paired in blocks of about so many.
BLOCK = 1000


def look_alike_members(df: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """(id, form, spelling, copies, links): every row whose form is written in several spellings.

    form and spelling are digests; form names the class. copies: the rows of this spelling; links: the
    rows of the class written otherwise, each of which looks the same as this row. Rows without id or
    text are in no class; a repeated row counts once. Classes of one spelling are left before any join.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("t")).where("id IS NOT NULL AND t IS NOT NULL")
    rows = cut(spread(rows).select("id", _digest(skeleton_udf("t")).alias("form"), _digest(F.col("t")).alias("spelling")))
    several = rows.groupBy("form").agg(F.min("spelling").alias("lo"), F.max("spelling").alias("hi")).where("lo <> hi").select("form")
    rows = cut(rows.join(several, "form", "left_semi").distinct())
    copies = rows.groupBy("form", "spelling").agg(F.count("*").alias("copies"))
    whole = copies.groupBy("form").agg(F.sum("copies").alias("whole"))
    counted = copies.join(whole, "form").withColumn("links", F.col("whole") - F.col("copies")).drop("whole")
    return cut(lookup(rows, counted, ["form", "spelling"]).select("id", "form", "spelling", "copies", "links"))


def look_alike_pairs(df: DataFrame, id_col: str, text: str = "text") -> DataFrame:
    """(id_a, id_b), id_a < id_b, of rows whose texts differ but have one consistent form.

    The spellings of a class are paired first, in blocks of about BLOCK rows, and the rows of two blocks
    then meet, so a class of any size is spread over many tasks of at most about BLOCK * BLOCK pairs.
    Copies of one spelling are never paired.
    """
    rows = look_alike_members(df, id_col, text)
    parts = F.greatest(F.ceil(F.col("copies") / BLOCK), F.lit(1))
    rows = rows.select("id", "form", "spelling", F.pmod(F.xxhash64("id"), parts).alias("block"))
    blocks = rows.select("form", "spelling", "block").distinct()
    named = lambda t, x: t.select("form", *[F.col(c).alias(c + x) for c in t.columns if c != "form"])
    met = named(blocks, "_a").join(named(blocks, "_b"), "form").where("spelling_a < spelling_b")
    one = met.join(named(rows, "_a"), ["form", "spelling_a", "block_a"])
    both = one.join(named(rows, "_b"), ["form", "spelling_b", "block_b"]).where("id_a <> id_b")
    pairs = both.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    repeated = rows.groupBy("id").count().where("count > 1").take(1)  # an id of several texts could meet another twice
    return pairs.distinct() if repeated else pairs
