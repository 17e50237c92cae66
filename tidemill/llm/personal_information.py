"""Personal information inside free text: found by what corpus co-occurrence discloses, and replaced.

Grammars propose candidate spans: mail addresses, number-like strings, number-and-street phrases and
pairs of name-like words. Which of them are personal is decided by how strongly the terms in and around
them reveal a protected entity, in bits over the whole collection:

- Numbers and names: every term beside a candidate or of its shape is counted over all candidates with
  the kind of those whose form alone is telling (seeds). A term's disclosure of a kind is how many bits
  it adds to the log-odds of that kind; a candidate discloses the sum over its terms and the kind's own
  log-odds (where these are negative).
- Mail addresses and streets: the terms are those inside the span (pieces and hosts of addresses, words
  of street names, a name's word with its street type). A term's disclosure is the log-odds of its
  standing inside such spans of telling form rather than anywhere else; a candidate discloses as much
  as its most revealing term.

Spans beyond their threshold are generalised to a placeholder of their kind. Names grow from a list of
given names: words that mostly follow known given names are family names, words that mostly precede
known family names are given names, by the same measure.

Texts are parsed once, for candidates and for the uses of words together. Pairs of names without
capitals, which can't be proposed before names are known, are then looked for only in texts where a
bounded filter of the names' hashes finds both words; candidates are joined with the names exactly.

Defined results: null and empty texts hold nothing. Text outside the found spans is untouched, and
positions count code points of the stored text from 1, whatever look-alike or invisible characters
it has.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.uniform_text import rules
from tidemill.llm.word_arrays import Words, hash_filter, passing, signed
from tidemill.operators.skew import lookup
from tidemill.session import cut, spread

KINDS = ("email", "phone", "id_number", "address", "person")
#: Bits of disclosure from which a candidate of each class is generalised; for mail and place the
#: log-odds of a term that stands in such spans in three of ten uses.
THRESHOLD = {"number": 1.0, "name": 2.0, "mail": -1.23, "place": -1.23}
#: Uses of prior doubt: a term seen so few times discloses little.
SMOOTHING, INNER_SMOOTHING = 2.0, 0.5
#: A word is taken as a name of a person if so much of its use is in such names, and it is so used at
#: least so often.
NAME_SHARE, NAME_USES = 0.3, 2
NAME_ROUNDS = 2


@lru_cache(maxsize=1)
def _table() -> dict[str, str]:
    return rules()


@lru_cache(maxsize=1 << 16)
def _plain(c: str) -> str:
    table = _table()
    return unicodedata.normalize("NFC", "".join(table.get(x, x) for x in unicodedata.normalize("NFD", c)))


def aligned(text: str) -> tuple[str, list[int] | None]:
    """The text in plain characters and, unless they are the same, each one's place in the text."""
    if text.isascii():
        return text, None
    out, at = [], []
    for i, c in enumerate(text):
        if c < "\x80":
            plain = c
        elif unicodedata.combining(c) and out:
            whole = unicodedata.normalize("NFC", out[-1] + c)
            if len(whole) == 1:
                out[-1] = whole
                continue
            plain = c
        else:
            plain = _plain(c)
        for x in plain:
            out.append(x)
            at.append(i)
    return "".join(out), at


_MAIL = regex.compile(
    r"""(?xi) (?<![\w@.+-])
    (?: [a-z0-9] [\w.+-]* (?: @ | \s@\s ) [a-z0-9-]+ (?:\.[a-z0-9-]+)* \. [a-z]{2,}
      | [a-z0-9] [\w.+-]* (?:\ dot\ [\w+-]+)* (?: \s? [(\[{<] \s? at \s? [)\]}>] \s? | @ ) [a-z0-9-]+ (?: (?: \ dot\  | \s? [(\[{<] \s? dot \s? [)\]}>] \s? | \. ) [a-z0-9-]+ )+
      | [a-z0-9] [\w.+-]* (?:\ dot\ [\w+-]+)* \ at\  [a-z0-9-]+ (?: \ dot\  [a-z0-9-]+ )+
    ) (?![\w@])"""
)
_DOTTED = regex.compile(r"(?i)@|\bdot\b|[(\[{<]\s?(?:at|dot)\s?[)\]}>]")
_NUMBER = regex.compile(
    r"""(?x) (?<![\w@\#.,/$€£]) (?: \+ \s? | \( )? (?: [A-Za-z]{1,2} (?=\d) )? \d+
    (?: (?: \)[ -]? | [ ]\( | [ ./-] )? (?: \d+ | [A-Za-z]{1,2} (?= [ -]? \d) (?<= [\d -][A-Za-z] | [\d -][A-Za-z]{2} ) ) )*
    (?: [ -]? [A-Z] (?!\w) | [a-z] (?!\w) )?"""
)
_OTHER_SHAPE = regex.compile(r"9{4}-9{2}-9{2}|9{1,2}/9{4}|9{1,2}[./]9{1,2}[./]9{2,4}|9{13,}|9{1,2}(?:-9{1,2}){2}|9{4}-9{3}")
_PHONE_SHAPE = regex.compile(r"\+.*|\(9{3,5}\).*|(?:9[ .-])?9{3}([ .-])9{3}\1?[ .-]9{4}|99([ .-])99\2(?:99\2)99\2?99|9{3}([ -])99\3?[ -]99[ -]99")
_ID_SHAPE = regex.compile(r"9{3}([ -])99\1?[ -]9{4}|A9{7}A|9{8}[ -]?A|A9{8}A?|99([ -]?)AA\2?[ -]?9{5}|A9{3}-9{4}-9{4}")

_NAMEWORD = r"\p{L}[\p{L}'’-]*"
_EN_TYPE = r"(?:(?:street|avenue|road|lane|terrace|boulevard|court|drive|way|row|close|square|place|crescent|parkway|highway)\b|(?:st|ave|rd|ln|blvd|ct|dr)\b(?:\.(?=,|\s\#|\s\p{Ll}|\s?$))?)"
_FR_TYPE = r"(?:rue|avenue|boulevard|bd|chemin|impasse|quai|allée|place|route|cours|passage|square)"
_ES_TYPE = r"(?:calle|c/|avenida|avda\.?|plaza|paseo|camino|carretera|ronda|travesía|rua|via|viale|piazza|corso|largo|praça|travessa)"
_DE_END = r"(?:straße|strasse|str\.|weg|gasse|platz|allee|ring|ufer|damm|hof|steig|pfad|markt|laan|straat|plein|gracht|kade|dijk)"
_UNIT = r"(?:,?\s(?:apt|unit|suite|flat|appt|app)\.?\s\w{1,5}\b|\s\#\d+\w?|,\s\d{1,2}\s?[ºª°]\s?\w{1,3}\b|,\s(?:bajo|ático|entresuelo|izq|dcha)\b)?"
_PLACES = [
    regex.compile(rf"(?i)(?<![\w$€£#.,/-])\d{{1,5}}\s?[a-d]?\s(?P<name>(?:{_NAMEWORD}\s){{1,4}}?)(?P<type>{_EN_TYPE}){_UNIT}"),
    regex.compile(rf"(?i)(?<![\w$€£#.,/-])\d{{1,5}}(?:\s(?:bis|ter|quater))?,?\s(?P<type>{_FR_TYPE})\s(?P<name>(?:(?:de|du|des|la|le|les|l'|d')\s?)*{_NAMEWORD}(?:[\s-](?-i:\p{{Lu}}){_NAMEWORD})*){_UNIT}"),
    regex.compile(rf"(?i)(?<![\w/])(?P<type>{_ES_TYPE})\s(?P<name>{_NAMEWORD}(?:\s{_NAMEWORD}){{0,4}}?),?\s(?:nº|n°|núm\.?|no\.)?\s?\d{{1,5}}\b{_UNIT}"),
    regex.compile(rf"(?i)(?<![\w-])(?P<name>(?:(?-i:\p{{Lu}})[\p{{L}}-]*\s)?[\p{{L}}-]{{3,}}?)(?P<type>{_DE_END})\s\d{{1,4}}(?:\s?[a-e](?!\w))?\b"),
    regex.compile(r"(?<![\w-])(?P<type>(?:Am|An der|Im|In der|Auf der|Auf dem|Zum|Zur|Unter den|Beim|An den|Hinter der))\s(?P<name>\p{Lu}[\p{L}-]+(?:\s\p{Lu}[\p{L}-]+)?)\s\d{1,4}(?:\s?[a-e](?!\w))?\b"),
]
#: What every place has besides a digit; a text without it is not searched for places.
_MAY_PLACE = regex.compile(rf"(?i)\b(?:street|st|avenue|ave|road|rd|lane|ln|terrace|blvd|boulevard|court|ct|drive|dr|way|row|close|square|place|crescent|parkway|highway|{_FR_TYPE})\b|\b{_ES_TYPE}\s|{_DE_END}\s\d|\b(?:am|an der|im|in der|auf der|auf dem|zum|zur|unter den|beim|an den|hinter der)\s\p{{L}}")
_PERSON = regex.compile(r"(?<![\p{L}\p{M}\p{N}@#_.'’-])(?P<a>\p{L}[\p{L}\p{M}'’]+)\s(?:\p{L}\.?\s)?(?P<b>\p{L}[\p{L}\p{M}'’]+(?:-\p{L}[\p{L}\p{M}]+)?)(?![\p{L}\p{M}\p{N}@_])")
_CAPITALS = regex.compile(r"(?<![\p{L}\p{M}\p{N}@#_.'’-])(?P<a>\p{Lu}[\p{L}\p{M}'’]+)\s(?:\p{L}\.?\s)?(?P<b>\p{Lu}[\p{L}\p{M}'’]+(?:-\p{L}[\p{L}\p{M}]+)?)(?![\p{L}\p{M}\p{N}@_])")
_NAME = regex.compile(r"\p{L}[\p{L}\p{M}'’]*(?:-\p{L}[\p{L}\p{M}]+)?")
_DIGIT = re.compile(r"\d")
_DIGITS = re.compile(r"(?:\d\D{0,6}){7}")
_BREAK = regex.compile(r"[.!?…\n](?=\s|$)")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*(?:['’-]\p{L}[\p{L}\p{M}]*)*|\p{N}+")


class Sentences:
    """The words of a text and where its sentences end, to find the terms beside a span."""

    def __init__(self, text: str):
        found = list(_WORD.finditer(text))
        self.words = [m.group().lower() for m in found]
        self.starts, self.ends = [m.start() for m in found], [m.end() for m in found]
        self.breaks = [m.end() for m in _BREAK.finditer(text)]

    def around(self, start: int, end: int) -> list[str]:
        """The words and runs of words next to a span within its sentence."""
        k = bisect_right(self.breaks, start)
        low = self.breaks[k - 1] if k else 0
        k = bisect_left(self.breaks, end + 1)
        high = self.breaks[k] if k < len(self.breaks) else 1 << 62
        z = bisect_right(self.ends, start)
        a = max(bisect_left(self.starts, low), z - 3)
        left = self.words[a:z]
        a = bisect_left(self.starts, end)
        right = self.words[a : min(a + 3, bisect_left(self.starts, high))]
        out = []
        if left:
            out += [f"<{n} " + " ".join(left[-n:]) for n in (1, 2, 3)]
        if right:
            out += [f">{n} " + " ".join(right[:n]) for n in (1, 2, 3)]
        return out


def _number_candidates(text: str, taken: list[tuple[int, int]], beside: Sentences):
    for m in _NUMBER.finditer(text):
        s, start = m.group(), m.start()
        if s.startswith("(") and ")" not in s:
            s, start = s[1:], start + 1
        if sum(c.isdigit() for c in s) < 7 or any(a < m.end() and start < b for a, b in taken):
            continue
        shape = regex.sub(r"\p{L}", "A", regex.sub(r"\d", "9", s))
        seed = None
        if _ID_SHAPE.fullmatch(shape):
            seed = "id_number"
        elif _OTHER_SHAPE.fullmatch(shape):
            seed = "other"
        elif _PHONE_SHAPE.fullmatch(shape) or (s.startswith("00") and 11 <= sum(map(str.isdigit, s)) <= 15):
            seed = "phone"
        yield start, start + len(s), "number", seed, ["shape " + shape, *beside.around(start, start + len(s))], None, None


def _place_candidates(text: str, taken: list[tuple[int, int]]):
    if not _DIGIT.search(text) or not _MAY_PLACE.search(text):
        return
    for k, p in enumerate(_PLACES):
        for m in p.finditer(text):
            a, b = m.span()
            if any(x < b and a < y for x, y in taken):
                continue
            said, kind = _WORD.findall(m.group("name")), m.group("type")
            names = [w.lower() for w in said if len(w) > 2] or [kind.lower()]
            seed = "address" if any(w[0].isupper() for w in said or [kind]) else None
            terms = ["in " + w for w in names]
            if said and k < 3:  # a street type that is a word of its own
                one, two = (said[-1], kind) if k == 0 else (kind, said[0])
                if one[0].isupper() and two[0].isupper():
                    terms.append(f"pair {one.lower()} {two.rstrip('.').lower()}")
            taken.append((a, b))
            yield a, b, "place", seed, terms, None, None


_AT = regex.compile(r"(?i)\s?[(\[{<]\s?at\s?[)\]}>]\s?|\sat\s|\s@\s")
_DOT = regex.compile(r"(?i)\s?[(\[{<]\s?dot\s?[)\]}>]\s?|\sdot\s")


def mails(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _MAIL.finditer(text)] if _DOTTED.search(text) else []


def _mail_candidates(text: str):
    for a, b in mails(text):
        s = _DOT.sub(".", _AT.sub("@", text[a:b])).lower()
        host = s.rpartition("@")[2]
        terms = ["host " + host, *("in " + w for w in _WORD.findall(s) if len(w) > 2)]
        yield a, b, "mail", "email" if s == text[a:b].lower() else None, terms, None, None


def _pairs(pattern: regex.Pattern, text: str, taken: list[tuple[int, int]]):
    """Every pair of neighbouring words that may be a given and a family name."""
    at = 0
    while m := pattern.search(text, at):
        at = m.end("a")  # the second word may begin the next pair
        if not any(a < m.end() and m.start() < b for a, b in taken):
            yield m


def candidates(text: str) -> list[tuple]:
    """(start, end, class, seed kind, terms, first word, second word) of a text in plain characters."""
    found = list(_mail_candidates(text))
    taken = [(a, b) for a, b, *_ in found]
    found += list(_place_candidates(text, taken))
    numbers, capitals = _DIGITS.search(text), _CAPITALS.search(text)
    if numbers or capitals:
        beside = Sentences(text)
        if numbers:
            more = list(_number_candidates(text, taken, beside))
            found += more
            taken += [(a, b) for a, b, *_ in more]
        if capitals:
            for m in _pairs(_CAPITALS, text, taken):
                found.append((m.start(), m.end(), "name", None, beside.around(m.start(), m.end()), m["a"].lower(), m["b"].lower()))
    return found


_FOUND = "start int, end int, class string, seed string, terms array<string>, a string, b string"
_COLUMNS = [c.split()[0] for c in _FOUND.split(", ")]


def _stored(found: list[tuple], at: list[int] | None) -> list[tuple]:
    """Candidates with places in the stored text."""
    return found if at is None else [(at[a], at[z - 1] + 1, *rest) for a, z, *rest in found]


def parse(df: DataFrame, record_id: str, text: str) -> DataFrame:
    """Candidates (id, start, end, class, seed, terms, a, b), and rows of class "use": how often (n) a word (a) stands outside mail."""
    rows = df.select(F.col(record_id).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    kind = rows.schema["id"].dataType.simpleString()

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()

        def counted() -> pd.DataFrame:
            out = pd.DataFrame({c: None for c in ("id", *_COLUMNS)}, index=range(len(words)))
            out = out.assign(a=list(words), n=list(words.values()))
            out["class"] = "use"
            words.clear()
            return out

        for b in batches:
            ids, out = [], []
            for rid, t in zip(b["id"], b["text"]):
                plain, at = aligned(t)
                found = candidates(plain)
                if found:
                    ids += [rid] * len(found)
                    out += _stored(found, at)
                    for x in sorted(found, reverse=True):
                        if x[2] == "mail":
                            plain = plain[: x[0]] + "@" + plain[x[1] :]
                words.update(_WORD.findall(plain.lower()))
            done = pd.DataFrame(out, columns=_COLUMNS)
            done.insert(0, "id", ids)
            yield done.assign(n=0)
            if len(words) > 500_000:
                yield counted()
        yield counted()

    return spread(rows).mapInPandas(f, f"id {kind}, {_FOUND}, n bigint")


def learn_names(pairs: DataFrame, total: DataFrame, given_names: DataFrame, given_name: str) -> tuple[DataFrame, DataFrame]:
    """(given, family): lower-case words `w` that are used as names. pairs: (a, b, n), total: (w, total)."""
    given = cut(given_names.select(F.lower(F.trim(given_name)).alias("w")).where("w <> ''").distinct())
    family = None
    names = lambda used: used.where(F.col("n") >= NAME_USES).join(total, "w").where(F.col("n") >= NAME_SHARE * F.col("total")).select("w")
    for _ in range(NAME_ROUNDS):
        family = cut(names(pairs.join(given.withColumnRenamed("w", "a"), "a", "left_semi").groupBy(F.col("b").alias("w")).agg(F.sum("n").alias("n"))))
        more = names(pairs.join(family.withColumnRenamed("w", "b"), "b", "left_semi").groupBy(F.col("a").alias("w")).agg(F.sum("n").alias("n")))
        given = cut(given.unionByName(more).distinct())
    return given, family


def _hashes(words: DataFrame) -> DataFrame:
    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"h": signed(Words(b["w"].tolist()).word)})

    return words.mapInPandas(f, "h bigint")


def uncapitalised(df: DataFrame, record_id: str, text: str, given: DataFrame, family: DataFrame) -> DataFrame:
    """Candidates for names in which a word has no capital, among them all whose words are names."""
    rows = df.select(F.col(record_id).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    sent = df.sparkSession.sparkContext.broadcast((hash_filter(_hashes(given)), hash_filter(_hashes(family))))

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g, h = sent.value
        for b in batches:
            texts = [aligned(t) for t in b["text"]]
            w = Words([" ".join(_NAME.findall(t.lower())) for t, _ in texts])
            is_a, is_b = passing(g, w.word), passing(h, w.word)
            near = np.zeros(len(is_a), bool)
            for k in (1, 2):  # an initial may stand between
                near[:-k] |= is_a[:-k] & is_b[k:] & (w.sentence[k:] == w.sentence[:-k]) if len(near) > k else False
            ids, out = [], []
            for i in np.unique(w.doc[w.sentence[near]]).tolist():
                t, at = texts[i]
                pairs = [m for m in _pairs(_PERSON, t, []) if not (m["a"][0].isupper() and m["b"][0].isupper())]
                if not pairs:
                    continue
                both = Words([f"{m['a'].lower()}\n{m['b'].lower()}" for m in pairs])
                maybe = passing(g, both.word[0::2]) & passing(h, both.word[1::2])
                if maybe.any():
                    taken = [(x, y) for x, y, c, *_ in candidates(t) if c != "name"]
                    beside = Sentences(t)
                    found = [(m.start(), m.end(), "name", "low", beside.around(*m.span()), m["a"].lower(), m["b"].lower()) for m, ok in zip(pairs, maybe) if ok and not any(x < m.end() and m.start() < y for x, y in taken)]
                    ids += [b["id"].iloc[i]] * len(found)
                    out += _stored(found, at)
            done = pd.DataFrame(out, columns=_COLUMNS)
            done.insert(0, "id", ids)
            yield done

    return spread(rows).mapInPandas(f, f"id {rows.schema['id'].dataType.simpleString()}, {_FOUND}")


def _names(found: DataFrame, low: DataFrame, given: DataFrame, family: DataFrame) -> DataFrame:
    """The candidates for names, with what is known of their words as terms and as seed."""
    rows = cut(found.where("class = 'name'").unionByName(low))
    rows = cut(lookup(rows, given.select(F.col("w").alias("a"), F.lit(True).alias("known_a")), ["a"], "left"))
    rows = lookup(rows, family.select(F.col("w").alias("b"), F.lit(True).alias("known_b")), ["b"], "left")
    rows = rows.withColumns({k: F.coalesce(k, F.lit(False)) for k in ("known_a", "known_b")})
    both, none = F.col("known_a") & F.col("known_b"), ~F.col("known_a") & ~F.col("known_b")
    rows = rows.where(both | (F.col("seed").isNull() & (~none | (F.length("a") > 2))))
    term = lambda c, n: F.when(F.col(c), n).otherwise(f"no {n}")
    terms = F.concat(F.array(term("known_a", "given"), term("known_b", "family")), "terms")
    return rows.select("id", "start", "end", "class", F.when(both, "person").when(none, "other").alias("seed"), terms.alias("terms"))


def disclosures(found: DataFrame) -> DataFrame:
    """(class, term, shown: [(kind, bits, prior)]): how much each term discloses of each kind, from the seeds."""
    seeds = found.where("seed IS NOT NULL")
    kinds = seeds.groupBy("class", F.col("seed").alias("kind")).agg(F.count("*").alias("n"))
    sizes = seeds.groupBy("class").agg(F.count("*").alias("all"))
    prior = kinds.join(sizes, "class").select("class", "kind", (F.col("n") / F.col("all")).alias("p"))
    terms = seeds.select("class", F.col("seed").alias("kind"), F.explode(F.array_distinct("terms")).alias("term"))
    joint = cut(terms.groupBy("class", "term", "kind").agg(F.count("*").alias("n")))
    alone = joint.groupBy("class", "term").agg(F.sum("n").alias("all"))
    share = (F.coalesce(F.col("n"), F.lit(0)) + SMOOTHING * F.col("p")) / (F.col("all") + SMOOTHING)
    odds = lambda p: F.log2(p / (1 - p))
    p = F.least(F.greatest(F.col("p"), F.lit(0.001)), F.lit(0.999))
    within = F.least(F.greatest(share, F.lit(1e-6)), F.lit(1 - 1e-6))
    each = alone.join(F.broadcast(prior), "class").join(joint, ["class", "term", "kind"], "left")  # prior: a few kinds
    return each.groupBy("class", "term").agg(F.collect_list(F.struct("kind", (odds(within) - odds(p)).alias("bits"), F.least(odds(p), F.lit(0.0)).alias("prior"))).alias("shown"))


def inner_disclosures(found: DataFrame, total: DataFrame, outside: DataFrame) -> DataFrame:
    """(class, term, bits) of the terms inside candidates of classes mail and place.

    total: (w, total) uses of words outside mail, outside: (w, total) capitalised pairs outside places.
    """
    terms = found.select("class", "seed", F.explode(F.array_distinct("terms")).alias("term"))
    n = terms.groupBy("class", "term").agg(F.count("seed").alias("n"), F.count("*").alias("held")).withColumn("w", F.expr("substring(term, instr(term, ' ') + 1)"))
    uses = n.where("term LIKE 'in %'").join(total, "w", "left").unionByName(n.where("term LIKE 'pair %'").join(outside, "w", "left"))
    uses = uses.unionByName(n.where("term LIKE 'host %'").withColumn("total", F.lit(None).cast("bigint")))
    # words are counted in places too, but not in mail; pairs only outside places
    all_uses = F.coalesce("total", F.lit(0)) + F.when((F.col("class") == "place") & F.col("term").startswith("in "), 0).otherwise(F.col("held"))
    share = (F.col("n") + INNER_SMOOTHING / 2) / (F.greatest(all_uses, F.col("n")) + INNER_SMOOTHING)
    return uses.select("class", "term", F.log2(share / (1 - share)).alias("bits"))


def find_personal(df: DataFrame, given_names: DataFrame, record_id: str, text: str = "text", given_name: str = "given_name") -> DataFrame:
    """(record_id, kind, start_at, length): every piece of personal information; no two overlap.

    Rows of one record_id must hold one text. Rows without record_id are left out. Without given
    names no persons are found.
    """
    parsed = cut(parse(df, record_id, text))
    total = cut(parsed.where("class = 'use'").groupBy(F.col("a").alias("w")).agg(F.sum("n").alias("total")))
    found = parsed.where("class <> 'use'").drop("n")
    pairs = cut(found.where("class = 'name'").groupBy("a", "b").agg(F.count("*").alias("n")))
    given, family = learn_names(pairs, total, given_names, given_name)
    span = ["id", "start", "end", "class"]
    judged = cut(_names(found, uncapitalised(df, record_id, text, given, family), given, family).unionByName(found.where("class = 'number'").select(*span, "seed", "terms")).distinct())
    terms = cut(judged.select(*span, F.explode(F.array_distinct("terms")).alias("term")))
    each = lookup(terms, disclosures(judged), ["class", "term"]).select(*span, F.explode("shown").alias("s"))
    scores = each.groupBy(*span, "s.kind").agg((F.sum("s.bits") + F.first("s.prior")).alias("bits"))
    best = scores.groupBy(*span).agg(F.max(F.struct("bits", "kind")).alias("b")).select(*span, "b.kind", "b.bits")
    spelt = cut(found.where("class IN ('mail', 'place')").select(*span, "seed", "terms").distinct())
    inner = cut(spelt.select(*span, F.explode("terms").alias("term")))
    outside = pairs.select(F.concat_ws(" ", "a", "b").alias("w"), F.col("n").alias("total"))
    kind = F.when(F.col("class") == "mail", "email").otherwise("address")
    shown = lookup(inner, inner_disclosures(spelt, total, outside), ["class", "term"]).groupBy(*span).agg(F.max("bits").alias("bits")).select(*span, kind.alias("kind"), "bits")
    enough = F.create_map(*[F.lit(x) for pair in THRESHOLD.items() for x in pair])[F.col("class")]
    spans = best.unionByName(shown).where((F.col("kind") != "other") & (F.col("bits") >= enough)).select("id", "start", "end", "kind").distinct()
    return _disjoint(spans).select(F.col("id").alias(record_id), "kind", (F.col("start") + 1).alias("start_at"), (F.col("end") - F.col("start")).alias("length"))


def _disjoint(spans: DataFrame) -> DataFrame:
    """Of overlapping spans the earlier, at one start the longer."""
    each = spans.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("start", (-F.col("end")).alias("minus"), "kind"))).alias("s"))
    empty = "cast(array() as array<struct<start:int,minus:int,kind:string>>)"
    kept = each.select("id", F.explode(F.expr(f"aggregate(s, {empty}, (k, x) -> if(size(k) = 0 or x.start >= -element_at(k, -1).minus, concat(k, array(x)), k))")).alias("x"))
    return kept.select("id", "x.start", (-F.col("x.minus")).alias("end"), "x.kind")


def sanitise(df: DataFrame, personal: DataFrame, record_id: str, text: str = "text", into: str = "clean_text") -> DataFrame:
    """df with column `into`: the text with every found piece replaced by a placeholder such as [PHONE]."""
    spans = personal.groupBy(F.col(record_id).alias("__id")).agg(F.array_sort(F.collect_list(F.struct("start_at", "length", F.upper("kind").alias("kind")))).alias("__spans"))
    joined = df.join(spans, F.col(record_id) == F.col("__id"), "left")
    init = "cast(struct('' as done, 1 as at) as struct<done:string,at:int>)"
    step = f"(a, x) -> struct(concat(a.done, substring(`{text}`, a.at, x.start_at - a.at), '[', x.kind, ']') as done, x.start_at + x.length as at)"
    clean = f"aggregate(coalesce(__spans, array()), {init}, {step}, a -> concat(a.done, substring(`{text}`, a.at)))"
    return joined.withColumn(into, F.expr(clean)).drop("__id", "__spans")
