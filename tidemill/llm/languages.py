"""The language of each document and of each segment of a mixed one, by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is bound by multiplying its letters' vectors,
each rolled by the letter's place; a text, or a segment of one, is the bundle (sum) of its words' n-grams,
and a language's prototype the bundle of the n-grams seen in it, each weighted by how much it is that
language's own, so that names, which stand in every language, count for none. A bundle is compared with
the prototypes by cosine. Its product with a prototype is a sum over its words, so words are multiplied
once and remembered; its length is taken from the bundle itself, on LENGTH_DIMENSIONS of its coordinates,
which are alike as letters are random. Segments are the best path over the words of a text: it costs much
to change language within a clause and less between clauses; each is then given the language of the
nearest prototype.

Profiles are fitted in two steps: on labelled samples (at most MAX_SAMPLES rows), then on the n-grams of
the clauses that the profiles are sure of in at most REFINE_ROWS labelled rows of the collection, where
n-grams seen less than LEAST_SEEN times are left out. Every row is then segmented.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.uniform_text import uniform
from tidemill.operators.ranking import top_k
from tidemill.session import cut, spread

DIMENSIONS, LENGTH_DIMENSIONS = 8192, 1024
#: At most so many labelled samples are used, as many of each language, chosen by a hash of their text.
MAX_SAMPLES = 20_000
#: Profiles are refined on at most so many labelled rows of the collection, taken by a hash of their text.
REFINE_ROWS = 50_000
#: Nats of log-odds that a unit of similarity is worth, and the costs of changing language.
SHARPNESS = 15.0
CHANGE_BETWEEN, CHANGE_WITHIN = 5.0, 9.0
#: A text whose best language is less ahead than this has no words of a language.
LEAST_EVIDENCE = 2.0
SURE = 4.0
#: Nats that an upstream label adds to its language while profiles are fitted; it is not used afterwards.
LABEL_WORTH = 6.0
LEAST_SEEN = 2
#: Words of which a bundle is added up at a time.
BUNDLE = 4096

_SKIP = regex.compile(r"(?i)[\p{L}\p{N}._+-]+(?:\s+dot\s+[\p{L}\p{N}._+-]+)*\s*(?:[(\[{]\s*at\s*[)\]}]|\sat\s)\s*[\p{L}\p{N}-]+(?:(?:\s+dot\s+|\s*[(\[]dot[)\]]\s*|\.)[\p{L}\p{N}-]+)+|(?:https?://|www\.)\S+|[\p{L}\p{N}._+-]+@[\p{L}\p{N}.-]+|[@#][\p{L}\p{M}\p{N}_.]+|[\[<{][A-Z_]+\d*[\]>}]|:[a-z_]+:")
_MAY_SKIP = re.compile(r"[@#<\[{]|://|www\.|:[a-z_]+:|(?i:\sat\s.*\sdot\s|\(at\))")
_TOKEN = regex.compile(r"(?P<word>\p{L}[\p{L}\p{M}]*)|(?P<end>[.!?…;:,\n\r/|()\"«»„“”]+|\s[-–—]+\s)|(?P<number>\p{N}+)")


def tokens(text: str) -> list[tuple[str, bool, bool]]:
    """(word in lower case, whether a clause begins at it, whether it counts) of a text in its uniform form.

    A word repeating the one before it doesn't count, nor does a capitalised word within a clause
    beside another one: such runs are names.
    """
    found: list[list] = []
    masked = _SKIP.sub(" ", text) if _MAY_SKIP.search(text) else text
    shouted = masked.upper() == masked
    fresh, capital_before, capitals = True, False, True
    start = 0

    def close() -> None:
        if capitals and len(found) - start > 1:  # a clause of capitalised words only is a name
            for t in found[start:]:
                t[2] = False

    for m in _TOKEN.finditer(masked):
        if m.lastgroup == "word":
            w = m.group()
            low, capital = w.lower(), not shouted and w[0].isupper()
            counts = not (found and found[-1][0] == low)
            if capital and capital_before and not fresh:
                counts = False
                if not found[-1][1]:
                    found[-1][2] = False
            if fresh:
                close()
                start, capitals = len(found), True
            found.append([low, fresh, counts])
            fresh, capital_before, capitals = False, capital, capitals and capital
        elif m.lastgroup == "end" and not (m.group() == "." and found and len(found[-1][0]) == 1):
            fresh, capital_before = True, False
    close()
    return [tuple(t) for t in found]


def grams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[i : i + n] for n in (3, 4, 5) for i in range(len(w) - n + 1)]


class Space:
    """The vectors of letters, n-grams and words."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 17):
        self.dimensions, self.seed = dimensions, seed
        self.rolled: dict[tuple[str, int], np.ndarray] = {}

    def letter(self, c: str, place: int) -> np.ndarray:
        v = self.rolled.get((c, place))
        if v is None:
            g = np.random.default_rng([self.seed, zlib.crc32(c.encode())])
            v = np.roll(g.integers(0, 2, self.dimensions, np.int8) * 2 - 1, place).astype(np.int8)
            if len(self.rolled) < 20_000:
                self.rolled[c, place] = v
        return v

    def gram(self, s: str, first: int | None = None) -> np.ndarray:
        """The bound vector of an n-gram, or its first coordinates."""
        v = self.letter(s[0], 0)[:first]
        for k, c in enumerate(s[1:], 1):
            v = v * self.letter(c, k)[:first]
        return v


class Profiles:
    """Prototypes of languages: names in order and a matrix with a row for each."""

    def __init__(self, names: list[str], bundles: np.ndarray, seed: int = 17):
        self.names = names
        self.matrix = (bundles / np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), 1e-9)).astype(np.float32)
        self._forget(bundles.shape[1], seed)

    def _forget(self, dimensions: int, seed: int) -> None:
        self.space = Space(dimensions, seed)
        self.known: dict[str, int] = {}
        self.seen: dict[str, np.ndarray] = {}
        # row 0 is a word that doesn't count
        self.product = np.zeros((4096, len(self.names)), np.float32)
        self.part = np.zeros((4096, min(LENGTH_DIMENSIONS, dimensions)), np.float32)

    def __getstate__(self):
        return {"names": self.names, "matrix": self.matrix, "seed": self.space.seed}

    def __setstate__(self, s):
        self.names, self.matrix = s["names"], s["matrix"]
        self._forget(self.matrix.shape[1], s["seed"])

    def rows(self, words: list[str]) -> np.ndarray:
        """Each word's row in `product` (its bundle times the prototypes, over the root of the dimensions) and in `part` (its bundle's first coordinates)."""
        if len(self.known) > 50_000:
            self._forget(self.space.dimensions, self.space.seed)
        get = self.known.get
        return np.array([get(w) or self._row(w) for w in words], np.int64)

    def _row(self, w: str) -> int:
        row = self.known[w] = len(self.known) + 1
        if row >= len(self.product):
            self.product, self.part = np.concatenate([self.product, np.zeros_like(self.product)]), np.concatenate([self.part, np.zeros_like(self.part)])
        found = grams(w)
        self.product[row] = np.sum([self._gram(s) for s in found], axis=0)
        self.part[row] = np.sum([self.space.gram(s, self.part.shape[1]) for s in found], axis=0, dtype=np.int32)
        return row

    def _gram(self, s: str) -> np.ndarray:
        v = self.seen.get(s)
        if v is None:
            v = self.matrix @ self.space.gram(s).astype(np.float32) / math.sqrt(self.space.dimensions)
            if len(self.seen) < 300_000:
                self.seen[s] = v
        return v

    def cosines(self, rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cosine with each prototype, length over the root of the dimensions) of the bundles of rows from each start to the next."""
        dot = np.add.reduceat(self.product[rows], starts)
        squares = np.zeros(len(starts))
        for k, (a, z) in enumerate(zip(starts.tolist(), [*starts[1:].tolist(), len(rows)])):
            bundle = self.part.take(rows[a : min(z, a + BUNDLE)], axis=0).sum(axis=0)
            for b in range(a + BUNDLE, z, BUNDLE):
                bundle += self.part.take(rows[b : min(z, b + BUNDLE)], axis=0).sum(axis=0)
            squares[k] = bundle @ bundle
        length = np.sqrt(squares / self.part.shape[1])
        return dot / np.maximum(length, 1e-9)[:, None], length


def _best_paths(scores: np.ndarray, fresh: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The language of every word on the best path of its text, for all texts at once, the longest leading.

    Texts begin at `first` and have `sizes` words; words of no text keep -1.
    """
    k = scores.shape[1]
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    still = np.searchsorted(-sizes, -np.arange(sizes.max(initial=0)), "left")  # texts of more than i words
    back = np.zeros(scores.shape, np.int16)
    path = np.full(len(scores), -1)
    at, own = scores[first].copy(), np.arange(k)
    for i in range(1, len(still)):
        m = still[i]
        here, held = first[:m] + i, at[:m]
        top = held.argmax(axis=1)
        moved = (held[np.arange(m), top] - np.where(fresh[here], CHANGE_BETWEEN, CHANGE_WITHIN))[:, None]
        stay = held >= moved
        back[here] = np.where(stay, own, top[:, None])
        at[:m] = np.where(stay, held, moved) + scores[here]
    path[first + sizes - 1] = at.argmax(axis=1)
    for i in range(len(still) - 1, 0, -1):
        here = first[: still[i]] + i
        path[here - 1] = back[here, path[here]]
    return path


def _may_change(ahead: np.ndarray, first: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each text the most that a run of its words is ahead of the text's best language."""
    n = len(ahead) + len(first)
    place = np.arange(len(ahead)) + doc + 1  # a 0 before each text
    x = np.zeros(n)
    x[place] = ahead
    sums = np.cumsum(x)
    begin = first + np.arange(len(first))
    own = np.repeat(np.arange(len(first)), np.diff(np.r_[begin, n]))
    sums -= sums[begin][own] if len(first) else 0
    apart = 2 * np.abs(sums).max(initial=0) + 1
    low = np.minimum.accumulate(sums - apart * own) + apart * own
    return np.maximum.reduceat(sums - low, begin)


def segment_all(texts, p: Profiles) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, language, confidence, cosine) of each segment of each text, in order; texts without words of a language have none.

    A segment's confidence is the share of its language in the odds of all languages.
    """
    found = [tokens(uniform(t)) if t else [] for t in texts]
    own = np.array([i for i, f in enumerate(found) if f], np.int64)
    if not len(own):
        return own, own, np.zeros(0), np.zeros(0)
    sizes = np.array([len(found[i]) for i in own])
    first, doc = np.r_[0, np.cumsum(sizes)[:-1]], np.repeat(np.arange(len(own)), sizes)
    flat = [t for i in own for t in found[i]]
    rows = p.rows([w for w, _, _ in flat]) * np.array([c for _, _, c in flat])
    nats = SHARPNESS * (p.product[rows] - p.product[rows].mean(axis=1, keepdims=True))
    best = np.add.reduceat(nats, first).argmax(axis=1)
    most = _may_change((nats - nats[np.arange(len(doc)), best[doc]][:, None]).max(axis=1), first, doc)
    path = best[doc]
    mixed = np.flatnonzero(most > CHANGE_BETWEEN)  # in the others the path never changes: no run is worth it
    if len(mixed):
        moving = _best_paths(nats, np.array([f for _, f, _ in flat]), first[mixed], sizes[mixed])
        path = np.where(moving >= 0, moving, path)
    starts = np.flatnonzero(np.r_[True, (np.diff(path) != 0) | (np.diff(doc) != 0)])
    cosine, length = p.cosines(rows, starts)
    worth = SHARPNESS * length[:, None] * (cosine - cosine.mean(axis=1, keepdims=True))
    lang = cosine.argmax(axis=1)
    top = worth[np.arange(len(starts)), lang]
    alone = np.bincount(doc[starts], minlength=len(own))[doc[starts]] == 1
    keep = ~alone | (top >= LEAST_EVIDENCE)
    sure = 1 / np.exp(np.clip(worth - top[:, None], -60, 60)).sum(axis=1)
    return own[doc[starts]][keep], lang[keep], sure[keep], cosine[np.arange(len(starts)), lang][keep]


def segments(text: str | None, p: Profiles) -> list[tuple[str, float]]:
    """(language, confidence) of each segment of one text."""
    _, lang, sure, _ = segment_all([text], p)
    return [(p.names[i], float(c)) for i, c in zip(lang, sure)]


def clauses(text: str | None) -> list[list[str]]:
    """The counting words of each clause of three or more."""
    out: list[list[str]] = []
    for w, fresh, counted in tokens(uniform(text)) if text else []:
        if fresh or not out:
            out.append([])
        if counted:
            out[-1].append(w)
    return [c for c in out if len(c) >= 3]


def sure_words(p: Profiles, said: list[str], labels: list) -> Counter:
    """(language, word) counts of the clauses that p, with the upstream label as a hint, is sure of."""
    counts: Counter = Counter()
    if not said:
        return counts
    place = {name: i for i, name in enumerate(p.names)}
    split = [c.split(" ") for c in said]
    starts = np.r_[0, np.cumsum([len(c) for c in split])[:-1]]
    products = np.add.reduceat(p.product[p.rows([w for c in split for w in c])], starts)
    nats = SHARPNESS * (products - products.mean(axis=1, keepdims=True))
    hint = np.array([place.get(x, -1) for x in labels])
    nats[np.flatnonzero(hint >= 0), hint[hint >= 0]] += LABEL_WORTH
    order = np.argsort(nats, axis=1)
    at = np.arange(len(split))
    best = order[:, -1]
    sure = nats[at, best] - (nats[at, order[:, -2]] if nats.shape[1] > 1 else 0) >= SURE
    for i in np.flatnonzero(sure):
        name = p.names[best[i]]
        counts.update((name, w) for w in split[i])
    return counts


def gram_weight(n: float, shares: np.ndarray, i: int) -> float:
    """The weight of a gram seen n times in language i in that language's bundle.

    shares: the gram's frequency in each language, by that language's size. A gram that other
    languages have as often weighs nothing.
    """
    return math.log1p(n) * max(0.0, shares[i] / shares.sum() - 0.25) / 0.75


def bundle_grams(names, rows, sizes: np.ndarray, dimensions: int) -> np.ndarray:
    """The languages' sums of weighted gram vectors. rows: (gram, counts by language)."""
    space, sums = Space(dimensions), np.zeros((len(names), dimensions))
    sizes = np.maximum(sizes, 1)
    held, weights = [], []

    def add() -> None:
        if held:
            sums[:] += np.array(weights, np.float32).T @ np.stack(held).astype(np.float32)
        held.clear(), weights.clear()

    for gram, counts in rows:
        counts = np.asarray(counts, float)
        shares = counts / sizes
        own = [gram_weight(n, shares, i) if n else 0.0 for i, n in enumerate(counts)]
        if any(own):
            held.append(space.gram(gram)), weights.append(own)
            if len(held) == 512:
                add()
    add()
    return sums


def gram_counts(words: Counter) -> Counter:
    counts: Counter = Counter()
    for (lang, w), n in words.items():
        for g in grams(w):
            counts[lang, g] += n
    return counts


def fit_samples(rows: list[tuple[str, str]], dimensions: int = DIMENSIONS) -> Profiles:
    """Profiles of labelled texts: (text, language) pairs, held by the driver."""
    names = sorted({lang for _, lang in rows})
    counts = gram_counts(_sample_words(rows))
    table: dict[str, list[int]] = {}
    for (lang, g), n in counts.items():
        table.setdefault(g, [0] * len(names))[names.index(lang)] += n
    sizes = np.sum(list(table.values()), axis=0)
    return Profiles(names, bundle_grams(names, sorted(table.items()), sizes, dimensions))


def _sample_words(rows: list[tuple[str, str]]) -> Counter:
    return Counter((lang, w) for text, lang in rows for w, _, counted in tokens(uniform(text)) if counted)


def fit(samples: DataFrame, corpus: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, rounds: int = 3) -> Profiles:
    """Profiles of the samples' languages, refined rounds - 1 times on labelled rows of the corpus (at most REFINE_ROWS).

    Both tables have the columns text and lang; the corpus's may be null, missing or wrong.
    """
    both = samples.select(F.col(text).alias("t"), F.col(lang).alias("l")).dropna().distinct()
    kinds = both.select("l").distinct().count()
    rows = [(r.t, r.l) for r in top_k(both, ["l"], [F.xxhash64("t"), F.col("t")], max(1, MAX_SAMPLES // max(1, kinds))).orderBy("l", "t").collect()]  # at most MAX_SAMPLES
    if not rows:
        raise ValueError("no labelled samples")
    p = fit_samples(rows, dimensions)
    names = tuple(p.names)
    spark = samples.sparkSession
    own = spark.createDataFrame([(*k, n) for k, n in gram_counts(_sample_words(rows)).items()], "lang string, gram string, n bigint")
    labelled = corpus.select(F.col(text).alias("text"), F.col(lang).alias("label")).where(F.col("label").isin(*names) & F.col("text").isNotNull())
    if rounds > 1:
        labelled = labelled.orderBy(F.xxhash64("text"), "text").limit(REFINE_ROWS).repartition(labelled.sparkSession.sparkContext.defaultParallelism)

        def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = [(label, " ".join(c)) for t, label in zip(b["text"], b["label"]) for c in clauses(t)]
                yield pd.DataFrame(out, columns=["label", "said"])

        labelled = cut(labelled.mapInPandas(parse, "label string, said string"))
    for _ in range(rounds - 1):
        before = spark.sparkContext.broadcast(p)  # languages x dimensions numbers

        def count(batches: Iterator[pd.DataFrame], before=before) -> Iterator[pd.DataFrame]:
            total: Counter = Counter()
            for b in batches:
                total.update(sure_words(before.value, b["said"].tolist(), b["label"].tolist()))
                if len(total) > 200_000:
                    yield _rows(gram_counts(total))
                    total.clear()
            yield _rows(gram_counts(total))

        counted = labelled.mapInPandas(count, "lang string, gram string, n bigint")
        each = counted.unionByName(own).groupBy("gram").agg(*[F.sum(F.when(F.col("lang") == name, F.col("n")).otherwise(0)).alias(f"n{i}") for i, name in enumerate(names)])
        each = cut(each.where(" + ".join(f"n{i}" for i in range(len(names))) + f" >= {LEAST_SEEN}"))
        sizes = np.array([x or 0 for x in each.agg(*[F.sum(f"n{i}") for i in range(len(names))]).first()], float)

        def bundle(batches: Iterator[pd.DataFrame], sizes=sizes) -> Iterator[pd.DataFrame]:
            sums = np.zeros((len(names), dimensions))
            for b in batches:
                sums += bundle_grams(names, zip(b["gram"], b.drop(columns="gram").to_numpy()), sizes, dimensions)
            i, d = np.nonzero(sums)
            yield pd.DataFrame({"i": i.astype(np.int32), "d": d.astype(np.int32), "x": np.round(sums[i, d] * 1e6).astype(np.int64)})

        sums = each.mapInPandas(bundle, "i int, d int, x bigint").groupBy("i", "d").agg(F.sum("x").alias("x"))
        bundles = np.zeros((len(names), dimensions))
        got = sums.toPandas()  # languages x dimensions numbers
        bundles[got["i"], got["d"]] = got["x"] / 1e6
        p = Profiles(list(names), bundles)
    return p


def _rows(counts: Counter) -> pd.DataFrame:
    return pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "gram", "n"])


def language_segments(df: DataFrame, profiles: Profiles, record_id: str, text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(record_id, *carry, seg_no, segments, lang_found, confidence, cosine): a row for each segment of each text.

    Null, empty and wordless texts have no row. Rows that repeat are each given theirs.
    """
    columns = [record_id, *carry]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "seg_no int", "segments int", "lang_found string", "confidence double", "cosine double"])
    sent = df.sparkSession.sparkContext.broadcast(profiles)  # languages x dimensions numbers

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = sent.value
        for b in batches:
            own, lang, sure, cosine = segment_all(b["__text"], p)
            first = np.flatnonzero(np.r_[True, np.diff(own) != 0][: len(own)])
            many = np.diff(np.r_[first, len(own)])
            numbers = np.arange(len(own)) - np.repeat(first, many) + 1
            out = b[columns].iloc[own].reset_index(drop=True)
            yield out.assign(seg_no=numbers.astype(np.int32), segments=np.repeat(many, many).astype(np.int32), lang_found=pd.Series(np.array(p.names, object)[lang], dtype=object), confidence=np.round(sure, 4), cosine=np.round(cosine.astype(float), 4))

    return spread(df.select(*columns, F.col(text).alias("__text")).where("__text IS NOT NULL")).mapInPandas(f, schema)
