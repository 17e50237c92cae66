"""The subjects of each document: averaged word and subword embeddings with independent logistic outputs.

A sentence is the mean of the vectors of its words, word pairs and character n-grams (hashed into
BUCKETS rows); each subject has a logistic output of its own, so a sentence may concern none, one or
several. Training is data-parallel: in every step each partition computes the gradient over its part of
the step's mini-batch, the driver adds them up, makes one step and sends the parameters out again
(BUCKETS x DIMENSIONS numbers, whatever the data). A document is about a subject if enough of its
sentences concern it.

Labelled samples don't show every wording, so the model is fitted twice: on the samples, then on
sentences of the collection as well. For these, every word and word pair is counted over all documents
together with the subjects found among the other sentences of its document: wording that keeps company
with one subject belongs to it, and wording that keeps any company belongs to none. Training takes
every distinct sentence that is judged so, in MINI_BATCHES equal parts, one a step, so that 2 * STEPS
steps go over all of them 2 * STEPS / MINI_BATCHES times.

Texts are cut into sentences once. All passes over them work on arrays of a whole batch: words are
known by a hash of their letters, computed for all words of a batch at once, and only a batch's
distinct words are looked at one by one.

Defined results: null and empty documents, and documents about no subject, have no row. A document of
one sentence tells nothing of company, and takes part in everything else.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.uniform_text import uniform
from tidemill.llm.word_arrays import Words, chunks
from tidemill.operators.ranking import top_k
from tidemill.operators.skew import lookup
from tidemill.session import cut, removed, small_enough, spread, written

BUCKETS, DIMENSIONS = 1 << 15, 16
#: At most so many labelled samples are used, as many of each subject, chosen by a hash of their text.
MAX_SAMPLES = 20_000
MAX_SUBJECTS = 1000
STEPS, RATE, MINI_BATCHES = 40, 0.1, 4
#: Gradients of more partitions than this are added up in groups before they go to the driver.
GRADIENTS = 32
SURE = 0.7
SHARE = 1 / 6
#: Wording used at least so often is judged by its company, smoothed by so many usual uses. It belongs
#: to a subject that so great a share of the sentences around it concern, if that is so great a part
#: of all it keeps (each against the usual); it is neutral below the second pair of limits.
LEAST_USES, SMOOTHING = 15, 15.0
BELONGS, NEUTRAL = (0.15, 0.5), (0.1, 0.4)
#: Up to so many judged wordings (about 100 bytes each) are sent to tasks; beyond that they are joined.
MAX_SENT_WORDINGS = 200_000

_LEAD = regex.compile(r"^\s*(?:@[\p{L}\p{N}_.]+\s*:|[-*>•]+|#{1,6}\s)\s*")
_HEADING = regex.compile(r"^\s*#{1,6}\s|^\s*(?:#\w+\s*)+$")
_SPLIT = regex.compile(r"(?<=[.!?…])[\s\"'”»)]+(?=[\p{L}\p{N}¿¡\"'@«“(])")
_TAGS = regex.compile(r"[@#][\p{L}\p{M}\p{N}_.]+|https?://\S+")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def sentences(text: str | None) -> list[list[str]]:
    """The sentences of a text as lists of lower-case words; headings and tags are none."""
    out = []
    for line in uniform(text or "").split("\n"):
        if not line.strip() or _HEADING.match(line):
            continue
        for part in _SPLIT.split(_LEAD.sub("", line)):
            words = _WORD.findall(_TAGS.sub(" ", part).lower())
            if words:
                out.append(words)
    return out


def parsed(docs: DataFrame, doc_id: str | None, text: str = "text") -> DataFrame:
    """(doc, said): the texts' sentences, one a line, words apart by a space; texts without sentences are left out."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said = ["\n".join(map(" ".join, sentences(t))) for t in b["text"]]
            out = b[["doc"]].assign(said=said)
            yield out[out["said"] != ""]

    own = F.col(doc_id) if doc_id else F.lit(0)
    rows = docs.select(own.alias("doc"), F.col(text).alias("text")).where("doc IS NOT NULL AND text IS NOT NULL")
    return spread(rows).mapInPandas(f, f"doc {rows.schema['doc'].dataType.simpleString()}, said string")


def _bucket(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass")) % BUCKETS


def word_buckets(w: str) -> list[int]:
    marked = f"<{w}>"
    return [_bucket(w), *(_bucket(marked[i : i + n]) for n in (4, 5) for i in range(len(marked) - n + 1))]


def pair_buckets(pair: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The bucket of each word's pair; BUCKETS, which holds nothing, for a sentence's last word."""
    return np.where(last, BUCKETS, (pair >> np.uint64(20)).astype(np.int64) % BUCKETS)


class Model:
    """Parameters: embeddings, output weights and biases; names are the subjects in order."""

    def __init__(self, names: list[str], vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.names, self.vectors, self.weights, self.bias = names, vectors, weights, bias
        self.padded = np.concatenate([vectors, np.zeros((1, DIMENSIONS), np.float32)])
        self.known: dict[int, int] = {}
        self.sums, self.sizes = np.zeros((1024, DIMENSIONS), np.float32), np.zeros(1024, np.float32)

    def __getstate__(self):
        return self.names, self.vectors, self.weights, self.bias

    def __setstate__(self, s):
        self.__init__(*s)

    @classmethod
    def fresh(cls, names: list[str], seed: int = 5) -> Model:
        g = np.random.default_rng(seed)
        return cls(names, (g.standard_normal((BUCKETS, DIMENSIONS)) / DIMENSIONS).astype(np.float32), np.zeros((DIMENSIONS, len(names)), np.float32), np.full(len(names), -2.0, np.float32))

    def scores(self, w: Words) -> np.ndarray:
        """The probability that each sentence concerns each subject."""
        if not len(w.word):
            return np.zeros((0, len(self.names)), np.float32)
        distinct, at, of = np.unique(w.word, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > 1_000_000:
            self.known.clear()
        rows = np.empty(len(distinct), np.int64)
        for k, (h, i) in enumerate(zip(distinct.tolist(), at.tolist())):
            row = self.known.get(h)
            if row is None:
                row = self.known[h] = len(self.known)
                if row >= len(self.sizes):
                    self.sums, self.sizes = np.concatenate([self.sums, np.zeros_like(self.sums)]), np.concatenate([self.sizes, np.zeros_like(self.sizes)])
                own = word_buckets(w.string(i))
                self.sums[row], self.sizes[row] = self.vectors[own].sum(axis=0), len(own)
            rows[k] = row
        row = rows[of]
        h = np.add.reduceat(self.sums[row] + self.padded[pair_buckets(w.pair, w.last)], w.first)
        n = np.add.reduceat(self.sizes[row] + ~w.last, w.first)
        return 1 / (1 + np.exp(-(h / n[:, None] @ self.weights + self.bias)))


BLOCK = "part int, own binary, sizes binary, words binary, lengths binary, pairs binary, targets binary"
BLOCK_COLUMNS = [c.split()[0] for c in BLOCK.split(", ")]
#: Sentences of a block.
BLOCK_SENTENCES = 2048


def _i4(x) -> bytes:
    return np.asarray(x, "<i4").tobytes()


def block(said: list[str], targets: list, part: int = 0) -> tuple:
    """A row of BLOCK: the distinct words of sentences with their buckets, and the sentences by these words."""
    w = Words(said)
    _, at, of = np.unique(w.word, return_index=True, return_inverse=True)
    own = [word_buckets(w.string(i)) for i in at.tolist()]
    return part, _i4([x for o in own for x in o]), _i4([len(o) for o in own]), _i4(of), _i4(np.diff(np.r_[w.first, len(w.word)])), _i4(pair_buckets(w.pair, w.last)), np.asarray(targets, "<f4").tobytes()


def packed(rows: DataFrame, parts: int) -> DataFrame:
    """Training blocks of (words, targets), dealt into `parts` equal parts."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[list[str], list]] = [([], []) for _ in range(parts)]
        n = 0
        for b in batches:
            out = []
            for said, target in zip(b["words"], b["targets"]):
                lines, targets = held[n % parts]
                n += 1
                lines.append(said), targets.append(target)
                if len(lines) == BLOCK_SENTENCES:
                    out.append(block(lines, targets, (n - 1) % parts))
                    lines.clear(), targets.clear()
            yield pd.DataFrame(out, columns=BLOCK_COLUMNS)
        yield pd.DataFrame([block(*x, k) for k, x in enumerate(held) if x[0]], columns=BLOCK_COLUMNS)

    return rows.select("words", "targets").mapInPandas(f, BLOCK)


def _block_gradient(r, params, grads) -> tuple[int, float]:
    """Adds a block's gradients to grads; returns its sentences and loss."""
    vectors, weights, bias = params
    gv, gw, gb = grads
    i4 = lambda x: np.frombuffer(x, "<i4").astype(np.int64)
    own, sizes, words, lengths, pairs = map(i4, r[1:6])
    targets = np.frombuffer(r[6], "<f4").reshape(len(lengths), -1)
    first, begin = np.r_[0, np.cumsum(lengths)[:-1]], np.r_[0, np.cumsum(sizes)[:-1]]
    sums = np.add.reduceat(vectors[own], begin)
    n = (np.add.reduceat(sizes[words], first) + lengths - 1).astype(np.float32)[:, None]
    h = np.add.reduceat(sums[words] + vectors[pairs], first) / n
    p = 1 / (1 + np.exp(-(h @ weights + bias)))
    e = (p - targets).astype(np.float32)
    gw += h.T @ e
    gb += e.sum(axis=0)
    each = np.repeat((e @ weights.T / n).astype(np.float32), lengths, axis=0)
    _add(gv, pairs, each)
    by_word = np.zeros_like(sums)
    _add(by_word, words, each)
    _add(gv, own, np.repeat(by_word, sizes, axis=0))
    return len(lengths), -float(np.sum(targets * np.log(p + 1e-9) + (1 - targets) * np.log(1 - p + 1e-9)))


def _add(into: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    order = np.argsort(at.astype(np.uint32), kind="stable")
    place = at[order]
    begin = np.flatnonzero(np.r_[True, np.diff(place) != 0])
    into[place[begin]] += np.add.reduceat(rows[order], begin)


GRADIENT = "slot int, used binary, gv binary, gw binary, gb binary, n bigint, loss double"


def _sent_gradient(gv, gw, gb, n, loss, slot=0) -> pd.DataFrame:
    used = np.flatnonzero(np.abs(gv).sum(axis=1))
    return pd.DataFrame({"slot": [slot], "used": [used.astype("<i4").tobytes()], "gv": [gv[used].tobytes()], "gw": [gw.tobytes()], "gb": [gb.tobytes()], "n": [n], "loss": [loss]})


def _summed_blocks(rows, params) -> tuple[list[np.ndarray], int, float]:
    vectors, weights, bias = params
    params = np.concatenate([vectors, np.zeros((1, DIMENSIONS), np.float32)]), weights, bias
    grads, n, loss = [np.zeros_like(p) for p in params], 0, 0.0
    for r in rows:
        k, x = _block_gradient(r, params, grads)
        n, loss = n + k, loss + x
    return [grads[0][:-1], *grads[1:]], n, loss


def _gradient(sent):
    """Sums of gradients over a partition's blocks, as one packed row."""

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        rows = (r for b in batches for r in b[BLOCK_COLUMNS].itertuples(index=False, name=None))
        yield _sent_gradient(*_flat(_summed_blocks(rows, sent.value)), TaskContext.get().partitionId() % GRADIENTS)

    return f


def _summed(shape: tuple[int, int], rows) -> tuple[list[np.ndarray], int, float]:
    grads = [np.zeros((BUCKETS, DIMENSIONS), np.float32), np.zeros(shape, np.float32), np.zeros(shape[1], np.float32)]
    n, loss = 0, 0.0
    for r in sorted(rows, key=lambda r: bytes(r.gb)):
        grads[0][np.frombuffer(r.used, "<i4")] += np.frombuffer(r.gv, np.float32).reshape(-1, DIMENSIONS)
        grads[1] += np.frombuffer(r.gw, np.float32).reshape(shape)
        grads[2] += np.frombuffer(r.gb, np.float32)
        n, loss = n + r.n, loss + r.loss
    return grads, n, loss


def _flat(x):
    grads, n, loss = x
    return (*grads, n, loss)


def train(blocks: DataFrame | list[tuple], model: Model, steps: int = STEPS, rate: float = RATE, parts: int = 1) -> Model:
    """model after `steps` synchronised steps on packed blocks, step t on those of part t modulo parts.

    A list of blocks (of a bounded sample) is trained on by the driver.
    """
    params = [model.vectors.copy(), model.weights.copy(), model.bias.copy()]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    shape, seen = model.weights.shape, 0
    local = isinstance(blocks, list)
    many = not local and blocks.rdd.getNumPartitions() > GRADIENTS
    for t in range(1, steps + 1):
        if local:
            grads, n, _ = _summed_blocks(blocks, params)
        else:
            sent = blocks.sparkSession.sparkContext.broadcast(tuple(params))
            found = blocks.where(F.col("part") == (t - 1) % parts).mapInPandas(_gradient(sent), GRADIENT)
            if many:
                found = found.groupBy("slot").applyInPandas(lambda x: _sent_gradient(*_flat(_summed(shape, x.itertuples(index=False)))), GRADIENT)
            grads, n, _ = _summed(shape, found.collect())  # at most GRADIENTS rows of parameter size
            sent.destroy()  # else every step's parameters would stay on the executors' disks
        seen += n
        if not n:
            continue
        for p, g, a, b in zip(params, grads, first, second):
            g /= n
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-6)
    if not seen:
        raise ValueError("nothing to train on")
    return Model(model.names, *params)


def sample_rows(samples: DataFrame, names: list[str], text: str, subject: str) -> list[tuple[str, list[float]]]:
    """(words, targets) of the labelled samples' sentences: at most MAX_SAMPLES texts, as many of each subject."""
    known = samples.select(F.col(text).alias("t"), F.col(subject).alias("s")).dropna().where(F.col("s").isin(*names))
    each = max(1, MAX_SAMPLES // max(1, len(names)))
    chosen = top_k(known.distinct(), ["s"], [F.xxhash64("t"), F.col("t")], each).select("t", "s").orderBy("s", "t").collect()
    return [(" ".join(w), [float(n == r.s) for n in names]) for r in chosen for w in sentences(r.t)]


def company(said: DataFrame, model: Model) -> DataFrame:
    """(wording, n, with_0, with_1, ...): uses of every word and word pair, and the summed shares of
    each subject among the other sentences of its document."""
    sent, k = said.sparkSession.sparkContext.broadcast(model), len(model.names)
    columns = [f"with_{i}" for i in range(k)]

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for _, w in chunks(batches):
            if not len(w.word):
                continue
            sure = (m.scores(w) >= SURE).astype(np.float64)
            starts = np.flatnonzero(np.r_[True, np.diff(w.doc) != 0])
            many = np.diff(np.r_[starts, len(w.doc)])
            doc = np.repeat(np.arange(len(starts)), many)
            others = np.maximum(many[doc] - 1, 1)[:, None]
            values = np.c_[np.ones(len(doc)), (np.add.reduceat(sure, starts)[doc] - sure) / others]
            social = many[doc] > 1
            hashes, at, width = [], [], []
            for key, size in ((w.word, 1), (w.pair, 2)):
                use = np.flatnonzero(social[w.sentence] & (~w.last if size == 2 else True))
                order = use[np.lexsort((w.sentence[use], key[use]))]
                same = (key[order][1:] == key[order][:-1]) & (w.sentence[order][1:] == w.sentence[order][:-1])
                order = order[np.r_[True, ~same][: len(order)]]  # once a sentence
                hashes.append(key[order]), at.append(order), width.append(np.full(len(order), size))
            key, at, width = np.concatenate(hashes), np.concatenate(at), np.concatenate(width)
            if not len(key):
                continue
            begin = np.flatnonzero(np.r_[True, (np.diff(key) != 0) | (np.diff(width) != 0)])
            sums = np.add.reduceat(values[w.sentence[at]], begin)
            ends = w.end[at[begin] + width[begin] - 1]
            out = {"wording": [w.text[a:b] for a, b in zip(w.start[at[begin]].tolist(), ends.tolist())], "n": sums[:, 0].astype(np.int64)}
            yield pd.DataFrame(out | {c: np.round(sums[:, i + 1] * 1e4).astype(np.int64) for i, c in enumerate(columns)})

    found = said.select("said").mapInPandas(f, "wording string, n bigint, " + ", ".join(f"{c} bigint" for c in columns))
    return found.groupBy("wording").agg(F.sum("n").alias("n"), *[(F.sum(c) / 1e4).alias(c) for c in columns])


def marked(uses: DataFrame, k: int) -> DataFrame:
    """(wording, own_0, ..., some): 1 for the subject that well-used wording belongs to, and how many it is not neutral to."""
    usual = uses.where("wording NOT LIKE '% %'").agg(F.sum("n").alias("n"), *[F.sum(f"with_{i}").alias(f"with_{i}") for i in range(k)]).first()
    rates = [max((usual[f"with_{i}"] or 0) / max(usual["n"] or 0, 1), 1e-4) for i in range(k)]
    smooth = [((F.col(f"with_{i}") + SMOOTHING * rates[i]) / (F.col("n") + SMOOTHING) / F.lit(rates[i])).alias(f"lift_{i}") for i in range(k)]
    known = uses.where(F.col("n") >= LEAST_USES).select("wording", *smooth)
    whole = sum((F.col(f"lift_{i}") for i in range(1, k)), F.col("lift_0"))
    least = lambda limits: [((F.col(f"lift_{i}") / whole >= max(limits[1], 1 / k + 0.25)) & (F.col(f"lift_{i}") >= 1.25) & (F.col(f"lift_{i}") * rates[i] >= limits[0])).cast("int") for i in range(k)]
    some = least(NEUTRAL)
    return known.select("wording", *[x.alias(f"own_{i}") for i, x in enumerate(least(BELONGS))], sum(some[1:], some[0]).alias("some"))


def judged(said: DataFrame, marks: DataFrame, k: int) -> DataFrame:
    """(words, targets): the distinct sentences that their wording's company assigns to subjects or to none."""
    kind = "words string, targets array<float>"
    if small_enough(marks, MAX_SENT_WORDINGS):
        rows = sorted((r.wording, *[r[f"own_{i}"] for i in range(k)], r.some) for r in marks.toLocalIterator())
        spelt = Words([r[0] for r in rows])
        keys = np.where(spelt.last[spelt.first], spelt.word[spelt.first], spelt.pair[spelt.first])
        order = np.argsort(keys)
        table = keys[order], np.array([r[1:] for r in rows], np.int32).reshape(-1, k + 1)[order]
        sent = said.sparkSession.sparkContext.broadcast(table)

        def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            keys, marks = sent.value
            telling = marks.any(axis=1)
            for _, w in chunks(batches):
                if not len(w.word) or not len(keys):
                    continue
                sums = np.zeros((len(w.first), k + 1), np.int64)
                met = np.zeros(len(w.first), bool)
                for key, use in ((w.word, np.ones(len(w.word), bool)), (w.pair, ~w.last)):
                    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                    hit = np.flatnonzero(use & (keys[at] == key))
                    met[w.sentence[hit]] = True
                    hit = hit[telling[at[hit]]]
                    once = np.unique(w.sentence[hit] * len(keys) + at[hit])
                    if len(once):
                        line = once // len(keys)
                        begin = np.flatnonzero(np.r_[True, np.diff(line) != 0])
                        sums[line[begin]] += np.add.reduceat(marks[once % len(keys)], begin)
                most = sums[:, :k].max(axis=1)
                chosen = np.flatnonzero(met & ((most > 0) | (sums[:, k] == 0)))
                targets = ((sums[chosen, :k] > 0) & (2 * sums[chosen, :k] >= most[chosen, None])).astype(np.float32)
                yield pd.DataFrame({"words": w.sentences(chosen), "targets": list(targets)}).drop_duplicates("words")

        return said.select("said").mapInPandas(f, kind).dropDuplicates(["words"])
    found = cut(said.select(F.explode(F.split("said", "\n")).alias("words")).distinct())
    pairs = F.expr("transform(slice(w, 1, greatest(size(w) - 1, 0)), (x, i) -> concat(x, ' ', w[i + 1]))")
    worded = cut(found.withColumn("w", F.split("words", " ")).select("words", F.explode(F.array_distinct(F.concat(F.col("w"), pairs))).alias("wording")))
    sums = lookup(worded, marks, ["wording"]).groupBy("words").agg(*[F.sum(f"own_{i}").alias(f"own_{i}") for i in range(k)], F.sum("some").alias("some"))
    most = F.greatest(*[F.col(f"own_{i}") for i in range(k)]) if k > 1 else F.col("own_0")
    belongs = F.array(*[((F.col(f"own_{i}") > 0) & (2 * F.col(f"own_{i}") >= most)).cast("float") for i in range(k)])
    return sums.where((most > 0) | (F.col("some") == 0)).select("words", belongs.alias("targets"))


def fit(samples: DataFrame, docs: DataFrame, names: list[str], sample_text: str = "text", subject: str = "subject", text: str = "text", said: DataFrame | None = None) -> Model:
    """A model of the named subjects from labelled samples and the company that wording keeps in docs.

    said: the documents as parsed before, to save parsing them again.
    """
    if len(names) > MAX_SUBJECTS:
        raise ValueError(f"more than {MAX_SUBJECTS} subjects")
    spark, k = samples.sparkSession, len(names)
    known = sample_rows(samples, names, sample_text, subject)
    if not known:
        raise ValueError("no labelled samples")
    first = train([block(*map(list, zip(*known)))], Model.fresh(names))
    said = cut(parsed(docs, None, text)) if said is None else said
    rows = judged(said, cut(marked(cut(company(said, first)), k)), k).unionByName(spark.createDataFrame(known, "words string, targets array<float>"))
    rows = rows.repartition(F.xxhash64("words")).sortWithinPartitions(F.xxhash64("words"), "words", F.hash("targets"))
    blocks, path = written(packed(rows, MINI_BATCHES), "part")
    model = train(blocks, Model.fresh(names), steps=2 * STEPS, parts=MINI_BATCHES)
    removed(spark, path)
    return model


def subject_shares(docs: DataFrame | None, model: Model, doc_id: str, text: str = "text", said: DataFrame | None = None) -> DataFrame:
    """(doc_id, subject, share, sentences): for each subject that any sentence concerns, the share of sentences."""
    said = parsed(docs, doc_id, text) if said is None else said
    kind = said.schema["doc"].dataType.simpleString()
    sent = said.sparkSession.sparkContext.broadcast(model)

    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        names = np.array(m.names, object)
        for b, w in chunks(batches):
            if not len(w.word):
                continue
            held = (m.scores(w) >= 0.5).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, np.diff(w.doc) != 0])
            many = np.diff(np.r_[starts, len(w.doc)]).astype(np.int32)
            sums = np.add.reduceat(held, starts)
            d, i = np.nonzero(sums)
            yield pd.DataFrame({"doc": b["doc"].to_numpy()[w.doc[starts[d]]], "subject": names[i], "share": sums[d, i] / many[d], "sentences": many[d]})

    return said.mapInPandas(f, f"doc {kind}, subject string, share double, sentences int").withColumnRenamed("doc", doc_id)
