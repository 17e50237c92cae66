"""TF-IDF vectors in long form, spherical k-means and centroids."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import cut


def tfidf(docs: DataFrame, doc: str, tokens: str, min_df: int = 2, max_df_share: float = 0.35, vocabulary: int = 2600, keep: int = 24) -> DataFrame:
    """(doc, term, weight): unit vectors of each document's `keep` heaviest terms.

    idf = ln((1 + N) / (1 + df)) + 1 with N the documents of two or more tokens, tf = 1 + ln(count);
    the vocabulary is the most frequent terms within the df band, ties by term; documents left with
    fewer than two terms have no vector.
    """
    rows = docs.where(F.size(tokens) >= 2).select(doc, tokens)
    n = rows.count()
    counts = rows.select(doc, F.explode(tokens).alias("term")).groupBy(doc, "term").agg(F.count("*").alias("c"))
    df = counts.groupBy("term").agg(F.count("*").alias("df")).where((F.col("df") >= min_df) & (F.col("df") <= max(1, int(n * max_df_share))))
    vocab = df.orderBy(F.desc("df"), F.asc("term")).limit(vocabulary)  # at most `vocabulary` rows, so it may be broadcast
    w = counts.join(F.broadcast(vocab), "term").select(doc, "term", ((1 + F.log("c")) * (F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1)).alias("w"))
    w = w.withColumn("r", F.row_number().over(Window.partitionBy(doc).orderBy(F.desc(F.round("w", 9)), F.asc("term")))).where(F.col("r") <= keep)
    norm = w.groupBy(doc).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), F.count("*").alias("terms")).where("terms >= 2")
    return w.join(norm, doc).select(doc, "term", (F.col("w") / F.col("norm")).alias("weight"))


def strided_seeds(packed: DataFrame, doc: str, k: int) -> list:
    """Every step-th document in order of doc, k of them; numbered from counts of ranges, so no task sorts all."""
    n = packed.count()
    step = max(1, n // k)
    rows = packed.repartitionByRange(F.col(doc)).sortWithinPartitions(doc).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    rows = cut(rows)  # read twice; evaluated twice, the ranges would differ
    sizes = {r["__part"]: r["n"] for r in rows.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # one row a partition
    before, at = {}, 0
    for p in sorted(sizes):
        before[p], at = at, at + sizes[p]
    wanted = [(i * step) % n for i in range(k)]
    places = [(p, w - before[p], i) for i, w in enumerate(wanted) for p in sizes if before[p] <= w < before[p] + sizes[p]]
    chosen = rows.sparkSession.createDataFrame(places, "__part int, __n bigint, __seed int")
    own = rows.withColumn("__n", F.col("__at") - F.shiftleft(F.col("__part").cast("bigint"), 33))
    return own.join(F.broadcast(chosen), ["__part", "__n"]).orderBy("__seed").collect()  # k rows


def spherical_kmeans(vectors: DataFrame, doc: str, k: int, rounds: int = 9) -> tuple[DataFrame, list[dict[str, float]]]:
    """((doc, cluster, similarity), centers): cosine k-means from evenly strided seeds.

    Assignments are those before the last update of centers. A document goes to the most similar
    center, at a tie the lowest; an empty cluster keeps its center. Centers (k times the bounded
    vocabulary) travel to tasks as a matrix, with which a batch's documents are multiplied by their
    few terms at once; each task adds up its own documents' sums.
    """
    packed = vectors.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("v"))
    packed = cut(packed.select(doc, F.transform("v", lambda x: x["term"]).alias("terms"), F.transform("v", lambda x: x["weight"]).alias("weights")))  # at most `keep` terms a document
    n = packed.count()
    if not n:
        return packed.select(doc, F.lit(0).alias("cluster"), F.lit(0.0).alias("similarity")).limit(0), []
    k = min(k, n)
    words = sorted(r.term for r in vectors.select("term").distinct().collect())  # the bounded vocabulary
    at = {w: i for i, w in enumerate(words)}
    centers = np.zeros((k, len(words)))
    for i, r in enumerate(strided_seeds(packed, doc, k)):
        centers[i, [at[t] for t in r.terms]] = r.weights
    spark = packed.sparkSession
    places = spark.sparkContext.broadcast(at)

    def flat(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = b["terms"].str.len().to_numpy()
        index = np.array([places.value[t] for terms in b["terms"] for t in terms], np.int64)
        return index, np.concatenate([np.asarray(w, float) for w in b["weights"]]), np.r_[0, np.cumsum(sizes)[:-1]]

    def assign(b: pd.DataFrame, centers: np.ndarray):
        index, weights, first = flat(b)
        scores = np.round(np.add.reduceat(centers.T[index] * weights[:, None], first), 12)
        return index, weights, first, scores.argmax(axis=1), scores.max(axis=1)

    before = centers
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(centers)

        def sums(batches, sent=sent):
            total = np.zeros_like(sent.value)
            for b in batches:
                if len(b):
                    index, weights, first, best, _ = assign(b, sent.value)
                    np.add.at(total, (np.repeat(best, np.diff(np.r_[first, len(index)])), index), weights)
            i, t = np.nonzero(total)
            yield pd.DataFrame({"cluster": i.astype(np.int32), "term": t.astype(np.int32), "x": np.round(total[i, t] * 1e9).astype(np.int64)})

        got = packed.mapInPandas(sums, "cluster int, term int, x bigint").groupBy("cluster", "term").agg(F.sum("x").alias("x")).toPandas()  # k x vocabulary
        fresh = np.zeros_like(centers)
        fresh[got["cluster"], got["term"]] = got["x"] / 1e9
        norms = np.linalg.norm(fresh, axis=1, keepdims=True)
        before, centers = centers, np.where(norms > 0, fresh / np.maximum(norms, 1e-12), centers)
        sent.unpersist()
    sent = spark.sparkContext.broadcast(before)

    def label(batches):
        for b in batches:
            if len(b):
                *_, best, score = assign(b, sent.value)
                yield pd.DataFrame({doc: b[doc], "cluster": best.astype(np.int32), "similarity": np.round(score, 4)})

    kind = packed.schema[doc].dataType.simpleString()
    named = [{words[t]: float(c[t]) for t in np.flatnonzero(c)} for c in centers]
    return packed.mapInPandas(label, f"{doc} {kind}, cluster int, similarity double"), named


def center_terms(centers: list[dict[str, float]], k: int = 14) -> list[list[tuple[str, float]]]:
    """The k heaviest terms of each center with weights above 0 to four digits, ties by term."""
    rounded = [[(t, round(x, 4)) for t, x in c.items() if round(x, 4) > 0] for c in centers]
    return [sorted(c, key=lambda x: (-x[1], x[0]))[:k] for c in rounded]


def cluster_label(terms: list[str], phrases: list[str], fallback: str) -> str:
    """A cluster's label: its four best terms, else phrases, else its identifier."""
    return ", ".join(terms[:4]) or ", ".join(phrases[:4]) or fallback


def context_clusters(n: int) -> int:
    """How many clusters contexts of n posts are put into."""
    return min(14, max(4, round(n**0.5)))


def dot(a, b):
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def centroids(df: DataFrame, label: str, vector: str, size: int) -> DataFrame:
    """(label, centroid): each label's mean vector at unit length; sums are combined before the shuffle."""
    means = df.groupBy(label).agg(*[F.avg(F.get(vector, F.lit(i)).cast("double")).alias(f"m{i}") for i in range(size)])
    m = F.array(*[F.col(f"m{i}") for i in range(size)])
    raw = means.select(label, m.alias("m"))
    return raw.select(label, F.transform("m", lambda x: x / F.sqrt(dot(F.col("m"), F.col("m")))).alias("centroid"))
