"""Vector queries: centroids, similarity quantiles, cluster confidence, TF-IDF and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import text as T
from tidemill.operators.ranking import grouped_quantiles
from tidemill.operators.vectors import centroids, dot, spherical_kmeans, tfidf
from tidemill.plans.base import COMMENTS, comments
from tidemill.plans.catalog import query
from tidemill.plans.texts import TOKENS
from tidemill.sources.tables import table

_SIMILAR = """
    WITH d AS (SELECT vec_id, label, unnest(range(1, 65)) AS i, unnest(embedding) AS x FROM embeddings),
    m AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM d GROUP BY ALL), n AS (SELECT label, sqrt(sum(m * m)) AS n FROM m GROUP BY label),
    v AS (SELECT vec_id, sqrt(sum(CAST(x AS DOUBLE) * x)) AS n FROM d GROUP BY vec_id),
    s AS (SELECT d.vec_id, d.label, sum(CAST(x AS DOUBLE) * m / n.n) / any_value(v.n) AS sim FROM d JOIN m ON d.label = m.label AND d.i = m.i JOIN n ON d.label = n.label JOIN v ON d.vec_id = v.vec_id GROUP BY d.vec_id, d.label)
"""


def similarities(spark, root):
    e = table(spark, root, "embeddings")
    j = e.join(centroids(e, "label", "embedding", 64), "label")
    norm = F.sqrt(dot(F.col("embedding"), F.col("embedding")))
    return j.select("vec_id", "label", (dot(F.col("embedding"), F.col("centroid")) / norm).alias("sim"))


@query(_SIMILAR + " SELECT vec_id, label, round(sim, 4) AS similarity FROM s")
def centroid_cosine(spark, root):
    """Each vector's cosine with the centroid of its label."""
    return similarities(spark, root).select("vec_id", "label", F.round("sim", 4).alias("similarity"))


@query(_SIMILAR + " SELECT label, round(quantile_cont(sim, 0.25), 4) AS p25, round(quantile_cont(sim, 0.5), 4) AS p50, round(quantile_cont(sim, 0.75), 4) AS p75 FROM s GROUP BY label")
def similarity_quantiles(spark, root):
    """Quartiles of the similarities within each label, with linear interpolation."""
    q = grouped_quantiles(similarities(spark, root), "label", "sim", (0.25, 0.5, 0.75), -1.0, 1.0)
    named = lambda p, c: F.round(F.max(F.when(F.col("p") == p, F.col("q"))), 4).alias(c)
    return q.groupBy("label").agg(named(0.25, "p25"), named(0.5, "p50"), named(0.75, "p75"))


@query(
    _SIMILAR
    + """
    , g AS (SELECT label, count(*) AS n, round(avg(sim), 6) AS coherence FROM s GROUP BY label),
    x AS (SELECT label, n, coherence, round(least(28, 14 * log10(n)) + greatest(0, least(34, (coherence - 0.15) * 80)) + least(24, n / 2.0), 2) AS confidence FROM g)
    SELECT *, CASE WHEN confidence >= 72 THEN 'strong' WHEN confidence >= 50 THEN 'moderate' ELSE 'tentative' END AS band FROM x
    """
)
def cluster_confidence(spark, root):
    """How far each label can be trusted as a cluster: size and coherence."""
    g = similarities(spark, root).groupBy("label").agg(F.count("*").alias("n"), F.round(F.avg("sim"), 6).alias("coherence"))
    x = F.round(F.least(F.lit(28.0), 14 * F.log10("n")) + F.greatest(F.lit(0.0), F.least(F.lit(34.0), (F.col("coherence") - 0.15) * 80)) + F.least(F.lit(24.0), F.col("n") / 2.0), 2)
    g = g.withColumn("confidence", x)
    return g.withColumn("band", F.when(F.col("confidence") >= 72, "strong").when(F.col("confidence") >= 50, "moderate").otherwise("tentative"))


def _weights(spark, root):
    docs = comments(spark, root).select("comment_id", T.tokens(F.col("text")).alias("tokens"))
    return tfidf(docs, "comment_id", "tokens", min_df=3)


@query(
    COMMENTS
    + TOKENS
    + """
    , d AS (SELECT comment_id, tokens FROM k WHERE len(tokens) >= 2), nn AS (SELECT count(*) AS n FROM d),
    tc AS (SELECT comment_id, unnest(tokens) AS term FROM d), cc AS (SELECT comment_id, term, count(*) AS c FROM tc GROUP BY ALL),
    f AS (SELECT term, count(*) AS df FROM cc GROUP BY term), v AS (SELECT term, df FROM f, nn WHERE df >= 3 AND df <= greatest(1, floor(n * 0.35)) ORDER BY df DESC, term LIMIT 2600),
    w AS (SELECT comment_id, cc.term, (1 + ln(c)) * (ln((1.0 + n) / (1 + df)) + 1) AS w FROM cc JOIN v ON cc.term = v.term, nn),
    r AS (SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY round(w, 9) DESC, term) AS r FROM w), q AS (SELECT * FROM r WHERE r <= 24),
    z AS (SELECT comment_id, sqrt(sum(w * w)) AS norm FROM q GROUP BY comment_id HAVING count(*) >= 2)
    SELECT q.comment_id, term, round(w / norm, 6) AS weight FROM q JOIN z ON q.comment_id = z.comment_id
    """
)
def tfidf_weights(spark, root):
    """The TF-IDF vector of every comment."""
    return _weights(spark, root).select("comment_id", "term", F.round("weight", 6).alias("weight"))


@query()
def spherical_kmeans_topics(spark, root):
    """Every comment's topic by cosine k-means over TF-IDF vectors."""
    return spherical_kmeans(_weights(spark, root), "comment_id", k=12)[0]


#: The runs of the topic model: which comments, clusters, vocabulary, least document frequency and its greatest share.
RUNS = {"all": (None, 24, 2600, 14, 0.35), "high_signal": ("high", 18, 2200, 6, 0.40)}


@query()
def modelled_topics(spark, root):
    """Each topic of both runs: its size, authors, likes, best terms and the comments and posts that stand for it."""
    from functools import reduce

    from pyspark.sql import DataFrame

    from tidemill.operators.ranking import top_k
    from tidemill.operators.vectors import center_terms, cluster_label
    from tidemill.plans.scores import scored
    from tidemill.session import cut

    h = cut(scored(spark, root).select("comment_id", "post", "author", "likes", "generic", "high", T.tokens(F.col("text")).alias("tokens")))
    out = []
    for run, (which, k, vocabulary, least, most) in RUNS.items():
        docs = h.where(which) if which else h
        found, centers = spherical_kmeans(cut(tfidf(docs.select("comment_id", "tokens"), "comment_id", "tokens", min_df=least, max_df_share=most, vocabulary=vocabulary)), "comment_id", k)
        terms = [[t for t, _ in c] for c in center_terms(centers)]
        named = spark.createDataFrame([(i, t, cluster_label(t, [], f"topic_{i}")) for i, t in enumerate(terms)], "cluster int, terms array<string>, label string")
        j = cut(found.join(docs.drop("tokens"), "comment_id"))
        sums = j.groupBy("cluster").agg(F.count("*").alias("comments"), F.count_distinct("post").alias("posts"), F.count_distinct("author").alias("authors"), F.count_if("high").alias("high_signal"), F.count_if("generic").alias("generic"), F.sum("likes").alias("likes"), F.percentile("likes", F.lit(0.5)).alias("median_likes"))
        listed = lambda df, c: df.groupBy("cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", c))), lambda x: x[c]).alias(c + "s"))
        best = listed(top_k(j, ["cluster"], [F.desc("similarity"), F.desc("likes"), F.asc("comment_id")], 8), "comment_id")
        by_post = j.groupBy("cluster", "post").agg(F.count("*").alias("n"), F.count_if("high").alias("h"))
        top = listed(top_k(by_post, ["cluster"], [F.desc("n"), F.desc("h"), F.asc("post")], 6), "post").withColumnRenamed("posts", "top_posts")
        out.append(sums.join(named, "cluster").join(best, "cluster").join(top, "cluster").withColumn("run", F.lit(run)))
    return reduce(DataFrame.unionByName, out)


@query(_SIMILAR + " SELECT count(*) FILTER (sim < 0.1) AS noise, count(*) AS vectors, round(count(*) FILTER (sim < 0.1) / greatest(count(*), 1), 4) AS ratio FROM s")
def noise_ratio(spark, root):
    """Vectors too far from their cluster's centre to belong to it."""
    s = similarities(spark, root)
    noise = F.count_if(F.col("sim") < 0.1)
    return s.agg(noise.alias("noise"), F.count("*").alias("vectors"), F.round(noise / F.greatest(F.count("*"), F.lit(1)), 4).alias("ratio"))
