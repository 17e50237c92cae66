"""Results that must stay whole on tables of several partitions."""

import random
from contextlib import contextmanager

from pyspark.sql import functions as F

from tidemill.operators.diverse import select_diverse
from tidemill.operators.providers import RuleProvider, extract_signals, numbered_batches, resolve_pointers
from tidemill.plans.summaries import _numbered


@contextmanager
def small_partitions(spark):
    """Adaptive execution with ranges that depend on the size of the columns read."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_numbered_keeps_every_row(spark):
    n = 60_000
    df = spark.range(n).select(F.format_string("id%08d", "id").alias("id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("at"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    with small_partitions(spark):
        got = _numbered(df, ["at", "id"], "position").collect()
    assert [r.position for r in sorted(got, key=lambda r: (r["at"], r["id"]))] == list(range(1, n + 1))


def test_pointers_resolve_to_their_own_rows(spark):
    n, cues = 40_000, RuleProvider.PROBLEM
    cue = lambda i: F.element_at(F.array(*[F.lit(c) for c in cues]), (i % len(cues) + 1).cast("int"))
    df = spark.range(n).select(F.format_string("c%08d", "id").alias("comment_id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("likes"), F.concat_ws(" ", cue(F.col("id")), F.sha2(F.col("id").cast("string"), 512)).alias("text"))
    with small_partitions(spark):
        b = numbered_batches(df, [F.desc("likes"), F.asc("comment_id")])
        r = resolve_pointers(extract_signals(b, "text", RuleProvider()), b).agg(F.count("*").alias("n"), F.count_distinct("comment_id").alias("rows"), F.count_if(F.col("problem") == cue(F.substring("comment_id", 2, 8).cast("bigint"))).alias("own"))
        assert tuple(r.first()) == (n, n, n)


def _greedy(rows, limit):
    rows = sorted(rows, key=lambda x: (-x[4], x[1]))
    chosen, posts, authors = [], set(), set()
    for _, i, p, a, _s in rows:
        if len(chosen) < limit and p not in posts and a not in authors:
            chosen.append(i)
            posts.add(p), authors.add(a)
    return [*chosen, *[r[1] for r in rows if r[1] not in chosen][: limit - len(chosen)]]


def test_diverse_beyond_a_dominant_author(spark):
    r = random.Random(6)
    topics = {"one": [("one", f"i{p:03d}{k:02d}", f"p{p}", "a", 900.0 - p) for p in range(40) for k in range(9)] + [("one", f"j{k}", f"q{k}", f"b{k}", 1.0 + k) for k in range(12)]}
    topics["one"] += [("one", f"k{k:02d}", f"p{k}", f"c{k % 3}", 20.0 + k) for k in range(40)]
    for t in range(12):
        s = str(t)
        topics[s] = [(s, f"i{i:04d}", r.choice([None, *[f"p{round(r.random() ** 2 * n)}" for n in (3, 30)]]), r.choice([None, "a", "a", f"a{round(r.random() ** 3 * 40)}"]), float(r.randrange(30))) for i in range(400)]
    rows = [x for v in topics.values() for x in v]
    df = spark.createDataFrame(rows + rows[:50], "topic string, item string, post string, author string, score double")
    for limit in (1, 4, 8):
        got = {}
        for x in select_diverse(df, "topic", "item", "post", "author", "score", limit).orderBy("place").collect():
            got.setdefault(x.topic, []).append(x.item)
        assert got == {t: _greedy(v, limit) for t, v in topics.items()}
