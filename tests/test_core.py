import json

import pytest
from pyspark.sql import functions as F

from tidemill.functions import text as T
from tidemill.functions.salvage import loose_json, salvage_array
from tidemill.functions.values import handle, likes, post_kind, roughly_equal, short_number, shortcode
from tidemill.operators.diverse import select_diverse
from tidemill.operators.intervals import nearest, within_days
from tidemill.operators.keyed import first_claims, latest_by_key, merge_states
from tidemill.operators.providers import RuleProvider, extract_signals, numbered_batches, resolve_pointers, with_retries
from tidemill.operators.ranking import top_values
from tidemill.operators.vectors import spherical_kmeans, tfidf
from tidemill.sources.bundles import read_bundle, read_lines, write_bundle, write_csv, write_report
from tidemill.sources.pages import linked_posts, page_record, parse_page
from tidemill.streaming.ingest import current, read_messages, unique_messages, upsert_batches, windowed_counts
from tidemill.streaming.state import fenced, freshness, next_concurrency, recovery_state


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(("text", "n"), [("1,234", 1234), ("1.2K", 1200), ("3m likes", 3_000_000), (" 12", 12), ("24 likes", 24), ("many", None), ("", None), (None, None), ("2B", 2_000_000_000)])
def test_short_numbers(spark, text, n):
    assert one(spark, text, short_number) == n
    assert one(spark, text, likes) == (n or 0)


@pytest.mark.parametrize(
    ("url", "code", "kind"),
    [("https://x.example/p/Ab_-1/", "Ab_-1", "p"), ("HTTPS://X.example/REELS/q9?x=1", "q9", "reel"), (" https://m.x.example/some.one/reel/Zz9/ ", "Zz9", "reel"), ("https://x.example/", None, None), (None, None, None)],
)
def test_addresses(spark, url, code, kind):
    assert (one(spark, url, shortcode), one(spark, url, post_kind)) == (code, kind)


def test_handles_and_equality(spark):
    assert [one(spark, x, handle) for x in ("@Ann.B", "https://x.example/Ann_b/", "https://x.example/p/xyz/", "")] == ["ann.b", "ann_b", None, None]
    df = spark.createDataFrame([(100.0, 140.0), (100.0, 160.0), (1000.0, 1080.0), (1000.0, 1100.0)], "a double, b double")
    assert [r[0] for r in df.select(roughly_equal(F.col("a"), F.col("b"))).collect()] == [True, False, True, False]


def test_text_functions(spark):
    f = lambda x, g: one(spark, x, g)
    assert f("a  b\n c ", T.collapse) == "a b c" and f(None, T.collapse) == ""
    assert f("See https://x.example/a?b=1 @ann.b #tag don't!", T.plain) == "See don't"
    assert f("The 'puppy' and 123 walks", T.tokens) == ["puppy", "walks"]
    assert f("hi @Ann.B and a@b.c @ann.b", T.mentions) == ["ann.b"]
    assert f("#One &#39; #two#three", T.hashtags) == ["one", "two"]
    assert f("👩‍🦰🐶🐶 ok 🇫🇷", T.emojis) == ["👩‍🦰", "🐶", "🐶", "🇫🇷"]
    assert f("👩‍🦰❤️", T.without_emoji) == ""
    df = spark.createDataFrame([(["a", "a"],), (["a", "b"],), ([],)], "x array<string>")
    assert [r[0] for r in df.select(T.repeats(F.col("x"))).collect()] == [True, False, False]
    assert [r[0] for r in df.select(T.ngrams(F.col("x"), 2)).collect()] == [["a a"], ["a b"], []]
    assert f("I eat well", lambda c: T.has_any(c, ["eat"])) and not f("great", lambda c: T.has_any(c, ["eat"]))


def test_salvage_is_a_prefix_at_every_cut():
    rows = [{"index": 1, "problem": 'a "quoted" {brace}'}, {"index": 2, "problem": "b\\"}, {"index": 3}]
    whole = "```json\n" + json.dumps({"signals": rows}) + "\n```"
    for n in range(len(whole) + 1):
        got = salvage_array(whole[:n], "signals")
        assert got == rows[: len(got)]
    assert salvage_array(whole, "signals") == rows
    assert salvage_array('[{"a": 1}, {"b": oops}, {"c": 3}]') == [{"a": 1}, {"c": 3}]
    assert salvage_array("no array", "signals") == [] and salvage_array(None) == []
    assert loose_json('Sure: {"a": 1} there') == {"a": 1} and loose_json("nothing") is None


def test_keyed(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "z")], "k string, v int, s string")
    assert sorted(map(tuple, latest_by_key(df, ["k"], ["v"]).collect())) == [("a", 2, "y"), ("b", None, "z")]
    assert latest_by_key(df.limit(0), ["k"], ["v"]).count() == 0
    assert sorted(map(tuple, first_claims(df.where("v IS NOT NULL"), "k", ["v"]).collect())) == [("a", 1, "x")]
    old = spark.createDataFrame([("p", "partial", 5, "w1"), ("q", "complete", 9, "w1")], "post string, status string, captured int, worker string")
    new = spark.createDataFrame([("p", "complete", 3, "w2"), ("q", "failed", 20, "w2"), ("r", "queued", 0, "w2")], old.schema)
    got = {r.post: tuple(r)[1:] for r in merge_states(old, new, "post", highest=("captured",)).collect()}
    assert got == {"p": ("complete", 5, "w2"), "q": ("complete", 20, "w1"), "r": ("queued", 0, "w2")}


def test_ranking_and_intervals(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "a"), ("h", "c")], "g string, v string")
    assert sorted(map(tuple, top_values(df, ["g"], "v", 1).collect())) == [("g", "a", 2, 1), ("h", "c", 1, 1)]
    assert [r.v for r in top_values(df, [], "v", 2).orderBy("rank").collect()] == ["a", "b"]
    from tidemill.operators.ranking import grouped_quantiles

    import numpy as np

    r = np.random.default_rng(3)
    values = {"a": r.uniform(-1, 1, 500), "b": np.round(r.uniform(0, 0.01, 77), 4), "c": np.array([0.5]), "d": np.array([1.0, -1.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs] + [("a", None), ("e", None)], "k string, x double")
    got = {(x.k, x.p): x.q for x in grouped_quantiles(df, "k", "x", (0.25, 0.5, 0.9), -1.0, 1.0, bins=64).collect()}
    assert set(got) == {(g, p) for g in "abcd" for p in (0.25, 0.5, 0.9)} and all(abs(q - np.quantile(values[g], p)) < 1e-9 for (g, p), q in got.items())
    day = 86400
    left = spark.createDataFrame([(1, 0), (2, 10 * day), (3, None)], "k int, a bigint")
    right = spark.createDataFrame([("x", 7 * day), ("y", 3 * day), ("z", 17 * day + 1)], "e string, b bigint")
    pairs = {(r.k, r.e) for r in within_days(left, right, "a", "b", 7).collect()}
    assert pairs == {(1, "x"), (1, "y"), (2, "x"), (2, "y")}
    assert {(r.k, r.e) for r in nearest(left, right, "k", "a", "b", "e", 7).collect()} == {(1, "y"), (2, "x")}


def test_diverse_matches_greedy(spark):
    import random

    r = random.Random(4)
    rows = [("t", f"i{i:03d}", f"p{r.randrange(12)}", f"a{r.randrange(40)}", float(r.randrange(50))) for i in range(300)]
    df = spark.createDataFrame(rows, "topic string, item string, post string, author string, score double")
    got = [(x.place, x.item) for x in select_diverse(df, "topic", "item", "post", "author", "score", 6).orderBy("place").collect()]
    chosen, posts, authors = [], set(), set()
    for _, i, p, a, _s in sorted(rows, key=lambda x: (-x[4], x[1])):
        if len(chosen) < 6 and p not in posts and a not in authors:
            chosen.append(i)
            posts.add(p), authors.add(a)
    assert got == list(enumerate(chosen, 1))


def test_providers(spark):
    rows = [(f"c{i:02d}", i % 7, "I wish it had never happened" if i % 3 == 0 else "nice") for i in range(40)]
    df = spark.createDataFrame(rows, "comment_id string, likes bigint, text string")
    b = numbered_batches(df, [F.desc("likes"), F.asc("comment_id")], size=10).cache()
    assert b.count() == 40 and b.select("batch", "index").distinct().count() == 40 and b.agg(F.max("index")).first()[0] <= 10
    found = extract_signals(b, "text", RuleProvider())
    invented = found.unionByName(spark.createDataFrame([("0-0", 99, "x", None), ("nowhere", 1, "x", None)], found.schema))
    assert {r.comment_id for r in resolve_pointers(invented, b).collect()} == {c for c, _, t in rows if t != "nice"}
    tries, waits = [], []

    def bad(x):
        tries.append(1)
        raise OSError

    assert with_retries(bad, fail=False, sleep=waits.append)([]) == '{"signals": []}' and len(tries) == 3 and waits == [1.5, 3.0]
    with pytest.raises(OSError):
        with_retries(bad, sleep=waits.append)([])


def test_vectors(spark):
    docs = [(1, ["cat", "purr", "milk"]), (2, ["cat", "purr"]), (3, ["dog", "bark"]), (4, ["dog", "bark", "bone"]), (5, ["dog"]), (6, [])]
    v = tfidf(spark.createDataFrame(docs, "d int, t array<string>"), "d", "t", min_df=1, max_df_share=1.0)
    lengths = {r.d: r.n for r in v.groupBy("d").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()}
    assert set(lengths) == {1, 2, 3, 4} and all(abs(x - 1) < 1e-9 for x in lengths.values())
    got, centers = spherical_kmeans(v, "d", k=4)
    assert got.count() == 4 and len(centers) == 4
    by = {r.d: r.cluster for r in got.collect()}
    assert {by[1], by[2]}.isdisjoint({by[3], by[4]})
    assert spherical_kmeans(v.limit(0), "d", k=3)[0].count() == 0
    from tidemill.operators.vectors import center_terms, cluster_label, strided_seeds

    wide = spark.range(1000).select(F.format_string("%04d", F.pmod(F.col("id") * 7919, F.lit(1000))).alias("d"))
    assert [r.d for r in strided_seeds(wide, "d", 4)] == ["0000", "0250", "0500", "0750"]
    assert center_terms([{"b": 0.5, "a": 0.5, "c": 0.00001, "d": 0.9}], 2) == [[("d", 0.9), ("a", 0.5)]]
    assert cluster_label([], ["x y"], "t1") == "x y" and cluster_label([], [], "t1") == "t1"


def test_bundles(spark, tmp_path):
    (tmp_path / "comments.jsonl").write_text('{"comment_id": "c1", "comment_text": "hi", "extra": 1}\n\n{"comment_id": "c2", "comment_likes": "1.2K"}\n')
    (tmp_path / "manifest.json").write_text(json.dumps({"type": "split_bundle", "files": {"comments": "comments.ndjson"}}))
    b = read_bundle(spark, str(tmp_path / "manifest.json"))
    got = {r.comment_id: r for r in b["comments"].collect()}
    assert got["c1"].comment_author == "unknown" and got["c1"].comment_likes == "0" and got["c2"].comment_text == "" and b["posts"].count() == 0
    (tmp_path / "bad.ndjson").write_text("{oops\n")
    with pytest.raises(Exception):
        read_lines(spark, str(tmp_path / "bad.ndjson"), "comments").collect()
    (tmp_path / "queue.json").write_text(json.dumps({"type": "queue", "queue": [{"shortcode": "a"}, {"shortcode": "b", "position": 7}]}))
    assert [(r.shortcode, r.position, r.status) for r in read_bundle(spark, str(tmp_path / "queue.json"))["post_queue"].collect()] == [("a", 1, "queued"), ("b", 7, "queued")]
    (tmp_path / "one.json").write_text(json.dumps({"comments": [{"comment_id": "c9"}], "posts": [{"shortcode": "s", "status": "complete"}]}))
    one_doc = read_bundle(spark, str(tmp_path / "one.json"))
    assert one_doc["comments"].first().comment_id == "c9" and one_doc["posts"].first().attempts == 0 and one_doc["events"].count() == 0
    m = write_bundle({"comments": b["comments"]}, str(tmp_path / "out"))
    assert m["counts"] == {"comments": 2}
    again = read_bundle(spark, str(tmp_path / "out/manifest.json"))["comments"]
    assert sorted(map(str, again.collect())) == sorted(map(str, b["comments"].collect()))


def test_csv_and_report(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", all', ["a", "b"], None), ("x\ny", [], 3)], "s string, t array<string>, n int").coalesce(1)
    write_csv(df, str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("*.csv")).read_text()
    assert text.startswith("s,t,n\n") and '"say ""hi"", all",a|b,' in text and '"x\ny",,3' in text
    assert "| say" in write_report([("Part", df, 5)], str(tmp_path / "r.md")) and (tmp_path / "r.md").exists()


PAGE = """<meta property="og:title" content="A walk"><a href="/p/AAA/">x</a><a href='https://h.example/ann/reels/BBB/?a=1'>y</a><a href="/p/AAA/?again">z</a>
<ul><li><a href="/Ann/">ann</a><span>what a dog</span><ul><li><a href="/bob/">bob</a> indeed so</li></ul></li></ul><script>var li = "<li>";</script>"""


def test_pages(spark):
    p = parse_page(PAGE)
    assert p["caption"] == "A walk" and [(c["author"], c["text"], c["depth"]) for c in p["comments"]] == [("ann", "what a dog", 0), ("bob", "indeed so", 1)] and [c["parent"] for c in p["comments"]] == [None, 0]
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "id int, html string")
    assert [(r.shortcode, r.kind, r.position) for r in linked_posts(df, "id", "html").orderBy("position").collect()] == [("AAA", "p", 1), ("BBB", "reel", 2)]
    got = df.select("id", page_record("html").alias("r")).orderBy("id").collect()
    assert got[0].r.caption == "A walk" and got[1].r.comments == []


def test_state_rules(spark):
    ages = [(45, True), (90, True), (165, True), (10, False)]
    df = spark.createDataFrame(ages, "age int, running boolean")
    assert [r[0] for r in df.select(recovery_state(F.col("running"), F.col("age"))).collect()] == ["recent", "recent", "stale", "not_running"]
    assert [r[0] for r in df.select(freshness(F.col("age"))).collect()] == ["quiet", "quiet", "silent", "fresh"]
    m = spark.createDataFrame([("w", "s1"), ("w", "s0"), ("w", None), ("v", "s1")], "worker string, session string")
    a = spark.createDataFrame([("w", "s1")], "worker string, active string")
    assert sorted((str(r.worker), str(r.session), r.accepted) for r in fenced(m, a, "worker", "session").collect()) == [("v", "s1", False), ("w", "None", True), ("w", "s0", False), ("w", "s1", True)]
    allowed, stable = next_concurrency(5, 0, 10, 3)
    assert (allowed, stable) == (3, 0)
    for _ in range(3):
        allowed, stable = next_concurrency(allowed, stable, 10, 0)
    assert allowed == 5 and next_concurrency(1, 0, 4, 1) == (1, 0)


def test_streaming(spark, tmp_path):
    src, store, rejected = (str(tmp_path / x) for x in ("in", "store", "rejected"))
    (tmp_path / "in").mkdir()
    msg = lambda c, s, t, n: json.dumps({"comment_id": c, "post": "p", "author": "a", "text": "t", "likes": n, "session": s, "worker": "w", "seen_at": t})
    (tmp_path / "in/1.json").write_text("\n".join([msg("c1", "s1", "2024-01-01T00:00:00", 1), msg("c1", "s1", "2024-01-01T00:01:00", 5), msg("c2", "s0", "2024-01-01T00:02:00", 1)]))
    active = spark.createDataFrame([("w", "s1")], "worker string, active string")
    run = lambda: upsert_batches(read_messages(spark, src), store, rejected, active, str(tmp_path / "cp")).awaitTermination()
    run()
    (tmp_path / "in/2.json").write_text("\n".join([msg("c1", "s1", "2024-01-01T00:00:30", 3), msg("c3", "s1", "2024-01-01T00:05:00", 2)]))
    run()
    assert sorted((r.comment_id, r.likes) for r in current(spark, store).collect()) == [("c1", 5), ("c3", 2)]
    assert [r.comment_id for r in spark.read.parquet(rejected).collect()] == ["c2"]
    for name, df, mode in (("u", unique_messages(read_messages(spark, src)), "append"), ("n", windowed_counts(read_messages(spark, src)), "complete")):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / f"cp{name}")).start()
        q.awaitTermination()
    assert spark.table("u").count() == 3 and spark.table("n").agg(F.sum("n")).first()[0] == 5
