"""The chains of events, themes, bundles and the engine's front on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from tidemill.engine import Corpus, Engine, Lexicon, filtered, main, options
from tidemill.operators import themes as H
from tidemill.operators.keyed import fold_states
from tidemill.operators.linking import confidence, link_score, reason_slug
from tidemill.operators.skew import lookup
from tidemill.plans.features import TENSIONS, confidence_score, risk_flags, short_affective, tag_names
from tidemill.sources.articles import articles, cache_key
from tidemill.sources.bundles import append_events, load_checkpoint, queue_of, read_bundle, save_checkpoint, write_bundle, write_json, write_parts

ROOT = "/root/testdata/sf0.001"


def test_lookup_with_hot_and_null_keys(spark):
    left = spark.createDataFrame([(1, i) for i in range(500)] + [(k, -k) for k in range(2, 60)] + [(None, 7), (99, 8)], "k int, x int")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(60)], "k int, v string")
    for how in ("inner", "left"):
        for sent in (0, 1000):
            got = sorted(map(str, lookup(left, right, ["k"], how, part=0.1, sent=sent).select("k", "x", "v").collect()))
            assert got == sorted(map(str, left.join(right, ["k"], how).select("k", "x", "v").collect()))
    assert lookup(left.limit(0), right, ["k"]).count() == 0
    with pytest.raises(ValueError):
        lookup(left, right, ["k"], "full")


def test_link_points(spark):
    rows = [  # days, entities, located, captions, phrases, tags, mentioned, markers, captured, likes, salience, points
        (1.0, 1, False, 0, 0, 0, False, 0, 0.0, 0.0, 0.0, 33), (0.5, 9, False, 0, 0, 0, False, 0, 0.0, 0.0, 0.0, 57), (3.0, 9, False, 0, 0, 0, False, 0, 0.0, 0.0, 0.0, 57), (7.0, 9, False, 0, 0, 0, False, 0, 0.0, 0.0, 0.0, 49),
        (7.01, 9, True, 3, 3, 2, True, 2, 9.0, 9.0, 0.9, 0), (3.0, 0, True, 5, 5, 5, True, 2, 1.5, 1.5, 0.75, 18 + 12 + 24 + 24 + 20 + 8 + 7 + 5 + 5 + 6), (7.0, 1, False, 0, 0, 0, True, 1, 1.49, 1.0, 0.7, 18),
    ]
    names = ["days", "entities", "located", "captions", "phrases", "tags", "mentioned", "markers", "captured", "likes", "salience", "want"]
    df = spark.createDataFrame(rows, names)
    assert all(r.got == r.want for r in df.withColumn("got", link_score(*[F.col(c) for c in names[:-1]])).collect())
    df = spark.createDataFrame([(s, e) for s in (24, 25, 41, 42, 64, 65) for e in (True, False)], "s int, e boolean")
    assert [r[0] for r in df.select(confidence(F.col("s"), F.col("e"))).collect()] == ["temporal_only"] * 2 + ["weak", "temporal_only"] * 2 + ["moderate", "temporal_only"] * 2 + ["strong", "temporal_only"]
    assert spark.range(1).select(reason_slug("x", F.lit("#a b"))).first()[0] == "x:hashtag_a_b"


def test_features(spark):
    df = spark.createDataFrame([("thank you so much 🙏", ["🙏"]), ("", ["🔥"]), ("so cute", []), ("the vet told us about pain and more", [])], "t string, e array<string>")
    got = df.select(tag_names(F.col("t"), F.col("e"), {"thanks": (["thank"], ["🙏"]), "pain": (["pain"], [])}).alias("g"), short_affective(F.col("t"), F.col("e")).alias("s")).collect()
    assert [(r.g, r.s) for r in got] == [(["thanks"], True), ([], True), ([], True), (["pain"], False)]
    p = spark.createDataFrame([(0.2, 0.1, 0.4, 0.6, 2, 10, 100, 0.5)], "top1 double, top3 double, prolific double, top_post double, posts int, authors int, size int, coherence double")
    r = p.select(risk_flags(F.col("coherence") - 0.2, F.lit(0.4)).alias("f"), confidence_score(F.col("size"), F.col("coherence"), F.col("posts"), F.lit(0.1), F.lit(2), F.col("top1"), F.col("top3"), F.col("prolific"), F.col("top_post")).alias("s")).first()
    assert r.f == ["high_single_author", "repeat_commenters", "single_post", "thin_posts", "thin_authors", "low_coherence", "high_noise"]
    assert abs(r.s - (28 + 28 + 1 + 4 - 2.2 - 12 - 8 - 5)) < 1e-9 and len(TENSIONS) == 4


def test_themes(spark):
    s = spark.createDataFrame([(f"s{i}", f"c{i % 15}", i, "ab"[i % 2] + f"{i % 3}", f"text a{i % 3} b") for i in range(40)], "signal_id string, comment_id string, likes bigint, label string, text string")

    class Odd(H.RuleThemes):
        def __call__(self, task, rows):
            out = super().__call__(task, rows)
            if task == "cluster":
                out[0]["signal_ids"].append("invented")
            if task == "merge":  # claims an unknown candidate, claims one twice and forgets the last theme
                out = [{**t, "candidate_ids": [*t["candidate_ids"], "nobody", out[0]["candidate_ids"][0]]} for t in out[:-1]]
            return out

    c = H.candidate_themes(s, Odd())
    assert {r.signal_id for r in c.collect()} == {f"s{i}" for i in range(40)}
    t = H.merged_themes(c, Odd())
    held = {}
    for r in t.collect():
        held.setdefault(r.signal_id, []).append(r.theme_id)
    assert set(held) == {f"s{i}" for i in range(40)} and all(len(v) == 1 for v in held.values()) and any(v[0].startswith("o_") for v in held.values())
    table = H.theme_table(H.merged_themes(c, H.RuleThemes()), s).collect()
    assert sum(r.signals for r in table) == 40 and len(table) == 6 and all(len(r.quotes) == len(set(r.quotes)) <= 6 for r in table)
    found = H.angles(spark.createDataFrame([("t1", "a1 / x"), ("t2", "zz / x")], "theme_id string, label string"), H.RuleThemes())
    b = H.borrowed(found, spark.createDataFrame([("t1", "c1", "so a1", 3), ("t1", "c2", "a1!", 9)], "theme_id string, comment_id string, text string, likes bigint")).collect()
    assert len(b) == 12 and {(r.theme_id, r.source_comment_id, r.source_likes, r.verified) for r in b} == {("t1", "c2", 9, True), ("t2", None, None, False)}


def test_stages_resume(spark, tmp_path):
    made = []
    make = lambda: made.append(1) or spark.range(3).toDF("x")
    st = H.Stages(spark, str(tmp_path / "st"))
    assert st.run("a", make).count() == 3 and st.run("a", make).count() == 3 and len(made) == 1
    assert H.Stages(spark, str(tmp_path / "st"), fresh=True).run("a", make).count() == 3 and len(made) == 2
    st.done()
    assert not (tmp_path / "st").exists()


def test_bundle_layouts_of_any_size(spark, tmp_path):
    many = 45_000
    (tmp_path / "queue.json").write_text(json.dumps({"type": "queue", "queue": [{"shortcode": f"s{i:08d}", "post_url": "https://x.example/p/" + "y" * 60} for i in range(many)] + [{"position": 3}]}))
    assert (tmp_path / "queue.json").stat().st_size > 4 << 20
    q = read_bundle(spark, str(tmp_path / "queue.json"))["post_queue"]
    assert q.count() == many and q.agg(F.max("position")).first()[0] == many
    (tmp_path / "one.json").write_text(json.dumps({"comments": [{"comment_id": "c"}], "posts": [{"shortcode": "s", "post_url": "u"}]}))
    b = read_bundle(spark, str(tmp_path / "one.json"))
    for mode in ("bundle", "single"):
        m = write_bundle(b, str(tmp_path / mode), mode=mode, checkpoint={"status": "idle"})
        assert m["counts"]["comments"] == 1 and m["files"]["post_urls"] and json.loads((tmp_path / mode / "checkpoint.json").read_text()) == {"status": "idle"}
        assert read_bundle(spark, str(tmp_path / mode / "manifest.json"))["comments"].first().comment_id == "c"
    assert set(write_bundle({"post_queue": q}, str(tmp_path / "q"), mode="queue")["counts"]) == {"post_queue"}
    posts = spark.createDataFrame([("b", 1), ("a", 2), ("z", 3)], "shortcode string, position int")
    assert sorted(map(tuple, queue_of(posts, spark.createDataFrame([("a", 9), ("b", 8)], "shortcode string, position int")).collect())) == [("a", 9), ("b", 8)]


def test_small_sinks(spark, tmp_path):
    assert write_json(spark, {"é": [1]}, str(tmp_path / "x/y.json")).endswith("}\n") and "é" in (tmp_path / "x/y.json").read_text()
    assert write_parts(spark.range(5).toDF("a"), str(tmp_path / "p"), [F.col("a").alias("b")], 2) == 5 and write_parts(spark.range(0), str(tmp_path / "e")) == 0
    assert load_checkpoint(spark, str(tmp_path / "c.json")) is None
    assert save_checkpoint(spark, str(tmp_path / "c.json"), {"a": 1}, "2024-01-01T00:00:00Z") == load_checkpoint(spark, str(tmp_path / "c.json"))
    e = spark.createDataFrame([("1", "t", "x", None)], "id string, ts string, type string, detail string")
    append_events(e, str(tmp_path / "log")), append_events(e, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    asked, waits = [], []
    fetch = lambda *a: asked.append(a) or '{"articles": ' + json.dumps([{"n": i} for i in range(12)]) + "}"
    for _ in range(2):
        assert len(articles(spark, str(tmp_path / "art"), "q", "a", "b", fetch, waits.append)) == 8
    assert len(asked) == 1 and waits == [5.5] and articles(spark, str(tmp_path / "art"), "other", "a", "b") == [] and len(cache_key("q", "a", "b")) == 16
    assert articles(spark, str(tmp_path / "art"), "bad", "a", "b", lambda *a: "<html>", waits.append) == []


def test_fold_states(spark):
    df = spark.createDataFrame([("p", "b1", "partial", 5, "w1"), ("p", "b2", "failed", 9, "w2"), ("p", "b3", "complete", 2, "w3"), ("p", "b4", "complete", 1, "w4")], "post string, batch string, status string, captured int, worker string")
    assert [tuple(r) for r in fold_states(df, "post", "batch", kept=("batch",), highest=("captured",)).collect()] == [("p", "b1", "complete", 9, "w3")]


def test_engine(spark, tmp_path):
    e = Engine(Corpus(spark, ROOT, most_comments=7), Lexicon(topics={"dogs": ["dog"]}))
    assert {t for r in e.run("scored").select("topics").distinct().collect() for t in r.topics} == {"dogs"} and e.run("comments").count() == 7
    assert "post_summary" in e.stages()
    with pytest.raises(ValueError):
        e.run("nothing")
    assert options(["x", "--input", "~/a", "--out", "b"]).input.endswith("/a") and "~" not in options(["x", "--input", "~/a", "--out", "b"]).input
    path = main(["collection_status_quality", "--input", ROOT, "--out", str(tmp_path), "--format", "json", "--limit", "2"], spark)
    assert spark.read.json(path).count() == 2
    df = spark.createDataFrame([("a", "Good Dog"), ("b", "good cat")], "segment string, text string")
    assert filtered(df, said="GOOD").count() == 2 and filtered(df, "a", "dog").count() == 1 and filtered(df, "b", "dog").count() == 0
