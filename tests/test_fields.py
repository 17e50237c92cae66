from pyspark.sql import functions as F

from tidemill.functions import fields as P
from tidemill.functions import forms as N
from tidemill.streaming import state as S


def each(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_page_fields(spark):
    c = F.col
    rows = [("annVerified", "ann"), ("3d", "ann"), ("12 likes", "ann"), ("Reply", "ann"), ("View all 12 replies", "x"), ("what a dog", "ann"), ("", "ann"), (None, None), ("ann", "ann")]
    got = each(spark, rows, "t string, a string", P.is_comment_text(c("t"), c("a")), P.is_user_name(c("t")))
    assert got == [(False, True), (False, False), (False, False), (False, False), (False, False), (True, False), (False, False), (False, False), (False, True)]
    assert each(spark, [("ann.bVerified 3d  A walk", "ann.b"), ("A walk", None)], "t string, a string", P.caption_text(c("t"), c("a"))) == [("A walk",), ("A walk",)]
    assert each(spark, [("1,204 likes 1.2K comments and 7 x v2.0 0",), (None,)], "t string", P.short_numbers(c("t"))) == [([1204, 1200, 7],), ([],)]
    rows = [([5, 1000, 210, 33], 1010, 200), ([1000, 210], 1000, 210), ([], 1, 1)]
    assert each(spark, rows, "n array<bigint>, l bigint, m bigint", P.repost_count(c("n"), c("l"), c("m"))) == [(33,), (None,), (None,)]
    assert each(spark, [("1,234 Likes, 56 Comments - ann.b on Photogram: “x”",), ("x",)], "t string", P.author_in_description(c("t"))) == [("ann.b",), (None,)]
    d = P.displayed_comments(c("h"), c("b"), c("d"))
    rows = [(9, "View all 12 comments", ""), (0, "View all 1.2K comments", "3 Comments"), (None, "", "1 Likes, 3 Comments"), (None, None, None)]
    assert [tuple(x) for (x,) in each(spark, rows, "h bigint, b string, d string", d)] == [(9, "view_all_comments_button"), (1200, "view_all_comments_text"), (3, "og_description_mixed_platform"), (None, None)]
    rows = [("1,234 Likes, x", "", []), ("", "7 likes", []), ("", "", ["x", "1.5K likes"]), (None, None, None)]
    assert each(spark, rows, "d string, s string, p array<string>", P.like_count(c("d"), c("s"), c("p"))) == [(1234,), (7,), (1500,), (0,)]
    assert each(spark, [(["x", "1,204 likes"],), ([],)], "t array<string>", P.comment_likes(c("t"))) == [(1204,), (0,)]
    rows = [("Try again later", "/p/x", True), ("log in to see", "/p/x", False), ("log in to see", "/p/x", True), ("x", "/accounts/login/", True), ("", "/challenge/", True)]
    assert each(spark, rows, "t string, p string, a boolean", P.limitation(c("t"), c("p"), c("a"))) == [("rate_limited_try_again_later",), ("login_wall",), (None,), ("login_wall",), ("challenge_required",)]
    assert each(spark, [("net::ERR_FAILED",), ("Timeout",), ("",), ("x",)], "m string", P.navigation_error(c("m"))) == [("navigation_error:network",), ("navigation_error:timeout",), (None,), ("navigation_error:other",)]
    assert each(spark, [("/p/x/c/123/",), ("/p/x",)], "l string", P.native_id(c("l")), P.absolute(c("l"), "https://h.example")) == [("123", "https://h.example/p/x/c/123/"), (None, "https://h.example/p/x")]
    assert each(spark, [("",), ("a",), ("foobar",)], "t string", P.fnv1a(c("t"))) == [("811c9dc5",), ("e40c292c",), ("bf9cf968",)]
    a, b, other = each(spark, [("p", "Ann", "Hi"), ("p", "ann", "hi"), ("p", "ann", "ho")], "p string, a string, t string", P.comment_id(c("p"), c("a"), c("t"), F.lit(None)))
    assert a == b != other
    assert each(spark, [('"Stop X" — works well', 125, 7, 10, 3700)], "t string, x int, d int, n int, s int", P.without_formula(c("t")), P.progress(c("d"), c("n")), P.progress(c("d"), F.lit(0)), P.duration(c("s"))) == [("Stop X", 70, 0, "1h 01m")]
    assert each(spark, [("", "/ann/"), (" Bob ", "/x/"), ("", "/a/b/")], "t string, l string", P.user_name(c("t"), c("l"))) == [("ann",), ("Bob",), ("unknown",)]


def test_forms(spark):
    c = F.col("t")
    assert each(spark, [("ｆｉｎｅ ﬁt",), (None,)], "t string", N.nfkc(c), N.normal_text(c)) == [("fine fit", "fine fit"), (None, "")]
    assert each(spark, [("👩‍🦰a",), (None,)], "t string", N.graphemes(c)) == [(["👩‍🦰", "a"],), ([],)]
    assert "dog_face" in each(spark, [("hi 🐶",)], "t string", N.demojised(c))[0][0]
    assert each(spark, [("I eat at the vet, vets",)], "t string", N.hit_terms(c, ["eat", "vet", "great"])) == [(["eat", "vet"],)]
    assert each(spark, [("Golden light near Mill Park",)], "t string", N.caption_mode(c, ["harbor"])) == [("golden light near",)]
    assert each(spark, [("🐶",), ("12",), ("hello",), ("привет",), (None,)], "t string", N.language_hint(c)) == [("emoji_only",), ("und",), ("latin",), ("und_non_latin",), ("und",)]


def test_collector_rules(spark):
    m = spark.createDataFrame([("w", ""), ("w", " s1 "), ("w", "s0"), ("v", "s1"), ("u", None)], "worker string, session string")
    a = spark.createDataFrame([("w", "s1", True), ("v", "s1", False)], "worker string, active string, running boolean")
    assert {(r.worker, r.session): r.accepted for r in S.fenced(m, a, "worker", "session", "running").collect()} == {("w", ""): True, ("w", " s1 "): True, ("w", "s0"): False, ("v", "s1"): False, ("u", None): True}
    d = S.Discovery(no_new=3, stuck=2, max_rounds=9)
    assert [d.round(*x) for x in ((5, 10), (0, 10), (0, 50), (1, 50), (0, 50), (0, 51))] == [None] * 5 + ["profile_scroll_stuck"]
    assert S.Discovery().round(0, 1, "login_wall") == "profile_discovery_login_wall" and S.Discovery(max_posts=3).round(3, 1) == "max_posts_discovery_limit_3"
    k = S.Capture(target=10)
    assert k.snapshot(3, True, True, False, 1) is None and k.snapshot(10, True, True, False, 2) == "target_reached" and k.snapshot(3, True, True, False, 1, "login_wall") == "login_wall"
    k = S.Capture(no_new=2)
    assert [k.snapshot(3, False, False, True, 1) for _ in range(2)] == [None, "comments_exhausted_bottom_reached"]
    k = S.Capture(no_new=2)
    assert [k.snapshot(3, False, False, False, 1) for _ in range(6)][-1] == "partial_scroll_stalled_before_bottom" and S.Capture().snapshot(1, True, True, False, 480) == "max_post_runtime_reached"
    assert S.Capture(target=10, coverage=True).snapshot(5, True, True, False, 1) == "coverage_min_rate_reached" and S.Capture(coverage=True).snapshot(1, True, True, False, 240) == "coverage_max_runtime_reached"
    o = S.normalize_options({"preload_tabs": 9, "coverage_min_rate": 0, "post_step_s": "x", "max_post_s": 3, "max_posts": "7"})
    assert (o["preload_tabs"], o["coverage_min_rate"], o["post_step_s"], o["max_post_s"], o["max_posts"], o["mode"]) == (5, 0.5, 18.0, 30.0, 7, "full")
    assert S.normalize_checkpoint({"version": 1, "concurrency": {"effective": 3}, "x": 1})["concurrency"] == {"configured": 5, "effective": 3, "stable_batches": 0, "last_backoff_at": None} and S.normalize_checkpoint(None)["version"] == 3
    assert S.stripped_for_recovery({"posts": {}, "status": "x"}) == {"status": "x", "posts_omitted": True}
    known, found = spark.createDataFrame([("a",)], "shortcode string"), spark.createDataFrame([("a",), ("b",), ("b",)], "shortcode string")
    assert [tuple(r) for r in S.add_discovered(known, found).collect()] == [("b", "queued")]
    posts = spark.createDataFrame([("a", None, 5, None), ("b", 7, None, None)], "shortcode string, like_count bigint, target_comment_count bigint, target_comment_source string")
    details = spark.createDataFrame([("a", 3, 99, "og"), ("b", None, 9, "view_all_comments_text")], posts.schema)
    assert sorted((r.shortcode, r.like_count, r.target_comment_count) for r in S.hydrated(posts, details).collect()) == [("a", 3, 5), ("b", 7, 9)]
    raw = spark.createDataFrame([(["c"] * 7, None), (None, 9)], "comments_data array<string>, n bigint")
    assert [(len(r.comments_data or []), r.comments_data_truncated, r.comments_data_total) for r in S.compacted(raw, "comments_data", "n").collect()] == [(5, 2, 7), (0, 0, 9)]
    q = spark.createDataFrame([(None, None, "in_progress", None, None, 8, None, 1, "https://x.example/reels/AbC/"), ("bad code", None, None, None, None, None, None, None, "")], "shortcode string, post_kind string, status string, attempts int, target_comment_count bigint, displayed_comment_count bigint, visible_index int, position int, post_url string")
    from tidemill.functions.values import post_kind, shortcode

    got = S.normalize_queue(q, shortcode(F.col("post_url")), post_kind(F.col("post_url"))).collect()
    assert [(r.shortcode, r.post_kind, r.status, r.attempts, r.target_comment_count, r.position) for r in got] == [("AbC", "reel", "queued", 0, 8, 1)]
    c = spark.createDataFrame([("c1", "p", "x"), ("", "p", "x"), ("c2", None, "x")], "comment_id string, post_shortcode string, post_caption string")
    assert [tuple(r) for r in S.normalize_comments(c).collect()] == [("c1", "p")]
