"""The streaming store's compaction and leases by event time."""

import json
import os

from tidemill.streaming.ingest import current, leases, post_counts, read_messages, upsert_batches


def message(c, post, at, likes=1, session="s1"):
    return json.dumps({"comment_id": c, "post": post, "author": "a", "text": "t", "likes": likes, "session": session, "worker": "w", "seen_at": at})


def test_store_compacts(spark, tmp_path):
    src, store = tmp_path / "in", tmp_path / "store"
    src.mkdir()
    active = spark.createDataFrame([("w", "s1")], "worker string, active string")
    for n in range(5):
        (src / f"{n}.json").write_text(message("c1", "p", f"2024-01-01T00:0{n}:00", n) + "\n" + message(f"d{n}", "p", "2024-01-01T00:00:00", 1, "s1" if n % 2 else "old"))
        upsert_batches(read_messages(spark, str(src)), str(store), str(tmp_path / "rejected"), active, str(tmp_path / "cp"), compact=2).awaitTermination()
    assert sorted((r.comment_id, r.likes) for r in current(spark, str(store)).collect()) == [("c1", 4), ("d1", 1), ("d3", 1)]
    assert sorted(p.name for p in store.iterdir() if "=" in p.name) == ["base=3", "delta=4"]
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 3 and current(spark, str(tmp_path / "none")) is None


def test_leases_end_by_event_time(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    run = lambda name, df, mode: df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start().awaitTermination()
    (src / "0.json").write_text(message("c1", "p", "2024-01-01T00:00:00", 5) + "\n" + message("c2", "q", "2024-01-01T00:01:00", 0))
    (src / "1.json").write_text(message("c3", "r", "2024-01-01T02:00:00", 1))
    (src / "2.json").write_text(message("c4", "r", "2024-01-01T02:01:00", 1))
    for n in range(3):
        os.utime(src / f"{n}.json", (1e9 + n, 1e9 + n))  # read in this order
    run("leased", leases(read_messages(spark, str(src), files=1)), "append")
    got = {(r.post, r.status) for r in spark.table("leased").collect()}
    assert {("p", "in_progress"), ("q", "in_progress"), ("r", "in_progress"), ("p", "partial"), ("q", "queued")} == got  # r's lease still runs
    run("counted", post_counts(read_messages(spark, str(src))), "complete")
    assert {(r.post, r.n) for r in spark.table("counted").collect()} == {("p", 1), ("q", 1), ("r", 2)}
