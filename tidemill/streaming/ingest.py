"""Structured Streaming ingest of captured comments: fencing, deduplication and keyed upsert."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.keyed import latest_by_key
from tidemill.streaming.state import LEASE_S, fenced

MESSAGE = "comment_id string, post string, author string, text string, likes bigint, session string, worker string, seen_at timestamp"


def read_messages(spark: SparkSession, folder: str, schema: str = MESSAGE, files: int = 100) -> DataFrame:
    """A stream of JSON lines; each micro-batch reads at most `files` files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(folder)


def unique_messages(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """At-least-once messages once: state is kept as long as the watermark lets copies come."""
    return stream.withWatermark("seen_at", delay).dropDuplicatesWithinWatermark(["comment_id"])


def windowed_counts(stream: DataFrame, window: str = "10 minutes", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Messages by post and event-time window (an extension)."""
    w = F.window("seen_at", window, slide) if slide else F.window("seen_at", window)
    return stream.withWatermark("seen_at", delay).groupBy(w, "post").agg(F.count("*").alias("n"), F.sum("likes").alias("likes"))


def upsert_batches(stream: DataFrame, store: str, rejected: str, active: DataFrame, checkpoint: str, compact: int = 20):
    """Writes a stream into a keyed store: a base of one row a key, and a delta for each batch since.

    Each batch is fenced against the active sessions; rejected messages go to `rejected`. A batch writes its own
    rows only; every `compact` batches the deltas are merged into a new base, and what it replaces is removed
    once it is whole. Folders are named by the batch, so a batch that runs again rewrites its own.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        judged = fenced(batch, active, "worker", "session").persist()
        judged.where("NOT accepted").drop("active", "accepted").write.mode("overwrite").parquet(f"{rejected}/batch={number}")
        new = latest_by_key(judged.where("accepted").drop("active", "accepted"), ["comment_id"], ["seen_at"])
        new.write.mode("overwrite").parquet(f"{store}/delta={number}")
        judged.unpersist()
        if (number + 1) % compact == 0:
            current(spark, store).write.mode("overwrite").parquet(f"{store}/base={number}")
            fs, _ = _fs(spark, store)
            for kind, n, p in _parts(spark, store):
                if n < number or (kind == "delta" and n == number):
                    fs.delete(p, True)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _fs(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _parts(spark: SparkSession, store: str) -> list[tuple]:
    """(kind, batch, path) of the whole bases and deltas of a store."""
    fs, path = _fs(spark, store)
    if not fs.exists(path):
        return []
    out = []
    for s in fs.listStatus(path):
        kind, _, n = s.getPath().getName().partition("=")
        if n.isdigit() and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            out.append((kind, int(n), s.getPath()))
    return out


def current(spark: SparkSession, store: str) -> DataFrame | None:
    """The store's rows: its last whole base and the deltas since, each key's latest; None if there is none."""
    parts = _parts(spark, store)
    base = max((n for kind, n, _ in parts if kind == "base"), default=-1)
    paths = [p.toString() for kind, n, p in parts if (kind == "base" and n == base) or (kind == "delta" and n > base)]
    return latest_by_key(spark.read.parquet(*paths), ["comment_id"], ["seen_at"]) if paths else None


def post_counts(stream: DataFrame) -> DataFrame:
    """Messages and likes of each post so far, kept up to date (complete or update mode)."""
    return stream.groupBy("post").agg(F.count("*").alias("n"), F.sum("likes").alias("likes"))


LEASE = "post string, status string, captured bigint, at timestamp"


def leases(stream: DataFrame, lease_s: int = LEASE_S, delay: str = "1 minute") -> DataFrame:
    """(post, status, captured, at): a lease begins with a post's message and ends `lease_s` of event time after its last.

    A lease that ends leaves the post partial if anything was captured, else queued again. Messages give likes as
    what was captured. State is one small row for each leased post.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, batches, state):
        if state.hasTimedOut:
            captured, last = state.get
            state.remove()
            yield pd.DataFrame({"post": [key[0]], "status": ["partial" if captured > 0 else "queued"], "captured": [captured], "at": [pd.Timestamp(last, unit="ms")]})
            return
        fresh = not state.exists
        captured, last = (0, 0) if fresh else state.get
        for b in batches:
            captured += int(b["likes"].fillna(0).sum())
            last = max(last, int(b["seen_at"].max().timestamp() * 1000))
        state.update((captured, last))
        state.setTimeoutTimestamp(max(last + lease_s * 1000, state.getCurrentWatermarkMs() + 1))
        if fresh:
            yield pd.DataFrame({"post": [key[0]], "status": ["in_progress"], "captured": [captured], "at": [pd.Timestamp(last, unit="ms")]})

    return stream.withWatermark("seen_at", delay).groupBy("post").applyInPandasWithState(step, LEASE, "captured bigint, last bigint", "append", GroupStateTimeout.EventTimeTimeout)
