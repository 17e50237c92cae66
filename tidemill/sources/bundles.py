"""Readers and writers of captured bundles: one document, a split folder with a manifest, or a queue."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.schemas import DEFAULTS, ENTITIES

EXTENSIONS = ("ndjson", "jsonl")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def read_small_json(spark: SparkSession, path: str):
    """A manifest or another small document, read by the driver."""
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def with_defaults(df: DataFrame, entity: str) -> DataFrame:
    values = DEFAULTS.get(entity, {})
    return df.select(*[F.coalesce(c, F.lit(values[c])).alias(c) if c in values else F.col(c) for c in df.columns])


def read_lines(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """JSON lines of an entity: blank lines are skipped, a malformed line fails the read, other columns are dropped.

    If the file is missing, its sibling of the other extension is read; if that is missing too, the
    result is empty.
    """
    for p in _siblings(path):
        if exists(spark, p):
            return with_defaults(spark.read.schema(ENTITIES[entity]).option("mode", "FAILFAST").json(p), entity)
    return spark.createDataFrame([], ENTITIES[entity])


def _siblings(path: str) -> list[str]:
    stem, _, ext = path.rpartition(".")
    return [path, *(f"{stem}.{e}" for e in EXTENSIONS if e != ext)] if ext in EXTENSIONS else [path]


_HEAD = "type string, files map<string,string>, queue array<string>"


def read_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The entities of a bundle, whatever its layout and size: a manifest naming files, a queue, or one document.

    Which it is, is told by its fields, read by Spark; only a manifest's names of files come to the driver.
    """
    doc = spark.read.schema(_HEAD).option("multiLine", True).option("mode", "FAILFAST").json(path)
    head = doc.select("type", "files", F.col("queue").isNotNull().alias("listed")).first()
    if head is not None and head.files:
        return read_split(spark, path, {"files": head.files})
    if head is not None and (head.type == "queue" or head.listed):
        return read_queue(spark, path)
    return read_single(spark, path)


def read_split(spark: SparkSession, path: str, manifest: dict) -> dict[str, DataFrame]:
    folder = path.rpartition("/")[0]
    files = manifest.get("files", {})
    return {e: read_lines(spark, f"{folder}/{files[e]}", e) if files.get(e) else spark.createDataFrame([], ENTITIES[e]) for e in ENTITIES}


def read_single(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """One JSON document with an array for each entity; missing arrays are empty."""
    schema = ", ".join(f"{e} array<struct<{s.replace(' ', ':').replace(',:', ',')}>>" for e, s in ENTITIES.items())
    doc = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return {e: with_defaults(doc.select(F.explode(e).alias("x")).select("x.*"), e) for e in ENTITIES}


def read_queue(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """A queue of posts to collect: all are queued, in the order given; posts without shortcode are left out."""
    doc = spark.read.schema("queue array<struct<shortcode:string,visible_index:int,position:int,post_url:string,post_kind:string>>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    rows = doc.select(F.posexplode("queue").alias("at", "q")).where("q.shortcode IS NOT NULL")
    place = F.coalesce(F.nullif("q.visible_index", F.lit(0)), F.nullif("q.position", F.lit(0)), F.col("at") + 1).cast("int")
    out = {e: spark.createDataFrame([], s) for e, s in ENTITIES.items()}
    out["post_queue"] = rows.select("q.shortcode", place.alias("position"), "q.post_url", "q.post_kind", F.lit("queued").alias("status"))
    return out


def queue_of(posts: DataFrame, queue: DataFrame | None = None, key: str = "shortcode") -> DataFrame:
    """Posts in the order of a queue, those not queued left out; without a queue, in the order of their places."""
    if queue is None:
        return posts
    return posts.drop("position").join(queue.select(key, "position"), key)


def capped(df: DataFrame, order: str, most: int | None) -> DataFrame:
    """The first rows of df in an order, or all (a bound that a user asks for)."""
    return df if most is None else df.orderBy(order).limit(most)


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_json(spark: SparkSession, value, path: str) -> str:
    """A small value as indented JSON with a newline at its end; folders are made."""
    text = json.dumps(value, indent=2, ensure_ascii=False, default=str) + "\n"
    _write(spark, path, text)
    return text


def write_parts(df: DataFrame, folder: str, columns: list | None = None, rows_a_file: int = 500_000) -> int:
    """JSON lines in parts of at most so many rows, of some columns or column expressions; returns the number of rows.

    An empty frame gives a folder without rows.
    """
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).option("ignoreNullFields", "false").json(folder)
    return df.sparkSession.read.schema(out.schema).json(folder).count()


def read_optional(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """JSON lines that may be missing: then there are no rows."""
    return read_lines(spark, path, entity)


def write_bundle(entities: dict[str, DataFrame], folder: str, note: str | None = None, mode: str = "bundle", checkpoint: dict | None = None) -> dict:
    """Writes a bundle and returns its manifest.

    mode "bundle": a folder of JSON lines for each entity, the addresses of posts, the checkpoint and a manifest
    with counts; "queue": the posts to collect alone, as queue.json in parts; "single": as "bundle", each entity
    in one file.
    """
    if mode not in ("bundle", "queue", "single"):
        raise ValueError("mode is bundle, queue or single")
    spark = next(iter(entities.values())).sparkSession
    if mode == "queue":
        entities = {"post_queue": entities["post_queue"]}
    elif "posts" in entities and "post_url" in entities["posts"].columns:
        entities = entities | {"post_urls": entities["posts"].select("post_url").where("post_url IS NOT NULL")}
    counts = {e: write_parts(df.coalesce(1) if mode == "single" else df, f"{folder}/{e}.ndjson", rows_a_file=0 if mode == "single" else 500_000) for e, df in entities.items()}
    files = {e: f"{e}.ndjson" for e in entities}
    if checkpoint is not None:
        write_json(spark, checkpoint, f"{folder}/checkpoint.json")
        files["checkpoint"] = "checkpoint.json"
    manifest = {"version": 3, "type": "split_bundle", "note": note, "files": files, "counts": counts}
    write_json(spark, manifest, f"{folder}/manifest.json")
    return manifest


def write_csv(df: DataFrame, folder: str, joiner: str = "|") -> None:
    """CSV with a header: quotes doubled, nulls empty, arrays of values joined."""
    flat = df.select(*[F.array_join(F.transform(f.name, lambda x: x.cast("string")), joiner).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in df.schema])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", "").csv(folder)


def write_report(sections: list[tuple[str, DataFrame, int]], path: str) -> str:
    """A Markdown report of the first rows of small tables; returns its text."""
    out = []
    for title, df, most in sections:
        rows = df.limit(most).collect()  # `most` rows
        out.append(f"## {title}\n")
        out.append("| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns))
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows]
        out.append("")
    text = "\n".join(out) + "\n"
    if sections:
        fs, p = _fs(sections[0][1].sparkSession, path)
        f = fs.create(p, True)
        f.write(bytearray(text.encode()))
        f.close()
    return text


def save_checkpoint(spark: SparkSession, path: str, value: dict, now: str) -> dict:
    """A checkpoint written with the time it was written at, which the caller gives."""
    value = value | {"updated_at": now}
    write_json(spark, value, path)
    return value


def load_checkpoint(spark: SparkSession, path: str) -> dict | None:
    """A checkpoint, or None if there is none."""
    return read_small_json(spark, path) if exists(spark, path) else None


def append_events(events: DataFrame, folder: str) -> None:
    """Events added to a log; the log is never rewritten. Columns as of the entity `events`."""
    events.write.mode("append").option("ignoreNullFields", "false").json(folder)
