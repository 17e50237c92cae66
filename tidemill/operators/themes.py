"""From signals to candidate themes, themes and angles by text providers; identifiers are kept and united by joins, never by the provider.

A provider answers a task, a short word, and rows, with rows; the built-in one works by rules, offline. What it
names must resolve: unknown identifiers are dropped, a candidate named twice stays with its first theme, and
candidates that no theme names become themes of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.keyed import first_claims
from tidemill.operators.ranking import top_k
from tidemill.session import cut

GROUPS, GROUP_MOST = 8, 5000
ANGLES = ("problem", "want", "proof", "objection", "story", "comparison")
PARTS = ("hook", "explanation", "solution", "social_proof", "call_to_action")


class ThemeProvider(Protocol):
    def __call__(self, task: str, rows: list[dict]) -> list[dict]:
        """Rows in answer to a task: cluster, merge, angles, structure, interpret or audit."""


class RuleThemes:
    """The same answers on every run: equal labels belong together."""

    def __call__(self, task: str, rows: list[dict]) -> list[dict]:
        if task in ("cluster", "merge"):
            key, ids = ("signal_id", "signal_ids") if task == "cluster" else ("candidate_id", "candidate_ids")
            found: dict[str, list] = {}
            for r in rows:
                found.setdefault(r["label"], []).append(r[key])
            return [{"label": k, ids: v} for k, v in found.items()]
        if task == "angles":
            return [{"theme_id": r["theme_id"], "angle": a, "hook": f"{a}: {r['label']}", "phrase": r["label"].partition(" / ")[0]} for r in rows for a in ANGLES]
        if task == "structure":
            return [{"theme_id": r["theme_id"], "part": p, "text": f"{p}: {r['label']}"} for r in rows for p in PARTS]
        if task == "interpret":
            return [{"id": r["id"], "text": f"{r['label']}: {r['size']}" + (f" after {r['before']}" if r.get("before") else "")} for r in rows]
        return [{"id": r["id"], "text": "ok" if r.get("size") else "empty"} for r in rows]


def _mapped(df: DataFrame, provider: ThemeProvider, task: str, schema: str) -> DataFrame:
    columns = [c.split()[0] for c in schema.split(", ")]

    def f(batches):
        for b in batches:
            yield pd.DataFrame(provider(task, b.to_dict("records")), columns=columns)

    return df.mapInPandas(f, schema)


def candidate_themes(signals: DataFrame, provider: ThemeProvider, groups: int = GROUPS) -> DataFrame:
    """(candidate_id, label, signal_id): candidates of each group of signals; groups hold at most about GROUP_MOST signals.

    signals: (signal_id string, label). Identifiers that no signal has are dropped.
    """
    n = signals.count()
    groups = max(groups, -(-n // GROUP_MOST))
    grouped = signals.select("signal_id", "label", F.pmod(F.xxhash64("signal_id"), F.lit(groups)).cast("int").alias("g"))

    def f(key, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k, c in enumerate(provider("cluster", rows.sort_values("signal_id").to_dict("records"))):
            out += [(f"g{key[0]}_{k}", c["label"], s) for s in c["signal_ids"]]
        return pd.DataFrame(out, columns=["candidate_id", "label", "signal_id"])

    found = grouped.groupBy("g").applyInPandas(f, "candidate_id string, label string, signal_id string")
    return found.join(signals.select("signal_id"), "signal_id", "left_semi").select("candidate_id", "label", "signal_id").distinct()


def merged_themes(candidates: DataFrame, provider: ThemeProvider) -> DataFrame:
    """(theme_id, label, signal_id): themes that the provider makes of the candidates' labels, with all their signals.

    Labels are merged first, so the provider sees each once for every group; of several claims on a candidate the
    first theme's counts, and unclaimed candidates are themes.
    """
    heads = candidates.select("candidate_id", "label").distinct()

    def f(batches):
        rows = [r for b in batches for r in b.to_dict("records")]
        out = [(f"t{k:06d}", t["label"], c, k) for k, t in enumerate(provider("merge", rows)) for c in t["candidate_ids"]]
        yield pd.DataFrame(out, columns=["theme_id", "label", "candidate_id", "at"])

    claims = cut(heads.repartition(1).sortWithinPartitions("label", "candidate_id").mapInPandas(f, "theme_id string, label string, candidate_id string, at int"))  # one row a group and label, in one answer
    known = first_claims(claims.join(heads.select("candidate_id"), "candidate_id", "left_semi"), "candidate_id", ["at", "theme_id"]).drop("at")
    orphans = heads.join(known, "candidate_id", "left_anti").select(F.concat(F.lit("o_"), "candidate_id").alias("theme_id"), "label", "candidate_id")
    themes = known.select("theme_id", "label", "candidate_id").unionByName(orphans)
    return themes.join(candidates.select("candidate_id", "signal_id"), "candidate_id").select("theme_id", "label", "signal_id").distinct()


def strength(n: Column) -> Column:
    return F.when(n >= 80, "high").when(n >= 25, "medium").otherwise("low")


def theme_table(themes: DataFrame, signals: DataFrame, quotes: int = 6) -> DataFrame:
    """(theme_id, label, signals, likes, strength, quotes): each theme's size and its most liked comments, one comment once."""
    j = themes.join(signals.select("signal_id", "comment_id", "likes"), "signal_id")
    sums = j.groupBy("theme_id", "label").agg(F.count("*").alias("signals"), F.sum("likes").alias("likes"))
    once = j.groupBy("theme_id", "comment_id").agg(F.max("likes").alias("n"))
    best = top_k(once, ["theme_id"], [F.desc("n"), F.asc("comment_id")], quotes).groupBy("theme_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "comment_id"))), lambda x: x["comment_id"]).alias("quotes"))
    return sums.join(best, "theme_id").select("theme_id", "label", "signals", "likes", strength(F.col("signals")).alias("strength"), "quotes")


def angles(themes: DataFrame, provider: ThemeProvider) -> DataFrame:
    """(theme_id, angle, hook, phrase): six angles of every theme, by row-wise answers."""
    return _mapped(themes.select("theme_id", "label"), provider, "angles", "theme_id string, angle string, hook string, phrase string")


def borrowed(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Angles with the most liked comment of their theme that holds their phrase; without one the row is kept, unverified.

    texts: (theme_id, comment_id, text, likes).
    """
    holds = found.select("theme_id", "angle", "phrase").join(texts, "theme_id").where(F.contains(F.lower("text"), F.lower("phrase")))
    best = holds.groupBy("theme_id", "angle").agg(F.min(F.struct((-F.col("likes")).alias("n"), "comment_id")).alias("b"))
    j = found.join(best, ["theme_id", "angle"], "left")
    return j.select(*found.columns, F.col("b.comment_id").alias("source_comment_id"), (-F.col("b.n")).alias("source_likes"), F.col("b").isNotNull().alias("verified"))


def structured(themes: DataFrame, provider: ThemeProvider, top: int = 10) -> DataFrame:
    """(theme_id, part, text): the five parts of an angle for the `top` largest themes."""
    best = themes.orderBy(F.desc("signals"), "theme_id").limit(top)
    return _mapped(best.select("theme_id", "label"), provider, "structure", "theme_id string, part string, text string")


def interpretations(packets: DataFrame, provider: ThemeProvider) -> DataFrame:
    """(id, text): packets interpreted twice, the second time with what the first said. packets: (id, label, size)."""
    first = cut(_mapped(packets.select("id", "label", "size"), provider, "interpret", "id string, text string"))
    again = packets.select("id", "label", "size").join(first.withColumnRenamed("text", "before"), "id")
    return _mapped(again, provider, "interpret", "id string, text string")


def audits(packets: DataFrame, provider: ThemeProvider) -> DataFrame:
    """(id, text): what the provider objects to in each packet."""
    return _mapped(packets.select("id", "label", "size"), provider, "audit", "id string, text string")


class Stages:
    """Tables of a pipeline's stages kept in a folder, so that a run that ended goes on where it was."""

    def __init__(self, spark: SparkSession, folder: str, fresh: bool = False):
        self.spark, self.folder, self.fresh = spark, folder.rstrip("/"), fresh

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def run(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table: read if it was written whole, else made and written."""
        path, fs = self._path(f"{name}/_SUCCESS")
        if self.fresh or not fs.exists(path):
            make().write.mode("overwrite").parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def done(self) -> None:
        """Removes what was kept, after success."""
        path, fs = self._path("")
        fs.delete(path, True)
