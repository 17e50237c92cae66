"""The library's front: a corpus, lexicons and events, and stages run over them by name or from a command line."""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans import base, catalog, features, scores, timeline
from tidemill.sources.bundles import capped


@dataclass(frozen=True)
class Lexicon:
    """Word lists by name; the defaults are the engine's own."""

    topics: Mapping[str, list[str]] = field(default_factory=lambda: scores.TOPICS)
    formats: Mapping[str, list[str]] = field(default_factory=lambda: scores.FORMATS)
    affect: Mapping[str, tuple] = field(default_factory=lambda: features.AFFECT)
    stance: Mapping[str, tuple] = field(default_factory=lambda: features.STANCE)
    motifs: Mapping[str, list | None] = field(default_factory=lambda: features.MOTIFS)


@dataclass(frozen=True)
class Corpus:
    """Tables of a collection: a folder with one Parquet table for each."""

    spark: SparkSession
    root: str
    most_comments: int | None = None

    def comments(self) -> DataFrame:
        """The canonical comments; a row cap, if asked for, takes the first by identifier."""
        return capped(base.comments(self.spark, self.root), "comment_id", self.most_comments)

    def posts(self) -> DataFrame:
        return base.posts(self.spark, self.root)


class Engine:
    """Runs stages over a corpus; stages are the catalogued queries and those added here."""

    def __init__(self, corpus: Corpus, lexicon: Lexicon | None = None, events: Sequence[timeline.Event] = timeline.EVENTS):
        self.corpus, self.lexicon, self.events = corpus, lexicon or Lexicon(), tuple(events)
        self.own: dict[str, Callable[[Engine], DataFrame]] = {
            "scored": lambda e: scores.scored(e.corpus.spark, e.corpus.root, e.lexicon.topics),
            "formats": lambda e: scores.formats(e.corpus.spark, e.corpus.root, e.lexicon.formats),
            "features": lambda e: features.features(e.corpus.spark, e.corpus.root, e.lexicon.affect, e.lexicon.stance),
            "links": lambda e: timeline.links(e.corpus.spark, e.corpus.root, e.events),
            "comments": lambda e: e.corpus.comments(),
        }

    def stages(self) -> list[str]:
        return sorted({*self.own, *catalog.QUERIES})

    def run(self, stage: str) -> DataFrame:
        """The stage's result; unknown stages are refused."""
        if stage in self.own:
            return self.own[stage](self)
        if stage not in catalog.QUERIES:
            raise ValueError(f"no stage {stage!r}")
        return catalog.QUERIES[stage](self.corpus.spark, self.corpus.root)


def filtered(evidence: DataFrame, segment: str | None = None, said: str | None = None, text: str = "text") -> DataFrame:
    """Evidence of a segment whose text holds some words, whatever their case."""
    out = evidence if segment is None else evidence.where(F.col("segment") == segment)
    return out if not said else out.where(F.contains(F.lower(text), F.lit(said.lower())))


def options(args: Sequence[str] | None = None) -> argparse.Namespace:
    a = argparse.ArgumentParser(prog="tidemill", description="Runs a stage over a corpus and writes its result.")
    a.add_argument("stage")
    a.add_argument("--input", required=True, help="folder of tables")
    a.add_argument("--out", required=True, help="folder for the result")
    a.add_argument("--format", default="parquet", choices=("parquet", "json", "csv"))
    a.add_argument("--max-comments", type=int, default=None)
    a.add_argument("--limit", type=int, default=None, help="rows of the result, of a report")
    a.add_argument("--fresh", action="store_true", help="write again what is there")
    got = a.parse_args(args)
    got.input, got.out = (os.path.expanduser(x) if x.startswith("~/") else x for x in (got.input, got.out))
    return got


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> str:
    from tidemill.session import local_session, ship
    from tidemill.sources.bundles import write_csv

    o = options(args)
    spark = spark or local_session()
    ship(spark)
    df = Engine(Corpus(spark, o.input, o.max_comments)).run(o.stage)
    df = df if o.limit is None else df.limit(o.limit)
    path = f"{o.out}/{o.stage}"
    if o.format == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite" if o.fresh else "error").option("ignoreNullFields", "false").format(o.format).save(path)
    return path


if __name__ == "__main__":
    main()
