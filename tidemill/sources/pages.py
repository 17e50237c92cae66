"""Records from captured pages: posts linked from a page, and a post's caption, counts and comments."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.values import POST_PATH


def linked_posts(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """(page_id, shortcode, kind, position): posts linked from each page, the first link of each."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)href\s*=\s*[\"']([^\"']*/(?:p|reel|reels|tv)/[A-Za-z0-9_-]+[^\"']*)[\"']"), 1)
    e = pages.select(page_id, F.posexplode(links).alias("at", "link"))
    kind = F.lower(F.regexp_extract("link", POST_PATH, 1))
    e = e.select(page_id, F.regexp_extract("link", POST_PATH, 2).alias("shortcode"), F.when(kind == "reels", "reel").otherwise(kind).alias("kind"), "at")
    first = e.groupBy(page_id, "shortcode").agg(F.min(F.struct("at", "kind")).alias("f"))
    w = Window.partitionBy(page_id).orderBy("at")
    return first.select(page_id, "shortcode", "f.kind", "f.at").withColumn("position", F.row_number().over(w)).drop("at")


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.meta: dict[str, str] = {}
        self.items: list[dict] = []
        self.depth = 0
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "meta" and (a.get("property") or a.get("name")):
            self.meta.setdefault(a.get("property") or a.get("name"), a.get("content") or "")
        elif tag == "li":
            self.depth += 1
            self.items.append({"author": None, "text": [], "depth": self.depth - 1})
        elif tag == "a" and self.items and self.depth and self.items[-1]["author"] is None:
            name = (a.get("href") or "").strip("/").split("/")
            if len(name) == 1 and name[0]:
                self.items[-1]["author"] = name[0].lower()

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag == "li":
            self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        if self.depth and not self.skip and data.strip() and self.items:
            self.items[-1]["text"].append(" ".join(data.split()))


_RECORD = T.StructType([T.StructField("caption", T.StringType()), T.StructField("description", T.StringType()), T.StructField("comments", T.ArrayType(T.StructType([T.StructField("author", T.StringType()), T.StructField("text", T.StringType()), T.StructField("depth", T.IntegerType()), T.StructField("parent", T.IntegerType())])))])


def parse_page(text: str | None) -> dict:
    """Caption, description and comments of one page, replies with their parents; what a page lacks is null or empty."""
    r = _Reader()
    r.feed(text or "")
    rows = [{"author": i["author"], "text": max((t for t in i["text"] if t.lower() != i["author"]), key=len, default=""), "depth": i["depth"]} for i in r.items if i["author"]]
    return {"caption": r.meta.get("og:title"), "description": r.meta.get("og:description"), "comments": with_parents([x for x in rows if x["text"]])}


def with_parents(rows: list[dict]) -> list[dict]:
    """Comments in a page's order with the place (from 0) of the last top-level one above each reply; null without one."""
    top = None
    for k, x in enumerate(rows):
        x["parent"] = top if x["depth"] else None
        top = top if x["depth"] else k
    return rows


@F.pandas_udf(_RECORD)
def page_record(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_page(t) for t in html], columns=["caption", "description", "comments"])
