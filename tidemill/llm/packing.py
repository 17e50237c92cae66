"""Filling containers of fixed capacity by bounded-space online best-fit.

Items come in a fixed pseudo-random order. OPEN_BINS bins are open at a time, found through a bitset
whose bit f says that a bin with f units of room is open: the lowest set bit at or above an item's
size is the fullest bin that takes it. If none does and all bins are open, the fullest is closed. A
bin without room closes at once. The corpus is cut into shards of about SHARD_UNITS units by a hash
of the item's identifier, each filled by one task, so the only extra room is that of the bins open at
a shard's end.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import cut, spread

OPEN_BINS = 128
SHARD_UNITS = 4_000_000
#: Documented bound on the kinds of containers, which are read by the driver.
MAX_KINDS = 1000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to the public rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: str | None, path: str = TOKENIZER) -> int:
    """Tokens of a text in a public byte-level vocabulary; null and empty texts have none."""
    return len(_encoding(path).encode_ordinary(text)) if text else 0


def token_counts(df: DataFrame, text: str = "text", into: str = "tokens", path: str = TOKENIZER) -> DataFrame:
    """df with the number of tokens of column `text`. The vocabulary file is sent to the executors, which need no copy."""
    df.sparkSession.sparkContext.addFile(path)
    name = os.path.basename(path)

    @F.pandas_udf(T.LongType())
    def count(s: pd.Series) -> pd.Series:
        from pyspark import SparkFiles

        own = SparkFiles.get(name)
        return s.map(lambda t: token_count(t, own)).astype("int64")

    return spread(df).withColumn(into, count(F.col(text)))


class BestFit:
    """Bounded-space online best-fit; `place` gives the number of the bin that takes an item."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.rooms = 0  # bit f: some open bin has f units of room
        self.bins: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, room: int) -> int:
        held = self.bins[room]
        number = held.pop()
        if not held:
            del self.bins[room]
            self.rooms ^= 1 << room
        return number

    def place(self, size: int) -> int:
        if not 0 <= size <= self.capacity:
            raise ValueError(f"{size} units don't fit a container of {self.capacity}")
        fits = self.rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            number = self._take(room)
        else:
            if self.open == self.limit:
                self._take((self.rooms & -self.rooms).bit_length() - 1)  # the fullest closes
                self.open -= 1
            room, number = self.capacity, self.made
            self.made += 1
            self.open += 1
        room -= size
        if room:
            self.bins.setdefault(room, []).append(number)
            self.rooms |= 1 << room
        else:
            self.open -= 1
        return number


def _fill(open_bins: int):
    def f(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, fit = None, None
        for b in batches:
            out = []
            for kind, capacity, shard, item, size in zip(b["kind"], b["capacity"], b["shard"], b["item"], b["size"]):
                if (kind, shard) != now:
                    now, fit = (kind, shard), BestFit(int(capacity), open_bins)
                begin = 0
                piece = 1
                while size - begin > capacity:  # a longer item fills containers of its own
                    out.append((kind, shard, fit.made, item, piece, begin, capacity))
                    fit.made += 1
                    begin += capacity
                    piece += 1
                out.append((kind, shard, fit.place(int(size - begin)), item, piece, begin, size - begin))
            yield pd.DataFrame(out, columns=["kind", "shard", "bin", "item", "piece", "begin", "units"])

    return f


def fill(items: DataFrame, containers: DataFrame, item_id: str, size: str, kind: str, capacity: str, open_bins: int = OPEN_BINS, shard_units: int = SHARD_UNITS) -> DataFrame:
    """(kind, shard, bin, item_id, piece, begin, units): where every item goes, for every kind of container.

    Every item is placed once for each kind, in one piece if it fits; an item over the capacity is cut
    into pieces 1, 2, ... that fill containers of their own, but for the last, which is placed like
    any item. Items of size 0 or null take no room and are placed too. A bin is named by kind, shard
    and bin. Repeated rows are items of their own. Kinds without name or with a capacity below 1 are
    left out. Without items there are no bins.
    """
    kinds = [(r[0], int(r[1])) for r in containers.select(kind, capacity).where(F.col(kind).isNotNull() & (F.col(capacity) >= 1)).distinct().limit(MAX_KINDS + 1).collect()]
    if len(kinds) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} kinds of containers")
    item_type = items.schema[item_id].dataType.simpleString()
    schema = f"kind string, shard int, bin bigint, item {item_type}, piece int, begin bigint, units bigint"
    sized = cut(items.select(F.col(item_id).alias("item"), F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)).alias("size")))
    if not kinds:
        placed = items.sparkSession.createDataFrame([], schema)
    else:
        total = sized.agg(F.sum("size")).first()[0] or 0
        shards = max(1, math.ceil(total / shard_units))
        listed = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("bigint").alias("capacity")) for k, c in sorted(kinds)])
        order = F.xxhash64("item")
        each = sized.select("item", "size", order.alias("order"), F.pmod(F.xxhash64("item", F.lit(7)), F.lit(shards)).cast("int").alias("shard"), F.explode(listed).alias("c")).select("c.kind", "c.capacity", "shard", "order", "item", "size")
        spread = each.repartition(len(kinds) * shards, "kind", "shard").sortWithinPartitions("kind", "shard", "order", "item", "size")
        placed = spread.select("kind", "capacity", "shard", "item", "size").mapInPandas(_fill(open_bins), schema)
    return placed.withColumnsRenamed({"kind": kind, "item": item_id})


def utilisation(placed: DataFrame, containers: DataFrame, kind: str, capacity: str) -> DataFrame:
    """(kind, bins, units, used): how many containers of each kind fill() took, and how full they are."""
    bins = placed.groupBy(kind, "shard", "bin").agg(F.sum("units").alias("units")).groupBy(kind).agg(F.count("*").alias("bins"), F.sum("units").alias("units"))
    sizes = containers.select(kind, F.col(capacity).alias("__size")).distinct()
    return bins.join(sizes, kind).select(kind, "bins", "units", F.round(F.col("units") / (F.col("bins") * F.col("__size")), 4).alias("used"))
