"""Occurrences and document frequency of every term, from vertical bitmaps.

Each term has, for every block of 65,536 records, a container of the records holding it and a counter
of its occurrences. Records are named by their identifiers where these are dense; sparse identifiers
are first replaced by ordinals, as containers of a few identifiers each would compress nothing. A container is a sorted list of 16-bit values or, beyond 4,096
of them, a bitmap of 8 KB, whichever is smaller. Tasks build containers over their own rows and
containers of one term and block are united after one shuffle; document frequency is the sum of
cardinalities. Terms that stand in most records weigh at most 8 KB a block, so no term is too hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import spread

TERM = regex.compile(r"[\p{L}\p{M}\p{N}]+")
LIST_MAX = 4096
FLUSH_POSTINGS = 1_000_000
#: Identifiers that span so many times their number are sparse.
SPARSE = 16
INDEX_SCHEMA = "term string, block bigint, card int, occurrences bigint, container binary"


def pack(low: np.ndarray) -> bytes:
    """Distinct sorted 16-bit values as a container."""
    if len(low) <= LIST_MAX:
        return low.astype("<u2").tobytes()
    bits = np.zeros(65536, bool)
    bits[low] = True
    return np.packbits(bits, bitorder="little").tobytes()


def unpack(container: bytes, card: int) -> np.ndarray:
    if card <= LIST_MAX:
        return np.frombuffer(container, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8), bitorder="little")).astype(np.uint16)


def unite(containers: list[tuple[bytes, int]]) -> tuple[bytes, int]:
    """The union of containers, and its cardinality."""
    if len(containers) == 1:
        return containers[0]
    if sum(card for _, card in containers) <= LIST_MAX:
        low = np.unique(np.concatenate([unpack(*c) for c in containers]))
    else:
        bits = np.zeros(65536, bool)
        for c in containers:
            bits[unpack(*c)] = True
        low = np.flatnonzero(bits)
    return pack(low), len(low)


def _ordinals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Numbers the records of a partition, which come sorted, after those of the partitions before."""
    from pyspark import TaskContext

    at, last = TaskContext.get().partitionId() << 40, None
    for b in batches:
        rid = b["rid"].to_numpy()
        if len(rid):
            fresh = np.r_[last is not None and rid[0] != last, rid[1:] != rid[:-1]]
            number = at + np.cumsum(fresh)
            at, last = int(number[-1]), rid[-1]
            yield b.assign(rid=number)


def _build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    codes: dict[str, int] = {}
    held: list[int] = []
    owner: list[int] = []
    lengths: list[int] = []

    def flush() -> pd.DataFrame:
        names = np.array(list(codes), dtype=object)
        code, rid = np.array(held, np.int64), np.repeat(np.array(owner, np.int64), lengths)
        order = np.lexsort((rid, code))
        code, rid = code[order], rid[order]
        fresh = np.r_[True, (code[1:] != code[:-1]) | (rid[1:] != rid[:-1])]
        at = np.flatnonzero(fresh)
        n = np.diff(np.r_[at, len(code)])
        code, rid = code[at], rid[at]
        block, low = rid >> 16, rid & 0xFFFF
        begin = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (block[1:] != block[:-1])])
        end = np.r_[begin[1:], len(code)]
        out = pd.DataFrame({"term": names[code[begin]], "block": block[begin], "card": (end - begin).astype(np.int32), "occurrences": np.add.reduceat(n, begin), "container": [pack(low[a:b]) for a, b in zip(begin, end)]})
        codes.clear(), held.clear(), owner.clear(), lengths.clear()
        return out

    for b in batches:
        for rid, text in zip(b["rid"].tolist(), b["text"].tolist()):
            found = TERM.findall(text.lower())
            if found:
                held += [codes.setdefault(t, len(codes)) for t in found]
                owner.append(rid)
                lengths.append(len(found))
        if len(held) >= FLUSH_POSTINGS:
            yield flush()
    if held:
        yield flush()


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Unites neighbours of one term and block; the input is sorted by them."""
    key, parts, n = None, [], 0

    def row() -> tuple:
        container, card = unite(parts)
        return (*key, card, n, container)

    names = ["term", "block", "card", "occurrences", "container"]
    for b in batches:
        out = []
        for term, block, card, occurrences, container in b[names].itertuples(index=False, name=None):
            if (term, block) != key:
                if key is not None:
                    out.append(row())
                key, parts, n = (term, block), [], 0
            elif len(parts) >= 64:
                parts = [unite(parts)]
            parts.append((container, card))
            n += occurrences
        yield pd.DataFrame(out, columns=names)
    if key is not None:
        yield pd.DataFrame([row()], columns=names)


def term_index(df: DataFrame, record_id: str, text: str = "text") -> DataFrame:
    """(term, block, card, occurrences, container): the vertical index of df.

    A term is a longest run of letters, marks and digits of the lower-cased text. Null and empty
    texts hold no term. Rows of one record_id are one record; rows without one are a record each.
    """
    own = -F.monotonically_increasing_id() - 1
    rows = df.select(F.coalesce(F.col(record_id).cast("bigint"), own).alias("rid"), F.col(text).alias("text")).where("text IS NOT NULL")
    ends = df.agg(F.count("*").alias("n"), F.min(F.col(record_id).cast("bigint")).alias("lo"), F.max(F.col(record_id).cast("bigint")).alias("hi")).first()
    if ends.lo is not None and ends.hi - ends.lo > SPARSE * ends.n:
        rows = rows.repartition("rid").sortWithinPartitions("rid").mapInPandas(_ordinals, "rid bigint, text string")
    else:
        rows = spread(rows)
    built = rows.mapInPandas(_build, INDEX_SCHEMA)
    return built.repartition("term", "block").sortWithinPartitions("term", "block").mapInPandas(_merge, INDEX_SCHEMA)


def term_counts(df: DataFrame, record_id: str, text: str = "text", rare: int = 2, common: float = 0.1) -> DataFrame:
    """(term, occurrences, documents, mark): mark is `rare`, `common` or null.

    rare: held by at most `rare` records; common: by more than that share of all rows of df; where
    both hold the mark is rare. An empty df has no terms.
    """
    total = df.count()
    sums = term_index(df, record_id, text).groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("card").alias("documents"))
    return sums.withColumn("mark", mark(F.col("documents"), total, rare, common))


def mark(documents: Column, total: int, rare: int, common: float) -> Column:
    return F.when(documents <= rare, "rare").when(documents > total * common, "common")
