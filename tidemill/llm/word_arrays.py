"""The words of a whole batch of texts as arrays, so that passes over them work on all words at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Arrays are made over about so many characters at a time.
CHUNK = 3_000_000
#: A filter has 16 bits a hash, at most so many in all (16 MB); fuller filters let more hashes pass.
FILTER_BITS = 1 << 27

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of parsed texts as arrays.

    start, end: places in text; word: hashes; pair: hashes of a word and the next of its sentence, 0 for
    a sentence's last; first: the first word of each sentence; sentence: each word's sentence; doc: each
    sentence's text.
    """

    def __init__(self, said: list[str]):
        self.text = "\x02".join(said)
        c = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = np.r_[False, c > 32, False]
        edge = np.diff(letter.astype(np.int8))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(c), _ODD)])
            back = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(c), _BACK)])
            sums = np.r_[np.uint64(0), np.cumsum(_mixed(c.astype(np.uint64)) * power[:-1], dtype=np.uint64)]
            self.word = _mixed((sums[self.end] - sums[self.start]) * back[self.start])
            line = np.cumsum((c == 10) | (c == 2))[self.start] if len(self.start) else np.zeros(0, int)
            fresh = np.r_[True, np.diff(line) != 0][: len(line)]
            self.first = np.flatnonzero(fresh)
            self.sentence = np.cumsum(fresh) - 1
            last = np.r_[fresh[1:], True][: len(line)]
            self.pair = np.where(last, np.uint64(0), _mixed(self.word * np.uint64(3) + np.r_[self.word[1:], np.uint64(0)][: len(line)]) | np.uint64(1))
        self.last = last
        self.doc = np.cumsum(c == 2)[self.start[self.first]] if len(self.first) else np.zeros(0, int)

    def string(self, i: int) -> str:
        return self.text[self.start[i] : self.end[i]]

    def sentences(self, chosen: np.ndarray) -> list[str]:
        ends = self.end[np.r_[self.first[1:], len(self.start)] - 1]
        return [self.text[a:b] for a, b in zip(self.start[self.first][chosen].tolist(), ends[chosen].tolist())]


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, Words]]:
    """Batches cut so that each has about CHUNK characters, with their words."""
    for b in batches:
        sizes = np.cumsum(b["said"].str.len().to_numpy()) // CHUNK
        for _, part in b.groupby(sizes, sort=False):
            yield part, Words(part["said"].tolist())


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)


def hash_filter(hashes: DataFrame) -> np.ndarray:
    """A bit table of column h, two bits a hash; its number of bits is a power of two, at most FILTER_BITS."""
    n = hashes.count()
    bits = min(FILTER_BITS, 1 << max(12, (16 * n).bit_length()))
    places = hashes.select(F.explode(F.array(*[F.shiftrightunsigned("h", k).bitwiseAND(F.lit(bits - 1)) for k in (0, 32)])).alias("b"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("b").bitwiseAND(F.lit(63)).cast("int"))
    got = places.groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(one).alias("x")).toPandas()  # at most FILTER_BITS / 64 rows
    table = np.zeros(bits // 64, np.int64)
    table[got["w"].to_numpy()] = got["x"].to_numpy()
    return table.view(np.uint64)


def passing(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets pass: all that are in it, and few others."""
    mask, out = np.uint64(len(table) * 64 - 1), np.ones(len(h), bool)
    for k in (0, 32):
        b = (h >> np.uint64(k)) & mask
        out &= ((table[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1)).astype(bool)
    return out
