"""Fixed-size filters and connected components over keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tasks import dropped, in_arrow, measured, written
from .words import mix

#: Bits of a filter at most (16 MB): beyond, it lets more pass, which only costs time.
FILTER_BITS = 27
_CHUNK = 1 << 15


class Filter:
    """A Bloom filter of 64-bit keys in a power of two of bits; never says no to a key that is in."""

    def __init__(self, bits: int):
        self.bits, self.bytes = bits, np.zeros(max(1, (1 << bits) >> 3), np.uint8)
        #: Whether so many keys are in that more than one other key in twenty passes.
        self.crowded = False

    def _places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        h = mix(np.asarray(keys).astype(np.int64, copy=False).view(np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5))
        for x in (h, h >> np.uint64(32)):
            yield (x & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        for p in self._places(keys):
            np.bitwise_or.at(self.bytes, p >> 3, (1 << (p & 7)).astype(np.uint8))

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for p in self._places(keys):
            out &= (self.bytes[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return out


def key_filter(keys: DataFrame, column: str, most_bits: int = FILTER_BITS) -> Filter:
    """A filter of all values of a long column of a written table, or of one that is cheap to read twice."""
    count = measured(keys)
    out = Filter(min(most_bits, max(16, (16 * count).bit_length())))
    bits = out.bits
    out.crowded = count > 1 << (bits - 3)
    if not count:
        return out

    def part(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filter(bits)
        for batch in it:
            own.add(batch.column(0).to_numpy(zero_copy_only=False))
        at = [i for i in range(0, len(own.bytes), _CHUNK) if own.bytes[i : i + _CHUNK].any()]
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([own.bytes[i : i + _CHUNK].tobytes() for i in at], pa.binary())], names=["at", "part"])

    def either(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"at": pdf["at"].iloc[:1], "part": [np.bitwise_or.reduce([np.frombuffer(x, np.uint8) for x in pdf["part"]]).tobytes()]})

    # few parts of a fixed size each, whatever the number of keys
    parts = in_arrow(keys.select(F.col(column).cast("long")).coalesce(8), part, "at long, part binary")
    for r in parts.groupBy("at").applyInPandas(either, "at long, part binary").collect():
        out.bytes[r.at : r.at + len(r.part)] = np.frombuffer(bytes(r.part), np.uint8)
    return out


#: Keys that are looked up in a table of their own at most, and the rows from which a key is one of them.
HOT_KEYS, HOT_ROWS = 1000, 256


def hot_keys(counts: DataFrame, key: str, count: str = "count") -> list:
    """The HOT_KEYS keys with most rows, if of HOT_ROWS at least; counts: (key, count), each key once.

    Any other key has less than one in HOT_KEYS of all rows.
    """
    often = counts.where((F.col(count) >= HOT_ROWS) & F.col(key).isNotNull()).select(key, count)
    return [r[0] for r in often.orderBy(F.desc(count)).limit(HOT_KEYS).collect()]


def looked_up(rows: DataFrame, found: DataFrame, key: str, hot: list) -> DataFrame:
    """rows left-joined with found, which has each key at most once; the rows of hot keys are not shuffled."""
    if not hot:
        return rows.join(found, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    few = F.broadcast(found.where(is_hot))
    return rows.where(~is_hot).join(found.where(~is_hot), key, "left").unionByName(rows.where(is_hot).join(few, key, "left"))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node that edges (a, b) reach from each node that has one.

    Labels spread to neighbours and then jump to their label's label, so the
    rounds grow with the logarithm of a chain's length. Each round is written.
    """
    sides = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(sides.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    hubs = hot_keys(sides.groupBy("b").count(), "b")
    while True:
        near = looked_up(sides, labels.withColumnRenamed("node", "b"), "b", hubs).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        spread = written(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")), changed=(F.col("label") < F.col("old")).cast("long"))
        if not measured(spread, "changed"):
            dropped(sides, spread)
            return labels
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = looked_up(spread, jump, "label", hot_keys(spread.groupBy("label").count(), "label"))
        before, labels = labels, written(jumped.select("node", F.least("label", F.coalesce("further", "label")).alias("label")))
        dropped(spread, before)
