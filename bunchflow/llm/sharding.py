"""Sharding by weighted rendezvous hashing, with DataFrame functions only.

Every record's key is hashed with every shard's number; the shard with the
least -ln(u) / weight takes the record. Law `key`: the key, the shard count and
the weights decide, nothing else. With one more shard a record either stays or
goes to the new one, so about 1 / (n + 1) of the records move.

Slots are numbered without gaps in each shard by two levels: records are
numbered in (shard, bucket) groups, whose counts give each group its first
slot. The number of buckets follows the number of rows, so no task orders a
whole shard.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tasks import table

SHARDS = 24
#: Rows of a (shard, bucket) group, on average.
GROUP_ROWS = 20_000


def score(key: Column, shard: int, weight: float) -> Column:
    """-ln(u) / weight for u in (0, 1) of 52 bits of md5(key#shard)."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"#{shard}"))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**52))) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to len(weights) - 1, of a key; a null key counts as the text "null"."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    key = F.coalesce(key.cast("string"), F.lit("null"))
    scores = [F.struct(score(key, i, w).alias("s"), F.lit(i).alias("i")) for i, w in enumerate(weights)]
    return (F.least(*scores) if len(scores) > 1 else scores[0])["i"]


def sharded(docs: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS, grown: float = 1.0) -> DataFrame:
    """docs with shard int and grown_shard int, the shard if one of weight `grown` is added.

    Null keys share one shard; repeated rows and equal keys go to the same one;
    an empty table stays empty; input columns named so are replaced.
    """
    k = F.col(f"`{key}`")
    return docs.withColumns({"shard": rendezvous(k, weights), "grown_shard": rendezvous(k, [*weights, grown])})


def numbered(rows: DataFrame, order: Sequence[str], groups: int) -> DataFrame:
    """rows with slot long, gapless from 0 in each shard; rows that are equal in `order` must be equal."""
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(groups)))
    counts = rows.groupBy("shard", "__bucket").agg(F.count("*").alias("__rows"))
    # shards x groups rows of counts, each shard's in one window
    first = counts.withColumn("__first", F.sum("__rows").over(Window.partitionBy("shard").orderBy("__bucket")) - F.col("__rows")).drop("__rows")
    place = F.row_number().over(Window.partitionBy("shard", "__bucket").orderBy(*order))
    return rows.withColumn("__place", place).join(first, ["shard", "__bucket"]).withColumn("slot", F.col("__first") + F.col("__place") - 1).drop("__first", "__place", "__bucket")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    groups = max(1, math.ceil(docs.count() / SHARDS / GROUP_ROWS))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = sharded(docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32")))
    return numbered(rows, ["doc_id", "size", "text_crc32"], groups).select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
