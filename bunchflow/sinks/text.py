"""Text and binary exports of small results."""

from __future__ import annotations

import struct
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bits import hex_word


def frames(events: DataFrame, links: int = 4) -> DataFrame:
    """(event, frame, line): the words of (event, words) in frames of `links`, each word with start, end and valid flags."""
    n = F.size("words")
    marked = F.transform("words", lambda w, i: F.concat(F.when(i == 0, "1").otherwise("0"), F.when(i == n - 1, "1").otherwise("0"), F.lit("1 "), hex_word(w)))
    frame = F.explode(F.sequence(F.lit(0), F.floor((n - 1) / links).cast("int"))).alias("frame")
    rows = events.where(n > 0).select("event", marked.alias("m"), frame)
    return rows.select("event", F.col("frame").cast("long").alias("frame"), F.array_join(F.slice("m", F.col("frame") * links + 1, links), " ").alias("line"))


def write_histogram(histogram: DataFrame, path: str) -> None:
    """The number of bins as a 32-bit word, then each bin's entries as a double, under- and overflow included.

    A histogram has a fixed, small number of rows, so it is collected.
    """
    rows = histogram.orderBy("bin").select(F.col("entries").cast("double")).collect()
    Path(path).write_bytes(struct.pack("<I", len(rows) - 2) + struct.pack(f"<{len(rows)}d", *[r[0] for r in rows]))


def read_histogram(path: str) -> list[float]:
    data = Path(path).read_bytes()
    return list(struct.unpack(f"<{struct.unpack('<I', data[:4])[0] + 2}d", data[4:]))
