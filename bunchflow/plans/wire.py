"""Round trips through the framed formats and Arrow IPC, with the SQL of what must come back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.framed import register
from ..sources.framed import check_files, read_arrow, read_events
from ..streaming.live import scratch
from .fixtures import CAND, HEADERS, word_arrays
from .framing import parsed

QUERIES: dict = {}
ORACLES: dict = {}

#: Orders make orbits of 594 events; two streams are written, a file each.
BACK = f"""WITH {CAND}, {HEADERS.strip()}, d AS (SELECT event, sum(w % 1000003)::BIGINT AS digest, count(*) AS n FROM words GROUP BY event)
SELECT ev.run, ev.orbit, ev.bx, ev.good, CASE WHEN good THEN d.n ELSE 0 END AS n, CASE WHEN good THEN digest ELSE 0 END AS digest FROM ev JOIN d USING (event)"""


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event, run, orbit, bx, good, words; events in error are empty."""
    e = parsed(spark, sf_dir).select("event", F.col("run").cast("int").alias("run"), "orbit", F.col("bx").cast("int").alias("bx"), "good")
    words = F.when(F.col("good"), F.col("words")).otherwise(F.array().cast("array<bigint>"))
    return e.join(word_arrays(spark, sf_dir), "event").withColumn("words", words)


def written_events(spark: SparkSession, sf_dir: str, kind: str) -> str:
    register(spark)
    at = scratch(spark)
    # whole orbits go to a file, in order
    rows = events(spark, sf_dir).repartitionByRange(2, "orbit").sortWithinPartitions("orbit", "event").select("run", "orbit", "bx", "good", "words")
    rows.write.format("framed").option("kind", kind).mode("append").save(at)
    return at


def digest(rows: DataFrame) -> DataFrame:
    total = F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w % 1000003)
    return rows.select(F.col("run").cast("long").alias("run"), "orbit", F.col("bx").cast("long").alias("bx"), "good", F.size("words").cast("long").alias("n"), total.alias("digest"))


def _round_trip(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return digest(read_events(spark, written_events(spark, sf_dir, kind), kind))

    query.__name__ = f"{kind}_roundtrip"
    QUERIES[query.__name__], ORACLES[query.__name__] = query, BACK


for _kind in ("native64", "native128", "dth", "dth_oa", "dth_oa_bare", "dth256", "frd"):
    _round_trip(_kind)


def _add(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@_add(BACK.replace("SELECT ev.run, ev.orbit", "SELECT ev.run::BIGINT AS run, ev.orbit"))
def arrowipc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    at = scratch(spark)
    rows = events(spark, sf_dir).select("run", "orbit", "bx", "good", "words")
    rows.write.format("arrowipc").option("mode", "stream").option("compression", "zstd").mode("append").save(at)
    return digest(read_arrow(spark, at, "run int, orbit long, bx int, good boolean, words array<bigint>"))


@_add(f"WITH {HEADERS} SELECT sum(n)::BIGINT AS words, count(*) AS events, CAST(0 AS BIGINT) AS broken FROM ev")
def frame_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framing checks over files: what they hold, and how many are broken."""
    found = check_files(spark, written_events(spark, sf_dir, "frd"), "frd")
    return found.agg(F.sum("words").alias("words"), F.sum("events").alias("events"), F.count("violation").alias("broken"))
