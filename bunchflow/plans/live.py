"""Streaming queries, run over what is there, with the SQL of the same batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.live import demultiplexed, drained, gaps, orbit_windows, scratch, watched
from .fixtures import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    # the table's own path as a pattern: a file and a folder of parts alike
    return watched(spark, f"{sf_dir}/{name}.parque[t]", schema)


@query("SELECT ((1 + event_id // 8) - 1) >> 4 AS file_group, count(*) AS events, count(DISTINCT user_id % 64) AS streams, round(sum(value), 4) AS total FROM events GROUP BY 1")
def stream_orbit_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows of orbits over the live events."""
    e = _stream(spark, sf_dir, "events").withColumn("orbit", F.floor(F.col("event_id") / 8) + 1)
    streams = F.size(F.collect_set(F.col("user_id") % 64)).cast("long")
    windows = e.groupBy(orbit_windows(e, 4).alias("file_group")).agg(F.count("*").alias("events"), streams.alias("streams"), F.round(F.sum("value"), 4).alias("total"))
    return drained(windows, "complete")


@query("SELECT event_type, count(*) AS events, round(min(value), 6) AS least, round(max(value), 6) AS most FROM events GROUP BY event_type")
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals."""
    e = _stream(spark, sf_dir, "events")
    return drained(e.groupBy("event_type").agg(F.count("*").alias("events"), F.round(F.min("value"), 6).alias("least"), F.round(F.max("value"), 6).alias("most")), "complete")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS begin, count(*) AS events FROM events GROUP BY 1")
def stream_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows on event time with a watermark; all are kept until the end here."""
    e = _stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 hour")
    begin = F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("begin")
    windows = e.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("events")).select(begin, "events")
    return drained(windows, "complete")


@query("SELECT o_orderkey // 16 AS orbit, count(*) AS rows, count(*) - 3 AS clashes FROM orders GROUP BY 1 HAVING count(DISTINCT o_custkey % 3) = 3")
def stream_demux(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orbits whose three time slices have all come, by keyed state."""
    o = _stream(spark, sf_dir, "orders").select(F.floor(F.col("o_orderkey") / 16).alias("orbit"), (F.col("o_custkey") % 3).cast("int").alias("slot"))
    return drained(demultiplexed(o, 3), "append")


@query("SELECT l_orderkey AS event, CAST(l_quantity * 4 AS BIGINT) AS pt, l_linenumber::BIGINT AS line FROM lineitem WHERE l_quantity >= 30 AND (l_orderkey * 7 + l_linenumber * 3 + l_suppkey) % 8 BETWEEN 2 AND 5")
def stream_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stateless live selection, file by file."""
    rows = _stream(spark, sf_dir, "lineitem").where("l_quantity >= 30 AND (l_orderkey * 7 + l_linenumber * 3 + l_suppkey) % 8 BETWEEN 2 AND 5")
    return drained(rows.select(F.col("l_orderkey").alias("event"), (F.col("l_quantity") * 4).cast("long").alias("pt"), F.col("l_linenumber").cast("long").alias("line")), "append")


@query("""WITH e AS (SELECT event_id % 3 AS stream, event_id AS pos, event_id // 8 AS orbit, (event_id % 8) * 6 + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS bx FROM events),
l AS (SELECT *, lag(orbit) OVER w AS o, lag(bx) OVER w AS b FROM e WINDOW w AS (PARTITION BY stream ORDER BY pos)),
c AS (SELECT *, o IS NOT NULL AND orbit <> o AND orbit <> o + 1 AS bad_orbit, o IS NOT NULL AND CASE WHEN orbit = o THEN bx <> b + 18 ELSE bx <> 0 END AS bad_bx FROM l)
SELECT stream, pos, orbit, bx, bad_orbit, bad_bx FROM c WHERE bad_orbit OR bad_bx""")
def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaks in live streams, with the last orbit and crossing as state, over several batches."""
    at = scratch(spark)
    e = table(spark, sf_dir, "events").select((F.col("event_id") % 3).alias("stream"), F.col("event_id").alias("pos"), F.floor(F.col("event_id") / 8).alias("orbit"), ((F.col("event_id") % 8) * 6 + (F.col("event_id") % 50 == 0).cast("long")).alias("bx"))
    # files of ascending events, read one a batch in the order of their times
    half = e.agg(F.expr("percentile(pos, 0.5)").cast("long")).first()[0]
    for part in (e.where(F.col("pos") <= half), e.where(F.col("pos") > half)):
        part.coalesce(1).write.mode("append").parquet(at)
    return drained(gaps(watched(spark, at, e.schema, files_per_batch=1), 1, 18, 0), "append")
