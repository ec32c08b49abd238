"""Queries over event headers: sampling, continuity, totals, merging, file keys, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.headers import lumisection, orbit_seconds, parse_event_header
from ..operators import streams as S
from .fixtures import CAND, HEADERS, header_words, table, word_arrays, words

QUERIES: dict = {}
ORACLES: dict = {}

#: Small enough that the test tables have several files and lumisections.
LUMI_BITS, FILE_BITS = 6, 3


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = parse_event_header(F.col("h"))
    return header_words(spark, sf_dir).select("event", *[p[k].alias(k) for k in ("run", "orbit", "bx", "n", "good")])


@query(f"WITH {CAND} SELECT event, i, w FROM words WHERE w & 1023 <> 0")
def zero_word_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero words between events are skipped: here, words are zeroed where their low bits are, then filtered as arrays."""
    arrays = word_arrays(spark, sf_dir).withColumn("words", F.transform("words", lambda w: F.when(w.bitwiseAND(F.lit(1023)) == 0, F.lit(0).cast("long")).otherwise(w)))
    return arrays.select("event", F.posexplode("words").alias("i", "w")).where("w <> 0").select("event", F.col("i").cast("long").alias("i"), "w")


@query(f"WITH {HEADERS} SELECT event, orbit FROM ev WHERE orbit IN (SELECT DISTINCT orbit FROM ev ORDER BY orbit LIMIT 5)")
def max_orbits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.first_orbits(parsed(spark, sf_dir), 5).select("event", "orbit")


@query(f"WITH {HEADERS} SELECT event, run FROM (SELECT event, run, sum(8 + 8 * n) OVER (PARTITION BY run ORDER BY event) AS total FROM ev) WHERE total <= 1000")
def byte_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = parsed(spark, sf_dir)
    return S.within_bytes(e, F.col("n") * 8 + 8, 1000, ["run"], ["event"]).select("event", "run")


@query(f"WITH {CAND} SELECT event, least(count(*), 3) AS n, sum(w) FILTER (WHERE i < 3)::BIGINT % 1000003 AS digest FROM words GROUP BY event")
def payload_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    cropped = word_arrays(spark, sf_dir).select("event", F.slice("words", 1, 3).alias("w"))
    total = F.aggregate("w", F.lit(0).cast("decimal(38,0)"), lambda s, x: (s + x).cast("decimal(38,0)"))
    return cropped.select("event", F.size("w").cast("long").alias("n"), (total % 1000003).cast("long").alias("digest"))


@query(f"WITH {HEADERS} SELECT event, orbit FROM ev WHERE orbit % 4 = 1")
def prescale_orbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.prescaled(parsed(spark, sf_dir), 4, 1).select("event", "orbit")


@query(f"WITH {HEADERS}, o AS (SELECT orbit, row_number() OVER (ORDER BY orbit) - 1 AS seq FROM (SELECT DISTINCT orbit FROM ev)) SELECT event, orbit FROM ev JOIN o USING (orbit) WHERE seq % 3 = 0")
def prescale_seq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third orbit by sequence number; distinct orbits are numbered in buckets."""
    e = parsed(spark, sf_dir)
    seq = S.numbered(e.select("orbit").distinct(), "orbit", number="seq")
    return S.prescaled(e.join(seq, "orbit"), 3, 0, "seq").select("event", "orbit")


@query(f"WITH {HEADERS} SELECT event, orbit FROM ev WHERE good AND orbit % 2 = 0")
def error_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.prescaled(parsed(spark, sf_dir).where("good"), 2, 0).select("event", "orbit")


@query(f"WITH {HEADERS} SELECT event, orbit, bx, (orbit >> {LUMI_BITS}) + 1 AS ls, round((orbit * 3564 + bx) / 40000000.0, 9)::DOUBLE AS seconds FROM ev")
def orbit_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).select("event", "orbit", "bx", lumisection(F.col("orbit"), LUMI_BITS).alias("ls"), F.round(orbit_seconds(F.col("orbit"), F.col("bx")), 9).alias("seconds"))


_KEYED = f"""{HEADERS}, keyed AS (
  SELECT *, (orbit >> {LUMI_BITS}) + 1 AS ls, (orbit - 1) >> {FILE_BITS} AS file_group FROM ev
), filed AS (
  SELECT *, min(orbit) OVER (PARTITION BY run, ls, file_group) & {(1 << LUMI_BITS) - 1} AS file_index FROM keyed
)"""


@query(f"WITH {_KEYED} SELECT event, run, orbit, ls, file_group, file_index FROM filed")
def lumi_file_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.file_keys(parsed(spark, sf_dir), LUMI_BITS, FILE_BITS).select("event", "run", "orbit", "ls", "file_group", "file_index")


_NAMED = f"""{_KEYED}, named AS (
  SELECT 'run' || lpad(run::VARCHAR, 6, '0') || '_ls' || lpad(ls::VARCHAR, 4, '0') || '_index' || lpad(file_index::VARCHAR, 6, '0') || '_ts' || lpad((bx // 6 % 6)::VARCHAR, 2, '0') || '.raw' AS name, * FROM filed
)"""


@query(f"WITH {_NAMED} SELECT name, count(*) AS events, count(DISTINCT orbit) AS orbits, sum(8 + 8 * n)::BIGINT AS bytes FROM named GROUP BY name")
def rolling_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rolling file holds, as its file header needs it."""
    e = S.file_keys(parsed(spark, sf_dir), LUMI_BITS, FILE_BITS)
    e = e.withColumn("name", S.file_name(F.col("run"), F.col("ls"), F.col("file_index"), F.floor(F.col("bx") / 6) % 6))
    return e.groupBy("name").agg(F.count("*").alias("events"), F.count_distinct("orbit").alias("orbits"), F.sum(F.col("n") * 8 + 8).alias("bytes"))


@query(f"WITH {_NAMED} SELECT DISTINCT name, run, ls, file_index AS index, bx // 6 % 6 AS ts, greatest(ls - 1, 0) * {1 << LUMI_BITS} + file_index AS orbit FROM (SELECT name, run, ls, file_index, bx FROM named)")
def filename_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = S.file_keys(parsed(spark, sf_dir), LUMI_BITS, FILE_BITS)
    names = e.select(S.file_name(F.col("run"), F.col("ls"), F.col("file_index"), F.floor(F.col("bx") / 6) % 6).alias("name")).distinct()
    p = S.parse_file_name(F.col("name"), LUMI_BITS)
    return names.select("name", *[c.alias(k) for k, c in p.items()])


_STREAM = f"""{HEADERS}, st AS (SELECT *, event % 3 AS stream FROM ev), lagged AS (
  SELECT *, lag(orbit) OVER (PARTITION BY stream ORDER BY event) AS o, lag(bx) OVER (PARTITION BY stream ORDER BY event) AS b FROM st
), checked AS (
  SELECT *, coalesce(orbit <> o AND orbit <> o + 1, false) AS bad_orbit,
    CASE WHEN o IS NULL THEN false WHEN orbit = o THEN bx <> b + 18 ELSE bx <> 0 END AS bad_bx FROM lagged
)"""


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = parsed(spark, sf_dir).withColumn("stream", F.col("event") % 3)
    return S.continuity(e, ["stream"], ["event"], orbit_step=1, bx_step=18, first_bx=0)


@query(f"WITH {_STREAM} SELECT event, stream, bad_orbit, bad_bx FROM checked")
def continuity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).select("event", "stream", "bad_orbit", "bad_bx")


@query(f"WITH {HEADERS} SELECT run, orbit, count(*) AS events, count(*) FILTER (WHERE NOT good AND n = 0) AS truncated FROM ev GROUP BY run, orbit QUALIFY orbit < max(orbit) OVER (PARTITION BY run)")
def truncation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.truncation(parsed(spark, sf_dir), complete_only=True).select("run", "orbit", "events", "truncated")


@query(f"""WITH {HEADERS}, per AS (SELECT orbit, max(CASE WHEN NOT good AND n = 0 THEN 1 ELSE 0 END) AS t FROM ev GROUP BY orbit)
  SELECT count(*) AS events, sum(n)::BIGINT AS candidates, count(*) FILTER (WHERE NOT good AND n = 0) AS truncated, (SELECT count(*) FROM per) AS orbits,
  (SELECT sum(t)::BIGINT FROM per) AS truncated_orbits, (count(*) + sum(n)::BIGINT) * 8 AS bytes FROM ev""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.totals(parsed(spark, sf_dir))


@query(f"WITH {HEADERS} SELECT run, count(*) AS events, sum(n)::BIGINT AS candidates, min(orbit) AS first_orbit, max(orbit) AS last_orbit FROM ev GROUP BY run")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).groupBy("run").agg(F.count("*").alias("events"), F.sum("n").alias("candidates"), F.min("orbit").alias("first_orbit"), F.max("orbit").alias("last_orbit"))


@query(f"WITH {HEADERS} SELECT count(*) AS events, count(*) FILTER (WHERE event % 11 = 0) AS disagree FROM ev")
def header_trailer_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trailer repeats the header's orbit and crossing; every eleventh is off by one here."""
    e = parsed(spark, sf_dir).withColumns({"t_orbit": F.col("orbit"), "t_bx": F.col("bx") + F.when(F.col("event") % 11 == 0, 1).otherwise(0)})
    return e.agg(F.count("*").alias("events"), F.sum(((F.col("t_orbit") != F.col("orbit")) | (F.col("t_bx") != F.col("bx"))).cast("long")).alias("disagree"))


@query(f"""WITH {_STREAM} SELECT unnest(['orbit', 'bx', 'truncated', 'bx_range']) AS kind, unnest([count(*) FILTER (WHERE bad_orbit), count(*) FILTER (WHERE bad_bx), count(*) FILTER (WHERE NOT good AND n = 0), count(*) FILTER (WHERE bx >= 3564)]) AS rows FROM checked""")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {"orbit": F.col("bad_orbit"), "bx": F.col("bad_bx"), "truncated": ~F.col("good") & (F.col("n") == 0), "bx_range": F.col("bx") >= 3564}
    return S.violation_report(_checked(spark, sf_dir), checks)


@query(f"WITH {_STREAM} SELECT event, concat_ws(',', CASE WHEN bad_orbit THEN 'orbit' END, CASE WHEN bad_bx THEN 'bx' END, CASE WHEN NOT good THEN 'error' END) AS violations FROM checked WHERE bad_orbit OR bad_bx OR NOT good")
def violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = S.violations({"orbit": F.col("bad_orbit"), "bx": F.col("bad_bx"), "error": ~F.col("good")})
    return _checked(spark, sf_dir).select("event", v.alias("v")).where(F.size("v") > 0).select("event", F.array_join("v", ",").alias("violations"))


_FILES = f"{CAND}, f AS (SELECT supplier % 5 AS file, event, i, w, row_number() OVER (PARTITION BY supplier % 5 ORDER BY event, i) AS round FROM words)"


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir).select((F.col("supplier") % 5).alias("file"), "event", "i", "w")


@query(f"WITH {_FILES} SELECT file, event, i, round FROM f")
def round_robin_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.round_robin(_files(spark, sf_dir), order=("event", "i")).select("file", "event", "i", "round")


@query(f"""WITH {_FILES}, n AS (SELECT file, count(*) AS n FROM f GROUP BY file), m AS (SELECT n AS m, file AS first FROM n ORDER BY n, file LIMIT 1)
  SELECT file, event, i, round FROM f, m WHERE round <= CASE WHEN file < first THEN m + 2 WHEN file = first THEN m ELSE m + 1 END""")
def round_robin_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.round_robin(_files(spark, sf_dir), order=("event", "i"), stop_first=True).select("file", "event", "i", "round")


@query(f"WITH {HEADERS} SELECT event, event % 4 AS file, orbit, row_number() OVER (PARTITION BY event % 4, orbit ORDER BY event) AS round FROM ev")
def frd_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = parsed(spark, sf_dir).withColumn("file", F.col("event") % 4)
    return S.orbit_interleaved(e, order=("event",)).select("event", "file", "orbit", "round")


@query(f"WITH {HEADERS} SELECT run, orbit, count(*) AS rows, count(*) - 3 AS clashes FROM ev GROUP BY run, orbit HAVING count(DISTINCT bx // 6 % 3) = 3")
def demux_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = parsed(spark, sf_dir).withColumn("slot", F.floor(F.col("bx") / 6) % 3)
    return S.complete_groups(e, ["run", "orbit"], "slot", 3)


@query("SELECT (o_custkey * 37) % 3564 // 6 * 6 AS bx, count(*) AS n FROM orders GROUP BY 1")
def bx_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    bx = F.floor((F.col("o_custkey") * 37) % 3564 / 6).cast("long") * 6
    return table(spark, sf_dir, "orders").groupBy(bx.alias("bx")).agg(F.count("*").alias("n"))


@query(f"WITH {HEADERS} SELECT run, round(avg(n), 6) AS mean, max(n) AS most FROM ev GROUP BY run")
def multiplicity_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed(spark, sf_dir).groupBy("run").agg(F.round(F.avg("n"), 6).alias("mean"), F.max("n").alias("most"))


@query(f"WITH {HEADERS} SELECT event, bx % 36 // 6 AS timeslice FROM ev")
def tmux_stripe(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = parsed(spark, sf_dir).withColumn("bx", F.floor(F.col("bx") / 6).cast("long"))
    return S.striped(e, 6).select("event", "timeslice")


@query(f"""WITH {HEADERS}, s AS (SELECT orbit, bx, ((orbit * 1103515245 + bx * 12345 + 37 * 2654435761) % 2147483647) % 25 AS template FROM ev)
  SELECT orbit, bx, template, n_name AS name FROM s JOIN nation ON n_nationkey = template""")
def resample_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots filled with templates drawn by a hash of orbit, crossing and seed; nations stand for templates."""
    templates = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("template"), F.col("n_name").alias("name"))
    return S.resampled(parsed(spark, sf_dir).select("orbit", "bx"), templates, 25, 37)


@query(f"""WITH {CAND}, n AS (SELECT event, count(*) AS n FROM words GROUP BY event)
  SELECT event, i // 4 AS frame, string_agg((CASE WHEN i = 0 THEN '1' ELSE '0' END) || (CASE WHEN i = n - 1 THEN '1' ELSE '0' END) || '1 ' || lpad(lower(to_hex(w)), 16, '0'), ' ' ORDER BY i) AS line
  FROM words JOIN n USING (event) GROUP BY event, i // 4""")
def emp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text frames of four words with start, end and valid flags."""
    from ..sinks.text import frames

    return frames(word_arrays(spark, sf_dir))
