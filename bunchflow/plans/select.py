"""Queries of the physics selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.kinematics import delta_phi, delta_r2
from ..operators.selection import LOOSE, TIGHT, cut_flow, histogram, isolation, preselected, triplets
from .fixtures import CAND, events, separation, triplet_sql

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


_BEST = "SELECT event, i1, i2, i3, pt_sum, round(mass, 3) AS mass FROM best"


def _best(spark: SparkSession, sf_dir: str, cuts) -> DataFrame:
    return triplets(events(spark, sf_dir), cuts).withColumn("mass", F.round("mass", 3))


@query(f"WITH {triplet_sql(LOOSE)} {_BEST}")
def triplet_best_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(spark, sf_dir, LOOSE)


@query(f"WITH {triplet_sql(TIGHT)} {_BEST}")
def triplet_best_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(spark, sf_dir, TIGHT)


_PRE = """WITH {cand} SELECT event, count(*) FILTER (WHERE pid BETWEEN 2 AND 5 AND pt >= {c.pt1}) >= 3
  AND count(*) FILTER (WHERE pid BETWEEN 2 AND 5 AND pt >= {c.pt2}) >= 2 AND count(*) FILTER (WHERE pid BETWEEN 2 AND 5 AND pt >= {c.pt3}) >= 1 AS passed
  FROM floats GROUP BY event"""


@query(_PRE.format(cand=CAND, c=LOOSE))
def preselect_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event", preselected(F.col("cands"), LOOSE).alias("passed"))


@query(_PRE.format(cand=CAND, c=TIGHT))
def preselect_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event", preselected(F.col("cands"), TIGHT).alias("passed"))


@query(f"""WITH {CAND} SELECT c.event, c.i, round(coalesce(sum(x.pt), 0) / c.pt, 6) AS iso FROM floats c
  LEFT JOIN floats x ON x.event = c.event AND x.i <> c.i AND {separation('c', 'x')} BETWEEN 0.0001 AND 0.0625 GROUP BY c.event, c.i, c.pt""")
def isolation_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each candidate's isolation, inside its event's array: no shuffle beyond the nesting."""
    iso = F.transform("cands", lambda c: F.struct(c["i"].alias("i"), F.round(isolation(c, F.col("cands"), LOOSE), 6).alias("iso")))
    return events(spark, sf_dir).select("event", F.explode(iso).alias("x")).select("event", "x.i", "x.iso")


@query(f"""WITH {CAND} SELECT a.event, a.i AS i, b.i AS j, round({separation('a', 'b')}, 6) AS dr2, round((a.phi - b.phi) - 6.283185307179586 * round((a.phi - b.phi) / 6.283185307179586), 6) AS dphi
  FROM floats a JOIN floats b ON a.event = b.event AND b.i = a.i + 1""")
def pair_deltar(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = events(spark, sf_dir).select("event", F.explode(F.arrays_zip("cands", F.expr("slice(cands, 2, greatest(size(cands) - 1, 0))").alias("next"))).alias("p")).select("event", F.col("p.cands").alias("a"), F.col("p.next").alias("b")).where("b IS NOT NULL")
    return pairs.select("event", "a.i", F.col("b.i").alias("j"), F.round(delta_r2(F.col("a.eta"), F.col("a.phi"), F.col("b.eta"), F.col("b.phi")), 6).alias("dr2"), F.round(delta_phi(F.col("a.phi"), F.col("b.phi")), 6).alias("dphi"))


@query(f"""WITH {triplet_sql(LOOSE)}, h AS (SELECT CASE WHEN mass < 0 THEN 0 WHEN mass >= 100 THEN 101 ELSE CAST(floor(mass) AS BIGINT) + 1 END AS bin, count(*) AS entries FROM best GROUP BY 1)
  SELECT b.bin, CAST(b.bin - 1 AS DOUBLE) AS lo, CAST(b.bin AS DOUBLE) AS hi, coalesce(entries, 0) AS entries FROM (SELECT unnest(range(0, 102)) AS bin) b LEFT JOIN h ON h.bin = b.bin""")
def mass_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(triplets(events(spark, sf_dir), LOOSE), "mass", 100, 0.0, 100.0)


_FLOW = """WITH {t} SELECT n_all, n_pre, n_pass, round(n_pre / n_all, 9) AS f_pre, round(n_pass / n_all, 9) AS f_pass
  FROM (SELECT (SELECT count(DISTINCT event) FROM floats) AS n_all, (SELECT count(*) FROM pre) AS n_pre, (SELECT count(*) FROM best) AS n_pass)"""


@query(_FLOW.format(t=triplet_sql(LOOSE)))
def cutflow_loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_flow(events(spark, sf_dir), LOOSE)


@query(_FLOW.format(t=triplet_sql(TIGHT)))
def cutflow_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_flow(events(spark, sf_dir), TIGHT)


@query(f"""WITH {triplet_sql(LOOSE)}, per AS (SELECT event, count(*) AS npuppi, sum(pt) AS sum_pt FROM floats GROUP BY event)
  SELECT event, npuppi, sum_pt, i1, i2, i3, CAST(round(mass, 2) AS DOUBLE) AS mass FROM best JOIN per USING (event)""")
def snapshot_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected events with their candidates' digest and triplet, as a snapshot keeps them."""
    e = events(spark, sf_dir)
    per = e.select("event", "cands", F.size("cands").cast("long").alias("npuppi"), F.aggregate("cands", F.lit(0.0), lambda s, c: s + c["pt"]).alias("sum_pt"))
    return triplets(per, LOOSE).select("event", "npuppi", "sum_pt", "i1", "i2", "i3", F.round("mass", 2).alias("mass"))


@query(f"WITH {CAND} SELECT event, count(*) AS n, max(pt) AS lead_pt, arg_max(i, pt * 1000 - i) AS lead FROM floats GROUP BY event HAVING count(*) FILTER (WHERE sin(phi) > 0 AND round(cos(eta), 2) < 0.9) > 0")
def array_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Array predicates with trigonometry, sizes and the leading element."""
    e = events(spark, sf_dir).where(F.exists("cands", lambda c: (F.sin(c["phi"]) > 0) & (F.round(F.cos(c["eta"]), 2) < 0.9)))
    lead = F.sort_array(F.transform("cands", lambda c: F.struct((-c["pt"]).alias("o"), c["i"].alias("i"))))[0]
    return e.select("event", F.size("cands").cast("long").alias("n"), (-lead["o"]).alias("lead_pt"), lead["i"].alias("lead"))
