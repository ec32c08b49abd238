"""Deterministic event streams made from the driver's order tables, in Spark and in SQL.

An event is an order; its candidates are the order's lines. All formulas are
whole-number arithmetic, so both engines make the same words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.candidates import puppi_floats, puppi_word
from ..functions.headers import event_header

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event, supplier, i and the integer fields of each candidate."""
    c = F.col
    i = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)) - 1
    return table(spark, sf_dir, "lineitem").select(
        c("l_orderkey").alias("event"),
        c("l_suppkey").alias("supplier"),
        i.cast("long").alias("i"),
        (c("l_quantity") * 4).cast("long").alias("pt"),
        (F.round(c("l_extendedprice") * 100).cast("long") % 1440 - 720).alias("eta"),
        ((c("l_partkey") * 37 + c("l_linenumber") * 211) % 1440 - 720).alias("phi"),
        ((c("l_orderkey") * 7 + c("l_linenumber") * 3 + c("l_suppkey")) % 8).alias("pid"),
        (F.round(c("l_discount") * 100).cast("long") * 8 - 40).alias("z0"),
        (F.round(c("l_tax") * 100).cast("long") * 4 - 16).alias("dxy"),
        (c("l_linenumber") % 8).cast("long").alias("quality"),
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event, supplier, i, w: one packed candidate a row."""
    c = F.col
    return fields(spark, sf_dir).select("event", "supplier", "i", puppi_word(c("pt"), c("eta"), c("phi"), c("pid"), c("z0"), c("dxy"), c("quality")).alias("w"))


def word_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event, words: the event's packed candidates in order."""
    rows = words(spark, sf_dir).groupBy("event").agg(F.sort_array(F.collect_list(F.struct("i", "w"))).alias("x"))
    return rows.select("event", F.col("x.w").alias("words"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event, cands: array of (i, pt, eta, phi, pid) with double fields, as the selection takes them."""
    f = puppi_floats(F.col("w"))
    rows = words(spark, sf_dir).select("event", "i", *[f[k].cast("double").alias(k) for k in ("pt", "eta", "phi")], F.shiftright("w", 37).bitwiseAND(F.lit(7)).alias("pid"))
    return rows.groupBy("event").agg(F.sort_array(F.collect_list(F.struct("i", "pt", "eta", "phi", "pid"))).alias("cands"))


def header_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event, h, suppliers' least key as stream: one header a row."""
    k = F.col("l_orderkey")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    h = event_header(k % 32, F.floor(k / 594) + 1, (k % 594) * 6, F.when(k % 97 == 0, 0).otherwise(F.col("n")), k % 97 == 0)
    return rows.select(k.alias("event"), h.alias("h"))


# The same in SQL: common table expressions that an oracle starts with.
CAND = """
cand AS (
  SELECT l_orderkey AS event, l_suppkey AS supplier,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS i,
    CAST(l_quantity * 4 AS BIGINT) AS pt,
    CAST(round(l_extendedprice * 100) AS BIGINT) % 1440 - 720 AS eta,
    (l_partkey * 37 + l_linenumber * 211) % 1440 - 720 AS phi,
    (l_orderkey * 7 + l_linenumber * 3 + l_suppkey) % 8 AS pid,
    CAST(round(l_discount * 100) AS BIGINT) * 8 - 40 AS z0,
    CAST(round(l_tax * 100) AS BIGINT) * 4 - 16 AS dxy,
    CAST(l_linenumber % 8 AS BIGINT) AS quality
  FROM lineitem
), words AS (
  SELECT event, supplier, i, pt + (eta & 4095) * 16384 + (phi & 2047) * 67108864 + pid * 137438953472
    + (z0 & 1023) * 1099511627776 + (dxy & 255) * 1125899906842624 + quality * 288230376151711744 AS w
  FROM cand
), raw AS (
  SELECT event, supplier, i, w, w & 16383 AS pt, ((w >> 14) & 4095) - 4096 * ((w >> 25) & 1) AS eta,
    ((w >> 26) & 2047) - 2048 * ((w >> 36) & 1) AS phi, (w >> 37) & 7 AS pid,
    ((w >> 40) & 1023) - 1024 * ((w >> 49) & 1) AS s10, ((w >> 50) & 255) - 256 * ((w >> 57) & 1) AS s8,
    (w >> 58) & 7 AS q3, (w >> 40) & 1023 AS u10, (w >> 50) & 63 AS u6
  FROM words
), ints AS (
  SELECT event, supplier, i, w, pt, eta, phi, pid, CASE WHEN pid > 1 THEN s10 ELSE 0 END AS z0, CASE WHEN pid > 1 THEN s8 ELSE 0 END AS dxy,
    CASE WHEN pid > 1 THEN q3 ELSE u6 END AS quality, CASE WHEN pid > 1 THEN 256 ELSE u10 END AS wpuppi
  FROM raw
), floats AS (
  SELECT event, supplier, i, pid, CAST(CAST(pt AS FLOAT) * CAST(0.25 AS FLOAT) AS DOUBLE) AS pt,
    CAST(CAST(eta AS FLOAT) * CAST(0.004363323129985824 AS FLOAT) AS DOUBLE) AS eta,
    CAST(CAST(phi AS FLOAT) * CAST(0.004363323129985824 AS FLOAT) AS DOUBLE) AS phi,
    [130, 22, -211, 211, 11, -11, 13, -13][pid + 1] AS pdgid,
    CAST(CAST(z0 AS FLOAT) * CAST(0.05 AS FLOAT) AS DOUBLE) AS z0, CAST(CAST(dxy AS FLOAT) * CAST(0.05 AS FLOAT) AS DOUBLE) AS dxy,
    CAST(CAST(wpuppi AS FLOAT) * CAST(0.00390625 AS FLOAT) AS DOUBLE) AS wpuppi, quality
  FROM ints
)
"""

HEADERS = """
hw AS (
  SELECT l_orderkey AS event, (-9223372036854775807 - 1) + CASE WHEN l_orderkey % 97 = 0 THEN 2305843009213693952 ELSE 0 END
    + (l_orderkey % 32) * 72057594037927936 + (1 + l_orderkey // 594) * 16777216 + (l_orderkey % 594) * 6 * 4096
    + CASE WHEN l_orderkey % 97 = 0 THEN 0 ELSE count(*) END AS h
  FROM lineitem GROUP BY l_orderkey
), ev AS (
  SELECT event, h, (h >> 56) & 31 AS run, (h >> 24) & 4294967295 AS orbit, (h >> 12) & 4095 AS bx, h & 4095 AS n, ((h >> 61) & 1) = 0 AS good
  FROM hw
)
"""

_WRAP = "({0} - 6.283185307179586 * round(({0}) / 6.283185307179586))"


def separation(a: str, b: str) -> str:
    """dR squared of two aliases in SQL."""
    d = _WRAP.format(f"({a}.phi - {b}.phi)")
    return f"(({a}.eta - {b}.eta) * ({a}.eta - {b}.eta) + {d} * {d})"


def triplet_sql(cuts) -> str:
    """CTEs floats .. best: the best triplet of each event by self-joins."""
    charge = "CASE WHEN {0}.pid IN (3, 5, 7) THEN 1 ELSE -1 END"
    mass = "sqrt(greatest(pow({e}, 2) - pow({x}, 2) - pow({y}, 2) - pow({z}, 2), 0))".format(
        e=" + ".join(f"sqrt({p}.pt * {p}.pt * pow((exp({p}.eta) + exp(-{p}.eta)) / 2, 2) + 0.01948816)" for p in "abc"),
        x=" + ".join(f"{p}.pt * cos({p}.phi)" for p in "abc"),
        y=" + ".join(f"{p}.pt * sin({p}.phi)" for p in "abc"),
        z=" + ".join(f"{p}.pt * (exp({p}.eta) - exp(-{p}.eta)) / 2" for p in "abc"),
    )

    def before(a: str, b: str) -> str:
        return f"({a}.pt > {b}.pt OR ({a}.pt = {b}.pt AND {a}.i < {b}.i))"

    return f"""{CAND}, pre AS (
  SELECT event FROM floats WHERE pid BETWEEN 2 AND 5 GROUP BY event
  HAVING count(*) FILTER (WHERE pt >= {cuts.pt1}) >= 3 AND count(*) FILTER (WHERE pt >= {cuts.pt2}) >= 2 AND count(*) FILTER (WHERE pt >= {cuts.pt3}) >= 1
), pion AS (
  SELECT c.event, c.i, c.pt, c.eta, c.phi, c.pid FROM floats c JOIN pre USING (event)
  LEFT JOIN floats x ON x.event = c.event AND x.i <> c.i AND {separation('c', 'x')} BETWEEN {cuts.ring_low} AND {cuts.ring_high}
  WHERE c.pid BETWEEN 2 AND 5 AND c.pt >= {cuts.pt1}
  GROUP BY c.event, c.i, c.pt, c.eta, c.phi, c.pid HAVING coalesce(sum(x.pt), 0) / c.pt <= {cuts.max_iso}
), trip AS (
  SELECT a.event, a.i AS i1, b.i AS i2, c.i AS i3, a.pt + b.pt + c.pt AS pt_sum, {mass} AS mass, a.pt AS pa, b.pt AS pb, c.pt AS pc
  FROM pion a JOIN pion b ON a.event = b.event AND {before('a', 'b')} AND a.pt >= {cuts.pt3} AND b.pt >= {cuts.pt2} AND {separation('a', 'b')} >= {cuts.min_dr2}
  JOIN pion c ON c.event = a.event AND {before('b', 'c')} AND {separation('a', 'c')} >= {cuts.min_dr2} AND {separation('b', 'c')} >= {cuts.min_dr2}
  WHERE abs({charge.format('a')} + {charge.format('b')} + {charge.format('c')}) = 1
), best AS (
  SELECT * FROM trip WHERE mass BETWEEN {cuts.min_mass} AND {cuts.max_mass}
  QUALIFY row_number() OVER (PARTITION BY event ORDER BY pt_sum DESC, pa DESC, i1, pb DESC, i2, pc DESC, i3) = 1
)"""
