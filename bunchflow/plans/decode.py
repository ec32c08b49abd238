"""Queries that pack and decode words and change layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import candidates as C
from ..functions.bits import hex_word
from ..functions.headers import orbit_header, orbits_of_duration, parse_event_header, parse_orbit_header
from .fixtures import CAND, HEADERS, header_words, table, word_arrays, words

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@query(f"WITH {HEADERS} SELECT event, run, orbit, bx, n, good FROM ev")
def header_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = parse_event_header(F.col("h"))
    return header_words(spark, sf_dir).select("event", *[h[k].alias(k) for k in ("run", "orbit", "bx", "n", "good")])


@query(f"WITH {HEADERS} SELECT event, h, true AS same FROM hw")
def header_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.headers import event_header

    p = parse_event_header(F.col("h"))
    return header_words(spark, sf_dir).select("event", "h", (event_header(p["run"], p["orbit"], p["bx"], p["n"], ~p["good"]) == F.col("h")).alias("same"))


@query(f"WITH {HEADERS} SELECT event, run, (h >> 24) & 1073741823 AS orbit FROM ev")
def header_parse_short_orbit(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = parse_event_header(F.col("h"), orbit_bits=30)
    return header_words(spark, sf_dir).select("event", h["run"].alias("run"), h["orbit"].alias("orbit"))


@query("SELECT o_orderkey AS k, 1 + o_orderkey // 594 AS orbit, (o_custkey * 17) % 16777216 AS length, o_orderkey % 97 <> 0 AS good, true AS tagged FROM orders")
def orbit_header_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    w = table(spark, sf_dir, "orders").select(k.alias("k"), orbit_header(F.floor(k / 594) + 1, F.col("o_custkey") * 17, k % 97 == 0).alias("w"))
    p = parse_orbit_header(F.col("w"))
    return w.select("k", *[p[x].alias(x) for x in ("orbit", "length", "good", "tagged")])


@query(f"WITH {CAND} SELECT event, i, pt, eta, phi, pid, z0, dxy, quality, wpuppi FROM ints")
def puppi_decode_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = C.puppi_ints(F.col("w"))
    return words(spark, sf_dir).select("event", "i", *[c.cast("long").alias(k) for k, c in p.items()])


@query(f"WITH {CAND} SELECT event, i, pt, eta, phi, CAST(pdgid AS BIGINT) AS pdgid, z0, dxy, wpuppi, quality FROM floats")
def puppi_decode_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = C.puppi_floats(F.col("w"))
    whole = ("pdgId", "quality")
    return words(spark, sf_dir).select("event", "i", *[c.cast("long" if k in whole else "double").alias(k.lower()) for k, c in p.items()])


@query(f"WITH {CAND} SELECT pdgid::BIGINT AS pdgid, count(*) AS n, min(pid) AS pid FROM floats GROUP BY pdgid")
def pdgid_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = C.pid(F.col("w"))
    return words(spark, sf_dir).select(C.pdg_id(code).cast("long").alias("pdgid"), code.alias("pid")).groupBy("pdgid").agg(F.count("*").alias("n"), F.min("pid").alias("pid"))


@query(f"WITH {CAND} SELECT pid > 1 AS charged, count(*) AS n, sum(z0)::BIGINT AS z0, sum(dxy)::BIGINT AS dxy, sum(wpuppi)::BIGINT AS wpuppi, sum(quality)::BIGINT AS quality FROM ints GROUP BY pid > 1")
def charged_neutral_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = C.puppi_ints(F.col("w"))
    rows = words(spark, sf_dir).select(C.charged(F.col("w")).alias("charged"), *[p[k].cast("long").alias(k) for k in ("z0", "dxy", "wpuppi", "quality")])
    return rows.groupBy("charged").agg(F.count("*").alias("n"), *[F.sum(k).alias(k) for k in ("z0", "dxy", "wpuppi", "quality")])


@query(f"WITH {CAND} SELECT event, i, CASE WHEN pid > 1 THEN CASE WHEN pid IN (3, 5, 7) THEN 1 ELSE -1 END ELSE 0 END::BIGINT AS charge FROM ints")
def candidate_charge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir).select("event", "i", C.charge(C.pid(F.col("w"))).cast("long").alias("charge"))


MUON = f"""WITH {CAND}, block AS (
  SELECT a.event, a.i // 3 AS block, a.w AS w0, b.w AS w1, c.w AS w2 FROM words a
  LEFT JOIN words b ON b.event = a.event AND b.i = a.i + 1 LEFT JOIN words c ON c.event = a.event AND c.i = a.i + 2 WHERE a.i % 3 = 0
), mu AS (
  SELECT event, 2 * block AS k, w0 AS lo, w1 & 4294967295 AS hi FROM block WHERE w1 IS NOT NULL
  UNION ALL SELECT event, 2 * block + 1, w2, (w1 >> 32) & 4294967295 FROM block WHERE w2 IS NOT NULL
)"""
_MUON_INTS = """(lo >> 1) & 65535 AS pt, ((lo >> 17) & 8191) - 8192 * ((lo >> 29) & 1) AS phi, ((lo >> 30) & 16383) - 16384 * ((lo >> 43) & 1) AS eta,
  ((lo >> 44) & 1023) - 1024 * ((lo >> 53) & 1) AS z0, ((lo >> 54) & 1023) - 1024 * ((lo >> 63) & 1) AS d0,
  CASE WHEN hi & 1 = 1 THEN -1 ELSE 1 END AS charge"""


@query(f"{MUON} SELECT event, k, {_MUON_INTS}, (hi >> 1) & 15 AS quality, (hi >> 9) & 15 AS isolation, (hi >> 13) & 15 AS beta FROM mu".replace("THEN -1 ELSE 1 END AS charge", "THEN -1 ELSE 1 END::BIGINT AS charge"))
def tkmu_decode_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = word_arrays(spark, sf_dir).select("event", F.posexplode(C.muon_structs(F.col("words"), C.muon_ints)).alias("k", "m"))
    return rows.select("event", F.col("k").cast("long").alias("k"), *[F.col(f"m.{x}").cast("long").alias(x) for x in ("pt", "phi", "eta", "z0", "d0", "charge", "quality", "isolation", "beta")])


@query(
    f"""{MUON}, m AS (SELECT event, k, {_MUON_INTS}, (hi >> 1) & 255 AS quality, (hi >> 9) & 15 AS isolation, (hi >> 13) & 15 AS beta FROM mu)
SELECT event, k, CAST(CAST(pt AS FLOAT) * CAST(0.03125 AS FLOAT) AS DOUBLE) AS pt, CAST(CAST(phi AS FLOAT) * CAST(0.0007669903939428206 AS FLOAT) AS DOUBLE) AS phi,
  CAST(CAST(eta AS FLOAT) * CAST(0.0007669903939428206 AS FLOAT) AS DOUBLE) AS eta, CAST(CAST(z0 AS FLOAT) * CAST(0.05 AS FLOAT) AS DOUBLE) AS z0,
  CAST(CAST(d0 AS FLOAT) * CAST(0.03 AS FLOAT) AS DOUBLE) AS d0, CAST(charge AS BIGINT) AS charge, quality, isolation,
  CAST(CAST(beta AS FLOAT) * CAST(0.06 AS FLOAT) AS DOUBLE) AS beta FROM m"""
)
def tkmu_decode_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = word_arrays(spark, sf_dir).select("event", F.posexplode(C.muon_structs(F.col("words"))).alias("k", "m"))
    whole = ("charge", "quality", "isolation")
    return rows.select("event", F.col("k").cast("long").alias("k"), *[F.col(f"m.{x}").cast("long" if x in whole else "double").alias(x) for x in ("pt", "phi", "eta", "z0", "d0", "charge", "quality", "isolation", "beta")])


@query(f"WITH {CAND} SELECT event, count(*) AS npuppi, sum(pt)::BIGINT AS pt, min(eta) AS eta, max(phi) AS phi, sum(quality)::BIGINT AS quality FROM ints GROUP BY event")
def layout_soa_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vector layout: one array a field."""
    soa = word_arrays(spark, sf_dir).select("event", C.structs(F.col("words"), C.puppi_ints).alias("c")).select("event", *C.arrays(F.col("c"), ["pt", "eta", "phi", "quality"], "Puppi"))

    def total(c: str):
        return F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))

    return soa.select("event", F.col("nPuppi").cast("long").alias("npuppi"), total("Puppi_pt").alias("pt"), F.array_min("Puppi_eta").alias("eta"), F.array_max("Puppi_phi").alias("phi"), total("Puppi_quality").alias("quality"))


@query(f"WITH {CAND} SELECT event, count(*) AS npuppi, sum(pt)::BIGINT AS pt, min(eta) AS eta, max(phi) AS phi, sum(quality)::BIGINT AS quality FROM ints GROUP BY event")
def layout_aos_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection layout: an array of structs, read back row by row."""
    aos = word_arrays(spark, sf_dir).select("event", F.explode(C.structs(F.col("words"), C.puppi_ints)).alias("c"))
    return aos.groupBy("event").agg(F.count("*").alias("npuppi"), F.sum("c.pt").alias("pt"), F.min("c.eta").alias("eta"), F.max("c.phi").alias("phi"), F.sum(F.col("c.quality").cast("long")).alias("quality"))


@query(f"WITH {CAND} SELECT event, string_agg(w::VARCHAR, ',' ORDER BY i) AS raw FROM words GROUP BY event")
def layout_raw64_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_arrays(spark, sf_dir).select("event", F.array_join(F.transform("words", lambda w: w.cast("string")), ",").alias("raw"))


@query("SELECT vec_id, CAST(len(embedding) AS BIGINT) AS size FROM embeddings")
def size_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size("embedding").cast("long").alias("size"))


@query("SELECT vec_id, CAST(8 AS BIGINT) AS outer_size, CAST(64 AS BIGINT) AS flat_size, CAST(embedding[10] AS DOUBLE) AS at_1_1 FROM embeddings")
def nested_2d_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array as 8 rows of 8, read as a two-dimensional list and flattened again."""
    two = table(spark, sf_dir, "embeddings").select("vec_id", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("embedding", r * 8 + 1, 8)).alias("m"))
    return two.select("vec_id", F.size("m").cast("long").alias("outer_size"), F.size(F.flatten("m")).cast("long").alias("flat_size"), F.get(F.get("m", F.lit(1)), F.lit(1)).cast("double").alias("at_1_1"))


@query("SELECT o_orderkey AS k, o_custkey AS \"head.who.cust\", o_totalprice AS \"head.total\" FROM orders")
def struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested structs become columns with dotted names."""
    from ..operators.layouts import flattened

    nested = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.struct(F.struct(F.col("o_custkey").alias("cust")).alias("who"), F.col("o_totalprice").alias("total")).alias("head"))
    return flattened(nested)


@query(f"WITH {CAND} SELECT event, i, CAST(pdgid AS BIGINT) AS pdgid, pt FROM floats")
def mc_alias_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A simulation layout's names and wide integers, read as the usual ones."""
    f = C.puppi_floats(F.col("w"))
    mc = words(spark, sf_dir).select("event", "i", f["pt"].alias("L1Puppi_pt"), f["pdgId"].cast("int").alias("L1Puppi_pdgId"))
    usual = mc.withColumnsRenamed({"L1Puppi_pt": "pt", "L1Puppi_pdgId": "pdgid"}).withColumn("pdgid", F.col("pdgid").cast("short"))
    return usual.select("event", "i", F.col("pdgid").cast("long").alias("pdgid"), F.col("pt").cast("double").alias("pt"))


@query(f"WITH {CAND} SELECT event, i, pt, eta FROM floats")
def int_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of integers, lifted to floats element by element."""
    ints = word_arrays(spark, sf_dir).select("event", C.structs(F.col("words"), C.puppi_ints).alias("c"))
    lifted = ints.select("event", F.transform("c.pt", lambda x: x.cast("float") * F.lit(C.PT_STEP).cast("float")).alias("pt"), F.transform("c.eta", lambda x: x.cast("float") * F.lit(C.ANGLE_STEP).cast("float")).alias("eta"))
    return lifted.select("event", F.posexplode(F.arrays_zip("pt", "eta")).alias("i", "x")).select("event", F.col("i").cast("long").alias("i"), F.col("x.pt").cast("double").alias("pt"), F.col("x.eta").cast("double").alias("eta"))


@query(f"WITH {CAND} SELECT event, i, pt, CAST(CASE WHEN z0 = 0 THEN 0 ELSE sign(z0) * floor(abs(z0) / pow(2.0, floor(log2(abs(z0))) - 15)) * pow(2.0, floor(log2(abs(z0))) - 15) END AS DOUBLE) AS z0 FROM floats")
def float24_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = C.puppi_floats(F.col("w"))
    return words(spark, sf_dir).select("event", "i", C.float24(f["pt"]).cast("double").alias("pt"), C.float24(f["z0"]).cast("double").alias("z0"))


@query(f"WITH {CAND} SELECT event, i, lpad(lower(to_hex(w)), 16, '0') AS frame FROM words")
def hex_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words(spark, sf_dir).select("event", "i", hex_word(F.col("w")).alias("frame"))


@query("SELECT n_nationkey::BIGINT AS k, CASE n_nationkey % 4 WHEN 0 THEN floor(11223.34455667789e0 * n_nationkey) WHEN 1 THEN floor(11223.34455667789e0 * n_nationkey) WHEN 2 THEN floor(11223.34455667789e0 * n_nationkey * 60) ELSE floor(11223.34455667789e0 * n_nationkey * 3600) END::BIGINT AS orbits FROM nation")
def duration_orbits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    unit = F.element_at(F.array(*map(F.lit, ["", "s", "m", "h"])), k % 4 + 1)
    return table(spark, sf_dir, "nation").select(k.cast("long").alias("k"), orbits_of_duration(F.concat(k.cast("string"), unit)).alias("orbits"))
