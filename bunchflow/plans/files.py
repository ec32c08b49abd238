"""Queries that write files and read them back: rolling runs, captures, snapshots, Arrow layouts, damaged files."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import candidates as C
from ..operators import streams as S
from ..operators.selection import LOOSE, triplets
from ..sinks.framed import capture, read_snapshot, register, rolled, write_rolling
from ..sources import framing
from ..sources.files import filesystem
from ..sources.framed import check_files, listed, read_arrow, read_events, read_orbits, read_run_headers
from ..streaming.live import scratch
from .decode import MUON
from .fixtures import CAND, HEADERS, triplet_sql, word_arrays
from .fixtures import events as candidate_events
from .framing import FILE_BITS, LUMI_BITS, parsed
from .wire import BACK, digest, events, written_events

QUERIES: dict = {}
ORACLES: dict = {}
RUN = 37


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _put(path: str, data: bytes) -> None:
    store, at = filesystem(path)
    store.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(at) as f:
        f.write(data)


_UNITS = f"{HEADERS}, per AS (SELECT orbit, CAST(ceil(sum(8 + 8 * n) / 32.0) AS BIGINT) AS units, sum(8 + 8 * n)::BIGINT AS bytes, min(run) AS any_run FROM ev GROUP BY orbit)"


@query(f"WITH {_UNITS} SELECT orbit, units, false AS error, units = 1 AS truncated FROM per")
def headers_only_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orbits and their sizes from block headers; payloads are passed unread."""
    return read_orbits(spark, written_events(spark, sf_dir, "dth256"), "dth256").select("orbit", "units", "error", "truncated")


@query(BACK)
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files cut into ranges of a few orbits, decoded apart."""
    return digest(read_events(spark, written_events(spark, sf_dir, "dth_oa"), "dth_oa", split_bytes=20_000))


def _timeslice():
    return F.lit(1)


def _rolling(spark: SparkSession, sf_dir: str, headers: bool, prescale: int = 1) -> str:
    at = scratch(spark)
    rows = rolled(events(spark, sf_dir), _timeslice(), RUN, LUMI_BITS, FILE_BITS, mux=1, prescale=prescale, headers=headers)
    write_rolling(rows, at, headers, order=("bx", "event"))
    return at


_RUN_BACK = BACK.replace("ev.run,", f"{RUN & 31}::BIGINT AS run,")


@query(_RUN_BACK)
def rolling_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling run files with their headers, read back."""
    return digest(read_events(spark, f"{_rolling(spark, sf_dir, True)}/run*/*.raw", "frd"))


@query(_RUN_BACK.replace("FROM ev JOIN d USING (event)", "FROM ev JOIN d USING (event) WHERE orbit % 3 = 1"))
def rolling_prescaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third orbit in bare rolling files, whose orbits end in zero words."""
    return digest(read_events(spark, f"{_rolling(spark, sf_dir, False, 3)}/run*/*.raw", "native64sz"))


_FILES = f"""{_UNITS}, keyed AS (SELECT *, (orbit >> {LUMI_BITS}) + 1 AS ls, (orbit - 1) >> {FILE_BITS} AS g FROM per), f AS (
  SELECT ls, min(orbit) & {(1 << LUMI_BITS) - 1} AS i, count(*) AS orbits, 32 + sum(24 + 32 * units)::BIGINT AS bytes FROM keyed GROUP BY ls, g
)"""


@query(f"WITH {_FILES} SELECT printf('run%06d_ls%04d_index%06d_ts01.raw', {RUN}, ls, i) AS name, orbits, {RUN}::BIGINT AS run, ls AS lumi, bytes, bytes AS length, NULL::VARCHAR AS violation FROM f")
def rolling_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the headers of rolling files say, from 32 bytes of each."""
    found = read_run_headers(spark, f"{_rolling(spark, sf_dir, True)}/run*/*.raw")
    return found.select(F.regexp_extract("file", "[^/]+$", 0).alias("name"), "orbits", "run", "lumi", "bytes", "length", "violation")


@query(f"WITH {_FILES} SELECT unnest(['run', 'lumi', 'orbits']) AS \"column\", unnest([1::BIGINT, count(DISTINCT ls), count(DISTINCT orbits)]) AS values FROM f")
def header_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the files of a run agree: more than one value of a header's field is a disagreement."""
    return S.agreeing(read_run_headers(spark, f"{_rolling(spark, sf_dir, True)}/run*/*.raw"), ["run", "lumi", "orbits"])


def _captured(kind: str, to: str, every: int, most: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        at = scratch(spark)
        capture(read_events(spark, written_events(spark, sf_dir, kind), kind), at, to, every, most)
        return digest(read_events(spark, at, to))

    return run


_SEQ = f"""{HEADERS.strip()}, o AS (
  SELECT orbit, row_number() OVER (ORDER BY orbit) AS number, bytes FROM (SELECT orbit, sum(8 + 8 * n)::BIGINT AS bytes FROM ev GROUP BY orbit)
), kept AS (
  SELECT orbit, sum(bytes) OVER (ORDER BY orbit) AS total FROM o WHERE number % {{every}} = 0
)"""
_CAPTURED = BACK.replace(HEADERS.strip(), _SEQ) + " WHERE ev.orbit IN (SELECT orbit FROM kept WHERE total <= {most})"

@query(_CAPTURED.format(every=2, most=4_000_000_000))
def capture_native128(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second orbit of framed records, stripped of its frame."""
    return _captured("dth_oa", "native128", 2, 4_000_000_000)(spark, sf_dir)


@query(_CAPTURED.format(every=3, most=60_000))
def capture_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third orbit of 256-bit blocks, while they take 60,000 bytes."""
    return _captured("dth256", "native64", 3, 60_000)(spark, sf_dir)


@query("SELECT o AS orbit, o % 5 = 0 AS truncated, o % 5 = 0 AS error FROM (SELECT unnest(range(1, 61)) AS o)")
def truncated_orbits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncated orbits with wrong numbers get the expected ones."""
    at = scratch(spark)
    words = np.arange(4, dtype=np.int64)
    parts = [framing.dth256_truncated(o + 7 * (o % 2)) if o % 5 == 0 else framing.dth256_orbit([(3, o, bx, True, words) for bx in (0, 6)]) for o in range(1, 61)]
    _put(f"{at}/part.raw", b"".join(parts))
    return read_orbits(spark, at, "dth256", split_bytes=500).select("orbit", "truncated", "error")


def _damaged() -> dict[str, tuple[str, bytes]]:
    """name -> (kind, bytes) of a file with one fault for each check."""
    es = [(3, 7, 6 * i, True, np.arange(300 + i)) for i in range(4)] + [(3, 8, 0, False, np.zeros(0, np.int64))]
    whole = {k: e(es) for k, e in framing.ENCODERS.items()}

    def put(kind: str, at: int, value: int) -> bytes:
        out = bytearray(whole[kind])
        out[at] = value
        return bytes(out)

    sound = {f"sound_{k}": (k, x) for k, x in whole.items()}
    one = framing.dth_oa_orbit(es[:1])
    faults = {
        "v01_magic": ("dth256", put("dth256", 0, 0)),
        "v02_short_block": ("dth256", put("dth256", 6, 200)),
        "v03_start_bit": ("dth256", put("dth256", 5, 0)),
        "v05_header_tag": ("dth", put("dth", 16 + 15, 0)),
        "v05_trailer_tag": ("dth", put("dth", len(one) - 1, 0)),
        "v06_event_tag": ("native64", put("native64", 7, 0)),
        "v07_length": ("dth_oa", put("dth_oa", len(whole["dth_oa"]) - 6, 0x33)),
        "v08_event_size": ("dth", framing.dth_oa_orbit(es[:2])),
        "v09_trailer_orbit": ("dth", put("dth", len(one) - 12, 9)),
        "v10_record": ("dth_oa", put("dth_oa", 16 + 8, 5)),
        "v12_file_magic": ("frd", put("frd", 0, 0)),
        "v13_file_size": ("frd", put("frd", 24, 1)),
        "v14_orbit_version": ("frd", put("frd", 32, 5)),
        "v15_event_orbit": ("frd", put("frd", 44, 9)),
        "v16_orbits": ("frd", put("frd", 12, 9)),
        "v17_run": ("frd", whole["frd"][:16] + b"\0\0\0\0" + whole["frd"][20:]),
        "v18_partial": ("native64", whole["native64"][:-4]),
    }
    return sound | faults


_NAMES = sorted(_damaged())


@query(f"SELECT unnest({_NAMES!r}) AS name, unnest([{', '.join(str(not n.startswith('sound')).lower() for n in _NAMES)}]) AS broken, unnest([{', '.join(str(not n.startswith('sound')).lower() for n in _NAMES)}]) AS kept_bytes")
def damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sound file of each format, and a file for each check that it must fail; the bytes from the fault on are kept."""
    at, out = scratch(spark), None
    for name, (kind, data) in _damaged().items():
        _put(f"{at}/{kind}/{name}", data)
    for kind in framing.ENCODERS:
        found = check_files(spark, f"{at}/{kind}", kind)
        out = found if out is None else out.unionByName(found)
    return out.select(F.regexp_extract("file", "[^/]+$", 0).alias("name"), F.col("violation").isNotNull().alias("broken"), F.col("bad").isNotNull().alias("kept_bytes"))


def _written(rows: DataFrame, at: str, **options: str) -> None:
    register(rows.sparkSession)
    writer = rows.write.format("arrowipc")
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.mode("append").save(at)


_PUPPI_INTS = "event long, c array<struct<pt: int, eta: smallint, phi: smallint, pid: smallint, z0: smallint, dxy: tinyint, quality: smallint, wpuppi: int>>"


@query(f"WITH {CAND} SELECT event, i, pt, eta, phi, pid, z0, dxy, quality, wpuppi::BIGINT AS wpuppi FROM ints")
def arrow_int_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The integer collection layout with its unsigned and narrow types, as an Arrow file, a task for each record batch."""
    at = scratch(spark)
    rows = word_arrays(spark, sf_dir).select("event", C.structs(F.col("words"), C.puppi_ints).alias("c"))
    _written(rows, at, compression="lz4", types="pt=uint16,eta=int16,phi=int16,pid=uint8,z0=int16,dxy=int8,quality=uint8,wpuppi=uint16")
    back = read_arrow(spark, at, _PUPPI_INTS).select("event", F.posexplode("c").alias("i", "x"))
    return back.select("event", F.col("i").cast("long").alias("i"), *[F.col(f"x.{c}").cast("long").alias(c) for c in ("pt", "eta", "phi", "pid", "z0", "dxy", "quality", "wpuppi")])


@query(f"WITH {CAND} SELECT event, i, pt, wpuppi, pdgid::BIGINT AS pdgid, quality, true AS near FROM floats")
def arrow_half_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floats as 16 bits: steps that 16 bits hold come back whole, angles within a part in 1,000."""
    at = scratch(spark)
    rows = word_arrays(spark, sf_dir).select("event", C.structs(F.col("words"), C.puppi_floats).alias("c"), C.structs(F.col("words"), C.puppi_floats)["eta"].cast("array<double>").alias("eta"))
    _written(rows, at, half="true")
    back = read_arrow(spark, at, "event long, c array<struct<pt: float, eta: float, phi: float, pdgId: int, z0: float, dxy: float, wpuppi: float, quality: long>>, eta array<double>")
    back = back.select("event", F.posexplode(F.arrays_zip("c", "eta")).alias("i", "x"))
    near = F.abs(F.col("x.c.eta") - F.col("x.eta")) <= F.abs(F.col("x.eta")) * 0.001 + 1e-4
    return back.select("event", F.col("i").cast("long").alias("i"), F.col("x.c.pt").cast("double").alias("pt"), F.col("x.c.wpuppi").cast("double").alias("wpuppi"), F.col("x.c.pdgId").cast("long").alias("pdgid"), F.col("x.c.quality").cast("long").alias("quality"), near.alias("near"))


_MUONS = f"{MUON}, m AS (SELECT event, k, (lo >> 1) & 65535 AS pt, CASE WHEN hi & 1 = 1 THEN -1 ELSE 1 END AS charge, (hi >> 1) & 255 AS quality, (hi >> 9) & 15 AS isolation FROM mu)"


def _muons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_arrays(spark, sf_dir).select("event", C.muon_structs(F.col("words")).alias("m"))


@query(f"{_MUONS} SELECT event, k, CAST(CAST(pt AS FLOAT) * CAST(0.03125 AS FLOAT) AS DOUBLE) AS pt, charge::BIGINT AS charge, quality, isolation FROM m")
def muon_arrow_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Muons as an Arrow stream of structs of floats."""
    at = scratch(spark)
    _written(_muons(spark, sf_dir), at, mode="stream", compression="zstd")
    back = read_arrow(spark, at, "event long, m array<struct<pt: float, phi: float, eta: float, z0: float, d0: float, charge: int, quality: long, isolation: long, beta: float>>")
    back = back.select("event", F.posexplode("m").alias("k", "x"))
    return back.select("event", F.col("k").cast("long").alias("k"), F.col("x.pt").cast("double").alias("pt"), *[F.col(f"x.{c}").cast("long").alias(c) for c in ("charge", "quality", "isolation")])


@query(f"{_MUONS} SELECT event, count(*) AS n, sum(pt)::BIGINT AS pt, sum(charge)::BIGINT AS charge, sum(quality & 15)::BIGINT AS quality, sum(isolation)::BIGINT AS isolation FROM m GROUP BY event")
def muon_vector_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Muons as one array a field, in Parquet and back."""
    at = scratch(spark)
    names = ["pt", "phi", "eta", "z0", "d0", "charge", "quality", "isolation", "beta"]
    rows = word_arrays(spark, sf_dir).select("event", C.muon_structs(F.col("words"), C.muon_ints).alias("m")).where(F.size("m") > 0)
    rows.select("event", *C.arrays(F.col("m"), names, "TkMu")).write.option("compression", "lz4").parquet(at)

    def total(c: str):
        return F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))

    return spark.read.parquet(at).select("event", F.col("nTkMu").cast("long").alias("n"), *[total(f"TkMu_{c}").alias(c) for c in ("pt", "charge", "quality", "isolation")])


@query(f"WITH {CAND} SELECT event, count(*) AS n, sum(pt)::BIGINT AS pt, sum(eta)::BIGINT AS eta, sum(dxy)::BIGINT AS dxy, sum(wpuppi)::BIGINT AS wpuppi FROM ints GROUP BY event")
def vector_layout_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates as one array a field, in Parquet and back."""
    at = scratch(spark)
    names = ["pt", "eta", "phi", "pid", "z0", "dxy", "quality", "wpuppi"]
    word_arrays(spark, sf_dir).select("event", C.structs(F.col("words"), C.puppi_ints).alias("c")).select("event", *C.arrays(F.col("c"), names, "Puppi")).write.parquet(at)

    def total(c: str):
        return F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))

    return spark.read.parquet(at).select("event", F.col("nPuppi").cast("long").alias("n"), *[total(f"Puppi_{c}").alias(c) for c in ("pt", "eta", "dxy", "wpuppi")])


def selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected events: event, run, orbit, bx, good, words, i1, i2, i3, mass."""
    best = triplets(candidate_events(spark, sf_dir), LOOSE).select("event", "i1", "i2", "i3", "mass")
    head = parsed(spark, sf_dir).select("event", F.col("run").cast("int").alias("run"), "orbit", F.col("bx").cast("int").alias("bx"), "good")
    return best.join(head, "event").join(word_arrays(spark, sf_dir), "event")


_PICKED = f"""WITH {triplet_sql(LOOSE)}, {HEADERS.strip()}, per AS (
  SELECT event, count(*) AS n, sum(pt)::BIGINT AS pt, sum(eta)::BIGINT AS eta, sum(phi)::BIGINT AS phi, sum(z0)::BIGINT AS z0, sum(dxy)::BIGINT AS dxy,
    sum(wpuppi)::BIGINT AS wpuppi, sum(quality)::BIGINT AS quality, sum(pid)::BIGINT AS pid, sum(w % 1000003)::BIGINT AS digest FROM ints GROUP BY event
)"""


@query(
    f"""{_PICKED}, s AS (SELECT event, sum(pdgid)::BIGINT AS pdgid, sum(pt) AS pt_sum FROM floats GROUP BY event)
SELECT ev.run::BIGINT AS run, ev.orbit, ev.bx::BIGINT AS bx, ev.good, per.n, s.pt_sum AS pt, s.pdgid, per.quality, 15::BIGINT AS columns, i1, i2, i3, round(CAST(CAST(mass AS FLOAT) AS DOUBLE), 2) AS mass
FROM best JOIN ev USING (event) JOIN per USING (event) JOIN s USING (event)"""
)
def snapshot_15_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole snapshot in Parquet and back: four keys, the size, eight arrays, the triplet's places and mass, each of its type."""
    at = scratch(spark)
    names = ["pt", "eta", "phi", "pdgId", "z0", "dxy", "wpuppi", "quality"]
    rows = selected(spark, sf_dir).withColumn("c", C.structs(F.col("words"), C.puppi_floats))
    columns = C.arrays(F.col("c"), names, "Puppi")
    places = F.array("i1", "i2", "i3").alias("Triplet_Index")
    rows.select("run", "orbit", "bx", "good", *columns, places, F.col("mass").cast("float").alias("Triplet_Mass")).write.parquet(at)
    back = spark.read.parquet(at)

    def total(c: str, kind: str):
        return F.aggregate(c, F.lit(0).cast(kind), lambda s, x: s + x.cast(kind))

    return back.select(
        F.col("run").cast("long").alias("run"), "orbit", F.col("bx").cast("long").alias("bx"), "good", F.col("nPuppi").cast("long").alias("n"), total("Puppi_pt", "double").alias("pt"), total("Puppi_pdgId", "long").alias("pdgid"),
        total("Puppi_quality", "long").alias("quality"), F.lit(len(back.columns)).cast("long").alias("columns"), *[F.get("Triplet_Index", F.lit(i)).alias(f"i{i + 1}") for i in range(3)], F.round(F.col("Triplet_Mass").cast("double"), 2).alias("mass"),
    )


@query(f"{_PICKED} SELECT ev.run::BIGINT AS run, ev.orbit, ev.bx::BIGINT AS bx, ev.good, per.n, per.digest, i1, i2, i3, round(CAST(CAST(mass AS FLOAT) AS DOUBLE), 2) AS mass FROM best JOIN ev USING (event) JOIN per USING (event)")
def raw_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected events as they came, with their triplet, in a binary file and back."""
    register(spark)
    at = scratch(spark)
    rows = selected(spark, sf_dir).select("run", "orbit", "bx", "good", "words", "i1", "i2", "i3", F.col("mass").cast("float").alias("mass"))
    rows.write.format("rawsnapshot").mode("append").save(at)

    def run(it):
        from ..sources.files import opened

        for batch in it:
            for path in batch.column(0).to_pylist():
                with opened(path) as f:
                    got = [(*e[:4], len(e[4]), int((e[4] % 1000003).sum()), *places, float(mass)) for e, places, mass in read_snapshot(f.read())]
                types = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 5, pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in got], t) for i, t in enumerate(types)], names=["run", "orbit", "bx", "good", "n", "digest", "i1", "i2", "i3", "mass"])

    back = listed(spark, at).mapInArrow(run, "run long, orbit long, bx long, good boolean, n long, digest long, i1 long, i2 long, i3 long, mass double")
    return back.withColumn("mass", F.round("mass", 2))


@query(f"{_PICKED} SELECT ev.orbit, ev.bx::BIGINT AS bx, per.n, per.digest, i1, i2, i3 FROM best JOIN ev USING (event) JOIN per USING (event)")
def raw_snapshot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a table: packed words, the triplet's places and its mass."""
    at = scratch(spark)
    selected(spark, sf_dir).select("run", "orbit", "bx", "good", F.size("words").alias("nPuppi"), F.col("words").alias("Puppi_packed"), F.array("i1", "i2", "i3").alias("Triplet_Index"), F.col("mass").cast("float").alias("Triplet_Mass")).write.parquet(at)
    total = F.aggregate("Puppi_packed", F.lit(0).cast("long"), lambda s, w: s + w % 1000003)
    return spark.read.parquet(at).select("orbit", F.col("bx").cast("long").alias("bx"), F.col("nPuppi").cast("long").alias("n"), total.alias("digest"), *[F.get("Triplet_Index", F.lit(i)).alias(f"i{i + 1}") for i in range(3)])


# The type matrix: nested Arrow types with values that follow from the row's number.
MATRIX_ROWS, MATRIX_BATCHES = 250, 8


def _matrix(first: int) -> pa.RecordBatch:
    e = np.arange(first, first + MATRIX_ROWS)
    ints = lambda i: 37 * e + 11 * i
    reals = lambda i: 0.7 * math.pi * e - 4.414 * i
    lengths = e % 3 + 5

    def each(values, kind) -> pa.Array:
        """Lists of lengths e % 3 + 5, element i from values(i)."""
        flat = np.concatenate([np.array([values(i)[r] for i in range(n)]) for r, n in enumerate(lengths)])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), pa.array(flat).cast(kind, safe=False))

    def fixed(values, n: int, kind) -> pa.Array:
        flat = np.stack([values(i) for i in range(n)], 1).reshape(-1)
        return pa.FixedSizeListArray.from_arrays(pa.array(flat).cast(kind, safe=False), n)

    flags = lambda i: (i % 3 == 1) | (e % 5 == 0)
    grid = pa.FixedSizeListArray.from_arrays(fixed(lambda i: reals(i), 12, pa.float32()).values, 4)
    members = each(ints, pa.int32())
    sub = pa.StructArray.from_arrays([pa.array(members.values.to_numpy().astype(np.int64) * 1000).cast(pa.uint64(), safe=False), pa.array(members.values.to_numpy() % 2 == 0)], names=["uint64SubMem", "boolSubMem"])
    structs = pa.ListArray.from_arrays(members.offsets, pa.StructArray.from_arrays([each(reals, pa.float32()).values, members.values, sub], names=["floatMem", "intMem", "SubStruct"]))
    columns = {
        "event": pa.array(e),
        "doubleVar": pa.array(reals(0)),
        "int8Var": pa.array((ints(0) % 100).astype(np.int8)),
        "uint8Var": pa.array((ints(0) % 256).astype(np.uint8)),
        "int16Var": pa.array((ints(0) % 30000).astype(np.int16)),
        "uintVar": pa.array(ints(0).astype(np.uint32)),
        "int64Var": pa.array(ints(0) * 1000),
        "boolVar": pa.array(flags(0)),
        "uint16FixList": fixed(ints, 2, pa.uint16()),
        "boolFixList": fixed(flags, 5, pa.bool_()),
        "int8List64": each(lambda i: ints(i) % 100, pa.int8()).cast(pa.large_list(pa.int8())),
        "floats3x4": pa.FixedSizeListArray.from_arrays(grid, 3),
        "GlobalStruct": pa.StructArray.from_arrays([pa.array((ints(3) % 65536).astype(np.uint16)), each(reals, pa.float32())], names=["uint16", "floats"]),
        "Struct": structs,
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


_MATRIX = """event long, doubleVar double, int8Var tinyint, uint8Var smallint, int16Var smallint, uintVar long, int64Var long, boolVar boolean, uint16FixList array<int>, boolFixList array<boolean>,
int8List64 array<tinyint>, floats3x4 array<array<float>>, GlobalStruct struct<uint16: int, floats: array<float>>, Struct array<struct<floatMem: float, intMem: int, SubStruct: struct<uint64SubMem: long, boolSubMem: boolean>>>"""


@query(
    f"""SELECT e AS event, round(0.7 * pi() * e, 6) AS d, 37 * e % 100 AS i8, 37 * e % 256 AS u8, 37 * e % 30000 AS i16, 37 * e AS u32, 37000 * e AS i64, e % 5 = 0 AS b, (37 * e + 11) % 65536 AS fix2,
  e % 3 + 5 AS n, list_sum([(37 * e + 11 * i) % 100 for i in range(e % 3 + 5)])::BIGINT AS list_sum, 12::BIGINT AS grid, (37 * e + 33) % 65536 AS in_struct, list_sum([37 * e + 11 * i for i in range(e % 3 + 5)])::BIGINT AS members,
  1000 * list_sum([37 * e + 11 * i for i in range(e % 3 + 5)])::BIGINT AS subs FROM (SELECT unnest(range({MATRIX_ROWS * MATRIX_BATCHES})) AS e)"""
)
def type_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nested types in eight record batches of an Arrow file, read with their flattened columns."""
    at = scratch(spark)
    sink = pa.BufferOutputStream()
    parts = [_matrix(i * MATRIX_ROWS) for i in range(MATRIX_BATCHES)]
    with pa.ipc.new_file(sink, parts[0].schema) as w:
        for x in parts:
            w.write_batch(x)
    _put(f"{at}/matrix.arrow", sink.getvalue().to_pybytes())
    rows = read_arrow(spark, at, _MATRIX)

    def total(c):
        return F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))

    n = F.size("int8List64").cast("long")
    return rows.select(
        "event", F.round("doubleVar", 6).alias("d"), *[F.col(c).cast("long").alias(a) for c, a in (("int8Var", "i8"), ("uint8Var", "u8"), ("int16Var", "i16"), ("uintVar", "u32"), ("int64Var", "i64"))], F.col("boolVar").alias("b"),
        F.get("uint16FixList", F.lit(1)).cast("long").alias("fix2"), n.alias("n"), total("int8List64").alias("list_sum"), F.size(F.flatten("floats3x4")).cast("long").alias("grid"),
        F.col("GlobalStruct.uint16").cast("long").alias("in_struct"), total("Struct.intMem").alias("members"), total("Struct.SubStruct.uint64SubMem").alias("subs"),
    )


@query(f"""WITH {CAND}, {HEADERS.strip()}, t AS (SELECT event, row_number() OVER (ORDER BY event) - 1 AS template FROM (SELECT DISTINCT event FROM words ORDER BY event LIMIT 100)),
d AS (SELECT template, least(count(*), 4) AS n, sum(CASE WHEN i < 4 THEN w % 1000003 END)::BIGINT AS digest FROM words JOIN t USING (event) GROUP BY template),
s AS (SELECT orbit, bx, ((orbit * 1103515245 + bx * 12345 + {RUN} * 2654435761) % 2147483647) % 100 AS template FROM ev)
SELECT orbit, bx, n, digest FROM s JOIN d USING (template)""")
def resample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots filled with the payloads of template events, cropped, drawn by a hash of orbit, crossing and seed."""
    templates = word_arrays(spark, sf_dir).orderBy("event").limit(100)
    templates = S.numbered(templates, "event", number="template").select("template", F.slice("words", 1, 4).alias("words"))
    filled = S.resampled(parsed(spark, sf_dir).select("orbit", "bx"), templates, 100, RUN)
    total = F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + w % 1000003)
    return filled.select("orbit", "bx", F.size("words").cast("long").alias("n"), total.alias("digest"))


@query(f"""WITH {HEADERS}, r AS (SELECT run, count(*) AS events, (count(*) + sum(n)::BIGINT) * 8 AS bytes, (max(orbit) - min(orbit) + 1) * 3564 / 40000000.0 AS seconds FROM ev GROUP BY run)
SELECT run, events, round((events / seconds / 1000.0)::DOUBLE, 4) AS khz, round((bytes / seconds / 1073741824.0)::DOUBLE, 9) AS gb_per_s, round((40000000.0 / (events / seconds))::DOUBLE, 4) AS slower FROM r""")
def rate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = parsed(spark, sf_dir).groupBy("run").agg(F.count("*").alias("events"), ((F.count("*") + F.sum("n")) * 8).alias("bytes"), ((F.max("orbit") - F.min("orbit") + 1) * 3564 / F.lit(40e6)).alias("seconds"))
    found = S.rates(per, F.col("events"), F.col("bytes"), F.col("seconds"))
    return found.select("run", "events", F.round("khz", 4).alias("khz"), F.round("gb_per_s", 9).alias("gb_per_s"), F.round("slower", 4).alias("slower"))
