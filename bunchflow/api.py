"""The toolkit's programs as Python functions: check, receive, generate, unpack, analyse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import candidates as C
from .operators import streams as S
from .operators.selection import LOOSE, TIGHT, Cuts, cut_flow, histogram, triplets
from .sinks.framed import capture, register, rolled, with_suffix, write_rolling
from .sinks.text import write_histogram
from .sources.files import filesystem
from .sources.framed import check_files, listed, read_events, read_orbits

#: Layouts of unpacked events: candidates or muons, as floats, 24-bit floats or integers, by field or by struct; or packed words.
LAYOUTS = ("float", "float24", "int", "coll_float", "coll_int", "raw64")
CUTS = {"loose": LOOSE, "tight": TIGHT}


def check(spark: SparkSession, path: str, kind: str, tmux: int = 6, orbit_mux: int = 1, max_orbits: int | None = None, headers_only: bool = False) -> DataFrame:
    """(kind of violation, rows) over the files at path; with headers_only, one row of totals from headers alone."""
    if headers_only:
        return read_orbits(spark, path, kind, orbit_mux).agg(F.count("*").alias("orbits"), F.coalesce(F.sum(F.col("truncated").cast("long")), F.lit(0)).alias("truncated"), F.coalesce(F.sum("units"), F.lit(0)).alias("units"))
    events = read_events(spark, path, kind, headers=True)
    events = S.first_orbits(events, max_orbits) if max_orbits else events
    checked = S.continuity(events, ["file"], ["pos"], orbit_mux, tmux)
    checks = {"orbit": F.col("bad_orbit"), "bx": F.col("bad_bx"), "truncated": ~F.col("good") & (F.col("n") == 0), "bx_range": F.col("bx") >= 3564}
    files = check_files(spark, path, kind).agg(F.lit("framing").alias("kind"), F.count("violation").alias("rows"))
    return S.violation_report(checked, checks).unionByName(files)


def receive(spark: SparkSession, path: str, kind: str, out: str, prescale: int = 1, most_bytes: int = 4_000_000_000) -> None:
    """Captures orbits of framed files as a native file: records as padded 128-bit events, 256-bit blocks as 64-bit words."""
    capture(read_events(spark, path, kind), out, "native128" if kind.startswith("dth_oa") else "native64", prescale, most_bytes)


def roll(spark: SparkSession, path: str, kind: str, out: str, run: int, timeslice: int = 0, lumi_bits: int = 18, file_bits: int = 12, orbit_mux: int = 1, prescale: int = 1, headers: bool = True) -> None:
    """Writes the files at path as rolling run files."""
    events = read_events(spark, path, kind).select("run", "orbit", "bx", "good", "words")
    write_rolling(rolled(events, F.lit(timeslice), run, lumi_bits, file_bits, orbit_mux, prescale, headers), out, headers)


def generate(spark: SparkSession, templates: DataFrame, out: str, kind: str, orbits: int, tmux: int = 6, orbit_mux: int = 1, timeslice: int = 0, run: int = 37, seed: int = 37, streams: int = 1) -> None:
    """Writes `orbits` orbits of events whose words are drawn from templates (an array column words), a file a stream.

    Stream s takes the crossings timeslice + s modulo tmux. Payloads are cropped to 207 words.
    """
    register(spark)
    n = templates.count()
    numbered = S.numbered(templates.select(F.slice("words", 1, 207).alias("words")).withColumn("at", F.monotonically_increasing_id()), "at", number="template").drop("at")
    slots = spark.range(orbits).select((F.col("id") * orbit_mux + orbit_mux).alias("orbit")).select("orbit", F.explode(F.sequence(F.lit(0), F.lit(streams - 1))).alias("stream"))
    slots = slots.select("orbit", "stream", F.explode(F.sequence(F.lit(timeslice) + F.col("stream"), F.lit(3563), F.lit(tmux))).alias("bx"))
    rows = S.resampled(slots, numbered, n, seed).select("stream", F.lit(run & 31).alias("run"), "orbit", "bx", F.lit(True).alias("good"), "words")
    rows.repartition(streams, "stream").sortWithinPartitions("stream", "orbit", "bx").write.format("framed").option("kind", kind).option("streams", "true").mode("append").save(out)


def unpacked(events: DataFrame, obj: str = "puppi", layout: str = "float") -> DataFrame:
    """events (run, orbit, bx, good, words) in a layout; obj: puppi or tkmu."""
    head = ["run", "orbit", "bx", "good"]
    if layout == "raw64":
        return events.select(*head, F.size("words").alias("nPuppi" if obj == "puppi" else "nWords"), F.col("words").alias("Puppi_packed" if obj == "puppi" else "TkMu_packed"))
    if obj == "puppi":
        ints, prefix = "int" in layout, "Puppi"
        c = C.structs(F.col("words"), C.puppi_ints if ints else C.puppi_floats)
        names = list((C.puppi_ints if ints else C.puppi_floats)(F.lit(0)))
    else:
        ints, prefix = "int" in layout, "TkMu"
        decoder = C.muon_ints if ints else C.muon_floats
        c, names = C.muon_structs(F.col("words"), decoder), list(decoder(F.lit(0), F.lit(0)))
    if layout == "float24":
        whole = {"pdgId", "quality", "charge", "isolation"}
        c = F.transform(c, lambda x: F.struct(*[(x[n] if n in whole else C.float24(x[n])).alias(n) for n in names]))
    if layout.startswith("coll"):
        return events.select(*head, c.alias(prefix))
    return events.select(*head, c.alias("c")).select(*head, *C.arrays(F.col("c"), names, prefix))


def unpack(spark: SparkSession, path: str, out: str | None, obj: str = "puppi", layout: str = "float", kind: str = "native64", sink: str = "parquet", compression: str = "zstd", delete: bool = False) -> str | None:
    """Decodes files to Parquet or Arrow and returns where; without `out`, or with delete, nothing stays."""
    rows = unpacked(read_events(spark, path, kind), obj, layout)
    if out is None:
        rows.write.format("noop").mode("overwrite").save()
        return None
    at = with_suffix(out, sink)
    register(spark)
    rows.write.format(sink).option("compression", compression).mode("append").save(at)
    if delete:
        store, place = filesystem(at)
        store.delete_dir(place)
        return None
    return at


def analyse(events: DataFrame, cuts: str | Cuts = "loose", output: str = "none", path: str | None = None) -> DataFrame:
    """The cut flow of events (key columns and cands); output: none, histo, rawhisto or snapshot, written to path."""
    chosen = CUTS[cuts] if isinstance(cuts, str) else cuts
    if output in ("histo", "rawhisto"):
        found = histogram(triplets(events, chosen), "mass", 100, 0.0, 100.0)
        write_histogram(found, path) if output == "rawhisto" else found.write.mode("overwrite").parquet(path)
    elif output == "snapshot":
        triplets(events.withColumn("candidates", F.col("cands")), chosen).write.mode("overwrite").parquet(path)
    return cut_flow(events, chosen)


def sizes(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files at a path."""
    return listed(spark, path)
