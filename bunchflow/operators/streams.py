"""Operators over event streams: sampling, continuity, merging, time demultiplexing, file keys, validation.

Order always comes from a position column, never from how rows are partitioned.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.headers import LUMI_BITS, lumisection


def prescaled(events: DataFrame, factor: int, phase: int = 0, by: str = "orbit") -> DataFrame:
    """Every factor-th value of a column; the phase is taken modulo the factor, so it can always match."""
    return events if factor <= 1 else events.where(F.pmod(F.col(by), F.lit(factor)) == phase % factor)


def first_orbits(events: DataFrame, n: int) -> DataFrame:
    """Events of the n least orbits; only distinct orbits are ranked."""
    least = events.select("orbit").distinct().orderBy("orbit").limit(n)
    return events.join(least, "orbit", "left_semi")


#: Bits of an order column below its bucket: a bucket is what one task orders.
BUCKET_BITS = 16


def _bucketed(rows: DataFrame, stream: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """rows with __bucket, so that streams are ordered bucket by bucket, by many tasks.

    The first order column makes the buckets if it is a whole number; else a stream is one bucket.
    """
    whole = rows.schema[order[0]].dataType.typeName() in ("byte", "short", "integer", "long")
    bucket = F.shiftright(F.col(order[0]).cast("long"), BUCKET_BITS) if whole else F.lit(0).cast("long")
    return rows.withColumn("__bucket", bucket), [*stream, "__bucket"]


def _joined(rows: DataFrame, per: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows with per's columns; keys may be null."""
    same = functools.reduce(lambda x, k: x & F.col(f"r.{k}").eqNullSafe(F.col(f"p.{k}")), keys, F.lit(True))
    return rows.alias("r").join(per.alias("p"), same).select("r.*", *[f"p.{c}" for c in per.columns if c not in keys])


def numbered(rows: DataFrame, order: str | Sequence[str], sums: dict[str, str] | None = None, stream: Sequence[str] = (), number: str = "number", where: Callable[[Column], Column] | None = None) -> DataFrame:
    """rows with their number from 0 in each stream, and sums of columns over all rows before, as {column: new column}.

    Rows are counted and added up in buckets of the order column; only one row a
    bucket is put in order for a whole stream. where: a condition on the number
    of the rows that the sums take.
    """
    order, sums = [order] if isinstance(order, str) else list(order), sums or {}
    rows, keys = _bucketed(rows, stream, order)
    inside, across = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*stream).orderBy("__bucket")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    per = rows.groupBy(*keys).agg(F.count("*").alias("__rows"))
    per = per.withColumn("__first", F.coalesce(F.sum("__rows").over(earlier), F.lit(0))).drop("__rows")
    rows = _joined(rows, per, keys).withColumn(number, F.row_number().over(inside) - 1 + F.col("__first")).drop("__first")
    if sums:
        taken = {c: F.when(where(F.col(number)), F.col(c)).otherwise(0) if where else F.col(c) for c in sums}
        per = rows.groupBy(*keys).agg(*[F.sum(x).alias(f"__{c}") for c, x in taken.items()])
        per = per.select(*keys, *[F.coalesce(F.sum(f"__{c}").over(earlier), F.lit(0)).alias(f"__before_{c}") for c in sums])
        rows = _joined(rows, per, keys)
        rows = rows.withColumns({new: F.coalesce(F.sum(taken[c]).over(before), F.lit(0)) + F.col(f"__before_{c}") for c, new in sums.items()})
        rows = rows.drop(*[f"__before_{c}" for c in sums])
    return rows.drop("__bucket")


def within_bytes(events: DataFrame, size: Column, most: int, stream: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Leading events of each stream whose running size stays below `most`."""
    sized = numbered(events.withColumn("__size", size), order, {"__size": "__total"}, stream, "__number")
    return sized.where(F.col("__total") + F.col("__size") <= most).drop("__size", "__total", "__number")


def preceded(rows: DataFrame, columns: Sequence[str], stream: Sequence[str], order: Sequence[str]) -> DataFrame:
    """rows with __before, a struct of the columns of the row before in the stream, null at its start."""
    rows, keys = _bucketed(rows, stream, order)
    inside, across = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*stream).orderBy("__bucket")
    held = F.struct(*columns)
    per = rows.groupBy(*keys).agg(F.max_by(held, F.struct(*order)).alias("__last"))
    per = per.withColumn("__earlier", F.lag("__last").over(across)).drop("__last")
    return _joined(rows, per, keys).withColumn("__before", F.coalesce(F.lag(held).over(inside), "__earlier")).drop("__earlier", "__bucket")


def continuity(events: DataFrame, stream: Sequence[str], order: Sequence[str], orbit_step: int = 1, bx_step: int = 6, first_bx: int = 0) -> DataFrame:
    """events with bad_orbit and bad_bx: breaks against the event before in the stream (the first is exempt).

    The orbit either stays or grows by orbit_step; the bunch crossing grows by
    bx_step within an orbit and starts at first_bx in a new one.
    """
    before_orbit, before_bx = F.col("__before.orbit"), F.col("__before.bx")
    same = F.col("orbit") == before_orbit
    return preceded(events, ["orbit", "bx"], stream, order).withColumns({
        "bad_orbit": before_orbit.isNotNull() & ~same & (F.col("orbit") != before_orbit + orbit_step),
        "bad_bx": before_orbit.isNotNull() & F.when(same, F.col("bx") != before_bx + bx_step).otherwise(F.col("bx") != first_bx),
    }).drop("__before")


def truncation(events: DataFrame, complete_only: bool = False, stream: Sequence[str] = ("run",)) -> DataFrame:
    """(stream, orbit, events, truncated): orbits with their truncated events; an event is truncated if it is empty and in error.

    complete_only leaves the last orbit of each stream out, as a checker that
    counts an orbit when the next one starts does.
    """
    per = events.groupBy(*stream, "orbit").agg(F.count("*").alias("events"), F.sum((~F.col("good") & (F.col("n") == 0)).cast("long")).alias("truncated"))
    if complete_only:
        last = per.groupBy(*stream).agg(F.max("orbit").alias("__last"))
        per = per.join(last, list(stream)).where(F.col("orbit") < F.col("__last")).drop("__last")
    return per


def totals(events: DataFrame) -> DataFrame:
    """One row of events, orbits, candidates, truncated events and bytes, from partial sums."""
    per = truncation(events.withColumn("__n", F.col("n")), stream=())
    sums = events.agg(F.count("*").alias("events"), F.sum("n").alias("candidates"), F.sum((~F.col("good") & (F.col("n") == 0)).cast("long")).alias("truncated"))
    orbits = per.agg(F.count("*").alias("orbits"), F.sum((F.col("truncated") > 0).cast("long")).alias("truncated_orbits"))
    return sums.crossJoin(orbits).withColumn("bytes", (F.col("events") + F.col("candidates")) * 8)


def round_robin(events: DataFrame, files: str = "file", order: Sequence[str] = ("pos",), stop_first: bool = False) -> DataFrame:
    """Events of several files in turn: columns round and file give the merged order.

    stop_first keeps what a reader emits that stops once the first file is
    found exhausted: with m the least number of events and f the first file that
    has it, files before f give up to m + 2 events, f gives m, files after it up
    to m + 1.
    """
    turned = numbered(events, order, stream=[files], number="__number").withColumn("round", F.col("__number") + 1).drop("__number")
    if not stop_first:
        return turned
    sizes = events.groupBy(files).agg(F.count("*").alias("__n"))
    first = sizes.agg(F.min(F.struct("__n", files)).alias("__x")).select(F.col("__x.__n").alias("__m"), F.col(f"__x.{files}").alias("__f"))
    # one row, of a fixed size
    bound = F.col("__m") + F.when(F.col(files) < F.col("__f"), 2).when(F.col(files) == F.col("__f"), 0).otherwise(1)
    return turned.crossJoin(F.broadcast(first)).where(F.col("round") <= bound).drop("__m", "__f")


def orbit_interleaved(events: DataFrame, files: str = "file", order: Sequence[str] = ("pos",)) -> DataFrame:
    """Events of each orbit in turn over the files: columns orbit, round, file give the order."""
    return events.withColumn("round", F.row_number().over(Window.partitionBy(files, "orbit").orderBy(*order)).cast("long"))


def complete_groups(rows: DataFrame, key: Sequence[str], slot: str, slots: int) -> DataFrame:
    """Keys whose slots 0 .. slots - 1 are all there, with the number of rows; slots that clash show in `clashes`."""
    per = rows.groupBy(*key).agg(F.count_distinct(slot).alias("__have"), F.count("*").alias("rows"))
    return per.where(F.col("__have") == slots).select(*key, "rows", (F.col("rows") - F.col("__have")).alias("clashes"))


def file_keys(events: DataFrame, lumi_bits: int = LUMI_BITS, file_bits: int = 12, mux: int = 1) -> DataFrame:
    """events with ls, file_group and file_index: the lumisection, the rolling file, and the file's first orbit in its lumisection."""
    ls = lumisection(F.col("orbit"), lumi_bits)
    group = F.shiftright(F.col("orbit") - mux, file_bits)
    keyed = events.withColumns({"ls": ls, "file_group": group})
    first = keyed.groupBy("run", "ls", "file_group").agg(F.min("orbit").alias("__first"))
    return keyed.join(first, ["run", "ls", "file_group"]).withColumn("file_index", F.col("__first").bitwiseAND(F.lit((1 << lumi_bits) - 1))).drop("__first")


def file_name(run: Column, ls: Column, index: Column, timeslice: Column) -> Column:
    return F.format_string("run%06d_ls%04d_index%06d_ts%02d.raw", run, ls, index, timeslice)


def parse_file_name(name: Column, lumi_bits: int = LUMI_BITS) -> dict[str, Column]:
    """run, ls, index, ts and first orbit of a rolling file's name; null fields where it is none."""

    def part(pattern: str) -> Column:
        got = F.regexp_extract(name, pattern, 1)
        return F.when(got != "", got.cast("long"))

    ls, index = part(r"_ls(\d+)"), part(r"_index(\d+)")
    return {"run": part(r"run(\d+)"), "ls": ls, "index": index, "ts": part(r"_ts(\d+)"), "orbit": F.shiftleft(F.greatest(ls - 1, F.lit(0)), lumi_bits) + index}


def violations(checks: dict[str, Column]) -> Column:
    """Array of the names of the conditions that hold; a null condition counts as not held."""
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))


def violation_report(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(kind, rows) for every check, those without violation included, in one pass."""
    sums = rows.agg(*[F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long").alias(k) for k, c in checks.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("rows")) for k in checks]))
    return sums.select(pairs.alias("x")).select("x.kind", "x.rows")


def strict(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """rows, failing at the first that violates a check."""
    found = violations(checks)
    return rows.withColumn("__ok", F.when(F.size(found) == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("violates "), F.array_join(found, ", "))).cast("boolean"))).where("__ok").drop("__ok")


def resampled(slots: DataFrame, templates: DataFrame, n_templates: int, seed: int, number: str = "template") -> DataFrame:
    """Each slot's template, drawn with replacement by a hash of its orbit, bunch crossing and the seed.

    Integer arithmetic alone, so any engine draws the same; templates are
    numbered 0 .. n_templates - 1 in the column `number`.
    """
    h = F.pmod((F.col("orbit") * 1103515245 + F.col("bx") * 12345 + F.lit(seed) * 2654435761) % 2147483647, F.lit(n_templates))
    return slots.withColumn(number, h).join(templates, number)


def striped(events: DataFrame, tmux: int) -> DataFrame:
    """events with timeslice: bunch crossing modulo the number of time-multiplexed streams."""
    return events.withColumn("timeslice", F.pmod("bx", F.lit(tmux)))


def agreeing(headers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, values): how many different values files' headers have; more than one is a disagreement. One pass."""
    counts = headers.agg(*[F.count_distinct(c).alias(c) for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("values")) for c in columns]))
    return counts.select(pairs.alias("x")).select("x.column", "x.values")


def rates(report: DataFrame, events: Column, nbytes: Column, seconds: Column) -> DataFrame:
    """report with khz, gb_per_s and slower, the factor by which the rate stays below 40 MHz."""
    return report.withColumns({"khz": events / seconds / 1e3, "gb_per_s": nbytes / seconds / 2.0**30, "slower": F.lit(40e6) / (events / seconds)})
