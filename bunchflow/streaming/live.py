"""Live operators: windows of orbits, running totals, time demultiplexing with state, live selection.

A file source's checkpoint takes the place of renaming files to claim them: a
file is read once, and a restarted query goes on where it stopped.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors see: in the shared one, or, in local mode alone, a temporary one where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    base = base or tempfile.mkdtemp(prefix="bunchflow-live-")
    return f"{base.rstrip('/')}/live/{uuid.uuid4().hex}"


def watched(spark: SparkSession, path: str, schema, files_per_batch: int | None = None, pattern: str | None = None, clean: str | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream; clean: "delete" or "archive" what has been read."""
    reader = spark.readStream.schema(schema)
    for k, v in (("maxFilesPerTrigger", files_per_batch), ("pathGlobFilter", pattern), ("cleanSource", clean)):
        if v:
            reader = reader.option(k, v)
    return reader.parquet(path)


def orbit_windows(events: DataFrame, bits: int, mux: int = 1, key: str = "orbit") -> Column:
    """Key of a tumbling window of 2**bits orbits that opens at orbit = mux modulo its length."""
    return F.shiftright(F.col(key) - mux, bits)


def drained(stream: DataFrame, mode: str, each: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Runs a stream over all that is there now and returns its result as a table.

    append: every batch's rows are kept; complete: the last batch's. A batch
    that is run again after a failure writes the same folder again.
    """
    spark = stream.sparkSession
    at = scratch(spark)

    def keep(batch: DataFrame, number: int) -> None:
        folder = "last" if mode == "complete" else f"batch={number}"
        batch.write.mode("overwrite").parquet(f"{at}/out/{folder}")
        if each:
            each(batch, number)

    # an empty first folder gives the result its schema, should no batch come
    spark.createDataFrame([], stream.schema).write.parquet(f"{at}/out/{'last' if mode == 'complete' else 'batch=-1'}")
    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out/last" if mode == "complete" else f"{at}/out/batch=*")


def demultiplexed(parts: DataFrame, slots: int, expire: str | None = None) -> DataFrame:
    """(orbit, rows, clashes) of each orbit once all its slots have come; parts: orbit long, slot int.

    The state of an orbit is one bit mask and two counts. It goes when the orbit
    is complete; with `expire`, also when nothing more came for that long, which
    never changes complete orbits' rows.
    """
    full = (1 << slots) - 1

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        mask, rows, clashes = state.get if state.exists else (0, 0, 0)
        for batch in batches:
            for slot, n in batch["slot"].value_counts().items():
                bit = 1 << int(slot)
                clashes += int(n) - (0 if mask & bit else 1)
                mask, rows = mask | bit, rows + int(n)
        if mask == full:
            state.remove()
            yield pd.DataFrame({"orbit": [key[0]], "rows": [rows], "clashes": [clashes]})
        else:
            state.update((mask, rows, clashes))
            if expire:
                state.setTimeoutDuration(expire)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if expire else GroupStateTimeout.NoTimeout
    return parts.groupBy("orbit").applyInPandasWithState(update, "orbit long, rows long, clashes long", "mask long, rows long, clashes long", "append", timeout)


def gaps(events: DataFrame, orbit_step: int = 1, bx_step: int = 6, first_bx: int = 0) -> DataFrame:
    """(stream, pos, orbit, bx, bad_orbit, bad_bx) of the breaks in streams; events: stream, pos, orbit, bx as long.

    The state of a stream is its last orbit and crossing; a batch's events are
    taken by pos, and batches in the order in which they come. The first event is exempt.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values("pos", kind="stable")
        last = state.get if state.exists else (None, None)
        orbit, bx = (rows[c].shift(1) for c in ("orbit", "bx"))
        if last[0] is not None:
            orbit.iloc[0], bx.iloc[0] = last
        same = rows["orbit"] == orbit
        known = orbit.notna()
        bad_orbit = known & ~same & (rows["orbit"] != orbit + orbit_step)
        bad_bx = known & ((same & (rows["bx"] != bx + bx_step)) | (~same & (rows["bx"] != first_bx)))
        state.update((int(rows["orbit"].iloc[-1]), int(rows["bx"].iloc[-1])))
        out = rows.assign(bad_orbit=bad_orbit, bad_bx=bad_bx)[bad_orbit | bad_bx]
        yield out[["stream", "pos", "orbit", "bx", "bad_orbit", "bad_bx"]]

    schema = "stream long, pos long, orbit long, bx long, bad_orbit boolean, bad_bx boolean"
    return events.select("stream", "pos", "orbit", "bx").groupBy("stream").applyInPandasWithState(update, schema, "orbit long, bx long", "append", GroupStateTimeout.NoTimeout)


def paced(spark: SparkSession, orbits_per_second: int, slots: int = 594, tmux: int = 6, partitions: int | None = None) -> DataFrame:
    """A stream of slots (orbit, bx) at a given rate of orbits, for generators that keep time."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", orbits_per_second)
    ticks = (ticks.option("numPartitions", partitions) if partitions else ticks).load()
    return ticks.select((F.col("value") + 1).alias("orbit"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit((slots - 1) * tmux).cast("long"), F.lit(tmux).cast("long"))).alias("bx"))


def observed(events: DataFrame) -> tuple[DataFrame, Observation]:
    """events, and their totals once an action has read them: events, words and events in error."""
    seen = Observation()
    return events.observe(seen, F.count(F.lit(1)).alias("events"), F.coalesce(F.sum("n"), F.lit(0)).alias("words"), F.coalesce(F.sum((~F.col("good")).cast("long")), F.lit(0)).alias("errors")), seen
