"""Framed event files and Arrow IPC as tables, read in ranges by Arrow batches.

Spark lists the files; a first pass cuts each into ranges that can be decoded on
their own, of which it reads the headers only; the ranges are spread over all
tasks. So a file may have any size, and no task holds more than an orbit, or a
chunk of a native file. Files are opened by Arrow's file systems.

Rows: file, pos (grows along the file), run, orbit, bx, good, n, words (signed
64-bit patterns). headers=True leaves the words out.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import Range, opened
from .framing import DECODERS, FramingError, Seen, cuts, frames, frd_header

_HEAD = "file string, pos long, run int, orbit long, bx int, good boolean, n int"
BATCH_EVENTS = 3564
#: Bytes of a range.
SPLIT_BYTES = 64 << 20


def _batch(path: str, events: list, headers: bool) -> pa.RecordBatch:
    n = len(events)
    columns = [
        pa.array([path] * n, pa.string()),
        pa.array([pos for pos, _ in events], pa.int64()),
        pa.array([e[0] for _, e in events], pa.int32()),
        pa.array([e[1] for _, e in events], pa.int64()),
        pa.array([e[2] for _, e in events], pa.int32()),
        pa.array([e[3] for _, e in events], pa.bool_()),
        pa.array([e[4] if isinstance(e[4], int) else len(e[4]) for _, e in events], pa.int32()),
    ]
    names = ["file", "pos", "run", "orbit", "bx", "good", "n"]
    if not headers:
        bounds = np.concatenate(([0], np.cumsum([len(e[4]) for _, e in events]))).astype(np.int32)
        values = np.concatenate([e[4] for _, e in events]) if n else np.zeros(0, np.int64)
        columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)))
        names.append("words")
    return pa.RecordBatch.from_arrays(columns, names=names)


def _batches(path: str, events: Iterable, headers: bool) -> Iterator[pa.RecordBatch]:
    held: list = []
    for e in events:
        held.append(e)
        if len(held) == BATCH_EVENTS:
            yield _batch(path, held, headers)
            held = []
    yield _batch(path, held, headers)


def listed(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(path, length) of the files at a path or glob."""
    files = spark.read.format("binaryFile")
    return (files.option("pathGlobFilter", pattern) if pattern else files).load(path).select("path", "length")


def ranges(files: DataFrame, kind: str, split_bytes: int) -> DataFrame:
    """(path, begin, end, record, orbit) of ranges of files that can be decoded on their own, spread over tasks."""
    total = files.agg(F.sum("length")).first()[0] or 0

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if length <= split_bytes:
                    found = [(0, length, None, None)]
                else:
                    with opened(path) as f:
                        found = list(cuts(kind, Range(f), split_bytes))
                columns = list(zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(found)), *(pa.array(c, pa.int64()) for c in columns)], names=["path", "begin", "end", "record", "orbit"])

    return files.mapInArrow(run, "path string, begin long, end long, record long, orbit long").repartition(max(1, min(10_000, math.ceil(total / split_bytes))))


def read_events(spark: SparkSession, path: str, kind: str, headers: bool = False, pattern: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Events of the files at a path or glob; kind: a key of framing.DECODERS. A file with bad framing fails its task."""
    decode = DECODERS[kind]
    options = {"headers": True} if headers and kind.startswith("native") else {}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for name, begin, end, record, orbit in zip(*(c.to_pylist() for c in batch.columns)):
                with opened(name) as f:
                    yield from _batches(name, decode(Range(f, begin, end), Seen(record, orbit), places=True, **options), headers)

    return ranges(listed(spark, path, pattern), kind, split_bytes).mapInArrow(run, _HEAD if headers else f"{_HEAD}, words array<bigint>")


def from_buffers(spark: SparkSession, buffers: list[bytes], kind: str) -> DataFrame:
    """Events of buffers in memory; file is the buffer's number."""
    decode = DECODERS[kind]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield from _batches(name, decode(Range(io.BytesIO(data.as_py())), places=True), False)

    return spark.createDataFrame([(str(i), bytearray(x)) for i, x in enumerate(buffers)], "file string, data binary").mapInArrow(run, f"{_HEAD}, words array<bigint>")


def read_orbits(spark: SparkSession, path: str, kind: str, mux: int = 1, pattern: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, pos, orbit, units, error, truncated) of each orbit, or record, of block formats and run files.

    Payloads are passed unread. units: rows of 128 or 256 bits, in run files
    words; truncated: nothing but its frame, or the error bit; the orbit of such
    a record is put right if it isn't `mux` after the one before.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "pos", "orbit", "units", "error", "truncated"]
        for batch in it:
            for name, begin, end, record, orbit in zip(*(c.to_pylist() for c in batch.columns)):
                with opened(name) as f:
                    rows = [(r.at, o, r.units, r.error, t) for r, o, t in frames(kind, Range(f, begin, end), Seen(record, orbit), mux)]
                types = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(types))], names=names)

    return ranges(listed(spark, path, pattern), kind, split_bytes).mapInArrow(run, "file string, pos long, orbit long, units long, error boolean, truncated boolean")


def read_run_headers(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(file, orbits, run, lumi, bytes, length, violation) from the headers of run files alone."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = []
            for name, length in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(name) as f:
                    try:
                        h = frd_header(Range(f))
                        rows.append((name, h.orbits, h.run, h.lumi, h.size, length, None))
                    except FramingError as x:
                        rows.append((name, None, None, None, None, length, str(x)))
            types = (pa.string(), *[pa.int64()] * 5, pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["file", "orbits", "run", "lumi", "bytes", "length", "violation"])

    return listed(spark, path, pattern).mapInArrow(run, "file string, orbits long, run long, lumi long, bytes long, length long, violation string")


def check_files(spark: SparkSession, path: str, kind: str, kept_bytes: int = 256) -> DataFrame:
    """(file, events, words, orbits, truncated, warnings, violation, bad): what each file holds, and where its framing breaks.

    violation and bad, the bytes from that place on, are null in a sound file. A file is read in order, in one task.
    """
    decode = DECODERS[kind]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for name in batch.column(0).to_pylist():
                events, words, orbits, last, why, bad, seen = 0, 0, 0, None, None, None, Seen()
                with opened(name) as f:
                    source = Range(f)
                    try:
                        for e in decode(source, seen):
                            events, words = events + 1, words + len(e[4])
                            orbits, last = orbits + (e[1] != last), e[1]
                    except FramingError as x:
                        why, bad = str(x), source.peek(x.at, kept_bytes)
                row = (name, events, words, orbits + seen.truncated, seen.truncated, len(seen.warnings), why, bad)
                types = (pa.string(), *[pa.int64()] * 5, pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=["file", "events", "words", "orbits", "truncated", "warnings", "violation", "bad"])

    return listed(spark, path).mapInArrow(run, "file string, events long, words long, orbits long, truncated long, warnings long, violation string, bad binary")


def read_arrow(spark: SparkSession, path: str, schema: str, columns: list[str] | None = None) -> DataFrame:
    """Record batches of Arrow IPC files or streams; unsigned 64-bit values keep their bit pattern.

    schema: the wanted columns as DDL; others are not read from files. A
    file's record batches are spread over tasks; a stream is read in order.
    """
    wanted = StructType.fromDDL(schema)
    names = columns or wanted.names

    def parts(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path in batch.column(0).to_pylist():
                with opened(path) as f:
                    # a file starts with its magic, a stream with a message
                    n = pa.ipc.open_file(f).num_record_batches if f.read(6) == b"ARROW1" else None
                at = [-1] if n is None else list(range(n))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(at), pa.string()), pa.array(at, pa.int64())], names=["path", "part"])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for path, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(path) as f:
                    if i < 0:
                        got = iter(pa.ipc.open_stream(f))
                    else:
                        whole = pa.ipc.open_file(f).schema
                        got = iter([pa.ipc.open_file(f, options=pa.ipc.IpcReadOptions(included_fields=sorted(whole.get_field_index(n) for n in names))).get_batch(i)])
                    for part in got:
                        yield pa.RecordBatch.from_arrays([signed(part.column(part.schema.get_field_index(n))) for n in names], names=names)

    found = listed(spark, path).mapInArrow(parts, "path string, part long").repartition(spark.sparkContext.defaultParallelism)
    return found.mapInArrow(run, StructType([wanted[n] for n in names]))


def from_arrow(spark: SparkSession, table: pa.Table) -> DataFrame:
    """An Arrow table in memory as a DataFrame, with the types that Spark has."""
    return spark.createDataFrame(pa.Table.from_arrays([signed(c.combine_chunks() if c.num_chunks != 1 else c.chunk(0)) for c in table.columns], names=table.column_names))


_SIGNED = {pa.uint8(): pa.int16(), pa.uint16(): pa.int32(), pa.uint32(): pa.int64(), pa.float16(): pa.float32()}


def signed(x: pa.Array) -> pa.Array:
    """Types that Spark has: the next wider signed integer, the bit pattern of 64 bits, 32-bit floats."""
    if x.type == pa.uint64():
        return x.view(pa.int64())
    if x.type in _SIGNED:
        return x.cast(_SIGNED[x.type])
    if pa.types.is_list(x.type) or pa.types.is_large_list(x.type):
        return pa.ListArray.from_arrays(x.offsets.cast(pa.int32()), signed(x.values))
    if pa.types.is_fixed_size_list(x.type):
        return pa.FixedSizeListArray.from_arrays(signed(x.values), x.type.list_size).cast(pa.list_(signed(x.values).type))
    if pa.types.is_struct(x.type):
        return pa.StructArray.from_arrays([signed(x.field(i)) for i in range(x.type.num_fields)], names=[x.type.field(i).name for i in range(x.type.num_fields)])
    return x
