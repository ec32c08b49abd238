"""Writers of framed event files, rolling run files, snapshots and Arrow IPC, as Python data sources.

df.write.format("framed").option("kind", "dth256").mode("append").save(path)
writes a file a task under a temporary name and renames it when all tasks are
done; a failed job leaves no file under a final name. Files go through Arrow's
file systems. A writer holds one orbit, or one Arrow batch, at a time.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..functions.headers import LUMI_BITS
from ..operators.streams import file_keys, file_name
from ..sources.files import filesystem
from ..sources.framing import Event, encode_frd, encode_native, encoded, frd_file_header, frd_orbit_header, header_of


@dataclass
class Written(WriterCommitMessage):
    """(temporary, final) names of a task's files."""

    names: list[tuple[str, str]]


class _Writer(DataSourceArrowWriter):
    suffix = "raw"

    def __init__(self, options: dict, overwrite: bool):
        self.options = options
        store, path = filesystem(options["path"])
        store.create_dir(path, recursive=True)
        if overwrite:
            for x in store.get_file_info(fs.FileSelector(path)):
                if x.base_name.startswith("part-"):
                    store.delete_file(x.path)

    def at(self, name: str) -> tuple[fs.FileSystem, str]:
        store, path = filesystem(self.options["path"])
        return store, f"{path}/{name}"

    def files(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, Iterator[bytes]]]:
        """(name or None, pieces) of the files of a task's rows; each file's pieces are taken before the next file."""
        raise NotImplementedError

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        names = []
        for name, pieces in self.files(b for b in iterator if b.num_rows):
            name = name or f"part-{uuid.uuid4().hex}.{self.suffix}"
            folder, _, base = name.rpartition("/")
            waiting = f"{folder}/.tmp-{uuid.uuid4().hex}-{base}" if folder else f".tmp-{uuid.uuid4().hex}-{base}"
            store, path = self.at(waiting)
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(path) as f:
                for x in pieces:
                    f.write(x)
            names.append((waiting, name))
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        for waiting, name in (x for m in messages if m for x in m.names):
            store, path = self.at(name)
            store.move(self.at(waiting)[1], path)

    def abort(self, messages: list[Written | None]) -> None:
        for waiting, _ in (x for m in messages if m for x in m.names):
            store, path = self.at(waiting)
            if store.get_file_info(path).type != fs.FileType.NotFound:
                store.delete_file(path)


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[pa.RecordBatch]]:
    """The batches, if there are any."""
    first = next(batches, None)
    if first is not None:
        yield (b for part in ([first], batches) for b in part)


def _events(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple]:
    """(event, values of further columns) of rows with run, orbit, bx, good and words."""
    for b in batches:
        columns = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("run", "orbit", "bx", "good", *more)]
        words = b.column(b.schema.get_field_index("words"))
        for (r, o, x, g, *rest), w in zip(zip(*columns), words):
            yield (r, o, x, g, np.asarray(w.values)), rest


class FramedWriter(_Writer):
    """Columns run, orbit, bx, good, words, in the order of a task's rows; option kind. A run file is held whole.

    With option streams, rows of each value of the column stream that stand together make a file.
    """

    def files(self, batches):
        for some in _some(batches):
            rows = _Lookahead(_events(some, "stream")) if self.options.get("streams") == "true" else _Lookahead((e, [0]) for e, _ in _events(some))
            while rows.next is not None:
                events = self._of_stream(rows)
                yield None, iter([encode_frd(events)]) if self.options["kind"] == "frd" else encoded(self.options["kind"], events)

    @staticmethod
    def _of_stream(rows: _Lookahead) -> Iterator[Event]:
        stream = rows.next[1][0]
        while rows.next is not None and rows.next[1][0] == stream:
            yield rows.take()[0]


class RollingWriter(_Writer):
    """Rows of rolled(), sorted by name and orbit: one file a name, orbits zero-padded to 256 bits; option headers."""

    def files(self, batches):
        rows = _Lookahead(_events(batches, "name", "ls", "file_run", "kept", "file_orbits", "file_bytes"))
        while rows.next is not None:
            yield rows.next[1][0], self._file(rows)

    def _file(self, rows: _Lookahead) -> Iterator[bytes]:
        name, ls, run, _, orbits, size = rows.next[1]
        headers = self.options.get("headers") == "true"
        if headers:
            yield frd_file_header(orbits, run, ls, size)
        while rows.next is not None and rows.next[1][0] == name:
            orbit, kept, held = rows.next[0][1], rows.next[1][3], []
            while rows.next is not None and rows.next[1][0] == name and rows.next[0][1] == orbit:
                held.append(rows.take()[0])
            if kept:
                body = encode_native(held)
                body += b"\0" * (-len(body) % 32)
                yield (frd_orbit_header(run, ls, orbit, len(body)) if headers else b"") + body


class _Lookahead:
    def __init__(self, items: Iterator):
        self.items = items
        self.next = next(items, None)

    def take(self):
        out, self.next = self.next, next(self.items, None)
        return out


class SnapshotWriter(_Writer):
    """Columns run, orbit, bx, good, words, i1, i2, i3, mass: each selected event, its triplet's places and its mass as a 32-bit float."""

    suffix = "dump"

    def files(self, batches):
        for some in _some(batches):
            yield None, (snapshot_bytes(e, tuple(rest[:3]), rest[3]) for e, rest in _events(some, "i1", "i2", "i3", "mass"))


def snapshot_bytes(e: Event, places: tuple[int, int, int], mass: float) -> bytes:
    return struct.pack("<Q", header_of(e)) + np.asarray(e[4], np.int64).tobytes() + struct.pack("<3If", *places, mass)


def read_snapshot(data: bytes) -> Iterator[tuple[Event, tuple[int, int, int], float]]:
    at = 0
    while at < len(data):
        h = struct.unpack_from("<Q", data, at)[0]
        n = h & 4095
        words = np.frombuffer(data, "<i8", n, at + 8)
        at += 8 + 8 * n
        *places, mass = struct.unpack_from("<3If", data, at)
        at += 16
        yield (h >> 56 & 31, h >> 24 & 0xFFFFFFFF, h >> 12 & 4095, not h >> 61 & 1, words), tuple(places), mass


class ArrowWriter(_Writer):
    """option mode: file or stream; compression: none, lz4 or zstd; half: true for 16-bit floats; types: field=type, comma-joined."""

    suffix = "arrow"

    def files(self, batches):
        for some in _some(batches):
            yield None, self._pieces(some)

    def _pieces(self, batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        codec = self.options.get("compression", "none")
        make = pa.ipc.new_stream if self.options.get("mode") == "stream" else pa.ipc.new_file
        sink = _Pieces()
        writer = None
        for b in batches:
            b = pa.RecordBatch.from_arrays([self._as(c, n) for n, c in zip(b.schema.names, b.columns)], names=b.schema.names)
            if writer is None:
                writer = make(pa.PythonFile(sink, "w"), b.schema, options=pa.ipc.IpcWriteOptions(compression=None if codec == "none" else codec))
            writer.write_batch(b)
            yield sink.taken()
        writer.close()
        yield sink.taken()

    def _as(self, x: pa.Array, name: str) -> pa.Array:
        types = dict(t.split("=") for t in self.options.get("types", "").split(",") if t)
        if pa.types.is_list(x.type):
            return pa.ListArray.from_arrays(x.offsets, self._as(x.values, name))
        if pa.types.is_struct(x.type):
            names = [x.type.field(i).name for i in range(x.type.num_fields)]
            return pa.StructArray.from_arrays([self._as(x.field(i), n) for i, n in enumerate(names)], names=names)
        if name in types:
            return x.cast(pa.type_for_alias(types[name]))
        if self.options.get("half") == "true" and x.type == pa.float32():
            return pa.array(x.to_numpy(zero_copy_only=False).astype(np.float16))
        return x


class _Pieces:
    """A file that hands on what has been written to it."""

    closed = False

    def __init__(self):
        self.held: list[bytes] = []
        self.place = 0

    def write(self, data) -> int:
        self.held.append(bytes(data))
        self.place += len(data)
        return len(data)

    def tell(self) -> int:
        return self.place

    def flush(self) -> None:
        pass

    def close(self) -> None:
        pass

    def taken(self) -> bytes:
        out, self.held = b"".join(self.held), []
        return out


def _sink(format_name: str, writer_class: type[_Writer]) -> type[DataSource]:
    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
            return writer_class(dict(self.options), overwrite)

    return Sink


SINKS = [_sink(n, w) for n, w in (("framed", FramedWriter), ("rolling", RollingWriter), ("rawsnapshot", SnapshotWriter), ("arrowipc", ArrowWriter))]


def register(spark: SparkSession) -> None:
    for x in SINKS:
        spark.dataSource.register(x)


def rolled(events: DataFrame, timeslice: Column, run: int | None = None, lumi_bits: int = LUMI_BITS, file_bits: int = 12, mux: int = 1, prescale: int = 1, headers: bool = True) -> DataFrame:
    """events (run, orbit, bx, good, words) with the name of their rolling file, whether their orbit is kept, and the file's orbits and bytes.

    An orbit is kept if it is `mux` modulo prescale; a prescale of 1 keeps all, of 0 none.
    Sizes are summed by orbit and file first, so headers are known before files are written.
    """
    keyed = file_keys(events.withColumn("run", F.lit(run).cast("int")) if run is not None else events, lumi_bits, file_bits, mux)
    numbers = F.col("run"), F.col("ls"), F.col("file_index"), timeslice
    kept = F.lit(prescale == 1) if prescale < 2 else F.col("orbit") % prescale == mux % prescale
    keyed = keyed.withColumns({"name": F.concat(F.format_string("run%06d/", F.col("run")), file_name(*numbers)), "kept": kept, "file_run": F.col("run").cast("int")})
    orbits = keyed.groupBy("name", "orbit").agg(F.first("kept").alias("kept"), (F.ceil(F.sum(F.size("words") * 8 + 8) / 32) * 32).alias("bytes"))
    overhead = 24 if headers else 0
    files = orbits.groupBy("name").agg(
        F.sum(F.col("kept").cast("int")).cast("int").alias("file_orbits"),
        (F.coalesce(F.sum(F.when(F.col("kept"), F.col("bytes") + overhead)), F.lit(0)) + (32 if headers else 0)).cast("long").alias("file_bytes"),
    )
    return keyed.join(files, "name")


def write_rolling(rows: DataFrame, path: str, headers: bool = True, order: tuple[str, ...] = ("bx",)) -> None:
    """Writes rows of rolled() below path as run…/run…_ls…_index…_ts….raw; a file is one task's."""
    register(rows.sparkSession)
    ready = rows.repartition("name").sortWithinPartitions("name", "orbit", *order)
    ready = ready.select("name", F.col("ls").cast("long").alias("ls"), "file_run", "kept", "file_orbits", "file_bytes", F.col("run").cast("int").alias("run"), "orbit", F.col("bx").cast("int").alias("bx"), "good", "words")
    ready.write.format("rolling").option("headers", str(headers).lower()).mode("append").save(path)


def captured(events: DataFrame, every: int, most_bytes: int = 4_000_000_000) -> DataFrame:
    """Events of the orbits with a number divisible by `every`, in order of orbits, while they take at most most_bytes.

    Orbits count from 1. Sizes are summed by orbit first; then orbits, not events, are numbered and added up.
    """
    from ..operators.streams import numbered

    orbits = events.groupBy("orbit").agg(F.sum(F.size("words") * 8 + 8).alias("bytes"))
    orbits = numbered(orbits, "orbit", {"bytes": "total_before"}, number="number", where=lambda n: (n + 1) % every == 0)
    kept = orbits.where((F.col("number") + 1) % every == 0).where(F.col("total_before") + F.col("bytes") <= most_bytes)
    return events.join(kept.select("orbit"), "orbit", "left_semi")


def capture(events: DataFrame, path: str, kind: str, every: int, most_bytes: int = 4_000_000_000) -> None:
    """Writes captured() events as one file of a kind: what a per-orbit capture becomes without its frames."""
    register(events.sparkSession)
    rows = captured(events, every, most_bytes).coalesce(1).sortWithinPartitions("orbit", "bx")
    rows.select("run", "orbit", "bx", "good", "words").write.format("framed").option("kind", kind).mode("append").save(path)


#: Suffixes of output files by kind.
SUFFIXES = {"parquet": ".parquet", "arrowipc": ".arrow", "framed": ".raw", "csv": ".csv"}


def with_suffix(path: str, kind: str) -> str:
    """path with the suffix of its kind, once."""
    return path if path.endswith(SUFFIXES[kind]) else path + SUFFIXES[kind]
