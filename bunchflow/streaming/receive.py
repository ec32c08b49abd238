"""Streams over TCP: each port is received by a task, which lands what comes as files that a file stream then reads.

A landed file is final and can be read again, so a live query that restarts
goes on from its checkpoint; what a broken connection had sent so far is landed too.
"""

from __future__ import annotations

import socket
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import filesystem


def streams(template: str, n: int, first: int = 0) -> list[str]:
    """The paths or addresses of n streams: %d becomes the stream's number, and a port grows by one a stream."""
    if "%d" in template:
        return [template.replace("%d", str(first + i)) for i in range(n)]
    host, colon, port = template.rpartition(":")
    if colon and port.isdigit():
        return [f"{host}:{int(port) + i}" for i in range(n)]
    if n > 1:
        raise ValueError(f"{n} streams need %d or a port in {template!r}")
    return [template]


def received(spark: SparkSession, addresses: Sequence[str], folder: str, file_bytes: int = 64 << 20, connections: int = 1, timeout: float | None = None, unit: int = 8) -> DataFrame:
    """(address, file, bytes) of the files that the streams' data land in, below folder; runs when it is read.

    A task listens on each address and takes `connections` connections one
    after another. Files hold file_bytes at most, in whole units of `unit` bytes.
    """

    def land(address: str, number: int, data: bytes) -> str:
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        name = f"{address.replace(':', '_')}-{number:06d}-{uuid.uuid4().hex}.raw"
        with store.open_output_stream(f"{path}/.{name}") as f:
            f.write(data)
        store.move(f"{path}/.{name}", f"{path}/{name}")
        return name

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for address in batch.column(0).to_pylist():
                host, _, port = address.rpartition(":")
                found: list[tuple[str, int]] = []
                with socket.create_server((host or "0.0.0.0", int(port))) as server:
                    server.settimeout(timeout)
                    for _ in range(connections):
                        client, _ = server.accept()
                        held = bytearray()
                        with client:
                            client.settimeout(timeout)
                            while data := _some(client):
                                held += data
                                while len(held) >= file_bytes:
                                    whole = max(unit, file_bytes // unit * unit)
                                    found.append((land(address, len(found), bytes(held[:whole])), whole))
                                    del held[:whole]
                        if held:
                            found.append((land(address, len(found), bytes(held)), len(held)))
                yield pa.RecordBatch.from_arrays([pa.array([address] * len(found), pa.string()), pa.array([f for f, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["address", "file", "bytes"])

    # a stream is a partition
    names = F.array(*map(F.lit, addresses))
    rows = spark.range(0, len(addresses), 1, len(addresses)).select(F.get(names, F.col("id").cast("int")).alias("address"))
    return rows.mapInArrow(run, "address string, file string, bytes long")


def _some(client: socket.socket) -> bytes:
    try:
        return client.recv(1 << 20)
    except (TimeoutError, ConnectionError):
        return b""


def sent(address: str, pieces: Iterator[bytes]) -> int:
    """Sends pieces to an address that listens; the number of bytes."""
    host, _, port = address.rpartition(":")
    total = 0
    with socket.create_connection((host, int(port))) as s:
        for x in pieces:
            s.sendall(x)
            total += len(x)
    return total
