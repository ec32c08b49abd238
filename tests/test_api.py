"""The programs' functions, streams over TCP, live state and ordered operators in buckets."""

import socket
import threading
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bunchflow import api
from bunchflow.operators import streams as S
from bunchflow.plans.fixtures import events as candidate_events
from bunchflow.plans.fixtures import word_arrays
from bunchflow.sources import framed, framing
from bunchflow.sources.files import Range, filesystem
from bunchflow.streaming import live, receive

EVENTS = [(3, 1 + i // 4, 6 * (i % 4), True, np.arange(i % 5, dtype=np.int64)) for i in range(40)]


def rows_of(df):
    return sorted((r.run, r.orbit, r.bx, r.good, tuple(r.words)) for r in df.collect())


WANT = sorted((r, o, b, g, tuple(w.tolist())) for r, o, b, g, w in EVENTS)


@pytest.mark.parametrize("kind", sorted(framing.ENCODERS))
def test_ranges_of_files(spark, tmp_path, kind):
    """Any cut into ranges gives the same events, in the order of pos."""
    (tmp_path / "a b.raw").write_bytes(framing.ENCODERS[kind](EVENTS))
    for step in (150, 10**9):
        rows = framed.read_events(spark, str(tmp_path), kind, split_bytes=step)
        assert rows_of(rows) == WANT
        assert [(r.orbit, r.bx) for r in rows.orderBy("pos").collect()] == [e[1:3] for e in EVENTS]
    headers = framed.read_events(spark, str(tmp_path), kind, headers=True)
    assert "words" not in headers.columns and headers.agg(F.sum("n")).first()[0] == sum(len(e[4]) for e in EVENTS)


def test_no_payload_is_read_for_headers(tmp_path):
    events = [(3, o, 0, True, np.zeros(4000, np.int64)) for o in range(1, 20)]
    (tmp_path / "x").write_bytes(framing.ENCODERS["dth256"](events))

    class Counting:
        def __init__(self, f):
            self.f, self.read_bytes = f, 0
            self.seek, self.tell = f.seek, f.tell

        def read(self, n):
            self.read_bytes += n
            return self.f.read(n)

    with open(tmp_path / "x", "rb") as f:
        counted = Counting(f)
        assert [o for _, o, _ in framing.frames("dth256", Range(counted))] == list(range(1, 20))
    assert counted.read_bytes < (tmp_path / "x").stat().st_size / 50


def test_native_chunks(monkeypatch):
    monkeypatch.setattr(framing, "CHUNK", 4096 * 8)
    events = [(1, 2, i % 3564, True, np.arange(n, dtype=np.int64)) for i, n in enumerate([4095, 0, 1, 4095, 4094, 7] * 20)]
    for kind in ("native64", "native128"):
        got = list(framing.DECODERS[kind](framing.ENCODERS[kind](events)))
        assert len(got) == len(events) and all(list(a[4]) == list(b[4]) for a, b in zip(got, events))


def test_records_go_on_from_any_number():
    data = b"".join(framing.dth_oa_orbit([(1, 5 + i, 0, True, np.arange(3))], 70 + i) for i in range(3))
    assert [e[1] for e in framing.decode_dth_oa(data)] == [5, 6, 7]
    seen = framing.Seen()
    lost = framing.dth_oa_orbit([(1, 5, 0, True, np.arange(3))], 1) + framing.dth_oa_truncated(2, 6)
    assert [e[1] for e in framing.decode_dth_oa(lost, seen)] == [5] and seen.truncated == 1 and seen.orbit == 6


def test_error_bits():
    block = bytearray(framing.dth256_orbit([(1, 5, 0, True, np.arange(2000))]))
    block[5] |= framing.DTH_ERROR
    seen = framing.Seen()
    assert len(list(framing.decode_dth256(bytes(block), seen))) == 1 and len(seen.warnings) == 1  # an error bit before the end is a warning
    seen = framing.Seen()
    data = framing.dth256_orbit([(1, 5, 0, True, np.arange(3))]) + framing.dth256_truncated(9) + framing.dth256_orbit([(1, 7, 0, True, np.arange(3))])
    assert [e[1] for e in framing.decode_dth256(data, seen)] == [5, 7] and (seen.truncated, len(seen.warnings)) == (1, 1)


def test_buffers_and_tables(spark):
    halves = [framing.ENCODERS["dth_oa"](EVENTS[:20]), framing.ENCODERS["dth_oa"](EVENTS[20:])]
    assert rows_of(framed.from_buffers(spark, halves, "dth_oa")) == WANT
    table = pa.table({"u": pa.array([2**64 - 1, 1], pa.uint64()), "l": pa.array([[1], [2, 3]], pa.list_(pa.uint8()))})
    assert [tuple(r) for r in framed.from_arrow(spark, table).collect()] == [(-1, [1]), (1, [2, 3])]


def test_paths():
    assert filesystem("file:/tmp/a b")[1] == filesystem("file:///tmp/a b")[1] == filesystem("/tmp/a b")[1] == "/tmp/a b"
    assert receive.streams("run%d.raw", 2) == ["run0.raw", "run1.raw"]
    assert receive.streams("localhost:7000", 3) == ["localhost:7000", "localhost:7001", "localhost:7002"]
    with pytest.raises(ValueError):
        receive.streams("one.raw", 2)


def test_numbers_sums_and_predecessors_in_buckets(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(int(s), int(p), int(x)) for s in (0, 1) for p, x in zip(sorted(rng.choice(200, 60, replace=False)), rng.integers(0, 9, 60))] + [(None, 5, 1), (None, 90, 2)]
    df = spark.createDataFrame(rows, "stream int, pos int, x int")
    got = {}
    for bits in (30, 3):
        monkeypatch.setattr(S, "BUCKET_BITS", bits)
        numbered = S.numbered(df, "pos", {"x": "before"}, ["stream"])
        preceded = S.preceded(df, ["x"], ["stream"], ["pos"])
        got[bits] = sorted(map(repr, numbered.collect())), sorted(map(repr, preceded.collect()))
        for r in numbered.collect():
            earlier = [x for s, p, x in rows if s == r.stream and p < r.pos]
            assert (r.number, r.before) == (len(earlier), sum(earlier))
        for r in preceded.collect():
            earlier = [(p, x) for s, p, x in rows if s == r.stream and p < r.pos]
            assert (r["__before"].x if r["__before"] else None) == (max(earlier)[1] if earlier else None)
    assert got[30] == got[3]


def free_port():
    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        return s.getsockname()[1]


def test_tcp_streams_land_in_files(spark, tmp_path):
    addresses = [f"127.0.0.1:{free_port()}" for _ in range(2)]
    data = [framing.ENCODERS["native64"](EVENTS[:20]), framing.ENCODERS["native64"](EVENTS[20:])]

    def send(address, x):
        for _ in range(200):
            try:
                return receive.sent(address, iter([x[:50], x[50:]]))
            except ConnectionRefusedError:
                time.sleep(0.1)

    threads = [threading.Thread(target=send, args=p) for p in zip(addresses, data)]
    for t in threads:
        t.start()
    landed = receive.received(spark, addresses, str(tmp_path / "in"), timeout=60.0).collect()
    for t in threads:
        t.join()
    assert sum(r.bytes for r in landed) == sum(map(len, data)) and len(landed) == 2
    assert rows_of(framed.read_events(spark, str(tmp_path / "in"), "native64")) == WANT


def test_a_live_query_goes_on_after_a_restart(spark, tmp_path):
    def put(n):
        spark.createDataFrame([(n,)], "x long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = live.watched(spark, str(tmp_path / "in"), "x long")
        stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.x for r in spark.read.parquet(str(tmp_path / "out")).collect())

    put(1)
    assert run() == [1]
    put(2)
    assert run() == [1, 2] and run() == [1, 2]


def test_paced_orbits(spark):
    stream = live.paced(spark, 50, slots=3)
    assert stream.isStreaming and stream.columns == ["orbit", "bx"]


def test_programs(spark, sf_dir, tmp_path):
    templates = word_arrays(spark, sf_dir).orderBy("event").limit(30).select("words")
    raw = str(tmp_path / "raw")
    api.generate(spark, templates, raw, "dth256", orbits=5, tmux=6, streams=2)
    events = framed.read_events(spark, raw, "dth256")
    assert events.count() == 5 * 2 * 594
    assert {r.kind: r.rows for r in api.check(spark, raw, "dth256").collect() if r.kind != "bx"} == {"orbit": 0, "truncated": 0, "bx_range": 0, "framing": 0}
    assert api.check(spark, raw, "dth256", headers_only=True).first().orbits == 10
    api.roll(spark, raw, "dth256", str(tmp_path / "rolled"), run=37, file_bits=1)
    assert framed.read_events(spark, f"{tmp_path}/rolled/run*/*.raw", "frd").count() == 5 * 2 * 594
    api.receive(spark, raw, "dth256", str(tmp_path / "caught"), prescale=2)
    assert framed.read_events(spark, str(tmp_path / "caught"), "native64").select("orbit").distinct().count() == 2
    for obj in ("puppi", "tkmu"):
        for layout in ("float24", "coll_int", "raw64"):
            at = api.unpack(spark, raw, str(tmp_path / f"{obj}_{layout}"), obj, layout, "dth256")
            assert at.endswith(".parquet") and spark.read.parquet(at).count() == 5 * 2 * 594
    assert api.unpack(spark, raw, None, kind="dth256") is None
    assert api.unpack(spark, raw, str(tmp_path / "gone"), kind="dth256", delete=True) is None and not (tmp_path / "gone.parquet").exists()
    assert api.unpack(spark, raw, str(tmp_path / "a"), layout="coll_int", kind="dth256", sink="arrowipc", compression="none").endswith(".arrow")
    found = candidate_events(spark, sf_dir)
    flow = api.analyse(found, "loose", "rawhisto", str(tmp_path / "h")).first()
    api.analyse(found, "loose", "snapshot", str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == flow.n_pass
    rows, seen = live.observed(events)
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get["events"] == 5 * 2 * 594
