"""Framed formats: round trips of any events, and one fault for each framing check."""

import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bunchflow.sources import framing as F

words = st.lists(st.integers(-(2**63), 2**63 - 1), max_size=5)


@st.composite
def events(draw):
    out, orbit = [], draw(st.integers(1, 1000))
    for _ in range(draw(st.integers(0, 6))):
        orbit += draw(st.integers(0, 2))
        out.append((draw(st.integers(0, 31)), orbit, draw(st.integers(0, 3563)), draw(st.booleans()), np.array(draw(words), np.int64)))
    return out


def same(a, b):
    a, b = list(a), list(b)
    return len(a) == len(b) and all(x[:4] == y[:4] and list(x[4]) == list(y[4]) for x, y in zip(a, b))


@pytest.mark.parametrize("kind", sorted(F.ENCODERS))
@settings(max_examples=60, deadline=None)
@given(es=events())
def test_round_trip(kind, es):
    assert same(F.DECODERS[kind](F.ENCODERS[kind](es)), es)


EVENTS = [(3, 7, 6 * i, True, np.arange(300 + i)) for i in range(4)] + [(3, 8, 0, False, np.zeros(0, np.int64))]


def test_zero_words_between_events_need_the_option():
    data = F.encode_native(EVENTS[:1]) + b"\0" * 16 + F.encode_native(EVENTS[1:])
    with pytest.raises(F.FramingError):
        list(F.decode_native(data))
    assert same(F.decode_native(data, skip_zeros=True), EVENTS)


def test_orbits_span_blocks():
    data = F.ENCODERS["dth256"](EVENTS)
    assert data.count(F.DTH_MAGIC) >= 3  # 1200 words and headers need two blocks, the next orbit one


def broken(kind, change):
    data = bytearray(F.ENCODERS[kind](EVENTS))
    change(data)
    with pytest.raises(F.FramingError):
        list(F.DECODERS[kind](bytes(data)))


def put(at, value):
    def change(data):
        data[at] = value

    return change


@pytest.mark.parametrize(
    "kind, change",
    [
        ("native64", put(7, 0)),  # tag
        ("native64", lambda d: d.append(0)),  # partial word
        ("native64", lambda d: d.__delitem__(slice(-24, None))),  # cut off
        ("dth256", put(0, 0)),  # magic
        ("dth256", put(5, 0)),  # start bit
        ("dth256", put(6, 200)),  # short block before the end
        ("dth256", put(20, 9)),  # orbit of the record
        ("dth_oa", put(16 + 15, 0)),  # record header tag
        ("dth_oa", put(16 + 8, 5)),  # record number
        ("dth_oa", lambda d: d.__setitem__(len(d) - 1, 0)),  # record trailer tag
        ("dth_oa", lambda d: d.__setitem__(len(d) - 6, 0x33)),  # record length
        ("frd", put(0, 0)),  # magic
        ("frd", put(8, 31)),  # header size
        ("frd", put(10, 21)),  # type
        ("frd", put(12, 9)),  # number of orbits
        ("frd", put(24, 1)),  # file size
        ("frd", put(32, 5)),  # orbit header version
        ("frd", put(36, 5)),  # run
        ("frd", lambda d: d.__setitem__(slice(16, 20), struct.pack("<I", 0))),  # run 0
    ],
)
def test_fault(kind, change):
    broken(kind, change)


def test_files(spark, tmp_path):
    from bunchflow.sources.framed import check_files, read_events

    for i, cut in enumerate((0, 8)):
        data = F.encode_native(EVENTS[:4])
        (tmp_path / f"part-{i}.raw").write_bytes(data[: len(data) - cut])
    found = {r.file[-10:]: (r.events, r.violation) for r in check_files(spark, str(tmp_path), "native64").collect()}
    assert found["part-0.raw"] == (4, None)
    assert found["part-1.raw"][0] == 3 and "cut off" in found["part-1.raw"][1]
    rows = read_events(spark, f"{tmp_path}/part-0.raw", "native64").orderBy("pos").collect()
    assert [len(r.words) for r in rows] == [300, 301, 302, 303]


def test_arrow_types(spark, tmp_path):
    import pyarrow as pa

    from bunchflow.sources.framed import read_arrow

    batch = pa.record_batch(
        {
            "u8": pa.array([255], pa.uint8()),
            "u64": pa.array([2**64 - 1], pa.uint64()),
            "half": pa.array([np.float16(0.5)], pa.float16()),
            "fixed": pa.array([[1, 2]], pa.list_(pa.uint16(), 2)),
            "nested": pa.array([[[1.5], []]], pa.list_(pa.list_(pa.float32()))),
            "s": pa.array([[{"a": 1, "b": [True]}]], pa.list_(pa.struct([("a", pa.uint32()), ("b", pa.list_(pa.bool_()))]))),
        }
    )
    schema = "u8 smallint, u64 bigint, half float, fixed array<int>, nested array<array<float>>, s array<struct<a: bigint, b: array<boolean>>>"
    for name, make in (("file", pa.ipc.new_file), ("stream", pa.ipc.new_stream)):
        with pa.OSFile(str(tmp_path / f"{name}.arrow"), "wb") as f, make(f, batch.schema) as w:
            w.write_batch(batch)
        r = read_arrow(spark, str(tmp_path / f"{name}.arrow"), schema).first()
        assert (r.u8, r.u64, r.half, r.fixed, r.nested) == (255, -1, 0.5, [1, 2], [[1.5], []])
        assert [(x.a, x.b) for x in r.s] == [(1, [True])]
        assert read_arrow(spark, str(tmp_path / f"{name}.arrow"), schema, ["u64"]).columns == ["u64"]


def test_histogram_file(spark, tmp_path):
    from bunchflow.operators.selection import histogram
    from bunchflow.sinks.text import read_histogram, write_histogram

    rows = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 4.9, 5.0, 10.0, None)], "x double")
    write_histogram(histogram(rows, "x", 2, 0.0, 10.0), str(tmp_path / "h"))
    assert read_histogram(str(tmp_path / "h")) == [1.0, 2.0, 1.0, 1.0]
