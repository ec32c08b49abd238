"""Bytes of the framed formats to events and back.

An event is (run, orbit, bx, good, words) with words as signed 64-bit patterns.
Every decoder checks its framing and raises FramingError with the place. Files
are read in order and in pieces: a decoder holds one orbit, or one chunk of a
native file.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np

from .files import Range

Event = tuple[int, int, int, bool, np.ndarray]

# Fixed values of the formats.
DTH_MAGIC = b"\x47\x5a"
DTH_START, DTH_END, DTH_ERROR = 0x80, 0x40, 0x20
DTH_MOST_UNITS = 0xFF
SR_HEADER_TAG, SR_TRAILER_TAG = 0x55, 0xAA
FRD_MAGIC, FRD_HEADER_SIZE, FRD_TYPE, FRD_ORBIT_VERSION = b"RAW_0002", 32, 20, 6
_FRD_FILE, _FRD_ORBIT = struct.Struct("<8sHHIIIQ"), struct.Struct("<6I")

#: Bytes of a native file that are looked at at once.
CHUNK = 4 << 20


class FramingError(ValueError):
    """What is wrong, and from which byte on."""

    def __init__(self, why: str, at: int):
        super().__init__(f"{why} at byte {at}")
        self.at = at


@dataclass
class Seen:
    """What a reading has passed: the last record and orbit, and what isn't an error."""

    record: int | None = None
    orbit: int | None = None
    truncated: int = 0
    warnings: list[str] = field(default_factory=list)


def header_of(e: Event) -> int:
    run, orbit, bx, good, words = e
    return (2 << 62) | (0 if good else 1 << 61) | (run & 31) << 56 | (orbit & 0xFFFFFFFF) << 24 | (bx & 4095) << 12 | (len(words) & 4095)


def _event_bytes(e: Event, pad: bool) -> bytes:
    body = struct.pack("<Q", header_of(e)) + np.asarray(e[4], np.int64).tobytes()
    # a padded empty event in error marks itself by a pad word that is not zero
    return body + struct.pack("<Q", 0 if e[3] or len(e[4]) else 1) if pad and len(body) % 16 else body


def encode_native(events: Iterable[Event], pad: bool = False) -> bytes:
    return b"".join(_event_bytes(e, pad) for e in events)


def _range(data: bytes | Range) -> Range:
    return data if isinstance(data, Range) else Range(io.BytesIO(data))


def decode_native(data: bytes | Range, pad: bool = False, skip_zeros: bool = False, tail: int = 0, orbit_bits: int = 32, headers: bool = False, places: bool = False) -> Iterator:
    """Events of a run of headers and words, in chunks.

    skip_zeros allows zero words between events, tail so many at the end; pad:
    128-bit events. headers gives the number of words in place of the words,
    places (byte, event).
    """
    source = _range(data)
    base, u = source.at, np.zeros(0, "<u8")
    at, more = 0, True
    while True:
        # the longest event has a header, 4095 words and a pad word
        if more and len(u) - at < 4097:
            base += 8 * at
            got = source.take(CHUNK)
            if len(got) % 8:
                raise FramingError("partial word", source.at - len(got) % 8)
            more = len(got) == CHUNK
            u = np.concatenate((u[at:], np.frombuffer(got, "<u8")))
            at = 0
        if at >= len(u):
            return
        h = int(u[at])
        if h == 0 and (skip_zeros or not more and len(u) - at <= tail):
            at += 1
            continue
        if h >> 62 != 2:
            raise FramingError(f"no event header: {h:016x}", base + 8 * at)
        n = h & 4095
        if at + 1 + n > len(u):
            raise FramingError("event is cut off", base + 8 * at)
        e = h >> 56 & 31, h >> 24 & ((1 << orbit_bits) - 1), h >> 12 & 4095, not h >> 61 & 1, n if headers else u[at + 1 : at + 1 + n].view(np.int64)
        yield (base + 8 * at, e) if places else e
        at += 1 + n
        at += pad and at % 2


def by_orbit(events: Iterable[Event]) -> Iterator[tuple[int, list[Event]]]:
    held: list[Event] = []
    for e in events:
        if held and held[0][1] != e[1]:
            yield held[0][1], held
            held = []
        held.append(e)
    if held:
        yield held[0][1], held


def _dth_header(units: int, flags: int, size: int, orbit: int | None) -> bytes:
    return DTH_MAGIC + b"\0\0\0" + bytes([flags, units, 0]) + b"\0" * 8 + (struct.pack("<QQ", orbit << 24, 0) if size == 32 else b"")


def _blocks(payload: bytes, unit: int, orbit: int | None, error: bool = False) -> bytes:
    payload += b"\0" * (-len(payload) % unit)
    step, out = DTH_MOST_UNITS * unit, []
    parts = [payload[i : i + step] for i in range(0, len(payload), step)] or [b""]
    for i, x in enumerate(parts):
        last = i == len(parts) - 1
        out += [_dth_header(len(x) // unit, (i == 0) * DTH_START | last * DTH_END | (last and error) * DTH_ERROR, unit, orbit), x]
    return b"".join(out)


def dth256_orbit(events: list[Event], number: int = 0) -> bytes:
    """An orbit in blocks of at most 255 rows of 256 bits, zero-padded."""
    return _blocks(encode_native(events), 32, events[0][1])


def dth256_truncated(orbit: int) -> bytes:
    """What stands for an orbit whose events were lost: one row, and the error bit."""
    return _blocks(b"\0" * 32, 32, orbit, error=True)


def dth_oa_orbit(events: list[Event], number: int = 0, slink: bool = True) -> bytes:
    """An orbit in blocks of at most 255 rows of 128 bits, with a record header and trailer around its padded events."""
    body = encode_native(events, pad=True)
    if slink:
        body = slink_record(body, number, events[-1][1], events[-1][2])
    return _blocks(body, 16, None)


def slink_record(body: bytes, number: int, orbit: int, bx: int) -> bytes:
    head = b"\0" * 8 + struct.pack("<Q", number)[:6] + b"\0" + bytes([SR_HEADER_TAG])
    units = len(body) // 16 + 2
    tail = struct.pack("<II", 0, orbit) + struct.pack("<H", bx & 0xFFF)[:1] + struct.pack("<I", units << 4 | bx >> 8 & 0xF) + b"\0\0" + bytes([SR_TRAILER_TAG])
    return head + body + tail


def dth_oa_truncated(number: int, orbit: int) -> bytes:
    """A record without events."""
    return _blocks(slink_record(b"", number, orbit, 0), 16, None)


#: Bytes of the events of one orbit, and of one event in `dth`; the number counts records.
ORBIT_ENCODERS: dict[str, Callable[[list[Event], int], bytes]] = {
    "native64": lambda es, number: encode_native(es),
    "native128": lambda es, number: encode_native(es, pad=True),
    "dth": lambda es, number: b"".join(dth_oa_orbit([e], number + i) for i, e in enumerate(es)),
    "dth_oa": dth_oa_orbit,
    "dth_oa_bare": lambda es, number: dth_oa_orbit(es, number, slink=False),
    "dth256": dth256_orbit,
}


def encoded(kind: str, events: Iterable[Event]) -> Iterator[bytes]:
    """The bytes of a file of events, an orbit at a time."""
    number = 0
    for _, es in by_orbit(events):
        yield ORBIT_ENCODERS[kind](es, number)
        number += len(es) if kind == "dth" else 1


@dataclass
class Record:
    """A run of blocks from a start to an end; units: rows of payload; payload: None where it was passed unread."""

    at: int
    orbit: int
    units: int
    error: bool
    first: bytes
    last: bytes
    payload: bytes | None


def dth_records(data: bytes | Range, unit: int, seen: Seen | None = None, payloads: bool = True) -> Iterator[Record]:
    """Records of a file, checked; without payloads only the headers, and 16 bytes at both ends, are read."""
    source, seen = _range(data), seen or Seen()
    parts: list[bytes] = []
    begin, orbit, total, first, last, open_ = 0, -1, 0, b"", b"", False
    while source.at < source.end:
        at = source.at
        head = source.take(unit)
        if len(head) < unit or head[:2] != DTH_MAGIC:
            raise FramingError("no block header", at)
        flags, units = head[5], head[6]
        if bool(flags & DTH_START) == open_:
            raise FramingError("start bit", at)
        if not flags & DTH_END and units != DTH_MOST_UNITS:
            raise FramingError("short block before the end", at)
        if flags & DTH_ERROR and not flags & DTH_END:
            seen.warnings.append(f"error bit without the end bit at byte {at}")
        size = units * unit
        if source.at + size > source.end:
            raise FramingError("block is cut off", at)
        word = struct.unpack("<Q", head[16:24])[0] >> 24 & 0xFFFFFFFF if unit == 32 else -1
        if open_ and word != orbit:
            raise FramingError("block of another orbit", at)
        if not open_:
            begin, orbit, total, first, last, parts = at, word, 0, b"", b"", []
        if payloads:
            parts.append(source.take(size))
        elif size:
            if not first:
                first = source.take(16)
                source.skip(size - 16)
            else:
                source.skip(size)
            last = source.peek(source.at - 16, 16)
        total, open_ = total + units, not flags & DTH_END
        if not open_:
            payload = b"".join(parts) if payloads else None
            if payload:
                first, last = payload[:16], payload[-16:]
            yield Record(begin, orbit, total, bool(flags & DTH_ERROR), first, last, payload)
    if open_:
        raise FramingError("no end of the record", begin)


def _expected(orbit: int, error: bool, seen: Seen, mux: int) -> int:
    """The orbit of a truncated record; one that isn't the next number is put right."""
    if error and seen.orbit is not None and orbit != seen.orbit + mux:
        seen.warnings.append(f"truncated orbit {orbit} after {seen.orbit}")
        return seen.orbit + mux
    return orbit


def decode_dth256(data: bytes | Range, seen: Seen | None = None, zero_pad: bool = False, mux: int = 1, places: bool = False) -> Iterator:
    """zero_pad allows zero words between events, not just up to three at a record's end. A record in error has no events."""
    seen = seen or Seen()
    for r in dth_records(data, 32, seen):
        orbit = _expected(r.orbit, r.error, seen, mux)
        seen.orbit = orbit
        if r.error:
            seen.truncated += 1
            continue
        for i, e in enumerate(decode_native(r.payload, skip_zeros=zero_pad, tail=3)):
            if e[1] != orbit:
                raise FramingError(f"orbit {e[1]} in a record of orbit {orbit}", r.at)
            yield (r.at + i, e) if places else e


@dataclass
class Slink:
    record: int
    orbit: int
    bx: int
    units: int


def slink_of(r: Record, seen: Seen) -> Slink:
    """The record header's number, which follows the last one's, and the trailer."""
    head, tail = r.first, r.last
    if r.units < 2 or head[15] != SR_HEADER_TAG or tail[15] != SR_TRAILER_TAG:
        raise FramingError("record tags", r.at)
    out = Slink(int.from_bytes(head[8:14], "little"), struct.unpack("<I", tail[4:8])[0], struct.unpack("<H", tail[8:10])[0] & 0xFFF, struct.unpack("<I", tail[9:13])[0] >> 4 & 0xFFFFF)
    if seen.record is not None and out.record != seen.record + 1:
        raise FramingError(f"record number {out.record} after {seen.record}", r.at)
    seen.record = out.record
    if out.units != r.units:
        raise FramingError("record length", r.at)
    return out


def decode_dth_oa(data: bytes | Range, seen: Seen | None = None, slink: bool = True, single: bool = False, places: bool = False) -> Iterator:
    """single: a record holds exactly one event, which fills it."""
    seen = seen or Seen()
    for r in dth_records(data, 16, seen):
        trailer = slink_of(r, seen) if slink else None
        body = r.payload[16:-16] if slink else r.payload
        events = list(decode_native(body, pad=True))
        # nothing but its frame, or an empty event in error, stands for an orbit whose events were lost
        if not single and (not events or not slink and r.units == 1 and not events[0][3]):
            seen.truncated += 1
        if trailer and events and (trailer.orbit, trailer.bx) != (events[-1][1], events[-1][2]):
            raise FramingError("trailer of another event", r.at)
        if single:
            if len(events) != 1:
                raise FramingError(f"{len(events)} events in a record of one", r.at)
            if len(body) != 8 * (len(events[0][4]) + 1 + (len(events[0][4]) + 1) % 2):
                raise FramingError("event size", r.at)
        if events or trailer:
            seen.orbit = events[-1][1] if events else trailer.orbit
        yield from enumerate(events, r.at) if places else events


def encode_frd(events: Iterable[Event], run: int = 37, lumi: int = 1) -> bytes:
    """A file header, then each orbit's header and events."""
    orbits = [(o, encode_native(es)) for o, es in by_orbit(events)]
    size = FRD_HEADER_SIZE + sum(_FRD_ORBIT.size + len(b) for _, b in orbits)
    return frd_file_header(len(orbits), run, lumi, size) + b"".join(frd_orbit_header(run, lumi, o, len(b)) + b for o, b in orbits)


def frd_file_header(orbits: int, run: int, lumi: int, size: int) -> bytes:
    return _FRD_FILE.pack(FRD_MAGIC, FRD_HEADER_SIZE, FRD_TYPE, orbits, run, lumi, size)


def frd_orbit_header(run: int, lumi: int, orbit: int, size: int) -> bytes:
    return _FRD_ORBIT.pack(FRD_ORBIT_VERSION, run, lumi, orbit, size, 0)


@dataclass
class FrdHeader:
    orbits: int
    run: int
    lumi: int
    size: int


def frd_header(data: bytes | Range) -> FrdHeader:
    """A file's header, checked but for its size."""
    head = _range(data).peek(0, FRD_HEADER_SIZE)
    if len(head) < FRD_HEADER_SIZE:
        raise FramingError("no file header", 0)
    magic, header, kind, n, run, lumi, size = _FRD_FILE.unpack(head)
    if (magic, header, kind) != (FRD_MAGIC, FRD_HEADER_SIZE, FRD_TYPE):
        raise FramingError("file header", 0)
    if not run or not lumi:
        raise FramingError("no run or lumisection", 0)
    return FrdHeader(n, run, lumi, size)


def frd_orbits(data: bytes | Range, payloads: bool = True) -> Iterator[Record]:
    """Orbits of a range of a file, checked against the file's header; without payloads only headers are read."""
    source = _range(data)
    file, whole = frd_header(source), source.whole
    if whole and file.size != source.end:
        raise FramingError(f"file of {source.end} bytes, header says {file.size}", 24)
    if source.begin == 0:
        source.skip(FRD_HEADER_SIZE)
    orbits = 0
    while source.at < source.end:
        at = source.at
        head = source.take(_FRD_ORBIT.size)
        if len(head) < _FRD_ORBIT.size:
            raise FramingError("partial orbit header", at)
        version, r, ls, orbit, length, _ = _FRD_ORBIT.unpack(head)
        if (version, r, ls) != (FRD_ORBIT_VERSION, file.run, file.lumi) or length % 8:
            raise FramingError("orbit header", at)
        if source.at + length > source.end:
            raise FramingError("orbit is cut off", at)
        payload = source.take(length) if payloads else None
        if not payloads:
            source.skip(length)
        yield Record(at, orbit, length // 8, False, b"", b"", payload)
        orbits += 1
    if whole and orbits != file.orbits:
        raise FramingError(f"{orbits} orbits, header says {file.orbits}", 12)


def decode_frd(data: bytes | Range, seen: Seen | None = None, places: bool = False) -> Iterator:
    seen = seen or Seen()
    for r in frd_orbits(data):
        for i, e in enumerate(decode_native(r.payload, tail=3)):
            if e[1] != r.orbit:
                raise FramingError(f"event of orbit {e[1]} in orbit {r.orbit}", r.at)
            yield (r.at + i, e) if places else e
        seen.orbit = r.orbit


ENCODERS = {k: lambda es, k=k: b"".join(encoded(k, es)) for k in ORBIT_ENCODERS} | {"frd": encode_frd}


def _native(**options):
    return lambda data, seen=None, places=False, headers=False: decode_native(data, places=places, headers=headers, **options)


#: Events of a file or a range of one; seen carries what stood before it; places gives (a number that grows along the file, event).
DECODERS: dict[str, Callable[..., Iterator]] = {
    "native64": _native(),
    "native64sz": _native(skip_zeros=True),
    "native128": _native(pad=True),
    "dth": lambda data, seen=None, places=False: decode_dth_oa(data, seen, single=True, places=places),
    "dth_oa": decode_dth_oa,
    "dth_oa_bare": lambda data, seen=None, places=False: decode_dth_oa(data, seen, slink=False, places=places),
    "dth256": decode_dth256,
    "dth256_padded": lambda data, seen=None, places=False: decode_dth256(data, seen, zero_pad=True, places=places),
    "frd": decode_frd,
}
UNITS = {"dth": 16, "dth_oa": 16, "dth_oa_bare": 16, "dth256": 32, "dth256_padded": 32}


def frames(kind: str, data: bytes | Range, seen: Seen | None = None, mux: int = 1) -> Iterator[tuple[Record, int, bool]]:
    """(record, orbit, whether truncated) of block formats and run files, from headers and the ends of records alone."""
    seen = seen or Seen()
    if kind == "frd":
        for r in frd_orbits(data, payloads=False):
            yield r, r.orbit, r.units == 0
        return
    for r in dth_records(data, UNITS[kind], seen, payloads=False):
        if UNITS[kind] == 32:
            orbit, truncated = _expected(r.orbit, r.error, seen, mux), r.error or r.units == 1
        elif kind == "dth_oa_bare":
            orbit = struct.unpack("<Q", r.first[:8])[0] >> 24 & 0xFFFFFFFF if r.first else -1
            truncated = r.units <= 1
        else:
            orbit, truncated = slink_of(r, seen).orbit, r.units <= 2
        seen.orbit = orbit
        seen.truncated += truncated
        yield r, orbit, truncated


def cuts(kind: str, data: bytes | Range, step: int) -> Iterator[tuple[int, int, int | None, int | None]]:
    """(begin, end, record and orbit before) of ranges of about `step` bytes that can be decoded on their own.

    Only headers are read, but in native files, which are read through.
    """
    source, seen = _range(data), Seen()
    begin, before = 0, (None, None)
    if kind.startswith("native"):
        starts = ((at, None, None) for at, _ in DECODERS[kind](source, places=True, headers=True))
    elif kind == "frd":
        starts = ((r.at, None, None) for r, _, _ in frames(kind, source, seen))
    else:
        starts = _with_before(kind, source, seen)
    for at, record, orbit in starts:
        if at - begin >= step:
            yield begin, at, *before
            begin, before = at, (record, orbit)
    yield begin, source.end, *before


def _with_before(kind: str, source: Range, seen: Seen) -> Iterator[tuple[int, int | None, int | None]]:
    record = orbit = None
    for r, _, _ in frames(kind, source, seen):
        yield r.at, record, orbit
        record, orbit = seen.record, seen.orbit
