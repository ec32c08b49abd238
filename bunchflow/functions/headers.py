"""Event and orbit header words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bits import join_fields, put, ubits

# Fixed values of the machine and the formats.
BX_PER_ORBIT = 3564
CLOCK_HZ = 40_000_000
EVENT_TAG = 2
ORBIT_TAG = 3
LUMI_BITS = 18


def event_header(run: Column, orbit: Column, bx: Column, n: Column, error: Column) -> Column:
    """10 | error | run 5 bits | orbit 32 | bx 12 | number of words 12."""
    return join_fields(F.lit(-(2**63)), put(error.cast("int"), 61, 1), put(run, 56, 5), put(orbit, 24, 32), put(bx, 12, 12), put(n, 0, 12))


def parse_event_header(word: Column, orbit_bits: int = 32) -> dict[str, Column]:
    """Columns run, orbit, bx, n, good, tagged; orbit_bits=30 reads the short orbit field of older unpackers."""
    return {
        "run": ubits(word, 56, 5),
        "orbit": ubits(word, 24, orbit_bits),
        "bx": ubits(word, 12, 12),
        "n": ubits(word, 0, 12),
        "good": ubits(word, 61, 1) == 0,
        "tagged": F.shiftrightunsigned(word, 62) == EVENT_TAG,
    }


def orbit_header(orbit: Column, length: Column, error: Column) -> Column:
    """11 | error | zeros | orbit 32 | length in words 24."""
    return join_fields(F.lit(-(2**62)), put(error.cast("int"), 61, 1), put(orbit, 24, 32), put(length, 0, 24))


def parse_orbit_header(word: Column) -> dict[str, Column]:
    return {"orbit": ubits(word, 24, 32), "length": ubits(word, 0, 24), "good": ubits(word, 61, 1) == 0, "tagged": F.shiftrightunsigned(word, 62) == ORBIT_TAG}


def orbit_seconds(orbit: Column, bx: Column) -> Column:
    """Time since orbit 0, in seconds."""
    return (orbit * BX_PER_ORBIT + bx) / F.lit(float(CLOCK_HZ))


def lumisection(orbit: Column, bits: int = LUMI_BITS) -> Column:
    return F.shiftright(orbit, bits) + 1


def orbits_of_duration(text: Column) -> Column:
    """Whole orbits in a duration such as 10, 10s, 2m or 1h; null for anything else."""
    number, unit = F.regexp_extract(text, r"^(\d+)([smh]?)$", 1), F.regexp_extract(text, r"^(\d+)([smh]?)$", 2)
    seconds = F.when(unit == "m", 60).when(unit == "h", 3600).otherwise(1)
    return F.when(number != "", F.floor(F.lit(CLOCK_HZ / BX_PER_ORBIT) * number.cast("double") * seconds))
