"""Bit fields of 64-bit words held in BIGINT columns.

A word is a bit pattern: values with the top bit set are negative BIGINTs. All
fields are masked after the shift, so arithmetic and logical shifts agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ubits(word: Column, start: int, bits: int) -> Column:
    """Unsigned field of `bits` bits from bit `start` on."""
    return F.shiftright(word, start).bitwiseAND(F.lit((1 << bits) - 1))


def sbits(word: Column, start: int, bits: int) -> Column:
    """Two's complement field."""
    u = ubits(word, start, bits)
    return u - F.shiftleft(F.shiftright(u, bits - 1), bits)


def put(value: Column, start: int, bits: int) -> Column:
    """The field's bits at their place in a word; higher bits of the value are cut off."""
    return F.shiftleft(value.cast("long").bitwiseAND(F.lit((1 << bits) - 1)), start)


def join_fields(*fields: Column) -> Column:
    out = fields[0]
    for f in fields[1:]:
        out = out.bitwiseOR(f)
    return out


def scaled(value: Column, step: float) -> Column:
    """value * step in 32-bit floats, as detectors' readout defines it."""
    return value.cast("float") * F.lit(step).cast("float")


def hex_word(word: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(word)), 16, "0")
