"""Fields of 64-bit particle candidates and 96-bit muons, and the lifts between layouts.

A decoder is a dict of columns over one word (or a word pair), so the same
expressions serve exploded rows, and arrays through `each`.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bits import join_fields, put, sbits, scaled, ubits

# Fixed values of the candidate format.
PDG_IDS = [130, 22, -211, 211, 11, -11, 13, -13]
PT_STEP = 0.25
ANGLE_STEP = math.pi / 720
Z0_STEP = 0.05
DXY_STEP = 0.05
WEIGHT_STEP = 1 / 256
# Fixed values of the muon format.
MUON_PT_STEP = 0.03125
MUON_ANGLE_STEP = math.pi / 4096
MUON_Z0_STEP = 0.05
MUON_D0_STEP = 0.03
MUON_BETA_STEP = 0.06


def pid(word: Column) -> Column:
    return ubits(word, 37, 3)


def charged(word: Column) -> Column:
    return pid(word) > 1


def pdg_id(code: Column) -> Column:
    """Particle number of a 3-bit code, from an array literal: a join with eight rows is not needed."""
    return F.element_at(F.array(*map(F.lit, PDG_IDS)), (code + 1).cast("int"))


def charge(code: Column) -> Column:
    """-1, 0 or 1: of the charged codes the even ones are negative but for electrons, as their particle numbers say."""
    return F.when(code <= 1, 0).when(code.isin(3, 5, 7), 1).otherwise(-1)


def puppi_ints(word: Column) -> dict[str, Column]:
    """Integer fields; those of the other kind of candidate are 0 (weight: 256)."""
    c = charged(word)
    return {
        "pt": ubits(word, 0, 14),
        "eta": sbits(word, 14, 12),
        "phi": sbits(word, 26, 11),
        "pid": pid(word),
        "z0": F.when(c, sbits(word, 40, 10)).otherwise(0),
        "dxy": F.when(c, sbits(word, 50, 8)).otherwise(0),
        "quality": F.when(c, ubits(word, 58, 3)).otherwise(ubits(word, 50, 6)),
        "wpuppi": F.when(c, 256).otherwise(ubits(word, 40, 10)),
    }


def puppi_floats(word: Column) -> dict[str, Column]:
    """32-bit float fields in GeV, radians and cm, the particle number and the quality."""
    return lift(puppi_ints(word))


def lift(ints: dict[str, Column]) -> dict[str, Column]:
    """Floats of integer fields, so that decoding from words and lifting integers agree by construction."""
    return {
        "pt": scaled(ints["pt"], PT_STEP),
        "eta": scaled(ints["eta"], ANGLE_STEP),
        "phi": scaled(ints["phi"], ANGLE_STEP),
        "pdgId": pdg_id(ints["pid"]),
        "z0": scaled(ints["z0"], Z0_STEP),
        "dxy": scaled(ints["dxy"], DXY_STEP),
        "wpuppi": scaled(ints["wpuppi"], WEIGHT_STEP),
        "quality": ints["quality"],
    }


def puppi_word(pt: Column, eta: Column, phi: Column, code: Column, z0: Column, dxy: Column, quality: Column) -> Column:
    return join_fields(put(pt, 0, 14), put(eta, 14, 12), put(phi, 26, 11), put(code, 37, 3), put(z0, 40, 10), put(dxy, 50, 8), put(quality, 58, 3))


def muon_halves(words: Column, k: Column) -> tuple[Column, Column]:
    """(64 low bits, 32 high bits) of muon k: two muons take three words, the middle one holds both high parts."""
    first = (F.floor(k / 2) * 3).cast("int")
    middle = F.get(words, first + 1)
    even = k % 2 == 0
    low = F.get(words, F.when(even, first).otherwise(first + 2))
    return low, F.when(even, ubits(middle, 0, 32)).otherwise(ubits(F.shiftright(middle, 32), 0, 32))


def muons_in(words: Column) -> Column:
    return F.floor(F.size(words) * 2 / 3).cast("int")


def muon_ints(low: Column, high: Column) -> dict[str, Column]:
    return {
        "pt": ubits(low, 1, 16),
        "phi": sbits(low, 17, 13),
        "eta": sbits(low, 30, 14),
        "z0": sbits(low, 44, 10),
        "d0": sbits(low, 54, 10),
        "charge": F.when(ubits(high, 0, 1) == 1, -1).otherwise(1),
        "quality": ubits(high, 1, 4),
        "isolation": ubits(high, 9, 4),
        "beta": ubits(high, 13, 4),
    }


def muon_floats(low: Column, high: Column) -> dict[str, Column]:
    """As integers, but the quality has its full 8 bits."""
    i = muon_ints(low, high)
    return {
        "pt": scaled(i["pt"], MUON_PT_STEP),
        "phi": scaled(i["phi"], MUON_ANGLE_STEP),
        "eta": scaled(i["eta"], MUON_ANGLE_STEP),
        "z0": scaled(i["z0"], MUON_Z0_STEP),
        "d0": scaled(i["d0"], MUON_D0_STEP),
        "charge": i["charge"],
        "quality": ubits(high, 1, 8),
        "isolation": i["isolation"],
        "beta": scaled(i["beta"], MUON_BETA_STEP),
    }


Decoder = Callable[[Column], dict[str, Column]]


def structs(words: Column, decoder: Decoder) -> Column:
    """Array of structs ("collection" layout) of an array of words."""
    return F.transform(words, lambda w: F.struct(*[c.alias(n) for n, c in decoder(w).items()]))


def muon_structs(words: Column, decoder: Callable[[Column, Column], dict[str, Column]] = muon_floats) -> Column:
    """Array of muon structs of an array of words."""
    n = muons_in(words)
    ks = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(ks, lambda k: F.struct(*[c.alias(x) for x, c in decoder(*muon_halves(words, k)).items()]))


def arrays(collection: Column, names: list[str], prefix: str) -> list[Column]:
    """One array a field ("vector" layout) of an array of structs, with its size in front."""
    return [F.size(collection).alias(f"n{prefix}"), *[collection[n].alias(f"{prefix}_{n}") for n in names]]


def float24(value: Column) -> Column:
    """A float whose mantissa keeps 16 bits: magnitudes are cut towards zero, exactly, by powers of two."""
    exponent = F.floor(F.log2(F.abs(value.cast("double"))))
    step = F.pow(F.lit(2.0), exponent - 15)
    return F.when(value == 0, value).otherwise((F.signum(value.cast("double")) * F.floor(F.abs(value.cast("double")) / step) * step).cast("float"))
