"""Angles, separations and invariant masses."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: charged pion mass, GeV.
PION_MASS = 0.1396


def delta_phi(a: Column, b: Column) -> Column:
    """a - b, wrapped to -pi .. pi."""
    d = a - b
    return d - F.lit(2 * math.pi) * F.round(d / F.lit(2 * math.pi))


def delta_r2(eta1: Column, phi1: Column, eta2: Column, phi2: Column) -> Column:
    d, p = eta1 - eta2, delta_phi(phi1, phi2)
    return d * d + p * p


def mass(*particles: tuple[Column, Column, Column], m: float = PION_MASS) -> Column:
    """Invariant mass of (pt, eta, phi) of particles of mass m."""

    def total(term):
        out = term(*particles[0])
        for p in particles[1:]:
            out = out + term(*p)
        return out

    e = total(lambda pt, eta, phi: F.sqrt(pt * pt * F.cosh(eta) * F.cosh(eta) + F.lit(m * m)))
    x = total(lambda pt, eta, phi: pt * F.cos(phi))
    y = total(lambda pt, eta, phi: pt * F.sin(phi))
    z = total(lambda pt, eta, phi: pt * F.sinh(eta))
    return F.sqrt(F.greatest(e * e - x * x - y * y - z * z, F.lit(0.0)))
