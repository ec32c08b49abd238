"""name -> query and name -> SQL, of all modules of this package."""

from __future__ import annotations

from . import decode, files, framing, live, select, wire

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (decode, select, framing, live, wire, files):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
