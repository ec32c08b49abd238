"""Analytics over bit-packed, orbit-structured event streams on PySpark."""
