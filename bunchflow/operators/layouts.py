"""Schema operators: flattening, description, and types that Spark lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(kind: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out: list[tuple[str, ...]] = []
    for f in kind.fields:
        at = (*path, f.name)
        out += _leaves(f.dataType, at) if isinstance(f.dataType, T.StructType) else [at]
    return out


def flattened(df: DataFrame) -> DataFrame:
    """Struct fields as columns with dotted names, at any depth; arrays of structs stay, their fields read as arrays."""
    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)) for path in _leaves(df.schema)])


def described(df: DataFrame) -> DataFrame:
    """(column, type, depth) of the flattened columns; depth counts nested arrays."""
    rows = []
    for f in flattened(df.limit(0)).schema.fields:
        kind, depth = f.dataType, 0
        while isinstance(kind, T.ArrayType):
            kind, depth = kind.elementType, depth + 1
        rows.append((f.name, f.dataType.simpleString(), depth))
    return df.sparkSession.createDataFrame(rows, "column string, type string, depth int")
