"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Rows of an Arrow batch of texts, set where the session has Spark's own 10,000: long texts would fill a worker.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def released(it: Iterator) -> Iterator:
    """The same items; then a reused worker gives back the memory that the task leaves."""
    yield from it
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow in small batches, whose workers keep no memory between tasks."""
    small_batches(df.sparkSession)
    return df.mapInArrow(lambda it: released(work(it)), schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; in local mode alone, a temporary one where none is set, as in tests."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = getattr(spark, "_bunchflow_shared", None) or tempfile.mkdtemp(prefix="bunchflow-")
        spark._bunchflow_shared = at
    return at


def written(df: DataFrame, **sums: Column) -> DataFrame:
    """The same rows from a table in the shared folder: cuts the lineage, survives lost executors.

    measured() tells the number of its rows, and other sums that are taken on
    the way. A stage that runs again may count rows twice; 0 is exact.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/bunchflow/{uuid.uuid4().hex}"
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in sums.items()])
    observed.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._bunchflow_path, out._bunchflow_sums = path, seen.get
    return out


def measured(table: DataFrame, name: str = "rows") -> int:
    """What was summed while the table was written; of another table, its rows are counted."""
    sums = getattr(table, "_bunchflow_sums", None)
    return sums[name] if sums else table.count()


def dropped(*tables: DataFrame) -> None:
    """Deletes written tables that no later step reads."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._bunchflow_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_arrow(
    df: DataFrame, column: str, fields: list[T.StructField], work: Callable[[pa.Array], dict[str, pa.Array]], keep: list[str] | None = None, prepare: Callable[[], object] | None = None
) -> DataFrame:
    """df with new columns that work() makes from whole Arrow batches of a text column.

    keep: the columns of df that stay (all by default). A kept column of a new
    column's name is replaced. prepare() runs once in each task; its value is
    then work's second argument.
    """
    names = {f.name for f in fields}
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    # Duplicate names would make the plan ambiguous, so columns travel under their place.
    kept = [F.col(f"`{c}`").alias(c) for c in keep]
    data = df.select(*kept, F.col(f"`{column}`").cast("string").alias("__text__"))
    schema = T.StructType([data.schema[c] for c in keep] + fields)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = (prepare(),) if prepare else ()
        for batch in it:
            if batch.num_rows:
                new = work(batch.column(len(keep)), *ready)
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(new[f.name] for f in fields)], names=[*keep, *(f.name for f in fields)])

    return in_arrow(data, run, schema)


def by_group(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """work() on the rows of each group of long keys: many small groups share a task and its batches.

    A group must fit into memory; the caller bounds it.
    """
    names = [*keys, *(c for c in df.columns if c not in keys)]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in it:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            cuts = np.zeros(rows.num_rows - 1, bool)
            for k in keys:
                cuts |= np.diff(rows.column(k).to_numpy()) != 0
            bounds = [0, *(np.flatnonzero(cuts) + 1).tolist()]
            for a, b in zip(bounds[:-1], bounds[1:]):
                if (out := work(rows.slice(a, b - a))) is not None:
                    yield out
            rest = rows.slice(bounds[-1])
        if rest is not None and (out := work(rest)) is not None:
            yield out

    return in_arrow(df.select(*names).repartition(*keys).sortWithinPartitions(*keys), run, schema)
