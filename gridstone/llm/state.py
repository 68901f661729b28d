"""Shared-folder state: tables written once and reread, never machine-local."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_held: dict[object, object] = {}


def held(name: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept in this Python worker for tasks to come.  One
    thing at a time: workers serve all operators, and would gather their tables."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


_small: list[dict] = []


def kept_small(table: dict) -> dict:
    """``table``, a cache that is quickly made anew, to be emptied by release()."""
    _small.append(table)
    return table


def release() -> None:
    """Let go what another operator's task left in this worker."""
    _held.clear()
    for table in _small:
        table.clear()
    pa.default_memory_pool().release_unused()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset and the session is of one machine (master ``local``, as
    in tests) a temporary folder is made and set.  On a cluster its absence is
    an error: a folder of one machine loses what the others write.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='gridstone-')}")
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and reread it: lineage ends here.

    The files survive the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gridstone-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ordered_ids(df: DataFrame, key: str, name: str) -> tuple[DataFrame, DataFrame | None]:
    """(``df`` with a long ``name`` in place of ``key`` and in its order, the
    table of both).  Integers stand for themselves and need no table; other
    keys are numbered in the order of their sorted partitions.  Null stays null.
    """
    if isinstance(df.schema[key].dataType, T.IntegralType):
        return df.withColumn(name, F.col(key).cast("long")).drop(key), None
    known = df.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key)
    names = written(known.withColumn(name, F.monotonically_increasing_id()), "ids")
    return df.join(names, key, "left").drop(key), names


def n_parts(spark: SparkSession, df: DataFrame | None = None, bytes_each: int = 8 << 20) -> int:
    """Number of groups to deal work into: follows the input's size and the
    cluster's shuffle setting, so that each group stays memory-sized."""
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if df is None:
        return base
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(x for x in sizes if x < 1 << 60)  # an unknown size is given as the largest there is
    return max(base, min(size // bytes_each, 1_000_000))


def bounded_batches(spark: SparkSession, most: int = 512, most_bytes: int = 8 << 20) -> None:
    """Let Arrow batches hold at most ``most`` rows, and about ``most_bytes``,
    in this session: texts can be long, and a batch is in memory whole, on
    either side."""
    for name, least in (("spark.sql.execution.arrow.maxRecordsPerBatch", most), ("spark.sql.execution.arrow.maxBytesPerBatch", most_bytes)):
        now = int(spark.conf.get(name).rstrip("b"))
        if now <= 0 or now > least:
            spark.conf.set(name, str(least))


def in_turn(*steps: Callable) -> Callable:
    """One function over batches for several, so that a task needs one Python
    worker for all of them."""

    def run(batches):
        for step in steps:
            batches = step(batches)
        yield from batches

    return run
