"""Shared helpers of the training-data operators."""
from __future__ import annotations

import ctypes
import gc
import os
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentilake.session import shared_path

WORD = r"[^\x20\x09-\x0D]+"
SMALL_GROUPS = 1000


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share (`spark.checkpoint.dir`).

    Only a local session without that setting gets a temporary folder.
    """
    return shared_path(spark, name)


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a reused result as Parquet in the shared folder and read it back."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, clear: Callable[[], None]) -> None:
    """Say in a Python worker that `name` keeps tables there. Those of other operators, which ran in it before, are dropped.

    What they took is given back to the system, as a worker lives on from one operator to the next.
    """
    others = [n for n in _HELD if n != name]
    for other in others:
        _HELD.pop(other)()
    if others:
        give_back()
    _HELD[name] = clear


def give_back() -> None:
    """Return freed memory to the system, where the C library can: many small freed objects otherwise stay with the process."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """Hand rows to Python workers in Arrow batches of about `size` while an action runs.

    A batch is held on both sides at once, in every task of an executor.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose machines do not share that path, the package goes along as --py-files.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def bounded_sample(rows: DataFrame, group: str, key: str, per_group: int, seed: int = 0) -> DataFrame:
    """About `per_group` rows of each group, chosen by the hash of a key column.

    The counts read the group and key columns only. Everything is kept of a group that
    has fewer rows. The expected size is the bound; the draw is the same on every run. Up to
    `SMALL_GROUPS` counts are sent to all executors, so the rows are filtered where they are.
    """
    counts = stash(rows.groupBy(F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n")), "group-counts")
    small = counts.limit(SMALL_GROUPS + 1).count() <= SMALL_GROUPS
    u = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (rows.join(F.broadcast(counts) if small else counts, F.col(group) == F.col("_g"))
            .where(u * F.col("_n") < per_group).drop("_g", "_n"))
