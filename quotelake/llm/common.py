"""Shared helpers: where jobs may write, how lineage is cut, how tables are read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What the innermost ``last_kept`` of this thread has seen written.
_WRITTEN: ContextVar[list[str] | None] = ContextVar("written", default=None)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = new_folder(spark, name)
    if _WRITTEN.get() is not None:
        _WRITTEN.get().append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``scratch`` gave."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    if _WRITTEN.get() and path in _WRITTEN.get():
        _WRITTEN.get().remove(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that holds inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what reads the result doesn't repeat the work before it
    and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with setting(spark, CLEANUP, "true"):  # what was shuffled for this table isn't read again
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def last_kept(spark: SparkSession) -> Iterator[None]:
    """Of the folders that this thread writes inside, only the last stays, and none after an error: for code that ends by cutting its result."""
    mine: list[str] = []
    outer = _WRITTEN.set(mine)
    try:
        yield
        kept = mine[-1:]
    except BaseException:
        kept = []
        raise
    finally:
        for path in [p for p in mine if p not in kept]:
            remove(spark, path)
        _WRITTEN.reset(outer)
        if kept and _WRITTEN.get() is not None:
            _WRITTEN.get().extend(kept)


def digest(*columns: Column) -> Column:
    """128 bits of the columns, as a struct of two numbers."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("b"), *columns).alias("b"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
