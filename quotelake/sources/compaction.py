"""Compaction of archive partitions through a manifest, so that readers see one generation.

The manifest is a ``KeyedTable`` of objects (files). An object is ``live``, ``claimed``
by a compaction (and still read), or ``superseded`` by what replaced it. A compaction
claims its sources, writes and verifies their replacement, and then supersedes them and
brings in the replacement by one swap of the manifest. One that stops before leaves
its sources in place; ``release`` gives them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .archive import SCHEMA_VERSION, row_digest, with_partition
from .keyed_table import KeyedTable

_KINDS = {"schema_version": T.IntegerType(), "generation": T.IntegerType(), "min_ns": T.LongType(), "max_ns": T.LongType(), "n_rows": T.LongType(), "n_bytes": T.LongType()}
_NAMES = ["object_id", "path", "stream", "date", "hour", "schema_version", "generation", "state", "claim", "superseded_by", "min_ns", "max_ns", "n_rows", "n_bytes"]
OBJECTS = T.StructType([T.StructField(c, _KINDS.get(c, T.StringType())) for c in _NAMES])
LIVE, CLAIMED, SUPERSEDED = "live", "claimed", "superseded"


def manifest_table(spark: SparkSession, root: str, buckets: int = 8) -> KeyedTable:
    return KeyedTable(spark, root, OBJECTS, ["object_id"], buckets)


def _objects(rows: DataFrame, time: str) -> DataFrame:
    """An object for each file of rows that are read from files, with its bounds of time."""
    file = F.col("_metadata.file_path")
    size = F.max("_metadata.file_size").alias("n_bytes")
    return rows.groupBy(file.alias("path")).agg(F.min(time).alias("min_ns"), F.max(time).alias("max_ns"), F.count(F.lit(1)).alias("n_rows"), size).withColumn("object_id", F.sha2("path", 256))


def register(table: KeyedTable, root: str, stream: str, time: str = "received_ts_ns") -> None:
    """Adds the files of a stream below an archive's root that the manifest doesn't have."""
    base = f"{root}/schema_version={SCHEMA_VERSION}"
    rows = table.spark.read.option("basePath", root).parquet(base).where(F.col("stream") == stream)
    found = _objects(rows, time).withColumns({"stream": F.lit(stream), "schema_version": F.lit(SCHEMA_VERSION), "generation": F.lit(0), "state": F.lit(LIVE)})
    found = found.withColumn("date", F.regexp_extract("path", "/date=([^/]+)/", 1)).withColumn("hour", F.regexp_extract("path", "/hour=([^/]+)/", 1))
    table.upsert(found, ["path"], "ignore")


def live_objects(table: KeyedTable) -> DataFrame:
    return table.read().where(F.col("state").isin(LIVE, CLAIMED))


def scan_live(table: KeyedTable, schema: T.StructType, where: F.Column | None = None) -> DataFrame:
    """Rows of the live objects, of those only whose manifest rows meet ``where`` (bounds, date, stream)."""
    objects = live_objects(table)
    paths = [r.path for r in (objects.where(where) if where is not None else objects).select("path").collect()]  # a list of files, as any scan plans
    return table.spark.read.schema(schema).parquet(*paths) if paths else table.spark.createDataFrame([], schema)


def release(table: KeyedTable, claim: str | None = None) -> None:
    """Gives the objects of a claim (or of all claims) back."""
    claimed = table.read().where(F.col("state") == CLAIMED)
    rows = claimed if claim is None else claimed.where(F.col("claim") == claim)
    table.upsert(rows.withColumns({"state": F.lit(LIVE), "claim": F.lit(None).cast("string")}), ["object_id"], "overwrite")


def compact_due(table: KeyedTable, root: str, stream: str, min_objects: int = 4, time: str = "received_ts_ns") -> int:
    """Merges the live files of every hour that has ``min_objects`` of them or more, in one job; gives how many were replaced.

    The replacement must have the same rows, each as often, and each hour the same
    bounds of time; its generation is one above the highest of the hour's sources.
    """
    spark, claim, hours = table.spark, uuid.uuid4().hex, ["date", "hour"]
    live = table.read().where((F.col("stream") == stream) & (F.col("state") == LIVE))
    due = live.groupBy(*hours).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_objects).select(*hours)
    sources = live.join(due, hours, "left_semi").select(*OBJECTS.names)
    chosen = sources.select("object_id", "path", "schema_version").collect()  # a list of files, as any scan plans
    if not chosen:
        return 0
    if any(r.schema_version != SCHEMA_VERSION for r in chosen):
        raise ValueError(f"only files of version {SCHEMA_VERSION} can be merged")
    table.upsert(sources.withColumns({"state": F.lit(CLAIMED), "claim": F.lit(claim)}), ["object_id"], "overwrite")
    mine = table.read().where((F.col("claim") == claim) & (F.col("state") == CLAIMED))
    try:
        if mine.count() != len(chosen):
            raise ValueError("another compaction has claimed some of the files")
        rows = with_partition(spark.read.parquet(*[r.path for r in chosen]))
        target = f"{root}/compacted/{claim}"
        rows.hint("rebalance", *hours).sortWithinPartitions(*hours, time).write.option("compression", "zstd").partitionBy(*hours).parquet(target)
        written = spark.read.schema(rows.schema).parquet(target).select(*rows.columns)
        if row_digest(rows) != row_digest(written):
            raise ValueError(f"{target} differs from its sources")
        fresh = _objects(written, time).withColumn("date", F.regexp_extract("path", "/date=([^/]+)/", 1)).withColumn("hour", F.regexp_extract("path", "/hour=([^/]+)/", 1))
        bounds = lambda objects: objects.groupBy(*hours).agg(F.min("min_ns").alias("low"), F.max("max_ns").alias("high"), F.sum("n_rows").alias("n"))
        if bounds(mine).exceptAll(bounds(fresh)).limit(1).count():
            raise ValueError(f"{target} has other bounds than its sources")
    except Exception:
        release(table, claim)
        raise
    fresh = fresh.join(mine.groupBy(*hours).agg((F.max("generation") + 1).alias("generation")), hours)
    fresh = fresh.withColumns({"stream": F.lit(stream), "schema_version": F.lit(SCHEMA_VERSION), "state": F.lit(LIVE), "claim": F.lit(None).cast("string"), "superseded_by": F.lit(None).cast("string")})
    old = mine.withColumns({"state": F.lit(SUPERSEDED), "superseded_by": F.lit(claim)})
    table.upsert(old.select(*OBJECTS.names).unionByName(fresh.select(*OBJECTS.names)), ["object_id"], "overwrite")
    return len(chosen)
