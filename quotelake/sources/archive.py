"""The hour-partitioned archive: layout, scans, writes, manifest, compaction."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_VERSION = 2
_LONGS = ("market_key", "token_key", "connection_id", "received_ts_ns", "price_mantissa", "size_mantissa")
UPDATES = T.StructType([T.StructField(c, T.LongType() if c in _LONGS else T.IntegerType()) for c in ("market_key", "token_key", "connection_id", "received_ts_ns", "side", "action", "price_mantissa", "price_scale", "size_mantissa", "size_scale")])
NANOS_PER_HOUR = 3_600_000_000_000


def instant(time: str | datetime) -> datetime:
    """A time in UTC, from ISO text or a datetime; one without an offset is UTC already."""
    at = datetime.fromisoformat(time) if isinstance(time, str) else time
    return at.astimezone(UTC) if at.tzinfo else at.replace(tzinfo=UTC)


def nanos(at: datetime) -> int:
    return (at - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1) * 1000


def hour_partitions(start: str | datetime, end: str | datetime, spark: SparkSession) -> DataFrame:
    """``date, hour`` of the partitions that meet ``[start, end)``."""
    low, high = instant(start), instant(end) - timedelta(microseconds=1)
    if low > high:
        return spark.createDataFrame([], "date string, hour string")
    hours = F.explode(F.sequence(*[F.lit(f"{t:%Y-%m-%d %H}:00:00").cast("timestamp_ntz") for t in (low, high)], F.expr("INTERVAL 1 HOUR")))
    return spark.range(1).select(hours.alias("h")).select(F.date_format("h", "yyyy-MM-dd").alias("date"), F.date_format("h", "HH").alias("hour"))


def with_partition(rows: DataFrame) -> DataFrame:
    """Adds ``date`` and ``hour`` of the received time."""
    at = F.timestamp_add("HOUR", F.expr(f"received_ts_ns div {NANOS_PER_HOUR}").cast("int"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    return rows.withColumn("date", F.date_format(at, "yyyy-MM-dd")).withColumn("hour", F.date_format(at, "HH"))


def write_archive(rows: DataFrame, root: str, exchange: str, stream: str, max_rows: int = 250_000, by: list[str] | None = None) -> None:
    """Appends rows as Zstandard Parquet without dictionary pages, by date and hour.

    Rows are dealt by hour; AQE splits an hour that is large and merges small
    ones, so files are neither huge nor many; each is sorted for narrow
    row-group bounds.
    """
    by = by or ["token_key", "received_ts_ns"]
    out = with_partition(rows).hint("rebalance", "date", "hour").sortWithinPartitions("date", "hour", *by)
    path = f"{root}/schema_version={SCHEMA_VERSION}/exchange={exchange}/stream={stream}"
    out.write.mode("append").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").option("parquet.enable.dictionary", "false").option("parquet.page.size", str(1 << 20)).option("maxRecordsPerFile", max_rows).partitionBy("date", "hour").parquet(path)


def scan_archive(spark: SparkSession, root: str, stream: str, schema: T.StructType, start: str | datetime | None = None, end: str | datetime | None = None, market_keys: DataFrame | None = None, columns: list[str] | None = None) -> DataFrame:
    """Rows of a stream in ``[start, end)``, given as ``instant`` takes them.

    Bounds on date and hour are derived from the instants, so whole directories
    are pruned; the exact bounds reach the row groups.
    """
    kinds = T.StructType([*schema.fields, *T.StructType.fromDDL("schema_version int, exchange string, stream string, date string, hour string").fields])
    rows = spark.read.schema(kinds).option("basePath", root).parquet(root).where((F.col("schema_version") == SCHEMA_VERSION) & (F.col("stream") == stream))
    stamp = F.concat("date", F.lit(" "), "hour")
    if start is not None:
        low = instant(start)
        rows = rows.where((F.col("received_ts_ns") >= nanos(low)) & (stamp >= f"{low:%Y-%m-%d %H}"))
    if end is not None:
        high = instant(end)
        rows = rows.where((F.col("received_ts_ns") < nanos(high)) & (stamp <= f"{high - timedelta(microseconds=1):%Y-%m-%d %H}"))
    if market_keys is not None:
        rows = rows.join(market_keys, "market_key", "left_semi")
    return rows.select(*(columns or schema.names))


def stream_files(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """``path, date, hour, n_rows, n_bytes`` of a stream's files; footers and the hidden file columns are enough."""
    path = f"{root}/schema_version={SCHEMA_VERSION}"
    rows = spark.read.option("basePath", root).parquet(path).where(F.col("stream") == stream)
    return rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("date").cast("string").alias("date"), F.col("hour").cast("string").alias("hour")).agg(F.count(F.lit(1)).alias("n_rows"), F.max("_metadata.file_size").alias("n_bytes"))


def dictionary(rows: DataFrame, kind: int, key: str, external_id: str, parent: str | None = None) -> DataFrame:
    """A row for each key seen: ``entity_kind, archive_key, parent_archive_key, external_id``."""
    above = F.col(parent) if parent else F.lit(None).cast("long")
    return rows.select(F.lit(kind).alias("entity_kind"), F.col(key).alias("archive_key"), above.alias("parent_archive_key"), F.col(external_id).cast("string").alias("external_id")).distinct()


def key_collisions(entries: DataFrame) -> DataFrame:
    """Keys that stand for two names: there must be none."""
    return entries.groupBy("entity_kind", "archive_key").agg(F.countDistinct("external_id").alias("names")).where("names > 1")


def decode(rows: DataFrame, entries: DataFrame, kind: int, key: str, name: str) -> DataFrame:
    """Adds external ids after all filters; an unknown key gives null."""
    known = entries.where(F.col("entity_kind") == kind).select(F.col("archive_key").alias(key), F.col("external_id").alias(name)).dropDuplicates([key])
    return rows.join(known, key, "left")


def store_bodies(requests: DataFrame, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Content-addressed bodies: each new body once, and the provenance of all requests. requests: source, requested_at, body."""
    rows = requests.withColumn("content_hash", F.sha2("body", 256))
    bodies = rows.groupBy("content_hash").agg(F.first("body").alias("body"))
    if stored is not None:
        bodies = bodies.join(stored.select("content_hash"), "content_hash", "left_anti")
    return bodies, rows.select("source", "requested_at", "content_hash").distinct()


def reuse_ratio(second: DataFrame, stored: DataFrame) -> DataFrame:
    """Share of the second crawl's bodies that were stored before it."""
    known = stored.select("content_hash").distinct().withColumn("known", F.lit(1))
    return second.join(known, "content_hash", "left").agg(F.count(F.lit(1)).alias("bodies"), F.count("known").alias("reused")).withColumn("ratio", F.try_divide(F.col("reused").cast("double"), F.col("bodies")))


def manifest(rows: DataFrame, keys: list[str], size: str, n_rows: str, time: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("objects"), F.sum(size).alias("total_bytes"), F.sum(n_rows).alias("total_rows"), F.min(time).alias("min_time"), F.max(time).alias("max_time"))


def reconcile(ours: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """Keys on one side only: ``missing`` (listed, not there) and ``orphan`` (there, not listed)."""
    missing = ours.select(key).join(remote, key, "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(remote.select(key).join(ours, key, "left_anti").withColumn("problem", F.lit("orphan")))


def compaction_plan(objects: DataFrame, as_of: Column, min_age_days: int, min_objects: int, target_bytes: int) -> DataFrame:
    """Objects to merge: of partitions with enough aged objects, the smallest until their bytes reach the target."""
    part = Window.partitionBy("stream", "date")
    aged = F.col("uploaded_at") <= F.timestamp_add("DAY", F.lit(-min_age_days), as_of)
    before = Window.partitionBy("stream", "date").orderBy("bytes", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = objects.withColumn("aged", F.count_if(aged).over(part)).where(F.col("aged") >= min_objects)
    rows = rows.withColumn("before", F.coalesce(F.sum("bytes").over(before), F.lit(0))).where(F.col("before") < target_bytes)
    return rows.withColumn("chosen", F.count(F.lit(1)).over(part)).where(F.col("chosen") >= min_objects).drop("aged", "before", "chosen")


def row_digest(rows: DataFrame) -> tuple:
    """Count, xor and sum of two independent digests of all rows, in any order; repeated rows count."""
    first, second = F.xxhash64(*rows.columns), F.xxhash64(F.lit("second"), *rows.columns)
    return tuple(rows.agg(F.count(F.lit(1)), *[f for x in (first, second) for f in (F.bit_xor(x), F.sum(x.cast("decimal(38,0)")))]).first())


def compact(spark: SparkSession, source: str, target: str, files: int, schema_version: int = SCHEMA_VERSION) -> None:
    """Merges a partition's files without a shuffle; fails unless the target has the same rows, each as often. Only the current version's files are merged."""
    if schema_version != SCHEMA_VERSION:
        raise ValueError(f"files of version {schema_version} can't be merged with version {SCHEMA_VERSION}")
    rows = spark.read.parquet(source)
    rows.coalesce(files).write.parquet(target)
    if row_digest(rows) != row_digest(spark.read.schema(rows.schema).parquet(target)):
        raise ValueError(f"{target} differs from {source}")


def cast_columns(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns coerced to a schema's types; what doesn't fit becomes null."""
    return rows.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def expire(rows: DataFrame, time: str, as_of: Column, hours: int) -> DataFrame:
    return rows.where(F.col(time) >= F.timestamp_add("HOUR", F.lit(-hours), as_of))


def closed_before(markets: DataFrame, as_of: Column, grace_hours: int) -> DataFrame:
    """Final, closed markets whose settlement (else close, else update) is older than the grace."""
    old = F.coalesce("settled_at", "closed_at", "updated_at") < F.timestamp_add("HOUR", F.lit(-grace_hours), as_of)
    return markets.where(F.col("inactive") & old)


def evict(books: DataFrame, tiers: DataFrame, markets: DataFrame, as_of: Column, grace_hours: int) -> tuple[DataFrame, DataFrame]:
    """Books and tiers that stay. A book goes with its final market; a tier if its market is final or has no book left."""
    gone = closed_before(markets, as_of, grace_hours)
    final = gone.where("finalised").select("market")
    books = books.join(final, "market", "left_anti")
    bare = gone.select("market").join(books.select("market").distinct(), "market", "left_anti")
    return books, tiers.join(final.unionByName(bare).distinct(), "market", "left_anti")
