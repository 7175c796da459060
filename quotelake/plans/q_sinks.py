"""Sinks that keep a table's keys unique, and compaction that replaces files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import history
from ..session import new_folder
from ..sources import archive, compaction
from ..sources.keyed_table import MODES, KeyedTable
from .q_book import exact
from .q_streaming import events
from .registry import family
from .standins import view, with_views

Q, SQL, query = family()

LATEST = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("event_id", T.LongType()), T.StructField("value", T.DecimalType(18, 2))])


@query(
    "a16_keyed_sink",
    """WITH e AS (SELECT user_id, event_type, event_id, ts, CASE WHEN (props->>'$.k')::INT % 3 <> 0 THEN value::DECIMAL(18, 2) END AS value FROM events),
m AS (SELECT 'ignore' AS mode, user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, arg_min_null(value, (ts, event_id)) AS value FROM e GROUP BY ALL
  UNION ALL SELECT 'overwrite', user_id, event_type, arg_max(event_id, (ts, event_id)), arg_max_null(value, (ts, event_id)) FROM e GROUP BY ALL
  UNION ALL SELECT 'merge', user_id, event_type, arg_max(event_id, (ts, event_id)), arg_max(value, (ts, event_id)) FILTER (value IS NOT NULL) FROM e GROUP BY ALL)
SELECT mode, user_id, event_type, event_id, value::DECIMAL(38, 6)::VARCHAR AS value FROM m""",
)
def _(spark, d):
    """A stream of events into three tables, one for each way to meet a stored key; micro-batches by time, the last of them twice."""
    root, out = new_folder(spark, "keyed-sink"), None
    tables = {mode: KeyedTable(spark, f"{root}/{mode}", LATEST, ["user_id", "event_type"], buckets=4) for mode in MODES}

    def save(rows, batch):
        rows = rows.withColumn("value", F.when(F.col("k") % 3 != 0, F.col("value").cast("decimal(18,2)"))).persist()
        for _ in range(2):  # as if the first try had stopped after its last write
            for mode, table in tables.items():
                table.upsert(rows, ["ts", "event_id"], mode, ("events", batch))
        rows.unpersist()

    landing = f"{root}/landing"
    ev = spark.read.parquet(f"{d}/events.parquet")
    low, high = ev.agg(F.min("ts"), F.max("ts")).first()
    for half in (0, 1):
        later = F.col("ts") >= F.lit(low + (high - low) // 2) if low else F.lit(False)
        ev.where(later == bool(half)).write.mode("append").parquet(landing)
        events(spark, landing, "*.parquet").writeStream.option("checkpointLocation", f"{root}/state").foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    for mode, table in tables.items():
        rows = table.read().select(F.lit(mode).alias("mode"), "user_id", "event_type", "event_id", *exact("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "a13_compact_generations",
    """WITH r AS (SELECT date_trunc('hour', make_timestamp(epoch_us(ts) // 24)) AS h, user_id % 6 AS part FROM events), f AS (SELECT h, count(DISTINCT part) AS files, count(*) AS n FROM r GROUP BY h)
SELECT strftime(h, '%Y-%m-%d') AS date, strftime(h, '%H') AS hour, CASE WHEN files >= 4 THEN 1 ELSE 0 END::INT AS generation, sum(n)::BIGINT AS n_rows, max(CASE WHEN files >= 4 THEN files ELSE 0 END)::BIGINT AS superseded FROM f GROUP BY ALL""",
)
def _(spark, d):
    """Hours with four files or more are merged and the files replaced in the manifest; readers see each row once."""
    root = new_folder(spark, "compacted-archive")
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts"))
    rows = view(spark, d, "bk_events").select("token_key", "seq", (F.floor(us / 24) * 1000).alias("received_ts_ns"))  # a day's rows in an hour
    for part in range(6):
        archive.write_archive(rows.where(F.col("token_key") % 6 == part), root, "x", "orderbook_updates")
    table = compaction.manifest_table(spark, f"{root}-manifest")
    compaction.register(table, root, "orderbook_updates")
    compaction.compact_due(table, root, "orderbook_updates", min_objects=4)
    hour = F.expr(f"received_ts_ns div {archive.NANOS_PER_HOUR}")
    read = compaction.scan_live(table, T.StructType.fromDDL("token_key long, seq long, received_ts_ns long")).groupBy(hour.alias("h")).agg(F.count(F.lit(1)).alias("n_rows"))
    live = compaction.live_objects(table).groupBy("date", "hour").agg(F.max("generation").alias("generation"), F.min(F.expr(f"min_ns div {archive.NANOS_PER_HOUR}")).alias("h"))
    gone = table.read().where(F.col("state") == compaction.SUPERSEDED).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("superseded"))
    return live.join(read, "h").join(gone, ["date", "hour"], "left").select("date", "hour", "generation", "n_rows", F.coalesce("superseded", F.lit(0)).alias("superseded"))


DOCUMENT = """concat('{"status":"', status, '"', CASE WHEN seq % 2 = 0 THEN concat(',"depth":{"list":[1,2],"seq":', CAST(seq AS {text}), '}') ELSE '' END,
  CASE WHEN seq % 3 = 0 THEN concat(',"n":', CAST(seq AS {text})) ELSE '' END, CASE WHEN seq % 5 = 0 THEN ',"gone":1' ELSE '' END, CASE WHEN seq % 7 = 0 THEN ',"n2":null' ELSE '' END, '}')"""


@query(
    "v5_v13_json_patches",
    with_views(
        "md_polls",
        f"""WITH p AS (SELECT *, {DOCUMENT.replace("{text}", "VARCHAR")} AS document, max(source_ts) OVER w AS top, max(observed_at) OVER w AS seen FROM md_polls WHERE market % 4 <> 0 WINDOW w AS (PARTITION BY market ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT * FROM p WHERE NOT coalesce(CASE WHEN source_ts IS NOT NULL AND top IS NOT NULL THEN source_ts <= top ELSE observed_at <= seen END, false)),
k AS (SELECT market, seq, document, unnest(json_keys(document)) AS field FROM f),
l AS (SELECT market, field, arg_max(json_extract(document, '$.' || field)::VARCHAR, seq) AS value FROM k WHERE field IN ('status', 'depth', 'n', 'n2') GROUP BY ALL)
SELECT market, '{{' || string_agg('"' || field || '":' || value, ',' ORDER BY field) || '}}' AS document FROM l GROUP BY market""",
    ),
)
def _(spark, d):
    """Sparse patches of known markets merged field by field: stale ones and fields off the list change nothing."""
    polls = view(spark, d, "md_polls").withColumn("document", F.expr(DOCUMENT.replace("{text}", "STRING")))
    known = polls.where("market % 4 <> 0").select("market")
    return history.apply_patches(polls, known, ["market"], ["seq"], "source_ts", "observed_at", "document", ["status", "depth", "n", "n2"])
