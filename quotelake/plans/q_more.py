"""Queries over sampling of books, tags, JSON projection, and archive paths."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import book, sampling
from ..operators import normalise as n
from .q_archive import written
from .q_book import BOOK, METRICS, bk, book_events
from .registry import family
from .standins import table

Q, SQL, query = family()


@query(
    "l3_observe_on_change",
    """WITH RECURSIVE g AS (SELECT user_id AS token_key, unnest(generate_series(low, high, INTERVAL 2 HOUR)) AS tick FROM (SELECT DISTINCT user_id FROM events), (SELECT date_trunc('hour', min(ts)) AS low, max(ts) AS high FROM events)),
s AS (SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) // 3 AS state FROM events),
p AS (SELECT g.token_key, g.tick, s.state, row_number() OVER (PARTITION BY g.token_key ORDER BY g.tick) AS n FROM g ASOF JOIN s ON g.token_key = s.user_id AND g.tick >= s.ts),
r AS (SELECT token_key, n, tick, state, true AS emitted, 'change' AS kind, state AS old, tick AS at FROM p WHERE n = 1
  UNION ALL SELECT p.token_key, p.n, p.tick, p.state, p.state <> r.old OR p.tick >= r.at + INTERVAL 12 HOUR, CASE WHEN p.state <> r.old THEN 'change' ELSE 'heartbeat' END,
    p.state, CASE WHEN p.state <> r.old OR p.tick >= r.at + INTERVAL 12 HOUR THEN p.tick ELSE r.at END FROM r JOIN p ON p.token_key = r.token_key AND p.n = r.n + 1)
SELECT token_key, tick, state::BIGINT AS state, kind FROM r WHERE emitted""",
)
def _(spark, d):
    """Books looked at on a grid of ticks: a row when the state changed since the tick before, and a heartbeat while it doesn't."""
    ev = table(spark, d, "events")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    states = ev.select(F.col("user_id").alias("token_key"), "ts", "event_id", F.floor(F.row_number().over(order) / 3).alias("state"))
    span = ev.agg(F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz").alias("low"), F.max("ts").alias("high"))  # one row
    grid = F.explode(F.sequence("low", "high", F.expr("INTERVAL 2 HOURS")))
    ticks = ev.select(F.col("user_id").alias("token_key")).distinct().crossJoin(F.broadcast(span)).select("token_key", grid.alias("tick"))
    seen = book.last_before(ticks, states, ["token_key"], "tick", "ts", ["state"], ["event_id"]).where("state IS NOT NULL")
    return sampling.observe_on_change(seen, ["token_key"], "tick", "state", 12 * 3600)


@query("p6_not_crossed", bk(f"WITH {BOOK}, {METRICS.format(k='token_key')} SELECT token_key FROM m WHERE best_ask IS NULL OR best_bid IS NULL OR best_ask >= best_bid"))
def _(spark, d):
    return book.not_crossed(book.book_metrics(book.replay_book(book_events(spark, d)))).select("token_key")


@query("s21_json_keep_keys", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '{\"a\":\"' || event_type || '\",\"b\":\"' || user_id || '\"}' ELSE '{\"b\":\"' || user_id || '\"}' END AS kept FROM events")
def _(spark, d):
    body = F.to_json(F.struct(F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("a"), F.col("user_id").cast("string").alias("b"), F.lit("x").alias("dropped")))
    return table(spark, d, "events").select("event_id", s.keep_keys(body, "a", "b").alias("kept"))


@query("n7_tag_normalise", "SELECT p_partkey::VARCHAR AS tag_id, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE p_partkey::VARCHAR END AS name FROM part")
def _(spark, d):
    third = F.col("p_partkey") % 3
    body = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.when(third == 0, F.col("p_name")).alias("label"), F.when(third == 1, F.col("p_brand")).alias("slug")))
    return n.tags(table(spark, d, "part").select(body.alias("payload")))


@query("a3_resolve_paths", "SELECT count(*) AS n_rows, count(DISTINCT date_trunc('hour', ts)) AS hours FROM events WHERE NOT (event_type = 'signup' AND (props->>'$.k')::INT < 50)")
def _(spark, d):
    """The files below a root, by the path of each: every written hour is there."""
    from ..sources import archive

    files = archive.stream_files(spark, written(spark, d), "orderbook_updates")
    return files.agg(F.sum("n_rows").alias("n_rows"), F.countDistinct("date", "hour").alias("hours"))
