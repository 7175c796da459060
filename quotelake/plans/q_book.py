"""Queries over the order-book operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import book
from ..operators.prefix import spread
from .registry import family
from .standins import table, view, with_views

Q, SQL, query = family()


def real(*names: str) -> list:
    return [F.round(F.col(n).cast("double"), 6).alias(n) for n in names]


def exact(*names: str) -> list:
    """Decimals as text, so that every digit is compared."""
    return [F.col(n).cast("decimal(38,6)").cast("string").alias(n) for n in names]


def snapshot_levels() -> F.Column:
    """Three to six levels that vary from row to row; those whose size isn't positive are to be left out."""
    cent = F.lit("0.010000").cast("decimal(7,6)")
    cents = lambda j: F.when(j % 2 == 0, 30).otherwise(60) + (F.col("k") + 3 * j) % 10
    level = lambda j: F.struct(F.when(j % 2 == 0, 1).otherwise(2).alias("side"), (cents(j) * cent).cast("decimal(18,6)").alias("price"), (F.col("v") - 10 * j).cast("decimal(18,6)").alias("size"))
    return F.transform(F.sequence(F.lit(0), 2 + F.col("k") % 4), level)


def parts_of(spark: SparkSession, sf_dir: str) -> int:
    """Into how many parts the busiest token is cut."""
    return spread(table(spark, sf_dir, "events"), ["user_id"])


def book_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "bk_events").withColumn("levels", F.when(F.col("kind") == 0, snapshot_levels()))


EPOCHS = """
e AS (SELECT *, sum(CASE WHEN kind = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY token_key ORDER BY ts, kind, seq ROWS UNBOUNDED PRECEDING) AS epoch FROM bk_events WHERE NOT is_recon)"""
# A snapshot's levels, by their number j.
SIDE = "CASE WHEN j % 2 = 0 THEN 1 ELSE 2 END"
PRICE = "((CASE WHEN j % 2 = 0 THEN 30 ELSE 60 END + (k + 3 * j) % 10) * 0.01)::DECIMAL(18, 6)"
MOVES = f"""{EPOCHS},
mv AS (
  SELECT token_key, epoch, ts, kind, seq, {SIDE} AS side, {PRICE} AS price, true AS is_set, (v - 10 * j)::DECIMAL(38, 6) AS x FROM (SELECT *, unnest(range(3 + k % 4)) AS j FROM e WHERE kind = 0) WHERE v > 10 * j
  UNION ALL SELECT token_key, epoch, ts, kind, seq, side, price, action <> 4, CASE WHEN action = 2 THEN 0 ELSE x END::DECIMAL(38, 6) FROM e WHERE kind = 1),
sg AS (SELECT *, sum(is_set::INT) OVER (PARTITION BY token_key, epoch, side, price ORDER BY ts, kind, seq ROWS UNBOUNDED PRECEDING) AS segment FROM mv WHERE epoch > 0),
rs AS (SELECT *, sum(CASE WHEN is_set THEN greatest(x, 0) ELSE x END) OVER (PARTITION BY token_key, epoch, side, price, segment ORDER BY ts, kind, seq ROWS UNBOUNDED PRECEDING) AS s FROM sg),
sz AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY token_key, epoch, side, price, segment ORDER BY ts, kind, seq ROWS UNBOUNDED PRECEDING)) AS size FROM rs)"""
BOOK = f"""{MOVES},
fin AS (SELECT token_key, epoch, side, price, arg_max(size, (ts, kind, seq)) AS size, max(ts) AS last_ts FROM sz GROUP BY ALL),
bk AS (SELECT * FROM fin WHERE size > 0 AND (token_key, epoch) IN (SELECT token_key, max(epoch) FROM e GROUP BY token_key))"""
METRICS = """
q AS (SELECT *, max(CASE WHEN side = 1 THEN price END) OVER b AS best_bid, min(CASE WHEN side = 2 THEN price END) OVER b AS best_ask FROM bk WINDOW b AS (PARTITION BY {k})),
m AS (SELECT {k}, any_value(best_bid) AS best_bid, any_value(best_ask) AS best_ask, any_value(best_bid + best_ask)::DOUBLE / 2 AS midpoint,
  coalesce(sum(size) FILTER (side = 1), 0) AS bid_depth, coalesce(sum(size) FILTER (side = 2), 0) AS ask_depth,
  coalesce(sum(size) FILTER (side = 1 AND price = best_bid), 0) AS bid_depth_top, coalesce(sum(size) FILTER (side = 2 AND price = best_ask), 0) AS ask_depth_top,
  coalesce(sum(size) FILTER (side = 1 AND 200 * price >= 99 * (best_bid + best_ask)), 0) AS bid_depth_1pct, coalesce(sum(size) FILTER (side = 2 AND 200 * price <= 101 * (best_bid + best_ask)), 0) AS ask_depth_1pct,
  count(*) AS level_count FROM q GROUP BY {k})"""


EXACT = ("best_bid", "best_ask", "spread", "bid_depth", "ask_depth", "bid_depth_top", "ask_depth_top", "bid_depth_1pct", "ask_depth_1pct")


def measured(keys: str) -> str:
    text = ", ".join(f"{c}::DECIMAL(38, 6)::VARCHAR AS {c}" for c in EXACT if c != "spread")
    return f"""SELECT {keys}, {text}, (best_ask - best_bid)::DECIMAL(38, 6)::VARCHAR AS spread, round(midpoint, 6) AS midpoint,
  round((best_ask - best_bid)::DOUBLE / midpoint * 10000, 4) AS spread_bps, round((bid_depth - ask_depth)::DOUBLE / (bid_depth + ask_depth)::DOUBLE, 6) AS imbalance, level_count FROM m"""


def metrics(levels: DataFrame, *keys: str) -> DataFrame:
    keys = keys or ("token_key",)
    m = book.book_metrics(levels, *keys)
    return m.select(*keys, *exact(*EXACT), *real("midpoint", "imbalance"), F.round("spread_bps", 4).alias("spread_bps"), "level_count")


def bk(sql: str) -> str:
    return with_views("bk_events", sql)


@query("d2_book_epochs", bk(f"WITH {EPOCHS} SELECT token_key, seq, kind, epoch::BIGINT AS epoch FROM e"))
def _(spark, d):
    return book.with_epochs(book_events(spark, d), parts_of(spark, d)).select("token_key", "seq", "kind", "epoch")


@query("d3_d4_level_sizes", bk(f"WITH {MOVES} SELECT token_key, epoch::BIGINT AS epoch, seq, side, price::DECIMAL(38, 6)::VARCHAR AS price, size::DECIMAL(38, 6)::VARCHAR AS size FROM sz"))
def _(spark, d):
    return book.level_sizes(book.book_moves(book_events(spark, d), parts_of(spark, d)), parts_of(spark, d)).select("token_key", "epoch", "seq", "side", *exact("price", "size"))


@query("d5_replay_book", bk(f"WITH {BOOK} SELECT token_key, epoch::BIGINT AS epoch, side, price::DECIMAL(38, 6)::VARCHAR AS price, size::DECIMAL(38, 6)::VARCHAR AS size, last_ts FROM bk"))
def _(spark, d):
    return book.replay_book(book_events(spark, d), parts=parts_of(spark, d)).select("token_key", "epoch", "side", *exact("price", "size"), "last_ts")


@query("d6_replay_violations", bk(f"WITH {EPOCHS} SELECT token_key, ts, seq, 'delta_before_snapshot' AS rule FROM e WHERE kind = 1 AND epoch = 0"))
def _(spark, d):
    return book.replay_violations(book_events(spark, d))


@query(
    "d7_book_as_of",
    bk(f"""WITH t AS (SELECT token_key, unnest([TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-12', TIMESTAMP '2024-01-20']) AS tick FROM (SELECT DISTINCT token_key FROM bk_events)), {MOVES},
al AS (SELECT z.*, t.tick FROM sz z JOIN t ON z.token_key = t.token_key AND z.ts <= t.tick),
cur AS (SELECT t.token_key, t.tick, max(e.epoch) AS epoch FROM t JOIN e ON e.token_key = t.token_key AND e.ts <= t.tick GROUP BY ALL),
f AS (SELECT token_key, tick, epoch, side, price, arg_max(size, (ts, kind, seq)) AS size FROM al GROUP BY ALL)
SELECT f.token_key, f.tick, side, price::DECIMAL(38, 6)::VARCHAR AS price, size::DECIMAL(38, 6)::VARCHAR AS size FROM f JOIN cur USING (token_key, tick, epoch) WHERE size > 0"""),
)
def _(spark, d):
    events = book_events(spark, d)
    ticks = F.array(*[F.lit(t).cast("timestamp_ntz") for t in ("2024-01-05", "2024-01-12", "2024-01-20")])
    return book.book_at_ticks(events, events.select("token_key").distinct().withColumn("tick", F.explode(ticks)), parts_of(spark, d)).select("token_key", "tick", "side", *exact("price", "size"))


@query("d8_d14_book_metrics", bk(f"WITH {BOOK}, {METRICS.format(k='token_key')} {measured('token_key')}"))
def _(spark, d):
    return metrics(book.replay_book(book_events(spark, d)))


@query("d15_book_serialise", bk(f"""WITH {BOOK} SELECT token_key, string_agg(price::DECIMAL(18, 2)::VARCHAR || ':' || size::DECIMAL(18, 2)::VARCHAR, ',' ORDER BY price DESC) FILTER (side = 1) AS bids,
  string_agg(price::DECIMAL(18, 2)::VARCHAR || ':' || size::DECIMAL(18, 2)::VARCHAR, ',' ORDER BY price) FILTER (side = 2) AS asks FROM bk GROUP BY token_key"""))
def _(spark, d):
    levels = book.replay_book(book_events(spark, d))
    bids, asks = (book.serialise_side(levels, s).withColumnRenamed("text", n) for s, n in ((1, "bids"), (2, "asks")))
    return bids.join(asks, "token_key", "full_outer").select("token_key", "bids", "asks")


@query(
    "d16_microstructure",
    bk(f"""WITH {BOOK}, {METRICS.format(k='token_key')}, w AS ({measured('token_key')}),
a AS (SELECT token_key, count(*) FILTER (kind = 1) AS updates, count(*) FILTER (event_type = 'purchase') AS trades, arg_max(price, (ts, seq)) FILTER (event_type = 'purchase') AS last_trade FROM bk_events GROUP BY token_key)
SELECT w.*, updates, trades, last_trade::DECIMAL(38, 6)::VARCHAR AS last_trade FROM w JOIN a USING (token_key)"""),
)
def microstructure(spark, d):
    events = book_events(spark, d)
    bought = F.col("event_type") == "purchase"
    activity = events.groupBy("token_key").agg(F.count_if(F.col("kind") == 1).alias("updates"), F.count_if(bought).alias("trades"), F.max_by("price", F.when(bought, F.struct("ts", "seq"))).alias("last_trade"))
    return metrics(book.replay_book(events)).join(activity.select("token_key", "updates", "trades", *exact("last_trade")), "token_key")


CLOSING = bk(f"""WITH t AS (SELECT token_key, max(ts) AS tick FROM bk_events WHERE event_type = 'error' AND k >= 90 GROUP BY token_key), {MOVES},
al AS (SELECT z.*, t.tick FROM sz z JOIN t ON z.token_key = t.token_key AND z.ts <= t.tick),
cur AS (SELECT t.token_key, t.tick, max(e.epoch) AS epoch FROM t JOIN e ON e.token_key = t.token_key AND e.ts <= t.tick GROUP BY ALL),
bk AS (SELECT f.* FROM (SELECT token_key, tick, epoch, side, price, arg_max(size, (ts, kind, seq)) AS size FROM al GROUP BY ALL) f JOIN cur USING (token_key, tick, epoch) WHERE size > 0), {METRICS.format(k='token_key, tick')} {measured('token_key, tick')}""")


@query("d17_closing_snapshot", CLOSING)
def _(spark, d):
    """The books at the time of the last resolving frame of each token."""
    events = book_events(spark, d)
    ends = events.where("event_type = 'error' AND k >= 90").groupBy("token_key").agg(F.max("ts").alias("tick"))
    return metrics(book.book_at_ticks(events, ends), "token_key", "tick")


@query("d18_d19_revisions", bk(f"WITH {EPOCHS} SELECT token_key, count(*) AS revision, arg_max(kind, (ts, kind, seq)) = 0 AS hash_valid FROM e WHERE epoch > 0 GROUP BY token_key"))
def _(spark, d):
    return book.revisions(book_events(spark, d))


@query(
    "d20_reconcile_diff",
    bk(f"""WITH c AS (SELECT token_key, ts AS tick, k, v FROM bk_events WHERE is_recon), {MOVES},
fs AS (SELECT token_key, min(ts) AS first_ts FROM e WHERE kind = 0 GROUP BY token_key),
ck AS (SELECT c.* FROM c JOIN fs USING (token_key) WHERE first_ts <= tick),
cur AS (SELECT ck.token_key, ck.tick, max(e.epoch) AS epoch FROM ck JOIN e ON e.token_key = ck.token_key AND e.ts <= ck.tick GROUP BY ALL),
al AS (SELECT z.*, ck.tick FROM sz z JOIN ck ON z.token_key = ck.token_key AND z.ts <= ck.tick),
o AS (SELECT f.token_key, f.tick, side, price, size FROM (SELECT token_key, tick, epoch, side, price, arg_max(size, (ts, kind, seq)) AS size FROM al GROUP BY ALL) f JOIN cur USING (token_key, tick, epoch) WHERE size > 0),
th AS (SELECT token_key, tick, {SIDE} AS side, {PRICE} AS price, (v - 10 * j)::DECIMAL(38, 6) AS size FROM (SELECT *, unnest(range(3 + k % 4)) AS j FROM ck) WHERE v > 10 * j)
SELECT token_key, tick, side, price::DECIMAL(38, 6)::VARCHAR AS price, o.size::DECIMAL(38, 6)::VARCHAR AS replayed, th.size::DECIMAL(38, 6)::VARCHAR AS reported FROM o FULL JOIN th USING (token_key, tick, side, price) WHERE o.size IS DISTINCT FROM th.size"""),
)
def _(spark, d):
    return book.reconcile(book_events(spark, d), parts_of(spark, d)).select("token_key", "tick", "side", *exact("price", "replayed", "reported"))


LEVELS = """bl AS (SELECT l_orderkey AS book, CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS side, CASE WHEN l_linenumber % 2 = 1 THEN 49 - round(100 * l_discount)::INT ELSE 51 + round(100 * l_discount)::INT END AS price_cents, l_quantity::DECIMAL(18, 2) AS size,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_tax) AS pos FROM lineitem)"""


@query("d1_book_levels", f"WITH {LEVELS} SELECT book, side, price_cents, arg_max(size, pos)::DECIMAL(38, 6)::VARCHAR AS size FROM bl WHERE size > 0 GROUP BY ALL")
def book_levels(spark, d):
    """Distinct levels of books given as lists: of a repeated price the last with a size."""
    li = table(spark, d, "lineitem")
    odd = F.col("l_linenumber") % 2 == 1
    off = F.round(F.col("l_discount") * 100).cast("int")
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax")
    level = F.struct(place.alias("at"), F.when(odd, 1).otherwise(2).alias("side"), F.when(odd, 49 - off).otherwise(51 + off).alias("price"), F.col("l_quantity").cast("decimal(18,2)").alias("size"))
    books = li.groupBy(F.col("l_orderkey").alias("book")).agg(F.array_sort(F.collect_list(level)).alias("levels"))
    levels = books.select("book", F.explode(book.distinct_levels(F.col("levels"))).alias("x"))
    return levels.select("book", "x.side", F.col("x.price").alias("price_cents"), F.col("x.size").cast("decimal(38,6)").cast("string").alias("size"))


@query(
    "j10_as_of_join",
    with_views("bk_events md_trades", "SELECT b.token_key, b.seq, t.price::DECIMAL(38, 6)::VARCHAR AS last_price, t.trade_id AS last_trade FROM bk_events b ASOF LEFT JOIN md_trades t ON b.token_key = t.token AND b.ts >= t.executed_at"),
)
def _(spark, d):
    events = view(spark, d, "bk_events").select("token_key", "ts", "seq")
    trades = view(spark, d, "md_trades").select(F.col("token").alias("token_key"), "executed_at", F.col("price").alias("last_price"), F.col("trade_id").alias("last_trade"))
    return book.last_before(events, trades, ["token_key"], "ts", "executed_at", ["last_price", "last_trade"], ["last_trade"], parts_of(spark, d)).select("token_key", "seq", *exact("last_price"), "last_trade")
