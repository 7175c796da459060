"""Queries over keyed writes and named joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import keyed as k
from .q_book import exact
from .registry import family
from .standins import table, view, with_views

Q, SQL, query = family()


@query("k1_trades_dedup", with_views("md_trades", "SELECT trade_id, market, price::DECIMAL(38, 6)::VARCHAR AS price, 0 AS arrival FROM md_trades"))
def _(spark, d):
    """Repeated trades, spelt otherwise, keep the first arrival."""
    rows = view(spark, d, "md_trades").withColumn("arrival", F.lit(0))
    again = rows.where("trade_id % 7 = 0").withColumn("side", F.upper("side")).withColumn("arrival", F.lit(1))
    c = F.col
    print_ = s.trade_fingerprint(F.lit("pm"), c("market"), c("token"), c("executed_at"), c("price"), c("size"), c("side"), c("trade_id"))
    both = again.unionByName(rows).withColumn("fingerprint", print_)
    return k.keep_first(both, ["fingerprint"], ["arrival"]).select("trade_id", "market", *exact("price"), "arrival")


@query("k2_k3_lifecycle_dedup", with_views("ev mk_markets", "WITH f AS (SELECT event_type AS kind, 'm' || user_id AS market, min(event_id) AS event_id FROM ev WHERE event_type IN ('signup', 'error') GROUP BY ALL) SELECT kind, market, f.event_id, m.o_custkey FROM f LEFT JOIN (SELECT external_id, event_id AS o_custkey FROM mk_markets WHERE active) m ON m.external_id = f.market"))
def _(spark, d):
    """Lifecycle rows of markets and events, first wins; an unknown market is kept with a null id."""
    rows = table(spark, d, "events").where("event_type IN ('signup', 'error')").select(F.col("event_type").alias("kind"), F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("market"), "event_id")
    known = view(spark, d, "mk_markets").where("active").select(F.col("external_id").alias("market"), F.col("event_id").alias("o_custkey"))
    return k.keep_first(rows, ["kind", "market"], ["event_id"]).join(known, "market", "left").select("kind", "market", "event_id", "o_custkey")


@query("k4_comments_upsert", "WITH c AS (SELECT conv_id, turn, role, text, 0 AS edit FROM conversations UNION ALL SELECT conv_id, turn, 'editor', text || ' (edited)', 1 FROM conversations WHERE turn % 3 = 0) SELECT conv_id, turn, arg_min(role, edit) AS role, arg_max(text, edit) AS text FROM c GROUP BY ALL")
def _(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text", F.lit(0).alias("edit"))
    edits = rows.where("turn % 3 = 0").withColumns({"role": F.lit("editor"), "text": F.concat("text", F.lit(" (edited)")), "edit": F.lit(1)})
    return k.upsert(rows.unionByName(edits), ["conv_id", "turn"], ["edit"], ["text"]).select("conv_id", "turn", "role", "text")


@query("k5_candles_upsert", with_views("md_trades", "SELECT market, date_trunc('hour', executed_at) AS start, (arg_max(price, (executed_at, trade_id)))::DECIMAL(38, 6)::VARCHAR AS close FROM md_trades GROUP BY ALL"))
def _(spark, d):
    rows = view(spark, d, "md_trades").withColumn("start", F.date_trunc("hour", "executed_at").cast("timestamp_ntz")).withColumnRenamed("price", "close")
    return k.keep_last(rows, ["market", "start"], ["executed_at", "trade_id"]).select("market", "start", *exact("close"))


@query("k6_holders_dedup", "SELECT o_custkey AS holder, o_orderdate AS observed, min(o_orderkey) AS orderkey FROM orders GROUP BY ALL")
def _(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_custkey").alias("holder"), F.col("o_orderdate").alias("observed"), F.col("o_orderkey").alias("orderkey"))
    return k.keep_first(rows, ["holder", "observed"], ["orderkey"])


@query("k7_k8_reference_dedup", with_views("ref_prices", "WITH r AS (SELECT *, CASE WHEN k % 9 = 0 THEN NULL ELSE provider || instrument || price || date_trunc('day', ts)::DATE END AS update_id FROM ref_prices) SELECT provider, update_id, min(seq) AS seq FROM r WHERE update_id IS NOT NULL GROUP BY ALL UNION ALL SELECT provider, update_id, seq FROM r WHERE update_id IS NULL"))
def _(spark, d):
    rows = view(spark, d, "ref_prices")
    key = F.concat(F.col("provider"), F.col("instrument").cast("string"), F.col("price").cast("string"), F.to_date("ts").cast("string"))
    rows = rows.withColumn("update_id", F.when(F.col("k") % 9 != 0, key))
    return k.keep_first_if_set(rows, ["provider"], "update_id", ["seq"]).select("provider", "update_id", "seq")


@query("k9_get_or_create", with_views("ref_prices", "SELECT DISTINCT provider, instrument FROM ref_prices WHERE NOT (provider = 'click' AND instrument < 5)"))
def _(spark, d):
    rows = view(spark, d, "ref_prices")
    return k.missing_keys(rows, ["provider", "instrument"], rows.where("provider = 'click' AND instrument < 5").select("provider", "instrument").distinct())


@query("k10_observations_dedup", with_views("bk_events", "SELECT token_key, date_trunc('hour', ts) AS observed_at, min(seq) AS seq FROM bk_events GROUP BY ALL"))
def _(spark, d):
    rows = view(spark, d, "bk_events").withColumn("observed_at", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return k.keep_first(rows, ["token_key", "observed_at"], ["seq"]).select("token_key", "observed_at", "seq")


@query("k11_p9_newest_header", with_views("bk_events", "SELECT token_key, max(ts) AS ts, arg_max(seq, (ts, seq)) AS seq, arg_max(kind, (ts, seq)) AS kind FROM bk_events GROUP BY token_key"))
def _(spark, d):
    return k.keep_last(view(spark, d, "bk_events").select("token_key", "ts", "seq", "kind"), ["token_key"], ["ts", "seq"])


@query("k13_a16_keyed_upsert", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'changed' ELSE c_mktsegment END AS segment FROM customer UNION ALL SELECT c_custkey + 1000000, 'new' FROM customer WHERE c_custkey % 10 = 0")
def _(spark, d):
    stored = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    changed = stored.where("c_custkey % 3 = 0").withColumn("segment", F.lit("changed"))
    new = stored.where("c_custkey % 10 = 0").select((F.col("c_custkey") + 1_000_000).alias("c_custkey"), F.lit("new").alias("segment"))
    return k.keep_last(changed.unionByName(new), ["c_custkey"], ["segment"], stored)


@query("k14_j4_resolve_identity", "WITH f AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN user_id::VARCHAR WHEN 1 THEN 'Customer#' || lpad(user_id::VARCHAR, 9, '0') ELSE 'nobody' END AS ref, user_id FROM events) SELECT event_id, CASE WHEN ref <> 'nobody' AND user_id IN (SELECT c_custkey FROM customer) THEN user_id END AS resolved FROM f")
def _(spark, d):
    ref = F.expr("CASE event_id % 3 WHEN 0 THEN CAST(user_id AS STRING) WHEN 1 THEN concat('Customer#', lpad(CAST(user_id AS STRING), 9, '0')) ELSE 'nobody' END")
    facts = table(spark, d, "events").select("event_id", ref.alias("ref"))
    return k.resolve_identity(facts, "ref", table(spark, d, "customer"), "c_custkey", ["c_name"]).select("event_id", "resolved")


BAD = "CASE WHEN l_quantity < 2 THEN 'quantity' WHEN l_discount > 0.09 THEN 'discount' END"


def rules():
    return {"quantity": F.col("l_quantity") >= 2, "discount": F.col("l_discount") <= 0.09}


@query("k15_quarantine", f"SELECT {BAD} AS rule, count(*) AS rejected, min(l_orderkey) AS first_key FROM lineitem WHERE {BAD} IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return k.split_rejects(table(spark, d, "lineitem"), rules())[1].groupBy("rule").agg(F.count(F.lit(1)).alias("rejected"), F.min("l_orderkey").alias("first_key"))


@query("k16_provenance_dedup", "SELECT source, sha256(text) AS content_hash, min(doc_id) AS doc_id FROM documents GROUP BY ALL")
def _(spark, d):
    rows = table(spark, d, "documents").select("source", F.sha2("text", 256).alias("content_hash"), "doc_id")
    return k.keep_first(rows, ["source", "content_hash"], ["doc_id"])


@query("k17_high_watermark", "SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id")
def _(spark, d):
    return k.high_watermark(table(spark, d, "events"), ["user_id"], "ts", "event_id")


@query("k18_finalized_markets", with_views("ev", "SELECT user_id AS market, max(ts) AS finalised_at, arg_max(event_id, (ts, event_id)) AS object FROM ev WHERE event_type = 'error' AND k >= 90 GROUP BY user_id"))
def _(spark, d):
    rows = view(spark, d, "bk_events").where("event_type = 'error' AND k >= 90").select(F.col("token_key").alias("market"), F.col("ts").alias("finalised_at"), F.col("seq").alias("object"))
    return k.keep_last(rows, ["market"], ["finalised_at", "object"])


@query("j1_p7_inner_changes", with_views("mk_markets mk_prev_tiers", "SELECT external_id, tier FROM mk_markets JOIN mk_prev_tiers USING (external_id) WHERE active AND tier IS DISTINCT FROM 'none'"))
def _(spark, d):
    rows = view(spark, d, "mk_markets").where("active").join(view(spark, d, "mk_prev_tiers"), "external_id")
    return rows.where(~F.col("tier").eqNullSafe("none")).select("external_id", "tier")


@query("j2_live_candidates", "SELECT o_orderkey, coalesce(array_to_string(list_sort(list(DISTINCT l_linenumber)), ','), '') AS tokens FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'F' GROUP BY o_orderkey")
def _(spark, d):
    tokens = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_set("l_linenumber")).alias("tokens"))
    rows = table(spark, d, "orders").where("o_orderstatus <> 'F'").join(tokens, "o_orderkey", "left")
    return rows.select("o_orderkey", F.array_join(F.coalesce("tokens", F.array().cast("array<int>")), ",").alias("tokens"))


@query("j5_latest_by_scalar", "SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def _(spark, d):
    rows = table(spark, d, "orders")
    newest = rows.agg(F.max("o_orderdate").alias("newest"))
    return rows.join(F.broadcast(newest), F.col("o_orderdate") == F.col("newest")).select("o_orderkey")


@query("j6_absent_active", with_views("mk_markets", "SELECT external_id FROM mk_markets WHERE active AND external_id NOT IN (SELECT 'm' || l_orderkey FROM lineitem WHERE l_linenumber = 1)"))
def _(spark, d):
    found = table(spark, d, "lineitem").where("l_linenumber = 1").select(F.concat(F.lit("m"), F.col("l_orderkey").cast("string")).alias("external_id")).distinct()
    return view(spark, d, "mk_markets").where("active").join(found, "external_id", "left_anti").select("external_id")


@query("j11_fully_initialised", "SELECT l_orderkey AS market FROM (SELECT l_orderkey, l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A') AS seen FROM lineitem) GROUP BY l_orderkey HAVING bool_and(seen)")
def _(spark, d):
    li = table(spark, d, "lineitem")
    return k.fully_initialised(li.select(F.col("l_orderkey").alias("market"), "l_partkey"), li.where("l_returnflag = 'A'"), "market", "l_partkey")


@query("j13_confirmed_current", "SELECT o_custkey AS market FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT user_id FROM events EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND value > 200")
def _(spark, d):
    ev = table(spark, d, "events")
    wanted = table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("market"))
    return wanted.intersect(ev.select("user_id")).subtract(ev.where("event_type = 'error' AND value > 200").select("user_id"))


HOURS = "h AS (SELECT event_type AS name, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL), c AS (SELECT name, hour, sum(n) OVER (PARTITION BY name ORDER BY hour ROWS UNBOUNDED PRECEDING)::BIGINT AS total FROM h)"


def counters(spark, d):
    from pyspark.sql import Window

    hours = table(spark, d, "events").groupBy(F.col("event_type").alias("name"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return hours.withColumn("total", F.sum("n").over(Window.partitionBy("name").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0))).drop("n")


@query("w5_write_deltas", f"WITH {HOURS}, l AS (SELECT *, total - lag(total) OVER (PARTITION BY name ORDER BY hour) AS delta FROM c) SELECT name, hour, delta FROM l WHERE delta > 0")
def _(spark, d):
    return k.write_deltas(counters(spark, d), "name", "hour", "total").select("name", "hour", "delta")


@query("w6_storage_growth", f"WITH {HOURS} SELECT name, hour, round((total - lag(total) OVER w) * 3600 / greatest(epoch(hour - lag(hour) OVER w), 1), 6) AS per_hour FROM c WINDOW w AS (PARTITION BY name ORDER BY hour)")
def _(spark, d):
    return k.growth_per_hour(counters(spark, d), "name", "hour", "total").select("name", "hour", F.round("per_hour", 6).alias("per_hour"))
