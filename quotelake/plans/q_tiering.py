"""Queries over the tiering operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tiering as t
from .q_book import exact, real
from .registry import family
from .standins import view, with_views

Q, SQL, query = family()


AT = "2024-01-15 12:00:00"
CLOSE = "1998-01-15 00:00:00"
LIMITS = t.Limits(allow=("m7",), block=("m8", "pm:m16"))


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def moves(spark, d):
    trades = view(spark, d, "md_trades").select("market", F.col("executed_at").alias("ts"), "size")
    updates = view(spark, d, "bk_events").where("kind = 1").select(F.concat(F.lit("m"), (F.col("token_key") % 50).cast("string")).alias("market"), "ts")
    return trades, updates


def scored(spark, d):
    active = t.activity(*moves(spark, d), ntz(AT), 6 * 3600)
    return t.scored(view(spark, d, "mk_markets"), active, view(spark, d, "mk_prev_tiers"), ntz(CLOSE), LIMITS)


ACT = f"""act AS (SELECT market, sum(t) AS trade_count, coalesce(sum(size), 0) AS trade_volume, sum(u) AS update_count FROM (
  SELECT market, 1 AS t, size, 0 AS u FROM md_trades WHERE executed_at BETWEEN TIMESTAMP '{AT}' - INTERVAL 6 HOUR AND TIMESTAMP '{AT}'
  UNION ALL SELECT 'm' || (token_key % 50), 0, NULL, 1 FROM bk_events WHERE kind = 1 AND ts BETWEEN TIMESTAMP '{AT}' - INTERVAL 6 HOUR AND TIMESTAMP '{AT}') GROUP BY market)"""
SCORED = f"""{ACT},
b AS (SELECT m.*, coalesce(trade_count, 0) AS tc, coalesce(update_count, 0) AS uc, p.tier AS previous, p.tier_since, external_id IN ('m7', 'pm:m7') AS forced, external_id IN ('m8', 'm16') AS blocked,
  spread BETWEEN 0.02 AND 0.25 AS wide, close_time > TIMESTAMP '{CLOSE}' AND close_time <= TIMESTAMP '{CLOSE}' + INTERVAL 30 DAY AS near,
  active AND NOT closed AND NOT archived AND accepting AND book AND n_tokens > 0 AS ok
  FROM mk_markets m LEFT JOIN act a ON a.market = m.external_id LEFT JOIN mk_prev_tiers p USING (external_id)),
s1 AS (SELECT *, ok AND NOT blocked AS eligible, round(log10(1 + liquidity::DOUBLE) * 10, 6)::DECIMAL(18, 6) + round(log10(1 + volume_24h::DOUBLE) * 8, 6)::DECIMAL(18, 6) + least(tc * 4, 40)::DECIMAL(18, 6)
  + round(least(ln(1 + uc::DOUBLE) * 6, 30), 6)::DECIMAL(18, 6) + CASE WHEN rewards THEN 30 ELSE 0 END + CASE WHEN wide THEN 20 ELSE 0 END + CASE WHEN near THEN 10 ELSE 0 END + CASE WHEN forced THEN 10000 ELSE 0 END AS raw,
  concat_ws(',', CASE WHEN forced THEN 'forced_allowlist' END, CASE WHEN liquidity > 0 THEN 'liquidity' END, CASE WHEN volume_24h > 0 THEN 'recent_volume' END, CASE WHEN tc > 0 THEN 'recent_trades' END, CASE WHEN uc > 0 THEN 'recent_book_activity' END,
    CASE WHEN rewards THEN 'maker_rewards' END, CASE WHEN wide THEN 'wide_actionable_spread' END, CASE WHEN near THEN 'near_resolution' END) AS good,
  concat_ws(',', CASE WHEN NOT active THEN 'inactive' END, CASE WHEN closed THEN 'closed' END, CASE WHEN archived THEN 'archived' END, CASE WHEN NOT accepting THEN 'not_accepting_orders' END, CASE WHEN NOT book THEN 'order_book_disabled' END,
    CASE WHEN n_tokens = 0 THEN 'no_clob_tokens' END, CASE WHEN blocked THEN 'forced_blocklist' END) AS poor FROM b),
s2 AS (SELECT *, CASE WHEN eligible THEN raw ELSE 0 END AS score, CASE WHEN eligible THEN good WHEN poor = '' THEN 'not_trade_ready' ELSE poor END AS reasons,
  coalesce(epoch(TIMESTAMP '{CLOSE}' - tier_since), 0) < 1800 AS dwell FROM s1),
s3 AS (SELECT *, forced OR (coalesce(previous = 'full', false) AND (dwell OR score >= 45)) OR (score >= 55 AND (liquidity >= 1000 OR volume_24h > 0 OR rewards OR tc >= 2 OR uc >= 100)) AS qualifies, rewards OR wide OR near AS interesting FROM s2),
sc AS (SELECT *, qualifies OR (coalesce(previous = 'sampled', false) AND (dwell OR score >= 12)) OR score >= 20 AS sampleable FROM s3)"""
CHOSEN = f"""{SCORED},
research AS (SELECT external_id FROM sc WHERE eligible AND interesting ORDER BY score DESC, external_id LIMIT 5),
general AS (SELECT external_id FROM sc WHERE eligible AND qualifies AND external_id NOT IN (FROM research) ORDER BY score DESC, external_id LIMIT (SELECT 50 - count(*) FROM research)),
fulls AS (FROM research UNION ALL FROM general),
remaining AS (SELECT external_id, score FROM sc WHERE eligible AND sampleable AND external_id NOT IN (FROM fulls)),
sampleds AS (SELECT external_id FROM remaining ORDER BY score DESC, external_id LIMIT 200),
binding AS (SELECT (SELECT count(*) FROM (SELECT external_id FROM sc WHERE eligible AND qualifies UNION FROM research)) > 50 AS full_binds, (SELECT count(*) FROM remaining) > 200 AS sampled_binds),
asg AS (SELECT external_id, score, eligible, CASE WHEN external_id IN (FROM fulls) THEN 'full' WHEN external_id IN (FROM sampleds) THEN 'sampled' ELSE 'none' END AS tier,
  CASE WHEN NOT eligible THEN reasons WHEN external_id IN (FROM fulls) THEN CASE WHEN reasons = '' THEN 'full_l2_score' ELSE reasons END || CASE WHEN interesting THEN ',research_bucket' ELSE '' END
    WHEN external_id IN (FROM sampleds) THEN CASE WHEN reasons = '' THEN 'trade_ready_long_tail' ELSE reasons END || CASE WHEN full_binds AND qualifies THEN ',full_l2_resource_ceiling' ELSE '' END
    ELSE concat_ws(',', CASE WHEN reasons <> '' THEN reasons END, CASE WHEN sampleable THEN 'sampled_resource_ceiling' ELSE 'below_sampled_promotion_threshold' END) END AS reasons,
  CASE WHEN NOT eligible OR external_id IN (FROM fulls) THEN false WHEN external_id IN (FROM sampleds) THEN full_binds AND qualifies ELSE sampleable AND sampled_binds END AS ceiling_binding FROM sc, binding)"""


def mk(sql: str) -> str:
    return with_views("bk_events md_trades mk_markets mk_prev_tiers", sql)


@query("t1_activity_window", mk(f"WITH {ACT} SELECT market, trade_count::BIGINT AS trade_count, trade_volume::DECIMAL(38, 6)::VARCHAR AS trade_volume, update_count::BIGINT AS update_count FROM act"))
def _(spark, d):
    return t.activity(*moves(spark, d), ntz(AT), 6 * 3600).select("market", "trade_count", *exact("trade_volume"), "update_count")


@query("w8_rolling_activity", mk("SELECT trade_id, count(*) OVER w AS trade_count, round(sum(size) OVER w::DOUBLE, 6) AS trade_volume FROM md_trades WINDOW w AS (PARTITION BY market ORDER BY executed_at RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)"))
def _(spark, d):
    trades = view(spark, d, "md_trades").withColumnRenamed("executed_at", "ts")
    return t.rolling_activity(trades, 6 * 3600).select("trade_id", "trade_count", *real("trade_volume"))


@query("p1_collectable", mk("SELECT external_id FROM mk_markets WHERE active AND NOT closed AND NOT archived AND accepting AND book AND n_tokens > 0"))
def _(spark, d):
    return view(spark, d, "mk_markets").where(t.collectable()).select("external_id")


@query("p2_p3_ineligible_reasons", mk(f"WITH {SCORED} SELECT external_id, reasons FROM sc WHERE NOT eligible"))
def _(spark, d):
    return scored(spark, d).where("NOT eligible").select("external_id", F.array_join("reasons", ",").alias("reasons"))


@query("t2_t3_tier_score", mk(f"WITH {SCORED} SELECT external_id, score::DECIMAL(38, 6)::VARCHAR AS score, reasons FROM sc WHERE eligible"))
def _(spark, d):
    return scored(spark, d).where("eligible").select("external_id", *exact("score"), F.array_join("reasons", ",").alias("reasons"))


@query("t4_hysteresis", mk(f"WITH {SCORED} SELECT external_id, qualifies, interesting, sampleable FROM sc WHERE eligible"))
def _(spark, d):
    return scored(spark, d).where("eligible").select("external_id", "qualifies", "interesting", "sampleable")


@query("t5_research_reserve", mk(f"WITH {CHOSEN} SELECT external_id FROM research"))
def _(spark, d):
    return t.select_tiers(scored(spark, d), LIMITS)["research"]


@query("t6_full_topk", mk(f"WITH {CHOSEN} SELECT external_id FROM fulls"))
def _(spark, d):
    return t.select_tiers(scored(spark, d), LIMITS)["full"]


@query("t7_sampled_topk", mk(f"WITH {CHOSEN} SELECT external_id FROM sampleds"))
def _(spark, d):
    return t.select_tiers(scored(spark, d), LIMITS)["sampled"]


@query("t8_ceiling_binding", mk(f"WITH {CHOSEN} SELECT full_binds, sampled_binds FROM binding"))
def _(spark, d):
    return t.select_tiers(scored(spark, d), LIMITS)["binding"]


@query("t9_assign_tiers", mk(f"WITH {CHOSEN} SELECT external_id, tier, score::DECIMAL(38, 6)::VARCHAR AS score, reasons, ceiling_binding FROM asg"))
def _(spark, d):
    return t.assign_tiers(scored(spark, d), LIMITS).select("external_id", "tier", *exact("score"), F.array_join("reasons", ",").alias("reasons"), "ceiling_binding")


@query("t10_tier_counts", mk(f"WITH {CHOSEN} SELECT tier, CASE WHEN tier = 'none' THEN string_split(reasons, ',')[-1] END AS reason, count(*) AS markets, count(*) FILTER (ceiling_binding) AS bound FROM asg GROUP BY ALL"))
def _(spark, d):
    last = F.when(F.col("tier") == t.NONE, F.try_element_at("reasons", F.lit(-1)))
    return t.assign_tiers(scored(spark, d), LIMITS).groupBy("tier", last.alias("reason")).agg(F.count(F.lit(1)).alias("markets"), F.count_if("ceiling_binding").alias("bound"))


@query("t11_tier_history", mk(f"WITH {CHOSEN} SELECT external_id, p.tier AS old_tier, a.tier AS new_tier, TIMESTAMP '{CLOSE}' AS changed_at FROM asg a LEFT JOIN mk_prev_tiers p USING (external_id) WHERE a.tier IS DISTINCT FROM p.tier"))
def _(spark, d):
    return t.tier_history(t.assign_tiers(scored(spark, d), LIMITS), view(spark, d, "mk_prev_tiers"), ntz(CLOSE))


CURRENT = f"""{CHOSEN}, cr AS (SELECT external_id, a.tier, CASE WHEN a.tier = 'full' AND p.tier <> 'full' THEN TIMESTAMP '{CLOSE}' WHEN p.tier = 'full' THEN tier_since END AS promoted_at,
  CASE WHEN p.tier = 'full' AND a.tier <> 'full' THEN TIMESTAMP '{CLOSE}' END AS demoted_at, tier_since AS first_assigned_at FROM asg a JOIN mk_prev_tiers p USING (external_id))"""


@query("t12_tier_current", mk(f"WITH {CURRENT} FROM cr"))
def current(spark, d):
    return t.tier_current(t.assign_tiers(scored(spark, d), LIMITS), view(spark, d, "mk_prev_tiers"), ntz(CLOSE))


@query("t13_tier_state", mk(f"WITH {CURRENT} SELECT external_id, tier, coalesce(greatest(promoted_at, demoted_at), first_assigned_at) AS tier_since FROM cr"))
def _(spark, d):
    return t.tier_state(current(spark, d))


@query("t14_selection_decisions", mk(f"WITH {CHOSEN} SELECT external_id, tier, row_number() OVER (PARTITION BY tier ORDER BY score DESC, external_id) AS place FROM asg WHERE tier <> 'none'"))
def _(spark, d):
    """The places of the selected markets, of which the ceilings bound the number."""
    from pyspark.sql import Window

    order = Window.partitionBy("tier").orderBy(F.desc_nulls_last("score"), "external_id")
    return t.assign_tiers(scored(spark, d), LIMITS).where(F.col("tier") != t.NONE).select("external_id", "tier", F.row_number().over(order).cast("long").alias("place"))


@query("t15_latest_cohort", with_views("mk_prev_tiers", "SELECT tier, count(*) AS markets FROM mk_prev_tiers WHERE tier_since = (SELECT max(tier_since) FROM mk_prev_tiers) GROUP BY tier"))
def _(spark, d):
    rows = view(spark, d, "mk_prev_tiers")
    newest = rows.agg(F.max("tier_since").alias("newest"))
    return rows.crossJoin(F.broadcast(newest)).where(F.col("tier_since") == F.col("newest")).groupBy("tier").agg(F.count(F.lit(1)).alias("markets"))


@query("t16_tier_of", with_views("md_trades mk_prev_tiers", "SELECT trade_id, coalesce(tier, 'none') AS tier FROM md_trades LEFT JOIN mk_prev_tiers ON external_id = market"))
def _(spark, d):
    tiers = view(spark, d, "mk_prev_tiers").select(F.col("external_id").alias("market"), "tier")
    return view(spark, d, "md_trades").join(tiers, "market", "left").select("trade_id", F.coalesce("tier", F.lit(t.NONE)).alias("tier"))


@query(
    "t17_subscription_diff",
    with_views("mk_markets", "WITH a AS (SELECT external_id, tokens FROM mk_markets WHERE o_orderkey % 5 <> 0), b AS (SELECT external_id, CASE WHEN o_orderkey % 7 = 0 THEN tokens || ',9' ELSE tokens END AS tokens FROM mk_markets WHERE o_orderkey % 5 <> 1) SELECT external_id, a.tokens AS old_tokens, b.tokens AS new_tokens FROM a FULL JOIN b USING (external_id) WHERE a.external_id IS NULL OR b.external_id IS NULL OR a.tokens IS DISTINCT FROM b.tokens".replace("a.external_id IS NULL OR b.external_id IS NULL OR", "(a.external_id IS NULL) OR (b.external_id IS NULL) OR")),
)
def _(spark, d):
    """Markets whose set of tokens changed, appeared or went between two universes."""
    rows = view(spark, d, "mk_markets")
    a = rows.where("o_orderkey % 5 <> 0").select("external_id", F.col("tokens").alias("old_tokens"), F.lit(1).alias("a"))
    b = rows.where("o_orderkey % 5 <> 1").select("external_id", F.when(F.col("o_orderkey") % 7 == 0, F.concat("tokens", F.lit(",9"))).otherwise(F.col("tokens")).alias("new_tokens"), F.lit(1).alias("b"))
    both = a.join(b, "external_id", "full_outer").where(F.col("a").isNull() | F.col("b").isNull() | ~F.col("old_tokens").eqNullSafe(F.col("new_tokens")))
    return both.select("external_id", "old_tokens", "new_tokens")


@query("g12_universe_counts", with_views("mk_markets", "SELECT count(DISTINCT event_id) AS events, count(*) AS markets, count(*) FILTER (active AND NOT closed AND NOT archived AND accepting AND book AND n_tokens > 0) AS trade_ready FROM mk_markets"))
def _(spark, d):
    return view(spark, d, "mk_markets").agg(F.countDistinct("event_id").alias("events"), F.count(F.lit(1)).alias("markets"), F.count_if(t.collectable()).alias("trade_ready"))
