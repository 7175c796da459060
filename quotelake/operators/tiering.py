"""Scoring of markets and their assignment to collection tiers under ceilings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .names import fresh

FULL, SAMPLED, NONE = "full", "sampled", "none"


@dataclass(frozen=True)
class Limits:
    """Thresholds and ceilings; a ceiling of 0 is none."""

    full_max: int = 50
    sampled_max: int = 200
    reserve: int = 5
    full_score: float = 55
    full_keep: float = 45
    sampled_score: float = 20
    sampled_keep: float = 12
    min_liquidity: float = 1000
    min_trades: int = 2
    min_updates: int = 100
    dwell_seconds: int = 1800
    allow: tuple[str, ...] = ()
    block: tuple[str, ...] = ()


def activity(trades: DataFrame, updates: DataFrame, as_of: Column, seconds: int = 900) -> DataFrame:
    """Trades, their volume and book updates of each market in the trailing window; a row at its start counts.

    trades: ``market, ts, size``; updates: ``market, ts``.
    """
    start = F.timestamp_add("SECOND", F.lit(-seconds), as_of)
    inside = (F.col("ts") >= start) & (F.col("ts") <= as_of)
    rows = trades.where(inside).select("market", F.lit(1).alias("t"), "size", F.lit(0).alias("u"))
    more = updates.where(inside).select("market", F.lit(0).alias("t"), F.lit(None).cast(trades.schema["size"].dataType).alias("size"), F.lit(1).alias("u"))
    return rows.unionByName(more).groupBy("market").agg(F.sum("t").alias("trade_count"), F.coalesce(F.sum("size"), F.lit(0)).alias("trade_volume"), F.sum("u").alias("update_count"))


def rolling_activity(trades: DataFrame, seconds: int = 900) -> DataFrame:
    """The same counts at every trade, over the window that ends at it."""
    at = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts"))
    frame = Window.partitionBy("market").orderBy("at").rangeBetween(-seconds * 1_000_000, 0)
    return trades.withColumn("at", at).withColumns({"trade_count": F.count(F.lit(1)).over(frame), "trade_volume": F.sum("size").over(frame)}).drop("at")


def collectable() -> Column:
    c = F.col
    return c("active") & ~c("closed") & ~c("archived") & c("accepting") & c("book") & (c("n_tokens") > 0)


def _listed(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]))


def ineligible_reasons() -> Column:
    c = F.col
    return _listed((~c("active"), "inactive"), (c("closed"), "closed"), (c("archived"), "archived"), (~c("accepting"), "not_accepting_orders"), (~c("book"), "order_book_disabled"), (c("n_tokens") == 0, "no_clob_tokens"))


def in_list(names: Column, listed: tuple[str, ...]) -> Column:
    return F.arrays_overlap(names, F.array(*map(F.lit, listed)).cast("array<string>")) if listed else F.lit(False)


def scored(markets: DataFrame, active: DataFrame, previous: DataFrame, as_of: Column, limits: Limits) -> DataFrame:
    """Adds score, reasons and the flags that the selection needs. markets: the columns of a candidate; active: ``activity()``; previous: ``external_id, tier, tier_since``."""
    rows = markets.join(active.withColumnRenamed("market", "external_id"), "external_id", "left").join(previous.withColumnsRenamed({"tier": "previous"}), "external_id", "left")
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    rows = rows.withColumns({"trade_count": zero("trade_count"), "update_count": zero("update_count"), "names": F.array("external_id", F.concat(F.lit("pm:"), "external_id"))})
    liquidity, volume, trades, updates = (zero(x).cast("double") for x in ("liquidity", "volume_24h", "trade_count", "update_count"))
    # The score is added up in whole millionths, which is exact and needs no decimals wider than 64 bits.
    part = lambda x: F.round(F.round(x, 6) * 1_000_000).cast("bigint")
    millionths = lambda x: F.lit(round(x * 1_000_000)).cast("bigint")
    (points,) = fresh(rows, "points")
    wide = zero("spread").between(0.02, 0.25)
    seconds = F.timestamp_diff("SECOND", as_of, F.col("close_time"))
    near = (F.col("close_time") > as_of) & (seconds <= 30 * 86400)
    forced, blocked = in_list(F.col("names"), limits.allow), in_list(F.col("names"), limits.block)
    score = part(F.log10(1 + liquidity) * 10) + part(F.log10(1 + volume) * 8) + part(F.least(trades * 4, F.lit(40.0))) + part(F.least(F.log1p(updates) * 6, F.lit(30.0)))
    for cond, n in ((F.col("rewards"), 30), (wide, 20), (near, 10), (forced, 10_000)):
        score = score + F.when(cond, millionths(n)).otherwise(millionths(0))
    reasons = _listed((forced, "forced_allowlist"), (liquidity > 0, "liquidity"), (volume > 0, "recent_volume"), (trades > 0, "recent_trades"), (updates > 0, "recent_book_activity"), (F.col("rewards"), "maker_rewards"), (wide, "wide_actionable_spread"), (near, "near_resolution"))
    rows = rows.withColumns({points: score, "reasons": reasons, "eligible": collectable() & ~blocked})
    dwell = F.coalesce(F.timestamp_diff("SECOND", F.col("tier_since"), as_of), F.lit(0)) < limits.dwell_seconds
    seen = (liquidity >= limits.min_liquidity) | (volume > 0) | F.col("rewards") | (trades >= limits.min_trades) | (updates >= limits.min_updates)
    kept_full = F.coalesce(F.col("previous") == FULL, F.lit(False)) & (dwell | (F.col(points) >= millionths(limits.full_keep)))
    kept_sampled = F.coalesce(F.col("previous") == SAMPLED, F.lit(False)) & (dwell | (F.col(points) >= millionths(limits.sampled_keep)))
    rows = rows.withColumn("qualifies", forced | kept_full | ((F.col(points) >= millionths(limits.full_score)) & seen))
    rows = rows.withColumns({"interesting": F.coalesce(F.col("rewards") | wide | near, F.lit(False)), "sampleable": F.col("qualifies") | kept_sampled | (F.col(points) >= millionths(limits.sampled_score)), "blocked": blocked})
    refused = F.concat(ineligible_reasons(), F.when(blocked, F.array(F.lit("forced_blocklist"))).otherwise(F.array().cast("array<string>")))
    refused = F.when(F.size(refused) == 0, F.array(F.lit("not_trade_ready"))).otherwise(refused)
    return rows.withColumns({"reasons": F.when(F.col("eligible"), F.col("reasons")).otherwise(refused), "score": (F.when(F.col("eligible"), F.col(points)).otherwise(0).cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")}).drop(points)


SALTS = 16


def _tops(able: DataFrame, most: dict[str, int]) -> DataFrame:
    """The best rows of each kind (a flag), at least as many as ``most`` says: bounded by it, whatever the input.

    Ranks are numbered inside a few parts by salt, of which only the first ones
    leave a task.
    """
    kinds = F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in most])) if most else F.array().cast("array<string>")
    part = Window.partitionBy("kind", F.pmod(F.xxhash64("external_id"), F.lit(SALTS))).orderBy(F.desc("score"), "external_id")
    rows = able.withColumn("kind", F.explode(kinds)).withColumn("place", F.row_number().over(part)).where(F.col("place") <= max(most.values(), default=0))
    return rows.select(*able.columns).distinct()


def _selection(rows: DataFrame, limits: Limits) -> tuple[DataFrame, DataFrame]:
    """``(chosen, counts)``: ``external_id, place`` of what a ceiling bounds, and the one-row counts of what competes."""
    left = F.col("sampleable") if limits.full_max else F.col("sampleable") & ~F.col("qualifies")
    able = rows.where("eligible").select("external_id", "score", "qualifies", "interesting", left.alias("left"), left.alias("competes"))
    reserve = min(limits.reserve, limits.full_max)
    most = {"interesting": reserve, "qualifies": limits.full_max + reserve if limits.full_max else 0, "left": limits.sampled_max + limits.full_max if limits.sampled_max else 0}
    some = _tops(able, {k: n for k, n in most.items() if n})
    best = lambda flag: F.row_number().over(Window.orderBy(F.desc(flag), F.desc("score"), "external_id"))
    some = some.withColumn("research", F.col("interesting") & (best("interesting") <= reserve))
    some = some.withColumn("rest", F.col("qualifies") & ~F.col("research"))
    some = some.withColumn("full", F.col("research") | (F.col("rest") & (best("rest") + F.count_if("research").over(Window.partitionBy()) <= limits.full_max)))
    some = some.withColumn("left", F.col("left") & ~F.col("full"))
    some = some.withColumn("sampled", F.col("left") & (best("left") <= limits.sampled_max))
    place = F.when(F.col("research"), "research").when(F.col("full"), "full").when(F.col("sampled"), "sampled")
    chosen = some.withColumn("place", place).where(F.col("place").isNotNull())
    counts = able.agg(F.count_if("qualifies").alias("wanted"), F.count_if("left").alias("remaining"))
    return chosen, counts


def _binding(chosen: DataFrame, counts: DataFrame, limits: Limits) -> DataFrame:
    """Whether each ceiling binds: more compete than it lets in."""
    more = chosen.agg(F.count_if(F.col("research") & ~F.col("qualifies")).alias("added"), F.count_if(F.col("full") & F.col("competes")).alias("gone"))
    wanted, remaining = F.col("wanted") + F.col("added"), F.col("remaining") - F.col("gone")
    return counts.crossJoin(F.broadcast(more)).select((F.lit(limits.full_max > 0) & (wanted > limits.full_max)).alias("full_binds"), (F.lit(limits.sampled_max > 0) & (remaining > limits.sampled_max)).alias("sampled_binds"))


def select_tiers(rows: DataFrame, limits: Limits) -> dict[str, DataFrame]:
    """``research``, ``full`` and ``sampled`` ids, the one-row ``binding``, and ``chosen``: what the ceilings bound, as ``external_id, place``."""
    chosen, counts = _selection(rows, limits)
    binding = _binding(chosen, counts, limits)
    chosen = chosen.select("external_id", "place")
    able = rows.where("eligible")
    ids = lambda *places: chosen.where(F.col("place").isin(*places)).select("external_id")
    full = ids("research", "full") if limits.full_max else able.where("qualifies").select("external_id")
    sampled = ids("sampled") if limits.sampled_max else able.where("sampleable").select("external_id").join(full, "external_id", "left_anti")
    return {"chosen": chosen, "research": ids("research"), "full": full, "sampled": sampled, "binding": binding}


def assign_tiers(rows: DataFrame, limits: Limits) -> DataFrame:
    """``external_id, tier, score, reasons, ceiling_binding`` of every scored market."""
    picked = select_tiers(rows, limits)
    out = rows.join(F.broadcast(picked["chosen"]), "external_id", "left").crossJoin(F.broadcast(picked["binding"]))
    out = out.withColumn("is_full", F.col("place").isin("research", "full") if limits.full_max else F.col("eligible") & F.col("qualifies"))
    out = out.withColumn("is_sampled", F.col("place") == "sampled" if limits.sampled_max else F.col("eligible") & F.col("sampleable") & ~F.coalesce("is_full", F.lit(False)))
    full, sampled = F.coalesce("is_full", F.lit(False)), F.coalesce("is_sampled", F.lit(False))
    tier = F.when(full, FULL).when(sampled, SAMPLED).otherwise(NONE)
    more = lambda name: F.concat("reasons", F.array(F.lit(name)))
    named = lambda name: F.when(F.size("reasons") == 0, F.array(F.lit(name))).otherwise(F.col("reasons"))
    capped = F.col("full_binds") & F.col("qualifies")
    reasons = (
        F.when(~F.col("eligible"), F.col("reasons"))
        .when(full, F.concat(named("full_l2_score"), F.when(F.col("interesting") & F.lit(limits.reserve > 0), F.array(F.lit("research_bucket"))).otherwise(F.array().cast("array<string>"))))
        .when(sampled, F.concat(named("trade_ready_long_tail"), F.when(capped, F.array(F.lit("full_l2_resource_ceiling"))).otherwise(F.array().cast("array<string>"))))
        .when(F.col("sampleable"), more("sampled_resource_ceiling"))
        .otherwise(more("below_sampled_promotion_threshold"))
    )
    binds = F.when(full | ~F.col("eligible"), False).when(sampled, capped).otherwise(F.col("sampleable") & F.col("sampled_binds"))
    return out.select("external_id", tier.alias("tier"), "score", reasons.alias("reasons"), binds.alias("ceiling_binding"))


def tier_history(assigned: DataFrame, stored: DataFrame, as_of: Column) -> DataFrame:
    """Rows to append: only where the stored tier is distinct from the new one."""
    rows = assigned.join(stored.select("external_id", F.col("tier").alias("stored")), "external_id", "left")
    return rows.where(~F.col("tier").eqNullSafe(F.col("stored"))).select("external_id", F.col("stored").alias("old_tier"), F.col("tier").alias("new_tier"), as_of.alias("changed_at"))


def tier_current(assigned: DataFrame, stored: DataFrame, as_of: Column) -> DataFrame:
    """The current table after an evaluation: promoted_at when a market enters the full tier, demoted_at when it leaves it."""
    old = stored.select("external_id", F.col("tier").alias("stored"), F.col("tier_since").alias("since"))
    rows = assigned.select("external_id", "tier").join(old, "external_id", "full_outer")
    was, now = F.col("stored").eqNullSafe(FULL), F.col("tier").eqNullSafe(FULL)
    promoted = F.when(now & ~was, as_of).when(was, F.col("since"))
    demoted = F.when(was & ~now & F.col("tier").isNotNull(), as_of)
    return rows.select("external_id", F.coalesce("tier", "stored").alias("tier"), promoted.alias("promoted_at"), demoted.alias("demoted_at"), F.coalesce("since", as_of).alias("first_assigned_at"))


def tier_state(current: DataFrame) -> DataFrame:
    """``external_id, tier, tier_since``: the later of promotion and demotion, else the first assignment."""
    return current.select("external_id", "tier", F.coalesce(F.greatest("promoted_at", "demoted_at"), "first_assigned_at").alias("tier_since"))
