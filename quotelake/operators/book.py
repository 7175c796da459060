"""Order-book reconstruction and measures, for all tokens at once.

A book event has ``token_key, ts, seq, kind, is_recon``; a snapshot (kind 0)
has ``levels``, an array of (side, price, size), a change (kind 1) has ``side,
price, action, x``. Actions: 2 deletes, 4 adds ``x``, any other sets. Sides: 1
buy, 2 sell. Events apply in the order ``(ts, kind, seq)``; the last makes the
order total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import Running, join_null_safe, running, with_parts

BUY, SELL = 1, 2
DELETE, DELTA = 2, 4
SIZE = "decimal(38,6)"


def distinct_levels(levels: Column) -> Column:
    """Levels of one snapshot: those with a size, of a repeated (side, price) the last. One sort of the array."""
    usable = F.filter(levels, lambda x: (x["size"] > 0) & x["price"].isNotNull() & x["side"].isin(BUY, SELL))
    placed = F.array_sort(F.transform(usable, lambda x, i: F.struct(x["side"].alias("side"), x["price"].alias("price"), i.alias("i"), x["size"].alias("size"))))
    repeated = lambda s, x, i: F.coalesce((F.get(s, i + 1)["side"] == x["side"]) & (F.get(s, i + 1)["price"] == x["price"]), F.lit(False))
    # The sorted array is bound to a variable, or it would be sorted again for each level.
    last = F.get(F.transform(F.array(placed), lambda s: F.filter(s, lambda x, i: ~repeated(s, x, i))), F.lit(0))
    return F.transform(last, lambda x: F.struct(x["side"].alias("side"), x["price"].alias("price"), x["size"].alias("size")))


ORDER = ["ts", "kind", "seq"]


def with_epochs(events: DataFrame, parts: int = 1) -> DataFrame:
    """Adds ``epoch``: how many snapshots of the token came so far, and ``part``, by which the rows of a busy token are spread. Reconciliation snapshots are left out."""
    rows = with_parts(events.where(~F.col("is_recon")), ["token_key"], "ts", "part", parts)
    return running(rows, ["token_key"], ORDER, "part", {"epoch": Running("sum", (F.col("kind") == 0).cast("long"))}, parts)


def book_moves(events: DataFrame, parts: int = 1) -> DataFrame:
    """One row a touched level: ``token_key, part, epoch, ts, kind, seq, side, price, is_set, x``; events may have their epochs already."""
    rows = events if "epoch" in events.columns else with_epochs(events, parts)
    level = F.struct("side", "price", F.col("x").alias("size"))
    each = F.when(F.col("kind") == 0, distinct_levels(F.col("levels"))).otherwise(F.array(level))
    rows = rows.withColumn("level", F.explode(each))
    is_set = (F.col("kind") == 0) | (F.col("action") != DELTA)
    x = F.when((F.col("kind") == 1) & (F.col("action") == DELETE), 0).otherwise(F.col("level.size"))
    return rows.select("token_key", "part", "epoch", "ts", "kind", "seq", "level.side", "level.price", is_set.alias("is_set"), x.cast(SIZE).alias("x"))


def level_sizes(moves: DataFrame, parts: int = 1) -> DataFrame:
    """The size of its level after each move.

    A set begins a segment at ``max(x, 0)``; additions inside it are a running
    sum that is lifted whenever it falls below zero: ``S - min(0, min S)``. With
    several parts (see ``prefix``), moves of one that come before its first set go on from the size ``c`` that the
    part before ended with: ``S + max(c, -min S)``. What a part without a set does to
    that size has the same form, so a window over the parts gives each its ``c``.
    """
    key = ["token_key", "epoch", "side", "price"]
    up_to = lambda *by: Window.partitionBy(*by).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero, inside = F.lit(0).cast(SIZE), [*key, "part"] if parts > 1 else key
    rows = moves.where("epoch > 0").withColumn("segment", F.sum(F.col("is_set").cast("long")).over(up_to(*inside)))
    start = F.when(F.col("is_set"), F.greatest("x", zero)).otherwise(F.col("x"))
    rows = rows.withColumn("s", F.sum(start).over(up_to(*inside, "segment")).cast(SIZE))
    rows = rows.withColumn("low", F.least(zero, F.min("s").over(up_to(*inside, "segment"))))
    if parts <= 1:
        return rows.withColumn("size", (F.col("s") - F.col("low")).cast(SIZE)).drop("s", "segment", "low")
    # Of each part: whether it has a set, what it adds and the least sum in it, or what it ends with.
    ends = rows.groupBy(*key, "part").agg(F.max_by(F.struct("segment", "s", "low"), F.struct(*ORDER)).alias("end"))
    ends = ends.withColumn("has_set", F.col("end.segment") > 0).withColumn("ended", (F.col("end.s") - F.col("end.low")).cast(SIZE))
    over = Window.partitionBy(*key).orderBy("part")
    so_far = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("run", F.sum(F.col("has_set").cast("long")).over(so_far))
    in_run = Window.partitionBy(*key, "run").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The first part of a run has a set (or is the first of all, from an empty level) and ends with ``ended``; the others add.
    added = F.when(F.col("has_set"), F.col("ended")).otherwise(F.col("end.s"))
    ends = ends.withColumn("total", F.sum(added).over(in_run).cast(SIZE))
    lift = F.when(~F.col("has_set"), -F.col("end.low") - (F.col("total") - F.col("end.s")))
    ends = ends.withColumn("lifted", F.greatest(zero, F.max(lift).over(in_run)))
    ends = ends.withColumn("c", (F.col("total") + F.col("lifted")).cast(SIZE))
    carried = ends.select(*key, "part", F.coalesce(F.lag("c").over(over), zero).alias("c"))
    rows = join_null_safe(rows, carried, [*key, "part"], "inner")
    size = F.when(F.col("segment") > 0, F.col("s") - F.col("low")).otherwise(F.col("s") + F.greatest(F.col("c"), -F.col("low")))
    return rows.withColumn("size", size.cast(SIZE)).drop("s", "segment", "low", "c")


def replay_book(events: DataFrame, as_of: Column | None = None, parts: int = 1) -> DataFrame:
    """The book of every token after all events (up to ``as_of``): ``token_key, epoch, side, price, size, last_ts``."""
    if as_of is not None:
        events = events.where(F.col("ts") <= as_of)
    # Only what came since a token's last snapshot makes its book.
    rows = with_epochs(events, parts)
    if parts > 1:
        rows = join_null_safe(rows, rows.groupBy("token_key").agg(F.max("epoch").alias("epoch")), ["token_key", "epoch"], "left_semi")
    else:
        rows = rows.withColumn("newest", F.max("epoch").over(Window.partitionBy("token_key"))).where("epoch = newest").drop("newest")
    order = F.struct("ts", "kind", "seq")
    last = level_sizes(book_moves(rows), parts).groupBy("token_key", "epoch", "side", "price").agg(F.max_by("size", order).alias("size"), F.max("ts").alias("last_ts"))
    return last.where("size > 0")


def replay_violations(events: DataFrame) -> DataFrame:
    """Changes that can't be applied: before any snapshot, or without price, size or a known side."""
    rows = with_epochs(events).where("kind = 1")
    rule = F.when(F.col("epoch") == 0, "delta_before_snapshot").when(F.col("price").isNull() | F.col("x").isNull(), "missing_value").when(~F.coalesce(F.col("side").isin(BUY, SELL), F.lit(False)), "unknown_side")
    return rows.withColumn("rule", rule).where(F.col("rule").isNotNull()).select("token_key", "ts", "seq", "rule")


def book_at_ticks(events: DataFrame, ticks: DataFrame, parts: int = 1) -> DataFrame:
    """The book at many times: ``token_key, tick, side, price, size``.

    Each tick asks every place (side and price) that its epoch has used so far for
    the last size there: as-of joins on sorted unions, so moves are never paired with
    ticks, and a tick never with places of other epochs. ticks: ``token_key, tick``.
    """
    rows = with_epochs(events, parts)
    moves = level_sizes(book_moves(rows), parts)
    asked = last_before(ticks.select("token_key", "tick").distinct(), rows, ["token_key"], "tick", "ts", ["epoch"], ["kind", "seq"], parts).where("epoch > 0")
    places = moves.groupBy("token_key", "epoch", "side", "price").agg(F.min("ts").alias("since"))
    asked = join_null_safe(asked, places, ["token_key", "epoch"], "inner").where(F.col("since") <= F.col("tick")).drop("since")
    found = last_before(asked, moves, ["token_key", "epoch", "side", "price"], "tick", "ts", ["size"], ["kind", "seq"], parts)
    return found.where("size > 0").select("token_key", "tick", "side", "price", "size")


def book_metrics(levels: DataFrame, *keys: str) -> DataFrame:
    """Quotes, depths and imbalance of each book; one shuffle by ``keys`` serves the window and the aggregate."""
    keys = keys or ("token_key",)
    buy, sell = F.col("side") == BUY, F.col("side") == SELL
    book = Window.partitionBy(*keys)
    rows = levels.withColumn("best_bid", F.max(F.when(buy, F.col("price"))).over(book)).withColumn("best_ask", F.min(F.when(sell, F.col("price"))).over(book))
    mid = ((F.col("best_bid") + F.col("best_ask")) / 2).cast("decimal(38,18)")
    rows = rows.withColumn("midpoint", mid)
    near_bid = buy & (F.col("price") >= F.lit("0.99").cast("decimal(4,2)") * F.col("midpoint"))
    near_ask = sell & (F.col("price") <= F.lit("1.01").cast("decimal(4,2)") * F.col("midpoint"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("size"))), F.lit(0).cast(SIZE))
    out = rows.groupBy(*keys).agg(
        F.first("best_bid").alias("best_bid"),
        F.first("best_ask").alias("best_ask"),
        F.first("midpoint").alias("midpoint"),
        total(buy).alias("bid_depth"),
        total(sell).alias("ask_depth"),
        total(buy & (F.col("price") == F.col("best_bid"))).alias("bid_depth_top"),
        total(sell & (F.col("price") == F.col("best_ask"))).alias("ask_depth_top"),
        total(near_bid).alias("bid_depth_1pct"),
        total(near_ask).alias("ask_depth_1pct"),
        F.count(F.lit(1)).alias("level_count"),
    )
    spread = F.col("best_ask") - F.col("best_bid")
    both = F.col("bid_depth") + F.col("ask_depth")
    real = lambda c: c.cast("double")
    bps = F.when(F.col("midpoint") != 0, real(spread) / real(F.col("midpoint")) * 10_000)
    skew = F.when(both > 0, real(F.col("bid_depth") - F.col("ask_depth")) / real(both))
    return out.withColumns({"spread": spread, "spread_bps": bps, "imbalance": skew})


def not_crossed(metrics: DataFrame) -> DataFrame:
    """Books whose spread isn't negative; one with an empty side stays."""
    return metrics.where(F.col("spread").isNull() | (F.col("spread") >= 0))


def serialise_side(levels: DataFrame, side: int) -> DataFrame:
    """``token_key, text``: the levels of a side as ``price:size``, the best first."""
    sign = -1 if side == BUY else 1
    rows = levels.where(F.col("side") == side)
    listed = F.array_sort(F.collect_list(F.struct((F.col("price") * sign).alias("by"), "price", "size")))
    return rows.groupBy("token_key").agg(F.array_join(F.transform(listed, lambda x: F.concat(x["price"].cast("decimal(18,2)").cast("string"), F.lit(":"), x["size"].cast("decimal(18,2)").cast("string"))), ",").alias("text"))


def revisions(events: DataFrame) -> DataFrame:
    """Mutations of each token's book, and whether its last one was a snapshot (whose hash is then still valid)."""
    rows = with_epochs(events).where("epoch > 0")
    return rows.groupBy("token_key").agg(F.count(F.lit(1)).alias("revision"), (F.max_by("kind", F.struct("ts", "kind", "seq")) == 0).alias("hash_valid"))


def reconcile(events: DataFrame, parts: int = 1) -> DataFrame:
    """Replayed levels against those of each reconciliation snapshot at its time: only where they differ."""
    checks = events.where(F.col("is_recon")).select("token_key", F.col("ts").alias("tick"), "seq", "levels")
    ours = book_at_ticks(events, checks.select("token_key", "tick"), parts).withColumnRenamed("size", "replayed")
    known = with_epochs(events).where("kind = 0").groupBy("token_key").agg(F.min("ts").alias("first_ts"))
    checks = checks.join(known, "token_key").where(F.col("first_ts") <= F.col("tick"))
    theirs = checks.withColumn("level", F.explode(distinct_levels(F.col("levels")))).select("token_key", "tick", "level.side", "level.price", F.col("level.size").cast(SIZE).alias("reported"))
    ours = ours.join(checks.select("token_key", "tick"), ["token_key", "tick"], "left_semi")
    both = ours.join(theirs, ["token_key", "tick", "side", "price"], "full_outer")
    return both.where(~F.col("replayed").eqNullSafe(F.col("reported")))


def last_before(left: DataFrame, right: DataFrame, key: list[str], left_ts: str, right_ts: str, values: list[str], order: list[str], parts: int = 1) -> DataFrame:
    """As-of join: each left row with the values of the last right row of its key at or before it.

    Both sides are one sorted stream a key, and the last right row is carried
    forward, so rows are sorted once and nothing is paired; with several parts (see
    ``prefix``) a busy key spreads over them. order: what makes the right side's order total.
    """
    keys, orders = [f"k{i}" for i in range(len(key))], [f"o{i}" for i in range(len(order))]
    mine, theirs = F.struct(*left.columns), F.struct(*values)
    kinds = {"l": left.select(mine.alias("l")).schema["l"].dataType, "r": right.select(theirs.alias("r")).schema["r"].dataType}
    a = left.select(*[F.col(c).alias(k) for c, k in zip(key, keys, strict=True)], F.col(left_ts).alias("t"), F.lit(1).alias("side"), mine.alias("l"), F.lit(None).cast(kinds["r"]).alias("r"), *[F.lit(None).cast(right.schema[c].dataType).alias(o) for c, o in zip(order, orders, strict=True)])
    b = right.select(*[F.col(c).alias(k) for c, k in zip(key, keys, strict=True)], F.col(right_ts).alias("t"), F.lit(0).alias("side"), F.lit(None).cast(kinds["l"]).alias("l"), theirs.alias("r"), *[F.col(c).alias(o) for c, o in zip(order, orders, strict=True)])
    both = with_parts(a.unionByName(b), keys, "t", "part", parts)
    joined = running(both, keys, ["t", "side", *orders], "part", {"last": Running("last", F.col("r"))}, parts).where("side = 1")
    return joined.select("l.*", *[F.col(f"last.{v}").alias(v) for v in values])
