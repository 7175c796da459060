"""Normalisation: raw JSON rows (``payload``) to typed rows, table to table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s

KNOWN_TYPES = ("book", "price_change", "last_trade_price", "tick_size_change", "new_market", "market_resolved")
METRIC = "decimal(38,18)"


def _get(path: str, payload: str = "payload") -> Column:
    return F.get_json_object(payload, f"$.{path}")


def _flag(path: str, default: bool | Column | None = None) -> Column:
    value = s.loose_bool(_get(path))
    return value if default is None else F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def metric(value: Column) -> Column:
    """A number that may not be negative: else null."""
    number = s.as_decimal(value)
    return F.when(number >= 0, number)


def market_candidates(raw: DataFrame) -> DataFrame:
    """What the selection needs of each raw market; rows without an id are left out (see ``identity_rejects``)."""
    tokens = s.json_list(_get("clobTokenIds"))
    closed, archived = _flag("closed", False), _flag("archived", False)
    active = _flag("active", False) & ~closed & ~archived
    book = _flag("enableOrderBook", F.size(tokens) > 0)
    accepting = _flag("acceptingOrders", False)
    return raw.where(F.coalesce(_get("id"), F.lit("")) != "").select(
        _get("id").alias("external_id"),
        active.alias("active"),
        closed.alias("closed"),
        archived.alias("archived"),
        accepting.alias("accepting"),
        book.alias("book"),
        (active & book & accepting & (F.size(tokens) > 0)).alias("tradable"),
        metric(_get("liquidityNum")).alias("liquidity"),
        metric(_get("volume24hr")).alias("volume_24h"),
        metric(_get("spread")).alias("spread"),
        s.parse_timestamp(_get("endDate")).alias("close_time"),
        tokens.alias("tokens"),
    )


def market_status() -> Column:
    """resolved > closed > archived > active > what the row says > inactive."""
    live = _flag("active", False) & _flag("acceptingOrders", True)
    return F.when(_flag("resolved", False), "resolved").when(_flag("closed", False), "closed").when(_flag("archived", False), "archived").when(live, "active").otherwise(F.lower(F.coalesce(_get("status"), F.lit("inactive"))))


def markets(raw: DataFrame) -> DataFrame:
    """The stored market row: a close before the open is dropped, names and type have fallbacks."""
    opened, closes = s.parse_timestamp(_get("startDate")), s.parse_timestamp(_get("endDate"))
    return raw.select(
        _get("id").alias("external_id"),
        s.first_present(F.col("payload"), "question", "title", "id").alias("question"),
        F.coalesce(_get("marketType"), F.lit("binary")).alias("market_type"),
        market_status().alias("status"),
        opened.alias("open_time"),
        F.when(opened.isNull() | (closes >= opened), closes).alias("close_time"),
        _flag("enableOrderBook", False).alias("enable_order_book"),
    )


def outcomes(raw: DataFrame) -> DataFrame:
    """One row an outcome: names, tokens and prices side by side, to the longer of names and tokens."""
    names, tokens, prices = (s.json_list(_get(c)) for c in ("outcomes", "clobTokenIds", "outcomePrices"))
    n = F.greatest(F.size("names"), F.size("tokens"))
    rows = raw.select(_get("id").alias("market"), names.alias("names"), tokens.alias("tokens"), prices.alias("prices"))
    rows = rows.select("*", F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))).alias("i"))
    fallback = F.concat(F.lit("Outcome "), F.col("i").cast("string"))
    return rows.select("market", F.concat("market", F.lit(":outcome:"), F.col("i").cast("string")).alias("outcome_id"), F.coalesce(F.get("names", "i"), fallback).alias("name"), F.get("tokens", "i").alias("token"), s.as_decimal(F.get("prices", "i")).alias("price"))


def events(raw: DataFrame) -> DataFrame:
    start, end = s.parse_timestamp(_get("startDate")), s.parse_timestamp(_get("endDate"))
    status = F.when(_flag("closed", False), "closed").when(_flag("active", False), "active").otherwise("inactive")
    return raw.select(_get("id").alias("external_id"), s.first_present(F.col("payload"), "title", "ticker", "id").alias("title"), status.alias("status"), start.alias("start_time"), F.when(start.isNull() | (end >= start), end).alias("end_time"))


def tags(raw: DataFrame) -> DataFrame:
    return raw.select(_get("id").alias("tag_id"), s.first_present(F.col("payload"), "label", "name", "slug", "id").alias("name"))


def nested_markets(raw: DataFrame, order: str) -> DataFrame:
    """Active, open events, their markets exploded; active markets; the last row of an id wins."""
    live = raw.where(_flag("active", False) & ~_flag("closed", False))
    listed = F.from_json(_get("markets"), "array<string>")
    rows = live.select(order, _get("id").alias("event_id"), F.posexplode(listed).alias("pos", "payload"))
    rows = rows.where(_flag("active", False) & (F.coalesce(_get("id"), F.lit("")) != "")).withColumn("external_id", _get("id"))
    return rows.groupBy("external_id").agg(F.max_by(F.struct("event_id", "payload"), F.struct(order, "pos")).alias("last")).select("external_id", "last.*")


def trades(raw: DataFrame) -> DataFrame:
    """Trades with market, price, size and time; others are left out."""
    rows = raw.select(_get("market").alias("market"), _get("asset_id").alias("token"), s.as_decimal(_get("price")).alias("price"), s.as_decimal(_get("size")).alias("size"), F.lower(_get("side")).alias("side"), s.parse_timestamp(_get("timestamp")).alias("executed_at"), _get("id").alias("trade_id"))
    return rows.where("market IS NOT NULL AND price IS NOT NULL AND size IS NOT NULL AND executed_at IS NOT NULL")


def price_changes(raw: DataFrame) -> DataFrame:
    """One row a change: set with a size, else delete; changes without price, size or side are left out."""
    each = raw.select(_get("market").alias("market"), s.parse_timestamp(_get("timestamp")).alias("ts"), F.posexplode(F.from_json(_get("price_changes"), "array<string>")).alias("pos", "payload"))
    rows = each.select("market", "ts", "pos", _get("asset_id").alias("token"), s.as_decimal(_get("price")).alias("price"), s.as_decimal(_get("size")).alias("size"), s.code(_get("side"), s.SIDES).alias("side"))
    rows = rows.where("price IS NOT NULL AND size IS NOT NULL AND side IS NOT NULL")
    return rows.withColumn("action", F.when(F.col("size") > 0, "set").otherwise("delete"))


def books(raw: DataFrame) -> DataFrame:
    """Book frames: levels as objects or pairs, sorted; a frame of which a side isn't a list is left out. A frame is parsed once."""
    part = lambda x, key, i: s.as_decimal(F.coalesce(F.try_variant_get(x, f"$.{key}", "string"), F.try_variant_get(x, f"$[{i}]", "string")))

    def side(name: str, sign: int) -> Column:
        levels = F.transform(name, lambda x: F.struct(part(x, "price", 0).alias("price"), part(x, "size", 1).alias("size")))
        levels = F.filter(levels, lambda x: (x["size"] > 0) & x["price"].isNotNull())
        return F.array_sort(F.transform(levels, lambda x: F.struct((x["price"] * sign).alias("by"), x["price"].alias("price"), x["size"].alias("size"))))

    get = lambda name, kind: F.try_variant_get("frame", f"$.{name}", kind)
    rows = raw.select(F.try_parse_json("payload").alias("frame"))
    rows = rows.select(get("asset_id", "string").alias("token"), s.parse_timestamp(get("timestamp", "string")).alias("ts"), get("hash", "string").alias("book_hash"), get("bids", "array<variant>").alias("bids"), get("asks", "array<variant>").alias("asks"))
    return rows.where("bids IS NOT NULL AND asks IS NOT NULL").withColumns({"bids": side("bids", -1), "asks": side("asks", 1)})


def book_headers(frames: DataFrame) -> DataFrame:
    total = lambda c: F.aggregate(c, F.lit(0).cast(METRIC), lambda a, x: (a + x["size"]).cast(METRIC))
    bid, ask = F.get("bids", F.lit(0))["price"], F.get("asks", F.lit(0))["price"]
    return frames.select("token", "ts", bid.alias("best_bid"), ask.alias("best_ask"), ((bid + ask) / 2).alias("midpoint"), (ask - bid).alias("spread"), total("bids").alias("bid_depth"), total("asks").alias("ask_depth"), (F.size("bids") + F.size("asks")).alias("level_count"))


def reference_prices(raw: DataFrame, providers: dict[str, str]) -> DataFrame:
    """Price frames, snapshots exploded: exact values are scaled by their topic, others as displayed."""
    topic = _get("topic")
    provider = F.try_element_at(F.create_map(*[F.lit(x) for kv in providers.items() for x in kv]), topic)
    points = F.coalesce(F.from_json(_get("payload.data"), "array<string>"), F.array(_get("payload")))
    rows = raw.select(topic.alias("topic"), provider.alias("provider"), F.lower(_get("payload.symbol")).alias("instrument"), F.when(_get("payload.data").isNotNull(), "snapshot").otherwise("live").alias("source_status"), F.explode(points).alias("payload"))
    exact, shown = s.as_decimal(_get("full_accuracy_value")), s.as_decimal(_get("value"))
    twap = F.get_json_object("payload", "$.full_accuracy_value").try_cast("decimal(38,0)")
    price = F.when(F.col("topic").endswith("twap"), (twap / F.lit("1000000000000000000").cast("decimal(19,0)")).cast("decimal(38,18)")).when(F.col("topic").contains("equity"), F.coalesce(exact, shown)).otherwise(shown)
    rows = rows.withColumns({"price": price, "ts": s.parse_timestamp(_get("timestamp"))}).where("provider IS NOT NULL AND price IS NOT NULL AND ts IS NOT NULL")
    update = F.sha2(F.concat_ws("|", "topic", "instrument", s.micros(F.col("ts")).cast("string"), s.plain_number(F.col("price"))), 256)
    return rows.select("provider", "instrument", "ts", "price", "source_status", update.alias("update_id"))


def comments(raw: DataFrame) -> DataFrame:
    body = s.first_present(F.col("payload"), "body", "text")
    return raw.select(F.coalesce(_get("id"), F.sha2("payload", 256)).alias("comment_id"), F.lower(_get("parentEntityID")).alias("parent"), s.first_present(F.col("payload"), "profile.name", "userAddress").alias("author"), body.alias("body"))


def sports(raw: DataFrame) -> DataFrame:
    home, away = s.score_split(_get("score"))
    return raw.select(s.first_present(F.col("payload"), "gameId", "slug").alias("game"), _get("status").alias("status"), home.alias("home_score"), away.alias("away_score"), F.sha2("payload", 256).alias("update_id"))


def lifecycle_patches(raw: DataFrame) -> DataFrame:
    """Frames that change a market, as sparse columns and the list of those they set."""
    kind = _get("event_type")
    tick = F.when(kind == "tick_size_change", s.as_decimal(_get("new_tick_size")))
    status = F.when(kind == "market_resolved", F.lit("resolved"))
    question = F.when(kind == "new_market", _get("question"))
    fields = F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(n)) for n, c in (("tick_size", tick), ("status", status), ("question", question))]))
    rows = raw.where(kind.isin("tick_size_change", "market_resolved", "new_market"))
    return rows.select(_get("market").alias("market"), kind.alias("event_type"), tick.alias("tick_size"), status.alias("status"), question.alias("question"), fields.alias("patched_fields"), F.sha2(F.concat_ws("|", kind, s.canonical_json(F.col("payload"))), 256).alias("dedup_hash"))


def candles(points: DataFrame) -> DataFrame:
    """Price points (token, ts, price) as one-minute candles of one value."""
    return points.select("token", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("start"), *[F.col("price").alias(c) for c in ("open", "high", "low", "close")])


def holders(raw: DataFrame) -> DataFrame:
    """Groups of a token's holders as ranked rows; the rank is the place in the list, rejects included."""
    each = raw.select(_get("token").alias("token"), F.posexplode(F.from_json(_get("holders"), "array<string>")).alias("pos", "payload"))
    rows = each.select("token", (F.col("pos") + 1).alias("rank"), _get("proxyWallet").alias("holder"), s.as_decimal(_get("amount")).alias("amount"))
    return rows.where("holder IS NOT NULL AND amount IS NOT NULL")


def fee_rates(rows: DataFrame) -> DataFrame:
    """A market's fee as a fraction if all its tokens agree. rows: market, base_fee (basis points)."""
    return rows.groupBy("market").agg(F.when(F.min("base_fee").eqNullSafe(F.max("base_fee")) & (F.count("base_fee") == F.count(F.lit(1))), F.min("base_fee").cast(METRIC) / 10_000).alias("fee_rate"))


def rewards(raw: DataFrame) -> DataFrame:
    """Reward settings: a row for each schedule and one summary row."""
    each = raw.select(_get("condition_id").alias("market"), F.posexplode(F.from_json(_get("rewards_config"), "array<string>")).alias("pos", "payload"))
    schedules = each.select("market", F.concat(F.lit("liquidity_reward:schedule:"), F.coalesce(_get("id"), F.col("pos").cast("string"))).alias("type"), s.as_decimal(_get("rate_per_day")).alias("rate"), s.parse_timestamp(_get("start_date")).alias("start"))
    summary = raw.select(_get("condition_id").alias("market"), F.lit("liquidity_reward:summary").alias("type"), s.as_decimal(_get("total_daily_rate")).alias("rate"), F.lit(None).cast("timestamp_ntz").alias("start"))
    return schedules.unionByName(summary)


def classify(payload: Column, bad: Column) -> Column:
    """Known type, transport envelope, error or unknown."""
    kind = F.get_json_object(payload, "$.event_type")
    return F.when(bad, "malformed_json").when(kind.isin(*KNOWN_TYPES), kind).when(F.get_json_object(payload, "$.error").isNotNull(), "error").when(F.get_json_object(payload, "$.topic").isNotNull(), "envelope").otherwise("unknown")


def frames(raw: DataFrame) -> DataFrame:
    """Text frames as one row an envelope: lists are exploded, malformed frames kept. raw: ``frame`` and other columns."""
    bad = F.try_parse_json("frame").isNull()
    listed = F.when(~bad & F.trim("frame").startswith("["), F.from_json("frame", "array<string>")).otherwise(F.array("frame"))
    rows = raw.withColumn("bad", bad).select("*", F.posexplode(listed).alias("pos", "payload"))
    return rows.withColumn("message_type", classify(F.col("payload"), F.col("bad"))).drop("frame", "bad")


def _heads(*names: str) -> dict[str, Column]:
    """Columns that several archive streams share, by name."""
    times = {"source_ts_ns": "source_ts", "exchange_ts_ns": "exchange_ts", "received_ts_ns": "ts"}
    keys = {"market_key": "market", "token_key": "token"}
    return {n: s.stable_key(keys[n], F.col(keys[n])) if n in keys else s.micros(F.col(times[n])) * 1000 if n in times else F.col(n) for n in names}


def _decimals(**columns: str) -> dict[str, Column]:
    out = {}
    for prefix, column in columns.items():
        out[f"{prefix}_mantissa"], out[f"{prefix}_scale"] = s.decimal_split(F.col(column))
    return out


def _select(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def encode_updates(rows: DataFrame, empty_deletes: bool = True) -> DataFrame:
    """Book changes in the archive's compact columns. rows: market, token, ts, side, action, price, size (text), and size_delta if there is one.

    A change that has only a delta is an addition; an addition keeps its code whatever
    its sign, any other change to nothing or less is a deletion; an unknown action sets.
    empty_deletes: false for rows whose actions are final, which then keep them whatever the size.
    """
    delta = F.col("size_delta") if "size_delta" in rows.columns else F.lit(None).cast("string")
    size = F.coalesce(F.col("size"), delta)
    action = F.when(F.col("size").isNull() & delta.isNotNull(), s.ACTIONS["delta"]).otherwise(F.coalesce(s.code(F.col("action"), s.ACTIONS), F.lit(s.ACTIONS["set"])))
    gone = F.lit(empty_deletes) & (size.try_cast("double") <= 0) & (action != s.ACTIONS["delta"])
    mantissa, scale = s.decimal_split(size)
    columns = _heads("market_key", "token_key", "received_ts_ns") | {"side": s.code(F.col("side"), s.SIDES), "action": F.when(gone, s.ACTIONS["delete"]).otherwise(action).cast("tinyint")}
    return _select(rows, columns | _decimals(price="price") | {"size_mantissa": mantissa, "size_scale": scale})


def _levels(text: str, side: str) -> Column:
    """Levels of a JSON list of (price, size); entries that aren't such pairs are left out."""
    pairs = F.filter(F.transform(s.json_list(F.col(text)), lambda x: F.from_json(x, "array<string>")), lambda x: F.size(x) >= 2)

    def one(pair: Column) -> Column:
        price, size = s.decimal_split(F.get(pair, F.lit(0))), s.decimal_split(F.get(pair, F.lit(1)))
        return F.struct(F.lit(s.SIDES[side]).alias("side"), price[0].alias("price_mantissa"), price[1].alias("price_scale"), size[0].alias("size_mantissa"), size[1].alias("size_scale"))

    return F.transform(pairs, one)


def encode_snapshots(rows: DataFrame) -> DataFrame:
    """Whole books. rows: market, token, connection_id, source_ts, exchange_ts, ts, book_hash, snapshot_type, bids, asks (JSON lists), is_reconciliation; unknown types are those of the exchange."""
    kind = F.coalesce(s.code(F.col("snapshot_type"), s.SNAPSHOTS), F.lit(s.SNAPSHOTS["exchange"])).cast("tinyint")
    columns = _heads("market_key", "token_key", "connection_id", "source_ts_ns", "exchange_ts_ns", "received_ts_ns", "book_hash")
    return _select(rows, columns | {"snapshot_type": kind, "levels": F.concat(_levels("bids", "buy"), _levels("asks", "sell")), "is_reconciliation": F.coalesce("is_reconciliation", F.lit(False))})


def encode_observations(rows: DataFrame) -> DataFrame:
    """Sampled book states. rows: market, token, ts, kind, recent_trade_count, recent_update_count, and best_bid, best_ask, bid_depth, ask_depth, last_trade as text."""
    columns = _heads("market_key", "token_key", "received_ts_ns") | {"observation_kind": F.when(F.col("kind") == "heartbeat", 2).otherwise(1).cast("tinyint")}
    columns |= {n: F.coalesce(F.col(n), F.lit(0)) for n in ("recent_trade_count", "recent_update_count")}
    return _select(rows, columns | _decimals(**{n: n for n in ("best_bid", "best_ask", "bid_depth", "ask_depth", "last_trade")}))


def encode_references(rows: DataFrame) -> DataFrame:
    """Reference prices. rows: provider, external_instrument_id, external_update_id, connection_id, source_ts, exchange_ts, ts, publish_slot, source_status, and price, bid, ask, confidence as text."""
    columns = _heads("provider", "external_instrument_id", "external_update_id", "connection_id", "source_ts_ns", "exchange_ts_ns", "received_ts_ns", "publish_slot", "source_status")
    return _select(rows, columns | {n: s.as_decimal(F.col(n)) for n in ("price", "bid", "ask", "confidence")})


def encode_frames(rows: DataFrame) -> DataFrame:
    """Raw socket frames. rows: market, token, connection_id, source_ts, exchange_ts, ts, channel, message_type, payload; ``payload_hash`` is made where it isn't given."""
    given = F.col("payload_hash") if "payload_hash" in rows.columns else F.lit(None).cast("string")
    columns = _heads("market_key", "token_key", "connection_id", "source_ts_ns", "exchange_ts_ns", "received_ts_ns", "channel", "message_type", "payload")
    return _select(rows, columns | {"payload_hash": F.coalesce(given, s.content_hash(F.col("payload")))})


def encode_bodies(rows: DataFrame) -> DataFrame:
    """Raw response bodies. rows: payload; ``content_hash`` and ``response_bytes`` are made where they aren't given."""
    given = lambda n, made: F.coalesce(F.col(n), made) if n in rows.columns else made
    payload = F.col("payload")
    return _select(rows, {"content_hash": given("content_hash", s.content_hash(payload)), "response_bytes": given("response_bytes", F.octet_length(payload)).cast("bigint"), "payload": payload})


def encode_entries(rows: DataFrame) -> DataFrame:
    """Dictionary entries, which are compact already."""
    return rows


ENCODERS = {
    "orderbook_updates": encode_updates,
    "orderbook_snapshots": encode_snapshots,
    "microstructure_observations": encode_observations,
    "reference_prices": encode_references,
    "raw_ws": encode_frames,
    "raw_rest": encode_bodies,
    "archive_dictionary": encode_entries,
}


def encode_compact(stream: str, rows: DataFrame) -> DataFrame:
    """Verbose rows as the compact rows of an archive stream."""
    if stream not in ENCODERS:
        raise ValueError(f"unknown archive stream {stream!r}")
    return ENCODERS[stream](rows)


def decode_updates(rows: DataFrame) -> DataFrame:
    price, size = (s.decimal_join(F.col(f"{x}_mantissa"), F.col(f"{x}_scale")) for x in ("price", "size"))
    return rows.select("market_key", "token_key", s.from_micros(F.expr("received_ts_ns div 1000")).alias("ts"), "side", "action", price.alias("price"), size.alias("size"))


def metric_diagnostics(raw: DataFrame, paths: list[str], samples: int = 10) -> DataFrame:
    """How often each metric is out of its domain, and the least ids of such rows."""
    each = F.array(*[F.struct(F.lit(p).alias("metric"), _get(p).alias("value")) for p in paths])
    bad = raw.select(_get("id").alias("id"), F.inline(each)).where(F.col("value").isNotNull() & metric(F.col("value")).isNull())
    from pyspark.sql import Window

    first = bad.withColumn("n", F.row_number().over(Window.partitionBy("metric").orderBy("id"))).where(F.col("n") <= samples)
    some = first.groupBy("metric").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("samples"))
    return bad.groupBy("metric").agg(F.count(F.lit(1)).alias("invalid")).join(some, "metric")


def identity_rejects(raw: DataFrame) -> DataFrame:
    return raw.where(F.coalesce(_get("id"), F.lit("")) == "")


def retention_policy(rows: DataFrame, policy: str, rate: float = 0.001) -> DataFrame:
    """Raw frames to keep: none, all, errors, errors_sample or full_l2. rows: message_type, payload, tier."""
    error = F.col("message_type").isin("error", "malformed_json", "unknown")
    keep = {"none": F.lit(False), "all": F.lit(True), "errors": error, "errors_sample": error | s.keep_sample(F.sha2("payload", 256), rate), "full_l2": error | (F.col("tier") == "full")}[policy]
    return rows.where(keep)
