"""Streams over the landed events; their SQL is that of the batch twins."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..operators import normalise as n
from ..operators import sampling
from ..streaming import jobs, ordered
from .q_archive import CHANGED, CONNECTION_GAPS, GAPS, folder
from .q_book import BOOK, CLOSING, bk, exact, metrics, snapshot_levels
from .registry import family
from .standins import view, with_views

Q, SQL, query = family()

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def events(spark, d, glob="events.parquet", files_per_batch=None):
    rows = jobs.landed(spark, d, glob, EVENTS, files_per_batch)
    k = F.get_json_object("props", "$.k").cast("int")
    return rows.withColumns({"k": k, "us": F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts")), "ts": F.col("ts").cast("timestamp")})


@query("l10_minute_counters", "SELECT date_trunc('minute', ts) AS minute, event_type, count(*) AS messages FROM events GROUP BY ALL")
def _(spark, d):
    out = jobs.run_to_end(jobs.minute_counters(events(spark, d), "event_type"), folder(spark, "l10"), "update")
    return jobs.newest(out, ["minute", "event_type"]).withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query("l2_rolling_activity", "WITH w AS (SELECT user_id, unnest(range(6)) AS i, date_trunc('hour', ts) AS h FROM events) SELECT h + INTERVAL 1 HOUR * (i + 1) AS window_end, user_id, count(*) AS n FROM w GROUP BY ALL")
def _(spark, d):
    out = jobs.run_to_end(jobs.rolling_activity(events(spark, d), "user_id", "6 hours", "1 hour"), folder(spark, "l2"), "update")
    return jobs.newest(out, ["window_end", "user_id"]).withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


@query("l11_dedup_stream", "SELECT DISTINCT event_type, user_id, (props->>'$.k')::INT AS k FROM events")
def _(spark, d):
    out = jobs.run_to_end(jobs.dedup(events(spark, d), ["event_type", "user_id", "k"], "60 days"), folder(spark, "l11"))
    return out.select("event_type", "user_id", "k")


@query("l1_l5_raw_audit", "SELECT event_id, CASE WHEN (props->>'$.k')::INT % 13 = 0 THEN 'malformed_json' WHEN event_type = 'error' THEN 'unknown' END AS message_type FROM events WHERE (props->>'$.k')::INT % 13 = 0 OR event_type = 'error'")
def _(spark, d):
    """Frames decoded and classified in the stream; errors are kept."""
    body = F.concat(F.lit('{"event_type":"'), F.when(F.col("event_type") == "error", "future").otherwise("book"), F.lit('"}'))
    raw = events(spark, d).select("event_id", F.when(F.col("k") % 13 == 0, F.substring(body, 1, 9)).otherwise(body).alias("frame"), F.lit("none").alias("tier"))
    return jobs.run_to_end(n.retention_policy(n.frames(raw), "errors"), folder(spark, "l5")).select("event_id", "message_type")


def fed(spark, d, name: str, job, parts: int = 3, jitter: int = 0, delay: int | None = None, sinks: dict[str, jobs.Sink] | None = None, halves: bool = False):
    """The sink of ``job`` (of a stream of events) after the events landed in parts by time; the stream stops after each and goes on from its checkpoint.

    jitter: events land up to so many hours late, so that they come out of order;
    delay: of the job's watermark in hours: a row without a user, the delay and a
    millisecond after the last event, tells that all has come; sinks: several ones;
    halves: two parts, cut in the middle of the time.
    """
    rows = spark.read.parquet(f"{d}/events.parquet")
    landing, path = folder(spark, f"{name}-landing"), folder(spark, name)
    lands = F.col("ts") + F.make_dt_interval(hours=F.pmod(F.col("event_id") * 7919, F.lit(jitter + 1)).cast("int"))
    cuts, newest = rows.agg(F.percentile_approx(lands, [i / parts for i in range(1, parts)]), F.date_trunc("millisecond", F.max("ts")).cast("timestamp_ntz")).first()
    if halves:
        low, high = rows.agg(F.min("ts"), F.max("ts")).first()
        cuts = [low + (high - low) // 2] if low else []
    part, out = F.lit(0), None
    for cut in cuts or []:
        part = part + (lands >= F.lit(cut)).cast("int")
    for i in range(len(cuts or []) + 1):
        rows.where(F.coalesce(part, F.lit(0)) == i).write.mode("append").parquet(landing)
        if delay is not None and newest is not None and i == len(cuts or []):
            end = newest + timedelta(hours=delay, milliseconds=1)
            spark.createDataFrame([(end, "end")], "ts timestamp_ntz, event_type string").select(*[F.col(c) if c in ("ts", "event_type") else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns]).write.mode("append").parquet(landing)
        out = jobs.run_to_sinks(job(events(spark, landing, "*.parquet")), path, sinks or {"rows": lambda x: x})
    return out if sinks else out["rows"]


@query("l4_suppress_stream", CHANGED)
def _(spark, d):
    key = ["provider", "instrument"]

    def job(rows):
        rows = rows.select(F.col("event_type").alias("provider"), (F.col("user_id") % 10).alias("instrument"), F.when(F.col("k") < 70, 1).otherwise(2 + F.col("k") % 2).cast("decimal(18,6)").alias("price"), "us", F.col("event_id").alias("seq"))
        return jobs.stateful(rows, key, jobs.SuppressUnchanged(12 * 3600, key, "us", ["seq"], "price", ["seq"], "decimal(18,6)"), "provider string, instrument long, seq long, late boolean")

    return fed(spark, d, "l4", job).where("NOT late").drop("batch", "late")


def book_changes(spark, d, name: str, resolving: bool = False):
    """The sink of the current-book stream over the landed events."""
    snapshot = (F.col("event_type") == "signup") & (F.col("k") < 50)
    even = F.col("k") % 2 == 0
    kind = F.when(snapshot, jobs.SNAPSHOT).otherwise(jobs.CHANGE)
    ends = (F.col("event_type") == "error") & (F.col("k") >= 90)
    kinds = F.when(ends, F.array(kind, F.lit(jobs.RESOLVE))).otherwise(F.array(kind)) if resolving else F.array(kind)

    def job(rows):
        rows = rows.withColumn("v", F.col("value").cast("decimal(18,2)")).where(~(snapshot & (F.col("k") % 5 == 0))).withColumn("kind", F.explode(kinds))
        rows = rows.select(
            F.col("user_id").alias("token_key"),
            "us",
            "kind",
            F.col("event_id").alias("seq"),
            F.when(snapshot, snapshot_levels()).alias("levels"),
            F.when(even, 1).otherwise(2).alias("side"),
            ((F.when(even, 30).otherwise(60) + F.col("k") % 10) * F.lit("0.010000").cast("decimal(7,6)")).cast("decimal(18,6)").alias("price"),
            F.expr("CASE event_type WHEN 'error' THEN 2 WHEN 'purchase' THEN 4 ELSE 1 END").alias("action"),
            F.when(F.col("event_type") == "purchase", F.col("v") - 40).otherwise(F.col("v")).cast("decimal(38,6)").alias("x"),
        )
        return jobs.stateful(rows, ["token_key"], jobs.CurrentBook(), jobs.BOOK_CHANGES)

    return fed(spark, d, name, job)


@query("l7_l13_current_book_stream", bk(f"WITH {BOOK} SELECT token_key, epoch::BIGINT AS epoch, side, price::DECIMAL(38, 6)::VARCHAR AS price, size::DECIMAL(38, 6)::VARCHAR AS size FROM bk"))
def _(spark, d):
    return jobs.current_levels(book_changes(spark, d, "l7")).select("token_key", "epoch", "side", *exact("price", "size"))


@query("l12_closing_stream", CLOSING)
def _(spark, d):
    """The books that the stream closed at the last resolving frame of each token."""
    levels = jobs.closing_levels(book_changes(spark, d, "l12", resolving=True))
    at = F.timestamp_add("MICROSECOND", F.col("us"), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    return metrics(levels.select("token_key", at.alias("tick"), "side", "price", "size"), "token_key", "tick")


STAYS = """WITH RECURSIVE w AS (SELECT user_id, event_id AS seq, epoch_us(ts) AS us, CASE WHEN k >= 70 THEN 2 WHEN k >= 40 THEN 1 ELSE 0 END AS wanted, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM (SELECT *, (props->>'$.k')::INT AS k FROM events)),
s AS (SELECT DISTINCT user_id, user_id % 3 AS tier, epoch_us(TIMESTAMP '2024-01-01 00:00:00') - 3600000000 * (user_id % 12) AS since FROM events WHERE user_id % 4 <> 0),
r AS (SELECT w.user_id, w.n, w.seq, CASE WHEN go THEN wanted ELSE tier END AS tier, CASE WHEN go THEN us ELSE since END AS since FROM (SELECT w.*, s.tier, s.since, s.tier IS NULL OR wanted > s.tier OR (wanted < s.tier AND us - s.since >= 21600000000) AS go FROM w LEFT JOIN s USING (user_id) WHERE n = 1) w
  UNION ALL SELECT user_id, n, seq, CASE WHEN go THEN wanted ELSE tier END, CASE WHEN go THEN us ELSE since END FROM (SELECT w.*, r.tier, r.since, wanted > r.tier OR (wanted < r.tier AND us - r.since >= 21600000000) AS go FROM r JOIN w ON w.user_id = r.user_id AND w.n = r.n + 1) w)
SELECT user_id, seq, tier::INT AS tier, since::BIGINT AS since FROM r"""


@query("l14_state_seed", STAYS)
def _(spark, d):
    """Stored tiers seed the state when the stream first starts; after a stop its own state goes on."""
    users = spark.read.parquet(f"{d}/events.parquet").select("user_id").distinct().where("user_id % 4 <> 0")
    stored = users.select("user_id", (F.col("user_id") % 3).cast("int").alias("tier"), F.expr("unix_micros(TIMESTAMP '2024-01-01 00:00:00') - 3600000000 * (user_id % 12)").alias("since"))

    def job(rows):
        rows = rows.select("user_id", "us", F.col("event_id").alias("seq"), F.when(F.col("k") >= 70, 2).when(F.col("k") >= 40, 1).otherwise(0).alias("wanted"))
        return jobs.stateful(rows, ["user_id"], jobs.TierStay(6 * 3600, "user_id"), "user_id long, seq long, tier int, since long", stored)

    return fed(spark, d, "l14", job).drop("batch")


@query(
    "l6_l15_tier_routing",
    with_views("mk_prev_tiers", "WITH r AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'update' WHEN 'signup' THEN 'snapshot' WHEN 'click' THEN 'observation' WHEN 'error' THEN 'reference' ELSE 'trade' END AS kind, 'm' || user_id AS market, (props->>'$.k')::INT AS k FROM events) SELECT event_id, CASE kind WHEN 'update' THEN coalesce(tier = 'full', false) WHEN 'snapshot' THEN coalesce(tier = 'full', false) OR k > 90 WHEN 'observation' THEN coalesce(tier = 'sampled', false) WHEN 'reference' THEN true ELSE false END AS to_archive, CASE kind WHEN 'snapshot' THEN k <= 95 WHEN 'observation' THEN false WHEN 'reference' THEN false ELSE true END AS to_hot FROM r LEFT JOIN mk_prev_tiers t ON t.external_id = r.market"),
)
def _(spark, d):
    """Rows routed in the stream by the tier table, while the pressure is critical."""
    kind = F.expr("CASE event_type WHEN 'view' THEN 'update' WHEN 'signup' THEN 'snapshot' WHEN 'click' THEN 'observation' WHEN 'error' THEN 'reference' ELSE 'trade' END")
    rows = events(spark, d).select("event_id", kind.alias("kind"), F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("market"), (F.col("k") > 90).alias("closing"), (F.col("k") > 95).alias("archive_only"))
    return jobs.run_to_end(jobs.route(rows, view(spark, d, "mk_prev_tiers"), F.lit("critical")), folder(spark, "l6")).select("event_id", "to_archive", "to_hot")


@query("l8_gaps_stream", GAPS)
def _(spark, d):
    """Gaps of sequences whose rows land out of order: rows wait for the watermark before gaps are judged."""

    def job(rows):
        rows = rows.select("ts", "user_id", "us", F.col("event_id").alias("seq"))
        return ordered.by_event_time(rows, ordered.SequenceGaps(["user_id"]), "expected long, actual long, missing long", delay="30 hours")

    return fed(spark, d, "l8", job, jitter=24, delay=30).where("change = 'gap'").select("user_id", "expected", "actual", "missing")


@query("l9_gaps_stream", CONNECTION_GAPS)
def _(spark, d):
    """Gaps that disconnects open and confirmations resolve, from rows that land out of order."""

    def job(rows):
        event = F.expr("CASE event_type WHEN 'error' THEN 'disconnect' WHEN 'signup' THEN 'confirm' END")
        rows = rows.select("ts", "user_id", "us", F.col("event_id").alias("seq"), event.alias("event"))
        return ordered.by_event_time(rows, ordered.ConnectionGaps(["user_id"]), "opened_us long, resolved_us long", delay="30 hours")

    gaps = fed(spark, d, "l9", job, jitter=24, delay=30).where("change IN ('open', 'resolved')").groupBy("user_id", "opened_us").agg(F.max("resolved_us").alias("resolved_us"))
    at = lambda c: F.timestamp_add("MICROSECOND", F.col(c), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))
    return gaps.select("user_id", at("opened_us").alias("opened_at"), at("resolved_us").alias("resolved_at"))


HOUR = 3600
RULE = sampling.Rule.seconds(grid=HOUR, full=6 * HOUR, sampled=3 * HOUR, heartbeat=12 * HOUR)
OBSERVED = """WITH RECURSIVE e AS (SELECT *, epoch_us(ts) AS us, (props->>'$.k')::INT AS k, value::DECIMAL(18, 2) AS v FROM events),
c AS (SELECT user_id, us, event_id AS seq, CASE WHEN event_type IN ('view', 'signup') THEN 1 ELSE 0 END AS revises,
    CASE WHEN event_type = 'error' THEN false WHEN event_type IN ('view', 'signup') THEN true END AS valid,
    CASE WHEN event_type IN ('view', 'signup') THEN k END AS bid, CASE WHEN event_type IN ('view', 'signup') THEN k + CASE WHEN k % 10 = 0 THEN -1 ELSE 2 END END AS ask,
    CASE WHEN event_type = 'purchase' THEN v END AS price, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS trades, CASE WHEN event_type = 'purchase' THEN v ELSE 0 END AS volume,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS updates, CASE WHEN k % 4 = 0 THEN CASE k % 3 WHEN 0 THEN 'full' WHEN 1 THEN 'sampled' ELSE 'none' END END AS tier FROM e
  UNION ALL SELECT user_id, us + 21600000000, event_id, 0, NULL, NULL, NULL, NULL, CASE WHEN event_type = 'purchase' THEN -1 ELSE 0 END, CASE WHEN event_type = 'purchase' THEN -v ELSE 0 END, CASE WHEN event_type = 'click' THEN -1 ELSE 0 END, NULL
  FROM e WHERE event_type IN ('purchase', 'click')),
s AS (SELECT user_id, us, seq, last_value(valid IGNORE NULLS) OVER w AS valid, last_value(bid IGNORE NULLS) OVER w AS bid, last_value(ask IGNORE NULLS) OVER w AS ask, last_value(tier IGNORE NULLS) OVER w AS tier,
    sum(revises) OVER w AS revision, last_value(price IGNORE NULLS) OVER w AS price, sum(trades) OVER w AS trades, sum(volume) OVER w AS volume, sum(updates) OVER w AS updates
  FROM c WINDOW w AS (PARTITION BY user_id ORDER BY us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY user_id, us ORDER BY seq DESC) = 1),
g AS (SELECT user_id, unnest(generate_series((low + 3599999999) // 3600000000, high // 3600000000)) * 3600000000 AS tick FROM (SELECT user_id, min(us) AS low FROM c GROUP BY user_id), (SELECT max(us) AS high FROM e)),
p AS (SELECT g.user_id, g.tick, b.tier, (b.revision, b.price, b.trades, b.volume, b.updates) AS state, row_number() OVER (PARTITION BY g.user_id ORDER BY g.tick) AS n
  FROM g ASOF JOIN b ON g.user_id = b.user_id AND g.tick >= b.us WHERE b.valid AND coalesce(b.ask >= b.bid, true) AND b.tier IN ('full', 'sampled')),
r AS (SELECT user_id, n, tick, tier, state, true AS given, CASE tier WHEN 'full' THEN 'periodic_hot' ELSE 'change' END AS kind, tick AS prior, state AS old FROM p WHERE n = 1
  UNION ALL SELECT user_id, n, tick, tier, state, due, kind, CASE WHEN due THEN tick ELSE prior END, CASE WHEN due THEN state ELSE old END FROM (
    SELECT p.*, r.prior, r.old, p.tick - r.prior >= CASE WHEN p.tier = 'full' THEN 21600000000 WHEN p.state IS DISTINCT FROM r.old THEN 10800000000 ELSE 43200000000 END AS due,
      CASE WHEN p.tier = 'full' THEN 'periodic_hot' WHEN p.state IS DISTINCT FROM r.old THEN 'change' ELSE 'heartbeat' END AS kind
    FROM r JOIN p ON p.user_id = r.user_id AND p.n = r.n + 1))
SELECT user_id, tick::BIGINT AS tick, kind, state[1]::BIGINT AS revision, state[2]::DECIMAL(18, 6)::VARCHAR AS price, state[3]::BIGINT AS trades, state[4]::DECIMAL(38, 6)::VARCHAR AS volume, state[5]::BIGINT AS updates FROM r WHERE given"""


def book_changes_of(rows):
    """Changes of a book a user: quotes, disconnects, tiers, and trades and updates that count for six hours."""
    kind, k, v = F.col("event_type"), F.col("k"), F.col("value").cast("decimal(18,2)").cast("decimal(38,6)")
    quote, trade, update = kind.isin("view", "signup"), (kind == "purchase").cast("long"), (kind == "click").cast("long")
    none = lambda t: F.lit(None).cast(t)
    cents = lambda c: c.cast("decimal(18,6)")
    traded = F.when(trade == 1, v).otherwise(F.lit(0).cast("decimal(38,6)"))
    tier = F.when(k % 4 == 0, F.when(k % 3 == 0, "full").when(k % 3 == 1, "sampled").otherwise("none"))
    names = [n for n, _ in ordered.ObserveBooks.CHANGES]
    comes = [F.col("us"), F.col("event_id"), quote.cast("long"), F.when(kind == "error", False).when(quote, True), cents(F.when(quote, k)), cents(F.when(quote, k + F.when(k % 10 == 0, -1).otherwise(2))), cents(F.when(trade == 1, v)), trade, traded, update, tier]
    goes = [F.col("us") + 6 * HOUR * 1_000_000, F.col("event_id"), F.lit(0).cast("long"), none("boolean"), *[none("decimal(18,6)")] * 3, -trade, (-traded).cast("decimal(38,6)"), -update, none("string")]
    pack = lambda values: F.struct(*[x.alias(n) for x, n in zip(values, names, strict=True)])
    both = F.array(pack(comes), pack(goes))
    rows = rows.withColumn("x", F.explode(F.when((trade == 1) | (update == 1), both).otherwise(F.slice(both, 1, 1))))
    return rows.select(*[c for c in ("ts",) if c in rows.columns], "user_id", "x.*")


def shown(observations):
    return observations.select("user_id", "tick", "kind", "revision", *exact18("price"), "trades", *exact("volume"), "updates")


def exact18(*names):
    return [F.col(c).cast("decimal(18,6)").cast("string").alias(c) for c in names]


@query("l3_observe_rule", OBSERVED)
def _(spark, d):
    """Observations of all books by the whole rule: full ones at intervals, sampled ones on change since the last one given, else heartbeats; crossed and invalid books wait."""
    ev = spark.read.parquet(f"{d}/events.parquet")
    us = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col("ts"))
    rows = ev.withColumns({"k": F.get_json_object("props", "$.k").cast("int"), "us": us}).drop("ts")
    until = rows.agg(F.max("us")).first()[0] or 0
    return shown(sampling.observe_books(sampling.book_states(book_changes_of(rows), ["user_id"]), ["user_id"], until, RULE))


@query("l3_observe_stream", OBSERVED)
def _(spark, d):
    """The same from a stream whose rows land out of order; timers give what is due while nothing comes."""

    def job(rows):
        parts = "revision long, price decimal(18,6), trades long, volume decimal(38,6), updates long"
        return ordered.by_event_time(book_changes_of(rows), ordered.ObserveBooks(["user_id"], RULE), parts, delay="30 hours")

    return shown(fed(spark, d, "l3", job, jitter=24, delay=30).where("change <> 'late'").withColumnsRenamed({"us": "tick", "change": "kind"}))


@query(
    "l13_late_rows",
    """WITH e AS (SELECT event_id, user_id, ts, ts + INTERVAL 1 HOUR * (event_id * 7919 % 25) AS lands FROM events), c AS (SELECT make_timestamp(epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2) AS cut FROM e),
m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 6 HOUR AS mark FROM e, c WHERE lands < cut) SELECT user_id, event_id AS seq, epoch_us(ts) AS us FROM e, c, m WHERE lands >= cut AND ts < mark""",
)
def _(spark, d):
    """Rows that land after the watermark has passed them: in a table beside the gaps, with the micro-batch that found them."""

    def job(rows):
        return ordered.by_event_time(rows.select("ts", "user_id", "us", F.col("event_id").alias("seq")), ordered.SequenceGaps(["user_id"]), "expected long, actual long, missing long", delay="6 hours")

    sinks = {"gaps": lambda rows: rows.where("change = 'gap'"), "late": lambda rows: rows.where("change = 'late'").select("user_id", "seq", "us")}
    return fed(spark, d, "l13", job, jitter=24, sinks=sinks, halves=True)["late"].drop("batch")
