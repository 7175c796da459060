"""Roll-ups, health states, capacity and data-quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as s
from .book import last_before

# What makes a run's result partial (if it is there and neither null, false, zero nor empty).
PARTIAL = ("write_failures", "archive_degraded", "trades.saturated_markets", "trades.history_floor_markets", "fees_incentives.errors", "comments.errors", "metadata.malformed_markets_skipped", "metadata.invalid_market_metric_values_normalized")
# The reasons that each kind of all-clear resolves.
RECORD = ("bounded_queue_timeout",)
TRANSIENT = ("bounded_queue_timeout", "durable_journal_live_admission_spill", "archive_spool_capacity_exceeded")
OPTIONAL = ("storage_critical_optional_hot_write_shed", "postgres_critical_optional_hot_write_shed")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def latest_times(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    out = None
    for name, (df, time) in tables.items():
        one = df.agg(F.max(time).alias("latest")).select(F.lit(name).alias("table_name"), "latest")
        out = one if out is None else out.unionByName(one)
    return out


def freshness(rows: DataFrame, expected: DataFrame, as_of: Column, seconds: int) -> DataFrame:
    """Age of each expected provider's newest row, and whether it is fresh."""
    newest = rows.groupBy("provider").agg(F.max("ts").alias("latest"))
    out = expected.join(newest, "provider", "left").withColumn("age", F.timestamp_diff("SECOND", F.col("latest"), as_of))
    state = F.when(F.col("latest").isNull(), "missing").when(F.col("age") <= seconds, "fresh").otherwise("stale")
    return out.withColumn("state", state)


def overall(states: DataFrame) -> DataFrame:
    """healthy if all are fresh, stale if none is, else degraded."""
    n, fresh = F.count(F.lit(1)), F.count_if(F.col("state") == "fresh")
    return states.agg(F.when(fresh == n, "healthy").when(fresh == 0, "stale").otherwise("degraded").alias("overall"))


def throughput(rows: DataFrame, key: str, time: str) -> DataFrame:
    """Messages a minute of each key."""
    return rows.groupBy(F.date_trunc("minute", F.col(time)).cast("timestamp_ntz").alias("minute"), key).agg(F.count(F.lit(1)).alias("messages"))


def ohlc(trades: DataFrame, key: str, time: str, order: list[str]) -> DataFrame:
    """Hourly candles of trades (price, size)."""
    at = F.struct(time, *order)
    hour = F.date_trunc("hour", F.col(time)).cast("timestamp_ntz")
    return trades.groupBy(key, hour.alias("start")).agg(F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("size").alias("volume"))


def bounded_samples(rejects: DataFrame, reason: str, key: str, n: int = 10) -> DataFrame:
    first = rejects.withColumn("__n", F.row_number().over(Window.partitionBy(reason).orderBy(key))).where(F.col("__n") <= n)
    some = first.groupBy(reason).agg(F.array_join(F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string")), ",").alias("samples"))
    return rejects.groupBy(reason).agg(F.count(F.lit(1)).alias("rejected")).join(some, reason)


def nearest_rank(rows: DataFrame, key: str, value: str, share: float, accuracy: int = 10_000) -> DataFrame:
    """The value at rank ``ceil(share * n)`` of each key, exactly; nulls don't count.

    A mergeable sketch gives two values between which that rank lies, as it errs by
    ``n / accuracy`` ranks at most. A second pass counts what lies below them and
    each value between them, so only those few are ranked.
    """
    left = rows.where(F.col(value).isNotNull()).select(F.col(key).alias("key"), F.col(value).alias("value"))
    margin = 2 / accuracy
    sides = F.percentile_approx("value", F.array(F.lit(max(0.0, share - margin)), F.lit(min(1.0, share + margin))), F.lit(accuracy))
    sketch = left.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) * F.lit(share)), F.lit(1)).alias("rank"), sides.alias("sides"))
    sketch = sketch.withColumnRenamed("key", "of").withColumn("low", F.get("sides", F.lit(0))).withColumn("high", F.get("sides", F.lit(1)))
    placed = left.join(sketch, F.col("key").eqNullSafe(F.col("of"))).where(F.col("value") <= F.col("high"))
    counts = placed.groupBy("key", F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.first("rank").alias("rank"))
    # What lies below is the null value and comes first.
    upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("key").orderBy(F.col("value").asc_nulls_first())))
    return upto.where(F.col("value").isNotNull() & (F.col("upto") >= F.col("rank"))).groupBy(F.col("key").alias(key)).agg(F.min("value").alias("value"))


def projection(samples: DataFrame, key: str, time: str, size: str, days: int = 30) -> DataFrame:
    """Growth over the sampled span carried on for some days."""
    seconds = F.greatest(F.timestamp_diff("SECOND", F.min(time), F.max(time)), F.lit(1))
    return samples.groupBy(key).agg((F.sum(size).cast("double") / seconds * 86_400 * days).alias("projected"))


def pressure(size: Column, queue: Column, warn: tuple[int, int], critical: tuple[int, int]) -> tuple[Column, Column]:
    """critical, warning or normal by the worse of two measures, and which measures are over their warning."""
    sources = F.array_compact(F.array(F.when(size >= warn[0], F.lit("size")), F.when(queue >= warn[1], F.lit("queue"))))
    state = F.when((size >= critical[0]) | (queue >= critical[1]), "critical").when(F.size(sources) > 0, "warning").otherwise("normal")
    return state, sources


def connection_stats(rows: DataFrame, key: str, time: str, order: str, value: str) -> DataFrame:
    at = F.struct(time, order)
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("messages"), F.min(time).alias("first_at"), F.max(time).alias("last_at"), F.min_by(value, at).alias("first_value"), F.max_by(value, at).alias("last_value"))


def open_degradations(raised: DataFrame, resolved: DataFrame, key: str) -> DataFrame:
    return raised.join(resolved.select(key).distinct(), key, "left_anti")


def resolve_degradations(raised: DataFrame, signals: DataFrame, runs: DataFrame, parts: int = 1) -> DataFrame:
    """``raised`` with ``resolved_at``, the first all-clear at or after it that concerns it; null: still open.

    raised: event_id (unique), run_id, reason, record_id, raised_at. signals: kind, run_id,
    record_id, at; ``record`` clears a record's timeout, ``transient`` the passing troubles
    of its own run (no run: of those without one) and of runs of the same job that have
    finished by then, ``optional`` what was shed under pressure. runs: run_id (unique),
    job_type, finished_at (null: running). Signals without a time are passed over, and a
    degradation without one stays open.

    Each degradation asks under up to three keys, each signal answers under one or two,
    and the answer is an as-of join on mirrored time, so nothing is paired; all of
    ``optional`` is one key, which ``parts`` spreads.
    """
    known = runs.select(F.col("run_id").alias("known_run"), "job_type", "finished_at")
    of_run = F.col("run_id") == F.col("known_run")
    named = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    own, job = F.coalesce(named("run", "run_id"), F.lit("no run")), named("job", "job_type")
    passing = F.col("reason").isin(*TRANSIENT)
    asks = (
        F.when(F.col("reason").isin(*RECORD), F.struct(named("record", "record_id").alias("key"), F.col("raised_at").alias("since"))),
        F.when(passing, F.struct(own.alias("key"), F.col("raised_at").alias("since"))),
        F.when(passing & F.col("finished_at").isNotNull(), F.struct(job.alias("key"), F.greatest("raised_at", "finished_at").alias("since"))),
        F.when(F.col("reason").isin(*OPTIONAL), F.struct(F.lit("optional").alias("key"), F.col("raised_at").alias("since"))),
    )
    whole = F.struct(*raised.columns)
    asked = raised.join(known, of_run, "left").select(F.col("event_id").alias("event"), whole.alias("row"), F.inline_outer(F.array_compact(F.array(*asks))))
    asked = asked.withColumn("since", F.when(F.col("row.raised_at").isNotNull(), -s.micros(F.col("since"))))
    kind = F.col("kind")
    answers = F.array(F.when(kind == "record", named("record", "record_id")), F.when(kind == "transient", own), F.when(kind == "transient", job), F.when(kind == "optional", F.lit("optional")))
    told = signals.where(F.col("at").isNotNull()).join(known, of_run, "left").select("at", F.explode(F.array_compact(answers)).alias("key"), (-s.micros(F.col("at"))).alias("mirrored"))
    askable = F.col("key").isNotNull() & F.col("since").isNotNull()
    met = last_before(asked.where(askable), told, ["key"], "since", "mirrored", ["at"], ["at"], parts)
    met = met.select("event", "row", "at").unionByName(asked.where(~askable).select("event", "row", F.lit(None).cast(signals.schema["at"].dataType).alias("at")))
    return met.groupBy("event").agg(F.any_value("row").alias("row"), F.min("at").alias("resolved_at")).select("row.*", "resolved_at")


def nested_total(document: Column) -> Column:
    """The sum of all whole numbers of a JSON document, at any depth; text that is no JSON has none.

    Texts, field names among them, are blanked first; what is left of digits are
    numbers. Fractions, exponents and booleans don't count. One expression, no recursion.
    """
    bare = F.regexp_replace(document, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "")
    found = F.filter(F.regexp_extract_all(bare, F.lit(r"(-?\d[\d.eE+-]*)"), F.lit(1)), lambda x: x.rlike(r"^-?\d+$"))
    zero = F.lit(0).cast("decimal(38,0)")
    total = F.aggregate(found, zero, lambda a, x: (a + x.try_cast("decimal(38,0)")).cast("decimal(38,0)"))
    return F.when(F.try_parse_json(document).isNotNull(), total).otherwise(zero)


def run_results(runs: DataFrame, document: str, flags: tuple[str, ...] = PARTIAL) -> DataFrame:
    """Adds ``processed``, the sum of a run's nested counters, and ``status``: partial if any of its ``flags`` (paths) is set, else completed."""
    raised = F.lit(False)
    for path in flags:
        value = F.get_json_object(document, f"$.{path}")
        raised = raised | F.coalesce(~value.isin("", "false", "[]", "{}") & (value.try_cast("double").isNull() | (value.try_cast("double") != 0)), F.lit(False))
    return runs.withColumns({"processed": nested_total(F.col(document)), "status": F.when(raised, "partial").otherwise("completed")})


def violations(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """``key, rule`` of every broken rule, all rules in one pass; a rule that is null isn't broken."""
    broken = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()]))
    return rows.select(key, F.explode(broken).alias("rule"))


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Natural keys that occur more than once; nulls count as equal."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def dangling(rows: DataFrame, key: list[str], parent: DataFrame) -> DataFrame:
    """Rows whose non-null key isn't in the parent."""
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    return rows.where(whole).join(parent, key, "left_anti")


def overlapping_versions(versions: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Intervals that the next one of the same key begins inside, or that are open though another follows."""
    following = F.lead(start).over(Window.partitionBy(*key).orderBy(start))
    return versions.withColumn("next_start", following).where(F.col("next_start").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("next_start"))))


def page_state(rows: DataFrame, page: str, ok: Column, cursor: str) -> DataFrame:
    """A page with a malformed row fails whole; a page whose content repeats another's is marked."""
    pages = rows.groupBy(page).agg(F.bool_and(ok).alias("complete"), F.max(cursor).alias("cursor"))
    seen = pages.groupBy("cursor").agg(F.min(page).alias("__first"))
    return pages.join(seen, "cursor").select(page, "complete", (F.col(page) != F.col("__first")).alias("repeated"))


def unsaturated_windows(rows: DataFrame, key: str, micros: str, span: int, limit: int, smallest: int) -> DataFrame:
    """The largest halvings of a time span in which fewer than ``limit`` rows lie; at ``smallest`` a full one is marked.

    Rows are counted once, in the narrowest windows; each count is added to all the
    windows around it, whose numbers are shifts of its own. A window is chosen if it
    isn't full while its parent is, and the parent holds what it and its sibling do.
    The span is taken as a power of two times the narrowest width.
    """
    levels = 1
    while (span >> levels) >= smallest:
        levels += 1
    width = span >> (levels - 1)
    finest = rows.groupBy(key, F.floor(F.col(micros) / width).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    around = finest.select(key, "slot", "n", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("up"))
    counts = around.groupBy(key, "up", F.expr("shiftright(slot, up)").alias("slot")).agg(F.sum("n").alias("n"))
    family = Window.partitionBy(key, "up", F.shiftright("slot", 1))
    chosen = counts.withColumn("parent", F.sum("n").over(family)).where((F.col("up") == levels - 1) | (F.col("parent") >= limit)).where((F.col("n") < limit) | (F.col("up") == 0))
    size = F.expr(f"shiftleft({width}L, up)")
    return chosen.select(key, (F.col("slot") * size).alias("start"), size.alias("width"), "n", (F.col("n") >= limit).alias("saturated"))
