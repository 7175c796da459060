"""Versioned history: change detection, intervals, merging of partial rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .names import fresh
from .prefix import Running, running, with_parts

FIRST, CURRENT = Window.unboundedPreceding, Window.currentRow


def digest(*fields: str) -> Column:
    """One digest over the stable fields; nulls differ from empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(f).cast("string")), F.lit("-")) for f in fields]), 256)


def scd2(rows: DataFrame, key: list[str], order: list[str], content: str, carry: list[str] | None = None, newest: list[str] | None = None, parts: int = 1) -> DataFrame:
    """Versions: runs of equal ``content`` in order. Going back to old content makes a new version.

    ``valid_from`` and ``valid_to`` (null: open) from the first of ``order``;
    carry: columns of a version's first row; newest: columns of which a version
    keeps the greatest; parts: of a busy key (see ``prefix``).
    """
    part, change, old = fresh(rows, "part", "change", "old")
    rows = running(with_parts(rows, key, order[0], part, parts), key, order, part, {old: Running("lag", F.col(content))}, parts)
    same = F.col(old).isNotNull() & F.col(content).eqNullSafe(F.col(old)["x"])
    rows = rows.withColumn(change, (~same).cast("long"))
    rows = running(rows, key, order, part, {"version_number": Running("sum", F.col(change))}, parts)
    first = F.struct(*order)
    out = rows.groupBy(*key, "version_number").agg(
        F.first(content).alias(content),
        F.min(order[0]).alias("valid_from"),
        F.max(order[0]).alias("last_observed_at"),
        F.count(F.lit(1)).alias("observations"),
        *[F.min_by(c, first).alias(c) for c in carry or []],
        *[F.max(c).alias(c) for c in newest or []],
    )
    if parts <= 1:
        return out.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy(*key).orderBy("version_number")))
    # The next version is met by its number.
    following = out.select(*[F.col(k).alias(f"next_{k}") for k in key], (F.col("version_number") - 1).alias("next_version"), F.col("valid_from").alias("valid_to"))
    met = F.col("version_number") == F.col("next_version")
    for k in key:
        met = met & F.col(k).eqNullSafe(F.col(f"next_{k}"))
    return out.join(following, met, "left").drop("next_version", *[f"next_{k}" for k in key])


def current_versions(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("valid_to").isNull())


def versions_as_of(versions: DataFrame, at: Column) -> DataFrame:
    return versions.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))


def mark_stale(rows: DataFrame, key: list[str], arrival: list[str], upstream: str, observed: str, parts: int = 1) -> DataFrame:
    """Adds ``stale``: not newer than what came before, by the upstream time if both are known, else by the observed one."""
    part, top, seen = fresh(rows, "part", "top", "seen")
    before = {top: Running("max", F.col(upstream), inclusive=False), seen: Running("max", F.col(observed), inclusive=False)}
    rows = running(with_parts(rows, key, arrival[0], part, parts), key, arrival, part, before, parts)
    known = F.col(upstream).isNotNull() & F.col(top).isNotNull()
    stale = F.coalesce(F.when(known, F.col(upstream) <= F.col(top)).otherwise(F.col(observed) <= F.col(seen)), F.lit(False))
    return rows.withColumn("stale", stale).drop(part, top, seen)


def merge_rows(rows: DataFrame, key: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """One row a key: of each field the last value that is not null."""
    at = F.struct(*order)
    return rows.groupBy(*key).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields])


def drop_unchanged(rows: DataFrame, key: list[str], order: list[str], content: str) -> DataFrame:
    """Rows whose content differs from the row before them of the same key."""
    at = Window.partitionBy(*key).orderBy(*order)
    same = F.col(content).eqNullSafe(F.lag(content).over(at)) & (F.row_number().over(at) > 1)
    return rows.withColumn("__same", same).where(~F.col("__same")).drop("__same")


def stitch_intervals(rows: DataFrame, key: list[str], start: str, tie: str, declared: str) -> DataFrame:
    """Adds ``effective_to``: the declared end, the next start, or the lesser of both."""
    following = F.lead(start).over(Window.partitionBy(*key).orderBy(start, tie))
    return rows.withColumn("effective_to", F.least(F.col(declared), following))


def scheduled_versions(rows: DataFrame, key: list[str], start: str, arrival: list[str], content: str, declared: str, observed: str, source: str) -> DataFrame:
    """Settings announced ahead of time: ``key, start, content, declared, observed, source, revisions, effective_to``.

    One row a key and start; the last to arrive replaces what was announced for that
    start before, be it earlier or later than other starts, and equal content is never
    skipped because of a neighbour. The times of observation and source only grow.
    ``revisions`` counts the arrivals that changed content or declared end. A row without
    a start is no announcement and is left out.
    """
    known = rows.where(F.col(start).isNotNull())
    moved, place = fresh(rows, "moved", "place")
    at = Window.partitionBy(*key, start).orderBy(*arrival)
    now = F.struct(F.col(content), F.col(declared))
    known = known.withColumn(place, F.row_number().over(at)).withColumn(moved, F.coalesce((~now.eqNullSafe(F.lag(now).over(at))).cast("long"), F.lit(1)))
    last = F.max_by(F.struct(content, declared), place)
    out = known.groupBy(*key, start).agg(last.alias(place), F.max(observed).alias(observed), F.max(source).alias(source), F.sum(moved).alias("revisions"))
    out = out.select(*key, start, F.col(f"{place}.{content}").alias(content), F.col(f"{place}.{declared}").alias(declared), observed, source, "revisions")
    return stitch_intervals(out, key, start, start, declared)


def bump_ties(rows: DataFrame, key: list[str], micros: str, order: list[str]) -> DataFrame:
    """Moves a time that isn't after the one before it to 1 µs after it: ``n + max(t - n)`` over the rows so far."""
    at = Window.partitionBy(*key).orderBy(*order)
    n = F.row_number().over(at)
    rows = rows.withColumn("__n", n)
    return rows.withColumn("bumped", F.col("__n") + F.max(F.col(micros) - F.col("__n")).over(at.rowsBetween(FIRST, CURRENT))).drop("__n")


def supersede(runs: DataFrame, job: str, started: str, finished: str, tie: str) -> DataFrame:
    """Adds ``status``: a run is cancelled if the next of its job starts before it finishes."""
    following = F.lead(started).over(Window.partitionBy(job).orderBy(started, tie))
    return runs.withColumn("status", F.when(following.isNotNull() & (F.col(finished).isNull() | (following < F.col(finished))), "cancelled").when(F.col(finished).isNull(), "running").otherwise("completed"))


def merge_json(rows: DataFrame, key: list[str], order: list[str], document: str, allowed: list[str] | None = None) -> DataFrame:
    """``key`` and one JSON object: of each of its fields the value of the last row that has it, nested values whole.

    A field that is null counts as a value; text that is no object, and fields that
    aren't ``allowed``, are passed over; a key of which nothing is left has ``{}``.
    Fields come in alphabetical order. A hot key's rows meet in partial aggregates.
    """
    docs = rows.select(*key, F.struct(*order).alias("at"), F.try_parse_json(F.col(document)).alias("doc"))
    docs = docs.withColumn("doc", F.when(F.schema_of_variant("doc").startswith("OBJECT"), F.col("doc")))
    fields = docs.lateralJoin(docs.sparkSession.tvf.variant_explode_outer(F.col("doc").outer()))
    keep = F.col("key").isNotNull() & (F.col("key").isin(allowed) if allowed is not None else F.lit(True))
    fields = fields.select(*key, "at", F.when(keep, F.col("key")).alias("field"), F.to_json("value").alias("value"))
    last = fields.groupBy(*key, "field").agg(F.max_by("value", "at").alias("value"))
    each = F.when(F.col("field").isNotNull(), F.struct("field", F.coalesce("value", F.lit("null")).alias("value")))
    listed = F.array_sort(F.collect_list(each))
    text = F.transform(listed, lambda x: F.concat(F.lit('"'), F.regexp_replace(x["field"], r'(["\\])', r"\\$1"), F.lit('":'), x["value"]))
    return last.groupBy(*key).agg(F.concat(F.lit("{"), F.array_join(text, ","), F.lit("}")).alias(document))


def apply_patches(patches: DataFrame, known: DataFrame, key: list[str], arrival: list[str], upstream: str, observed: str, document: str, allowed: list[str]) -> DataFrame:
    """The merged documents of known keys from sparse patches: stale patches, unknown keys and fields that aren't allowed change nothing."""
    fresh_ones = mark_stale(patches.join(known.select(*key).distinct(), key, "left_semi"), key, arrival, upstream, observed).where("NOT stale")
    return merge_json(fresh_ones, key, arrival, document, allowed)
