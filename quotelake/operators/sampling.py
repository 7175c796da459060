"""Change-driven sampling and gap accounting over tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.scalars import micros
from .names import fresh


def suppress_unchanged(rows: DataFrame, key: list[str], order: list[str], value: str, seconds: int) -> DataFrame:
    """Drops a row equal to the last one kept unless ``seconds`` have passed since that.

    A change is always kept, and so is a row that follows the one before it by the
    interval or more: a window finds these. Between them, each kept row decides
    the next one; the rows of a key pass in order, batch by batch, and only the
    last kept time is held. A row without time is never dropped.
    """
    us, start = fresh(rows, "us", "start")
    timed = F.col(order[0]).isNotNull()
    untimed, rows = rows.where(~timed), rows.where(timed)
    at = Window.partitionBy(*key).orderBy(*order)
    step = seconds * 1_000_000
    rows = rows.withColumn(us, micros(F.col(order[0])))
    starts = ~F.col(value).eqNullSafe(F.lag(value).over(at)) | (F.col(us) - F.lag(us).over(at) >= step) | (F.row_number().over(at) == 1)
    rows = rows.withColumn(start, F.coalesce(starts, F.lit(True)))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = 0
        for batch in batches:
            time = batch.column(us).to_numpy(zero_copy_only=False)
            begins = np.flatnonzero(batch.column(start).to_numpy(zero_copy_only=False))
            kept = np.zeros(len(time), bool)
            kept[begins] = True
            for a, b in zip(np.concatenate([[-1], begins]), np.append(begins, len(time)), strict=True):
                i, last = a + 1, int(time[a]) if a >= 0 else last
                while (i := i + int(np.searchsorted(time[i:b], last + step))) < b:
                    kept[i], last = True, int(time[i])
            yield batch.filter(pa.array(kept))

    # The window has dealt and sorted the rows already; the sort costs nothing.
    return rows.sortWithinPartitions(*key, *order).mapInArrow(pick, rows.schema).drop(us, start).unionByName(untimed)


@dataclass(frozen=True)
class Rule:
    """When books are observed, in microseconds: they are looked at on a grid; ``full`` ones are given again after ``full``,
    ``sampled`` ones after ``sampled`` if they changed since they were last given, else after ``heartbeat``."""

    grid: int
    full: int
    sampled: int
    heartbeat: int

    @classmethod
    def seconds(cls, grid: int = 30, full: int = 300, sampled: int = 30, heartbeat: int = 900) -> Rule:
        return cls(grid * 1_000_000, full * 1_000_000, sampled * 1_000_000, heartbeat * 1_000_000)


class Observed:
    """A book as it stands, ``shown``: (since when, state, tier or None if it isn't observed), and what was given ``last``: (when, state)."""

    def __init__(self, shown: tuple | None, last: tuple | None):
        self.shown, self.last = shown, last

    def due(self, start: int, rule: Rule) -> int | None:
        """The first tick from ``start`` on at which the book is given if it stays as it is."""
        if not self.shown or self.shown[2] not in ("full", "sampled"):
            return None
        at = max(start, self.shown[0])
        if self.last:
            wait = rule.full if self.shown[2] == "full" else rule.heartbeat if self.last[1] == self.shown[1] else rule.sampled
            at = max(at, self.last[0] + wait)
        return -(-at // rule.grid) * rule.grid


def observe(book: Observed, until: int, then: tuple | None, rule: Rule) -> list[tuple]:
    """``(tick, state, kind)`` of the ticks before ``until``, from when the book is shown ``then``."""
    out = []
    start = book.last[0] + 1 if book.last else 0
    while (tick := book.due(start, rule)) is not None and tick < until:
        _, state, tier = book.shown
        kind = "periodic_hot" if tier == "full" else "heartbeat" if book.last and book.last[1] == state else "change"
        out.append((tick, state, kind))
        book.last, start = (tick, state), tick + 1
    book.shown = then
    return out


def book_states(changes: DataFrame, key: list[str]) -> DataFrame:
    """The state of each book after each of its changes (see ``streaming.ordered.ObserveBooks``): ``key, us, seq, tier, observed`` and the five parts.

    ``observed`` is false while the book isn't valid or is crossed.
    """
    order = Window.partitionBy(*key).orderBy("us", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    newest = lambda c: F.last(c, ignorenulls=True).over(order)
    total = lambda c, kind: F.sum(F.coalesce(c, F.lit(0))).over(order).cast(kind)
    bid, ask = newest("bid"), newest("ask")
    observed = F.coalesce(newest("valid"), F.lit(False)) & F.coalesce(ask >= bid, F.lit(True))
    return changes.select(*key, "us", "seq", newest("tier").alias("tier"), observed.alias("observed"), total("revises", "long").alias("revision"), newest("price").alias("price"), total("trades", "long").alias("trades"), total("volume", "decimal(38,6)").alias("volume"), total("updates", "long").alias("updates"))


PARTS = ["revision", "price", "trades", "volume", "updates"]


def observe_books(states: DataFrame, key: list[str], until: int, rule: Rule) -> DataFrame:
    """``key, tick, kind`` and the five parts of every observation up to ``until`` (microseconds): the batch twin of the stream.

    states: what ``book_states`` gives. A book's rows pass in order, batch by
    batch; only how it stands and what was given last is held.
    """
    kinds = dict(states.dtypes)
    schema = ", ".join([*(f"{k} {kinds[k]}" for k in key), "tick long", "kind string", *(f"{p} {kinds[p]}" for p in PARTS)])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, book = None, Observed(None, None)
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            out = []
            rows = zip(zip(*[columns[k] for k in key], strict=True), columns["us"], columns["observed"], columns["tier"], zip(*[columns[p] for p in PARTS], strict=True), strict=True)
            for of, us, observed, tier, state in rows:
                if of != now:
                    out += [(*now, t, kind, *s) for t, s, kind in observe(book, until + 1, None, rule)] if now else []
                    now, book = of, Observed(None, None)
                out += [(*of, t, kind, *s) for t, s, kind in observe(book, min(us, until + 1), (us, state, tier if observed else None), rule)]
            yield frame(out)
        if now:
            yield frame([(*now, t, kind, *s) for t, s, kind in observe(book, until + 1, None, rule)])

    arrow = to_arrow_schema(states.sparkSession.createDataFrame([], schema).schema)

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    rows = states.where(F.col("us").isNotNull()).repartition(*key).sortWithinPartitions(*key, "us", "seq")
    return rows.mapInArrow(walk, schema)


def observe_on_change(rows: DataFrame, key: list[str], tick: str, state: str, heartbeat: int) -> DataFrame:
    """Of states on a grid of ticks, changes since the tick before and heartbeats: ``key, tick, state, kind``."""
    at = Window.partitionBy(*key).orderBy(tick)
    changed = ~F.col(state).eqNullSafe(F.lag(state).over(at)) | (F.row_number().over(at) == 1)
    rows = rows.withColumn("kind", F.when(changed, "change").otherwise("heartbeat"))
    return suppress_unchanged(rows, key, [tick], state, heartbeat).select(*key, tick, state, "kind")


def sequence_gaps(rows: DataFrame, key: str, order: list[str], seq: str) -> DataFrame:
    """Jumps of a sequence: ``expected, actual`` and, forward, how many are missing."""
    expected = F.lag(seq).over(Window.partitionBy(key).orderBy(*order)) + 1
    rows = rows.select(key, expected.alias("expected"), F.col(seq).alias("actual")).where(F.col("expected").isNotNull() & (F.col("actual") != F.col("expected")))
    return rows.withColumn("missing", F.when(F.col("actual") > F.col("expected"), F.col("actual") - F.col("expected")))


def connection_gaps(rows: DataFrame, key: str, time: str, order: str, opens: Column, resolves: Column) -> DataFrame:
    """Each opening with the first resolving row after it, null while it is open."""
    after = Window.partitionBy(key).orderBy(time, order).rowsBetween(1, Window.unboundedFollowing)
    rows = rows.where(opens | resolves).withColumn("resolved_at", F.min(F.when(resolves, F.col(time))).over(after)).withColumn("__opens", opens)
    return rows.where("__opens").select(key, F.col(time).alias("opened_at"), "resolved_at")
