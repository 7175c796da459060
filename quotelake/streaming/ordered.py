"""Stateful streams that apply a key's rows in their own order, whatever order they land in.

Rows wait in state until the watermark has passed them, then they are applied
sorted. A row that lands after the watermark has passed it is given back as ``late``
with the micro-batch that found it, so that nothing vanishes. Timers on event time
release what waits and give what is due by time alone, so a key needs no new rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.sampling import Observed, Rule, observe


def plain(rows: Iterator[Row], columns: list[tuple[str, str]]) -> list[tuple]:
    """The columns (name, type) of rows as tuples."""
    out: list[tuple] = []
    at: list[int] = []
    for row in rows:
        at = at or [row.__fields__.index(name) for name, _ in columns]
        out.append(tuple([row[i] for i in at]))
    return out


class Ordered(StatefulProcessor):
    """Base of processors over rows of ``us`` (microseconds), ``seq`` and other columns.

    columns: (name, type) of the rows beside the key, ``us`` and ``seq`` first;
    given: names of what ``apply`` gives after the key, ``us``, ``seq`` and
    ``change``. A null ``us`` counts as late.
    """

    key: list[str]
    columns: list[tuple[str, str]]
    given: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # One value with an array a column: a list would be sent and parsed row by row, each with its schema.
        self.held = handle.getValueState("held", ", ".join(f"{n} array<{t}>" for n, t in self.columns))
        self.out = Row(*self.key, "us", "seq", "change", *self.given)
        self.start(handle)

    def start(self, handle: StatefulProcessorHandle) -> None:
        """Declares the state of the processor itself."""

    def apply(self, key: tuple, rows: list[tuple], mark: int) -> list[tuple]:
        """Applies rows in order and does what is due before ``mark``; gives (us, seq, change, *given)."""
        raise NotImplementedError

    def due(self) -> int | None:
        """When there is something to give though no row comes, in microseconds."""
        return None

    def _work(self, key: tuple, new: list[tuple], mark: int) -> Iterator[Row]:
        late = [r for r in new if r[0] is None or r[0] < mark]
        stored = self.held.get()
        held = [*zip(*stored, strict=True)] if stored else []
        held += [r for r in new if r[0] is not None and r[0] >= mark]
        ripe = sorted((r for r in held if r[0] < mark), key=lambda r: (r[0], r[1] is None, r[1] or 0))
        waiting = [r for r in held if r[0] >= mark]
        if waiting and (ripe or len(new) > len(late)):
            self.held.update(tuple(list(c) for c in zip(*waiting, strict=True)))
        elif stored and not waiting:
            self.held.clear()
        out = [(r[0], r[1], "late", *[None] * len(self.given)) for r in late] + self.apply(key, ripe, mark)
        next_at = min((t for t in (min((r[0] for r in waiting), default=None), self.due()) if t is not None), default=None)
        if next_at is not None:
            self.handle.registerTimer(max(next_at, mark) // 1000 + 1)  # one that stands at the watermark fires, and goes when it has
        for r in out:
            yield self.out(*key, *r)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self._work(key, plain(rows, self.columns), 1000 * timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._work(key, [], 1000 * timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


class SequenceGaps(Ordered):
    """Jumps of each key's sequence: ``gap`` rows with ``expected, actual`` and, forward, how many are ``missing``. Rows without a number are passed over."""

    def __init__(self, key: list[str]):
        self.key, self.columns, self.given = key, [("us", "long"), ("seq", "long")], ["expected", "actual", "missing"]

    def start(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "seq long")

    def apply(self, key: tuple, rows: list[tuple], mark: int) -> list[tuple]:
        before = self.last.get() if rows else None
        last, out = before[0] if before else None, []
        for us, seq in rows:
            if seq is None:
                continue
            if last is not None and seq != last + 1:
                out.append((us, seq, "gap", last + 1, seq, seq - last - 1 if seq > last + 1 else None))
            last = seq
        if rows and last is not None:
            self.last.update((last,))
        return out


class ConnectionGaps(Ordered):
    """Gaps of a connection: ``open`` rows at its disconnects, ``resolved`` rows for all open ones at the next confirmation.

    Rows have ``event``: ``disconnect``, ``planned`` (opens nothing) or ``confirm``.
    """

    def __init__(self, key: list[str]):
        self.key, self.columns, self.given = key, [("us", "long"), ("seq", "long"), ("event", "string")], ["opened_us", "resolved_us"]

    def start(self, handle: StatefulProcessorHandle) -> None:
        self.opened = handle.getListState("opened", "us long, seq long")

    def apply(self, key: tuple, rows: list[tuple], mark: int) -> list[tuple]:
        if not rows:
            return []
        before = [tuple(r) for r in self.opened.get()] if self.opened.exists() else []
        opened, out = list(before), []
        for us, seq, event in rows:
            if event == "disconnect":
                opened.append((us, seq))
                out.append((us, seq, "open", us, None))
            elif event == "confirm":
                out += [(a, s, "resolved", a, us) for a, s in opened]
                opened = []
        if opened != before:
            self.opened.put(opened) if opened else self.opened.clear()
        return out


class ObserveBooks(Ordered):
    """Observations of books by ``Rule``, also when nothing changes: a timer stands at each next due tick.

    Rows change a book: ``revises`` counts revisions; ``valid, bid, ask, price,
    tier`` replace what was, if not null; ``trades, volume, updates`` add. A row
    with tier ``closed`` ends the book and its state.
    """

    CHANGES = [("us", "long"), ("seq", "long"), ("revises", "long"), ("valid", "boolean"), ("bid", "decimal(18,6)"), ("ask", "decimal(18,6)"), ("price", "decimal(18,6)"), ("trades", "long"), ("volume", "decimal(38,6)"), ("updates", "long"), ("tier", "string")]
    PARTS = [("revision", "long"), ("price", "decimal(18,6)"), ("trades", "long"), ("volume", "decimal(38,6)"), ("updates", "long")]

    def __init__(self, key: list[str], rule: Rule):
        self.key, self.rule, self.columns = key, rule, self.CHANGES
        self.given = [n for n, _ in self.PARTS]

    def start(self, handle: StatefulProcessorHandle) -> None:
        parts, given = (", ".join(f"{p}{n} {t}" for n, t in self.PARTS) for p in ("", "given_"))
        self.state = handle.getValueState("book", f"us long, valid boolean, bid decimal(18,6), ask decimal(18,6), tier string, {parts}, given_us long, {given}")
        self.next = None

    def apply(self, key: tuple, rows: list[tuple], mark: int) -> list[tuple]:
        self.next = None
        before, width = self.state.get(), 5 + len(self.PARTS)
        book = before[:width] if before else None
        last = before[width:] if before and before[width] is not None else None
        seen = Observed(book and self._shown(book), last and (last[0], last[1:]))
        out = []
        for row in rows:
            book = self._changed(book, row)
            out += observe(seen, row[0], None if book is None else self._shown(book), self.rule)
            if book is None:
                seen = Observed(None, None)
        out += observe(seen, mark, seen.shown, self.rule)
        if book is None:
            if before:
                self.state.clear()
            return [(tick, None, kind, *state) for tick, state, kind in out]
        after = (*book, seen.last[0], *seen.last[1]) if seen.last else (*book, *[None] * (1 + len(self.PARTS)))
        if after != before:
            self.state.update(after)
        self.next = seen.due(mark, self.rule)
        return [(tick, None, kind, *state) for tick, state, kind in out]

    def due(self) -> int | None:
        return self.next

    @staticmethod
    def _changed(book: tuple | None, row: tuple) -> tuple | None:
        us, _, revises, valid, bid, ask, price, trades, volume, updates, tier = row
        if tier == "closed":
            return None
        _, valid0, bid0, ask0, tier0, revision0, price0, trades0, volume0, updates0 = book or (us, False, None, None, None, 0, None, 0, Decimal(0), 0)
        new = lambda value, old: old if value is None else value
        return (us, new(valid, valid0), new(bid, bid0), new(ask, ask0), new(tier, tier0), revision0 + (revises or 0), new(price, price0), trades0 + (trades or 0), volume0 + (volume or Decimal(0)), updates0 + (updates or 0))

    @staticmethod
    def _shown(book: tuple) -> tuple:
        us, valid, bid, ask, tier, *state = book
        crossed = bid is not None and ask is not None and ask < bid
        return us, tuple(state), tier if valid and not crossed else None


def by_event_time(stream: DataFrame, processor: Ordered, schema: str, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Runs an ordered processor; rows whose key holds a null only move the watermark. ``time``: the column of event time, to which the watermark belongs; ``schema``: of what the processor gives beside key, ``us, seq, change``."""
    kinds = dict(stream.dtypes)
    keys = ", ".join(f"{k} {kinds[k]}" for k in processor.key)
    known = F.lit(True)
    for k in processor.key:
        known = known & F.col(k).isNotNull()
    # A condition that isn't deterministic stays above the watermark, which so sees all rows. Late rows must reach the
    # processor, so the column that the watermark stands on doesn't go with them.
    rows = stream.withWatermark(time, delay).where(F.when(F.spark_partition_id() >= 0, known)).select(*processor.key, *[n for n, _ in processor.columns])
    return rows.groupBy(*processor.key).transformWithState(statefulProcessor=processor, outputStructType=f"{keys}, us long, seq long, change string, {schema}", outputMode="Append", timeMode="EventTime")
