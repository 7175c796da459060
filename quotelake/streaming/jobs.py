"""Structured Streaming jobs. Each gives what its batch twin gives over the same rows.

Sinks are keyed and idempotent: a micro-batch appends its rows with its number,
and the newest row of a key counts, so a batch that is run again after a failure
changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.book import BUY, DELETE, DELTA, SELL

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def landed(spark: SparkSession, folder: str, file_glob: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the Parquet files in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(folder)


Sink = Callable[[DataFrame], DataFrame]


def run_to_sinks(stream: DataFrame, path: str, sinks: dict[str, Sink], mode: str = "append") -> dict[str, DataFrame]:
    """Runs the stream over all that has landed since its last stop, each micro-batch into several sinks; returns each sink's rows with their ``batch`` number.

    A sink takes what its function gives of the batch and writes it under the
    batch's number, over what an earlier try of that batch may have left, so a batch
    that runs twice gives each row once in each sink, also if the first try stopped
    between two of them. The checkpoint below ``path`` keeps offsets and state, so a
    later call goes on where the last one stopped.
    """
    spark = stream.sparkSession

    def save(rows: DataFrame, batch: int) -> None:
        if len(sinks) > 1:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, give in sinks.items():
                give(rows).withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{path}/{name}/part={batch}")
        finally:
            if len(sinks) > 1:
                rows.unpersist()

    old = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, STATE_STORE)
    try:
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(PROVIDER, old) if old else spark.conf.unset(PROVIDER)
    out, nothing = {}, spark.createDataFrame([], stream.schema)
    for name, give in sinks.items():
        empty = give(nothing).withColumn("batch", F.lit(0)).limit(0)
        empty.write.mode("ignore").parquet(f"{path}/{name}/part=-1")  # a sink that nothing has reached yet reads as empty
        out[name] = spark.read.schema(empty.schema).option("basePath", f"{path}/{name}").parquet(f"{path}/{name}").select(*empty.columns)
    return out


def run_to_end(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """``run_to_sinks`` with one sink of all rows."""
    return run_to_sinks(stream, path, {"rows": lambda rows: rows}, mode)["rows"]


def newest(rows: DataFrame, key: list[str]) -> DataFrame:
    names = [c for c in rows.columns if c != "batch"]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*names), "batch").alias("row")).select("row.*")


def minute_counters(stream: DataFrame, key: str, delay: str = "10 minutes") -> DataFrame:
    """Rows of each key a minute; state of a minute goes once the watermark has passed it."""
    window = F.window("ts", "1 minute")
    return stream.withWatermark("ts", delay).groupBy(window.alias("w"), key).agg(F.count(F.lit(1)).alias("messages")).select(F.col("w.start").alias("minute"), key, "messages")


def rolling_activity(stream: DataFrame, key: str, length: str, slide: str, delay: str = "1 hour") -> DataFrame:
    """Counts of each key in sliding windows."""
    return stream.withWatermark("ts", delay).groupBy(F.window("ts", length, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.end").alias("window_end"), key, "n")


def dedup(stream: DataFrame, key: list[str], delay: str) -> DataFrame:
    """Each key once within the delay."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(key)


def route(rows: DataFrame, tiers: DataFrame, pressure: Column) -> DataFrame:
    """Adds ``to_archive`` and ``to_hot`` to rows of (kind, market, closing, archive_only); tiers: the current table, read anew each batch."""
    rows = rows.join(tiers.select(F.col("external_id").alias("market"), "tier"), "market", "left")
    full, kind = F.coalesce(F.col("tier") == "full", F.lit(False)), F.col("kind")
    critical = pressure == "critical"
    archive = F.when(kind == "update", full).when(kind == "snapshot", full | F.col("closing")).when(kind == "observation", F.coalesce(F.col("tier") == "sampled", F.lit(False))).when(kind.isin("raw_body", "reference"), True).otherwise(False)
    hot = F.when(kind == "snapshot", ~F.col("archive_only")).when(kind.isin("observation", "reference"), ~critical).when(kind == "raw_body", False).otherwise(True)
    return rows.withColumns({"to_archive": archive, "to_hot": hot})


def in_order(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """A key's rows of one micro-batch, sorted; ``files_per_batch`` bounds them."""
    return pd.concat(list(rows)).sort_values(order)


class SuppressUnchanged(StatefulProcessor):
    """Keeps a row unless it equals the last kept one and ``seconds`` haven't passed.

    time: microseconds; order: columns that make the order total after it; kept:
    what is given of a row, with ``late``: true of a row that isn't after the last
    one seen, or without time, which is given but changes nothing. The state has the
    last kept row's time and value and the last seen order key. Under a watermark it
    ends once it can't matter: any row that comes ``seconds`` after the last kept one
    is kept, and an older one is late.
    """

    def __init__(self, seconds: int, key: list[str], time: str, order: list[str], value: str, kept: list[str], value_type: str = "string", order_type: str = "long", watched: bool = False):
        self.watched = watched  # whether there is a watermark, and so timers
        self.step, self.key, self.time, self.order, self.value, self.kept = seconds * 1_000_000, key, time, order, value, kept
        self.schema = f"us long, value {value_type}, seen_us long, " + ", ".join(f"seen{i} {order_type}" for i in range(len(order)))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows, [self.time, *self.order])
        mark = 1000 * timerValues.getCurrentWatermarkInMs()
        state = self.last.get() if self.last.exists() else None
        us, value, seen = (state[0], state[1], tuple(state[2:])) if state else (None, None, None)
        kept, late = [], []
        places = zip(*(frame[c].tolist() for c in [self.time, *self.order]), strict=True)
        for i, (place, x) in enumerate(zip(places, frame[self.value].tolist(), strict=True)):
            if pd.isna(place[0]) or (seen is not None and place <= seen) or (seen is None and place[0] < mark):
                late.append(i)
                continue
            seen = place
            if us is None or x != value or place[0] - us >= self.step:
                us, value = place[0], x
                kept.append(i)
        if seen is not None:
            self.last.update((us, value, *seen))
            if timerValues.getCurrentWatermarkInMs() >= 0 and self.watched:
                self.handle.registerTimer(max(us + self.step, seen[0]) // 1000 + 1)
        out = frame.iloc[[*kept, *late]][self.kept].assign(late=[False] * len(kept) + [True] * len(late))
        for i, c in reversed(list(enumerate(self.key))):
            out.insert(0, c, key[i])
        yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.last.exists():
            us, _, seen, *_ = self.last.get()
            if max(us + self.step, seen) < 1000 * timerValues.getCurrentWatermarkInMs():
                self.last.clear()
        yield from ()

    def close(self) -> None:
        pass


BOOK_CHANGES = "token_key long, epoch long, us long, seq long, change string, side int, price decimal(18,6), size decimal(38,6)"
SNAPSHOT, CHANGE, RESOLVE, DISCONNECT = 0, 1, 2, 3


class CurrentBook(StatefulProcessor):
    """A token's book: levels in a map state, epoch and the last applied order key in a value state.

    Rows have ``us, kind, seq``; a snapshot (kind 0) has ``levels``, an array of
    (side, price, size), of which the last usable one of a place counts; a change
    (kind 1) has ``side, price, action, x``; a resolving frame (kind 2) closes the
    book as it stands; after a disconnect (kind 3) the book isn't valid and takes
    no change until the next snapshot. Rows at or before the last applied one, and
    rows without time, change nothing; a snapshot without levels empties the book.

    Given of a micro-batch (``BOOK_CHANGES``): a ``head`` row (``invalid`` after a
    disconnect), ``level`` rows of the places that changed (size 0: gone) in the
    epoch it ends in, for each resolving frame of a valid book the ``closing``
    rows of all levels, with a ``closed`` row, and a ``late`` row for each row that
    changes nothing because it came too late.

    grace: under a watermark, a token's state ends so many seconds after its
    resolving frame, unless a snapshot has begun it anew; rows of the token that are
    older than the watermark are late from then on.
    """

    def __init__(self, grace: int | None = None):
        self.grace = grace

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "side int, price decimal(18,6)", "size decimal(38,6)")
        self.head = handle.getValueState("head", "epoch long, valid boolean, us long, kind int, seq long, ends long")
        self.handle = handle

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows, ["us", "kind", "seq"])
        first, valid, *last, ends = self.head.get() if self.head.exists() else (0, False, -1, 0, 0, None)
        epoch, last = first, tuple(last)
        mark = 0 if self.grace is None or self.head.exists() else 1000 * timerValues.getCurrentWatermarkInMs()
        before = {tuple(k): v[0] for k, v in self.levels.iterator()} if epoch else {}
        book, out = dict(before), []
        for us, kind, seq, levels, side, price, action, x in zip(*(frame[c].tolist() for c in ("us", "kind", "seq", "levels", "side", "price", "action", "x")), strict=True):
            if pd.isna(us) or (us, kind, seq) <= last or us < mark:
                out.append((*key, epoch, None if pd.isna(us) else us, seq, "late", 0, None, None))
                continue
            last = (us, kind, seq)
            side, action = (None if pd.isna(v) else int(v) for v in (side, action))  # pandas holds integers with gaps as floats
            if kind == SNAPSHOT:
                ends = None
                epoch, valid, book = epoch + 1, True, {(v["side"], v["price"]): v["size"] for v in ([] if levels is None else levels) if v["size"] and v["size"] > 0 and v["price"] is not None and v["side"] in (BUY, SELL)}
            elif kind == DISCONNECT:
                valid = False
            elif kind == RESOLVE:
                if self.grace is not None:
                    ends = us + 1_000_000 * self.grace
                    self.handle.registerTimer(ends // 1000 + 1)
                if valid:
                    out += [(*key, epoch, us, seq, "closing", s, p, n) for (s, p), n in book.items()] + [(*key, epoch, us, seq, "closed", 0, None, None)]
            elif valid and side in (BUY, SELL) and price is not None and (action == DELETE or x is not None):
                size = book.get((side, price), Decimal(0)) + x if action == DELTA else Decimal(0) if action == DELETE else x
                book.pop((side, price), None) if size <= 0 else book.__setitem__((side, price), size)
        if last[0] < 0:  # nothing was applied
            yield pd.DataFrame(out, columns=["token_key", "epoch", "us", "seq", "change", "side", "price", "size"])
            return
        self.head.update((epoch, valid, *last, ends))
        gone = before.keys() - book.keys()
        for place in gone:
            self.levels.removeKey(place)
        changed = [place for place, size in book.items() if epoch != first or before.get(place) != size]
        for place in changed:
            if before.get(place) != book[place]:
                self.levels.updateValue(place, (book[place],))
        now = (*key, epoch, *last[::2])
        out += [(*now, "level", s, p, book[s, p]) for s, p in changed]
        if epoch == first:
            out += [(*now, "level", s, p, Decimal(0)) for s, p in gone]
        out.append((*now, "head" if valid else "invalid", 0, None, None))
        yield pd.DataFrame(out, columns=["token_key", "epoch", "us", "seq", "change", "side", "price", "size"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.head.exists():
            ends = self.head.get()[5]
            if ends is not None and ends < 1000 * timerValues.getCurrentWatermarkInMs():
                self.levels.clear()
                self.head.clear()
        yield from ()

    def close(self) -> None:
        pass


def current_levels(changes: DataFrame) -> DataFrame:
    """The valid books as they stand after a sink's ``CurrentBook`` rows: ``token_key, epoch, side, price, size``."""
    heads = changes.where(F.col("change").isin("head", "invalid")).groupBy("token_key").agg(F.max_by(F.struct("epoch", "change"), "batch").alias("head"))
    valid = heads.where("head.change = 'head'").select("token_key", "head.epoch")
    last = changes.where("change = 'level'").groupBy("token_key", "epoch", "side", "price").agg(F.max_by("size", "batch").alias("size"))
    return last.join(valid, ["token_key", "epoch"]).where("size > 0")


def closing_levels(changes: DataFrame) -> DataFrame:
    """Each token's levels at its last resolving frame: ``token_key, us, side, price, size``; a book that was empty then gives none."""
    newest = changes.where("change = 'closed'").groupBy("token_key").agg(F.max(F.struct("us", "seq")).alias("at"))
    rows = changes.where("change = 'closing'").join(newest, "token_key").where(F.struct("us", "seq") == F.col("at"))
    return rows.select("token_key", "us", "side", "price", "size")


class TierStay(StatefulProcessor):
    """Tiers that rise at once but fall only after ``seconds`` in a tier; a stored tier and its time seed the state.

    Rows have ``us, seq, wanted``; tiers are numbers, the higher the better. Seeds
    have ``tier, since`` (microseconds) and apply when a stream first starts; after
    a stop, its own state goes on. Given: ``seq, tier, since`` after each row. A row
    that wants nothing (null) ends its market: it gives nothing and the state goes.
    """

    def __init__(self, seconds: int, key: str):
        self.step, self.key = seconds * 1_000_000, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stay = handle.getValueState("stay", "tier int, since long")

    def handleInitialState(self, key, seed: pd.DataFrame, timerValues) -> None:
        newest = seed.sort_values("since").iloc[-1]
        self.stay.update((int(newest["tier"]), int(newest["since"])))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frame = in_order(rows, ["us", "seq"])
        tier, since = self.stay.get() if self.stay.exists() else (None, None)
        out = []
        for us, seq, wanted in zip(*(frame[c].tolist() for c in ("us", "seq", "wanted")), strict=True):
            if pd.isna(wanted):
                tier = since = None
                continue
            wanted = int(wanted)
            if tier is None or wanted > tier or (wanted < tier and us - since >= self.step):
                tier, since = wanted, us
            out.append((*key, seq, tier, since))
        if tier is not None:
            self.stay.update((tier, since))
        elif self.stay.exists():
            self.stay.clear()
        yield pd.DataFrame(out, columns=[self.key, "seq", "tier", "since"])

    def close(self) -> None:
        pass


def stateful(stream: DataFrame, key: list[str], processor: StatefulProcessor, schema: str, seed: DataFrame | None = None, time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """seed: rows for the processor's initial state, of the same key; time: a column of event time, by which the processor's timers go."""
    initial = seed.groupBy(*key) if seed is not None else None
    if time:
        # Late rows must reach the processor, so the column that the watermark stands on doesn't go with them.
        stream = stream.withWatermark(time, delay).drop(time)
    return stream.groupBy(*key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime" if time else "None", initialState=initial)
