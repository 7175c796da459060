"""Streams by event time: order, timers, ends of state, late rows, several sinks."""

import os
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quotelake.operators import sampling
from quotelake.streaming import jobs, ordered

T0 = datetime(2024, 1, 1)
US0 = 1_704_067_200_000_000
RULE = sampling.Rule.seconds(grid=30, full=300, sampled=30, heartbeat=900)
TICKS = "k string, s double, seq long"


def feed(spark, tmp_path, schema, parts, job, sinks=None):
    """Lands the parts one by one; each row has ``s``, seconds after ``T0``."""
    out = None
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        rows = jobs.landed(spark, f"file://{tmp_path}/in", "*.parquet", schema)
        us = (F.lit(US0) + F.col("s") * 1_000_000).cast("long")
        rows = rows.withColumns({"us": us, "ts": F.timestamp_micros(us)})
        out = jobs.run_to_sinks(job(rows), f"file://{tmp_path}/out", sinks or {"rows": lambda x: x})
    return out


def test_rows_are_judged_in_order_and_late_ones_kept_aside(spark, tmp_path):
    parts = [[("a", 10.0, 3), ("a", 5.0, 1), ("b", 1.0, 7)], [("a", 7.0, 2), ("a", 200.0, 5), (None, 300.0, 9), ("b", 2.0, None)], [("a", 100.0, 4), ("b", 250.0, 8), ("b", 400.0, 10)], [("c", 3000.0, 1)]]
    job = lambda rows: ordered.by_event_time(rows, ordered.SequenceGaps(["k"]), "expected long, actual long, missing long", delay="60 seconds")
    sinks = {"gaps": lambda x: x.where("change = 'gap'"), "late": lambda x: x.where("change = 'late'")}
    out = feed(spark, tmp_path, TICKS, parts, job, sinks)
    # a: 1, 2, 3, 5 (4 came when its time had passed); b: 7, 8, 10; rows of no key only move the time.
    assert sorted((r.k, r.expected, r.actual, r.missing) for r in out["gaps"].collect()) == [("a", 4, 5, 1), ("b", 9, 10, 1)]
    late = out["late"].collect()
    assert [(r.k, r.seq) for r in late] == [("a", 4)]
    assert late[0].batch > 0


def test_connection_gaps_open_and_resolve(spark, tmp_path):
    parts = [[("a", 5.0, 2, "confirm"), ("a", 1.0, 0, "disconnect"), ("a", 2.0, 1, "disconnect")], [("a", 200.0, 4, "planned"), ("a", 150.0, 3, "disconnect"), ("b", 210.0, 1, "confirm")], [("z", 9000.0, 0, None)]]
    job = lambda rows: ordered.by_event_time(rows, ordered.ConnectionGaps(["k"]), "opened_us long, resolved_us long", delay="60 seconds")
    out = feed(spark, tmp_path, "k string, s double, seq long, event string", parts, job)["rows"]
    got = out.groupBy("k", "opened_us").agg(F.max("resolved_us").alias("r")).collect()
    second = lambda us: None if us is None else (us - US0) // 1_000_000
    assert sorted((r.k, second(r.opened_us), second(r.r)) for r in got) == [("a", 1, 5), ("a", 2, 5), ("a", 150, None)]


CHANGES = ", ".join(["k string", "s double", *(f"{n} {t}" for n, t in ordered.ObserveBooks.CHANGES if n != "us")])


def change(k, s, seq, bid=None, ask=None, tier=None, valid=None, updates=0):
    d = lambda x: None if x is None else Decimal(str(x))
    return (k, float(s), seq, int(bid is not None), valid, d(bid), d(ask), None, 0, Decimal(0), updates, tier)


def observed(rows):
    return sorted((r.k, (r.us - US0) // 1_000_000, r.change, r.revision, r.updates) for r in rows.where("change <> 'late'").collect())


def test_sampled_books_change_or_beat_without_input(spark, tmp_path):
    """The first sight, heartbeats while nothing comes, a change after the interval; crossed and invalid books wait."""
    parts = [
        [change("t", 1, 1, 0.4, 0.6, "sampled", True)],
        [change("z", 2000, 1)],
        [change("t", 2010, 2, 0.45, 0.6), change("t", 2041, 3, 0.7, 0.6), change("t", 2095, 4, 0.5, 0.6), change("t", 2125, 5, valid=False)],
        [change("z", 4000, 2)],
    ]
    job = lambda rows: ordered.by_event_time(rows, ordered.ObserveBooks(["k"], RULE), "revision long, price decimal(18,6), trades long, volume decimal(38,6), updates long", delay="10 seconds")
    out = feed(spark, tmp_path, CHANGES, parts[:2], job)["rows"]
    # No row of t came after its first, yet it beats every 900 s from when it was given.
    assert observed(out) == [("t", 30, "change", 1, 0), ("t", 930, "heartbeat", 1, 0), ("t", 1830, "heartbeat", 1, 0)]
    out = feed(spark, tmp_path, CHANGES, parts[2:], job)["rows"]
    assert observed(out)[3:] == [("t", 2010, "change", 2, 0), ("t", 2100, "change", 4, 0)]


def test_full_books_are_given_at_intervals_until_they_are_closed(spark, tmp_path):
    parts = [[change("t", 1, 1, 0.4, 0.6, "full", True), change("t", 400, 2, 0.41, 0.6), change("t", 700, 3, tier="closed"), change("t", 710, 4, updates=1)], [change("z", 2000, 1)]]
    job = lambda rows: ordered.by_event_time(rows, ordered.ObserveBooks(["k"], RULE), "revision long, price decimal(18,6), trades long, volume decimal(38,6), updates long", delay="10 seconds")
    assert observed(feed(spark, tmp_path, CHANGES, parts, job)["rows"]) == [("t", 30, "periodic_hot", 1, 0), ("t", 330, "periodic_hot", 1, 0), ("t", 630, "periodic_hot", 2, 0)]


def test_the_batch_twin_observes_the_same(spark):
    rows = [change("t", 1, 1, 0.4, 0.6, "sampled", True), change("t", 2010, 2, 0.45, 0.6), change("t", 2041, 3, 0.7, 0.6), change("t", 2095, 4, 0.5, 0.6), change("t", 2125, 5, valid=False), change("u", 5, 1, 0.4, 0.6, "full", True), change("v", 5, 1, 0.4, 0.6, "none", True)]
    changes = spark.createDataFrame(rows, CHANGES).withColumn("us", (F.lit(US0) + F.col("s") * 1_000_000).cast("long"))
    got = sampling.observe_books(sampling.book_states(changes, ["k"]), ["k"], US0 + 2_400_000_000, RULE)
    seen = sorted((r.k, (r.tick - US0) // 1_000_000, r.kind, r.revision) for r in got.collect())
    assert [r for r in seen if r[0] == "t"] == [("t", 30, "change", 1), ("t", 930, "heartbeat", 1), ("t", 1830, "heartbeat", 1), ("t", 2010, "change", 2), ("t", 2100, "change", 4)]
    assert [r[1] for r in seen if r[0] == "u"] == list(range(30, 2401, 300))
    assert not [r for r in seen if r[0] == "v"]
    assert sampling.observe_books(sampling.book_states(changes.limit(0), ["k"]), ["k"], 0, RULE).count() == 0


BOOKS = "token_key long, s double, kind int, seq long, levels array<struct<side:int,price:decimal(18,6),size:decimal(18,6)>>, side int, price decimal(18,6), action int, x decimal(38,6)"


def kept_state(stream, path):
    """Runs the stream; gives the rows of state that are left."""
    query = stream.writeStream.option("checkpointLocation", f"file://{path}/state").foreachBatch(lambda rows, n: rows.write.format("noop").mode("overwrite").save()).trigger(availableNow=True).start()
    query.awaitTermination()
    return [op.numRowsTotal for p in query.recentProgress for op in p.stateOperators][-1]


@pytest.fixture
def rocks(spark):
    spark.conf.set(jobs.PROVIDER, jobs.STATE_STORE)
    yield
    spark.conf.unset(jobs.PROVIDER)


def test_a_closed_book_leaves_no_state(spark, tmp_path, rocks):
    level = [(1, Decimal("0.4"), Decimal(1)), (2, Decimal("0.6"), Decimal(2))]
    snap = lambda token, s, seq, levels: (token, float(s), jobs.SNAPSHOT, seq, levels, None, None, None, None)
    end = lambda token, s, seq: (token, float(s), jobs.RESOLVE, seq, None, None, None, None, None)
    parts = [[snap(1, 1, 1, level), snap(2, 1, 2, level), end(1, 20, 3)], [snap(2, 500, 4, None), snap(3, 600, 5, level)], [snap(1, 30, 6, level), snap(3, 610, 7, level)]]
    left = []
    for part in parts:
        spark.createDataFrame(part, BOOKS).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        rows = jobs.landed(spark, f"file://{tmp_path}/in", "*.parquet", BOOKS)
        us = (F.lit(US0) + F.col("s") * 1_000_000).cast("long")
        rows = rows.withColumns({"us": us, "ts": F.timestamp_micros(us)}).drop("s")
        job = lambda grace: jobs.stateful(rows, ["token_key"], jobs.CurrentBook(grace), jobs.BOOK_CHANGES, time="ts", delay="10 seconds")  # noqa: B023, E731
        left.append((kept_state(job(60), f"{tmp_path}/ended"), kept_state(job(None), f"{tmp_path}/kept")))
        out = jobs.run_to_end(job(60), f"file://{tmp_path}/out")
    # With a grace the closed token's levels, head and timer go; without, they stay.
    assert left[1][0] < left[1][1]
    assert {r.token_key for r in jobs.current_levels(out).collect()} >= {3}
    assert [(r.token_key, r.seq, r.batch > 0) for r in out.where("change = 'late'").collect()] == [(1, 6, True)]
    # A snapshot without levels empties a book and doesn't stop the stream.
    assert jobs.current_levels(out).where("token_key = 2").count() == 0


def test_a_suppressed_run_leaves_no_state_once_it_cannot_matter(spark, tmp_path, rocks):
    schema = "item string, us long, seq long, price decimal(18,6), ts timestamp"
    row = lambda item, s, seq, price: (item, US0 + s * 1_000_000, seq, Decimal(price), T0 + timedelta(seconds=s))
    parts = [[row("a", 1, 1, "1"), row("b", 1, 2, "1")], [row("b", 5000, 3, "1")], [row("a", 9000, 4, "1"), row("a", 2, 5, "1")]]
    job = jobs.SuppressUnchanged(900, ["item"], "us", ["seq"], "price", ["seq"], "decimal(18,6)", watched=True)
    counts, out = [], None
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        rows = lambda: jobs.stateful(jobs.landed(spark, f"file://{tmp_path}/in", "*.parquet", schema), ["item"], job, "item string, seq long, late boolean", time="ts", delay="10 seconds")
        counts.append(kept_state(rows(), f"{tmp_path}/a"))
        out = jobs.run_to_end(rows(), f"file://{tmp_path}/out")
    assert counts[1] < counts[0]
    assert sorted((r.seq, r.late) for r in out.collect()) == [(1, False), (2, False), (3, False), (4, False), (5, True)]


def test_a_batch_that_runs_twice_gives_each_row_once(spark, tmp_path):
    """A sink that fails once, after another took the batch: the batch runs again and both have each row once."""
    marker = tmp_path / "failed"

    def second(rows):
        if not marker.exists() and rows.isStreaming is False and rows.limit(1).count():
            marker.write_text("x")
            raise RuntimeError("stopped between two sinks")
        return rows.where("seq > 1")

    spark.createDataFrame([("a", 1.0, 1), ("a", 2.0, 2)], TICKS).write.parquet(f"file://{tmp_path}/in")
    rows = jobs.landed(spark, f"file://{tmp_path}/in", "*.parquet", TICKS)
    sinks = {"first": lambda x: x, "second": second}
    with pytest.raises(Exception, match="stopped between two sinks"):
        jobs.run_to_sinks(rows, f"file://{tmp_path}/out", sinks)
    assert os.path.isdir(f"{tmp_path}/out/first/part=0")
    out = jobs.run_to_sinks(rows, f"file://{tmp_path}/out", sinks)
    assert sorted(r.seq for r in out["first"].collect()) == [1, 2]
    assert [r.seq for r in out["second"].collect()] == [2]


def test_a_key_asks_for_its_state_once():
    """Each call goes to the JVM and back, so a key reads and writes two values, not row by row."""
    calls = []

    class Value:
        def __init__(self):
            self.value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def clear(self):
            calls.append("clear")
            self.value = None

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, ms):
            pass

    class Mark:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    books = ordered.ObserveBooks(["k"], RULE)
    books.init(Handle())
    names = [n for n, _ in ordered.ObserveBooks.CHANGES]
    rows = [Row(*names)(i * 1_000_000, i, 1, True, Decimal(1), Decimal(2), None, 0, Decimal(0), 0, "full") for i in range(1, 50)]
    assert list(books.handleInputRows(("a",), iter(rows), Mark(0))) == [] and calls == ["get", "update", "get"]
    out = list(books.handleExpiredTimer(("a",), Mark(400_000), None))
    assert [(r.us, r.revision) for r in out] == [(30_000_000, 30), (330_000_000, 49)]
    assert len(calls) == 7 and books.held.value is None
