"""A key with most of the rows, cut into parts, gives what one task would give."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotelake.operators import book, history, prefix

T0 = datetime(2024, 1, 1)
BOOK = "token_key long, ts timestamp_ntz, kind int, seq long, is_recon boolean, side int, price decimal(18,6), action int, x decimal(18,2), levels array<struct<side:int,price:decimal(18,6),size:decimal(18,2)>>"
PARTS = 7


@pytest.fixture(scope="module")
def events(spark):
    """One token has nine rows of ten; times repeat, some tokens and times are null."""
    random.seed(2)
    rows = []
    for i in range(2500):
        token = 1 if i % 10 else random.choice([2, 3, None])
        kind = 0 if random.random() < 0.01 else 1
        levels = [(random.choice([1, 2]), Decimal(random.randint(1, 6)), Decimal(random.randint(0, 9))) for _ in range(4)] if kind == 0 else None
        ts = None if random.random() < 0.003 else T0 + timedelta(seconds=random.randint(0, 1200))
        rows.append((token, ts, kind, i, False, random.choice([1, 2]), Decimal(random.randint(1, 6)), random.choice([1, 2, 4, 4, 4]), Decimal(random.randint(-6, 6)), levels))
    return spark.createDataFrame(rows, BOOK).repartition(4).cache()


def same(a, b):
    b = b.select(*a.columns)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_parts_spread_a_busy_key(events):
    placed = prefix.with_parts(events, ["token_key"], "ts", "part", PARTS)
    sizes = [r["count"] for r in placed.where("token_key = 1").groupBy("part").count().collect()]
    assert len(sizes) == PARTS
    assert max(sizes) < 2 * sum(sizes) / PARTS
    tasks = book.with_epochs(events, PARTS).where("token_key = 1").groupBy(F.spark_partition_id()).count().count()
    assert tasks > 1
    assert prefix.spread(events, ["token_key"], busy=400) == 6
    assert prefix.spread(events.limit(0), ["token_key"]) == 1


@pytest.mark.parametrize("kind", ["sum", "min", "max", "last", "lag"])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_aggregates_equal_one_window(events, kind, inclusive):
    if kind == "lag" and not inclusive:
        pytest.skip("a lag never counts its own row")
    value = F.when(F.col("seq") % 3 != 0, F.col("x"))
    order, column = ["ts", "kind", "seq"], {"r": prefix.Running(kind, value, inclusive)}
    got = [prefix.running(prefix.with_parts(events, ["token_key"], "ts", "part", n), ["token_key"], order, "part", column, n).select("token_key", "seq", "r") for n in (1, PARTS)]
    same(got[0], got[1])


def test_books_of_a_busy_token(events):
    for f in (book.with_epochs, lambda e, n: book.level_sizes(book.book_moves(e, n), n), lambda e, n: book.replay_book(e, parts=n)):
        same(f(events, 1).drop("part"), f(events, PARTS).drop("part"))
    ticks = events.select("token_key").distinct().withColumn("tick", F.explode(F.array(*[F.lit(T0 + timedelta(seconds=s)).cast("timestamp_ntz") for s in (0, 300, 301, 900, 5000)])))
    same(book.book_at_ticks(events, ticks), book.book_at_ticks(events, ticks, PARTS))
    # And each tick's book is that of the events up to it.
    for s in (301, 900):
        at = T0 + timedelta(seconds=s)
        one = book.replay_book(events.where("token_key IS NOT NULL"), F.lit(at)).select("token_key", "side", "price", "size")
        same(one, book.book_at_ticks(events, ticks, PARTS).where((F.col("tick") == F.lit(at)) & F.col("token_key").isNotNull()).select("token_key", "side", "price", "size"))


def test_history_of_a_busy_key(events):
    rows = events.select("token_key", "ts", "seq", (F.col("seq") % 5 < 3).cast("string").alias("content"), F.col("x").alias("up"))
    same(history.scd2(rows, ["token_key"], ["ts", "seq"], "content"), history.scd2(rows, ["token_key"], ["ts", "seq"], "content", parts=PARTS))
    stale = lambda n: history.mark_stale(rows, ["token_key"], ["ts", "seq"], "up", "seq", n)
    same(stale(1), stale(PARTS))


def test_as_of_join_of_a_busy_key(events):
    left, right = events.select("token_key", "ts", "seq"), events.where("action = 4").select("token_key", "ts", "seq", "x")
    join = lambda n: book.last_before(left, right, ["token_key"], "ts", "ts", ["x"], ["seq"], n)
    same(join(1), join(PARTS))


def test_nothing_at_all(events):
    none = events.limit(0)
    assert book.with_epochs(none, PARTS).count() == 0
    assert book.replay_book(none, parts=PARTS).count() == 0
