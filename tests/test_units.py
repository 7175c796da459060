"""Small cases with results known beforehand."""

import math
import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quotelake import session
from quotelake.functions import scalars as s
from quotelake.operators import book, health, history, keyed, normalise, sampling, tiering
from quotelake.sources import archive
from quotelake.streaming import jobs

T0 = datetime(2024, 1, 1)
BOOK = "token_key long, ts timestamp_ntz, kind int, seq long, is_recon boolean, side int, price decimal(18,6), action int, x decimal(18,2), levels array<struct<side:int,price:decimal(18,6),size:decimal(18,2)>>"


def event(n, kind=1, side=1, price="0.4", action=1, x="5", levels=None, recon=False):
    return (1, T0 + timedelta(seconds=n), kind, n, recon, side, Decimal(price), action, Decimal(x), levels)


def level(side, price, size):
    return (side, Decimal(price), Decimal(size))


def final(spark, rows):
    out = book.replay_book(spark.createDataFrame(rows, BOOK)).collect()
    return {(r.side, float(r.price)): float(r["size"]) for r in out}


def test_replay_sets_deletes_and_adds(spark):
    rows = [
        event(0, 0, levels=[level(1, "0.4", "10"), level(2, "0.6", "3")]),
        event(1, side=1, price="0.41", x="2"),
        event(2, side=2, price="0.6", action=2),
        event(3, side=1, price="0.4", action=4, x="-4"),
        event(4, side=1, price="0.41", action=4, x="-9"),
        event(5, side=1, price="0.41", action=4, x="1"),
    ]
    assert final(spark, rows) == {(1, 0.4): 6.0, (1, 0.41): 1.0}


def test_replay_does_not_depend_on_input_order(spark):
    rows = [event(0, 0, levels=[level(1, "0.4", "10")])] + [event(i, price=f"0.{30 + i % 4}", action=(1, 4, 2)[i % 3], x=str(i % 5 - 1)) for i in range(1, 40)]
    assert final(spark, rows) == final(spark, rows[::-1])


def test_a_snapshot_replaces_the_book_and_reconciliation_is_ignored(spark):
    rows = [event(0, 0, levels=[level(1, "0.4", "10")]), event(1, 0, levels=[level(2, "0.7", "1")]), event(2, 0, levels=[level(1, "0.1", "9")], recon=True)]
    assert final(spark, rows) == {(2, 0.7): 1.0}


def test_repeated_levels_keep_the_last_with_a_size(spark):
    rows = [event(0, 0, levels=[level(1, "0.4", "1"), level(1, "0.4", "7"), level(1, "0.4", "0")])]
    assert final(spark, rows) == {(1, 0.4): 7.0}


def test_changes_before_a_snapshot_are_violations(spark):
    rows = spark.createDataFrame([event(0), event(1, 0, levels=[level(1, "0.4", "1")])], BOOK)
    assert [r.rule for r in book.replay_violations(rows).collect()] == ["delta_before_snapshot"]


def test_empty_book_tables(spark):
    assert book.book_metrics(book.replay_book(spark.createDataFrame([], BOOK))).count() == 0


def test_as_of_book_at_a_snapshot_equals_the_snapshot(spark):
    rows = spark.createDataFrame([event(0, 0, levels=[level(1, "0.4", "10")]), event(5, x="1"), event(9, 0, levels=[level(2, "0.8", "2")])], BOOK)
    ticks = spark.createDataFrame([(1, T0 + timedelta(seconds=9))], "token_key long, tick timestamp_ntz")
    assert [(r.side, float(r.price), float(r["size"])) for r in book.book_at_ticks(rows, ticks).collect()] == [(2, 0.8, 2.0)]


@pytest.mark.parametrize(("text", "want"), [("1.50", "1.5"), ("", None), ("nan", None), ("x", None), (None, None), (" 2 ", "2"), ("1E+3", "1000"), ("0.1234567890123456789", None), ("1.5000000000000000000000", "1.5"), ("10E-19", "1E-18"), ("1E-19", None), ("-0.000000000000000001", "-1E-18")])
def test_as_decimal(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(s.as_decimal(F.col("t")).alias("n")).first().n
    assert got == (Decimal(want) if want else None)


@pytest.mark.parametrize(("text", "want"), [("0.4200", (4200, 4)), ("6.2500", (62500, 4)), ("1E+3", (1, -3)), ("-0.0004", (-4, 4)), ("99999999999999999999", (None, None)), ("x", (None, None))])
def test_decimal_split(spark, text, want):
    m, k = s.decimal_split(F.col("t"))
    got = spark.createDataFrame([(text,)], "t string").select(m.alias("m"), k.alias("k")).first()
    assert (got.m, got.k) == want


@pytest.mark.parametrize(("text", "want"), [("2024-01-01T00:00:00Z", T0), ("2024-01-01T02:30:00+02:30", T0), ("1704067200", T0), ("1704067200000", T0), ("1704067200000000", T0), ("1704067200000000000", T0), ("soon", None)])
def test_parse_timestamp(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(s.parse_timestamp(F.col("t")).alias("t")).first().t == want


def test_fingerprints_are_equal_for_other_spellings(spark):
    rows = spark.createDataFrame([("PM", Decimal("1.50"), "BUY"), ("pm", Decimal("1.5"), "buy")], "e string, p decimal(18,6), s string")
    one = F.lit("x")
    got = rows.select(s.trade_fingerprint(F.col("e"), one, one, F.lit("2024-01-01").cast("timestamp_ntz"), F.col("p"), F.col("p"), F.col("s"), one).alias("f")).distinct()
    assert got.count() == 1


def test_price_changes_without_a_side_are_dropped(spark):
    frame = '{"market":"m","timestamp":"1704067200000","price_changes":[{"asset_id":"a","price":"0.4","size":"0","side":"BUY"},{"asset_id":"a","price":"0.5","size":"2"}]}'
    got = normalise.price_changes(spark.createDataFrame([(frame,)], "payload string")).collect()
    assert [(r.token, r.action) for r in got] == [("a", "delete")]


def test_book_levels_are_sorted_whatever_their_form(spark):
    frame = '{"asset_id":"a","timestamp":"1704067200000","bids":[["0.40","1"],{"price":"0.42","size":"2"},["0.41","0"]],"asks":[["0.5","1"]]}'
    got = normalise.book_headers(normalise.books(spark.createDataFrame([(frame,), ('{"asset_id":"b","bids":"x"}',)], "payload string"))).collect()
    assert [(r.token, float(r.best_bid), r.level_count) for r in got] == [("a", 0.42, 3)]


def test_malformed_frames_are_kept(spark):
    rows = spark.createDataFrame([("{bad",), ('[{"event_type":"book"},{"error":"x"}]',), ('{"topic":"t"}',)], "frame string")
    assert sorted(r.message_type for r in normalise.frames(rows).collect()) == ["book", "envelope", "error", "malformed_json"]


def test_tiers_dwell_and_ceilings(spark):
    kinds = "external_id string, active boolean, closed boolean, archived boolean, accepting boolean, book boolean, n_tokens long, liquidity decimal(18,2), volume_24h decimal(18,2), spread double, rewards boolean, close_time timestamp_ntz"
    row = lambda i, liq: (f"m{i}", True, False, False, True, True, 2, Decimal(liq), Decimal("1000"), 0.1, False, None)
    markets = spark.createDataFrame([row(i, 10**i) for i in range(1, 6)] + [("off", False, True, False, True, True, 2, None, None, None, False, None)], kinds)
    active = spark.createDataFrame([], "market string, trade_count long, trade_volume decimal(18,2), update_count long")
    previous = spark.createDataFrame([("m1", "full", T0)], "external_id string, tier string, tier_since timestamp_ntz")
    limits = tiering.Limits(full_max=2, sampled_max=2, reserve=1)
    out = {r.external_id: (r.tier, r.ceiling_binding) for r in tiering.assign_tiers(tiering.scored(markets, active, previous, F.lit("2024-01-01 00:10:00").cast("timestamp_ntz"), limits), limits).collect()}
    assert out["m5"][0] == out["m4"][0] == "full"
    assert out["off"] == ("none", False)
    assert sorted(k for k, v in out.items() if v[0] == "sampled") == ["m2", "m3"]
    assert out["m1"] == ("none", True)


def test_versions_reopen_when_content_returns(spark):
    rows = spark.createDataFrame([(1, T0 + timedelta(hours=i), i, c) for i, c in enumerate("aabba")], "k int, ts timestamp_ntz, seq int, c string")
    got = history.scd2(rows, ["k"], ["ts", "seq"], "c").orderBy("version_number").collect()
    assert [(r.c, r.observations, r.valid_to is None) for r in got] == [("a", 2, False), ("b", 2, False), ("a", 1, True)]


def test_keyed_writes_are_idempotent(spark):
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "k int, n int, v string")
    once = keyed.keep_first(rows, ["k"], ["n"])
    assert sorted(map(tuple, once.collect())) == [(1, 1, "a"), (2, 1, "c")]
    assert keyed.keep_first(rows, ["k"], ["n"], once).count() == 0
    assert sorted(map(tuple, keyed.keep_last(rows, ["k"], ["n"]).collect())) == [(1, 2, "b"), (2, 1, "c")]


def test_identity_prefers_the_id_to_an_alias(spark):
    dims = spark.createDataFrame([("a", "b"), ("b", "x")], "id string, alias1 string")
    got = keyed.resolve_identity(spark.createDataFrame([("b",), ("x",), ("?",)], "ref string"), "ref", dims, "id", ["alias1"]).collect()
    assert {r.ref: r.resolved for r in got} == {"b": "b", "x": "b", "?": None}


def test_unchanged_rows_are_kept_only_after_the_interval(spark):
    rows = spark.createDataFrame([(1, T0 + timedelta(seconds=t), i, v) for i, (t, v) in enumerate([(0, 1), (100, 1), (250, 1), (310, 1), (320, 2), (400, 2), (650, 2)])], "k int, ts timestamp_ntz, seq int, v int")
    assert sorted(r.seq for r in sampling.suppress_unchanged(rows, ["k"], ["ts", "seq"], "v", 300).collect()) == [0, 3, 4, 6]


def test_rules_and_rejects(spark):
    rows = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "k int, v int")
    rules = {"positive": F.col("v") > 0}
    good, bad = keyed.split_rejects(rows, rules)
    assert (good.count(), [r.k for r in bad.collect()]) == (2, [2])
    assert [(r.k, r.rule) for r in health.violations(rows, "k", rules).collect()] == [(2, "positive")]


def hourly(spark, path, hours):
    rows = spark.createDataFrame([(1, 1, 1, 1704067200_000_000_000 + h * 3_600_000_000_000, 1, 1, 4, 1, 5, 0) for h in hours], archive.UPDATES)
    archive.write_archive(rows, path, "x", "orderbook_updates")


@pytest.mark.parametrize(
    ("start", "end", "want"),
    [
        ("2024-01-01T01:00:00", "2024-01-01T03:00:00", [1, 2]),
        ("2024-01-01T01:00:00Z", "2024-01-01T03:00:00.000001Z", [1, 2, 3]),
        ("2024-01-01T06:00:00+05:00", "2024-01-01 08:00:00+05:00", [1, 2]),
        ("2023-12-31T20:00:00-05:00", "2023-12-31T22:00:00-05:00", [1, 2]),
        ("2023-12-31 23:00:00", "2024-01-01 00:00:00", [-1]),
        (datetime(2024, 1, 1, 22), datetime(2024, 1, 2, 1, tzinfo=timezone(timedelta(hours=1))), [22, 23]),
        ("2024-01-01 22:30:00", None, [23, 24]),
        (None, "2024-01-01 00:00:00", [-1]),
        ("2024-01-01 03:00:00", "2024-01-01 02:00:00", []),
    ],
)
def test_scans_take_instants(spark, tmp_path_factory, start, end, want):
    path = f"file://{tmp_path_factory.mktemp('archive')}"
    hourly(spark, path, range(-1, 25))
    got = archive.scan_archive(spark, path, "orderbook_updates", archive.UPDATES, start, end, columns=["received_ts_ns"])
    assert sorted((r.received_ts_ns - 1704067200_000_000_000) // 3_600_000_000_000 for r in got.collect()) == want
    if start and end:
        hours = archive.hour_partitions(start, end, spark).count()
        assert hours >= len(want)


def test_compaction_sees_other_rows(spark, tmp_path):
    source, target = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string").repartition(3).write.parquet(source)
    archive.compact(spark, source, target, 1)
    assert spark.read.parquet(target).rdd.getNumPartitions() == 1 and spark.read.parquet(target).count() == 3
    pair = spark.createDataFrame([(3, "z"), (3, "z"), (2, "y")], "k int, v string")
    assert archive.row_digest(spark.read.parquet(source)) != archive.row_digest(pair)
    with pytest.raises(ValueError, match="version"):
        archive.compact(spark, source, f"{target}2", 1, schema_version=1)


def test_snapshot_names_have_codes(spark):
    rows = spark.createDataFrame([("exchange",), ("closing",), ("other",)], "t string")
    assert [r.c for r in rows.select(s.code(F.col("t"), s.SNAPSHOTS).alias("c")).collect()] == [1, 4, None]
    assert [r.c for r in rows.select(s.code(F.lit("Token"), s.ENTITIES).alias("c")).collect()] == [2, 2, 2]


def test_nearest_rank_equals_sorting(spark):
    random.seed(1)
    values = {"a": [random.gauss(0, 1) ** 9 for _ in range(999)], "b": [1.0] * 50 + [2.0], "c": [5.0], "d": [float(i % 7) for i in range(100)]}
    rows = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs] + [("a", None)], "k string, v double")
    for share in (0.001, 0.5, 0.99, 1.0):
        got = {r.k: r.value for r in health.nearest_rank(rows, "k", "v", share, accuracy=8).collect()}
        assert got == {k: sorted(vs)[max(1, math.ceil(share * len(vs))) - 1] for k, vs in values.items()}


def test_long_runs_pass_in_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        rows = spark.createDataFrame([(k, T0 + timedelta(seconds=40 * t), t, t // 200) for k in range(3) for t in range(400)], "us int, ts timestamp_ntz, start int, v int")
        got = sampling.suppress_unchanged(rows, ["us"], ["ts", "start"], "v", 300)
        assert got.columns == rows.columns
        assert sorted((r.us, r.start) for r in got.collect()) == [(k, b + t) for k in range(3) for b in (0, 200) for t in range(0, 200, 8)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_snapshots_of_many_levels_and_ticks(spark):
    rows = [
        event(0, 0, levels=[level(1, "0.40", "10"), level(1, "0.41", "1"), level(2, "0.60", "3"), level(2, "0.61", "4"), level(2, "0.62", "0")]),
        event(5, side=2, price="0.61", action=2),
        event(9, 0, levels=[level(1, "0.41", "7"), level(2, "0.59", "2"), level(2, "0.60", "3")]),
        event(12, side=1, price="0.41", action=4, x="-7"),
    ]
    events = spark.createDataFrame(rows, BOOK)
    ticks = spark.createDataFrame([(1, T0 + timedelta(seconds=t)) for t in (-1, 0, 5, 8, 9, 12)] + [(2, T0)], "token_key long, tick timestamp_ntz")
    got = {}
    for r in book.book_at_ticks(events, ticks).collect():
        got.setdefault((r.tick - T0).seconds, set()).add((r.side, str(r.price), float(r["size"])))
    first = {(1, "0.400000", 10.0), (1, "0.410000", 1.0), (2, "0.600000", 3.0), (2, "0.610000", 4.0)}
    assert got == {0: first, 5: first - {(2, "0.610000", 4.0)}, 8: first - {(2, "0.610000", 4.0)}, 9: {(1, "0.410000", 7.0), (2, "0.590000", 2.0), (2, "0.600000", 3.0)}, 12: {(2, "0.590000", 2.0), (2, "0.600000", 3.0)}}


@pytest.mark.parametrize(("full", "sampled"), [(2, 2), (0, 2), (2, 0), (0, 0)])
def test_tier_selection_equals_sorting(spark, full, sampled):
    random.seed(full * 3 + sampled)
    rows = [(f"m{i}", Decimal(random.randint(0, 9)), random.random() < 0.6, random.random() < 0.3, random.random() < 0.7, i % 10 > 0) for i in range(80)]
    limits = tiering.Limits(full_max=full, sampled_max=sampled, reserve=1)
    table = spark.createDataFrame(rows, "external_id string, score decimal(18,6), qualifies boolean, interesting boolean, sampleable boolean, eligible boolean")
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[1], r[0]))
    research = [r[0] for r in able if r[3]][: min(1, full)]
    general = [r[0] for r in able if r[2] and r[0] not in research]
    want_full = research + (general[: full - len(research)] if full else general)
    left = [r[0] for r in able if r[4] and r[0] not in want_full]
    got = tiering.select_tiers(table, limits)
    ids = lambda name: sorted(r.external_id for r in got[name].collect())
    assert (ids("research"), ids("full"), ids("sampled")) == (sorted(research), sorted(want_full), sorted(left[:sampled] if sampled else left))
    wanted = len({r[0] for r in able if r[2]} | set(research))
    assert tuple(got["binding"].first()) == (0 < full < wanted, 0 < sampled < len(left))


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(master="local-cluster[2,1,1024]", getConf=lambda: SimpleNamespace(get=lambda k: None), getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_root(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: None)))


EVENTS = "token_key long, us long, kind int, seq long, levels array<struct<side:int,price:decimal(18,6),size:decimal(18,6)>>, side int, price decimal(18,6), action int, x decimal(38,6)"


def stepped(spark, tmp_path, schema, parts, job):
    """A stream that stops after each part and starts again."""
    out = None
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        out = jobs.run_to_end(job(jobs.landed(spark, f"file://{tmp_path}/in", "*.parquet", schema)), f"file://{tmp_path}/out")
    return out


def test_current_books_over_a_restart(spark, tmp_path):
    snap = lambda us, seq, *levels: (1, us, 0, seq, list(levels), None, None, None, None)
    move = lambda us, seq, side, price, action, x: (1, us, 1, seq, None, side, Decimal(price), action, Decimal(x))
    parts = [
        [move(5, 0, 1, "0.1", 1, "3"), snap(10, 1, level(1, "0.40", "10.5"), level(1, "0.41", "1"), level(2, "0.60", "3"), level(2, "0.60", "4"), level(2, "0.61", "0")), move(11, 2, 1, "0.42", 1, "0.000001")],
        [move(9, 3, 1, "0.40", 2, "0"), move(20, 4, 1, "0.40", 4, "-0.5"), (1, 21, 2, 5, None, None, None, None, None), move(22, 6, 2, "0.60", 2, "0")],
        [snap(30, 7, level(1, "0.30", "1"), level(2, "0.70", "2"), level(2, "0.71", "5")), move(31, 8, 2, "0.71", 4, "-9")],
    ]
    out = stepped(spark, tmp_path, EVENTS, parts, lambda rows: jobs.stateful(rows, ["token_key"], jobs.CurrentBook(), jobs.BOOK_CHANGES))
    assert {(r.epoch, r.side, str(r.price), str(r["size"])) for r in jobs.current_levels(out).collect()} == {(2, 1, "0.300000", "1.000000"), (2, 2, "0.700000", "2.000000")}
    assert {(r.us, r.side, str(r.price), str(r["size"])) for r in jobs.closing_levels(out).collect()} == {(21, 1, "0.400000", "10.000000"), (21, 1, "0.410000", "1.000000"), (21, 1, "0.420000", "0.000001"), (21, 2, "0.600000", "4.000000")}
    second = [(r.side, str(r.price), str(r["size"])) for r in out.where("batch = 1 AND change = 'level'").collect()]
    assert sorted(second) == [(1, "0.400000", "10.000000"), (2, "0.600000", "0.000000")]  # only what changed


def test_a_disconnect_makes_a_book_invalid_until_a_snapshot(spark, tmp_path):
    snap = lambda token, us, seq, price: (token, us, jobs.SNAPSHOT, seq, [level(1, price, "1")], None, None, None, None)
    bare = lambda token, us, kind, seq: (token, us, kind, seq, None, None, None, None, None)
    move = lambda token, us, seq: (token, us, jobs.CHANGE, seq, None, 1, Decimal("0.2"), 1, Decimal(5))
    parts = [[snap(1, 1, 1, "0.1"), snap(2, 1, 2, "0.1"), bare(1, 2, jobs.DISCONNECT, 3), bare(2, 2, jobs.DISCONNECT, 4)], [move(1, 3, 5), bare(1, 4, jobs.RESOLVE, 6), snap(2, 3, 7, "0.3"), move(2, 4, 8)]]
    out = stepped(spark, tmp_path, EVENTS, parts, lambda rows: jobs.stateful(rows, ["token_key"], jobs.CurrentBook(), jobs.BOOK_CHANGES))
    assert {(r.token_key, float(r.price), int(r["size"])) for r in jobs.current_levels(out).collect()} == {(2, 0.3, 1), (2, 0.2, 5)}
    assert jobs.closing_levels(out).count() == 0


def test_late_rows_are_not_sampled_again(spark, tmp_path):
    hour = 3_600_000_000
    schema = "item string, us long, seq long, price decimal(18,6), note string"
    row = lambda h, seq, price: ("a", h * hour, seq, Decimal(price), f"n{seq}")
    parts = [[row(10, 1, "1.5"), row(100, 2, "1.5")], [row(50, 3, "2"), row(101, 4, "1.5"), row(102, 5, "1.6")], [row(103, 6, "1.6"), row(99, 7, "9")]]
    job = jobs.SuppressUnchanged(12 * 3600, ["item"], "us", ["seq"], "price", ["seq", "note"], "decimal(18,6)")
    out = stepped(spark, tmp_path, schema, parts, lambda rows: jobs.stateful(rows, ["item"], job, "item string, seq long, note string, late boolean"))
    assert sorted((r.seq, r.note) for r in out.where("NOT late").collect()) == [(1, "n1"), (2, "n2"), (5, "n5")]
    assert sorted((r.seq, r.batch) for r in out.where("late").collect()) == [(3, 1), (7, 2)]


def test_stays_are_seeded_and_survive_a_stop(spark, tmp_path):
    hour = 3_600_000_000
    stored = spark.createDataFrame([("a", 2, 0), ("b", 0, 0)], "market string, tier int, since long")
    parts = [[("a", hour, 1, 0), ("b", hour, 2, 1)], [("b", 2 * hour, 3, 0), ("a", 7 * hour, 4, 1), ("c", hour, 5, 1)], [("b", 7 * hour, 6, 0)]]
    job = lambda rows: jobs.stateful(rows, ["market"], jobs.TierStay(6 * 3600, "market"), "market string, seq long, tier int, since long", stored)
    out = stepped(spark, tmp_path, "market string, us long, seq long, wanted int", parts, job)
    assert sorted((r.seq, r.tier, r.since // hour) for r in out.collect()) == [(1, 2, 0), (2, 1, 1), (3, 1, 1), (4, 1, 7), (5, 1, 1), (6, 0, 7)]


def test_a_stream_over_nothing_is_empty(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = jobs.landed(spark, f"file://{tmp_path}/in", "*.parquet", "ts timestamp, k string")
    out = jobs.run_to_end(jobs.minute_counters(rows, "k"), f"file://{tmp_path}/out", "update")
    assert out.count() == 0 and out.columns == ["minute", "k", "messages", "batch"]


def test_scan_prunes_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 1, 1704067200_000_000_000 + h * 3_600_000_000_000, 1, 1, 4, 1, 5, 0) for h in range(5)], archive.UPDATES)
    archive.write_archive(rows, f"file://{tmp_path}", "x", "orderbook_updates")
    got = archive.scan_archive(spark, f"file://{tmp_path}", "orderbook_updates", archive.UPDATES, "2024-01-01 01:00:00", "2024-01-01 03:00:00")
    assert got.count() == 2
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "hour" in filters and "date" in filters


def test_json_objects_merge_by_field(spark):
    rows = [(1, 1, '{"a":1,"b":{"x":[1,2]},"q\\"k":"v"}'), (1, 2, '{"a":null}'), (1, 3, '{"b":{"y":2},"c":"text"}'), (2, 1, "not json"), (2, 2, "[1]"), (3, 1, None), (4, 5, '{"a":"new"}'), (4, 4, '{"a":"old","d":1.50}')]
    docs = spark.createDataFrame(rows, "k int, n int, doc string")
    got = {r.k: r.doc for r in history.merge_json(docs, ["k"], ["n"], "doc").collect()}
    assert got == {1: '{"a":null,"b":{"y":2},"c":"text","q\\"k":"v"}', 2: "{}", 3: "{}", 4: '{"a":"new","d":1.5}'}
    allowed = {r.k: r.doc for r in history.merge_json(docs, ["k"], ["n"], "doc", ["c", "d"]).collect()}
    assert allowed == {1: '{"c":"text"}', 2: "{}", 3: "{}", 4: '{"d":1.5}'}
    assert history.merge_json(docs.limit(0), ["k"], ["n"], "doc").count() == 0


def test_rows_without_a_time_are_never_suppressed(spark):
    rows = [("a", T0, 1, "x"), ("a", None, 2, "x"), ("a", T0 + timedelta(seconds=5), 3, "x"), ("a", None, 4, "y"), ("a", T0 + timedelta(seconds=50), 5, "x")]
    got = sampling.suppress_unchanged(spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq int, v string"), ["k"], ["ts", "seq"], "v", 40)
    assert sorted(r.seq for r in got.collect()) == [1, 2, 4, 5]


def test_windows_around_each_other_are_counted_once(spark):
    rows = spark.createDataFrame([("a", us) for us in (0, 1, 2, 3, 9, 60)] + [("b", 5)], "k string, us long")
    got = health.unsaturated_windows(rows, "k", "us", 64, 3, 4)
    assert sorted(map(tuple, got.collect())) == [("a", 0, 4, 4, True), ("a", 8, 8, 1, False), ("a", 32, 32, 1, False), ("b", 0, 64, 1, False)]
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(health.unsaturated_windows(rows, "k", "us", 1 << 22, 3, 1)._jdf.queryExecution(), "simple")
    assert plan.count("Scan ExistingRDD") == 1
