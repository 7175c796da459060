"""Nested counters, all-clears along runs, announced settings, compact rows: cases with results known beforehand."""

from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from quotelake.operators import health, history, normalise
from quotelake.plans import registry

T0 = datetime(2024, 1, 1)


def at(n):
    return None if n is None else T0 + timedelta(hours=n)


@pytest.mark.parametrize(
    ("document", "total", "status"),
    [
        ('{"a": 1, "b": {"c": [2, {"d": -3}], "7": true}, "e": 0.5, "f": 1e3, "g": "8 \\" 9"}', 0, "completed"),
        ('{"n": 99999999999999999999, "m": [[1]]}', 10**20, "completed"),
        ('{"write_failures": 2}', 2, "partial"),
        ('{"write_failures": 0, "archive_degraded": false, "comments": {"errors": null}}', 0, "completed"),
        ('{"archive_degraded": true}', 0, "partial"),
        ('{"trades": {"saturated_markets": 1, "history_floor_markets": 0}}', 1, "partial"),
        ('{"trades": 5, "comments": []}', 5, "completed"),
        ('{"a": 5', 0, "completed"),
        ("", 0, "completed"),
        (None, 0, "completed"),
    ],
)
def test_nested_counters(spark, document, total, status):
    row = health.run_results(spark.createDataFrame([(document,)], "details string"), "details").first()
    assert (int(row.processed), row.status) == (total, status)


def test_a_very_long_text_among_counters(spark):
    document = '{"note": "' + 'x1\\"' * 200_000 + '", "n": 4}'
    assert int(health.run_results(spark.createDataFrame([(document,)], "details string"), "details").first().processed) == 4


RAISED = "event_id long, run_id long, reason string, record_id string, raised_at timestamp_ntz, at int"
TIMEOUT, SPILL, SHED = health.TRANSIENT[0], health.TRANSIENT[1], health.OPTIONAL[0]


def resolved(spark, raised, signals, runs, parts=1):
    raised = spark.createDataFrame([(e, run, reason, record, at(t), 1) for e, run, reason, record, t in raised], RAISED)
    signals = spark.createDataFrame([(kind, run, record, at(t)) for kind, run, record, t in signals], "kind string, run_id long, record_id string, at timestamp_ntz")
    runs = spark.createDataFrame([(run, job, at(t)) for run, job, t in runs], "run_id long, job_type string, finished_at timestamp_ntz")
    out = health.resolve_degradations(raised, signals, runs, parts)
    assert out.columns == [*raised.columns, "resolved_at"]
    rows = out.collect()
    assert len(rows) == raised.count()
    return {r.event_id: r.resolved_at for r in rows}


@pytest.mark.parametrize("parts", [1, 3])
def test_all_clears_along_runs(spark, parts):
    runs = [(1, "collect", 5), (2, "collect", None), (3, "backfill", 5), (4, None, 5)]
    raised = [
        (10, 1, SPILL, None, 1),  # by run 2 of the same job, once run 1 has finished
        (11, 2, SPILL, None, 1),  # by its own run
        (12, 3, SPILL, None, 1),  # another job: open
        (13, None, SPILL, None, 1),  # by the all-clear without a run
        (14, 3, TIMEOUT, "r1", 1),  # by its record
        (15, 3, SPILL, "r1", 1),  # a record clears only timeouts
        (16, 9, SHED, None, 1),  # by kind, the first one at or after it
        (17, 9, SHED, None, 4),  # after the last: open
        (18, 9, "other", "r1", 1),
        (19, 2, SPILL, None, None),  # no time: open
        (20, 4, SPILL, None, 1),  # a run without a job has no successors
        (21, 2, None, None, 1),
        (22, 2, SPILL, None, 4),  # at the same time counts
    ]
    signals = [("transient", 2, None, 4), ("transient", 2, None, 6), ("transient", None, None, 7), ("record", None, "r1", 8), ("record", None, None, 2), ("optional", None, None, 3), ("optional", None, None, 2), ("transient", 2, None, None), ("odd", 2, None, 2)]
    want = dict.fromkeys([r[0] for r in raised])
    want |= {10: at(6), 11: at(4), 13: at(7), 14: at(8), 16: at(2), 22: at(4)}
    assert resolved(spark, raised, signals, runs, parts) == want


def test_all_clears_of_empty_tables(spark):
    assert resolved(spark, [], [("optional", None, None, 1)], []) == {}
    assert resolved(spark, [(1, 1, SHED, None, 1)], [], []) == {1: None}


def test_announced_settings(spark):
    rows = [  # key, start, arrival, setting, declared end, observed, source
        ("a", 10, 1, "x", None, 1, 1),
        ("a", 20, 2, "x", None, 2, None),  # equal to its neighbour, yet kept
        ("a", 10, 3, "y", 15, 0, None),  # replaces; its times don't go back
        ("a", 10, 4, "y", 15, 5, None),  # changes nothing but the time of observation
        ("a", 5, 5, "z", None, 6, 6),  # an earlier start announced later
        ("b", 10, 6, None, 99, 7, None),
        ("b", None, 7, "q", None, 8, None),
    ]
    df = spark.createDataFrame([(k, at(s), n, v, at(e), at(o), at(src)) for k, s, n, v, e, o, src in rows], "k string, start timestamp_ntz, n int, setting string, declared timestamp_ntz, observed timestamp_ntz, source timestamp_ntz")
    out = history.scheduled_versions(df, ["k"], "start", ["n"], "setting", "declared", "observed", "source").orderBy("k", "start").collect()
    got = [(r.k, r.start, r.setting, r.observed, r.source, r.revisions, r.effective_to) for r in out]
    assert got == [("a", at(5), "z", at(6), at(6), 1, at(10)), ("a", at(10), "y", at(5), at(1), 2, at(15)), ("a", at(20), "x", at(2), None, 1, None), ("b", at(10), None, at(7), None, 1, at(99))]


def test_actions_of_compact_updates(spark):
    rows = [("set", "1", None), ("SET", "0", None), ("delta", "-1", None), (None, None, "-2"), ("odd", "3", None), ("reset", None, None), ("set", None, None), ("set", "many", None)]
    df = spark.createDataFrame([("m", "t", at(0), "buy", action, "0.5", size, delta) for action, size, delta in rows], "market string, token string, ts timestamp_ntz, side string, action string, price string, size string, size_delta string")
    out = normalise.encode_compact("orderbook_updates", df).collect()
    assert [r.action for r in out] == [1, 2, 4, 4, 1, 3, 1, 1]
    assert [r.size_mantissa for r in out] == [1, 0, -1, -2, 3, None, None, None]


def zero_sets(spark, tmp_path):
    """A folder with events of which some are set to nothing."""
    rows = [(i, datetime(2024, 1, 11, i), 3 * i, kind, value, f'{{"k": {i}}}') for i, (kind, value) in enumerate([("view", 0.0), ("click", 0.0), ("view", 5.0), ("error", 7.0), ("purchase", 0.0), ("signup", 0.0)])]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"file://{tmp_path}/events.parquet")
    return f"file://{tmp_path}"


def same_as_sql(spark, tmp_path, name):
    got = registry.queries()[name](spark, zero_sets(spark, tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    rows = sorted(map(tuple, got.select(columns).collect()))
    assert rows == sorted(want)
    return rows


def test_a_scanned_set_to_nothing_stays_a_set(spark, tmp_path):
    assert {r[0] for r in same_as_sql(spark, tmp_path, "a1_a6_scan_archive")} == {1, 2, 4}


def test_a_set_to_nothing_survives_the_roundtrip(spark, tmp_path):
    assert sum(r[0] == 1 and r[3] == "0.000000" for r in same_as_sql(spark, tmp_path, "n23_a17_encode_roundtrip")) == 2


def test_compact_snapshots_of_broken_levels(spark):
    df = spark.createDataFrame([('[["0.1", 2, "more"], [], null, "x", {"a": 1}]', None, None), ("[]", "[[1e-3, 5]]", True)], "bids string, asks string, is_reconciliation boolean")
    for name in ("market", "token", "connection_id", "book_hash", "snapshot_type"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    for name in ("source_ts", "exchange_ts", "ts"):
        df = df.withColumn(name, F.lit(None).cast("timestamp_ntz"))
    a, b = normalise.encode_compact("orderbook_snapshots", df).collect()
    assert [tuple(x) for x in a.levels] == [(1, 1, 1, 2, 0)] and a.market_key is None and a.is_reconciliation is False and a.snapshot_type == 1
    assert b.is_reconciliation is True and len(b.levels) == 1 and (b.levels[0].side, b.levels[0].size_mantissa) == (2, 5)


def test_unknown_streams_are_refused(spark):
    with pytest.raises(ValueError, match="unknown archive stream"):
        normalise.encode_compact("odd", spark.range(1))
