"""Keyed tables and compaction: what stops half-way leaves the old table, what runs twice changes nothing."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.sources import archive, compaction
from quotelake.sources.keyed_table import KeyedTable

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
ROWS = "k long, a string, b string, n long"


def content(table):
    return sorted(map(tuple, table.read().collect()))


def test_three_ways_to_meet_a_stored_key(spark, tmp_path):
    first = spark.createDataFrame([(1, "x", None, 1), (1, "y", None, 2), (2, None, "p", 3), (None, "no", "key", 4)], ROWS)
    second = spark.createDataFrame([(1, None, "q", 5), (3, "z", "r", 6), (3, "zz", None, 7)], ROWS)
    want = {
        "ignore": [(1, "x", None), (2, None, "p"), (3, "z", "r")],
        "overwrite": [(1, None, "q"), (2, None, "p"), (3, "zz", None)],
        "merge": [(1, "y", "q"), (2, None, "p"), (3, "zz", "r")],
    }
    for mode, rows in want.items():
        table = KeyedTable(spark, f"file://{tmp_path}/{mode}", SCHEMA, ["k"], buckets=3)
        assert content(table) == []
        assert table.upsert(first.withColumn("more", F.lit(1)), ["n"], mode)
        assert table.upsert(second, ["n"], mode)
        assert content(table) == rows
    with pytest.raises(ValueError, match="mode"):
        table.upsert(first, ["n"], "other")


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}", SCHEMA, ["k"], buckets=8)
    table.upsert(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("a"), F.lit("b").alias("b"), F.lit(1).alias("n")), ["n"])
    before = table._pointer()[1]["folders"]
    table.upsert(spark.createDataFrame([(5, "new", "b", 2)], ROWS), ["n"])
    after = table._pointer()[1]["folders"]
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert table.read().count() == 100 and table.read().where("a = 'new'").count() == 1
    table.vacuum(keep=1)
    assert table.read().count() == 100


def test_a_stop_before_the_swap_leaves_the_old_table(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, f"file://{tmp_path}", SCHEMA, ["k"], buckets=2)
    table.upsert(spark.createDataFrame([(1, "old", "b", 1)], ROWS), ["n"], batch=("s", 0))
    fresh = spark.createDataFrame([(1, "new", "b", 2), (2, "new", "b", 2)], ROWS)
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_swap", lambda self, number, state: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError, match="stopped"):
            table.upsert(fresh, ["n"], batch=("s", 1))
    assert content(table) == [(1, "old", "b")]
    # The same batch again: it is applied now, and a third time changes nothing.
    assert table.upsert(fresh, ["n"], batch=("s", 1))
    number = table._pointer()[0]
    assert not table.upsert(spark.createDataFrame([(1, "again", "b", 9)], ROWS), ["n"], batch=("s", 1))
    assert content(table) == [(1, "new", "b"), (2, "new", "b")] and table._pointer()[0] == number


def test_a_second_writer_fails(spark, tmp_path):
    table = KeyedTable(spark, f"file://{tmp_path}", SCHEMA, ["k"], buckets=2)
    table.upsert(spark.createDataFrame([(1, "a", "b", 1)], ROWS), ["n"])
    number, state = table._pointer()
    table.upsert(spark.createDataFrame([(2, "a", "b", 1)], ROWS), ["n"])
    with pytest.raises(Exception, match="(?i)exist"):
        table._swap(number + 1, state)
    assert len(content(table)) == 2


@pytest.fixture
def small_files(spark, tmp_path):
    root = f"file://{tmp_path}/archive"
    hour = archive.NANOS_PER_HOUR
    rows = spark.range(60).select(F.col("id").alias("token_key"), (F.lit(470_000 * hour) + (F.col("id") % 3) * hour + F.col("id")).alias("received_ts_ns"))
    for part in range(4):
        # The third hour has two files only.
        archive.write_archive(rows.where((F.col("token_key") % 4 == part) & ((F.col("token_key") % 3 < 2) | (F.lit(part) < 2))), root, "x", "s")
    table = compaction.manifest_table(spark, f"file://{tmp_path}/manifest", buckets=2)
    compaction.register(table, root, "s")
    return root, table


READ = T.StructType([T.StructField("token_key", T.LongType()), T.StructField("received_ts_ns", T.LongType())])


def test_compaction_replaces_the_files(small_files):
    root, table = small_files
    before = sorted(map(tuple, compaction.scan_live(table, READ).collect()))
    assert compaction.compact_due(table, root, "s") == 8
    assert sorted(map(tuple, compaction.scan_live(table, READ).collect())) == before
    live = compaction.live_objects(table).collect()
    assert sorted(r.generation for r in live) == [0, 0, 1, 1]
    gone = table.read().where("state = 'superseded'").collect()
    assert len(gone) == 8 and len({r.superseded_by for r in gone}) == 1
    for hour in {r.hour for r in gone}:
        old, new = [r for r in gone if r.hour == hour], [r for r in live if r.hour == hour]
        assert (min(r.min_ns for r in old), max(r.max_ns for r in old), sum(r.n_rows for r in old)) == (new[0].min_ns, new[0].max_ns, new[0].n_rows)
    assert compaction.compact_due(table, root, "s") == 0
    compaction.register(table, root, "s")  # what is known is left alone
    assert compaction.live_objects(table).count() == 4


def test_a_compaction_that_stops_leaves_its_sources(small_files, monkeypatch):
    root, table = small_files
    before = sorted(map(tuple, compaction.scan_live(table, READ).collect()))
    with monkeypatch.context() as m:
        m.setattr(compaction, "row_digest", lambda rows: object())
        with pytest.raises(ValueError, match="differs"):
            compaction.compact_due(table, root, "s")
    assert sorted(map(tuple, compaction.scan_live(table, READ).collect())) == before
    assert table.read().where("state <> 'live'").count() == 0
    # Stopped for good between claim and swap: claimed files are still read, and can be given back.
    claimed = table.read().withColumns({"state": F.lit("claimed"), "claim": F.lit("dead")})
    table.upsert(claimed, ["object_id"])
    assert sorted(map(tuple, compaction.scan_live(table, READ).collect())) == before
    assert compaction.compact_due(table, root, "s") == 0
    compaction.release(table)
    assert compaction.compact_due(table, root, "s") == 8
