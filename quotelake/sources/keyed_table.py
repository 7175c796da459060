"""A table with unique keys on plain Parquet: staged, verified and swapped in whole.

Rows lie in hash buckets of their key. A write touches only the buckets of its
keys: their new contents are staged in a folder of their own and checked, and then
one small pointer file, moved to the next number, makes them the table's. A reader
takes the newest pointer, so it sees all of a write or nothing; a write that stops
before the pointer leaves the table as it was, and what it staged is never read. A
second writer finds the number taken, fails, and may run again, on a file system that
moves a file whole and not onto another (as HDFS does).

Defined results: rows whose key holds a null are left out; an empty table or write is
fine; of repeated keys in one write the order decides; a column that the table lacks
is left out, one that a write lacks is null.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import history, keyed

MODES = ("ignore", "overwrite", "merge")


class KeyedTable:
    """``root``: a folder that all executors share; ``schema`` and ``key`` hold for the table's life."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.key, self.buckets = spark, root.rstrip("/"), schema, key, buckets

    def _path(self, name: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _pointer(self) -> tuple[int, dict]:
        """The newest complete pointer: its number, and which folder each bucket is in and what was applied."""
        place, fs = self._path("pointers")
        found = sorted((f.getPath().getName() for f in fs.listStatus(place)), reverse=True) if fs.exists(place) else []
        for name in found:
            if name.isdigit():
                state = self._state(name)
                if state is not None:
                    return int(name), state
        return 0, {"folders": {}, "applied": {}}

    def _state(self, name: str) -> dict | None:
        """What a pointer says; none if it was cut short."""
        text = self.spark.read.option("wholetext", True).text(f"{self.root}/pointers/{name}").first()
        try:
            return json.loads(text.value) if text else None
        except ValueError:
            return None

    def _swap(self, number: int, state: dict) -> None:
        """Writes a pointer aside and moves it to its number, which fails if another writer was first."""
        gateway, jvm = self.spark.sparkContext._gateway, self.spark.sparkContext._jvm
        aside, fs = self._path(f"pointers/_{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        place, _ = self._path(f"pointers/{number:012d}")
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        files.rename(aside, place, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))

    def _read(self, folders: dict, buckets: list[int]) -> DataFrame:
        paths = [f"{self.root}/data/{folders[str(b)]}/bucket={b}" for b in buckets if str(b) in folders]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self) -> DataFrame:
        """The table as its newest pointer has it."""
        folders = self._pointer()[1]["folders"]
        return self._read(folders, [int(b) for b in folders])

    def stage(self, rows: DataFrame, order: list[str], mode: str, folders: dict) -> dict:
        """Writes the new contents of the touched buckets and checks them; gives the folder of each."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        kinds, names = {f.name: f.dataType for f in self.schema}, self.schema.names
        whole = reduce(lambda a, k: a & F.col(k).isNotNull(), self.key, F.lit(True))
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        typed = rows.select(*[(F.col(c) if c in rows.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in names], *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)]).where(whole)
        by = [f"order_{i}" for i in range(len(order))]
        touched = sorted(r.b for r in typed.select(bucket.alias("b")).distinct().collect())  # fewer than there are buckets
        if not touched:
            return {}
        stored = self._read(folders, touched)
        if mode == "ignore":
            new = keyed.keep_first(typed, self.key, by).select(*names)
            merged = stored.unionByName(new.join(stored.select(*self.key), self.key, "left_anti"))
        elif mode == "overwrite":
            new = keyed.keep_last(typed, self.key, by).select(*names)
            merged = stored.join(new.select(*self.key), self.key, "left_anti").unionByName(new)
        else:  # of each column the newest value that isn't null; what is stored is the oldest
            old = stored.select(*names, *[F.lit(None).cast(typed.schema[c].dataType).alias(c) for c in by])
            both = old.withColumn("age", F.lit(0)).unionByName(typed.withColumn("age", F.lit(1)))
            merged = history.merge_rows(both, self.key, ["age", *by], [c for c in names if c not in self.key]).select(*names)
        folder = uuid.uuid4().hex
        merged.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", *self.key).write.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        staged = self._read({str(b): folder for b in touched}, touched)
        keys = stored.select(*self.key).unionByName(typed.select(*self.key)).distinct().count()
        held, distinct = staged.agg(F.count(F.lit(1)), F.count_distinct(F.struct(*self.key))).first()
        if not held == distinct == keys:
            raise ValueError(f"staged {held} rows of {distinct} keys where there should be {keys}")
        return {str(b): folder for b in touched}

    def upsert(self, rows: DataFrame, order: list[str], mode: str = "overwrite", batch: tuple[str, int] | None = None) -> bool:
        """Writes rows by key: ``ignore`` keeps what is stored, else the first; ``overwrite`` takes the last; ``merge`` takes of each column the last that isn't null.

        batch: name of a source and number; one that was applied is left out, so a
        micro-batch that runs again changes nothing. Gives whether the table changed.
        """
        number, state = self._pointer()
        if batch and state["applied"].get(batch[0], -1) >= batch[1]:
            return False
        folders = self.stage(rows, order, mode, state["folders"])
        applied = state["applied"] | ({batch[0]: batch[1]} if batch else {})
        if not folders and applied == state["applied"]:
            return False
        self._swap(number + 1, {"folders": state["folders"] | folders, "applied": applied})
        return bool(folders)

    def vacuum(self, keep: int = 2) -> None:
        """Removes pointers but the newest ones, and folders that none of these names. No write may be running."""
        number, _ = self._pointer()
        place, fs = self._path("pointers")
        if number == 0:
            return
        used = set()
        for f in sorted(fs.listStatus(place), key=lambda f: f.getPath().getName(), reverse=True):
            name = f.getPath().getName()
            if name.isdigit() and int(name) > number - keep:
                used |= set((self._state(name) or {"folders": {}})["folders"].values())
            else:
                fs.delete(f.getPath(), False)
        data, fs = self._path("data")
        for f in fs.listStatus(data) if fs.exists(data) else []:
            if f.getPath().getName() not in used:
                fs.delete(f.getPath(), True)
