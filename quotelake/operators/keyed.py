"""Keyed writes as set operations: first wins, last wins, merge, rejects, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, key: list[str], order: list[str], stored: DataFrame | None = None) -> DataFrame:
    """Of each key the first row in order, unless the key is stored already.

    The whole row travels as one struct in a partial aggregate; no sort.
    """
    names = rows.columns
    out = rows.groupBy(*key).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("__row")).select("__row.*")
    return out.join(stored.select(*key), key, "left_anti") if stored is not None else out


def keep_last(rows: DataFrame, key: list[str], order: list[str], stored: DataFrame | None = None) -> DataFrame:
    """Of each key the last row in order; stored rows count as older than all others."""
    names = rows.columns
    if stored is not None:
        rows = rows.withColumn("__new", F.lit(1)).unionByName(stored.select(*names).withColumn("__new", F.lit(0)))
        order = ["__new", *order]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("__row")).select("__row.*")


def keep_first_if_set(rows: DataFrame, key: list[str], id_col: str, order: list[str]) -> DataFrame:
    """``keep_first`` over rows with an id; rows without one are all kept."""
    return keep_first(rows.where(F.col(id_col).isNotNull()), [*key, id_col], order).unionByName(rows.where(F.col(id_col).isNull()))


def upsert(rows: DataFrame, key: list[str], order: list[str], overwrite: list[str]) -> DataFrame:
    """Of each key the first row, with the named columns of the last one."""
    at = F.struct(*order)
    keep = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(*[(F.max_by if c in overwrite else F.min_by)(c, at).alias(c) for c in keep])


def missing_keys(rows: DataFrame, key: list[str], stored: DataFrame) -> DataFrame:
    """Keys to create: those of the rows that are not stored."""
    return rows.select(*key).distinct().join(stored, key, "left_anti")


def resolve_identity(facts: DataFrame, ref: str, dims: DataFrame, id_col: str, aliases: list[str]) -> DataFrame:
    """Adds ``resolved``: the dimension row that ``ref`` names, by id before any alias.

    Aliases are unpivoted with their priority and joined by equality; the best of
    several is chosen per name before the join, so facts are not multiplied.
    """
    names = F.array(*[F.struct(F.lit(i).alias("rank"), F.col(c).cast("string").alias("alias")) for i, c in enumerate([id_col, *aliases])])
    known = dims.select(F.col(id_col).alias("resolved"), F.inline(names)).where(F.col("alias").isNotNull())
    best = known.groupBy("alias").agg(F.min_by("resolved", F.struct("rank", "resolved")).alias("resolved"))
    return facts.join(best, F.col(ref).cast("string") == F.col("alias"), "left").drop("alias")


def split_rejects(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and rejects with the ``rule`` each breaks first. A rule that is null counts as kept."""
    broken = F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in rules.items()])
    tagged = rows.withColumn("rule", broken)
    return tagged.where(F.col("rule").isNull()).drop("rule"), tagged.where(F.col("rule").isNotNull())


def high_watermark(rows: DataFrame, key: list[str], time: str, cursor: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.max(time).alias(time), F.max_by(cursor, F.struct(time, cursor)).alias(cursor))


def write_deltas(samples: DataFrame, key: str, time: str, counter: str) -> DataFrame:
    """Growth of a counter since the sample before; falls and standstills are left out."""
    grown = F.col(counter) - F.lag(counter).over(Window.partitionBy(key).orderBy(time))
    return samples.withColumn("delta", grown).where("delta > 0")


def growth_per_hour(samples: DataFrame, key: str, time: str, size: str) -> DataFrame:
    """Bytes an hour since the sample before, over one second at least."""
    at = Window.partitionBy(key).orderBy(time)
    seconds = F.greatest(F.timestamp_diff("MICROSECOND", F.lag(time).over(at), F.col(time)) / 1e6, F.lit(1.0))
    return samples.withColumn("per_hour", (F.col(size) - F.lag(size).over(at)) * 3600 / seconds)


def fully_initialised(expected: DataFrame, seen: DataFrame, group: str, member: str) -> DataFrame:
    """Groups of which every member was seen."""
    marks = seen.select(member).distinct().withColumn("__seen", F.lit(1))
    return expected.join(marks, member, "left").groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count("__seen").alias("m")).where("n = m").select(group)
