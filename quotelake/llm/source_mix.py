"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources get the weights 5, 2, 1, repeating, in code point order (null last) and
share ``epochs`` (1.5) times all words; a target stops at ``most`` (2) times its
source's size and the excess is shared again by weight. A source first takes
its whole epochs; what is left of its target is filled with the documents of
the smallest exponential keys ``-ln(u) / w``, where u follows from the document
alone (id and text) and w is its quality weight. The prefix sums that cut at the
budget are taken in two steps, over ranges of keys and inside a range, so that
no source, however large, meets in one task.

Only DataFrame functions are used.

Defined results: a null text or one without words has size 0, takes 0 and gets
no words; a null id is a value like others; repeated rows have the same key and
are ordered by a number of their own among the repetitions, so that each is
taken once at most in a fractional epoch; an empty table gives an empty result;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.names import fresh
from .common import cut, digest, table

WEIGHTS = (5.0, 2.0, 1.0)
WORD = r"[^\x20\x09-\x0D]+"
FEW_SOURCES = 100_000  # up to so many sources their table (some 100 bytes a row) is broadcast
RANGE_ROWS = 2000  # documents that a range of keys holds, about


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 to 2: higher for texts whose words have the length of words and which lie between 50 and 20,000 words."""
    mean = F.coalesce(F.length(text), F.lit(0)) / F.greatest(size, F.lit(1))
    return 1 + 0.5 * mean.between(3, 10).cast("double") + 0.5 * size.between(50, 20_000).cast("double")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds ``target`` to rows with a ``source`` and its ``source_size``.

    A target is ``min(most * size, level * weight)`` with the one level at which
    the targets add up; with sources ordered by ``size / weight`` the level
    follows from running sums, so no rounds are needed. Holds one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    upto = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("capped", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
    rows = rows.withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    rows = rows.withColumn("all", epochs * F.sum("source_size").over(everything))
    # The level if exactly the sources before this one stop at their caps.
    rows = rows.withColumn("level", (F.col("all") - F.col("capped")) / F.col("open_weight"))
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return rows.withColumn("target", target)


def sampling_key(id_: Column, text: Column, size: Column) -> Column:
    """``-ln(u) / w`` with u from the first 52 bits of a digest of id and text."""
    digest = F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)
    return -F.log(u) / quality_weight(text, size)


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, epochs: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(id_col, text_hash, source, size, source_size, target, taken)`` of every row.

    One pass over the texts writes ids, sizes and keys to the shared folder;
    only these are shuffled. The table with a row a source is broadcast if it
    was counted to have few rows; otherwise Spark chooses the join.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("size", n_words(F.col("text")))
    rows = rows.select("id", "source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("skey"), "size", sampling_key(F.col("id"), F.col("text"), F.col("size")).alias("key"), F.xxhash64("text").alias("text_hash"))
    rows = cut(rows, "mix-sizes")
    sums = rows.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sums = cut(sums, "mix-sources")
    small = F.broadcast if sums.count() <= FEW_SOURCES else lambda df: df
    mix = targets(sums, weights, epochs, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    mix = mix.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    mix = mix.select("skey", "source_size", "target", "whole", "rest", (F.floor(F.col("n") / RANGE_ROWS) + 1).alias("ranges"))
    rows = rows.join(small(mix), "skey")
    # 1 - exp(-1.5 key) rises with the key and lies in 0 to 1: the number of its range.
    rows = rows.withColumn("part", F.floor((1 - F.exp(-1.5 * F.col("key"))) * F.col("ranges")))
    over = Window.partitionBy("skey").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("skey", "part").agg(F.sum("size").alias("words"))
    base = ranges.select("skey", "part", F.coalesce(F.sum("words").over(over), F.lit(0)).alias("base"))
    inside = Window.partitionBy("skey", "part").orderBy("key", "text_hash", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("size").over(inside)).join(base, ["skey", "part"])
    end = F.col("base") + F.col("upto")
    # A document over the budget's edge is taken if that comes nearer to it.
    more = (end <= F.col("rest")) | (2 * F.col("rest") > 2 * end - F.col("size"))
    taken = F.col("size") * (F.col("whole") + (more & (F.col("whole") < most)).cast("long"))
    return rows.select(F.col("id").alias(id_col), "text_hash", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def apply_mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """``df`` with each row as often as the mix takes it: not at all, once, or more often."""
    mixed = mix_sources(df, id_col, text_col, source_col, **params)
    n = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    row, place, times = fresh(df, "row", "place", "times")
    hashed = lambda text_hash: digest(F.col(id_col), text_hash, F.col(source_col).cast("string"))
    # Rows alike in id, text and source are numbered, so that each meets one result.
    number = lambda by: F.row_number().over(Window.partitionBy(row).orderBy(by))
    mixed = mixed.withColumnRenamed("source", source_col) if source_col != "source" else mixed
    mixed = mixed.select(hashed(F.col("text_hash")).alias(row), n.cast("int").alias(times))
    mixed = mixed.withColumn(place, number(times)).where(F.col(times) > 0)
    rows = df.withColumn(row, hashed(F.xxhash64(F.col(text_col).cast("string")))).withColumn(place, number(row))
    rows = rows.join(mixed, [row, place]).withColumn(times, F.explode(F.sequence(F.lit(1), times)))
    return rows.select(*df.columns)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    return mix_sources(table(spark, sf_dir, "documents")).drop("text_hash", "source")


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size, coalesce(text, '') AS t,
         coalesce(length(text), 0) AS chars
  FROM documents),
k AS (
  SELECT doc_id, source, size, t,
         -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || t), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
         / (1 + 0.5 * (chars / greatest(size, 1) BETWEEN 3 AND 10)::INT + 0.5 * (size BETWEEN 50 AND 20000)::INT)::DOUBLE AS key
  FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
r AS (
  SELECT *, cap / weight AS ratio,
         coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_weight,
         1.5::DOUBLE * sum(source_size) OVER () AS everything
  FROM w),
l AS (SELECT *, max(CASE WHEN (everything - capped) / open_weight <= ratio THEN (everything - capped) / open_weight END) OVER () AS level FROM r),
m AS (SELECT source, source_size, least(cap, level * weight) AS target FROM l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM m),
c AS (
  SELECT k.doc_id, k.size, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS rest,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.t, k.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM k JOIN n ON k.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN whole < 2 AND (upto <= rest OR 2 * rest > 2 * upto - size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""
