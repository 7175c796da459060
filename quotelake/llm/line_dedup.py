"""Removal of boilerplate lines by the spread of each line over sites.

HyperLogLog sketches of the sites are kept per line digest and merge by
aggregation, so a line on very many pages is never gathered. A line whose
estimate is clear of the threshold is decided by it; the others near the
threshold get exact distinct counts. Lines on ``min_sites`` sites or more go
from every text.

Defined results: lines are divided at line feeds; blank lines always stay; a
null site is no site; a null text stays null, an empty one empty; rows alike in
id and text share their result and are all kept; an empty table gives an empty
result; other columns pass through, but input columns named ``n_lines`` and
``n_removed`` are replaced. Lines are told apart by
128-bit digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.names import fresh
from .common import cut, digest, table

MIN_SITES = 10
LOG_BUCKETS = 10  # a relative error of about 1.04 / sqrt(1024) = 3.3 %
MARGIN = 0.15  # estimates within it of the threshold are counted exactly


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``line`` digests found on ``min_sites`` sites or more, from rows of (line, site)."""
    spread = lines.where(F.col("site").isNotNull()).groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LOG_BUCKETS)).alias("sketch"))
    spread = cut(spread.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= (1 - MARGIN) * min_sites - 1), "spread")
    clear = F.col("sites") > (1 + MARGIN) * min_sites + 1
    near = lines.join(spread.where(~clear).select("line"), "line", "left_semi")
    exact = near.where(F.col("site").isNotNull()).groupBy("line").agg(F.countDistinct("site").alias("sites")).where(F.col("sites") >= min_sites)
    return spread.where(clear).select("line").unionByName(exact.select("line"))


def drop_boilerplate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``df`` with the lines taken out of its texts, and ``n_lines`` and ``n_removed``.

    Lines are shuffled as digests; texts once, to meet what is to be taken out of them.
    """
    columns = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    row = digest(F.col(id_col), F.col(text_col))
    lines = df.select(row.alias("row"), F.col(site_col).cast("string").alias("site"), F.explode(lines_of(F.col(text_col))).alias("text"))
    lines = cut(lines.where(F.trim("text") != "").select("row", "site", digest(F.col("text")).alias("line")), "lines")
    found = lines.select("row", "line").join(boilerplate(lines.select("line", "site"), min_sites), "line")
    own, other, out = fresh(df, "row", "other_row", "gone")
    gone = found.groupBy(F.col("row").alias(other)).agg(F.collect_set("line").alias(out))
    joined = df.select(*columns, row.alias(own)).join(gone, F.col(own) == F.col(other), "left")
    whole = lines_of(F.col(text_col))
    kept = F.filter(whole, lambda x: (F.trim(x) == "") | ~F.array_contains(out, digest(x)))
    clean = F.when(F.col(out).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    n_lines = F.coalesce(F.size(whole), F.lit(0)).cast("long")
    removed = F.when(F.col(out).isNull(), 0).otherwise(F.size(whole) - F.size(kept)).cast("long")
    return joined.select(*[clean.alias(c) if c == text_col else F.col(c) for c in columns], n_lines.alias("n_lines"), removed.alias("n_removed"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, removed lines, and the digest of the text that stays."""
    clean = drop_boilerplate(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_removed", F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("text_md5"))


OP8_SQL = rf"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
b AS (SELECT line FROM l WHERE trim(line) <> '' GROUP BY line HAVING count(DISTINCT source) >= {MIN_SITES}),
m AS (SELECT l.doc_id, l.pos, l.line, b.line IS NOT NULL AS gone FROM l LEFT JOIN b ON l.line = b.line),
c AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       strlen(c.text)::BIGINT AS n_bytes, md5(c.text) AS text_md5
FROM documents d LEFT JOIN c USING (doc_id)
"""
