"""Ranked lexical search over a document-partitioned index, by a hybrid of term-at-a-time and document-at-a-time.

The index has one row a block of documents: their ids in ascending order, their
numbers of terms, and for each term the places and occurrences of the documents
that hold it. A search takes the corpus' numbers from the index (documents, terms,
documents of each query term), then each task walks its own blocks and keeps, per
item, the best ``k`` of all blocks it has met; these few rows meet in one window an
item. In a block an item is answered so:

1. Term at a time: the postings of its short lists are summed into accumulators.
2. The accumulators, sorted by document and bounded by the largest of them, are
   one more iterator beside the long lists, which are bounded by their largest
   contribution.
3. Document at a time, in windows of documents: iterators whose bounds together
   can't reach the k-th best score so far give no candidates; candidates of the
   others are looked up in them, the highest bound first, and leave as soon as
   what they have and the bounds that remain can't reach that score.

Defined results: a null text has no terms; documents without terms and items
without terms give nothing; rows of one item id are one item; repeated documents
are ranked each; equal scores go by ascending id, a null id last; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, table
from .words import classes, slices, split

K = 10
#: Terms are runs of ASCII letters and digits and of all other characters beyond ASCII.
KINDS = classes(bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))
#: Up to so many query terms are told to the tasks that index; with more, all terms are indexed.
VOCABULARY = 1 << 20
#: Item terms that one walk over the index answers; more items take several walks.
WALK_TERMS = 1 << 18
#: A list is short if it names less than one of so many of the block's documents.
SHORT = 16
WINDOW = 1024


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term``, each pair once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                names, codes, row, _ = split(texts, KINDS)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + row)), names.take(pa.array(codes))], names=["item", "term"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"item {kind}, term string").distinct()


def write_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: DataFrame | None = None) -> None:
    """Writes the blocks of all documents below ``path``; no shuffle. vocabulary: ``term``, the only ones to index; if there are not too many, the tasks are told them."""
    spark = docs.sparkSession
    known = None
    if vocabulary is not None and vocabulary.limit(VOCABULARY + 1).count() <= VOCABULARY:
        known = spark.sparkContext.broadcast([r.term for r in vocabulary.collect()])
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(known.value, pa.string()) if known else None
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                ids = batch.column(0).slice(first, len(texts))
                order = pc.sort_indices(ids)
                ids = ids.take(order)
                names, codes, row, _ = split(texts.take(order), KINDS)
                n = np.bincount(row, minlength=len(ids)).astype(np.int64)
                if asked is not None:
                    at = pc.fill_null(pc.index_in(names, value_set=asked), -1).to_numpy()[codes]
                    names, codes, row = asked, at[at >= 0], row[at >= 0]
                key, tf = np.unique(codes.astype(np.int64) * len(ids) + row, return_counts=True)
                term, at = np.divmod(key, max(1, len(ids)))
                begins = np.flatnonzero(np.diff(term, prepend=-1))
                held = pa.array([names.take(pa.array(term[begins])).to_pylist()], pa.list_(pa.string()))
                df = pa.array([np.diff(np.append(begins, len(term)))], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.to_pylist()], pa.list_(ids.type)), pa.array([int((n > 0).sum())], pa.int64()), pa.array([int(n.sum())], pa.int64()), held, df, pa.array([n.astype("<i8").tobytes()], pa.binary()), pa.array([at.astype("<i4").tobytes()], pa.binary()), pa.array([tf.astype("<i4").tobytes()], pa.binary())],
                    names=["ids", "n_docs", "n_terms", "terms", "df", "lengths", "places", "tfs"],
                )

    schema = f"ids array<{kind}>, n_docs long, n_terms long, terms array<string>, df array<long>, lengths binary, places binary, tfs binary"
    docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema).write.parquet(path)


class Best:
    """The best ``k`` (score, id) so far; ``floor``: a score below it can't be among them."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], 1

    def add(self, ids: pa.Array, places: np.ndarray, scores: np.ndarray) -> None:
        some = np.lexsort((places, -scores))[: self.k]  # ids ascend with their places
        fresh = zip(scores[some].tolist(), ids.take(pa.array(places[some])).to_pylist(), strict=True)
        self.rows = heapq.nsmallest(self.k, [*self.rows, *fresh], key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
        if len(self.rows) == self.k:
            self.floor = max(1, self.rows[-1][0])


def accumulate(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Term at a time: the lists' contributions summed by document, in order of the documents."""
    if len(lists) == 1:
        return lists[0]
    places, where = np.unique(np.concatenate([p for p, _ in lists]), return_inverse=True)
    total = np.zeros(len(places), np.int64)
    np.add.at(total, where, np.concatenate([s for _, s in lists]))
    return places, total


def answer(lists: list[tuple[np.ndarray, np.ndarray]], ids: pa.Array, best: Best, short: int = SHORT, window: int = WINDOW) -> None:
    """Adds an item's best documents of a block. lists: of each of its terms here, ascending places and contributions."""
    few = [x for x in lists if len(x[0]) * short < len(ids)]
    iterators = [x for x in lists if len(x[0]) * short >= len(ids)]
    if few:
        iterators.append(accumulate(few))
    if not iterators:
        return
    iterators.sort(key=lambda x: int(x[1].max()))
    bounds = np.cumsum([int(x[1].max()) for x in iterators])
    cuts = np.arange(0, len(ids) + window, window)
    spans = [np.searchsorted(x[0], cuts) for x in iterators]
    for i, low in enumerate(cuts[:-1]):
        lazy = int(np.searchsorted(bounds, best.floor))  # the first so many together stay below the floor
        if lazy == len(iterators):
            return
        score = np.zeros(window, np.int64)
        for (places, gives), span in zip(iterators[lazy:], spans[lazy:], strict=True):
            part = slice(span[i], span[i + 1])
            score[places[part] - low] += gives[part]
        found = np.flatnonzero(score)
        have = score[found]
        for k in range(lazy - 1, -1, -1):
            able = have + bounds[k] >= best.floor
            found, have = found[able], have[able]
            if not len(found):
                break
            places, gives = iterators[k]
            part = slice(spans[k][i], spans[k][i + 1])
            if part.start == part.stop:
                continue
            at = np.searchsorted(places[part], found + low)
            at[at == part.stop - part.start] = 0
            hit = places[part][at] == found + low
            have = have + np.where(hit, gives[part][at], 0)
        good = have >= best.floor
        if good.any():
            best.add(ids, found[good] + low, have[good])


def search_blocks(index: DataFrame, items: list[tuple[object, list[int]]], weights: list[tuple[str, int]], n_docs: int, n_terms: int, k: int, kind: str, id_kind: str) -> DataFrame:
    """``item, doc, score``: each task's best ``k`` of each item. weights: term and weight; items: id and its terms' numbers there."""
    given = index.sparkSession.sparkContext.broadcast((items, weights))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, terms = given.value
        number = {t: i for i, (t, _) in enumerate(terms)}
        best = [Best(k) for _ in asked]
        for batch in batches:
            for row in range(batch.num_rows):
                ids, held, df = (batch.column(c)[row].values for c in range(3))
                lengths, places, tf = (np.frombuffer(batch.column(c)[row].as_py(), t) for c, t in ((3, "<i8"), (4, "<i4"), (5, "<i4")))
                ends = np.cumsum(df.to_numpy())
                mine = np.array([number.get(t, -1) for t in held.to_pylist()], np.int64)
                w = np.array([terms[i][1] if i >= 0 else 0 for i in mine.tolist()], np.int64)
                m = 10 + 90 * lengths * n_docs // n_terms
                tf = tf.astype(np.int64)
                gives = np.repeat(w, df.to_numpy()) * (1_000_000_000 * tf // (1000 * tf + 8 * m[places]))
                lists = {}
                for i, a, b in zip(mine.tolist(), (ends - df.to_numpy()).tolist(), ends.tolist(), strict=True):
                    if i >= 0 and gives[a:b].any():
                        lists[i] = (places[a:b], gives[a:b])
                for (_, its), top in zip(asked, best, strict=True):
                    answer([lists[i] for i in its if i in lists], ids, top)
        rows = [(i, doc, score) for i, top in enumerate(best) for score, doc in top.rows]
        item, doc, score = ([r[c] for r in rows] for c in range(3))
        yield pa.RecordBatch.from_arrays([pa.array([asked[i][0] for i in item], pa_item), pa.array(doc, pa_id), pa.array(score, pa.int64())], names=["item", "doc", "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    out = index.sparkSession.createDataFrame([], f"item {kind}, doc {id_kind}, score long").schema
    pa_item, pa_id = to_arrow_type(out["item"].dataType), to_arrow_type(out["doc"].dataType)
    return index.select("ids", "terms", "df", "lengths", "places", "tfs").mapInArrow(work, out)


def search(index: DataFrame, terms: DataFrame, k: int = K, walk_terms: int = WALK_TERMS) -> DataFrame:
    """``item, rank, doc, score`` of each item's best ``k`` documents. index: what ``write_index`` wrote; terms: ``item, term``."""
    spark, kind, id_kind = index.sparkSession, terms.schema["item"].dataType.simpleString(), index.schema["ids"].dataType.elementType.simpleString()
    n_docs, n_terms = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    held = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log((F.lit(2.0) * n_docs + 2) / (F.lit(2.0) * F.col("df") + 1)))
    weighed = terms.join(held, "term").select("item", "term", weight.alias("w"))
    walks = max(1, -(-terms.count() // walk_terms))
    out = spark.createDataFrame([], f"item {kind}, doc {id_kind}, score long")
    for walk in range(walks):  # the queries of a walk are of bounded size
        rows = weighed.where(F.pmod(F.xxhash64("item"), F.lit(walks)) == walk).collect()
        number = {t: i for i, t in enumerate(sorted({r.term for r in rows}))}
        weights, items = dict.fromkeys(number, 0), {}
        for r in rows:
            weights[r.term] = r.w
            items.setdefault(r.item, []).append(number[r.term])
        if items:
            out = out.unionByName(search_blocks(index, list(items.items()), list(weights.items()), n_docs, n_terms, k, kind, id_kind))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last()))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("item", "rank", "doc", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    terms = item_terms(table(spark, sf_dir, "benchmark"), "item_id", "text")
    path = scratch(spark, "postings")
    write_index(table(spark, sf_dir, "documents"), path, vocabulary=terms.select("term").distinct())
    return search(spark.read.parquet(path), terms).select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


OP13_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents WHERE text IS NOT NULL),
e AS (SELECT r, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
s AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM e),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
t AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(ts) AS term FROM e) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term, nd),
x AS (SELECT item_id, r, doc_id, sum(w * (1000000000 * tf // (1000 * tf + 8 * (10 + 90 * n * nd // nt)))) AS score FROM q JOIN t USING (term) JOIN f USING (term), s GROUP BY ALL)
SELECT item_id, rank::INT AS rank, doc_id, score::BIGINT AS score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0) WHERE rank <= 10"""
