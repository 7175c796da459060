"""N-gram Jaccard join by vertical partitioning.

1. The document frequency of every n-gram is counted over all documents; the
   most frequent ones (at most ``HEAVY``) come last in the global order.
2. Two texts that link share n-grams among the first ones of either's set in
   that order. Shared rare ones are counted per pair, part by part of the order,
   and summed; texts that share a frequent one are drawn to the least of them,
   which keeps candidates linear in the input however many texts share it.
   Candidates that hang together form a group.
3. Inside a group, sets are dealt to blocks of bounded size. For each pair of
   blocks the global n-gram order is cut into fragments; the overlaps of all
   pairs are counted fragment by fragment, as products of membership matrices,
   and summed. The exact test follows, and of the links of a pair of blocks a
   spanning forest is kept, which is all that the classes need.
4. The classes are the connected components.

Every linked pair is tested with its exact overlap; frequencies and the order
only decide how much is tested. Identical texts are one node throughout.

Defined results: a null or empty text, or one without words, has no shingles
and its own class; fewer words than ``k`` give one shingle of all of them;
repeated rows, null ids and ids that occur twice are rows like others (a class
id is the least id that is not null); an empty table gives an empty result;
other columns are ignored, whatever their names. Texts are told apart by
64-bit digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.names import fresh
from .common import BATCH, cut, setting, table
from .components import components
from .shingles import shingles

HEAVY = 1 << 20  # n-grams that may be called frequent: bounds what is broadcast (16 MB)
FREQUENT = 8  # documents from which an n-gram counts as frequent
FLUSH = 2_000_000  # n-grams that a task holds before it passes them on
EXTRA = 20  # a set's first n-grams are this part of it more than one shared n-gram asks for
BLOCK = 150_000  # n-grams of the sets in a block, about
CROWD = 1000  # sets in a block at most, about: bounds the matrix of overlaps where sets are small
REACH = 8  # blocks that travel together: a task that compares pairs of blocks holds at most twice as many (20 MB)
FILTER_BITS = 1 << 27  # of the bitmap that candidates are filtered by (16 MB)
COLUMNS = 4096  # n-grams in a fragment of a pair of blocks
BUCKET = 1 << 20  # n-grams of all texts that one bucket gets, about
GIVEN = 8 << 20  # bytes of rows that a task is given at once


def need(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least overlap that a set of n needs to link with any other."""
    return -(-percent * n // 100)


def _deal(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending keys, where each bucket begins and the low 32 bits of each."""
    edges = np.searchsorted(keys >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))
    return edges, keys.astype(np.uint32)


def squeeze(ascending: np.ndarray) -> bytes:
    """Ascending 32-bit numbers as steps, split by bytes, of which compression removes the empty ones."""
    return np.ascontiguousarray(np.diff(ascending, prepend=np.uint32(0)).astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()


def unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).reshape(-1), dtype=np.uint32)


def bucket_bits(texts: DataFrame) -> int:
    """Of the number of buckets that n-grams are dealt to: by the length of the texts, however many partitions they come in."""
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    return min(24, max(8, int(np.ceil(np.log2(max(1, chars / (6 * BUCKET)))))))


def frequent_ngrams(texts: DataFrame, k: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (the top ``32 + bits`` bits of the hash) and document frequencies of the most frequent n-grams, by key.

    Counts cover all documents. A task passes on each key once with its count,
    about 3 bytes for most; keys are dealt by their top bits, so no key is hot.
    """
    shift = np.uint64(32 - bits)

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held) >> shift, return_counts=True)
        edges, low = _deal(keys, bits)
        parts = [(b, s) for b in range(1 << bits) if (s := slice(edges[b], edges[b + 1])).stop > s.start]
        many = [np.flatnonzero(counts[s] > 1) for _, s in parts]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([b for b, _ in parts], pa.int32()),
                pa.array([squeeze(low[s]) for _, s in parts], pa.binary()),
                pa.array([np.stack([m, counts[s][m]]).astype(np.uint32).tobytes() for m, (_, s) in zip(many, parts, strict=True)], pa.binary()),
            ],
            names=["bucket", "low", "more"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(shingles(text.as_py(), k))
                size += len(held[-1])
                if size > FLUSH:
                    yield emit(held)
                    held, size = [], 0
        if size:
            yield emit(held)

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        low, counts = [], []
        for a, b in zip(rows["low"], rows["more"], strict=True):
            low.append(unsqueeze(a))
            n = np.ones(len(low[-1]), np.int64)
            at, many = np.frombuffer(b, np.uint32).reshape(2, -1)
            n[at] = many
            counts.append(n)
        low, inverse = np.unique(np.concatenate(low), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
        pick = counts >= FREQUENT
        return pd.DataFrame({"key": (np.int64(rows["bucket"].iloc[0]) << 32) + low[pick].astype(np.int64), "n": counts[pick]})

    counted = texts.select("text").mapInArrow(work, "bucket int, low binary, more binary").groupBy("bucket").applyInPandas(total, "key long, n long")
    rows = counted.orderBy(F.desc("n"), "key").limit(HEAVY).toPandas().sort_values("key")
    return rows["key"].to_numpy(np.uint64), rows["n"].to_numpy(np.int64)


def prefix(grams: np.ndarray, keys: np.ndarray, counts: np.ndarray, percent: int, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The first n-grams of a set in the global order, which of them are frequent, and how many a link shares.

    The order has rare ones by hash, then frequent ones by frequency and hash.
    Of the first ``n - need + extra`` n-grams of two sets that link, at least the
    lesser ``extra`` are in both.
    """
    n = len(grams)
    extra = max(1, n // EXTRA)
    length = n - need(n, percent) + extra
    if not len(keys):
        return grams[:length], np.zeros(min(n, length), bool), extra
    key = grams >> np.uint64(32 - bits)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    often = np.where(keys[at] == key, counts[at], 0)
    by = np.lexsort((grams, often))[:length]
    return grams[by], often[by] > 0, extra


def _stars(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted by key and node: which places are the first of their key, and for all others an edge to the first."""
    first = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, bool)
    lead = np.flatnonzero(first)[np.cumsum(first) - 1] if len(keys) else np.zeros(0, np.int64)
    edges = np.stack([nodes[lead], nodes])[:, ~first]
    edges = edges[:, edges[0] != edges[1]]
    return first, np.unique(edges, axis=1)


def candidate_edges(texts: DataFrame, k: int, percent: int, bits: int, keys: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``(u, v)``: pairs of texts that may link, or that hang together by others that may.

    A rare n-gram is in fewer than ``FREQUENT`` documents: all pairs that share
    it are counted, per bucket of n-grams, and the counts are summed per pair; a
    pair that shares fewer than both sets' links would is dropped. A set with
    frequent n-grams among its first ones can't be judged by that count; its
    pairs all stay, and by each frequent n-gram it is drawn to the least text
    that has it too, first inside a task, then between tasks. An n-gram beyond
    the ``HEAVY`` ones that a bucket finds in ``FREQUENT`` documents or more draws
    them to the least one too: all that share it hang together, so the count of a
    pair need not have it.
    """
    order = texts.sparkSession.sparkContext.broadcast((keys, counts))
    shift = np.uint64(32 - bits)
    columns = ["low", "nodes", "least", "often", "often_nodes", "edges"]

    def emit(held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        key, often, node, least = (np.concatenate(x) for x in zip(*held, strict=True))
        key = key >> shift
        by = np.lexsort((node, key))
        key, often, node, least = key[by], often[by], node[by], least[by]
        first, edges = _stars(key[often], node[often])
        cuts = np.linspace(0, edges.shape[1], (1 << bits) + 1).astype(int)
        at, low = _deal(key[~often], bits)
        node_r, least_r = node[~often], least[~often].astype(np.uint16)
        at_o, low_o = _deal(key[often][first], bits)
        node_o = node[often][first]
        out = {c: [] for c in ["bucket", *columns]}
        for b in np.flatnonzero((np.diff(at) > 0) | (np.diff(at_o) > 0) | (np.diff(cuts) > 0)).tolist():
            s, t = slice(at[b], at[b + 1]), slice(at_o[b], at_o[b + 1])
            out["bucket"].append(b)
            for c, x in zip(columns, (low[s], node_r[s], least_r[s], low_o[t], node_o[t], np.ascontiguousarray(edges[:, cuts[b] : cuts[b + 1]])), strict=True):
                out[c].append(squeeze(x) if x.dtype == np.uint32 else x.tobytes())
        return pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), *[pa.array(out[c], pa.binary()) for c in columns]], names=["bucket", *columns])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = order.value
        held, size = [], 0
        for batch in batches:
            seen = set()
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if node in seen:
                    continue
                seen.add(node)
                grams = shingles(text.as_py(), k)
                if len(grams):
                    first, often, extra = prefix(grams, keys, counts, percent, bits)
                    least = 0 if often.any() else min(extra, 65_535)
                    held.append((first, often, np.full(len(first), node, np.int64), np.full(len(first), least, np.int64)))
                    size += len(first)
                if size > FLUSH // 2:
                    yield emit(held)
                    held, size = [], 0
        if size:
            yield emit(held)

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        get = lambda c, t: np.concatenate([unsqueeze(x) if t == np.uint32 else np.frombuffer(x, t) for x in rows[c]])
        key, node, least = get("low", np.uint32), get("nodes", np.int64), get("least", np.uint16).astype(np.int64)
        by = np.lexsort((node, key))
        key, node, least = key[by], node[by], least[by]
        one = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1]))) if len(key) else np.zeros(0, bool)
        key, node, least = key[one], node[one], least[one]
        _, which, n = np.unique(key, return_inverse=True, return_counts=True)
        many = n[which] >= FREQUENT
        crowded = _stars(key[many], node[many])[1]
        key, node, least = key[~many], node[~many], least[~many]
        pairs, d = [np.zeros((3, 0), np.int64)], 1
        while d < len(key) and (same := np.flatnonzero(key[d:] == key[:-d])).size:
            pairs.append(np.stack([node[same], node[same + d], np.minimum(least[same], least[same + d])]))
            d += 1
        pairs, n = np.unique(np.concatenate(pairs, axis=1), axis=1, return_counts=True)
        key, node = get("often", np.uint32), get("often_nodes", np.int64)
        by = np.lexsort((node, key))
        local = [np.frombuffer(x, np.int64).reshape(2, -1) for x in rows["edges"]]
        stars = np.unique(np.concatenate([_stars(key[by], node[by])[1], crowded, *local], axis=1), axis=1)
        zero = np.zeros(stars.shape[1], np.int64)
        return pd.DataFrame({"u": np.concatenate([pairs[0], stars[0]]), "v": np.concatenate([pairs[1], stars[1]]), "least": np.concatenate([pairs[2], zero]), "n": np.concatenate([n, zero])})

    dealt = texts.select("node", "text").mapInArrow(work, "bucket int, " + ", ".join(f"{c} binary" for c in columns))
    counted = dealt.groupBy("bucket").applyInPandas(join, "u long, v long, least long, n long")
    return counted.groupBy("u", "v").agg(F.min("least").alias("least"), F.sum("n").alias("n")).where(F.col("n") >= F.col("least")).select("u", "v")


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``: partial counts of each fragment, summed."""
    out = np.zeros((len(a), len(b)), np.int64)
    both = np.intersect1d(np.unique(np.concatenate(a)), np.unique(np.concatenate(b)), assume_unique=True)
    placed = []
    for sets in (a, b):
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(both, flat), max(0, len(both) - 1))
        hit = both[at] == flat if len(both) else np.zeros(len(flat), bool)
        by = np.argsort(at[hit], kind="stable")
        placed.append((owner[hit][by], at[hit][by]))
    for low in range(0, len(both), COLUMNS):
        parts = []
        for (owner, at), sets in zip(placed, (a, b), strict=True):
            s = slice(*np.searchsorted(at, [low, low + COLUMNS]))
            part = np.zeros((len(sets), min(COLUMNS, len(both) - low)), np.float32)
            part[owner[s], at[s] - low] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric boolean matrix as (node, root) pairs."""
    left, edges = linked.any(axis=1), []
    for root in range(len(linked)):
        if left[root]:
            left[root] = False
            edge = np.array([root])
            while len(edge):
                new = np.flatnonzero(linked[edge].any(axis=0) & left)
                left[new] = False
                edges += [(int(x), root) for x in new]
                edge = new
    return edges


def _sets(sizes: list[int], data: bytes) -> list[np.ndarray]:
    return np.split(np.frombuffer(data, np.uint64), np.cumsum(sizes)[:-1])


def links_within(nodes: list[int], a: list[np.ndarray], split: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among sets; split: if not 0, only between the first ``split`` sets and the others."""
    n = np.array([len(x) for x in a])
    first, second = (slice(0, split), slice(split, None)) if split else (slice(None), slice(None))
    common = overlaps(a[first], a[second])
    linked = 100 * common >= percent * (n[first][:, None] + n[second][None, :] - common)
    if split:
        whole = np.zeros((len(n),) * 2, bool)
        whole[:split, split:] = linked
        linked = whole | whole.T
    else:
        np.fill_diagonal(linked, False)
    return [(nodes[x], nodes[y]) for x, y in forest(linked)]


def filter_rows(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be in ``members``: a bitmap of a fixed size is broadcast, so few other rows are shuffled after it."""
    place = F.pmod(F.col(key), F.lit(FILTER_BITS))
    words = members.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("m")).toPandas()
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[words["w"].to_numpy(np.int64)] = words["m"].to_numpy(np.int64)
    shared = df.sparkSession.sparkContext.broadcast(bitmap)
    at = df.columns.index(key)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.mod(batch.column(at).to_numpy(zero_copy_only=False), FILTER_BITS)
            yield batch.filter(pa.array((shared.value[p >> 6] >> (p & 63)) & 1 == 1))

    return df.mapInArrow(work, df.schema)


def meetings(blocks: DataFrame) -> DataFrame:
    """Rows of blocks with the cells ``low, high`` in which they meet: every two blocks of a group in exactly one.

    Blocks travel in runs of ``REACH``; a cell has one run or two. So a block is sent
    once for each run of its group, and no task holds more than two runs.
    """
    runs = F.sequence(F.lit(0), F.floor((F.col("blocks") - 1) / REACH).cast("int"))
    rows = blocks.withColumn("run", F.floor(F.col("block") / REACH).cast("int")).withColumn("other", F.explode(runs))
    return rows.withColumn("low", F.least("run", "other")).withColumn("high", F.greatest("run", "other")).drop("other")


def links_of_cell(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links ``(u, v)`` between the two runs of a cell, or inside its only one: a spanning forest for each pair of blocks."""
    alone = rows["low"].iloc[0] == rows["high"].iloc[0]
    parts = list(zip(rows["run"], rows["nodes"], rows["sizes"], rows["grams"], strict=True))
    out = []
    for i, (run, nodes, sizes, data) in enumerate(parts):
        for run_b, nodes_b, sizes_b, data_b in parts[i + 1 :]:
            if alone or run != run_b:
                out += links_within([*nodes, *nodes_b], _sets(sizes, data) + _sets(sizes_b, data_b), len(nodes), percent)
    return pd.DataFrame(out, columns=["u", "v"], dtype=np.int64)


def verified_edges(texts: DataFrame, groups: DataFrame, k: int, percent: int) -> DataFrame:
    """Links ``(u, v)`` inside the groups: a spanning forest for each pair of blocks.

    texts: ``node, row, text``; groups: ``node, grp``. Narrow rows choose the one
    row that stands for all copies of a text, and the block; only the chosen
    texts are shuffled. Groups of one block are tested where they are gathered,
    pairs of blocks in cells that hold a bounded number of them.
    """
    chosen = texts.groupBy("node").agg(F.min(F.struct("row", F.length("text").alias("chars"))).alias("one")).join(groups, "node").select("node", "grp", "one.*")
    room = F.greatest(F.floor(F.sum("chars") / (6 * BLOCK)), F.floor(F.count(F.lit(1)) / CROWD))
    sizes = chosen.groupBy("grp").agg((room + 1).cast("int").alias("blocks"))
    chosen = chosen.join(sizes, "grp").select("row", "grp", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    chosen = cut(chosen, "candidates")
    members = filter_rows(texts, chosen, "row").join(chosen, "row")
    columns = ["u", "v", "grp", "block", "blocks", "nodes", "sizes", "grams"]

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node")
        sets = [shingles(text, k) for text in rows["text"]]
        some = [i for i, x in enumerate(sets) if len(x)]
        nodes, sets = [int(rows["node"].iloc[i]) for i in some], [sets[i] for i in some]
        edges = links_within(nodes, sets, 0, percent) if sets else []
        none = dict.fromkeys(columns)
        out = [none | {"u": u, "v": v} for u, v in edges]
        blocks = int(rows["blocks"].iloc[0])
        if blocks > 1 and sets:
            out.append(none | {"grp": int(rows["grp"].iloc[0]), "block": int(rows["block"].iloc[0]), "blocks": blocks, "nodes": nodes, "sizes": [len(x) for x in sets], "grams": np.concatenate(sets).tobytes()})
        return pd.DataFrame(out, columns=columns, dtype=object)

    found = members.groupBy("grp", "block").applyInPandas(gather, "u long, v long, grp long, block int, blocks int, nodes array<long>, sizes array<int>, grams binary")
    found = cut(found, "links")
    met = meetings(found.where("grp IS NOT NULL").drop("u", "v"))
    between = met.groupBy("grp", "low", "high").applyInPandas(lambda rows: links_of_cell(rows, percent), "u long, v long")
    return found.where("u IS NOT NULL").select("u", "v").unionByName(between)


def ngram_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``(id_col, node, root, n_shingles, component_id)`` of every row; texts link when ``100 * intersection >= percent * union``.

    node: the text's 64-bit digest, null without shingles; root: that of its class.
    """
    spark = df.sparkSession
    text = F.col(text_col).cast("string")
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("node"), F.xxhash64(F.col(id_col), text).alias("row"))
    texts = rows.where(F.col("text").isNotNull())
    with setting(spark, BATCH, str(GIVEN)):  # all that runs in Python is written inside
        bits = bucket_bits(texts)
        keys, counts = frequent_ngrams(texts, k, bits)
        groups = components(candidate_edges(texts, k, percent, bits, keys, counts)).withColumnRenamed("root", "grp")
        classes = components(verified_edges(texts.select("node", "row", "text"), groups, k, percent))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = [len(shingles(text.as_py(), k)) for text in batch.column(2)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["id", "node", "n_shingles"])

        kind = df.schema[id_col].dataType.simpleString()
        counted = rows.select("id", "node", "text").mapInArrow(count, f"id {kind}, node long, n_shingles long")
        counted = cut(counted.withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node"))), "counted")
    nodes = counted.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("least"))
    nodes = nodes.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.join(least, "root").select(F.col("node").alias("named"), "root", "component_id")
    linked = counted.where(F.col("node").isNotNull()).join(named, F.col("node") == F.col("named")).select("id", "node", "root", "n_shingles", "component_id")
    empty = counted.where(F.col("node").isNull()).select("id", "node", F.col("node").alias("root"), "n_shingles", F.col("id").alias("component_id"))
    return linked.unionByName(empty).withColumnRenamed("id", id_col)


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` without near copies: of each class the row of the least id (a null one last), once.

    Rows without shingles all stay. Narrow rows choose; the texts are shuffled once.
    """
    classes = ngram_classes(df, id_col, text_col, k, percent)
    node, chosen_node, chosen_id = fresh(df, "node", "chosen_node", "chosen_id")
    named = classes.select(F.col(id_col).alias("id"), "node", "root")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node"))
    chosen = named.where(F.col("node").isNotNull()).groupBy("root").agg(first.alias("first")).select(F.col("first.id").alias(chosen_id), F.col("first.node").alias(chosen_node))
    row = df.withColumn(node, F.xxhash64(F.col(text_col).cast("string")))
    kept = row.join(chosen, (F.col(node) == F.col(chosen_node)) & F.col(id_col).eqNullSafe(F.col(chosen_id)), "left_semi").dropDuplicates([node])
    empty = F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")
    return kept.unionByName(row.where(empty)).select(*df.columns)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of four-word shingles and its class at a similarity of 0.85."""
    return ngram_classes(table(spark, sf_dir, "documents"), k=4, percent=85).drop("node", "root")
