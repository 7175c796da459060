"""Embedding near-duplicates by product quantisation.

Equal vectors of one label are one node. Coarse centroids and, for the residuals
to them, codebooks of subspaces are fitted on a bounded sample. Every node goes
to the inverted list of its nearest centroid with its codes and the length of
what the codes miss; a list has a core, whose residuals are short, and a rim.
A node is compared with its own list and with every core that can hold a vector
close enough (its radius bounds that, so none is missed); one in a rim also with
the rims of the ``PROBES`` nearest centroids. Distances come from a table of each query's
subspace distances (asymmetric: the query isn't coded); what the codes miss
bounds the true distance from below, so this filter loses nothing, and the rest
is ranked by the exact cosine in double precision. So only a link between two
rims, each beyond the other's probes, can be missed; tests measure that.

Queries and lists are cut to blocks of bounded size and meet as such, so work
grows with the input as long as lists keep their size; only link counts and a
spanning forest leave a pair of blocks, so a large group of close vectors gives
no list of all its pairs.

Defined results: a null label, or a vector that is null, empty, zero, or holds
null or non-finite components, links with nothing and is its own component;
vectors of different lengths don't link; rows alike in label and vector (by
128-bit digests) link with each other; null and repeated ids are values like
others (a component id is the least id that is not null, a row with a null id is
not kept); an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, digest, table
from .components import components
from .ngram_join import forest

SAMPLE = 16_384  # nodes that the index is fitted on, the least digests
SUBSPACES, CODES = 8, 64
BLOCK = 1024  # nodes that are compared together, and a list's aimed-at size in the largest label
PROBES = 4  # nearest centroids whose rims a node in a rim is compared with
SLACK = 1e-6  # added to what the bounds allow, for rounding


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids after a fixed number of rounds, begun with evenly spaced rows; an empty cluster keeps its centroid."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        n = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], axis=1)
        centres[n > 0] = total[n > 0] / n[n > 0, None]
    return centres


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


class Index:
    """Centroids and codebooks of one vector length."""

    def __init__(self, x: np.ndarray | None, lists: int = 1):
        self.fitted = x is not None
        if x is None:
            return
        self.centres = kmeans(x, min(lists, len(x)))
        self.apart = np.stack([np.sqrt(((self.centres - c) ** 2).sum(1)) for c in self.centres])
        rest = x - self.centres[_nearest(x, self.centres)]
        self.parts = [p for p in np.array_split(np.arange(x.shape[1]), SUBSPACES) if len(p)]
        self.books = [kmeans(rest[:, p], min(CODES, len(x))) for p in self.parts]

    def place(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, list[list[int]], np.ndarray, np.ndarray]:
        """List, other lists to be asked, codes, and the length that the codes miss, of each row.

        A centroid's core is list ``2 i``, its rim ``2 i + 1``; a core reaches ``radius`` far.
        """
        if not self.fitted:
            return np.zeros(len(x), int), [[]] * len(x), np.zeros((len(x), 0), np.uint8), np.full(len(x), 9.0, np.float32)
        far = np.maximum((x**2).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * x @ self.centres.T, 0)
        near = np.argmin(far, axis=1)
        rest = x - self.centres[near]
        own = 2 * near + (np.sqrt((rest**2).sum(1)) > radius)
        # What is in a list lies beyond the plane halfway between its centroid and the row's own one.
        beyond = far - far.min(axis=1, keepdims=True) <= 2 * radius * self.apart[near] + SLACK
        core = beyond & (np.sqrt(far) <= 2 * radius + SLACK)
        some = np.argpartition(far, min(PROBES, far.shape[1]) - 1, axis=1)[:, :PROBES]
        rim = np.zeros_like(beyond)
        np.put_along_axis(rim, some, (own % 2 == 1)[:, None], axis=1)
        asked = np.stack([core, rim & beyond], axis=2).reshape(len(x), -1)
        asked[np.arange(len(x)), own] = False
        codes = np.stack([_nearest(rest[:, p], b) for p, b in zip(self.parts, self.books, strict=True)], axis=1).astype(np.uint8)
        missed = rest - np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return own, [np.flatnonzero(row).tolist() for row in asked], codes, np.sqrt((missed**2).sum(1)).astype(np.float32)

    def distances(self, x: np.ndarray, which: int, codes: np.ndarray) -> np.ndarray:
        """Distances of each row to the coded vectors of a list, by table lookup."""
        if not self.fitted:
            return np.zeros((len(x), len(codes)), np.float32)
        rest, out = x - self.centres[which // 2], np.zeros((len(x), len(codes)), np.float32)
        for i, (p, book) in enumerate(zip(self.parts, self.books, strict=True)):
            q = rest[:, p]
            lookup = ((q**2).sum(1)[:, None] - 2 * q @ book.T + (book**2).sum(1)).astype(np.float32)
            out += lookup[:, codes[:, i]]
        return np.sqrt(np.maximum(out, 0))


def fit(nodes: DataFrame, block: int = BLOCK) -> dict[int, Index]:
    """An index for each vector length in the sample."""
    rows = nodes.select("key", "vector").orderBy("key").limit(SAMPLE).collect()
    most = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    lists = int(np.clip(2 ** np.ceil(np.log2(max(1.0, most / block))), 1, SAMPLE // 16))
    out = {}
    for size in {len(r.vector) for r in rows}:
        out[size] = Index(unit(np.array([r.vector for r in rows if len(r.vector) == size], np.float64)), lists)
    return out


def usable(vector: F.Column) -> F.Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_links(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93, block: int = BLOCK) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` of every row; pairs link at a cosine of ``threshold`` or more."""
    vector = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), vector.alias("vector"), F.col(label_col).alias("label"))
    good = usable(F.col("vector")) & F.col("label").isNotNull()
    rows = rows.withColumn("key", F.when(good, digest(F.col("label"), F.transform("vector", lambda x: x + 0.0))))
    nodes = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    # Written once, so the numbers stay what they are.
    nodes = cut(nodes.select("key", F.monotonically_increasing_id().alias("node"), F.xxhash64("label").alias("label"), "vector", "n", "least"), "vectors")
    index = df.sparkSession.sparkContext.broadcast(fit(nodes, block))
    kind = "<f4" if df.schema[vector_col].dataType.elementType.simpleString() == "float" else "<f8"
    radius = np.float32(np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-4)

    def of(size: int) -> Index:
        return index.value.get(size) or Index(None)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for size, part in frame.groupby(frame["vector"].map(len)):
                own, asks, codes, missed = of(size).place(unit(np.stack(part["vector"].to_list())), float(radius))
                yield pa.RecordBatch.from_pandas(pd.DataFrame({"node": part["node"], "label": part["label"], "n": part["n"], "size": np.int32(size), "list": own.astype(np.int32), "asks": asks, "codes": [c.tobytes() for c in codes], "missed": missed, "vector": [np.asarray(v, kind).tobytes() for v in part["vector"]]}), schema=placed_arrow, preserve_index=False)

    placed_arrow = pa.schema([("node", pa.int64()), ("label", pa.int64()), ("n", pa.int64()), ("size", pa.int32()), ("list", pa.int32()), ("asks", pa.list_(pa.int32())), ("codes", pa.binary()), ("missed", pa.float32()), ("vector", pa.binary())])
    placed = nodes.select("node", "label", "n", "vector").mapInArrow(place, "node long, label long, n long, size int, list int, asks array<int>, codes binary, missed float, vector binary")
    placed = cut(placed, "placed")
    where = ["label", "size", "list"]

    def in_blocks(rows: DataFrame, keep: DataFrame | None = None) -> DataFrame:
        """Rows of a list, dealt to blocks."""
        counts = rows.groupBy(*where).agg((F.floor(F.count(F.lit(1)) / block) + 1).cast("int").alias("blocks"))
        counts = counts.join(keep, where, "left_semi") if keep is not None else counts
        return rows.join(counts, where).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        """One row for a block; of a member, the lists that it asks are kept."""
        first = rows.iloc[:1]
        asks = [np.asarray(a, np.int32) for a in rows["asks"]]
        return pd.DataFrame({**{c: first[c] for c in (*where, "block", "blocks")}, "nodes": [rows["node"].tolist()], "n": [rows["n"].tolist()], "homes": [rows["home"].tolist()], "asks": [b"".join(a.tobytes() for a in asks)], "n_asks": [[len(a) for a in asks]], "codes": [b"".join(rows["codes"])], "missed": [rows["missed"].to_numpy(np.float32).tobytes()], "vectors": [b"".join(rows["vector"])]})

    body = ["nodes", "n", "homes", "asks", "n_asks", "codes", "missed", "vectors"]
    shape = "label long, size int, list int, block int, blocks int, nodes array<long>, n array<long>, homes array<int>, asks binary, n_asks array<int>, codes binary, missed binary, vectors binary"
    members = cut(in_blocks(placed.withColumn("home", F.col("list"))).groupBy(*where, "block").applyInPandas(gather, shape), "lists")
    queries = placed.select("node", "label", "n", "size", F.explode("asks").alias("list"), F.col("list").alias("home"), F.array().cast("array<int>").alias("asks"), F.lit(b"").alias("codes"), F.lit(0).cast("float").alias("missed"), "vector")
    queries = in_blocks(queries, placed.select(*where).distinct()).groupBy(*where, "block").applyInPandas(gather, shape)
    side = lambda rows, s: rows.select(*where, F.col("block").alias(f"block_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in body])
    inside = side(members, "a").join(side(members, "b"), where).where("block_a <= block_b").withColumn("inside", F.lit(True))
    across = side(queries, "a").join(side(members, "b"), where).withColumn("inside", F.lit(False))
    columns = ["size", "list", "inside", "block_a", "block_b", *[f"{c}_{s}" for s in "ab" for c in body]]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs, ns = [], [], []
            for row in batch.to_pylist():
                size, (a, b) = row["size"], ({c: row[f"{c}_{s}"] for c in body} for s in "ab")
                for part in (a, b):
                    part["x"] = unit(np.frombuffer(part["vectors"], kind).reshape(len(part["nodes"]), size).astype(np.float64))
                codes = np.frombuffer(b["codes"], np.uint8).reshape(len(b["nodes"]), -1)
                close = of(size).distances(a["x"], row["list"], codes) - np.frombuffer(b["missed"], np.float32)[None, :] <= radius
                i, j = np.nonzero(close)
                if not row["inside"]:
                    # A pair that meets in both lists counts where the lesser node asks.
                    homes = np.array(a["homes"], np.int64)
                    both = np.zeros((len(b["nodes"]), int(homes.max()) + 1), bool)
                    owner, asked = np.repeat(np.arange(len(b["nodes"])), b["n_asks"]), np.frombuffer(b["asks"], np.int32)
                    fits = asked < both.shape[1]
                    both[owner[fits], asked[fits]] = True
                    mine = ~both[j, homes[i]] | (np.array(a["nodes"])[i] < np.array(b["nodes"])[j])
                    i, j = i[mine], j[mine]
                exact = np.einsum("ij,ij->i", a["x"][i], b["x"][j]) >= threshold
                linked = np.zeros(close.shape, bool)
                linked[i[exact], j[exact]] = True
                nodes = a["nodes"]
                if row["inside"] and row["block_a"] == row["block_b"]:
                    linked |= linked.T
                    np.fill_diagonal(linked, False)
                    counts = linked @ np.array(a["n"])
                else:
                    counts = np.concatenate([linked @ np.array(b["n"]), linked.T @ np.array(a["n"])])
                    left, right = linked.any(axis=1), linked.any(axis=0)
                    nodes = nodes + b["nodes"]
                    some = np.flatnonzero(np.concatenate([left, right]))
                    whole = np.zeros((len(some),) * 2, bool)
                    whole[: left.sum(), left.sum() :] = linked[left][:, right]
                    linked, nodes, counts = whole | whole.T, [nodes[k] for k in some], counts[some]
                for k in np.flatnonzero(counts):
                    us.append(nodes[k])
                    vs.append(None)
                    ns.append(int(counts[k]))
                for x, y in forest(linked):
                    us.append(nodes[x])
                    vs.append(nodes[y])
                    ns.append(0)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64()), pa.array(ns, pa.int64())], names=["u", "v", "links"])

    met = inside.select(*columns).unionByName(across.select(*columns))
    links = cut(met.repartition(F.xxhash64("list", "block_a", "block_b", "nodes_a")).mapInArrow(compare, "u long, v long, links long"), "links")
    roots = components(links.where(F.col("v").isNotNull()).select("u", "v"))
    other = links.where(F.col("v").isNull()).groupBy("u").agg(F.sum("links").alias("other"))
    named = nodes.select("key", "node", "n", "least").join(roots, "node", "left").join(other, F.col("node") == F.col("u"), "left")
    named = named.select("key", "least", F.coalesce("root", "node").alias("root"), (F.col("n") - 1 + F.coalesce("other", F.lit(0))).alias("n_links"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select(F.col("key").alias("named"), "n_links", "component")
    out = rows.where(F.col("key").isNotNull()).join(named, F.col("key") == F.col("named")).select("id", "n_links", F.col("component").alias("component_id"))
    alone = rows.where(F.col("key").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = out.unionByName(alone).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    return out.withColumnRenamed("id", id_col)


def op2_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at a cosine of 0.93 between all embeddings of one label, and their components."""
    return vector_links(table(spark, sf_dir, "embeddings"))
