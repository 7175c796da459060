"""A quality classifier by nearest-neighbour voting in a latent semantic space.

A text's terms are hashed byte pairs, triples of character classes, and how
often a word repeats the one before it, all counted over the whole text; term
weights are square roots of shares times an inverse document frequency. The
latent space is a truncated singular value decomposition of a bounded sample of
labelled rows, ``SAMPLE`` of each label at most (the least digests). The labelled
vectors are broadcast; every document's exact cosines with all of them come from
blocked matrix products, and its nearest labels vote, weighted by similarity.

Defined results: a null or empty text, or one of which nothing is known in the
latent space, gets the share of label 1 among the labelled rows that may be
learnt from; without any such rows all scores are 0.5; rows are independent, so
repeated rows get equal scores; labels that are null or not 0 or 1 are not
learnt from; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SAMPLE = 700
DIMENSIONS = 48
NEIGHBOURS = 15
PAIRS = 4096
CLASSES = 8
TERMS = PAIRS + CLASSES**3 + 16
THRESHOLD = 0.3

# 0 small letter, 1 capital, 2 digit, 3 blank, 4 line end, 5 sentence mark, 6 other sign, 7 beyond ASCII.
_CLASS = np.full(256, 6, np.uint32)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[[44, 46, 59, 58]], _CLASS[128:] = 0, 1, 2, 3, 4, 5, 7


def terms(text: str | None) -> np.ndarray:
    """Square roots of the terms' shares: pairs, class triples, and a run of repeated words; each part of length 1."""
    out = np.zeros(TERMS, np.float32)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(data) > 2:
        pairs = ((data[:-1] * np.uint32(0x9E3779B1)) ^ (data[1:] * np.uint32(0x85EBCA6B))) >> np.uint32(7)
        kinds = _CLASS[data]
        triples = (kinds[:-2] * CLASSES + kinds[1:-1]) * CLASSES + kinds[2:]
        out[:PAIRS] = np.bincount(pairs & np.uint32(PAIRS - 1), minlength=PAIRS)
        out[PAIRS : PAIRS + CLASSES**3] = np.bincount(triples, minlength=CLASSES**3)
        out[: PAIRS + CLASSES**3] /= len(data)
    words = (text or "").split()
    if len(words) > 1:
        same = sum(map(operator.eq, words, words[1:])) / (len(words) - 1)
        out[PAIRS + CLASSES**3 + min(15, int(same * 16))] = min(1.0, same * 2)
    return np.sqrt(out)


class Space:
    """The latent space and the labelled vectors in it."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, share: float):
        self.share, self.labels = share, labels.astype(np.float32)
        seen = (rows > 0).sum(axis=0)
        self.weight = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + 0.3
        x = rows * self.weight
        values, vectors = np.linalg.eigh((x @ x.T).astype(np.float64))
        top = np.argsort(values)[::-1][: min(DIMENSIONS, len(rows))]
        top = top[values[top] > 1e-9 * max(values.max(), 1e-30)]
        self.basis = (x.T @ (vectors[:, top] / np.sqrt(values[top]))).astype(np.float32)
        self.vectors = self._unit(x @ self.basis)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.sqrt((x**2).sum(axis=1, keepdims=True)), 1e-12)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        cosines = self._unit((rows * self.weight) @ self.basis) @ self.vectors.T
        k = min(NEIGHBOURS, cosines.shape[1])
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosines, near, 1), 0) ** 4
        total = weight.sum(axis=1)
        vote = (weight * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.clip(np.where(total > 1e-6, vote.astype(np.float64), self.share), 0, 1)


def held_out(id_: F.Column) -> F.Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Space | None:
    """Fits the space on at most ``SAMPLE`` rows of each label that are not held out.

    The sampled ids (a bounded number) are joined with the documents; features,
    of a fixed size each whatever the text's length, come to the driver.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "id").select("id", "y", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [terms(x.as_py()).astype(np.float16).tobytes() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["id", "y", "terms"])

    kind = docs.schema[id_col].dataType.simpleString()
    got = sorted(rows.mapInArrow(work, f"id {kind}, y int, terms binary").collect(), key=lambda r: (r.id, r.y, bytes(r.terms)))
    if not got:
        return None
    x = np.stack([np.frombuffer(r.terms, np.float16) for r in got]).astype(np.float32)
    return Space(x, np.array([r.y for r in got]), counts.get(1, 0) / sum(counts.values()))


def score_texts(docs: DataFrame, space: Space | None, text_col: str = "text") -> DataFrame:
    """Adds ``score`` to the rows; no shuffle. An input column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(space)
    docs = docs.drop("score")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    at = docs.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for low in range(0, batch.num_rows, 500):
                texts = batch.column(at).slice(low, 500).to_pylist()
                scores.append(shared.value.scores(np.stack([terms(x) for x in texts])) if shared.value else np.full(len(texts), 0.5))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[*batch.schema.names, "score"])

    return docs.mapInArrow(work, f"{kinds}, score double")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_texts(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
