"""Packing of documents into sequences of a fixed number of tokens, as a cutting-stock problem.

A document's whole multiples of the sequence length are sequences by themselves; what
is left, its tail, is an item. Items of one length are alike, so the problem is that
of their histogram, which has fewer rows than a sequence has tokens whatever the
corpus' size: only it comes to the driver. A linear program over patterns (how many
items of each length share a sequence) covers the histogram at the least padded
length; its columns are priced by a knapsack over the duals, which gives the best
pattern of every sum at once. A sequence whose length is a power of two needs no
padding, so such sums cost themselves and others the whole length. Patterns are
rounded down, what they leave is filled first-fit, and patterns that would be padded
by more than ``slack`` tokens are given up. Documents are ranked within their tail's
length, in salted parts, and a rank tells the pattern, sequence and offset.

Tails that no pattern takes are cut at the powers of two that make up their length.
Such pieces in descending order fill sequences exactly, and the last, shorter rest
falls into sequences of powers of two, so they need no padding.

Defined results: a null text is empty and has the end id alone; repeated and null ids
are documents of their own; an empty table gives no pieces; other columns are ignored,
whatever their names. Which of the documents with tails of one length stand in which
sequence depends on their ids and contents alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, last_kept, table
from .token_files import TOKENIZER, encoder

SIZE, END_ID = 2048, 1
#: A pattern is kept if it is padded by no more than this.
SLACK = 4
#: The program ends when its value is within this share of a lower bound, or after so many columns.
GAP, COLUMNS = 2e-3, 500
#: Columns that one pricing offers.
OFFERS = 60
#: Documents of one salted part.
PART = 1 << 19

Pattern = dict[int, int]


def cost(total: int, size: int) -> int:
    """The length that a sequence of so many tokens takes: a power of two needs no padding."""
    return total if total & (total - 1) == 0 else size


def first_fit(left: np.ndarray, size: int) -> Pattern:
    """A pattern of the longest items that still fit, of those ``left`` by length; none if all are gone."""
    pattern, room, length, have = {}, size, len(left) - 1, np.flatnonzero(left)
    while room and len(have):
        have = have[have <= room]
        if not len(have):
            break
        length = int(have[-1])
        n = min(int(left[length]), room // length)
        n = max(n, 1)
        pattern[length] = n
        room -= n * length
        have = have[:-1]
    return pattern


def sums(pattern: Pattern) -> int:
    return sum(k * n for k, n in pattern.items())


def start_basis(demand: np.ndarray, size: int) -> tuple[list[Pattern], list[int]]:
    """A pattern for each length in demand, each exhausting its length: a triangular basis. Second: the lengths in order of exhaustion."""
    left, patterns, order = demand.astype(float), [], []
    while (left > 0).any():
        pattern = first_fit(np.ceil(left), size)
        share = {k: left[k] / n for k, n in pattern.items()}
        last = min(share, key=share.get)
        amount = share[last]
        for k, n in pattern.items():
            left[k] = 0 if k == last else left[k] - amount * n
        gone = [k for k in pattern if k != last and left[k] < 1e-9]
        patterns.append(pattern)
        order.append(last)
        for k in gone:
            left[k] = 0
            patterns.append({k: size // k})
            order.append(k)
    return patterns, order


def knapsack(lengths: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For every sum of lengths up to ``size`` the highest value, and the last item that gives it."""
    best, item = np.full(size + 1, -np.inf), np.zeros(size + 1, np.int64)
    best[0] = 0
    upto = np.searchsorted(lengths, np.arange(size + 1), "right")
    for s in range(int(lengths[0]), size + 1):
        got = best[s - lengths[: upto[s]]] + value[: upto[s]]
        item[s] = k = int(got.argmax())
        best[s] = got[k]
    return best, item


def triangular_inverse(patterns: list[Pattern], lengths: list[int]) -> np.ndarray:
    """The inverse of the basis of which pattern i holds no length before ``lengths[i]``."""
    row = {k: i for i, k in enumerate(lengths)}
    earlier: list[list[tuple[int, int]]] = [[] for _ in lengths]
    for j, pattern in enumerate(patterns):
        for k, n in pattern.items():
            if row[k] != j:
                earlier[row[k]].append((j, n))
    inverse = np.zeros((len(lengths), len(lengths)))
    for i, k in enumerate(lengths):
        inverse[i, i] = 1
        for j, n in earlier[i]:
            inverse[i] -= n * inverse[j]
        inverse[i] /= patterns[i][k]
    return inverse


def linear_program(demand: np.ndarray, size: int, gap: float = GAP, columns: int = COLUMNS) -> list[tuple[Pattern, float]]:
    """Patterns and how often each is used, of the least total cost that gives every length its demand; column generation."""
    patterns, lengths = start_basis(demand, size)
    if not patterns:
        return []
    row = {k: i for i, k in enumerate(lengths)}
    ascending = np.array(sorted(lengths))
    place = np.array([row[int(k)] for k in ascending])
    inverse = triangular_inverse(patterns, lengths)
    price = np.array([cost(sums(p), size) for p in patterns], float)
    # Slightly different demands keep the method from standing still.
    wanted = demand[lengths] * (1 + 1e-7 * np.random.Generator(np.random.PCG64(1)).random(len(lengths)))
    used = np.maximum((inverse * wanted).sum(axis=1), 0)
    dual = (inverse * price[:, None]).sum(axis=0)
    costs = np.array([cost(s, size) for s in range(1, size + 1)])
    powers = [s for s in range(1, size + 1) if cost(s, size) == s]
    tokens, pivots = float((demand * np.arange(len(demand))).sum()), 0
    while pivots < columns:
        best, item = knapsack(ascending, dual[place], size)
        value = float((price * used).sum())
        if value <= (1 + gap) * max(tokens, value / max(1.0, float((best[1:] / costs).max()))):
            break
        # Of every sum that costs itself, the best pattern with each length: those that promise most enter.
        offers = []
        for s in powers:
            got = best[s - ascending[ascending <= s]] + dual[place[ascending <= s]] - s
            offers += [(float(g), s, i) for i, g in enumerate(got.tolist()) if g > 1e-6 * s]
        top = int((best[1:] / costs).argmax()) + 1
        offers = [(np.inf, top, int(item[top])), *sorted(offers, reverse=True)[:OFFERS]]
        entered = 0
        for _, s, i in offers:
            pattern: Pattern = {int(ascending[i]): 1}
            at = s - int(ascending[i])
            while at:
                k = int(ascending[item[at]])
                pattern[k] = pattern.get(k, 0) + 1
                at -= k
            where, many = [row[k] for k in pattern], np.array(list(pattern.values()), float)
            saving = float((dual[where] * many).sum()) - cost(s, size)
            way = (inverse[:, where] * many).sum(axis=1)
            able = way > 1e-9
            if saving <= 1e-9 * s or not able.any():
                continue
            ratio = np.where(able, used / np.where(able, way, 1), np.inf)
            out = int(ratio.argmin())
            step = ratio[out]
            used = np.maximum(used - step * way, 0)
            used[out] = step
            pivot = inverse[out] / way[out]
            inverse -= way[:, None] * pivot
            inverse[out] = pivot
            dual -= saving * pivot
            patterns[out], price[out] = pattern, cost(s, size)
            entered += 1
        pivots += entered
        if not entered:
            break
    return list(zip(patterns, used.tolist(), strict=True))


def whole_patterns(demand: np.ndarray, size: int, slack: int, gap: float = GAP, columns: int = COLUMNS) -> list[tuple[Pattern, int]]:
    """Patterns in whole numbers: the program's rounded down, then first-fit over what is left; those padded by more than ``slack`` are left out."""
    left, out = demand.copy(), []

    def take(pattern: Pattern, n: int) -> None:
        for k, many in pattern.items():
            left[k] -= many * n
        out.append((pattern, n))

    program = linear_program(demand, size, gap, columns)
    for pattern, amount in sorted(program, key=lambda x: -x[1]):
        n = min(int(amount + 1e-6), *(int(left[k]) // many for k, many in pattern.items()))
        if n and cost(sums(pattern), size) - sums(pattern) <= slack:
            take(pattern, n)
    rest = left.copy()
    while rest.any():
        pattern = first_fit(rest, size)
        n = min(int(rest[k]) // many for k, many in pattern.items())
        for k, many in pattern.items():
            rest[k] -= many * n
        if cost(sums(pattern), size) - sums(pattern) <= slack:
            take(pattern, n)
    return out


class Plan:
    """Where the document of each rank within its tail's length goes."""

    def __init__(self, demand: np.ndarray, patterns: list[tuple[Pattern, int]], size: int):
        self.size, self.bits = size, np.arange(size.bit_length() - 2, -1, -1)
        rows, supply, sequence = [], np.zeros(len(demand), np.int64), 0
        for pattern, n in patterns:
            offset = 0
            for k, many in sorted(pattern.items(), reverse=True):
                rows.append((k, int(supply[k]), many, sequence, offset))
                supply[k] += n * many
                offset += k * many
            sequence += n
        rows.sort()
        self.slots = np.array(rows, np.int64).reshape(-1, 5)
        self.supply, self.first_chain = supply, sequence
        # Pieces of powers of two in descending order, within one power by length and rank.
        rest = demand - supply
        has = (np.arange(len(demand))[:, None] >> self.bits) & 1
        number = rest[:, None] * has
        self.before = np.cumsum(number, axis=0) - number
        total = number.sum(axis=0) << self.bits
        self.begin = np.cumsum(total) - total
        self.full, self.rest = divmod(int(total.sum()), size)
        digits = [1 << int(b) for b in self.bits if self.rest >> int(b) & 1]
        self.ends = np.cumsum([0, *digits]).astype(np.int64)
        self.first_whole = sequence + self.full + len(digits)

    def whole(self, tail: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of tails that a pattern takes."""
        wide = int(max(rank.max(initial=0), self.slots[:, 1].max(initial=0))) + 1
        at = np.searchsorted(self.slots[:, 0] * wide + self.slots[:, 1], tail * wide + rank, "right") - 1
        _, start, many, sequence, offset = self.slots[at].T
        nth, copy = np.divmod(rank - start, many)
        return sequence + nth, offset + copy * tail

    def piece(self, tail: np.ndarray, rank: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of a tail's piece; bit: its place in ``bits``."""
        where = self.begin[bit] + ((self.before[tail, bit] + rank - self.supply[tail]) << self.bits[bit])
        nth, offset = np.divmod(where, self.size)
        digit = np.searchsorted(self.ends, offset, "right") - 1
        last = nth == self.full
        return self.first_chain + nth + np.where(last, digit, 0), offset - np.where(last, self.ends[np.minimum(digit, len(self.ends) - 1)], 0)


def encode_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """``id, n, tail, whole, crc, bits``: tokens, tokens of the tail, and check sums of the whole sequences, of the tail and of its pieces."""
    with open(tokenizer, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(definition.value)
        for batch in batches:
            done = 0
            for ids, at in enc.encode(batch.column(1)):
                data = memoryview(np.insert(ids, at[1:], end_id).astype("<u4").tobytes())
                at = at + np.arange(len(at))
                n = np.diff(at)
                whole, crc, bits = [], [], []
                for a, many in zip(at[:-1].tolist(), n.tolist(), strict=True):
                    tail = many % size
                    whole.append([zlib.crc32(data[4 * (a + k * size) : 4 * (a + k * size + size)]) for k in range(many // size)])
                    a += many - tail
                    crc.append(zlib.crc32(data[4 * a : 4 * (a + tail)]))
                    some = []
                    for b in range(tail.bit_length() - 1, -1, -1):
                        if tail >> b & 1:
                            some.append(zlib.crc32(data[4 * a : 4 * (a + (1 << b))]))
                            a += 1 << b
                    bits.append(some)
                lists = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(n)), pa.array(n), pa.array((n % size).astype(np.int32)), pa.array(whole, lists), pa.array(crc, pa.int64()), pa.array(bits, lists)], names=["id", "n", "tail", "whole", "crc", "bits"])
                done += len(n)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(work, f"id {kind}, n long, tail int, whole array<long>, crc long, bits array<long>")


def ranked(pieces: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """Adds ``rank`` within the length of the tail and ``before``, the whole sequences of documents before it; second: ``tail, n``.

    Rows are dealt to parts by their contents. They are numbered inside each part,
    and a small table of what each part holds gives where its numbers begin.
    """
    rows = pieces.withColumn("part", F.pmod(F.xxhash64("id", "n", "crc", "whole"), F.lit(parts)))
    order = ["id", "n", "crc", "whole", "bits"]
    held = rows.groupBy("part", "tail").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("whole")).alias("wholes"))
    so_far = (Window.unboundedPreceding, -1)
    tails = held.select("part", "tail", F.coalesce(F.sum("n").over(Window.partitionBy("tail").orderBy("part").rowsBetween(*so_far)), F.lit(0)).alias("first"))
    wholes = held.groupBy("part").agg(F.sum("wholes").alias("wholes"))
    wholes = wholes.select("part", F.coalesce(F.sum("wholes").over(Window.orderBy("part").rowsBetween(*so_far)), F.lit(0)).alias("wholes"))
    # One order serves both windows.
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("part", "tail").orderBy(*order)) - 1)
    rows = rows.withColumn("inside", F.coalesce(F.sum(F.size("whole")).over(Window.partitionBy("part").orderBy("tail", *order).rowsBetween(*so_far)), F.lit(0)))
    rows = rows.join(tails, ["part", "tail"]).join(wholes, "part")
    rows = rows.withColumns({"rank": F.col("first") + F.col("nth"), "before": F.col("wholes") + F.col("inside")})
    return rows.select("id", "n", "tail", "whole", "crc", "bits", "rank", "before"), held.groupBy("tail").agg(F.sum("n").alias("n"))


def place(rows: DataFrame, plan: Plan, id_col: str) -> DataFrame:
    """The pieces of ranked documents with their sequences."""
    given = rows.sparkSession.sparkContext.broadcast(plan)
    kind = rows.schema["id"].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Values, the row of each, and its number in the row."""
        n = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(n)), n)
        return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), row, np.arange(len(row)) - (np.cumsum(n) - n)[row]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = given.value
        for batch in batches:
            ids, lists, cuts = batch.column(0), batch.column(3), batch.column(5)
            n, tail, crc, rank, before = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2, 4, 6, 7))

            def give(row, start, length, sums_, sequence, offset):
                return pa.RecordBatch.from_arrays([ids.take(pa.array(row)), *(pa.array(np.asarray(x, np.int64)) for x in (start, length, sums_, n[row], sequence, offset))], names=names)

            sums_, row, nth = flat(lists)
            yield give(row, nth * where.size, np.full(len(row), where.size), sums_, where.first_whole + before[row] + nth, np.zeros(len(row)))
            row = np.flatnonzero((tail > 0) & (rank < where.supply[tail]))
            if len(row):
                yield give(row, (n - tail)[row], tail[row], crc[row], *where.whole(tail[row], rank[row]))
            sums_, row, nth = flat(cuts)
            some = (rank >= where.supply[tail])[row]
            sums_, row, nth = sums_[some], row[some], nth[some]
            has = (tail[row][:, None] >> where.bits) & 1
            bit = np.argmax(np.cumsum(has, axis=1) == (nth + 1)[:, None], axis=1)
            length = 1 << where.bits[bit] if len(bit) else np.zeros(0, np.int64)
            higher = tail[row] & ~(2 * length - 1)
            yield give(row, (n - tail)[row] + higher, length, sums_, *where.piece(tail[row], rank[row], bit))

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(work, schema).withColumnRenamed("id", id_col)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID, size: int = SIZE, slack: int = SLACK, part: int = PART) -> DataFrame:
    """One row a piece: ``id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset``. size: a power of two."""
    if size < 2 or size & (size - 1):
        raise ValueError("the length of a sequence must be a power of two")
    spark = docs.sparkSession
    pieces = cut(encode_pieces(docs, id_col, text_col, tokenizer or public_tokenizers.path(TOKENIZER), end_id, size), "pieces")
    with last_kept(spark):
        rows, tails = ranked(pieces, 64 + pieces.count() // part)
        demand = np.zeros(size, np.int64)
        for length, n in tails.collect():  # fewer rows than a sequence has tokens
            demand[length] = n
        demand[0] = 0
        plan = Plan(demand, whole_patterns(demand, size, slack), size)
    return place(rows, plan, id_col)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
