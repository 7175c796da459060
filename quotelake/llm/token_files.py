"""Token-id files with fixed-width bit packing.

Each id takes the minimum bits that the vocabulary needs. Documents are written
in ascending id order as blocks; a block is one row of a Parquet file in the
shared folder (Spark commits the files, so a lost executor's part is written
again whole) and holds

* ``shard``, ``block``: its place; shards and blocks in this order are the ids in order,
* ``first``: ids of the shard before it, ``n_ids``, ``bits``,
* ``doc_ids``, ``offsets``: its documents and where in the block each begins (and the last ends),
* ``data``: the packed ids, id i at bit ``i * bits``, lowest bit first.

Any range of ids is read by unpacking the eight-id groups that hold it.

Defined results: a null text counts as empty and has the end id alone; null ids
come first; rows of one id are ordered by their text and all kept; an empty
table gives no blocks; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, table
from .pretokens import TextEncoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOCK_IDS = 1 << 18
#: Bytes of text that are encoded together.
ROOM = 4_000_000


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids take ``bits`` bytes."""
    n = len(ids)
    groups = np.zeros((-(-n // 8), 8), np.uint64)
    groups.reshape(-1)[:n] = ids
    out = np.zeros((len(groups), bits), np.uint8)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        value = groups[:, j] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-n * bits // 8)]


def unpack(data: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """The ids ``start`` to ``stop`` of a block."""
    low, high = start // 8, -(-stop // 8)
    part = np.zeros((high - low) * bits, np.uint8)
    have = np.frombuffer(data, np.uint8)[low * bits : high * bits]
    part[: len(have)] = have
    part = part.reshape(-1, bits)
    out = np.zeros((high - low, 8), np.uint64)
    for j in range(8):
        byte, shift = divmod(j * bits, 8)
        for k in range(-(-(shift + bits) // 8)):
            out[:, j] |= part[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (out[:, j] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[start - 8 * low : stop - 8 * low].astype("<u4")


def byte_characters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)}


class Encoder:
    """The tokenizers library with what it gave for short pre-tokens kept.

    Pre-tokens go to the library's model directly, which spares its records of
    offsets and masks; texts that need more than the model go to it whole.
    """

    def __init__(self, definition: str, room: int = ROOM):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.tokenize, self.chars = self.tokenizer.model.tokenize, byte_characters()
        self.texts = TextEncoder(public_tokenizers.PATTERN, self._pieces, self._whole, room=room)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        out = []
        for piece in pieces:
            plain = piece.isascii() and piece.isprintable()  # of these bytes, only the space has another character
            chars = piece.replace(" ", self.chars[32]) if plain else piece.encode().decode("latin-1").translate(self.chars)
            out.append(array("I", [t.id for t in self.tokenize(chars)]).tobytes())
        return out

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _special(self, text: str) -> bytes | None:
        """A text that holds an added token's string goes to the library whole."""
        return self._whole(text) if any(s in text for s in self.special) else None

    def encode(self, texts: list[str] | pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        return self.texts.encode(texts, self._special if self.special else None)


_ENCODERS: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    key = zlib.crc32(definition.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(definition)
    return _ENCODERS[key]


def write_token_files(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = END_ID) -> None:
    """Encodes ``df`` and writes the blocks below ``path``; one shuffle of the texts, by ranges of the id."""
    with open(tokenizer or public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        definition = df.sparkSession.sparkContext.broadcast(f.read())
    kind = df.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(definition.value)
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        docs, sizes, parts = [], [], []  # of the block that is being filled

        def flush() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            data = pack(np.concatenate(parts), enc.bits)
            row = [shard, block, first, int(offsets[-1]), enc.bits, pa.concat_arrays(docs), pa.array(offsets), data]
            return pa.RecordBatch.from_arrays([pa.array([x.to_pylist() if isinstance(x, pa.Array) else x], t) for x, t in zip(row, arrow.types, strict=True)], schema=arrow)

        for batch in batches:
            arrow = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.int32()), ("doc_ids", pa.list_(batch.schema.field(0).type)), ("offsets", pa.list_(pa.int64())), ("data", pa.binary())])
            done = 0
            for ids, at in enc.encode(batch.column(1)):
                ids = np.insert(ids, at[1:], end_id)
                at = at + np.arange(len(at))
                row, n = 0, len(at) - 1
                while row < n:
                    # Rows are added until the block holds BLOCK_IDS.
                    have = sum(map(len, parts))
                    stop = min(n, max(row + 1, int(np.searchsorted(at, at[row] + BLOCK_IDS - have))))
                    docs.append(batch.column(0).slice(done + row, stop - row))
                    sizes.append(np.diff(at[row : stop + 1]))
                    parts.append(ids[at[row] : at[stop]])
                    row = stop
                    if have + len(parts[-1]) >= BLOCK_IDS:
                        yield flush()
                        block, first = block + 1, first + have + len(parts[-1])
                        docs, sizes, parts = [], [], []
                done += n
        if docs:
            yield flush()

    schema = f"shard int, block int, first long, n_ids long, bits int, doc_ids array<{kind}>, offsets array<long>, data binary"
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(work, schema).write.parquet(path)


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, ids_crc32)`` of every document in the files.

    Only the shards' totals (a row for each task that wrote) are summed in one place.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = shards.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                base, bits, docs, offsets, data = (batch.column(k)[row].as_py() for k in range(5))
                ids = unpack(data, bits, 0, offsets[-1]).tobytes()
                at = np.array(offsets, np.int64)
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, batch.schema.field(2).type.value_type), pa.array(at[:-1] + base), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])

    placed = blocks.join(F.broadcast(before), "shard").select((F.col("base") + F.col("first")).alias("base"), "bits", "doc_ids", "offsets", "data")
    return placed.mapInArrow(work, f"id {kind}, start long, n_tokens long, ids_crc32 long").withColumnRenamed("id", id_col)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every document's ids to files and returns what reading them back gives."""
    path = scratch(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path)
