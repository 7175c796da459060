"""Byte-level BPE encoding and decoding.

A sentencepiece BPE model is written directly from the vocabulary: each token's
bytes are mapped to one character a byte (``chr(0x100 + byte)``), its score is
its negative rank, and the normaliser is the identity. The model encodes
pre-tokens; ids are decoded by mapping the pieces' characters back to bytes.

Defined results: a null text counts as empty, an empty text has no ids and the
digests of no bytes; rows are independent of each other, so repeated rows and
ties give repeated rows; an empty table gives an empty result; other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .pretokens import TextEncoder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def read_ranks(path: str) -> list[bytes]:
    """The tokens' bytes in rank order from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    return [ranks[i] for i in range(len(ranks))]


CHARS = {b: chr(0x100 + b) for b in range(256)}


def to_chars(data: bytes) -> str:
    return data.decode("latin-1").translate(CHARS)


def to_bytes(chars: str) -> bytes:
    return bytes([ord(c) - 0x100 for c in chars])


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto; piece i + 1 is the token of rank i, piece 0 the unknown one."""
    unknown = _message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2)
    model = [_message(1, unknown)]
    for rank, token in enumerate(tokens):
        model.append(_message(1, _message(1, to_chars(token).encode()) + b"\x15" + struct.pack("<f", -float(rank)) + _number(3, 1)))
    trainer = _number(3, 2) + _number(4, len(tokens) + 1)  # BPE
    normaliser = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(model) + _message(2, trainer) + _message(3, normaliser)


class Codec:
    """One process's encoder and decoder of a serialised model."""

    def __init__(self, model: bytes, pattern: str = public_tokenizers.PATTERN):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.processor.get_piece_size() - 1
        self.tokens = [to_bytes(self.processor.id_to_piece(i + 1)) for i in range(n)]
        self.known = {token: struct.pack("<I", i) for i, token in enumerate(self.tokens)}
        self.pattern = pattern
        self.texts = TextEncoder(pattern, self._pieces, self._whole)

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        data = [p.encode() for p in pieces]
        rest = [d for d in data if d not in self.known]  # a pre-token that is a token needs no merges
        merged = dict(zip(rest, self.processor.encode([to_chars(d) for d in rest], num_threads=1), strict=True)) if rest else {}
        return [self.known[d] if d in self.known else struct.pack(f"<{len(merged[d])}I", *[i - 1 for i in merged[d]]) for d in data]

    def _stand_in(self, char: str) -> str:
        """A character of the kind that the library's Unicode tables give to one that this Python's tables lack."""
        import tiktoken

        if not hasattr(self, "kinds"):
            every = {bytes([b]): b for b in range(256)}
            self.kinds = [(tiktoken.Encoding(kind, pat_str=rf"\p{{{kind}}}", mergeable_ranks=every, special_tokens={}), stand_in) for kind, stand_in in (("L", "\u4e00"), ("N", "\u0664"))]
        return next((stand_in for kind, stand_in in self.kinds if kind.encode_ordinary(char)), "\u2603")

    def _whole(self, text: str) -> bytes:
        """The pattern splits the text with stand-ins for characters it can't know; the model encodes the pre-tokens as they are."""
        known = self.texts.odd.sub(lambda found: self._stand_in(found[0]), text)
        return b"".join(self._pieces([text[m.start() : m.end()] for m in self.texts.split.finditer(known)]))

    def encode(self, texts: list[str | None] | pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(ids, offsets)`` of slices of the texts in order."""
        return self.texts.encode(texts)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


_CODECS: dict[str, Codec] = {}


def codec(model: bytes) -> Codec:
    """The codec of this Python process, which serves many tasks."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(model)
    return _CODECS[key]


def encode_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, with_ids: bool = True) -> DataFrame:
    """``(id_col, n_tokens, ids, ids_sha256, decoded_sha256)`` of every row.

    The vocabulary (under 1 MB, of a fixed size) goes to the executors once;
    texts are only read, never shuffled. with_ids: whether ``ids``, an array of
    int, is given.
    """
    model = df.sparkSession.sparkContext.broadcast(serialise(read_ranks(vocabulary or public_tokenizers.path(VOCABULARY))))
    kind = df.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(model.value)
        for batch in batches:
            done = 0
            for ids, at in bpe.encode(batch.column(1)):
                n = len(at) - 1
                each = [ids[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                first = [hashlib.sha256(x).hexdigest() for x in each]
                second = [hashlib.sha256(bpe.decode(x)).hexdigest() for x in each]
                columns = [batch.column(0).slice(done, n), pa.array(np.diff(at)), pa.array(first, pa.string()), pa.array(second, pa.string())]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype("<i4"))))
                    names.append("ids")
                done += n
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema)
    return out.withColumnRenamed("id", id_col)


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count and the digests of its ids and of the decoded bytes."""
    return encode_texts(table(spark, sf_dir, "documents"), with_ids=False)
