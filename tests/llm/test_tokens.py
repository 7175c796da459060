"""Encoding, counting and token files against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quotelake.llm import bpe_codec, token_counts, token_files

ODD = [None, "", " ", "   ", "a  b", " x ", "the\n\n cat's  hat\t", "ñandú été", "中文🙂", "a" * 3000, "\U00010ee7 new", "\0\x1c\x85", "▁▁the ▁", "<|endoftext|>hi", "<s>x</s>", "x  y", "word " * 5000, "ab\n \n c", "ab  "]


def texts(spark):
    rows = [(i, t, "clash", i) for i, t in enumerate(ODD)] + [(3, ODD[3], "clash", 0), (None, "no id", "clash", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids long")


def adversarial(n=4000):
    random.seed(3)
    letters = list(" \n\tab'sñé▁\0\x85　中🙂éZ1９²")
    return ["".join(random.choice(letters) for _ in range(random.randint(0, 30))) for _ in range(n)]


def each(slices):
    return [ids[a:b].tolist() for ids, at in slices for a, b in zip(at, at[1:], strict=False)]


def test_codec_equals_the_library_and_round_trips(spark):
    import tiktoken

    with open(public_tokenizers.path(bpe_codec.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe_codec.encode_texts(texts(spark)).join(texts(spark).select("doc_id", "text"), "doc_id").collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        assert (r.n_tokens, r.ids) == (len(ids), ids.tolist())
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    codec = bpe_codec.Codec(bpe_codec.serialise(bpe_codec.read_ranks(public_tokenizers.path(bpe_codec.VOCABULARY))))
    many = adversarial()
    many += [None, "x" + chr(0x1C89) + "y " + chr(0x10D4A) + chr(0x10EC2) + "5" + chr(0x10D40) + " " + chr(0x2FFFF), *many[:50], "word " * 2_000_000]
    assert each(codec.encode(many)) == [library.encode_ordinary(x or "") for x in many]
    assert each(codec.encode([])) == []


def test_counts_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    for r in token_counts.count_tokens(texts(spark)).join(texts(spark).select("doc_id", "text"), "doc_id").collect():
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), len(library.encode(r.text or "")))
        assert r.over_limit == (r.n_tokens > 4096)
    with open(public_tokenizers.path(token_counts.MODEL), "rb") as f:
        counter = token_counts.Counter(f.read(), limit=50)
    many = adversarial()
    assert counter.counts(many) == [len(x) for x in library.encode(many)]


@pytest.mark.parametrize("bits", [1, 3, 8, 11, 16, 17, 32])
def test_packing_round_trips_and_reads_any_range(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1003).astype("<u4")
    data = token_files.pack(ids, bits)
    assert len(data) == -(-1003 * bits // 8)
    assert (token_files.unpack(data, bits, 0, 1003) == ids).all()
    assert (token_files.unpack(data, bits, 77, 801) == ids[77:801]).all()
    assert token_files.pack(ids[:0], bits) == b""


def test_files_give_the_library_s_ids_in_order(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(token_files.TOKENIZER))
    rows = [(None, "no id"), (None, ""), *enumerate(ODD), (3, ODD[3]), (3, "more"), (3, None)]
    docs = spark.createDataFrame(random.sample(rows, len(rows)), "doc_id long, text string").repartition(3)
    token_files.write_token_files(docs, f"file://{tmp_path}/files")
    got = [tuple(r) for r in token_files.read_token_files(spark, f"file://{tmp_path}/files").orderBy("start").collect()]
    want, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    with open(public_tokenizers.path(token_files.TOKENIZER), encoding="utf-8") as f:
        encoder = token_files.Encoder(f.read())
    many = adversarial()
    assert each(encoder.encode(many)) == [x.ids for x in library.encode_batch(many, add_special_tokens=False)]


def test_blocks_end_where_they_are_full(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 100)
    docs = spark.createDataFrame([(i, "word " * (i % 150)) for i in range(300)], "doc_id long, text string")
    token_files.write_token_files(docs.coalesce(1), f"file://{tmp_path}/files")
    blocks = spark.read.parquet(f"file://{tmp_path}/files").orderBy("shard", "block").collect()
    assert [i for b in blocks for i in b.doc_ids] == list(range(300)) and len(blocks) > 100
    assert all(b.n_ids == b.offsets[-1] and (b.n_ids >= 100 or b.block == max(x.block for x in blocks if x.shard == b.shard)) for b in blocks)
    assert all(b.offsets[-2] < 100 for b in blocks)


def test_empty_tables(spark, tmp_path):
    none = texts(spark).where(F.lit(False))
    assert bpe_codec.encode_texts(none).count() == 0
    assert token_counts.count_tokens(none).count() == 0
    token_files.write_token_files(none, f"file://{tmp_path}/files")
    assert token_files.read_token_files(spark, f"file://{tmp_path}/files").count() == 0


def test_ids_do_not_depend_on_the_slices():
    with open(public_tokenizers.path(token_files.TOKENIZER), encoding="utf-8") as f:
        definition = f.read()
    given = [t for t in ODD + adversarial(300) if t is not None]
    want = each(token_files.Encoder(definition, room=1 << 30).encode(given))
    assert each(token_files.Encoder(definition, room=50).encode(given)) == want
    assert len(list(token_files.Encoder(definition).encode(["word " * 600_000, "more"]))) == 1
