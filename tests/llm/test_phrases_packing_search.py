"""Phrases, packing and search against brute force over words and ids."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotelake.llm import collocations, lexical_search, packing


def phrase_docs(spark):
    random.seed(5)
    words = ["a", "B", "c", "dé", "e-f", "\0x", "g"]
    rows = [(i, " ".join(random.choices(words, [9, 7, 5, 3, 2, 1, 1], k=random.randint(0, 40))).replace("g", random.choice([".", "g", "\n", ";\t"])), random.choice(["en", "fr", None]), "clash") for i in range(80)]
    rows += [(1, None, "en", "x"), (2, "", None, "x"), (None, "A b c. A b c\tA", "en", "x"), (3, rows[3][1], rows[3][2], "x"), (4, "b " * 3000, "de", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, phrase string")


def brute_phrases(rows, least, longest, share, top):
    counts, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r.lang is None else r.lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in able.items():
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in able.items())
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "longest", "shards", "slots", "top"), [(10, 3, 3, 1 << 25, 2000), (3, 4, 2, 1 << 16, 5), (4, 3, 5, 1 << 15, 2000), (2, 2, 1, 1 << 16, 2000)])
def test_phrases_equal_brute_force(spark, least, longest, shards, slots, top):
    docs = phrase_docs(spark).repartition(5)
    got = collocations.collocations(docs, least=least, longest=longest, shards=shards, slots=slots, top=top)
    assert sorted(map(tuple, got.collect())) == brute_phrases(docs.collect(), least, longest, 50, top)


def test_counted_phrases_are_grouped_by_one_string(spark):
    blocks = spark.createDataFrame([("a\tb c", ["x", "y"], np.array([0, 1, -1, 0, 1], "<i4").tobytes())] * 2, "lang string, words array<string>, codes binary")
    given = spark.sparkContext.broadcast(collocations.zlib.compress(np.full(1 << 15, 3, np.uint8)))
    got = collocations.named_counts(blocks, given, 3)
    assert {tuple(r) for r in got.collect()} == {("a\tb c", 1, "x", 4), ("a\tb c", 1, "y", 4), ("a\tb c", 2, "x y", 4)}
    assert "keys=[key#" in got._jdf.queryExecution().executedPlan().toString()


def test_rare_phrases_go_along_no_longer_than_they_count(spark, monkeypatch):
    kept = {}

    def cut(df, name, write=collocations.cut):
        kept[name] = (out := write(df, name)).count()
        return out

    monkeypatch.setattr(collocations, "cut", cut)
    random.seed(9)
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(random.choices(words, k=30) + ["of", "the", "same"]), "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = collocations.collocations(docs, least=10, slots=1 << 16)
    assert sorted(map(tuple, got.collect())) == brute_phrases(docs.collect(), 10, 3, 50, 2000)
    # The pairs of words, most of them rare, count in two scans and aren't in those after.
    assert kept["phrases-2"] > 500 and kept["phrases-3"] < 100


def test_a_task_counts_phrases_in_little_memory(monkeypatch):
    random.seed(9)
    names = pa.array([f"w{i}" for i in range(20_000)])
    blocks = [("en", names, np.array(random.choices(range(-1, 20_000), k=100_000), "<i4")) for _ in range(12)]
    monkeypatch.setattr(collocations, "COMBINED", 1_000_000)
    starts = np.ones(1 << 15, np.uint8)
    tracemalloc.start()
    try:
        n = sum(int(n.sum()) for _, n in collocations.counted(iter(blocks), starts, 1, 2, 3))
        assert tracemalloc.get_traced_memory()[1] < 50 * 1_000_000
    finally:
        tracemalloc.stop()
    full = [b[2] >= 0 for b in blocks]
    assert n == sum(int(f.sum() + (f[1:] & f[:-1]).sum() + (f[2:] & f[1:-1] & f[:-2]).sum()) for f in full)


def test_no_phrases_of_an_empty_table(spark):
    assert collocations.collocations(phrase_docs(spark).limit(0)).count() == 0


def test_phrase_scores_are_exact(spark):
    rows = [("en", "a b", 2, 30_000_000_007), ("en", "a", 1, 30_000_000_011), ("en", "b", 1, 30_000_000_013)]
    got = collocations.score_phrases(spark.createDataFrame(rows, "lang string, phrase string, size int, f long")).first()
    assert got.score == 1_000_000 * rows[0][3] ** 2 // (rows[1][3] * rows[2][3])


def pack_docs(spark):
    random.seed(7)
    rows = [(i, " ".join(random.choices(["the", "of", "nation", "été", "x", "\n"], k=int(random.expovariate(1 / 300)))), "clash") for i in range(150)]
    rows += [(500, "word " * 9000, "c"), (501, None, "c"), (502, "", "c"), (None, "no id at all", "c"), (3, rows[3][1], "c"), (3, rows[3][1], "c"), (3, "another", "c")] + [(600 + i, "same text " * 30, "c") for i in range(90)]
    return spark.createDataFrame(rows, "doc_id long, text string, tail string")


def check_packing(rows, docs, size, slack):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = Counter()
    for r in docs:
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        want[(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    ids_of = {}
    for r in docs:
        ids = np.array(library.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        ids_of.setdefault((r.doc_id, len(ids)), []).append(ids)
    # Every id lies in exactly one piece, and pieces hold the ids that they name.
    pieces = defaultdict(list)
    for r in rows:
        assert any(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for ids in ids_of[r.doc_id, r.doc_tokens])
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length))
    assert pieces.keys() == ids_of.keys()
    for key, some in pieces.items():
        covered = Counter(i for a, n in some for i in range(a, a + n))
        assert covered == Counter({i: len(ids_of[key]) for i in range(key[1])})
    # Sequences are gapless, of bounded length, and hardly padded.
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for some in sequences.values():
        at = 0
        for offset, n in sorted(some):
            assert offset == at
            at += n
        assert at <= size
        assert packing.cost(at, size) - at <= slack


@pytest.mark.parametrize(("size", "slack"), [(2048, 4), (64, 0), (256, 16)])
def test_packing_places_every_id_once(spark, size, slack):
    docs = pack_docs(spark)
    out = packing.pack(docs.repartition(3), size=size, slack=slack, part=20)
    check_packing(out.collect(), docs.collect(), size, slack)
    again = packing.pack(docs.repartition(5), size=size, slack=slack, part=20)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, out.collect()))


def test_packing_of_nothing_and_of_wrong_sizes(spark):
    assert packing.pack(pack_docs(spark).limit(0)).count() == 0
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(pack_docs(spark), size=100)


def test_the_program_reaches_its_bound():
    random.seed(9)
    demand = np.bincount([random.randint(1, 255) for _ in range(20000)], minlength=256)
    demand[0] = 0
    program = packing.linear_program(demand, 256)
    given = np.zeros(256)
    for pattern, n in program:
        for k, many in pattern.items():
            given[k] += many * n
    assert np.allclose(given, demand, rtol=1e-5)
    assert sum(packing.cost(packing.sums(p), 256) * n for p, n in program) <= 1.01 * (demand * np.arange(256)).sum()
    # 3 items of 100 in 256: no pattern does better than two a sequence.
    alone = np.bincount([100] * 30, minlength=256)
    assert math.isclose(sum(packing.cost(packing.sums(p), 256) * n for p, n in packing.linear_program(alone, 256)), 15 * 256, rel_tol=1e-6)


def terms_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def brute_search(docs, items, k):
    counts = [(r.doc_id, Counter(terms_of(r.text))) for r in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for r in items:
        asked[r.item_id] |= set(terms_of(r.text))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def search_tables(spark):
    random.seed(11)
    words = [f"w{i}" for i in range(60)] + ["É", "中", "9"]
    weights = [1 / (i + 1) for i in range(63)]
    rows = [(i, random.choice([" ", "-", "\n"]).join(random.choices(words, weights, k=random.randint(0, 50))).upper(), "c") for i in range(3000)]
    rows += [(None, "w1 w2 w40", "c"), (5000, None, "c"), (5001, "", "c"), (5002, "...", "c"), (7, "w40 w41", "c"), (7, "w40 w41", "c"), (5003, "w1 " * 20000, "c")]
    items = [(i, " ".join(random.choices(words, k=random.randint(1, 12))), "c") for i in range(60)] + [(3, "w62 W1", "c"), (None, "w5", "c"), (900, None, "c"), (901, "nowhere", "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, score string"), spark.createDataFrame(items, "item_id long, text string, rank string")


@pytest.mark.parametrize(("walk_terms", "told"), [(1 << 18, True), (40, False)])
def test_search_equals_brute_force(spark, tmp_path, monkeypatch, walk_terms, told):
    docs, items = search_tables(spark)
    terms = lexical_search.item_terms(items, "item_id", "text")
    if not told:
        monkeypatch.setattr(lexical_search, "VOCABULARY", 3)
    lexical_search.write_index(docs.repartition(3), str(tmp_path / "index"), vocabulary=terms.select("term").distinct())
    got = lexical_search.search(spark.read.parquet(str(tmp_path / "index")), terms, walk_terms=walk_terms)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(docs.collect(), items.collect(), 10)


def test_search_over_nothing(spark, tmp_path):
    docs, items = search_tables(spark)
    terms = lexical_search.item_terms(items, "item_id", "text")
    lexical_search.write_index(docs.limit(0), str(tmp_path / "a"))
    assert lexical_search.search(spark.read.parquet(str(tmp_path / "a")), terms).count() == 0
    lexical_search.write_index(docs, str(tmp_path / "b"))
    assert lexical_search.search(spark.read.parquet(str(tmp_path / "b")), terms.limit(0)).count() == 0


@pytest.mark.parametrize("short", [1, 4, 16, 10**9])
def test_skipping_loses_no_document(short):
    random.seed(short)
    for _ in range(60):
        n = random.randint(1, 400)
        lists = []
        for _ in range(random.randint(1, 7)):
            places = np.array(sorted(random.sample(range(n), random.randint(1, n))))
            lists.append((places, np.array([random.randint(1, random.choice([3, 50, 1000])) for _ in places])))
        total = Counter()
        for places, gives in lists:
            for p, g in zip(places.tolist(), gives.tolist(), strict=True):
                total[p] += g
        best = lexical_search.Best(5)
        lexical_search.answer(lists, pa.array(range(n)), best, short, window=32)
        assert best.rows == [(s, p) for p, s in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:5]]


def test_ranks_follow_one_order_across_blocks(spark, tmp_path, monkeypatch):
    """Documents with equal scores in many blocks: the least ids count."""
    docs = spark.createDataFrame([(i, "same words" if i % 3 else "other") for i in range(4000)], "doc_id long, text string").withColumn("r", F.rand(1)).orderBy("r").repartition(7)
    items = spark.createDataFrame([(1, "same")], "item_id long, text string")
    whole = lexical_search.slices
    monkeypatch.setattr(lexical_search, "slices", lambda texts: whole(texts, 500))
    lexical_search.write_index(docs, str(tmp_path / "index"))
    got = lexical_search.search(spark.read.parquet(str(tmp_path / "index")), lexical_search.item_terms(items, "item_id", "text"))
    assert [r.doc for r in got.orderBy("rank").collect()] == [i for i in range(20) if i % 3][:10]
