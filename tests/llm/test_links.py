"""Near-duplicate text, vectors, images and components against brute force."""

import random
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from quotelake.llm import image_copies, ngram_join, vector_links
from quotelake.llm.components import components
from quotelake.llm.shingles import shingles


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def test_components_equal_union_find(spark):
    random.seed(1)
    edges = [(random.randint(0, 300), random.randint(0, 300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (7, 8), (7, 8)]
    want = Sets()
    for a, b in edges:
        if a != b:
            want.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: want.find(x) for x in want.up}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_shingles_are_those_of_the_words():
    assert len(shingles("a b c d e", 4)) == 2 and len(shingles("A  b\tC d", 4)) == 1 and len(shingles("a b", 4)) == 1
    assert len(shingles(None, 4)) == len(shingles(" \n", 4)) == 0
    assert (shingles("Ab c d e f", 4) == shingles("aB c\nd  e f ", 4)).all()
    assert len(shingles("x y " * 50_000, 4)) == 2


def brute_classes(rows, k, percent):
    sets = {}
    for i, (_, text) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        sets[i] = {tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))} if words else set()
    links = Sets()
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.join(a, b)
    groups = defaultdict(list)
    for i in sets:
        groups[links.find(i)].append(i)
    least = {i: min((rows[j][0] for j in g if rows[j][0] is not None), default=None) for g in groups.values() for i in g}
    return sorted((str(rows[i][0]), len(sets[i]), str(least[i] if sets[i] else rows[i][0])) for i in sets)


def test_ngram_join_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 900)  # several blocks a group
    random.seed(2)
    words = [f"w{i}" for i in range(4000)]
    shared = random.sample(words, 50)
    base = random.sample(words, 80)
    rows = [(i, " ".join(random.sample(words, 60) + shared)) for i in range(60)]
    for i in range(60, 160):  # a large group of near copies, some linked only through others
        copy = list(base)
        for _ in range(random.randint(0, 3)):
            copy[random.randrange(80)] = random.choice(words)
        rows.append((i, " ".join(copy)))
    rows += [(200, "one two"), (201, "One  two"), (202, ""), (203, None), (204, "one"), (205, rows[3][1]), (206, rows[3][1].upper()), (60, rows[60][1]), (None, rows[5][1]), (207, " ".join(words))]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("u", F.lit(1)).repartition(5)
    got = ngram_join.ngram_classes(table, k=4, percent=85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_classes(rows, 4, 85)
    assert ngram_join.ngram_classes(table.where("false")).count() == 0
    kept = ngram_join.keep_one(table.withColumn("chosen_node", F.lit(1)).withColumn("__node", F.lit(2)), k=4, percent=85)
    assert kept.columns == [*table.columns, "chosen_node", "__node"]
    kept = kept.collect()
    classes = {c for _, n, c in brute_classes(rows, 4, 85) if n}
    assert len([r for r in kept if r.text]) == len(classes)


def test_any_two_blocks_meet_in_one_cell_of_bounded_size(spark):
    blocks = [(g, b, n) for g, n in ((1, 2), (2, 8), (3, 37)) for b in range(n)]
    rows = ngram_join.meetings(spark.createDataFrame(blocks, "grp long, block int, blocks int")).collect()
    cells, copies = defaultdict(list), defaultdict(int)
    for r in rows:
        cells[r.grp, r.low, r.high].append((r.run, r.block))
        copies[r.grp, r.block] += 1
    met = [(g, *sorted((a, b))) for (g, low, high), of in cells.items() for i, (x, a) in enumerate(of) for y, b in of[i + 1 :] if low == high or x != y]
    assert sorted(met) == sorted((g, a, b) for g, n in ((1, 2), (2, 8), (3, 37)) for b in range(n) for a in range(b))
    assert max(map(len, cells.values())) <= 2 * ngram_join.REACH and max(copies.values()) == 5


def test_blocks_of_small_sets_are_bounded_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CROWD", 50)
    seen = {}
    monkeypatch.setattr(ngram_join, "cut", lambda df, name: seen.setdefault(name, df.cache()))
    rows = [(i, f"same four words here own{i % 300}") for i in range(600)]  # two shingles each, one of them in all texts
    table = spark.createDataFrame(rows, "doc_id long, text string")
    texts = table.select(F.xxhash64("text").alias("node"), F.xxhash64("doc_id").alias("row"), "text")
    groups = texts.select("node", F.lit(1).cast("long").alias("grp")).distinct()
    edges = ngram_join.verified_edges(texts, groups, 4, 85)
    assert edges.count() == 0
    sizes = [r["count"] for r in seen["candidates"].groupBy("block").count().collect()]
    assert sum(sizes) == 300 and max(sizes) < 100


def test_buckets_follow_the_length_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET", 1 << 10)
    some = spark.range(12).select(F.repeat(F.lit("word "), 100_000).alias("text"))  # about a million n-grams
    assert [ngram_join.bucket_bits(some.coalesce(n)) for n in (1, 4)] == [10, 10]
    assert ngram_join.bucket_bits(some.crossJoin(spark.range(4)).coalesce(1)) == 12
    assert ngram_join.bucket_bits(some.where("false")) == 8


def test_frequent_ngrams_beyond_the_list_make_no_pairs(spark, monkeypatch):
    random.seed(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):
        copy = list(base)
        copy[random.randrange(80)] = f"own{i}"
        rows.append((i, " ".join(copy)))
    rows += [(200 + i, " ".join(random.sample(base, 60))) for i in range(20)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    texts = table.select(F.xxhash64("text").alias("node"), "text")
    edges = ngram_join.candidate_edges(texts, 4, 85, 4, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert edges.count() < 120 * 119 // 8
    monkeypatch.setattr(ngram_join, "HEAVY", 1)
    got = ngram_join.ngram_classes(table, k=4, percent=85).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == brute_classes(rows, 4, 85)


def test_vector_links_recall_and_precision(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 32))
    x = np.concatenate([x, x[:300] + rng.normal(size=(300, 32)) * 0.2, x[:40] + rng.normal(size=(40, 32)) * 0.1])
    rows = [(i, v.tolist(), i % 300 % 3) for i, v in enumerate(x)]
    odd = [(9000, None, 1), (9001, [0.0] * 32, 1), (9002, [float("nan")] * 32, 1), (9003, [None] * 32, 1), (9004, rows[0][1], None), (9005, [], 1), (9006, [1.0, 2.0], 1), (9007, [2.0, 4.0], 1), (None, rows[7][1], rows[7][2])]
    same = [(9100 + i, rows[3][1], rows[3][2]) for i in range(50)]
    every = rows + odd + same
    table = spark.createDataFrame(every, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("clash"))
    got = vector_links.vector_links(table, block=60).collect()
    assert len(got) == len(every)
    n = {r.vec_id: r.n_links for r in got}
    want, units = defaultdict(int), [(i, np.array(v) / np.linalg.norm(v), label) for i, v, label in rows + same + odd[-1:]]
    m = np.stack([u for _, u, _ in units])
    linked = (m @ m.T >= 0.93) & (np.array([k for *_, k in units])[:, None] == np.array([k for *_, k in units]))
    np.fill_diagonal(linked, False)
    for (i, _, _), c in zip(units, linked.sum(1), strict=True):
        want[i] = int(c)
    assert all(n[i] <= want[i] for i in want)
    assert sum(n[i] for i in want) >= 0.9 * sum(want.values())
    assert all(n[i] == 0 for i in range(9000, 9006)) and n[9006] == n[9007] == 1
    whole = Sets()
    ids = [i for i, _, _ in units]
    for a, b in np.argwhere(linked).tolist():
        if ids[a] is not None and ids[b] is not None:
            whole.join(ids[a], ids[b])
    by = {r.vec_id: r for r in got}
    assert sum(by[i].component_id == whole.find(i) for i in ids if i is not None) >= 0.98 * len(ids)
    assert by[9100].component_id == by[3].component_id == 3 and by[3].kept and not by[9100].kept
    assert by[9007].component_id == 9006 and by[None].component_id == 7 and not by[None].kept
    assert vector_links.vector_links(table.where("false")).count() == 0


def test_vector_links_over_many_lists(spark):
    rng = np.random.default_rng(6)
    loose = np.ones(16) + rng.normal(size=(700, 16)) * 0.274  # a large group about the threshold
    tight = rng.normal(size=(60, 16)).repeat(10, axis=0) + rng.normal(size=(600, 16)) * 0.05  # groups of close copies
    x = np.concatenate([rng.normal(size=(300, 16)), loose, tight])
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(3)
    m = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = m @ m.T >= 0.93
    np.fill_diagonal(linked, False)
    want = Sets()
    for a, b in np.argwhere(linked).tolist():
        want.join(a, b)
    got = {r.vec_id: r for r in vector_links.vector_links(table, block=5).collect()}  # 512 lists, of which 4 rims are probed
    assert all(got[i].n_links <= linked[i].sum() for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.9 * linked.sum()
    assert all(got[i].n_links == linked[i].sum() for i in range(1000, 1600))
    assert all(want.find(i) == want.find(r.component_id) and r.kept == (i == r.component_id) for i, r in got.items())
    assert sum(r.component_id == want.find(i) for i, r in got.items()) >= 0.98 * len(got)


def page(i):
    return " ".join(f"{i}w{j * 7919 % 1000}" for j in range(400))


def test_edited_images_are_found_and_others_are_not(spark):
    grey = [image_copies.render(page(i)) for i in range(60)]
    rows = [(i, image_copies.write_image(g)) for i, g in enumerate(grey)]
    rows += [(100 + i, image_copies.write_image(image_copies.edited(grey[i], image_copies.EDITS[i % 4]))) for i in range(24)]
    blank = image_copies.write_image(np.full((50, 50), 7.0))
    large = image_copies.write_image(np.kron(grey[0], np.ones((12, 12))))
    rows += [(500, None), (501, b""), (502, b"P5 junk"), (503, blank), (504, blank), (505, rows[0][1]), (506, b"P6 2 2 255\n" + bytes(12)), (507, large), (508, large), (None, rows[1][1])]
    table = spark.createDataFrame(rows, "image_id long, image binary").withColumn("node", F.lit("clash")).withColumn("keys", F.lit(1))
    got = image_copies.image_copies(table).collect()
    assert len(got) == len(rows)
    by = {r.image_id: r for r in got}
    assert sum(by[100 + i].component_id == i for i in range(24)) >= 22
    assert all(by[i].component_id == i and by[i].kept for i in range(60))
    assert by[505].component_id == 0 and by[504].component_id == 503 and by[500].component_id == 500 and by[None].component_id == 1
    assert by[508].component_id == by[507].component_id and not by[None].kept and not by[505].kept
    assert image_copies.image_copies(table.where("false")).count() == 0


def test_the_tables_find_most_of_what_all_pairs_give(spark, monkeypatch):
    monkeypatch.setattr(image_copies, "CROWD", 4)
    rng = np.random.default_rng(8)
    grey = []
    for i in range(24):
        g = image_copies.render(page(i))
        grey += [g, g + rng.normal(size=g.shape) * 6, g + rng.normal(size=g.shape) * 12, np.rot90(g), *[image_copies.edited(g, k, i) for k in ("smaller", "half", "crop", "centre")]]
    banner = image_copies.render(page("banner"))
    for i in range(30):  # a large group that shares a part
        g = image_copies.render(page(f"page {i}"))
        g[:60] = banner[:60]
        grey.append(g)
    table = spark.createDataFrame([(i, image_copies.write_image(g)) for i, g in enumerate(grey)], "image_id long, image binary").repartition(4)
    node = {r.image_id: r.node for r in table.select("image_id", F.xxhash64("image").alias("node")).collect()}
    rows = sorted(table.collect())
    found = {r.image_id: image_copies.unpacked(*image_copies.packed(*x)) for r, x in zip(rows, image_copies.describe([image_copies.read_image(bytes(r.image)) for r in rows]), strict=True)}
    want, links = Sets(), set()
    for a in found:
        for b in found:
            if node[a] < node[b] and image_copies.agreeing(*found[a], *found[b]) >= image_copies.AGREE:
                want.join(a, b)
                links.add((node[a], node[b]))
    assert len(links) > 400
    images = spark.createDataFrame([(node[i], *image_copies.packed(*x)) for i, x in found.items()], "node long, points binary, words binary").repartition(4)
    pairs = {tuple(sorted(r)) for r in image_copies.candidate_pairs(images).collect()}
    assert len(pairs) < image_copies.LEADERS * 3 * len(found)
    got = {r.image_id: r.component_id for r in image_copies.image_copies(table).collect()}
    joined = sum(got[i] == got[want.find(i)] for i in want.up)
    assert joined >= 0.9 * len(want.up)
    assert all(got[i] == i for i in found if i not in want.up)
    assert all(want.find(i) == want.find(c) for i, c in got.items())
    assert len({got[i] for i in range(192, 222)}) == 1


def test_no_pair_of_a_large_group_is_left_out(spark, monkeypatch):
    # One key in 60 images, of which only the last two are copies: neither is among the first that all others are compared with.
    rng = np.random.default_rng(4)
    n = 60
    words = rng.integers(0, 1 << 32, (n, 9, 4), dtype=np.uint32)
    points = np.stack([rng.uniform(0, 90, (n, 9)), rng.uniform(0, 90, (n, 9)), np.ones((n, 9)), rng.uniform(-3, 3, (n, 9))], axis=2).astype(np.float32)
    words[:, :2], points[:, :2, 3] = words[0, :2], 0.5  # two points that all have, at places of their own
    words[n - 1, 2:], points[n - 1] = words[n - 2, 2:] ^ np.uint32(1 << 30), points[n - 2]  # a bit that every table's key has
    images = spark.createDataFrame([(i, *image_copies.packed(points[i], words[i])) for i in range(n)], "node long, points binary, words binary").repartition(3)
    monkeypatch.setattr(image_copies, "CROWD", 8)
    assert (n - 2, n - 1) not in {tuple(r) for r in image_copies.candidate_pairs(images).collect()}
    assert [tuple(sorted(r)) for r in image_copies.linked_images(images).collect()] == [(n - 2, n - 1)]
    monkeypatch.setattr(image_copies, "CROWD", n)
    assert [tuple(sorted(r)) for r in image_copies.linked_images(images).collect()] == [(n - 2, n - 1)]


def test_descriptions_do_not_depend_on_the_batch():
    grey = [image_copies.render(page(i)) for i in range(5)] + [None, np.zeros((3, 300), np.float32), image_copies.render(page(7))[:70, :50]]
    together = image_copies.describe(grey)
    for x, (points, words) in zip(grey, together, strict=True):
        p, w = image_copies.describe([x])[0]
        assert np.allclose(p, points, atol=1e-3) and (np.bitwise_count(w ^ words).sum() <= 2)
    assert [len(p) for p, _ in together[5:7]] == [0, 0]


def test_pictures_in_colour_are_read():
    assert image_copies.read_image(b"P6 1 1 255\n\x01\x02\x03")[0, 0] == 2
    assert image_copies.read_image(b"P5 2 2 255\n\x01") is None
