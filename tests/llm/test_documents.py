"""Quality, mixing, line dedup, license scans, and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quotelake.llm import license_scan, line_dedup, quality, source_mix

random.seed(5)
WORDS = ["".join(random.choice("etaoinshrdlu") for _ in range(random.randint(2, 7))) for _ in range(900)]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n):
    return " ".join(random.choice(WORDS) for _ in range(n))


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def test_classifier_on_held_out_rows_and_odd_texts(spark):
    rows = [(i, prose(60) if i % 3 else prose(30).upper().replace(" ", "!! "), "s") for i in range(600)]
    table = docs(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(600)] + [(9999, 7), (None, 1)], "doc_id long, quality int")
    space = quality.train(table, labels)
    got = quality.score_texts(table.withColumn("score", F.lit("clash")), space).withColumn("held", quality.held_out(F.col("doc_id"))).where("held").collect()
    assert sum((r.score >= quality.THRESHOLD) == (r.doc_id % 3 > 0) for r in got) >= 0.98 * len(got)
    odd = quality.score_texts(docs(spark, [(1, None, "s"), (2, "", "s"), (2, "", "s"), (None, "x", None), (4, prose(30_000), "s")]), space).collect()
    assert len(odd) == 5 and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in odd if not r.text} == {space.share}
    assert quality.score_texts(table.where("false"), space).count() == 0
    assert quality.train(table, labels.where("false")) is None
    assert {r.score for r in quality.score_texts(table.limit(3), None).collect()} == {0.5}


def test_scores_equal_a_plain_neighbour_vote(spark):
    rows = [(i, prose(50) if i % 2 else prose(20).upper(), "s") for i in range(300)] + [(1000 + i, f"{prose(15)} {prose(15).upper()}", "s") for i in range(40)]
    table = docs(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    space = quality.train(table, labels)
    place = lambda text: (quality.terms(text).astype(np.float64) * space.weight) @ space.basis.astype(np.float64)
    unit = lambda v: v / np.sqrt((v * v).sum())
    held = {r.doc_id for r in table.where(quality.held_out(F.col("doc_id"))).collect()}
    texts = {i: t for i, t, _ in rows}
    known = [(unit(place(texts[i])), i % 2) for i in range(300) if i not in held]
    assert len(known) == len(space.labels)
    for r in quality.score_texts(table, space).collect():
        near = sorted(((float(unit(place(r.text)) @ v), y) for v, y in known), key=lambda x: -x[0])[: quality.NEIGHBOURS]
        weights = [max(0.0, c) ** 4 for c, _ in near]
        assert r.score == pytest.approx(sum(w * y for w, (_, y) in zip(weights, near, strict=True)) / sum(weights), abs=5e-3)


def test_mix_meets_its_targets(spark):
    rows = [(i, prose(5 + i % 40), f"s{i % 4}" if i % 11 else None) for i in range(3000)] + [(5, "same", "s1"), (5, "same", "s1"), (7, None, "s9"), (8, "  ", "s9"), (9, prose(30_000), "s2")]
    got = source_mix.mix_sources(docs(spark, rows).withColumn("size", F.lit("clash")).withColumn("key", F.lit(1))).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
        size, target, taken = by.get(r.source, (0, r.target, 0))
        by[r.source] = (size + r["size"], r.target, taken + r.taken)
    assert abs(sum(t for _, t, _ in by.values()) - 1.5 * sum(s for s, _, _ in by.values())) < 1e-6
    for size, target, taken in by.values():
        assert target <= 2 * size + 1e-9 and abs(taken - target) <= (45 if size < 30_000 else 30_000)
    again = source_mix.mix_sources(docs(spark, rows[::-1])).collect()
    assert sorted((r.doc_id or -1, r.text_hash, r.taken) for r in got) == sorted((r.doc_id or -1, r.text_hash, r.taken) for r in again)
    assert source_mix.mix_sources(docs(spark, rows).where("false")).count() == 0
    named = docs(spark, rows).withColumn("row", F.lit("mine")).withColumn("Times", F.lit(2)).withColumn("place", F.lit(3)).withColumn("__row", F.lit(4))
    mixed = source_mix.apply_mix(named)
    assert mixed.columns == named.columns and {tuple(r)[5:] for r in mixed.collect()} == {("mine", 2, 3, 4)}
    assert mixed.count() == sum(r.taken // r["size"] for r in got if r["size"])


def test_targets_are_reshared_above_the_cap(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 400), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in source_mix.targets(sizes).collect()}
    assert got["a"] == 20 and got[None] == 0 and abs(sum(got.values()) - 1.5 * 1410) < 1e-9
    assert abs(got["c"] - 2095 / 3) < 1e-9 and abs(got["b"] - 4190 / 3) < 1e-9


def test_lines_on_many_sites_go(spark):
    rows = [(i, f"common line\nown {i}\n\nhalf" if i % 2 else f"common line\nown {i}", f"s{i % 20}") for i in range(40)]
    rows += [(100, None, "s1"), (101, "", None), (102, "common line", "s1"), (102, "common line", "s1"), (103, "\n\n", "s2"), (104, "one site\n" * 500, "s3")]
    table = docs(spark, rows).withColumn("gone", F.lit("clash")).withColumn("line", F.lit(1)).withColumn("n_lines", F.lit("old")).withColumn("row", F.lit(2)).withColumn("__own_row", F.lit(3))
    got = {}
    for r in line_dedup.drop_boilerplate(table).collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_removed))
    assert got[0] == [("own 0", 2, 1)] and got[1] == [("own 1\n", 4, 2)]
    assert got[100] == [(None, 0, 0)] and got[101] == [("", 1, 0)] and got[102] == [("", 1, 1)] * 2 and got[103] == [("\n\n", 3, 0)]
    assert got[104] == [("one site\n" * 500, 501, 0)]
    assert line_dedup.drop_boilerplate(table.where("false")).count() == 0


def test_licenses_are_found_by_phrases_and_diagonals(spark):
    notice = dict(license_scan.TEMPLATES)["apache"]
    edited = "Intro words. " + notice.replace("may not use", "may never ever use").title() + " tail"
    rows = [(1, "Under the MIT License; mit license, CC-BY and CC BY.", "s"), (2, edited, "s"), (3, None, "s"), (4, "", "s"), (2, edited, "s"), (None, "gnu general public license", None), (6, "the license to use this file", "s"), (7, "cc " * 30_000 + "by", "s")]
    table = docs(spark, rows).withColumn("labels", F.lit(1)).withColumn("pos", F.lit("clash"))
    got = {}
    for r in license_scan.scan_licenses(table).collect():
        got.setdefault(r.doc_id, []).append(r)
    first = got[1][0]
    assert (first.n_base, first.first_word, first.last_word, first.base_labels) == (4, 2, 9, "cc-by,mit")
    assert len(got[2]) == 2 and {r.labels for r in got[2]} == {"apache"} and got[2][0].score > 0.5
    assert (got[3][0].n_words, got[3][0].labels, got[3][0].score, got[3][0].first_word) == (0, "", 0.0, None)
    assert got[None][0].base_labels == "gpl" and got[6][0].labels == "" and got[7][0].last_word == 29_999
    assert license_scan.scan_licenses(table.where("false")).count() == 0


def test_whole_notices_are_told_apart(spark):
    whole = dict(license_scan.NOTICES)
    rows = [(i, "Before it. " + whole[k].title() + " After it.", "s") for i, k in enumerate(whole)]
    rows += [(100, f"{whole['mit']} and {whole['bsd']}", "s"), (101, " ".join(whole["lgpl"].split()[:70]), "s"), (102, "this wor\u212a is licensed under a creative commons attribution 4 0", "s")]
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(docs(spark, rows)).collect()}
    for i, k in enumerate(whole):
        assert k in got[i].split(",") and len(got[i].split(",")) <= 2, (k, got[i])
    assert got[list(whole).index("lgpl")] == "lgpl" and got[list(whole).index("agpl")] == "agpl"
    assert got[100] == "bsd,mit" and got[101] == "lgpl" and got[102] == "cc-by"


def test_spans_yield_only_to_better_ones_that_they_overlap(spark):
    spans = {0: (0, 12, 17), 1: (8, 20, 17), 2: (16, 32, 17)}  # template: first and last k-gram that matched, k-grams it has
    rows = [(d, 1, pos, tid, f"l{tid}", grams, 0) for d in (1, None) for tid, (low, high, grams) in spans.items() for pos in range(low, high + 1)]
    rows += [(2, 1, pos, tid, f"l{tid}", grams, 0) for tid, (low, high, grams) in spans.items() if tid < 2 for pos in range(low, high + 1)]
    hits = spark.createDataFrame(rows, "id long, text_hash long, pos int, tid int, label string, grams int, diagonal int")
    got = sorted((r.id or 0, r.tid, r.start, r.stop) for r in license_scan.verified_spans(hits).collect())
    # The second overlaps the whole third one; the first shares no word with the third.
    both = [(0, 0, 16), (2, 16, 36)]
    assert got == [(0, *s) for s in both] + [(1, *s) for s in both] + [(2, 0, 0, 16), (2, 1, 8, 24)]


def test_pipeline_takes_empty_tables_and_other_columns(spark, tmp_path):
    rows = [(i if i % 7 else None, prose(60), f"s{i % 5}") for i in range(60)] + [(5, None, None), (6, "", "s1"), (6, "", "s1")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    table = docs(spark, rows).withColumn("node", F.lit("mine")).withColumn("row", F.lit(1)).withColumn("n_tokens", F.lit("old"))
    for name, docs_in in (("some", table), ("none", table.where("false"))):
        kept = docs_in
        for stage, f in corpus_pipeline.STAGES:
            out = f(spark, kept, str(tmp_path))
            if stage != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == table.columns
                out.write.parquet(f"{tmp_path}/{name}-{stage}")
                kept = spark.read.parquet(f"{tmp_path}/{name}-{stage}")
        assert (out.count() > 0) == (name == "some")


def test_pipeline_decisions_take_effect(spark, tmp_path):
    base = prose(120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[60:])
    good = [(i, f"banner on all sites\n{prose(60)}", f"s{i % 15}") for i in range(150)]
    junk = [(1000 + i, prose(40).upper().replace(" ", "!! "), "s1") for i in range(60)]
    rows = good + junk + [(2000, base, "s1"), (2001, near, "s2"), (2002, base, "s3"), (2003, None, "s4")]
    table = docs(spark, rows)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1) for i in range(150)] + [(1000 + i, 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality"](spark, table, str(tmp_path))
    assert kept.columns == table.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {r[0] for r in good} <= ids and not {r[0] for r in junk} & ids
    clean = stages["line_dedup"](spark, kept, str(tmp_path))
    assert clean.where(F.contains("text", F.lit("banner"))).count() == 0 and clean.count() == len(ids)
    one = [r.doc_id for r in stages["ngram_join"](spark, clean, str(tmp_path)).collect()]
    assert {2000, 2001, 2002} & set(one) == {2000} and len(one) == len(set(one)) and {r[0] for r in good} <= set(one)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.run(spark, str(tmp_path)).where("n_tokens > 0").count() > 0
