"""License scans by diagonal voting.

All rolling word k-grams of all texts are joined by hash (and then by their
words) with the k-gram positions of license templates. A match votes for the
diagonal ``word position - template position``; votes are added up by diagonal,
neighbouring diagonals are merged (a few words may be put in or left out), and a
span is verified if it covers enough of its template and enough of itself. Of
spans that overlap, those of the best templates stay.
Beside that, the places of fixed phrases are counted.

Only DataFrame functions are used; the templates are a table of fixed size and
are broadcast.

Defined results: a null or empty text has no words, no labels (empty strings),
null first and last words and score 0; rows alike in id and text share one
result, each row gets it; a null id is a value like others; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
K = 4

# Phrases that must be found, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Opening words of public license notices, lower-cased, without punctuation.
TEMPLATES = [
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

# Whole public notices, in the same form.
NOTICES = [
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public license along with this program if not see https www gnu org licenses",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu lesser general public license for more details you should have received a copy of the gnu lesser general public license along with this library",
    ),
    (
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public license for more details you should have received a copy of the gnu affero general public license along with this program if not see https www gnu org licenses",
    ),
    (
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    ),
]
TEMPLATES = TEMPLATES + NOTICES
GAP = 2  # diagonals this far apart are merged
COVER = 0.5  # least share of the template's k-grams, and of the span's, that match
RIVAL = 0.95  # of spans that overlap, those stay whose coverage is at least this part of the best one's


def words_of(text: Column) -> Column:
    """Words of ``text`` after A-Z are lower-cased.

    lower() makes ASCII letters of two other characters, the Kelvin sign and the
    dotted capital I. Characters beyond ASCII stand in for them, as no phrase or
    template has any.
    """
    plain = F.coalesce(text.cast("string"), F.lit(""))
    for letter in ("\u212a", "\u0130"):
        plain = F.replace(plain, F.lit(letter), F.lit("\u00df"))
    return F.regexp_extract_all(F.lower(plain), F.lit(WORD), F.lit(0))


def _grams(df: DataFrame) -> DataFrame:
    """Explodes ``words`` to its k-grams, ``pos``, ``g0`` .. and the hash ``h``, after a row that stands for the text itself (``pos`` is -1, the rest null).

    The outer form keeps Spark from splitting texts twice.
    """
    rows = df.select("*", F.posexplode_outer(F.concat(F.array(F.lit(None).cast("string")), "words")).alias("pos", "g0")).withColumn("pos", F.col("pos") - 1)
    rows = rows.where((F.col("pos") == -1) | (F.col("pos") <= F.size("words") - K))
    parts = ["g0"] + [f"g{i}" for i in range(1, K)]
    rows = rows.withColumns({f"g{i}": F.get("words", F.col("pos") + i) for i in range(1, K)})
    return rows.withColumn("h", F.when(F.col("g0").isNotNull(), F.xxhash64(*parts))).drop("words")


def template_grams(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(i).alias("tid"), F.lit(label).alias("label"), F.split(F.lit(text), " ").alias("words")) for i, (label, text) in enumerate(TEMPLATES)])
    listed = spark.range(1, numPartitions=1).select(F.inline(rows)).withColumn("grams", F.size("words") - K + 1)
    return _grams(listed).where("pos >= 0").withColumnRenamed("pos", "tpos").withColumnsRenamed({f"g{i}": f"t{i}" for i in range(K)} | {"h": "th"})


def gram_hits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each text with ``n_words`` and the phrase columns ``b`` (``pos`` is -1), and a row for each place where a template's k-gram stands.

    One pass over the texts, written to the shared folder.
    """
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), words_of(F.col(text_col)).alias("words"))
    phrases = F.named_struct(*[x for n, c in phrase_columns(F.col("words")).items() for x in (F.lit(n), c)])
    rows = _grams(rows.select("id", "text_hash", F.size("words").cast("long").alias("n_words"), phrases.alias("b"), "words"))
    same = [F.col("h") == F.col("th")] + [F.col(f"g{i}") == F.col(f"t{i}") for i in range(K)]
    rows = rows.join(F.broadcast(template_grams(df.sparkSession)), same, "left").where(F.col("tid").isNotNull() | (F.col("pos") == -1))
    return cut(rows.select("id", "text_hash", "n_words", F.when(F.col("pos") == -1, F.col("b")).alias("b"), "pos", "tid", "label", "grams", (F.col("pos") - F.col("tpos")).alias("diagonal")), "license-hits")


def license_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified spans: ``(id, text_hash, tid, label, start, stop, votes, coverage)``, word positions from 0."""
    return verified_spans(gram_hits(df, id_col, text_col))


def verified_spans(hits: DataFrame) -> DataFrame:
    """The spans that ``gram_hits`` vote for."""
    hits = hits.where("pos >= 0")
    votes = hits.groupBy("id", "text_hash", "tid", "label", "grams", "diagonal").agg(F.countDistinct("pos").alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high"))
    by = Window.partitionBy("id", "text_hash", "tid").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > GAP).cast("int"), F.lit(1))
    merged = votes.withColumn("apart", apart).withColumn("band", F.sum("apart").over(by))
    spans = merged.groupBy("id", "text_hash", "tid", "label", "grams", "band").agg(F.sum("votes").alias("votes"), F.min("low").alias("start"), (F.max("high") + K).alias("stop"))
    spans = spans.where((F.col("votes") >= COVER * F.col("grams")) & (F.col("votes") >= COVER * (F.col("stop") - F.col("start") - K + 1)))
    spans = spans.select("id", "text_hash", "tid", "label", "start", "stop", "votes", F.least(F.lit(1.0), F.col("votes") / F.col("grams")).alias("coverage"))
    # Licenses of one family share most of their words: a span goes if one that it overlaps is clearly better.
    # Spans that chain together are listed once, and each looks only at those that share words with it.
    order = Window.partitionBy("id", "text_hash").orderBy("start", "stop", "tid")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("begins", F.coalesce((F.col("start") >= before).cast("int"), F.lit(1))).withColumn("place", F.sum("begins").over(order))
    listed = spans.groupBy("id", "text_hash", "place").agg(F.collect_list(F.struct("tid", "label", "start", "stop", "votes", "coverage")).alias("chain"))
    beaten = lambda a: F.exists("chain", lambda b: (b["start"] < a["stop"]) & (b["stop"] > a["start"]) & (a["coverage"] < RIVAL * b["coverage"]))
    return listed.select("id", "text_hash", F.inline(F.filter("chain", lambda a: ~beaten(a))))


def phrase_columns(words: Column) -> dict[str, Column]:
    """``n_base``, ``first_word``, ``last_word``, ``base`` (an array of labels) from the joined words."""
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    spaces = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))
    first, last, found = [], [], []
    for phrase, label in PHRASES.items():
        text = f" {phrase} "
        at = F.instr(joined, text)
        back = F.instr(F.reverse(joined), text[::-1])
        first.append(F.when(at > 0, spaces(F.substring(joined, F.lit(1), at)) - 1))
        last.append(F.when(at > 0, spaces(F.substring(joined, F.lit(1), F.length(joined) - back + 2 - len(text))) - 1))
        found.append(F.when(at > 0, F.lit(label)))
    count = F.regexp_count(joined, F.lit("(?= (?:" + "|".join(PHRASES) + ") )"))
    some = F.contains(joined, F.lit(" license ")) | F.contains(joined, F.lit(" cc by "))
    return {
        "n_base": F.when(some, count).otherwise(0).cast("long"),
        "first_word": F.when(some, F.least(*first)).cast("long"),
        "last_word": F.when(some, F.greatest(*last)).cast("long"),
        "base": F.when(some, F.array_compact(F.array(*found))).otherwise(F.array().cast("array<string>")),
    }


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, text_hash, n_words, n_base, first_word, last_word, base_labels, labels, score)`` of every row."""
    hits = gram_hits(df, id_col, text_col)
    spans = verified_spans(hits).groupBy("id", "text_hash").agg(F.collect_set("label").alias("more"), F.max("coverage").alias("coverage"))
    key = F.struct(F.col("id").isNull().alias("none"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "text_hash")
    spans = spans.select(key.alias("key"), "more", "coverage")
    joined = hits.where("pos = -1").select("id", "text_hash", key.alias("key"), "n_words", "b.*").join(spans, "key", "left")
    labels = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    base = F.array_sort(F.array_distinct("base"))
    score = F.greatest(F.coalesce("coverage", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0))
    return joined.select(F.col("id").alias(id_col), "text_hash", "n_words", "n_base", "first_word", "last_word", F.array_join(base, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, labels and score of every document."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("text_hash")


def _sql() -> str:
    listed = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    phrases = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in PHRASES.items())
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(len(words))) AS pos FROM d),
g AS (SELECT doc_id, pos, array_to_string(words[pos + 1:pos + {K}], ' ') AS gram, len(words) AS n, words FROM p),
t AS (SELECT tid, label, string_split(t, ' ') AS words FROM (VALUES {listed}) v(tid, label, t)),
tp AS (SELECT tid, label, words, len(words) - {K} + 1 AS grams, unnest(range(len(words) - {K} + 1)) AS tpos FROM t),
tg AS (SELECT tid, label, grams, tpos, array_to_string(words[tpos + 1:tpos + {K}], ' ') AS gram FROM tp),
h AS (SELECT g.doc_id, tg.tid, tg.label, tg.grams, g.pos, g.pos - tg.tpos AS diagonal FROM g JOIN tg ON g.gram = tg.gram WHERE g.pos <= g.n - {K}),
v AS (SELECT doc_id, tid, label, grams, diagonal, count(DISTINCT pos) AS votes, min(pos) AS low, max(pos) AS high FROM h GROUP BY ALL),
a AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w <= {GAP} THEN 0 ELSE 1 END AS apart FROM v WINDOW w AS (PARTITION BY doc_id, tid ORDER BY diagonal)),
b AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, tid ORDER BY diagonal) AS band FROM a),
s AS (SELECT doc_id, tid, label, grams, band, sum(votes) AS votes, min(low) AS start, max(high) + {K} AS stop FROM b GROUP BY ALL),
o1 AS (SELECT doc_id, tid, label, start, stop, least(1.0::DOUBLE, votes::DOUBLE / grams) AS coverage FROM s WHERE votes >= {COVER} * grams AND votes >= {COVER} * (stop - start - {K} + 1)),
o AS (SELECT doc_id, label, coverage FROM o1 a WHERE NOT EXISTS (FROM o1 b WHERE b.doc_id = a.doc_id AND b.start < a.stop AND b.stop > a.start AND a.coverage < {RIVAL} * b.coverage)),
m AS (SELECT g.doc_id, g.pos, f.label FROM g JOIN (VALUES {phrases}) f(phrase, label, n) ON array_to_string(g.words[g.pos + 1:g.pos + f.n], ' ') = f.phrase),
mb AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM m GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM m UNION SELECT doc_id, label FROM o) GROUP BY doc_id),
mo AS (SELECT doc_id, max(coverage) AS coverage FROM o GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       greatest(coalesce(coverage, 0::DOUBLE), CASE WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0::DOUBLE END) AS score
FROM d LEFT JOIN mb USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN mo USING (doc_id)
"""


OP9_SQL = _sql()
