"""License scan with DataFrame functions only: sparse TF-IDF cosine of every
passage to licence templates, then inheritance from the nearest directory.

1. Document frequencies of the templates' words are counted over all documents.
2. Texts are cut into passages: lines, overlapping windows of long lines, and the
   same windows over the whole text where they cross a line break, so that wrapped
   notices are compared whole. Windows of each template's own length around cue words
   score a short notice without its neighbours, however common its words are. A
   passage can reach the threshold only if it has one of the *cue* words: by
   Cauchy-Schwarz the others alone stay below it against every template. Such
   passages' term counts are joined with the templates' weights; the best cosine
   at or above the threshold names the passage's licence, the best passage its
   document's.
3. A licence file speaks for its directory. Directories find their nearest
   ancestor (or themselves) with a licence by a join on ancestor paths; files
   without a notice of their own inherit from their directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.text import documents, store

#: Public notices and titles by SPDX identifier.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    ],
}
THRESHOLD = 0.75
#: Words of a passage, and how far one starts after another, in lines longer than that.
PASSAGE, STEP = 40, 20
#: Windows of a template's length start this part of it after another (at least one word).
FITTED_STEPS = 5
#: A notice in the first lines of a file holds for its directory.
HEADER_LINES = 3
#: Weight of a word that no template has.
OTHER = 1.0
#: What lies between words: runs of ASCII letters and digits, dots and hyphens inside.
_BETWEEN = r"[.\-]*[^a-z0-9.\-][^a-z0-9]*|^[.\-]+|[.\-]+$"


def _words(text: str) -> list[str]:
    return [w for w in re.split(_BETWEEN, text.lower()) if w]


def _word_array(text: str | Column) -> Column:
    return F.split(F.lower(text), _BETWEEN)


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """(documents, {word: documents that have it}); the vocabulary is the templates'."""
    held = F.array(*[F.lit(w) for w in vocabulary])
    counted = (docs.select(F.explode(F.array_intersect(_word_array("text"), held)).alias("word"))
               .groupBy("word").count())
    return docs.count(), {r["word"]: r["count"] for r in counted.collect()}  # at most a row per template word


def template_weights(frequencies: tuple[int, dict[str, int]], templates: dict[str, list[str]], threshold: float):
    """(rows of (template, licence, word, weight / norm), {word: idf}, cue words)."""
    n, df = frequencies
    vocabulary = sorted({w for texts in templates.values() for t in texts for w in _words(t)})
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) + 1 for w in vocabulary}
    rows, needed = [], set()
    for licence, texts in templates.items():
        for k, text in enumerate(texts):
            weights = {w: c * idf[w] for w, c in Counter(_words(text)).items()}
            norm = math.sqrt(sum(v * v for v in weights.values()))
            rows += [(f"{licence}#{k}", licence, w, v / norm) for w, v in weights.items()]
            # heaviest words become cues until the rest alone cannot reach the threshold
            left = norm * norm
            for w in sorted(weights, key=lambda w: (-idf[w], w)):
                if math.sqrt(max(0.0, left)) / norm < threshold * 0.999:
                    break
                needed.add(w)
                left -= weights[w] ** 2
    return rows, idf, sorted(needed)


def _window_starts(words: Column) -> Column:
    return F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(words) - (PASSAGE - STEP) - 1), F.lit(STEP))


def _passage(kind: int, line: Column, start: Column, words: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), line.alias("line"), start.alias("start"), words.alias("words"))


def line_passages(lines: str) -> Column:
    """Each line, cut into overlapping windows if it is long."""
    return F.flatten(F.transform(lines, lambda words, i: F.transform(
        _window_starts(words), lambda s: _passage(0, i, s, F.slice(words, s + 1, F.lit(PASSAGE))))))


def crossing_passages(words: str, line_of: str) -> Column:
    """Windows over the whole text that cross a line break; each has the line it starts on."""
    starts = F.filter(_window_starts(F.col(words)), lambda s: F.get(line_of, s) < F.get(
        line_of, F.least(s + PASSAGE, F.size(line_of)) - 1))
    return F.transform(starts, lambda s: _passage(1, F.get(line_of, s), s, F.slice(words, s + 1, F.lit(PASSAGE))))


def fitted_passages(words: str, line_of: str, cue: Column, lengths: list[int]) -> Column:
    """Windows of the templates' lengths that hold a cue word, over the whole text."""
    at = F.filter(F.transform(words, lambda w, i: F.when(F.array_contains(cue, w), i)), lambda i: i.isNotNull())

    def of_length(length: int) -> Column:
        step = max(1, length // FITTED_STEPS)
        first = lambda i: F.ceil(F.greatest(F.lit(0), i - length + 1) / step).cast("int")
        starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(first(i), F.floor(i / step).cast("int")))))
        return F.transform(starts, lambda k: _passage(1 + length, F.get(line_of, k * step), k * step, F.slice(words, k * step + 1, F.lit(length))))

    return F.concat(*[of_length(length) for length in lengths])


def licence_notices(docs: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """(row, line, licence, cosine): the best passage of each row of ``docs``
    (columns ``row`` and ``text``) that reaches the threshold; ties go to the
    first line, then to the first licence by name."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for texts in templates.values() for t in texts for w in _words(t)})
    lengths = sorted({len(_words(t)) for texts in templates.values() for t in texts})
    rows, idf, cues = template_weights(document_frequencies(docs, vocabulary), templates, threshold)
    weights = spark.createDataFrame(rows, "template string, name string, word string, weight double")
    idfs = spark.createDataFrame(sorted(idf.items()), "word string, idf double")
    cue = F.array(*[F.lit(w) for w in cues])
    texts = (docs.where(F.arrays_overlap(_word_array("text"), cue)).withColumn("contents", F.split("text", "\n"))
             .select("row", F.transform("contents", lambda content: F.filter(_word_array(content), lambda w: w != "")).alias("lines")))
    texts = texts.select("row", "lines", F.flatten("lines").alias("words"),
                         F.flatten(F.transform("lines", lambda words, i: F.transform(words, lambda _: i))).alias("line_of"))
    passages = texts.select("row", F.inline(F.concat(
        line_passages("lines"), crossing_passages("words", "line_of"), fitted_passages("words", "line_of", cue, lengths))))
    place = ["row", "kind", "line", "start"]
    terms = (passages.where(F.arrays_overlap("words", cue)).select(*place, F.explode("words").alias("word"))
             .groupBy(*place, "word").agg(F.count("*").alias("tf"))
             .join(F.broadcast(idfs), "word", "left")  # the templates' words: a fixed table
             .withColumn("weight_in", F.col("tf") * F.coalesce("idf", F.lit(OTHER))))
    norms = terms.groupBy(*place).agg(F.sqrt(F.sum(F.col("weight_in") * F.col("weight_in"))).alias("norm"))
    dots = (terms.join(F.broadcast(weights), "word")
            .groupBy(*place, "template", "name").agg(F.sum(F.col("weight_in") * F.col("weight")).alias("dot")))
    scored = (dots.join(norms, place)
              .withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("cosine") >= threshold))
    best = scored.groupBy("row").agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "line", F.col("name").alias("licence"))).alias("b"))
    return best.select("row", "b.line", "b.licence", (-F.col("b.minus")).alias("cosine"))


def scan_licences(files: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Input columns: ``doc_id``, ``text``, ``directory`` (segments joined by ``/``).
    A file whose notice stands in its first HEADER_LINES lines is its directory's licence file.

    One row per file: doc_id, directory, own_licence, cosine, licence (own or
    inherited, null if none), licence_from (``own``, the directory, or null).
    A directory with several licence files has the commonest licence, ties by
    name. Null texts have no notice; files without a directory inherit nothing;
    repeated rows each vote; an empty table gives an empty result.
    """
    rows = files.select("doc_id", "directory", F.coalesce("text", F.lit("")).alias("text"))
    keyed = rows.withColumn("row", F.xxhash64("doc_id", "directory", "text"))
    notices = store(licence_notices(keyed.select("row", "text").where("text <> ''"), templates, threshold), "notices")
    light = store(keyed.select("row", "doc_id", "directory").join(notices, "row", "left"), "files")
    # licence files: the notice stands in the header
    votes = light.where(f"licence IS NOT NULL AND line < {HEADER_LINES} AND directory IS NOT NULL").groupBy("directory", "licence").agg(F.count("*").alias("n"))
    stated = votes.groupBy("directory").agg(F.min(F.struct((-F.col("n")).alias("minus"), "licence")).alias("b")).select(
        F.col("directory").alias("ancestor"), F.col("b.licence").alias("stated"))
    parts = F.split("directory", "/")
    paths = (light.where("directory IS NOT NULL").select("directory").distinct()
             .withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(parts))))
             .withColumn("ancestor", F.array_join(F.slice(F.split("directory", "/"), F.lit(1), F.col("depth")), "/")))
    nearest = (paths.join(stated, "ancestor").groupBy("directory")
               .agg(F.max(F.struct("depth", "ancestor", "stated")).alias("b"))
               .select("directory", F.col("b.ancestor").alias("ancestor"), F.col("b.stated").alias("stated")))
    return light.join(nearest, "directory", "left").select(
        "doc_id", "directory", F.col("licence").alias("own_licence"), "cosine",
        F.coalesce("licence", "stated").alias("licence"),
        F.when(F.col("licence").isNotNull(), F.lit("own")).otherwise(F.col("ancestor")).alias("licence_from"))


def document_files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source, language, thousand of the id. The id's
    remainder by seven tells the depth: some files lie in a source's root, some in
    its languages' folders, most in the lowest ones."""
    levels = F.array(F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")),
                     F.coalesce(F.floor(F.col("doc_id") / 1000).cast("string"), F.lit("unknown")))
    depth = F.least(F.coalesce(F.pmod("doc_id", F.lit(7)), F.lit(2)) + 1, F.lit(3)).cast("int")
    return docs.select("doc_id", "text", F.array_join(F.slice(levels, F.lit(1), depth), "/").alias("directory"))


def op4_license_scans(spark, sf_dir: str) -> DataFrame:
    return scan_licences(document_files(documents(spark, sf_dir)))


def _oracle() -> str:
    rows = ", ".join(f"('{licence}#{k}', '{licence}', '{w}', {c})" for licence, texts in TEMPLATES.items()
                     for k, t in enumerate(texts) for w, c in sorted(Counter(_words(t)).items()))
    lengths = ", ".join(f"({n})" for n in sorted({len(_words(t)) for texts in TEMPLATES.values() for t in texts}))
    return f"""
WITH template(template, name, word, tf) AS (VALUES {rows}),
vocabulary AS (SELECT DISTINCT word FROM template),
files AS (
  SELECT doc_id, coalesce(text, '') AS text, array_to_string([coalesce(source, 'unknown'), coalesce(lang, 'unknown'),
    coalesce((doc_id // 1000)::VARCHAR, 'unknown')][1:least(coalesce(doc_id % 7, 2) + 1, 3)], '/') AS directory
  FROM documents),
frequency AS (
  SELECT word, count(*) AS df FROM (
    SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '{_BETWEEN}')) AS word FROM files WHERE text <> '')
  WHERE word IN (SELECT word FROM vocabulary) GROUP BY word),
idf AS (
  SELECT v.word, ln((1 + (SELECT count(*) FROM files WHERE text <> '')) / (1 + coalesce(df, 0))) + 1 AS idf FROM vocabulary v LEFT JOIN frequency f ON v.word = f.word),
weight AS (
  SELECT template, name, t.word, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY template)) AS weight FROM template t JOIN idf USING (word)),
line AS (
  SELECT doc_id, generate_subscripts(s, 1) - 1 AS line, unnest(s) AS content FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM files WHERE text <> '')),
line_words AS (SELECT doc_id, line, list_filter(regexp_split_to_array(lower(content), '{_BETWEEN}'), lambda w: w <> '') AS words FROM line),
-- the words shared with a template bound the cosine by the root of their squared weights
words AS (
  SELECT * FROM line_words WHERE doc_id IN (
    SELECT doc_id FROM (SELECT DISTINCT doc_id, unnest(words) AS word FROM line_words) JOIN weight USING (word)
    GROUP BY doc_id, template HAVING sum(weight * weight) >= {0.999 * THRESHOLD ** 2})),
whole AS (
  SELECT doc_id, flatten(list(words ORDER BY line)) AS words, flatten(list(list_transform(words, lambda w: line) ORDER BY line)) AS line_of
  FROM words GROUP BY doc_id),
passage AS (
  SELECT doc_id, 0 AS kind, line, start, words[start + 1:start + {PASSAGE}] AS held
  FROM (SELECT doc_id, line, words, unnest(range(0, greatest(1, len(words) - {PASSAGE - STEP}), {STEP})) AS start FROM words)
  UNION ALL
  SELECT doc_id, 1, line_of[start + 1], start, words[start + 1:start + {PASSAGE}]
  FROM (SELECT *, unnest(range(0, greatest(1, len(words) - {PASSAGE - STEP}), {STEP})) AS start FROM whole)
  WHERE line_of[start + 1] < line_of[least(start + {PASSAGE}, len(words))]
  UNION ALL
  SELECT doc_id, 1 + length, line_of[start + 1], start, words[start + 1:start + length]
  FROM (SELECT *, unnest(range(0, len(words), step)) AS start
        FROM whole, (SELECT length, greatest(1, length // {FITTED_STEPS}) AS step FROM (VALUES {lengths}) AS l(length)))),
-- a passage without any word of a template scores nothing
term AS (
  SELECT doc_id, kind, line, start, word, count(*) AS tf FROM (
    SELECT doc_id, kind, line, start, unnest(held) AS word FROM passage WHERE list_has_any(held, (SELECT list(word) FROM vocabulary)))
  GROUP BY ALL),
weighed AS (SELECT t.*, tf * coalesce(idf, {OTHER}) AS w FROM term t LEFT JOIN idf USING (word)),
scored AS (
  SELECT doc_id, line, start, name, round(dot / norm, 6) AS cosine FROM
    (SELECT doc_id, kind, line, start, template, name, sum(w * weight) AS dot FROM weighed JOIN weight USING (word) GROUP BY ALL)
    JOIN (SELECT doc_id, kind, line, start, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL) USING (doc_id, kind, line, start)
  WHERE round(dot / norm, 6) >= {THRESHOLD}),
best AS (SELECT doc_id, line, name AS licence, cosine FROM scored
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY cosine DESC, line, name) = 1),
light AS (SELECT f.doc_id, directory, line, licence, cosine FROM files f LEFT JOIN best USING (doc_id)),
stated AS (SELECT directory AS ancestor, licence AS stated FROM light WHERE licence IS NOT NULL AND line < {HEADER_LINES} GROUP BY directory, licence
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY count(*) DESC, licence) = 1),
nearest AS (
  SELECT directory, ancestor, stated FROM (SELECT DISTINCT directory FROM light) d
  JOIN stated s ON d.directory = s.ancestor OR starts_with(d.directory, s.ancestor || '/')
  QUALIFY row_number() OVER (PARTITION BY directory ORDER BY length(ancestor) DESC) = 1)
SELECT doc_id, directory, licence AS own_licence, cosine, coalesce(licence, stated) AS licence,
  CASE WHEN licence IS NOT NULL THEN 'own' ELSE ancestor END AS licence_from
FROM light LEFT JOIN nearest USING (directory)
"""


ORACLE = _oracle()
