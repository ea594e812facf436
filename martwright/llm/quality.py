"""Quality rules with cross-document line frequency.

Every text gets base signals. Its lines are normalised (ASCII lower case, runs of
white space as one blank) and hashed, and for each host the distinct documents
that hold a line are counted: equal texts are one document. A line in
more documents of a host than the limit is boilerplate and is removed, except
from the first document that has it, so that a group of near copies never
vanishes whole. A document left with too few of its words is depleted and is
rejected, like one that fails the base rules.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.bloom import split_rows
from martwright.llm.text import canonical, documents, packed, store, text_slices, tidy, unpacked, word_hashes, words_of

#: A line in more documents of its host than this is removed, however large the host.
LINE_DOCUMENTS = 20
#: A document is depleted when less than this share of its words is left.
LEFT_SHARE = 0.30
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, REPEAT_PERCENT = 50, 50

_SIGNALS = ("doc_id long, row_key long, host string, content long, n_words long, word_chars long, n_symbols long, "
            "n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<int>")


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[bounds])


def repeated_words(index: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of each text in 3-word windows that it holds twice or more."""
    n = len(index)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    if n < 3:
        return np.zeros(len(bounds) - 1, dtype=np.int64)
    whole = np.flatnonzero(doc[:-2] == doc[2:])
    width = int(index.max()) + 1
    if width < 1 << 21:
        window = (index[whole] * width + index[whole + 1]) * width + index[whole + 2]
    else:
        pairs = np.unique(index[whole] * width + index[whole + 1], return_inverse=True)[1]
        window = pairs * width + index[whole + 2]
    # stable: equal windows of one text lie side by side
    order = np.argsort(window, kind="stable")
    equal = (window[order][1:] == window[order][:-1]) & (doc[whole][order][1:] == doc[whole][order][:-1])
    twice = np.zeros(len(whole), dtype=bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[whole[twice] + k] = True
    return _sums(covered, bounds)


def normalised_lines(lines: pa.Array) -> pa.Array:
    return pc.ascii_trim_whitespace(pc.replace_substring_regex(pc.ascii_lower(lines), r"[ \t-\r]+", " "))


def _lines_of(texts: pa.Array):
    """(index of each line in the distinct lines, the distinct lines, bounds, hash and words of each distinct line)."""
    lists = pc.split_pattern(texts, "\n")
    encoded = lists.flatten().dictionary_encode()
    distinct = encoded.dictionary
    bounds = lists.offsets.to_numpy().astype(np.int64)
    _, _, words = words_of(distinct)
    hashes = word_hashes(normalised_lines(distinct)).view(np.int64)
    return encoded.indices.to_numpy().astype(np.int64), distinct, bounds - bounds[0], hashes, np.diff(words)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        texts = batch.column("text")
        index, distinct, bounds = words_of(texts)
        chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
        line, kinds, line_bounds, hashes, words = _lines_of(texts)
        worded = words[line] > 0
        doc = np.repeat(np.arange(len(texts)), np.diff(line_bounds))
        first = np.unique(doc[worded] * max(1, len(kinds)) + line[worded])
        once = np.bincount(first // max(1, len(kinds)), minlength=len(texts))
        offsets = pa.array(line_bounds, pa.int32())
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), batch.column("row_key"), batch.column("host"), batch.column("content"),
            pa.array(np.diff(bounds)), pa.array(_sums(chars[index] if len(index) else index, bounds)),
            pc.cast(pc.count_substring_regex(texts, SYMBOLS), pa.int64()),
            pa.array(_sums(worded, line_bounds) - once), pa.array(repeated_words(index, bounds)),
            pa.ListArray.from_arrays(offsets, pa.array(hashes[line], mask=~worded)),
            pa.ListArray.from_arrays(offsets, pa.array(words[line].astype(np.int32)))],
            names=[c.split()[0] for c in _SIGNALS.split(", ")])


def _frequent_lines(signals: DataFrame, line_documents: int) -> DataFrame:
    """(host, line, first_doc) of lines in more documents of their host than the limit."""
    held = signals.select("host", "content", "doc_id", F.explode(F.array_distinct("lines")).alias("line")).where("line IS NOT NULL")
    # distinct contents first: copies of one text, however many, count once
    return (held.groupBy("host", "line", "content").agg(F.min("doc_id").alias("doc_id"))
            .groupBy("host", "line").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first_doc"))
            .where(F.col("docs") > line_documents).select("host", "line", "first_doc"))


def quality_signals(docs: DataFrame, host: str = "source", line_documents: int = LINE_DOCUMENTS,
                    left_share: float = LEFT_SHARE) -> DataFrame:
    """One row per document: doc_id, row_key, the base signals, ``removed_at``
    (line numbers from 0), n_removed_words, base_failed, kept.

    Null and empty texts have no words and fail; a null host is a host of its
    own; repeated rows count as one document and share a verdict; ties of the
    first document go to the least doc_id (rows without one never are first). An
    empty table gives an empty result; further input columns are ignored.
    """
    base = canonical(docs, F.col(host).cast("string").alias("host")).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed = base.withColumn("row_key", F.xxhash64("doc_id", "text", "host")).withColumn("content", F.xxhash64("text"))
    signals = store(keyed.select("doc_id", "row_key", "host", "content", "text").mapInArrow(tidy(_scan), _SIGNALS), "signals")
    frequent = _frequent_lines(signals, line_documents).withColumnRenamed("host", "_host").withColumnRenamed("line", "_line")
    removed = (signals.select("row_key", "doc_id", "host", F.explode(F.array_distinct("lines")).alias("line"))
               .join(frequent, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host")))
               .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
               .groupBy("row_key").agg(F.sort_array(F.collect_set("line")).alias("removed_lines")))
    # (a set per document: never more than its own lines)
    places = F.transform("lines", lambda line, i: F.when(F.array_contains("removed_lines", line), i))
    n_removed = F.aggregate("removed_at", F.lit(0).cast("long"), lambda n, i: n + F.get("line_words", i))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (signals.join(removed, "row_key", "left")
            .withColumn("removed_at", F.when(F.col("removed_lines").isNotNull(), F.array_compact(places)))
            .withColumn("n_removed_words", F.coalesce(n_removed, F.lit(0).cast("long")))
            .withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_removed_words") >= left_share * F.col("n_words")))
            .select("doc_id", "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "removed_at", "n_removed_words", "base_failed", "kept"))


def filter_quality(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The documents that are kept, in the columns of ``docs``, without their
    frequent lines (``n_chars`` follows the text where there is such a column).

    Null and empty texts fail and go; repeated rows stay or go together; a null
    host is a host of its own; an empty table gives an empty result; no name of
    another column clashes. Only rows that go or lose lines meet their verdict
    by a join; the others are told by a filter of keys and are not shuffled.
    """
    verdicts = quality_signals(docs, host, **limits)
    changed = store(verdicts.where("NOT kept OR removed_at IS NOT NULL").select(F.col("row_key").alias("key"), "kept", "removed_at")
                    .dropDuplicates(["key"]), "quality-changed")
    text = F.coalesce("_row.text", F.lit(""))
    keyed = packed(docs).withColumn("_id", F.xxhash64(F.col("_row.doc_id").cast("long"), text, F.col(f"_row.`{host}`").cast("string")))
    same, others = split_rows(keyed, "_id", changed.select("key"))
    judged = others.join(changed, F.col("_id") == F.col("key"), "left").where(F.coalesce("kept", F.lit(True)))
    left = F.array_join(F.filter(F.split(text, "\n", -1), lambda line, i: ~F.array_contains("removed_at", i)), "\n")
    out = judged.select("_row", F.when(F.col("removed_at").isNull(), text).otherwise(left).alias("_text"))
    if same is not None:
        out = out.unionByName(same.select("_row", text.alias("_text")))
    return unpacked(out, F.col("_text"))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    signals = quality_signals(documents(spark, sf_dir)).drop("row_key", "removed_at")
    return signals.select(*[c for c in signals.columns if c != "n_removed_words"], "n_removed_words")
