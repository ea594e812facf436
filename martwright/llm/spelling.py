"""Spelling variants: words one edit apart, by an index of variable-length grams.

1. Words are counted over all documents; each task adds up before the shuffle.
2. *Dictionary.* Grams of the words (``^word$``) are counted. A gram that more
   words hold than the limit is frequent and is pruned from the lists: it is
   extended by the next character instead, up to ``LONGEST`` characters.
3. *Decomposition.* From every position goes the shortest gram that is not
   frequent (or as long as allowed, or at the end). A gram depends on its own
   characters alone, so an edit changes only those that cover it.
4. *Bounds.* For each word, the most grams that one edit anywhere can affect are
   counted; the rest must be shared, each at its place or one beside it.
5. *Merging.* Words that share enough grams share one of their ``affected + 1``
   rarest. These short lists (gram, place, length) are joined; the others are
   merged as a bitmap of each word's grams, which bounds what two words share
   from above; it must reach the larger bound of the two.
6. The edit distance of what is left is verified.

A word's form is its commonest near word, if that is at least twice as common;
so forms form trees, and a word's root is found by pointer doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.text import canonical, documents, store, text_slices

#: The words, and the runs of which a character is deleted.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DELETE_ONE_IN = 97
MIN_CHARS, MIN_COUNT, FORM_RATIO = 5, 3, 2
#: Length of the shortest and longest gram; ``MIN_CHARS`` lets every word of it share a gram.
SHORTEST, LONGEST = 2, 5
#: A gram is frequent beyond so many positions, and beyond this share of all
#: positions: at most ``1 / SHARE`` grams of a length can be, which bounds the dictionary.
FREQUENT, SHARE = 32, 1 / 50_000
#: A task's counts are sent on when they hold so many words or characters.
HELD_WORDS, HELD_CHARS = 200_000, 4_000_000
#: Runs of a text that are counted at once.
RUNS = 100_000


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    chars = 0

    def add(runs: list[str], seed: int):
        nonlocal chars
        for run, n in Counter(runs).items():
            h = zlib.crc32(run.encode(), seed)
            if h % DELETE_ONE_IN == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= MIN_CHARS:
                if run not in counts:
                    chars += len(run)
                counts[run] += n

    for batch in text_slices(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            # bytes.lower() lower-cases A-Z only
            text = text.encode().lower().decode()
            if len(text) < 4 * RUNS:
                add(RUN.findall(text), seed)
            else:
                part = []
                for m in RUN.finditer(text):
                    part.append(m[0])
                    if len(part) == RUNS:
                        add(part, seed)
                        part = []
                add(part, seed)
            if len(counts) >= HELD_WORDS or chars >= HELD_CHARS:
                yield _counted(counts)
                counts, chars = Counter(), 0
    yield _counted(counts)


def word_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur ``min_count`` times or more."""
    each = canonical(docs).mapInArrow(_count_runs, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for word in batch.column("word").to_pylist():
            padded = f"^{word}$"
            for size in range(SHORTEST, LONGEST + 1):
                counts.update(padded[p:p + size] for p in range(len(padded) - size + 1))
        yield _counted(counts).rename_columns(["gram", "n"])


def gram_dictionary(words: DataFrame, frequent: int = FREQUENT, share: float = SHARE) -> dict[str, int]:
    """Frequent grams and their counts: at most 1 / share of each length, whatever the number of words."""
    chars = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    limit = max(frequent, chars * share)
    counts = words.select("word").mapInArrow(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in counts.where(F.col("n") > limit).collect()}


def decompose(word: str, dictionary: dict[str, int]) -> list[str]:
    """The gram that starts at each position of ``^word$`` but the last."""
    padded = f"^{word}$"
    grams = []
    for p in range(len(padded) - 1):
        size = SHORTEST
        while size < LONGEST and p + size < len(padded) and padded[p:p + size] in dictionary:
            size += 1
        grams.append(padded[p:p + size])
    return grams


def affected(grams: list[str]) -> int:
    """The most grams that one inserted, deleted or replaced character can change."""
    cover = [0] * (len(grams) + 2)
    for p, gram in enumerate(grams):
        # characters after the first: an edit there falls into the gram; at the
        # first one, a replaced or deleted character does too
        for at in range(p, p + len(gram)):
            cover[at] += 1
    return max(cover[1:])


def _index(batches: Iterator[pa.RecordBatch], dictionary: dict[str, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"word": [], "size": [], "need": [], "grams": [], "keys": []}
        for word in batch.column("word").to_pylist():
            grams = decompose(word, dictionary)
            changed = affected(grams)
            rarest = sorted(range(len(grams)), key=lambda p: (dictionary.get(grams[p], 0), grams[p], p))[:changed + 1]
            times: Counter = Counter()
            bits = 0
            for gram in grams:  # a repeated gram counts as often as it stands
                bits |= 1 << (zlib.crc32(f"{gram}{times[gram]}".encode()) & 63)
                times[gram] += 1
            out["word"].append(word)
            out["size"].append(len(word))
            out["need"].append(len(grams) - changed)
            out["grams"].append(bits - (1 << 64) if bits >> 63 else bits)
            out["keys"].append([{"gram": grams[p], "place": p} for p in rarest])
        yield pa.RecordBatch.from_arrays([
            pa.array(out["word"], pa.string()), pa.array(out["size"], pa.int32()), pa.array(out["need"], pa.int32()),
            pa.array(out["grams"], pa.int64()), pa.array(out["keys"], pa.list_(pa.struct([("gram", pa.string()), ("place", pa.int32())])))], names=list(out))


def near_words(words: DataFrame, frequent: int = FREQUENT, share: float = SHARE) -> DataFrame:
    """(a, b): each pair of words (distinct, of ``MIN_CHARS`` characters or more)
    that differ by exactly one inserted, deleted or replaced character, once."""
    dictionary = gram_dictionary(words, frequent, share)
    lists = store(words.select("word").mapInArrow(
        lambda batches: _index(batches, dictionary),
        "word string, size int, need int, grams long, keys array<struct<gram:string,place:int>>"), "gram-lists")
    listed = lists.select("word", "size", "need", "grams", F.explode("keys").alias("key")).select(
        "word", "size", "need", "grams", "key.gram", "key.place")
    # the partner is of the same length with the gram at the same place, or one longer with it there or one later
    shift = F.explode(F.array(*[F.struct(F.lit(s).alias("size"), F.lit(p).alias("place")) for s, p in ((0, 0), (1, 0), (1, 1))]))
    probe = listed.withColumn("shift", shift).select(
        F.col("word").alias("a"), F.col("size").alias("size_a"), F.col("need").alias("need_a"), F.col("grams").alias("grams_a"), "gram",
        (F.col("size") + F.col("shift.size")).alias("size"), (F.col("place") + F.col("shift.place")).alias("place"))
    other = listed.select(F.col("word").alias("b"), F.col("need").alias("need_b"), F.col("grams").alias("grams_b"), "gram", "size", "place")
    # a word of m characters has m + 1 grams
    alone_a = F.bit_count(F.col("grams_a").bitwiseAND(F.bitwise_not("grams_b")))
    alone_b = F.bit_count(F.col("grams_b").bitwiseAND(F.bitwise_not("grams_a")))
    shared = F.least(F.col("size_a") - alone_a, F.col("size") - alone_b) + 1
    pairs = (probe.join(other, ["gram", "size", "place"])
             .where((shared >= F.greatest("need_a", "need_b")) & ((F.col("size_a") < F.col("size")) | (F.col("a") < F.col("b"))))
             .where(F.levenshtein("a", "b", 1) == 1))
    return pairs.select("a", "b").distinct()


def _roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): forms followed to the last, by pointer doubling."""
    current = store(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max_rounds):
        further = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = store(current.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        current = joined.select("word", "root")
        if not joined.where("moved").limit(1).count():
            return current
    raise RuntimeError(f"forms did not end in {max_rounds} rounds")


def group_variants(docs: DataFrame, frequent: int = FREQUENT, share: float = SHARE) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Null and empty texts have no words; repeated rows count each time, with the
    deletions of their id; rows without doc_id share those of an empty id. Equal
    counts: the least word in code-point order is the form. An empty table gives
    an empty result; other input columns are ignored.
    """
    words = store(word_counts(docs), "words")
    pairs = store(near_words(words, frequent, share), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # a word has few near words: an alphabet's worth for each place at most
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    judged = store(words.join(best, "word", "left").withColumn(
        "common", F.coalesce(-F.col("best.n") >= FORM_RATIO * F.col("n"), F.lit(False)))
        .select("word", F.when(F.col("common"), F.col("best.near")).alias("form"), "n",
                F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("common"), -F.col("best.n")).alias("form_n")), "forms")
    roots = _roots(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return group_variants(documents(spark, sf_dir))
