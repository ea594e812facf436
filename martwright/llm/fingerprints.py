"""Order MinHash fingerprints, with DataFrame functions only.

A text's k-mers are its runs of K words (a shorter text is one k-mer). Equal
k-mers are numbered in text order, and every (k-mer, number) pair is hashed.
The hash's leading bits deal the pairs into BINS; in each bin the TUPLE least
pairs are selected, put back into *text order*, and their k-mers hashed together.
So a bin's code survives only if its minimal k-mers do, in the same order:
likeness falls with edit distance, not just with the set of words.

The fingerprint lists the bins' codes (8 hexadecimal digits each, ``-`` where a
bin is empty). Likeness is the share of equal codes among the bins that are not
empty in both texts; two texts without words are alike.

Positions and hashes share one long (as many low bits as positions need), so a
text is sorted twice as a plain array of longs; everything else is linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.text import WORD_SEPARATORS, documents

K, TUPLE, BINS = 2, 2, 64
#: Rows of one range of doc_id, ordered by one task, and most ranges (their
#: cuts are held by every task; beyond that ranges grow and are sorted with spill).
RANGE_ROWS, MAX_RANGES = 4_000, 10_000


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is used:
    the optimizer would copy a column used inside a lambda into the lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _span(count: Column) -> Column:
    """0 .. count - 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def fingerprint(text: str | Column) -> Column:
    """The fingerprint of a string column (null: as empty)."""
    words = F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SEPARATORS), lambda x: x != ""), lambda x: F.xxhash64(x))
    # a k-mer is its words' hashes together; a short text's missing ones are null
    return _let(words, lambda w: _let(
        F.when(F.size(w) >= K, F.size(w) - (K - 1)).otherwise(F.least(F.size(w), F.lit(1))),
        lambda n: _let(
            F.transform(_span(n), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(K)])),
            lambda kmers: _let(F.length(F.bin(n)), lambda bits: _of_kmers(kmers, n, bits)))))


def _of_kmers(kmers: Column, n: Column, bits: Column) -> Column:
    high = lambda x: F.call_function("shiftleft", F.call_function("shiftright", x, bits), bits)
    bin_of = lambda x: F.shiftrightunsigned(x, 64 - (BINS - 1).bit_length())

    def selected(mask: Column, ordered: Column) -> Column:
        starts = F.filter(_span(n), lambda i: (i == 0) | (high(F.get(ordered, i)) != high(F.get(ordered, i - 1))))
        # equal k-mers lie together, in text order: their number is the place in their run
        numbers = _let(starts, lambda at: F.flatten(F.transform(
            at, lambda a, r: F.sequence(F.lit(0), F.coalesce(F.get(at, r + 1), n) - a - 1))))
        pairs = _let(numbers, lambda number: F.sort_array(F.transform(ordered, lambda x, i: high(
            F.xxhash64(F.get(kmers, x.bitwiseAND(mask).cast("int")), F.get(number, i))).bitwiseOR(x.bitwiseAND(mask)))))
        # by (bin, hash): the first TUPLE of every bin
        return _let(pairs, lambda p: F.filter(p, lambda x, i: (i < TUPLE) | (bin_of(F.get(p, i - TUPLE)) != bin_of(x))))

    def codes(mask: Column, chosen: Column, heads: Column) -> Column:
        def code(a, r):
            count = F.coalesce(F.get(heads, r + 1), F.size(chosen)) - a
            in_order = F.sort_array(F.transform(F.slice(chosen, a + 1, count), lambda x: x.bitwiseAND(mask).cast("int")))
            joined = F.xxhash64(F.transform(in_order, lambda p: F.get(kmers, p)))
            return F.struct(bin_of(F.get(chosen, a)).alias("bin"), F.lpad(
                F.lower(F.hex(joined.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0").alias("code"))

        return _let(F.map_from_entries(F.transform(heads, code)), lambda filled: F.concat_ws(",", F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(BINS - 1).cast("long")),
            lambda b: F.coalesce(F.element_at(filled, b), F.lit("-")))))

    def of_chosen(mask: Column, chosen: Column) -> Column:
        heads = F.filter(_span(F.size(chosen)), lambda i: (i == 0) | (bin_of(F.get(chosen, i)) != bin_of(F.get(chosen, i - 1))))
        return _let(heads, lambda h: codes(mask, chosen, h))

    return _let(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, lambda mask: _let(
        F.sort_array(F.transform(kmers, lambda h, i: high(h).bitwiseOR(i.cast("long")))),
        lambda ordered: _let(selected(mask, ordered), lambda chosen: of_chosen(mask, chosen))))


def likeness(a: str | Column, b: str | Column) -> Column:
    """0 to 1, from two fingerprints."""
    pairs = F.arrays_zip(F.split(a, ",").alias("x"), F.split(b, ",").alias("y"))
    some = F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-"))
    same = F.filter(some, lambda p: p["x"] == p["y"])
    return F.when(F.size(some) == 0, F.lit(1.0)).otherwise(F.size(same) / F.size(some)).cast("double")


def with_next(docs: DataFrame, column: str, out: str, range_column: str, order: list[str]) -> DataFrame:
    """``column`` of the next row in ascending order, within ranges that each
    end with a halo of the following one's first row."""
    return docs.withColumn(out, F.lead(column).over(Window.partitionBy(range_column).orderBy(*order)))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text (the last half replaced by
    the start of the next document's), and their likenesses.

    Documents follow each other by ascending doc_id (nulls first, ties by text);
    after the last comes the first, and an only document follows itself. Null
    texts are empty; an empty table gives an empty result; further input columns
    are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    facts = base.agg(F.count("*").alias("rows"), F.min("doc_id").alias("least"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls")).first()
    ranges = min(MAX_RANGES, max(1, facts["rows"] // RANGE_ROWS))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = sorted(set(base.agg(F.percentile_approx("doc_id", shares, 10 * ranges)).first()[0] or [])) if shares else []
    # the cuts are ids that exist: the first row of a range is known without a look at its texts
    cuts = [c for c in cuts if c != facts["least"] or facts["nulls"]]
    if cuts:
        held = F.array(*[F.lit(c).cast("long") for c in cuts])
        number = F.coalesce(F.size(F.filter(held, lambda c: c <= F.col("doc_id"))), F.lit(0))
        number = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(number)
        opens = F.coalesce(F.array_contains(held, F.col("doc_id")), F.lit(False))
    else:
        number, opens = F.lit(0), F.lit(False)
    last = len(cuts)
    first = F.col("doc_id").isNull() if facts["nulls"] else F.col("doc_id") == F.lit(facts["least"])
    placed = base.withColumn("_range", number).withColumn("_halo", F.lit(0))
    extra = F.concat(F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("h"))),
                     F.when(opens, F.array(F.struct((F.col("_range") - 1).alias("r"), F.lit(1).alias("h")))).otherwise(F.array().cast("array<struct<r:int,h:int>>")),
                     F.when(first, F.array(F.struct(F.lit(last).alias("r"), F.lit(2).alias("h")))).otherwise(F.array().cast("array<struct<r:int,h:int>>")))
    placed = placed.withColumn("_at", F.explode(extra)).select("doc_id", "text", F.col("_at.r").alias("_range"), F.col("_at.h").alias("_halo"))
    order = ["_halo", "doc_id", "text"]
    placed = with_next(placed, "text", "_next", "_range", order)
    half = F.floor(F.char_length("text") / 2).cast("int")
    placed = (placed.withColumn("n_chars", F.char_length("text").cast("long"))
              .withColumn("_edited", F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half)))
              .drop("_next").withColumn("edited_sha256", F.sha2("_edited", 256)))
    printed = (placed.withColumn("fingerprint", fingerprint("text"))
               .withColumn("edited_fingerprint", fingerprint("_edited")).drop("_edited"))
    following = with_next(printed, "fingerprint", "_next_fingerprint", "_range", order).where("_halo = 0")
    return following.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "_next_fingerprint").alias("near_next"))


def op10_order_minhash(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))
