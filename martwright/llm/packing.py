"""Packing documents into fixed windows by non-negative least squares.

Lengths are few (at most ``window`` different ones), so the plan is made on
their histogram, whatever the number of documents:

1. cut every document into pieces of at most ``window`` tokens;
2. enumerate shallow combinations of present lengths (one to four pieces) that
   fill a window exactly, or nearly where no exact one exists;
3. solve for non-negative repeat counts whose pieces match the histogram best;
4. round the counts, never using more pieces than there are;
5. pack what is left by best fit, in runs of equal sequences.

The plan says which ranks of each length go to which sequences, so a piece
finds its place from its length and its rank among pieces of that length. Ranks
come from salted counts; no group of equal lengths meets in one task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.text import as_binary, canonical, documents, store, text_slices, tidy
from martwright.llm.tokens import encoder, tokenizer_json

WINDOW = 4096
END_ID = 2
#: Columns of the least-squares problem offered for each present length.
PAIRS_AND_TRIPLES = 12
#: Buckets that share the ranking of one length.
SALTS = 64

_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def token_pieces(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``window`` ids (little-endian unsigned 32-bit). A null
    or empty text is one piece with the end id; repeated rows each have their
    own pieces."""
    json_text = tokenizer_json(tokenizer_path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            ids, bounds = encoder(json_text).encode(batch.column("text"), end_id)
            tokens = np.diff(bounds)
            pieces = -(-tokens // window)
            doc = np.repeat(np.arange(len(tokens)), pieces)
            number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * window
            length = np.minimum(window, tokens[doc] - start)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length), pa.array(tokens[doc]),
                as_binary(ids.astype("<u4"), np.concatenate(([0], np.cumsum(length))))],
                names=["doc_id", "start", "length", "doc_tokens", "ids"])

    return canonical(docs).withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(tidy(cut), _PIECES)


def combinations(lengths: list[int], window: int, each: int = PAIRS_AND_TRIPLES) -> list[tuple[int, ...]]:
    """Shallow combinations, largest piece first: for every length the exact
    pair, exact triples and quadruples spread over the other lengths, and the
    best near fill by one more piece."""
    present = set(lengths)
    ordered = sorted(present)
    found: set[tuple[int, ...]] = set()
    for a in ordered:
        rest = window - a
        if rest == 0:
            found.add((a,))
            continue
        if rest in present:
            found.add(tuple(sorted((a, rest), reverse=True)))
        elif (i := bisect_right(ordered, rest)) > 0:
            found.add(tuple(sorted((a, ordered[i - 1]), reverse=True)))
        below = ordered[:bisect_right(ordered, rest - 1)]
        triples = 0
        for b in below[::max(1, len(below) // (8 * each))]:
            if rest - b in present:
                found.add(tuple(sorted((a, b, rest - b), reverse=True)))
                triples += 1
            elif (left := rest - b) > 1 and (i := bisect_right(ordered, left // 2)) > 0:
                c = ordered[i - 1]
                if left - c in present:
                    found.add(tuple(sorted((a, b, c, left - c), reverse=True)))
                    triples += 1
            if triples >= each:
                break
    return sorted(found)


def nonnegative_least_squares(columns: list[tuple[int, ...]], counts: dict[int, int], rounds: int = 400) -> np.ndarray:
    """x >= 0 minimising |A x - counts|, A[l, j] = pieces of length l in column
    j, by accelerated projected gradients on the sparse columns."""
    row_of = {length: i for i, length in enumerate(counts)}
    rows = np.array([row_of[l] for c in columns for l in c])
    cols = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    target = np.array(list(counts.values()), dtype=float)

    def forward(x):
        return np.bincount(rows, x[cols], len(target))

    def backward(r):
        return np.bincount(cols, r[rows], len(columns))

    v = np.ones(len(columns))
    for _ in range(20):  # the largest eigenvalue of A'A bounds the step
        v = backward(forward(v))
        scale = np.linalg.norm(v)
        v /= scale
    x = y = np.zeros(len(columns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - backward(forward(y) - target) / (1.05 * scale))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t_new * (new - x), new, t_new
    return x


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, tuple[int, ...]]]:
    """[(repeats, lengths of the pieces of one sequence)] that use every piece
    of the histogram exactly once."""
    left = {length: n for length, n in counts.items() if n > 0}
    runs: list[tuple[int, tuple[int, ...]]] = []

    def use(columns: tuple[int, ...], at_most: float):
        need = {l: columns.count(l) for l in set(columns)}
        repeats = int(min(at_most, *(left.get(l, 0) // k for l, k in need.items())))
        if repeats > 0:
            runs.append((repeats, columns))
            for l, k in need.items():
                left[l] -= k * repeats
                if not left[l]:
                    del left[l]

    if left:
        columns = combinations(list(left), window)
        exact = [c for c in columns if sum(c) == window] or columns
        solved = nonnegative_least_squares(exact, left)
        for j in np.argsort(-solved, kind="stable"):
            use(exact[j], np.floor(solved[j] + 0.5))
    ordered = sorted(left)
    while left:
        # best fit over the residual histogram, as many times as it lasts
        sequence, room, taken = [], window, {}
        while True:
            i = bisect_right(ordered, room) - 1
            while i >= 0 and left.get(ordered[i], 0) <= taken.get(ordered[i], 0):
                i -= 1
            if i < 0:
                break
            l = ordered[i]
            sequence.append(l)
            taken[l] = taken.get(l, 0) + 1
            room -= l
        use(tuple(sequence), float("inf"))
        if any(l not in left for l in taken):
            ordered = sorted(left)
    return runs


def _places(runs: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, pieces of that length in a sequence, first
    sequence, offset of the first of them) for each run and length."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for repeats, lengths in runs:
        offset = 0
        for l in sorted(set(lengths), reverse=True):
            k = lengths.count(l)
            rows.append((l, used.get(l, 0), repeats * k, k, sequence, offset))
            used[l] = used.get(l, 0) + repeats * k
            offset += l * k
        sequence += repeats
    return rows


def pack_pieces(pieces: DataFrame, window: int = WINDOW, salts: int = SALTS) -> DataFrame:
    """Adds sequence_id and offset to pieces (rows with a ``length`` of 1 to
    ``window`` and a unique ``piece`` key); all other columns pass through.
    An empty table gives an empty result."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `window` rows
    rows = _places(plan(counts, window))
    places = spark.createDataFrame(rows, "length long, first_rank long, ranks long, per_sequence long, first_sequence long, first_offset long")
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = (salted.groupBy("length", "_salt").count()
             .select("length", "_salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base")))
    within = Window.partitionBy("length", "_salt").orderBy("piece")
    ranked = (salted.withColumn("_rank", F.row_number().over(within) - 1)
              .join(bases, ["length", "_salt"])
              .withColumn("_rank", F.col("_rank") + F.col("_base")))
    # the places of a length are sorted runs: an array per length, found by rank
    held = places.groupBy("length").agg(F.sort_array(F.collect_list(F.struct(
        "first_rank", "ranks", "per_sequence", "first_sequence", "first_offset"))).alias("_runs"))
    place = F.element_at(F.filter("_runs", lambda r: r["first_rank"] <= F.col("_rank")), -1)
    at = F.col("_rank") - F.col("_place.first_rank")
    return (ranked.join(F.broadcast(held), "length")  # one row per length, bounded by the window
            .withColumn("_place", place)
            .withColumn("sequence_id", F.col("_place.first_sequence") + F.floor(at / F.col("_place.per_sequence")))
            .withColumn("offset", F.col("_place.first_offset") + F.pmod(at, F.col("_place.per_sequence")) * F.col("length"))
            .select(*pieces.columns, "sequence_id", "offset"))


def packed_digests(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces with a digest in place of their ids, packed."""
    digests = store(
        token_pieces(docs, tokenizer_path, window)
        .select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                F.monotonically_increasing_id().alias("piece")), "pieces")
    return pack_pieces(digests, window).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    return packed_digests(documents(spark, sf_dir))
