"""Toxicity scores: a bidirectional gated recurrent network with attention
pooling over character and word inputs, trained and run in numpy.

A word's input is its own (hashed) embedding beside the pooled embeddings of its
character n-grams (of three and of five, ends of the word included). A window of WINDOW words is read in both directions, its
states are pooled by attention, and the pool gives the window's logit. Windows
overlap by half and cover the whole text; a document's score is its highest
window's. Training knows labels of documents only: a document's logit is the
log-sum of its windows' (some window must be toxic, or none may be).

Training rows are a bounded sample (TRAIN_ROWS of each class, the least hashes
first) of labelled rows that are not held out, up to TRAIN_WORDS words long while
a class has such; all else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.text import canonical, documents, gather, mixed, text_slices, word_hashes, words_of

WINDOW, STEP = 32, 16
WORD_ROWS, CHAR_ROWS = 1 << 15, 1 << 15
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 16, 8, 8
#: The bound of the training sample: rows of each class, words of a row.
TRAIN_ROWS, TRAIN_WORDS = 600, 1_500
UPDATES, WINDOWS_PER_UPDATE, RATE = 160, 400, 0.01
#: Windows of an excerpt.
EXCERPTS = 10
#: Windows run at once.
BLOCK = 2_048
FOLDS = 5

Parameters = dict[str, np.ndarray]


def word_inputs(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word row, flat n-gram rows, n-gram bounds) of each distinct word;
    punctuation around a word is dropped."""
    bare = pc.ascii_trim(words, characters=".,;:!?\"'()[]{}*-_")
    rows = (word_hashes(bare) % np.uint64(WORD_ROWS)).astype(np.int64)
    lengths = pc.utf8_length(bare).to_numpy(zero_copy_only=False).astype(np.int64)
    code = np.frombuffer("".join(bare.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    # every word between two marks on each side; two n-grams around each of its characters
    marked = lengths + 4
    ends = np.cumsum(marked)
    padded = np.ones(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    inner = np.ones(len(padded), dtype=bool)
    for k in (1, 2):
        inner[ends - marked + k - 1] = False
        inner[ends - k] = False
    padded[inner] = code
    at = np.flatnonzero(inner)
    three = (padded[at - 1] << np.uint64(42)) + (padded[at] << np.uint64(21)) + padded[at + 1]
    five = mixed(three) + (padded[at - 2] << np.uint64(21)) + padded[at + 2]
    grams = (mixed(np.stack((three, five), axis=1).ravel()) % np.uint64(CHAR_ROWS)).astype(np.int64)
    return rows, grams, 2 * np.concatenate(([0], np.cumsum(lengths)))


def windows_of(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, words, text) of every window; a text without words has one empty window."""
    counts = np.diff(bounds)
    each = 1 + np.maximum(0, -(-(counts - WINDOW) // STEP))
    text = np.repeat(np.arange(len(counts)), each)
    number = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    return bounds[text] + number * STEP, np.clip(counts[text] - number * STEP, 0, WINDOW), text


def new_parameters(seed: int = 5) -> Parameters:
    rng = np.random.default_rng(seed)
    inputs = WORD_DIM + CHAR_DIM
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"word": np.zeros((WORD_ROWS, WORD_DIM)), "char": rng.standard_normal((CHAR_ROWS, CHAR_DIM)) * 0.05,
         "attend": normal(2 * HIDDEN, ATTENTION), "focus": normal(ATTENTION), "out": normal(2 * HIDDEN), "bias": np.zeros(1)}
    for side in ("ahead", "back"):
        p |= {f"{side}_in": normal(inputs, 3 * HIDDEN), f"{side}_bias": np.zeros(3 * HIDDEN), f"{side}_state": normal(HIDDEN, 3 * HIDDEN)}
    return {k: v.astype(np.float32) for k, v in p.items()}


def _embed(p: Parameters, rows: np.ndarray, grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros((len(rows), CHAR_DIM), dtype=np.float32)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        sums[some] = np.add.reduceat(p["char"][grams], bounds[some], axis=0)
    return np.concatenate((p["word"][rows], sums / np.sqrt(np.maximum(1, np.diff(bounds)))[:, None].astype(np.float32)), axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(given: np.ndarray, mask: np.ndarray, state: np.ndarray, keep: bool):
    """Gated recurrence over (steps, windows, 3 * HIDDEN) inputs."""
    h = np.zeros((given.shape[1], HIDDEN), dtype=np.float32)
    out = np.empty((len(given), given.shape[1], HIDDEN), dtype=np.float32)
    saved = []
    for t in range(len(given)):
        g = h @ state
        gates = _sigmoid(given[t, :, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(given[t, :, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
        new = (n + z * (h - n)) * mask[t]
        if keep:
            saved.append((h, z, r, n, g[:, 2 * HIDDEN:]))
        out[t] = h = new
    return out, saved


def _run_back(grad: np.ndarray, mask: np.ndarray, state: np.ndarray, saved: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs and of the state matrix."""
    given = np.empty((*grad.shape[:2], 3 * HIDDEN), dtype=np.float32)
    d_state = np.zeros_like(state)
    d_h = np.zeros(grad.shape[1:], dtype=np.float32)
    for t in reversed(range(len(grad))):
        h, z, r, n, g = saved[t]
        d = (d_h + grad[t]) * mask[t]
        d_n = d * (1 - z) * (1 - n * n)
        d_z = d * (h - n) * z * (1 - z)
        d_r = d_n * g * r * (1 - r)
        given[t] = np.concatenate((d_z, d_r, d_n), axis=1)
        d_g = np.concatenate((d_z, d_r, d_n * r), axis=1)
        d_state += h.T @ d_g
        d_h = d * z + d_g @ state.T
    return given, d_state


def _layout(first: np.ndarray, words: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word of each step and window, mask): steps by windows; masked steps hold word 0."""
    steps = np.arange(WINDOW)[:, None]
    inside = steps < words[None, :]
    at = np.where(inside, first[None, :] + steps, 0)
    return (index[at] if len(index) else np.zeros_like(at)), inside[:, :, None].astype(np.float32)


def _pool(p: Parameters, states: np.ndarray, mask: np.ndarray):
    mid = np.tanh(states @ p["attend"])
    score = np.where(mask[:, :, 0] > 0, mid @ p["focus"], np.float32(-1e9))
    weight = np.exp(score - score.max(axis=0)) * mask[:, :, 0]
    weight /= np.maximum(weight.sum(axis=0), np.float32(1e-9))
    pooled = np.einsum("tb,tbh->bh", weight, states)
    return mid, weight, pooled, pooled @ p["out"] + p["bias"][0]


def logits(p: Parameters, texts: pa.Array) -> np.ndarray:
    """The highest window's logit of each text."""
    index, distinct, bounds = words_of(pc.ascii_lower(pc.fill_null(texts, "")))
    if len(distinct) == 0:
        distinct = pa.array([""])
    x = _embed(p, *word_inputs(distinct))
    sides = {s: x @ p[f"{s}_in"] + p[f"{s}_bias"] for s in ("ahead", "back")}
    first, words, text = windows_of(bounds)
    out = np.empty(len(first), dtype=np.float32)
    for a in range(0, len(first), BLOCK):
        word, mask = _layout(first[a:a + BLOCK], words[a:a + BLOCK], index)
        ahead, _ = _run(sides["ahead"][word], mask, p["ahead_state"], False)
        back, _ = _run(sides["back"][word[::-1]], mask[::-1], p["back_state"], False)
        out[a:a + BLOCK] = _pool(p, np.concatenate((ahead, back[::-1]), axis=2), mask)[3]
    return np.maximum.reduceat(out, np.flatnonzero(np.diff(text, prepend=-1))) if len(out) else out


def _gradients(p: Parameters, inputs, index: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Parameters:
    """Gradients of the mean cross-entropy of some documents (word positions in ``bounds``)."""
    first, words, text = windows_of(bounds)
    word, mask = _layout(first, words, index)
    used, place = np.unique(word, return_inverse=True)
    place = place.reshape(word.shape)
    rows, (grams, gram_bounds) = inputs[0][used], gather(inputs[1], inputs[2], used)
    x = _embed(p, rows, grams, gram_bounds)
    runs = {}
    for side, flip in (("ahead", slice(None)), ("back", slice(None, None, -1))):
        runs[side] = _run((x @ p[f"{side}_in"] + p[f"{side}_bias"])[place[flip]], mask[flip], p[f"{side}_state"], True)
    states = np.concatenate((runs["ahead"][0], runs["back"][0][::-1]), axis=2)
    mid, weight, pooled, z = _pool(p, states, mask)
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    top = np.maximum.reduceat(z, starts)
    share = np.exp(z - top[text])
    total = np.add.reduceat(share, starts)
    doc = top + np.log(total)
    d_z = ((_sigmoid(doc) - labels)[text] * share / total[text] / len(labels)).astype(np.float32)
    g = {"bias": np.array([d_z.sum()]), "out": pooled.T @ d_z}
    d_pooled = d_z[:, None] * p["out"]
    d_weight = np.einsum("bh,tbh->tb", d_pooled, states)
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_mid = d_score[:, :, None] * p["focus"] * (1 - mid * mid)
    g["focus"] = np.einsum("tb,tba->a", d_score, mid)
    g["attend"] = np.einsum("tbh,tba->ha", states, d_mid)
    d_states = weight[:, :, None] * d_pooled + d_mid @ p["attend"].T
    d_x = np.zeros_like(x)
    order = np.argsort(place, axis=None, kind="stable")
    heads = np.flatnonzero(np.diff(place.ravel()[order], prepend=-1))
    for side, flip, cut in (("ahead", slice(None), slice(0, HIDDEN)), ("back", slice(None, None, -1), slice(HIDDEN, None))):
        d_in, g[f"{side}_state"] = _run_back(d_states[flip][:, :, cut], mask[flip], p[f"{side}_state"], runs[side][1])
        by_word = np.add.reduceat(d_in[flip].reshape(-1, 3 * HIDDEN)[order], heads, axis=0)
        g[f"{side}_in"], g[f"{side}_bias"] = x.T @ by_word, by_word.sum(axis=0)
        d_x += by_word @ p[f"{side}_in"].T
    g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
    np.add.at(g["word"], rows, d_x[:, :WORD_DIM])
    counts = np.diff(gram_bounds)
    np.add.at(g["char"], grams, np.repeat(d_x[:, WORD_DIM:] / np.sqrt(np.maximum(1, counts))[:, None], counts, axis=0))
    return g


def train(texts: list[str], labels: np.ndarray, updates: int = UPDATES, seed: int = 5) -> Parameters:
    """Adam on balanced batches of whole documents. Without rows of both
    classes the network stays as it began, with an output of the one class's share."""
    p = new_parameters(seed)
    if len(set(labels.tolist())) < 2:
        p["out"][:] = 0
        p["bias"][0] = -2.0 if not len(labels) or labels[0] == 0 else 2.0
        return p
    rng = np.random.default_rng(seed)
    index, distinct, bounds = words_of(pc.ascii_lower(pa.array(texts, pa.string())))
    inputs = word_inputs(distinct)
    classes = [rng.permutation(np.flatnonzero(labels == c)) for c in (0, 1)]
    turn = [0, 0]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for step in range(1, updates + 1):
        batch, windows, c = [], 0, 0
        while windows < WINDOWS_PER_UPDATE or c:
            i = classes[c][turn[c] % len(classes[c])]
            turn[c] += 1
            batch.append(i)
            windows += 1 + max(0, (bounds[i + 1] - bounds[i] - WINDOW) // STEP + 1)
            c = 1 - c
        part, part_bounds = gather(index, bounds, np.array(batch))
        g = _gradients(p, inputs, part, part_bounds, labels[batch].astype(np.float32))
        rate = RATE * min(1.0, 2 * (1 - step / (updates + 1)))
        for k, v in p.items():
            m, s = moments[k]
            m += 0.1 * (g[k] - m)
            s += 0.01 * (g[k] * g[k] - s)
            v -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return p


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def excerpt() -> F.Column:
    """Word windows spread evenly over a long text, of TRAIN_WORDS words in all."""
    words, each = F.split("text", "[ \t-\r]+"), TRAIN_WORDS // EXCERPTS
    start = lambda i: F.floor((F.size(words) - each) * i / (EXCERPTS - 1)).cast("int")
    return F.array_join(F.concat(*[F.slice(words, start(i) + 1, F.lit(each)) for i in range(EXCERPTS)]), " ")


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """At most ``rows`` labelled, not held out texts of each class: the first by
    hash of those up to TRAIN_WORDS words. A class that has longer ones only
    gives excerpts of these; it is empty only if ``docs`` has none of its rows."""
    known = (labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .where(F.col("doc_id").isNotNull()).where(~held_out()))
    order = F.xxhash64("doc_id", F.lit("train"))
    fit = docs.where(F.size(F.split("text", "[ \t-\r]+")) <= TRAIN_WORDS)

    def first_ids(labelled: DataFrame, c: int, n: int) -> list[int]:
        return [r["doc_id"] for r in labelled.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(n).collect()]

    def texts(source: DataFrame, ids: list[int]) -> list:
        found = source.where(F.col("doc_id").isin(ids)).select("doc_id", "text", order.alias("order")).collect()
        return sorted(found, key=lambda r: (r["order"], r["text"]))

    # ids first, from the labels alone: the texts of a bounded set of ids need no join
    ids = {c: first_ids(known, c, 2 * rows) for c in (0, 1)}
    found = texts(fit, ids[0] + ids[1])
    taken: dict[int, list] = {}
    for c in (0, 1):
        held = set(ids[c])
        taken[c] = [r for r in found if r["doc_id"] in held]
        if len(taken[c]) < rows and len(ids[c]) == 2 * rows:  # there are labels further on
            taken[c] = texts(fit, first_ids(known.join(fit.select("doc_id").distinct(), "doc_id"), c, rows))
        if not taken[c] and ids[c]:
            there = first_ids(known.join(docs.select("doc_id").distinct(), "doc_id"), c, rows)
            taken[c] = texts(docs.withColumn("text", excerpt()), there)
        taken[c] = taken[c][:rows]
    return ([r["text"] for c in (0, 1) for r in taken[c]],
            np.array([c for c in (0, 1) for _ in taken[c]], dtype=np.int64))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null and empty texts have one empty window and its score; repeated rows score
    alike; labels of unknown or repeated documents are ignored or merged (toxic
    wins); without labels of both classes every score is the same. An empty
    table gives an empty result; further input columns are ignored.
    """
    base = canonical(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    p = train(*training_sample(base, labels))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            z = logits(p, batch.column("text")).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "score"])

    return base.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op1_toxicity_gru(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
