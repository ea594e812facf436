"""Word-by-word and row-by-row versions of the network's forward pass and of a
propagation round."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martwright.llm import sharding, toxicity
from martwright.llm.text import mixed, word_hashes


def plain_logit(p, text):
    """The network on one text, a word and a state at a time."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]

    def embedded(word):
        bare = word.strip(".,;:!?\"'()[]{}*-_")
        row = int(word_hashes(pa.array([bare]))[0]) % toxicity.WORD_ROWS
        codes = [1, 1, *map(ord, bare), 1, 1]
        grams = np.zeros(toxicity.CHAR_DIM)
        for i in range(2, len(codes) - 2):
            three = (codes[i - 1] << 42) + (codes[i] << 21) + codes[i + 1]
            five = (int(mixed(np.array([three], dtype=np.uint64))[0]) + (codes[i - 2] << 21) + codes[i + 2]) % (1 << 64)
            for key in (three, five):
                grams += p["char"][int(mixed(np.array([key], dtype=np.uint64))[0]) % toxicity.CHAR_ROWS]
        return np.concatenate((p["word"][row], grams / np.sqrt(max(1, 2 * len(bare)))))

    def states(inputs, side):
        h, out, n = np.zeros(toxicity.HIDDEN), [], toxicity.HIDDEN
        for x in inputs:
            given, kept = x @ p[f"{side}_in"] + p[f"{side}_bias"], h @ p[f"{side}_state"]
            z, r = sigmoid(given[:n] + kept[:n]), sigmoid(given[n:2 * n] + kept[n:2 * n])
            new = np.tanh(given[2 * n:] + r * kept[2 * n:])
            h = z * h + (1 - z) * new
            out.append(h)
        return out

    best, start = None, 0
    while best is None or start - toxicity.STEP + toxicity.WINDOW < len(words):
        inputs = [embedded(w) for w in words[start:start + toxicity.WINDOW]]
        both = [np.concatenate(s) for s in zip(states(inputs, "ahead"), states(inputs[::-1], "back")[::-1])]
        pooled = np.zeros(2 * toxicity.HIDDEN)
        if both:
            scores = np.array([np.tanh(s @ p["attend"]) @ p["focus"] for s in both])
            weights = np.exp(scores - scores.max())
            pooled = (weights / weights.sum()) @ np.array(both)
        logit = pooled @ p["out"] + p["bias"][0]
        best = logit if best is None else max(best, logit)
        start += toxicity.STEP
    return best


def test_network_equals_a_word_by_word_pass():
    rng = np.random.default_rng(4)
    p = {k: (v + 0.3 * rng.standard_normal(v.shape)).astype(np.float32) for k, v in toxicity.new_parameters().items()}
    words = ["Bad", "word!", "(fine)", "Ünï", "...", "x", "don't", "日本語", "\U0001f600", "end."]
    texts = ["", None, "one", " \t\n", "... --"] + [" ".join(rng.choice(words, n)) for n in (2, 7, 39, 40, 41, 59, 60, 61, 200)]
    got = toxicity.logits(p, pa.array(texts, pa.string()))
    assert np.allclose(got, [plain_logit(p, t) for t in texts], atol=2e-4)


def test_a_propagation_round_equals_a_plain_one(spark):
    rng = random.Random(9)
    shards = 5
    rows, row = [], 0
    for part in range(120):
        for _ in range(rng.choice([1, 2, 3, 9, 40])):
            rows.append((row, part * 7919, rng.randrange(shards)))
            row += 1
    sizes = Counter(p for _, p, _ in rows)
    rows = [(r, p, sizes[p] == 1, s) for r, p, s in rows]
    nodes = spark.createDataFrame(rows, "row long, part long, lone boolean, shard int")
    for number in range(2):
        state = [tuple(r) for r in nodes.collect()]
        pairs = nodes.select("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("s")).distinct().select(
            "part", "s", F.xxhash64("part", "s"), sharding._share("part", F.lit(number))).collect()
        tie, share = {(r[0], r[1]): r[2] for r in pairs}, {r[0]: r[3] for r in pairs}
        votes = Counter((p, s) for _, p, lone, s in state if not lone)
        wish = {p: max((n, tie[q, s], s) for (q, s), n in votes.items() if q == p)[2] for p in {p for p, _ in votes}}
        asked = Counter()
        for (p, s), n in votes.items():
            if s != wish[p]:
                asked[s, wish[p]] += n
        loads = Counter(s for _, _, _, s in state)
        room = {s: max(loads.values()) - loads[s] for s in range(shards)}
        granted = {}
        for (a, b), n in asked.items():
            inbound = sum(v for (_, t), v in asked.items() if t == b)
            granted[a, b] = min(n, asked[b, a] + room[b] * n / inbound) / n
        want = sorted((r, p, lone, wish[p] if not lone and share[p] < granted.get((s, wish[p]), -1) else s) for r, p, lone, s in state)
        nodes = sharding._round(nodes, shards, number).select("row", "part", "lone", "shard")
        assert sorted(tuple(r) for r in nodes.collect()) == want
        assert want != sorted(state)
        # fewer parts are cut, and no shard grows beyond what it gave and had room for, about
        cut = lambda rs: sum(len({s for _, q, _, s in rs if q == p}) > 1 for p in sizes)
        assert cut(want) <= cut(state)
