"""The corpus pipeline against a plain version of its five stages, and stages on
tables whose columns have the operators' own names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pandas as pd
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_exact import brute_components

from martwright.llm import bloom, jaccard, mixing, quality, secrets, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_quality(docs):
    """Rows (doc_id, text, source, ...) that stay, without frequent lines."""
    line_key = lambda line: " ".join(WORD.findall(line.translate(LOWER)))
    holders = defaultdict(dict)
    for d in docs:
        for line in (d["text"] or "").split("\n"):
            if WORD.search(line):
                held = holders[d["source"], line_key(line)]
                held[d["text"]] = min(held.get(d["text"], d["doc_id"]), d["doc_id"])
    frequent = {k: min(v.values()) for k, v in holders.items() if len(v) > 20}
    out = []
    for d in docs:
        words = WORD.findall(d["text"] or "")
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
            continue
        left = [line for line in d["text"].split("\n")
                if not WORD.search(line) or frequent.get((d["source"], line_key(line)), d["doc_id"]) == d["doc_id"]]
        if len(WORD.findall("\n".join(left))) >= 0.3 * len(words):
            out.append({**d, "text": "\n".join(left)})
    return out


def plain_copies(docs):
    _, groups = brute_components([d["doc_id"] for d in docs], [d["text"] for d in docs])
    return [d for d, g in zip(docs, groups) if d["doc_id"] == g]


def plain_spans(text):
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 12:
            spans.append((m.start(), m.end(), m[2]))
    spans += [(m.start(), m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    wide = []
    for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text):
        shares = [n / len(m[0]) for n in Counter(m[0]).values()]
        if (re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and -sum(p * math.log2(p) for p in shares) >= 3.5
                and not any(a < m.end() and m.start() < b for a, b, _ in spans)):
            wide.append((m.start(), m.end(), m[0]))
    return spans, wide


def plain_masks(docs):
    owners, repositories = defaultdict(set), defaultdict(set)
    for d in docs:
        base, wide = plain_spans(d["text"])
        for _, _, value in base + wide:
            owners[value].add(d["source"])
            repositories[value].add((d["source"], d["lang"]))
    out = []
    for d in docs:
        base, wide = plain_spans(d["text"])
        live = [w for w in wide if len(owners[w[2]]) <= 2 and len(repositories[w[2]]) <= 4]
        parts, at = [], 0
        for start, end, _ in sorted(base + live):
            if start >= at:  # spans that overlap are one mask
                parts.append(d["text"][at:start] + "<secret>")
            at = max(at, end)
        out.append({**d, "text": "".join(parts) + d["text"][at:]})
    return out


def plain_mix(docs):
    mass = Counter()
    for d in docs:
        mass[d["source"]] += len(d["text"])
    whole, roots = sum(mass.values()), sum(math.sqrt(m) for m in mass.values())
    out = []
    for d in docs:
        rate = math.sqrt(mass[d["source"]]) / roots * whole / mass[d["source"]]
        draws = max(1, math.ceil(rate / mixing.MEAN))
        for j in range(draws):
            u = int(hashlib.md5(f"{mixing.SEED}:{d['doc_id']}:{j}".encode()).hexdigest()[:13], 16) / 2 ** 52
            p = c = math.exp(-rate / draws)
            k = 0
            while c <= u:
                k += 1
                p *= rate / draws / k
                c += p
            out += [d] * k
    return out


def planted_documents():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(3, 8)))
    table = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    docs = [dict(zip(COLUMNS, r)) for r in table[COLUMNS].itertuples(index=False)]
    for i in range(140):
        lines = [" ".join(word() for _ in range(12)) for _ in range(6)]
        if i % 4 == 0:
            lines.insert(rng.randint(0, 5), "Subscribe to our  NEWSLETTER today" if i % 8 else "subscribe to our newsletter today")
        if i % 5 == 0:
            lines.append(f"api_key = '{hashlib.md5(str(i % 20).encode()).hexdigest()}' then AKIA{'ABCDEFGH1234567' + str(i)} end")
        if i % 6 == 0:
            lines.append(f"build Zx9{hashlib.sha1(str(i % 9).encode()).hexdigest().upper()[:24]}qQ done")
        text = "\n".join(lines)
        docs.append({"doc_id": 10_000 + i, "text": text, "lang": "en", "source": f"s{i % 3}"})
        if i % 7 == 0:  # a near copy and an exact one
            docs.append({"doc_id": 20_000 + i, "text": text + " tail", "lang": "en", "source": f"s{i % 2}"})
            docs.append({"doc_id": 30_000 + i, "text": text, "lang": "de", "source": "s0"})
    docs += [{"doc_id": 40_000, "text": None, "lang": None, "source": None}, {"doc_id": 40_001, "text": "", "lang": "en", "source": "s0"}]
    return [{**d, "n_chars": len(d["text"] or "")} for d in docs]


def test_run_equals_the_plain_stages(spark, tmp_out):
    docs = planted_documents()
    spark.createDataFrame([tuple(d[c] for c in COLUMNS) for d in docs], SCHEMA).repartition(5).write.parquet(f"{tmp_out}/documents.parquet")
    got = corpus_pipeline.run(spark, tmp_out).toPandas().sort_values(["sequence_id", "offset"])
    stages = [docs]
    for stage in (plain_quality, plain_copies, plain_masks, plain_mix):
        stages.append(stage(stages[-1]))
    assert len(stages[0]) > len(stages[1]) > len(stages[2]) == len(stages[3])
    assert sum("<secret>" in d["text"] for d in stages[3]) > 20
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokens.tokenizer_json())
    want = Counter()
    for d in stages[-1]:
        ids = np.array(library.encode(d["text"], add_special_tokens=False).ids + [2], dtype="<u4")
        for s in range(0, len(ids), 4096):
            part = ids[s:s + 4096]
            want[d["doc_id"], s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter(got[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False, name=None)) == want
    total = got.groupby("sequence_id").length.sum()
    assert total.max() <= 4096 and total.index.tolist() == list(range(len(total)))
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()


#: Every name that the stages make beside the input's columns.
INTERNAL = ["_row", "_id", "_key", "_row_key", "_removed_at", "_hidden", "_text", "_words", "key", "kept", "row_key", "removed_at", "hidden",
            "host", "content", "component", "class", "first", "rows", "_salt", "_piece", "n", "row", "text_", "lines", "line", "_ROW"]


@pytest.mark.parametrize("sent_bits", [bloom.SENT_BITS, 0])
def test_internal_names_neither_clash_nor_change(spark, monkeypatch, sent_bits):
    monkeypatch.setattr(bloom.split_rows, "__defaults__", (0.01, sent_bits))  # 0: every row is joined
    docs = planted_documents()
    names = [c for c in INTERNAL if c != "_ROW"]
    df = spark.createDataFrame([tuple(d[c] for c in COLUMNS) for d in docs], SCHEMA).select(
        "*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c) for c in names])
    plain = {quality.filter_quality: plain_quality, jaccard.drop_near_duplicates: plain_copies, secrets.mask_secrets: None}
    for stage, plain_stage in plain.items():
        out = stage(df)
        assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
        got = {r["doc_id"]: r for r in out.collect()}
        assert all(r[c] == f"{c}:{d}" for d, r in got.items() for c in names)
        if plain_stage:
            want = {d["doc_id"]: d["text"] for d in plain_stage(docs if stage is quality.filter_quality else [{**d, "text": d["text"] or ""} for d in docs])}
            if stage is jaccard.drop_near_duplicates:
                want[40_000] = None
            assert {d: r["text"] for d, r in got.items()} == want
        else:
            assert got[40_000]["text"] is None and len(got) == len(docs)  # a null text stays null


def test_rows_are_split_by_their_keys(spark):
    rows = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("_key"))
    keys = spark.range(0, 5000, 50).select(F.col("id").alias("key"))
    sure, maybe = bloom.split_rows(rows, "k", keys)
    held = {r["k"] for r in maybe.collect()}
    assert held >= set(range(0, 5000, 50)) and len(held) < 400
    assert {r["k"] for r in sure.collect()} == set(range(5000)) - held and sure.columns == ["k", "_key"]
    assert bloom.split_rows(rows, "k", keys.limit(0))[1].count() == 0
    assert bloom.split_rows(rows, "k", keys, sent_bits=0)[0] is None
