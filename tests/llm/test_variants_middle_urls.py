"""Spelling variants, fill-in-middle and the URL filter against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martwright.llm import fim, spelling, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["word", "n", "form", "near", "h1", "root", "host", "path", "key", "_row", "_key", "_piece", "_salt", "listed", "output", "gram"]


def with_clashes(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in df.columns])


def rows(df):
    return [tuple(r) for r in df.collect()]


# spelling variants


def plain_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(docs):
    n = plain_words(docs)
    near = {w: [v for v in n if v != w and one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda v: (-n[v], v))
            if n[best] >= 2 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def spelled_documents():
    rng = random.Random(5)
    stems = ["matter", "aaaaaa", "aaaaaaa", "letters", "écoles", "Ärger", "banana", "street", "wörter"]
    docs = []
    for i in range(300):
        words = []
        for _ in range(40):
            w = rng.choice(stems)
            if rng.random() < 0.4:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("aeté×") + w[at:], w[:at] + rng.choice("aetö") + w[at + 1:]])
            words.append(w if rng.random() < 0.9 else w.upper())
        docs.append((i, rng.choice([" ", "-", "1", "\n"]).join(words)))
    return docs + [(None, "matter matter banana"), (7, None), (8, ""), (7, None), (9, "street " * 5), (9, "street " * 5)]


@pytest.mark.parametrize("frequent", [3, 32, 10_000])
def test_variants_equal_all_pairs(spark, frequent):
    docs = spelled_documents()
    df = with_clashes(spark.createDataFrame([(i, t, "en", "a", 0) for i, t in docs], DOCS))
    got = spelling.group_variants(df, frequent=frequent, share=0.0)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(rows(got), key=str) == plain_variants(docs)
    assert rows(spelling.group_variants(df.limit(0))) == []


def test_bounds_hold_for_every_edit():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 12))) for _ in range(300)]
    grams = Counter(f"^{w}$"[p:p + k] for w in words for k in range(2, 6) for p in range(len(w) + 3 - k))
    for frequent in (2, 20, 200):
        dictionary = {g: n for g, n in grams.items() if n > frequent}
        for w in words[:60]:
            own = spelling.decompose(w, dictionary)
            need = len(own) - spelling.affected(own)
            assert need >= 1
            for at in range(len(w) + 1):
                edits = [w[:at] + c + w[at:] for c in "abcé"]
                if at < len(w):
                    edits += [w[:at] + w[at + 1:]] + [w[:at] + c + w[at + 1:] for c in "abcé"]
                for edited in edits:
                    shared = Counter(own) & Counter(spelling.decompose(edited, dictionary))
                    assert sum(shared.values()) >= need


def test_long_text_counts_like_a_short_one(spark):
    text = "Matter " * 200_000 + "banana"
    got = dict(rows(spelling.word_counts(spark.createDataFrame([(3, text, "", "", 0), (4, "banana banana", "", "", 0)], DOCS))))
    assert got == plain_words([(3, text), (4, "banana banana")])


# fill in the middle


def plain_middle(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, len(units), "plain", None, None, text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return (doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def middle_documents():
    rng = random.Random(1)
    texts = ["", None, "a", "é", "word", "  \n\t", "two words", "<P> marker", "a <M", "<S", "P>x<", "x\U0001f600y\r\nz", "kein Maß ÄÖ", "\x00nul", "long " * 40_000]
    docs = [(i, texts[i % len(texts)]) for i in range(4 * len(texts))]
    docs += [(1000 + i, "".join(rng.choice(["ab", "c", " ", "é", "<", "P>", "\n", "9"]) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    return docs + [(None, "no id here"), (5, "twice given"), (5, "twice given")]


def test_middle_equals_plain_cutting(spark):
    docs = middle_documents()
    df = with_clashes(spark.createDataFrame([(i, t, "en", "a", 0) for i, t in docs], DOCS))
    out = fim.fill_in_middle(df)
    want = sorted((plain_middle(i, t) for i, t in docs), key=str)
    assert sorted(rows(out), key=str) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    back = out.select("doc_id", fim.restored(F.col("output"), F.col("form")))
    assert sorted(rows(back), key=str) == sorted(((i, t or "") for i, t in docs), key=str)
    assert rows(fim.fill_in_middle(df.limit(0))) == []


def test_every_rank_of_a_skip_list():
    texts = ["", "one", "Ünits: a, b; c" * 50, "x", "words and more words " * 30]
    lists = fim.SkipLists(pa.array(texts))
    assert len(lists.lanes) > 2
    units = [re.findall("[A-Za-z]+|[^A-Za-z]", t) for t in texts]
    assert lists.units.tolist() == [len(u) for u in units]
    for share in np.linspace(0, 1, 23):
        ranks = np.array([int(share * len(u)) for u in units])
        assert lists.chars_at(ranks).tolist() == [len("".join(u[:r])) for u, r in zip(units, ranks)]


# URL filter

URLS = [
    "http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x#y", "http://example.org/en/2", "http://org/x", "http://notorg/x", "http://a.org",
    "http://x.com/fr/1", "http://x.com/de/1#f", "http://com/de/", "http://spam.net/page", "http://spam.net/page?again", "http://ok.net/page",
    "ftp://h.net?q/a", "http://h.net#/a", "no scheme", "", None, "a://b.net/c://d", "http://", "http://ü.net/pfad/ä", "http://spam.net/page",
]


def plain_urls(pages, listed):
    out = []
    for page_id, url in pages:
        rest = (url or "").partition("://")[2]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        best = None
        for action, rule in urls.RULES:
            name, _, start = rule.partition("/")
            if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[1])):
                best = (action, rule)
        inside = host + path in listed
        out.append((page_id, host, path, best and best[1], best[0] if best else "block" if inside else "allow", inside))
    return sorted(out, key=str)


@pytest.mark.parametrize("piece_bits,sent_bits", [(urls.PIECE_BITS, urls.SENT_BITS), (256, urls.SENT_BITS), (256, 0)])
def test_urls_equal_plain_lists(spark, piece_bits, sent_bits):
    many = [f"http://h{i % 50}.net/p/{i}" for i in range(1500)]
    pages = list(enumerate(URLS + many)) + [(None, "http://spam.net/page")] + [(9000 + i, many[3]) for i in range(700)]
    listed = ["spam.net/page", None, "spam.net/page", "never/seen"] + [u[7:] for u in many[::7]]
    df = with_clashes(spark.createDataFrame([(i, u, "<p>") for i, u in pages], "page_id long, url string, html string"))
    keys = spark.createDataFrame([(k,) for k in listed], "key string")
    got = urls.filter_urls(df, keys, piece_bits=piece_bits, sent_bits=sent_bits)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "listed"]
    assert sorted(rows(got), key=str) == plain_urls(pages, set(listed))
    assert rows(urls.filter_urls(df.limit(0), keys)) == []
    assert not any(r[-1] for r in rows(urls.filter_urls(df, keys.limit(0))))


def test_all_keys_listed(spark):
    df = spark.createDataFrame([(i, f"http://a.net/{i % 5}", "") for i in range(20)], "page_id long, url string, html string")
    keys = urls.page_keys(df).select("key")
    assert all(r[-1] for r in rows(urls.filter_urls(df, keys)))
