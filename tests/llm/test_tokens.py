"""The word cache of the encoder: bounded, exact, and learning a recurring word once."""

import numpy as np
import pyarrow as pa
import pytest

from martwright.llm import tokens

WORDS = [a + b + c for a in ("ka", "lo", "mi", "ñu") for b in ("re", "st", "ou", "zé") for c in ("n", "ts", "ing", "ß", "x")]


def sliced(encoder, number=30):
    """Slices that share their common words and have words of their own, with the library's ids."""
    for k in range(number):
        texts = [" ".join(WORDS), "", None, f"own{chr(97 + k % 26)}{'q' * (k // 26)} " + " ".join(w + chr(97 + k % 26) * 3 + "!" for w in WORDS)]
        ids, bounds = encoder.encode(pa.array(texts))
        for i, text in enumerate(texts):
            assert ids[bounds[i]:bounds[i + 1]].tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def test_recurring_words_outlive_the_bound(monkeypatch):
    encoder, asked = tokens.WordEncoder(tokens.tokenizer_json(), cache_bytes=20_000), []
    plain = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: asked.extend(w for t in texts for w in t.split()) or plain(texts))
    sliced(encoder)
    assert encoder.held < 40_000
    assert max(asked.count(w) for w in WORDS) == 1


def test_equal_hashes_give_each_word_its_own_ids(monkeypatch):
    monkeypatch.setattr(tokens, "string_hashes", lambda words: np.arange(len(words)).astype(np.uint64) % np.uint64(3))
    sliced(tokens.WordEncoder(tokens.tokenizer_json(), cache_bytes=20_000))


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_hashes_do_not_depend_on_the_place(kind):
    words = pa.array(["x", *WORDS, "", "x"], kind).cast(pa.string())
    hashes = tokens.string_hashes(words)
    assert hashes[0] == hashes[-1] and len(set(hashes.tolist())) == len(WORDS) + 2
    assert tokens.string_hashes(words[5:9]).tolist() == hashes[5:9].tolist()
    assert len(tokens.string_hashes(words[:0])) == 0
    encoder = tokens.WordEncoder(tokens.tokenizer_json())
    ids, bounds = encoder.encode(pa.array(["a bé c", None], kind))
    assert ids.tolist() == encoder.tokenizer.encode("a bé c", add_special_tokens=False).ids and bounds.tolist() == [0, len(ids), len(ids)]
