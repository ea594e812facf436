"""Exact encoding with a public tokenizer file, one library call per distinct word.

``word_bpe`` files drop white space and never merge across it, so a text's ids
are its words' ids in order. A word of plain letters with a tail of ASCII
punctuation is the letters' ids, then the tail's: the pre-tokenizer cuts there.
Texts that spell a special token (``<|``) are encoded whole by the library.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from martwright.llm.text import gather, mixed, words_of

#: Lower-case letters of one normal form; others go through the library word by word.
_PLAIN = r"^[a-zß-öø-ÿ]+$"
_TAILED = r"^(?P<core>[a-zß-öø-ÿ]+)(?P<tail>[!-/:-@\[-`{-~]+)$"
#: Words in one library call; each ends with an id that marks a word's end.
_JOIN = 50
#: Odd base of the words' hashes (modulo 2^64).
_BASE = 0x9E3779B97F4A7C15


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's text, read on the driver and shipped with the task."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def string_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit polynomial hash of each string's bytes, from sums of powers over all of them."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
    bounds -= bounds[0]

    def powers(base: int) -> np.ndarray:
        return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(data), base, np.uint64))))

    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * powers(_BASE)[:-1], dtype=np.uint64)))
    return mixed((sums[bounds[1:]] - sums[bounds[:-1]]) * powers(pow(_BASE, -1, 1 << 64))[bounds[:-1]])


class WordEncoder:
    """Encodes Arrow string arrays; keeps the ids of distinct words up to about
    ``cache_bytes`` (a memory bound: beyond it, words not seen again are dropped).
    The words are held in Arrow and found by sorted hashes, a slice at once, without
    a Python object for each; a word is found only if it equals the held one."""

    def __init__(self, json_text: str, cache_bytes: int = 32 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json_text)
        self.cache_bytes = cache_bytes
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for piece, i in vocabulary.items():
            self.ends[i] = piece.endswith("</w>")
        self._reset()

    def _reset(self):
        self.words = pa.array([], pa.string())
        self.flat = np.zeros(0, dtype=np.uint32)
        self.bounds = np.zeros(1, dtype=np.int64)
        self.hashes = np.zeros(0, dtype=np.uint64)  # ascending
        self.places = np.zeros(0, dtype=np.int32)  # of the words with these hashes
        self.again = np.zeros(0, dtype=bool)  # words found since the last trim

    @property
    def held(self) -> int:
        return sum(x.nbytes for x in (self.words, self.flat, self.bounds, self.hashes, self.places, self.again))

    def _trim(self):
        """Drops the words that no later slice held; all, where the others fill half the cache."""
        keep = self.again
        if self.held * int(keep.sum()) * 2 > self.cache_bytes * len(keep):
            return self._reset()
        self.words = self.words.filter(pa.array(keep))
        self.flat, self.bounds = gather(self.flat, self.bounds, np.flatnonzero(keep))
        stays = keep[self.places]
        self.hashes, self.places = self.hashes[stays], (np.cumsum(keep, dtype=np.int32) - 1)[self.places[stays]]
        self.again = np.zeros(len(self.words), dtype=bool)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of words of plain letters one after another, number for each)."""
        cuts = np.append(np.arange(0, len(words), _JOIN), len(words)).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(cuts, words), " ").to_pylist()
        flat = np.concatenate([np.array(x, dtype=np.uint32) for x in self._encode(joined)])
        stops = np.flatnonzero(self.ends[flat]) + 1
        if len(stops) != len(words) or stops[-1] != len(flat):
            raise ValueError("the tokenizer does not mark the end of each word")
        return flat, np.diff(stops, prepend=0)

    def _learn(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Adds words to the cache; their places there."""
        plain = pc.match_substring_regex(words, _PLAIN)
        letters, others = words.filter(plain), words.filter(pc.invert(plain))
        ids, lengths = [], []
        if len(letters):
            flat, each = self._ids(letters)
            ids.append(flat)
            lengths.append(each)
        if len(others):
            found = self._encode(others.to_pylist())
            ids.append(np.array([i for x in found for i in x], dtype=np.uint32))
            lengths.append(np.array([len(x) for x in found]))
        first, mask = len(self.words), plain.to_numpy(zero_copy_only=False)
        places = np.empty(len(words), dtype=np.int32)
        places[np.concatenate((np.flatnonzero(mask), np.flatnonzero(~mask)))] = np.arange(first, first + len(words))
        self.words = pa.concat_arrays([self.words, letters, others])
        self.flat = np.concatenate((self.flat, *ids))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(np.concatenate(lengths), dtype=np.int64)))
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.places = np.insert(self.places, at, places[order])
        self.again = np.append(self.again, np.zeros(len(words), dtype=bool))
        return places

    def _lookup(self, words: pa.Array) -> np.ndarray:
        """The places of distinct words in the cache; new ones are learned."""
        words = words.cast(pa.string())
        hashes = string_hashes(words)
        out = np.zeros(len(words), dtype=np.int64)
        new = np.ones(len(words), dtype=bool)
        if len(self.hashes):
            out[:] = self.places[np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)]
            new = pc.not_equal(words, self.words.take(pa.array(out))).to_numpy(zero_copy_only=False)
            self.again[out[~new]] = True
        if new.any():
            out[new] = self._learn(words.filter(pa.array(new)), hashes[new])
        return out

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, bounds of each text); null is
        empty; ``end_id`` closes every text."""
        if self.held > self.cache_bytes:
            self._trim()
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        easy = pc.if_else(pa.array(special), "", texts) if special.any() else texts
        word, distinct, bounds = words_of(pc.ascii_lower(easy))
        tailed = pc.match_substring_regex(distinct, _TAILED)
        parts = pc.extract_regex(distinct, _TAILED)
        core = pc.if_else(tailed, pc.struct_field(parts, "core"), distinct).dictionary_encode()
        tail = pc.if_else(tailed, pc.struct_field(parts, "tail"), "").dictionary_encode()
        pair = np.empty(2 * len(distinct), dtype=np.int64)
        pair[0::2] = self._lookup(core.dictionary)[core.indices.to_numpy()]
        pair[1::2] = self._lookup(tail.dictionary)[tail.indices.to_numpy()]
        unique, unique_bounds = gather(self.flat, self.bounds, pair)
        ids, word_bounds = gather(unique, unique_bounds[::2], word)
        bounds = word_bounds[bounds]
        if special.any():
            whole = dict(zip(np.flatnonzero(special), self._encode(texts.filter(pa.array(special)).to_pylist())))
            each = [np.array(whole[i], dtype=np.uint32) if i in whole else ids[a:b]
                    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:]))]
            ids, bounds = np.concatenate(each), np.concatenate(([0], np.cumsum([len(x) for x in each])))
        if end_id is not None:
            ids = np.insert(ids, bounds[1:], end_id)
            bounds = bounds + np.arange(len(bounds))
        return ids, bounds


@functools.lru_cache(maxsize=2)
def encoder(json_text: str) -> WordEncoder:
    """One encoder for each worker process, kept between its tasks."""
    return WordEncoder(json_text)
