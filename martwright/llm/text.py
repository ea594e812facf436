"""Shared helpers of the text operators: bounded Arrow slices, the word rule,
segment gathers, and small DataFrame conventions.

A *word* is a maximal run of characters other than space and TAB..CR
(``[^\\x20\\x09-\\x0D]+``); Arrow's ASCII white-space split is exactly that.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.session import scratch_path, ship_package

#: Text bytes handled at once inside a Python task; bounds its memory, not its results.
SLICE_BYTES = 1 << 20

#: The words of a text, as a Spark SQL regular expression.
WORD_SEPARATORS = r"[ \t-\r]+"


def documents(spark, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def canonical(docs: DataFrame, *extra: str) -> DataFrame:
    """Only the columns an operator reads, with null texts as empty ones, so
    that further input columns can never clash with those it makes."""
    ship_package(docs.sparkSession)
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *extra)


def packed(docs: DataFrame) -> DataFrame:
    """The input's rows as one struct ``_row``: whatever its columns are called,
    none can clash with those made beside it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def unpacked(rows: DataFrame, text: Column) -> DataFrame:
    """The rows of ``packed`` with another text, in the input's columns."""
    return with_length(rows.select(F.col("_row").withField("text", text).alias("_row")).select("_row.*"))


def store(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write below the shared checkpoint folder and read back: the cut of the
    lineage survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, made to follow the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut record batches into slices of about ``SLICE_BYTES`` of text (one
    row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def _give_back():
    """Unused memory of this worker to the system: a worker outlives its task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task for ``mapInArrow`` that leaves no memory with its worker when it ends."""

    @functools.wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            _give_back()

    return run


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(index of each word in the distinct words, the distinct words, word
    bounds of each text). Null texts have no words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    encoded = lists.flatten().dictionary_encode()
    index = encoded.indices.to_numpy().astype(np.int64)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    bounds = bounds - bounds[0]
    blank = pc.index(encoded.dictionary, "").as_py()
    if blank >= 0:
        keep = index != blank
        bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
        index = index[keep]
    return index, encoded.dictionary, bounds


def gather(flat: np.ndarray, bounds: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the segments ``flat[bounds[i]:bounds[i + 1]]`` for i in index."""
    lengths = bounds[index + 1] - bounds[index]
    out = np.concatenate(([0], np.cumsum(lengths)))
    at = np.arange(out[-1]) + np.repeat(bounds[index] - out[:-1], lengths)
    return flat[at], out


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each distinct word, the same in every process."""
    import pandas as pd

    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def as_binary(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Arrow binary array whose items are the segments' bytes."""
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1,
        [None, pa.py_buffer((bounds * flat.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))],
    )
