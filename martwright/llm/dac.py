"""Token ids as directly addressable codes.

An id is cut into bytes, the lowest first. Level k holds the k-th byte of every
id that has one; its bitmap says which ids go on to level k + 1, and a rank
directory (set bits before each block of 512) turns a position of one level
into the position in the next. Token i of a segment is read with one byte and
one bit at each level: nothing else is decoded.

A *segment* holds whole documents. Layout, little endian:

    "DACS" | levels u32 | tokens u64 | documents u64
    doc_id i64[documents] | null mask u8[documents] | end offset u64[documents]
    per level: count u64 | bytes u8[count]
               and, but for the last: bitmap u8[ceil(count / 8)] | directory u32[ceil(count / 512) + 1]

The stored table has a row per segment: ``part`` (range partition), ``segment``
(its number there), ``first_doc``, ``part_start`` (tokens before it in the
part), ``n_tokens``, ``data``. Parts and segments ascend with doc_id.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.text import canonical, documents, store, text_slices, tidy
from martwright.llm.tokens import encoder, tokenizer_json

END_ID = 2
#: Tokens after which a segment is closed (at the end of a document).
SEGMENT_TOKENS = 1 << 20
_BLOCK = 512
_HEAD = struct.Struct("<4sIQQ")
_SEGMENTS = "part int, segment int, first_doc long, part_start long, n_tokens long, data binary"
_DOCUMENTS = "part int, doc_id long, part_offset long, n_tokens long, ids_crc32 long"


def pack_segment(ids: np.ndarray, bounds: np.ndarray, doc_ids: list[int | None]) -> bytes:
    out = [np.array([0 if d is None else d for d in doc_ids], dtype="<i8").tobytes(),
           np.array([d is None for d in doc_ids], dtype="u1").tobytes(),
           bounds[1:].astype("<u8").tobytes()]
    level, rest = 0, ids.astype(np.uint32)
    while level == 0 or len(rest):
        more = rest > 0xFF
        out += [struct.pack("<Q", len(rest)), (rest & 0xFF).astype(np.uint8).tobytes()]
        level += 1
        if not more.any():
            break
        ranks = np.add.reduceat(more, np.arange(0, len(more), _BLOCK), dtype=np.int64)
        out += [np.packbits(more, bitorder="little").tobytes(), np.concatenate(([0], np.cumsum(ranks))).astype("<u4").tobytes()]
        rest = rest[more] >> 8
    return b"".join([_HEAD.pack(b"DACS", level, len(ids), len(doc_ids)), *out])


class Segment:
    """A packed segment: its documents, any token, any range of tokens."""

    def __init__(self, data: bytes):
        magic, levels, self.n_tokens, n_docs = _HEAD.unpack_from(data)
        if magic != b"DACS":
            raise ValueError("not a segment of directly addressable codes")
        at = _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            x = np.frombuffer(data, kind, count, at)
            at += x.nbytes
            return x

        ids, nulls = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if null else int(i) for i, null in zip(ids, nulls)]
        self.bounds = np.concatenate(([0], take("<u8", n_docs).astype(np.int64)))
        self.levels = []
        for k in range(levels):
            n = int(take("<u8", 1)[0])
            chunk = take("u1", n)
            last = k == levels - 1
            self.levels.append((chunk, None if last else take("u1", -(-n // 8)), None if last else take("<u4", -(-n // _BLOCK) + 1)))

    @staticmethod
    def _rank(bitmap: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Set bits before position i."""
        block = i // _BLOCK
        bits = np.unpackbits(bitmap[block * _BLOCK // 8:-(-i // 8)], bitorder="little")
        return int(directory[block]) + int(bits[:i - block * _BLOCK].sum())

    def token(self, i: int) -> int:
        value = 0
        for k, (chunk, bitmap, directory) in enumerate(self.levels):
            value |= int(chunk[i]) << (8 * k)
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(bitmap, directory, i)
        return value

    def tokens(self, a: int, b: int) -> np.ndarray:
        """Ids a to b, read from the levels' own ranges."""
        out = np.zeros(b - a, dtype=np.uint32)
        where = np.arange(b - a)
        for k, (chunk, bitmap, directory) in enumerate(self.levels):
            out[where] |= chunk[a:b].astype(np.uint32) << np.uint32(8 * k)
            if bitmap is None or a == b:
                break
            more = np.unpackbits(bitmap[a >> 3:-(-b // 8)], bitorder="little")[a & 7:(a & 7) + b - a].astype(bool)
            where = where[more]
            a = self._rank(bitmap, directory, a)
            b = a + len(where)
        return out


def write_codes(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = END_ID,
                segment_tokens: int = SEGMENT_TOKENS) -> DataFrame:
    """Encode every text and store the segments; returns the stored table.

    Documents ascend by doc_id (nulls first, repeated ids by text) over parts
    and segments; a null or empty text has just the end id; an empty table
    stores no segment. Only whole texts are encoded; a text longer than a
    segment has its own.
    """
    json_text = tokenizer_json(tokenizer_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, before = TaskContext.get().partitionId(), 0, 0
        kept: list[tuple[np.ndarray, np.ndarray, list]] = []

        def close():
            nonlocal number, before, kept
            shifts = np.cumsum([0, *(len(i) for i, _, _ in kept)])
            ids = np.concatenate([i for i, _, _ in kept])
            bounds = np.concatenate([[0], *(b[1:] + s for (_, b, _), s in zip(kept, shifts))])
            docs_here = [d for _, _, each in kept for d in each]
            row = {"part": [part], "segment": [number], "first_doc": [docs_here[0]], "part_start": [before],
                   "n_tokens": [len(ids)], "data": [pack_segment(ids, bounds, docs_here)]}
            number, before, kept = number + 1, before + len(ids), []
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([
                ("part", pa.int32()), ("segment", pa.int32()), ("first_doc", pa.int64()),
                ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())]))

        for batch in text_slices(batches):
            ids, bounds = encoder(json_text).encode(batch.column("text"), end_id)
            kept.append((ids, bounds, batch.column("doc_id").to_pylist()))
            if sum(len(i) for i, _, _ in kept) >= segment_tokens:
                yield close()
        if kept:
            yield close()

    ordered = (canonical(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    # the codes are close to incompressible, and a compressed page could not be addressed
    return store(ordered.mapInArrow(tidy(encode), _SEGMENTS), "dac", compression="none")


def read_documents(segments: DataFrame) -> DataFrame:
    """Every document of a stored table: doc_id, start, n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                segment = Segment(batch.column("data")[row].as_buffer())
                a, b = segment.bounds[:-1], segment.bounds[1:]
                crc = [zlib.crc32(segment.tokens(x, y).astype("<u4").tobytes()) for x, y in zip(a.tolist(), b.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(a), batch.column("part")[row].as_py()), pa.int32()),
                    pa.array(segment.doc_ids, pa.int64()),
                    pa.array(a + batch.column("part_start")[row].as_py(), pa.int64()),
                    pa.array(b - a, pa.int64()), pa.array(crc, pa.int64())],
                    names=["part", "doc_id", "part_offset", "n_tokens", "ids_crc32"])

    # a row per range partition: as many as the cluster's shuffle partitions, whatever the data
    parts = segments.groupBy("part").agg(F.min("first_doc").alias("first_doc"), F.sum("n_tokens").alias("total"))
    order = Window.orderBy(F.asc_nulls_first("first_doc")).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("before"))
    return (segments.select("part", "part_start", "data").mapInArrow(tidy(decode), _DOCUMENTS)
            .join(F.broadcast(starts), "part")
            .select("doc_id", (F.col("before") + F.col("part_offset")).alias("start"), "n_tokens", "ids_crc32"))


def op3_directly_addressable_codes(spark, sf_dir: str) -> DataFrame:
    return read_documents(write_codes(documents(spark, sf_dir)))
