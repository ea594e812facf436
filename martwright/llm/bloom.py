"""Bloom filters of DataFrame keys, built and tested with DataFrame functions.

A filter is cut into equal *pieces* by a hash of the key, each an array of
64-bit words. While all pieces have at most ``SENT_BITS`` bits, a test reads
them as one scalar subquery: no join and no shuffle of the rows tested.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.text import store

#: Bits of one piece, about; it bounds the row that holds a piece.
PIECE_BITS = 1 << 20
#: So many bits of a whole filter (32 MB) are read as a scalar subquery.
SENT_BITS = 1 << 28


@dataclass
class Level:
    number: int
    bits: int
    hashes: int
    pieces: int

    @staticmethod
    def sized(number: int, keys: int, rate: float, pieces: int) -> "Level":
        each = max(1, -(-keys // pieces))
        bits = max(64, math.ceil(each * math.log2(1 / rate) / math.log(2) * 1.05))
        return Level(number, -(-bits // 64) * 64, max(1, round(math.log2(1 / rate))), pieces)

    def piece(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(self.pieces)).cast("int")

    def positions(self, key: Column) -> list[Column]:
        """Bits of a key: two 31-bit hashes of (key, level), combined."""
        low = F.lit((1 << 31) - 1).cast("long")
        a = F.xxhash64(key, F.lit(2 * self.number)).bitwiseAND(low)
        b = F.xxhash64(key, F.lit(2 * self.number + 1)).bitwiseAND(low)
        return [F.pmod(a + b * F.lit(i), F.lit(self.bits)) for i in range(self.hashes)]

    def words(self, keys: DataFrame) -> DataFrame:
        """(piece, level, words) of the filter that holds ``keys`` (column key)."""
        spark = keys.sparkSession
        per_piece = self.bits // 64
        at = keys.select(self.piece(F.col("key")).alias("piece"), F.explode(F.array(*self.positions(F.col("key")))).alias("at"))
        marks = at.select("piece", F.shiftright("at", 6).cast("int").alias("word"),
                          F.expr("shiftleft(1L, cast(at % 64 as int))").alias("mark"))
        blank = spark.range(self.pieces * per_piece).select(
            F.floor(F.col("id") / per_piece).cast("int").alias("piece"), F.pmod("id", F.lit(per_piece)).cast("int").alias("word"),
            F.lit(0).cast("long").alias("mark"))
        held = marks.unionByName(blank).groupBy("piece", "word").agg(F.bit_or("mark").alias("mark"))
        # a piece's words: PIECE_BITS / 64 rows, about
        return held.groupBy("piece").agg(F.sort_array(F.collect_list(F.struct("word", "mark"))).alias("held")).select(
            "piece", F.lit(self.number).alias("level"), F.transform("held", lambda w: w["mark"]).alias("words"))

    def holds(self, key: Column, words: Column) -> Column:
        """Whether a filter of these words (of the key's piece) has all bits of the key."""
        test = F.lit(True)
        for at in reversed(self.positions(key)):
            test = (F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1) & test
        return test


def sent_words(words: DataFrame) -> Column:
    """The words of all pieces of a filter as one value, an array by piece; the caller checks the size."""
    rows = words.agg(F.sort_array(F.collect_list(F.struct("piece", "words"))).alias("all"))
    return rows.select(F.transform("all", lambda p: p["words"])).scalar()


def split_rows(rows: DataFrame, key: str, keys: DataFrame, rate: float = 0.01,
               sent_bits: int = SENT_BITS) -> tuple[DataFrame | None, DataFrame]:
    """(rows whose key is certainly not in ``keys``, the others): what the
    second part holds besides rows of ``keys`` is about ``rate`` of the first.
    The first part is never shuffled. It is None where the filter would be
    larger than ``sent_bits``. ``keys`` has a column ``key``; null keys count as
    others."""
    count = keys.count()
    pieces = max(1, math.ceil(count * math.log2(1 / rate) / math.log(2) / PIECE_BITS))
    level = Level.sized(1, max(1, count), rate, pieces)
    if level.bits * pieces > sent_bits:
        return None, rows
    words = store(level.words(keys), "filter")
    # a column of its own, so that the subquery stands in the plan once
    held = rows.select(F.struct(*rows.columns).alias("_row"), F.col(key).alias("_key")).withColumn(
        "_words", F.get(sent_words(words), level.piece(F.col("_key"))))
    maybe = F.coalesce(level.holds(F.col("_key"), F.col("_words")), F.lit(True))
    return held.where(~maybe).select("_row.*"), held.where(maybe).select("_row.*")
