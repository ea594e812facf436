"""URL filter by a Bloom filter cascade (DataFrame functions only).

A cascade is an exact membership test for a *closed* universe: the keys that the
corpus itself holds. Level 1 is a Bloom filter of the listed keys. The keys of
the universe that pass it although they are not listed are its false positives;
level 2 is a filter of those; level 3 holds the listed keys that level 2 lets
through by mistake, and so on, until a level has no false positive. A key is
listed when the first level that it misses has an even number.

Level 1 is as selective as the listed share of the universe asks for, so few of
the other keys are ever shuffled; later levels are small. Every level is cut
into equal *pieces* by a hash of the key, each an array of 64-bit words.

The test needs no join: the words of all pieces, while they have at most
``SENT_BITS`` bits, are read as scalar subqueries. A larger cascade is dealt out
by piece, with salted rows, so that a url of any frequency is spread.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.bloom import PIECE_BITS, SENT_BITS, Level, sent_words
from martwright.llm.text import store

#: Fixed values: (action, rule). A rule is a host and the start of a path.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
#: Labels of hosts whose pages make the query's list of keys.
LISTED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]

#: Rows of one piece are dealt over so many tasks when pieces are joined.
SALTS = 32
#: False-positive rate of the levels after the first.
LATER_RATE = 1 / 16
MAX_LEVELS = 64


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first ``://`` up to ``/``, ``?``, ``#``
    or the end, A-Z lower-cased; the path from there up to ``?``, ``#`` or the
    end. Null, or no ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits (equal lengths: the first in
    code-point order), nulls where none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        action = F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


class Cascade:
    """Levels and their stored words: (piece, level, words), one row per piece and level."""

    def __init__(self, levels: list[Level], words: list[DataFrame], sent_bits: int = SENT_BITS):
        self.levels, self.words, self.sent_bits = levels, words, sent_bits

    @property
    def bits(self) -> int:
        return sum(level.bits * level.pieces for level in self.levels)

    def _verdict(self, key: Column, words: list[Column]) -> Column:
        """Listed or not, by the first level that the key misses."""
        listed = F.lit(len(self.levels) % 2 == 1)
        for level, held in reversed(list(zip(self.levels, words))):
            listed = F.when(level.holds(key, held), listed).otherwise(F.lit(level.number % 2 == 0))
        return listed

    def mark(self, rows: DataFrame, key: str, name: str) -> DataFrame:
        """``rows`` with a boolean column ``name``: whether the key (not null) is listed."""
        if not self.levels:
            return rows.withColumn(name, F.lit(False))
        packed = rows.select(F.struct(*rows.columns).alias("_row"), F.col(key).alias("_key")).withColumn("_piece", self.levels[0].piece(F.col("_key")))
        verdict = self._verdict(F.col("_key"), [F.col(f"_words_{level.number}") for level in self.levels])
        if self.bits <= self.sent_bits:
            # columns of their own, so that each subquery stands in the plan once
            held = packed.select("*", *[F.get(sent_words(words), F.col("_piece")).alias(f"_words_{level.number}")
                                            for level, words in zip(self.levels, self.words)])
            return held.select("_row.*", verdict.alias(name))
        spread = None
        for level, words in zip(self.levels, self.words):
            part = words.select(F.col("piece").alias("_piece"), F.col("words").alias(f"_words_{level.number}"))
            spread = part if spread is None else spread.join(part, "_piece")
        spread = spread.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = packed.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int"))
        return dealt.join(spread, ["_piece", "_salt"]).select("_row.*", verdict.alias(name))


def build_cascade(universe: DataFrame, listed: DataFrame, piece_bits: int = PIECE_BITS, sent_bits: int = SENT_BITS) -> Cascade:
    """The cascade that tells the keys of ``listed`` from all others of
    ``universe`` (each a column ``key``; repeated keys count once, nulls are
    ignored, listed keys outside the universe are encoded too). An empty list
    gives a cascade without levels."""
    listed = store(listed.where("key IS NOT NULL").select("key").distinct(), "listed-keys")
    keys = listed.count()
    if not keys:
        return Cascade([], [], sent_bits)
    universe = universe.where("key IS NOT NULL").select("key")
    others = max(1, universe.agg(F.approx_count_distinct("key")).first()[0] - keys)  # for the size of level 1 only
    rate = min(0.5, max(2.0 ** -24, math.sqrt(0.5) * keys / others))
    pieces = max(1, math.ceil(keys * math.log2(1 / rate) / math.log(2) / piece_bits))
    levels, words = [], []
    inside, outside, count = listed, None, keys
    while count:
        if len(levels) == MAX_LEVELS:
            raise RuntimeError(f"the cascade did not end in {MAX_LEVELS} levels")
        level = Level.sized(len(levels) + 1, count, rate if not levels else LATER_RATE, pieces)
        levels.append(level)
        words.append(store(level.words(inside), "cascade-level"))
        now = Cascade([level], [words[-1]], sent_bits)
        if outside is None:
            # the pass over the whole universe shuffles only what passes the filter
            passed = now.mark(universe, "key", "held").where("held").select("key", F.lit(0).alias("listed"))
            mixed = passed.unionByName(listed.select("key", F.lit(1).alias("listed")))
            wrong = mixed.groupBy("key").agg(F.max("listed").alias("listed")).where("listed = 0").select("key")
        else:
            wrong = now.mark(outside, "key", "held").where("held").select("key")
        wrong = store(wrong, "cascade-wrong")
        inside, outside, count = wrong, inside, wrong.count()
    return Cascade(levels, words, sent_bits)


def page_keys(pages: DataFrame) -> DataFrame:
    """page_id, host, path, key (host and path)."""
    host, path = split_url(F.col("url"))
    return (pages.select("page_id", host.alias("host"), path.alias("path"))
            .withColumn("key", F.concat("host", "path")))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str]] | None = None,
                piece_bits: int = PIECE_BITS, sent_bits: int = SENT_BITS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, listed.

    The longest rule that fits decides; without one, a listed key (host and
    path) is blocked, all else allowed. Null urls and urls without ``://`` have
    empty host, path and key; repeated rows share a verdict; rows without
    page_id are judged like others; an empty table gives an empty result; other
    input columns are ignored.
    """
    keyed = page_keys(pages)
    cascade = build_cascade(keyed.select("key"), listed, piece_bits, sent_bits)
    rule, action = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    return cascade.mark(keyed, "key", "listed").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(action, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")


def listed_pages(pages: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """The keys of pages whose host has a listed label: stands in for a list from outside."""
    names = F.array(*[F.lit(x) for x in (LISTED_LABELS if labels is None else labels)])
    return page_keys(pages).where(F.arrays_overlap(F.split("host", r"\."), names)).select("key")


def op13_url_filters(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return filter_urls(pages, listed_pages(pages))


def _sql_rules() -> str:
    rows = ", ".join(f"('{act}', '{text}', '{text.partition('/')[0]}', '/{text.partition('/')[2]}')" for act, text in RULES)
    return f"(VALUES {rows}) AS r(action, rule, name, start)"


_SQL_LABELS = ", ".join(f"'{x}'" for x in LISTED_LABELS)
ORACLE = f"""
WITH rest AS (
  SELECT row_number() OVER () AS i, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (
  SELECT i, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
listed AS (SELECT DISTINCT host || path AS key FROM cut WHERE list_has_any(string_split(host, '.'), [{_SQL_LABELS}])),
fit AS (
  SELECT i, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
  FROM cut, {_sql_rules()} WHERE (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY i)
SELECT page_id, host, path, rule,
  coalesce(action, CASE WHEN host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END) AS verdict,
  host || path IN (SELECT key FROM listed) AS listed
FROM cut LEFT JOIN fit USING (i)
"""
