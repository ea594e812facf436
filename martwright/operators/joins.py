"""Joins against a side whose size is checked before it is broadcast."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.session import stash

# A side with at most this many rows (counted) is broadcast to every task.
BROADCAST_ROWS = 1_000_000


BROADCAST_BYTES = 64 << 20


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a DataFrame, by one aggregate: texts and binaries by
    their length, other columns by the width of their type."""
    fixed = 8 + sum(0 if f.dataType.typeName() in ("string", "binary") else 16 for f in df.schema.fields)
    varying = [F.coalesce(F.octet_length(f.name), F.lit(0)) + 16 for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    width = sum(varying, F.lit(fixed))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return row["n"], row["b"] or 0


def join_checked(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``big.join(small)`` with ``small`` broadcast only when it is measured to
    hold at most ``max_rows`` rows and ``max_bytes`` bytes; otherwise an ordinary
    (shuffle) join that AQE may still convert at runtime."""
    rows, size = measured(small)
    if rows <= max_rows and size <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


# A key with more fact rows than this is split over several tasks.
SPLIT_ROWS = 4_000_000
_SALT = "_hk_salt"
_N = "_hk_n"


class KeyProfile:
    """Distinct values and row counts of several key columns of a fact, from
    one pass (GROUPING SETS with partial aggregation per task), stored as
    parquet in the shared checkpoint folder.

    The profile is dimension-sized (one row per distinct key value) and
    answers, without touching the fact again, which values are hot and
    whether every value exists in a dimension."""

    def __init__(self, fact: DataFrame, keys: list[str]):
        self.keys = list(keys)
        sets = fact.groupingSets([[k] for k in keys], *keys).agg(
            F.count(F.lit(1)).alias("_kp_rows"), F.grouping_id().alias("_kp_gid")
        )
        n = len(keys)
        # one value column: the key of the set each row belongs to
        value = None
        for i, k in enumerate(keys):
            gid = (1 << n) - 1 - (1 << (n - 1 - i))  # all bits set except this key's
            term = F.when(F.col("_kp_gid") == gid, F.col(k))
            value = term if value is None else value.when(F.col("_kp_gid") == gid, F.col(k))
        which = None
        for i, k in enumerate(keys):
            gid = (1 << n) - 1 - (1 << (n - 1 - i))
            which = F.when(F.col("_kp_gid") == gid, F.lit(k)) if which is None else which.when(
                F.col("_kp_gid") == gid, F.lit(k)
            )
        self.table = stash(
            sets.select(which.alias("_kp_key"), value.alias("_kp_value"), "_kp_rows"), "key-profile"
        )

    def values(self, key: str) -> DataFrame:
        return self.table.where(F.col("_kp_key") == key).select(
            F.col("_kp_value").alias("_kp_value"), "_kp_rows"
        )

    def hot(self, key: str, split_rows: int = SPLIT_ROWS) -> DataFrame | None:
        """Values of ``key`` holding more than ``split_rows`` rows with their
        piece counts, or None when there are none (at most rows / split_rows
        values can qualify)."""
        hot = self.values(key).where(F.col("_kp_rows") > split_rows).select(
            F.col("_kp_value").alias("_hk_id"),
            F.ceil(F.col("_kp_rows") / F.lit(split_rows)).cast("int").alias(_N),
        )
        return hot if hot.limit(1).count() > 0 else None

    def hot_all(self, split_rows: int = SPLIT_ROWS) -> dict[str, DataFrame | None]:
        """``hot`` for every key; one look at the profile answers the normal
        case of no hot value at all."""
        if self.table.where(F.col("_kp_rows") > split_rows).limit(1).count() == 0:
            return {k: None for k in self.keys}
        return {k: self.hot(k, split_rows) for k in self.keys}

    def presence(self, checks: dict[str, tuple[DataFrame, str]]) -> dict[str, bool]:
        """``all_present`` for several keys in one action: per key at most one
        missing value is looked for (a handful of rows reach the driver)."""
        parts = []
        for key, (dim, natural) in checks.items():
            vals = self.values(key).where(F.col("_kp_value").isNotNull()).select("_kp_value")
            missing = vals.join(dim.select(F.col(natural).alias("_kp_value")), "_kp_value", "left_anti")
            parts.append(missing.limit(1).select(F.lit(key).alias("_kp_key")))
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        missing_keys = {r[0] for r in out.collect()}
        return {key: key not in missing_keys for key in checks}

    def all_present(self, key: str, dim: DataFrame, natural: str) -> bool:
        """Every non-null value of ``key`` has a dimension row."""
        vals = self.values(key).where(F.col("_kp_value").isNotNull()).select("_kp_value")
        missing = vals.join(dim.select(F.col(natural).alias("_kp_value")), "_kp_value", "left_anti")
        return missing.limit(1).count() == 0


def hot_keys(fact: DataFrame, keys: list[str], split_rows: int = SPLIT_ROWS) -> dict[str, DataFrame | None]:
    """For each key column, the values holding more than ``split_rows`` fact
    rows and the number of pieces to split each into (None: no hot value)."""
    return KeyProfile(fact, keys).hot_all(split_rows)


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    hot: DataFrame | None,
    salt_cols: list[str],
    extra_condition=None,
) -> DataFrame:
    """Inner join ``fact`` to ``dim`` on ``fact_key == dim_key`` (plus
    ``extra_condition``), splitting hot keys: their fact rows get a salt
    ``hash(salt_cols) mod n`` and their dimension rows are repeated once per
    salt, so a key holding a third of the fact is spread over n tasks. With no
    hot keys this is the plain join."""
    if hot is None or hot.count() == 0:
        cond = F.col(fact_key) == F.col(dim_key)
        if extra_condition is not None:
            cond = cond & extra_condition
        return fact.join(dim, cond)
    # bounded by rows / split_rows, and counted just above
    hot_b = F.broadcast(hot)
    f = fact.join(hot_b, F.col(fact_key) == F.col("_hk_id"), "left").withColumn(
        _SALT,
        F.when(F.col(_N).isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.col(_N)).cast("int")
        ),
    ).drop("_hk_id", _N)
    d = dim.join(hot_b, F.col(dim_key) == F.col("_hk_id"), "left").withColumn(
        "_hk_salt_d",
        F.explode(
            F.when(F.col(_N).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col(_N) - 1))
        ),
    ).drop("_hk_id", _N)
    cond = (F.col(fact_key) == F.col(dim_key)) & (F.col(_SALT) == F.col("_hk_salt_d"))
    if extra_condition is not None:
        cond = cond & extra_condition
    return f.join(d, cond).drop(_SALT, "_hk_salt_d")


# Per dimension DataFrame (immutable, so the answer cannot change): both
# facts of a build ask the same question about the same dimension.
_ARITHMETIC: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def arithmetic_key(dim: DataFrame, natural: str, surrogate: str) -> tuple[int, int] | None:
    memo = _ARITHMETIC.setdefault(dim, {})
    if (natural, surrogate) not in memo:
        memo[(natural, surrogate)] = _arithmetic_key(dim, natural, surrogate)
    return memo[(natural, surrogate)]


def _arithmetic_key(dim: DataFrame, natural: str, surrogate: str) -> tuple[int, int] | None:
    """``(natural_min, surrogate_min)`` when every dimension row satisfies
    ``surrogate = natural - natural_min + surrogate_min`` (dense keys numbered
    in natural-key order over contiguous natural keys), else None.

    Two aggregates over the dimension; no fact data is touched."""
    lo = dim.agg(F.min(natural).alias("lo"), F.min(surrogate).alias("s_lo")).first()
    if lo is None or lo["lo"] is None:
        return None
    off = F.col(natural) - F.lit(lo["lo"]) + F.lit(lo["s_lo"])
    bad = dim.agg(
        F.count_if(F.col(natural).isNull() | F.col(surrogate).isNull() | (F.col(surrogate) != off)).alias("bad")
    ).first()["bad"]
    return (int(lo["lo"]), int(lo["s_lo"])) if bad == 0 else None


def all_keys_present(fact: DataFrame, fact_key: str, dim: DataFrame, natural: str) -> bool:
    """Every non-null fact key has a dimension row: distinct fact keys (map-side
    partial aggregation) anti-joined with the dimension, stop at the first."""
    keys = fact.select(F.col(fact_key).alias("_ap_k")).where(F.col("_ap_k").isNotNull()).distinct()
    missing = keys.join(dim.select(F.col(natural).alias("_ap_k")), "_ap_k", "left_anti")
    return missing.limit(1).count() == 0


def substitute_key(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    natural: str,
    surrogate: str,
    hot: DataFrame | None = None,
    salt_cols: list[str] | None = None,
    profile: "KeyProfile | None" = None,
    present: bool | None = None,
) -> DataFrame:
    """``fact`` with ``surrogate`` looked up by ``fact_key = dim.natural``,
    with inner-join semantics (rows without a match are dropped).

    When the surrogate is provably an offset of the natural key and every fact
    key exists in the dimension, the look-up is arithmetic: no join, so no
    shuffle of the fact. Otherwise a (hot-key-splitting) join."""
    offset = arithmetic_key(dim, natural, surrogate)
    if present is None and offset is not None:
        present = (
            profile.all_present(fact_key, dim, natural)
            if profile is not None
            else all_keys_present(fact, fact_key, dim, natural)
        )
    if offset is not None and present:
        lo, s_lo = offset
        return fact.where(F.col(fact_key).isNotNull()).withColumn(
            surrogate, (F.col(fact_key) - F.lit(lo) + F.lit(s_lo)).cast("bigint")
        )
    lookup = dim.select(F.col(natural).alias("_sk_nat"), F.col(surrogate))
    return salted_join(fact, lookup, fact_key, "_sk_nat", hot, salt_cols or [fact_key]).drop("_sk_nat")
