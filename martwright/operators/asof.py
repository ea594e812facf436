"""Version join: each fact row picks the dimension version valid on its date.

Equality on the natural key plus ``fact_date BETWEEN start AND end`` (both
ends inclusive). Spark plans it as a hash / sort-merge join on the key with
the range as residual condition; the dimension side is pruned to the four
columns it contributes before the exchange. A key has few versions, so the
residual check costs little. A key holding very many fact rows is split
explicitly (``hot``: salted fact rows, repeated versions); AQE's skew-join
handling remains on for whatever is left.

``versioned_key`` avoids the join for ids without history (see there).
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators.joins import (
    BROADCAST_ROWS,
    KeyProfile,
    all_keys_present,
    arithmetic_key,
    salted_join,
)
from martwright.operators.overlaps import overlap_pairs
from martwright.operators.sequence import prior_value_in_key
from martwright.session import stash


def asof_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_date: str,
    dim_key: str,
    surrogate: str,
    start_col: str = "effective_start_date",
    end_col: str = "effective_end_date",
    hot: DataFrame | None = None,
    salt_cols: list[str] | None = None,
) -> DataFrame:
    """``hot`` (from ``joins.hot_keys``) lists fact keys to split over
    several tasks; their versions are repeated once per piece."""
    versions = dim.select(
        F.col(dim_key).alias("_v_id"),
        F.col(start_col).alias("_v_start"),
        F.col(end_col).alias("_v_end"),
        F.col(surrogate),
    )
    in_range = F.col(fact_date).between(F.col("_v_start"), F.col("_v_end"))
    joined = salted_join(fact, versions, fact_key, "_v_id", hot, salt_cols or [fact_key], in_range)
    return joined.drop("_v_id", "_v_start", "_v_end")


def asof_scan(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_date: str,
    dim_key: str,
    surrogate: str,
    start_col: str = "effective_start_date",
    end_col: str = "effective_end_date",
    num_partitions: int | None = None,
) -> DataFrame:
    """The rows of ``asof_join`` by one ordered scan, for versions that do not
    overlap (``overlaps.overlap_pairs`` gives none).

    Facts and version starts are laid in one order of (key, date), starts first;
    each fact takes the last version begun before it, carried over range pieces
    (``prior_value_in_key``), and stays if that version has not ended. There is no
    broadcast, no residual range condition, and a key with any number of facts or
    versions is spread over tasks. Facts without a key, a date or a version go,
    as in an inner join."""
    same = dict(fact.dtypes)[fact_key], dict(fact.dtypes)[fact_date]
    facts = fact.where(F.col(fact_key).isNotNull() & F.col(fact_date).isNotNull()).select(
        F.col(fact_key).alias("_as_id"), F.col(fact_date).alias("_as_at"), F.lit(1).alias("_as_kind"),
        F.struct(*fact.columns).alias("_as_row"))
    version = F.struct(F.col(surrogate).alias("key"), F.col(end_col).alias("last"))
    starts = dim.where(F.col(dim_key).isNotNull() & (F.col(start_col) <= F.col(end_col))).select(
        F.col(dim_key).cast(same[0]).alias("_as_id"), F.col(start_col).cast(same[1]).alias("_as_at"), F.lit(0).alias("_as_kind"),
        version.alias("_as_version"))
    line = facts.unionByName(starts, allowMissingColumns=True)
    scanned = prior_value_in_key(line, "_as_id", ["_as_at", "_as_kind"], "_as_version", "_as_found", num_partitions)
    valid = (F.col("_as_kind") == 1) & (F.col("_as_at") <= F.col("_as_found.last"))
    return scanned.where(valid).select("_as_row.*", F.col("_as_found.key").alias(surrogate))


def versioned_key(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_date: str,
    dim_key: str,
    surrogate: str,
    open_start,
    open_end,
    start_col: str = "effective_start_date",
    end_col: str = "effective_end_date",
    hot: DataFrame | None = None,
    salt_cols: list[str] | None = None,
    max_broadcast_rows: int = BROADCAST_ROWS,
    profile: KeyProfile | None = None,
    present: bool | None = None,
) -> DataFrame:
    """The version join, split by kind of history:

    * ids whose history is one open version (``open_start``..``open_end``)
      get the key by arithmetic when it is provably an offset of the id and
      every fact id exists in the dimension -- no join, no shuffle;
    * the other ids (a counted, broadcast set) take the version join against
      their own versions only (broadcast when counted small).

    Otherwise (a proof fails, the set is too big) the versions are carried along
    the facts by ``asof_scan``; only versions that overlap need the plain join,
    as a fact may then have several. Same rows as the plain version join."""

    def general():
        if overlap_pairs(dim, dim_key, surrogate, start_col, end_col).limit(1).count() == 0:
            return asof_scan(fact, dim, fact_key, fact_date, dim_key, surrogate, start_col, end_col)
        return asof_join(fact, dim, fact_key, fact_date, dim_key, surrogate, start_col, end_col, hot, salt_cols)

    split = _history_split(dim, dim_key, surrogate, start_col, end_col, open_start, open_end, max_broadcast_rows)
    if split is None:
        return general()
    complex_ids, offset, history, n_history = split
    if present is None:
        present = (
            profile.all_present(fact_key, dim, dim_key)
            if profile is not None
            else all_keys_present(fact, fact_key, dim, dim_key)
        )
    if not present:
        return general()
    lo, s_lo = offset
    ids = F.broadcast(complex_ids)  # counted in _history_split
    in_range = F.col(fact_date).between(F.lit(open_start), F.lit(open_end))
    plain = (
        fact.join(ids, F.col(fact_key) == F.col("_vk_id"), "left_anti")
        .where(F.col(fact_key).isNotNull() & in_range)
        .withColumn(surrogate, (F.col(fact_key) - F.lit(lo) + F.lit(s_lo)).cast("bigint"))
    )
    with_history = fact.join(ids, F.col(fact_key) == F.col("_vk_id"), "left_semi")
    if n_history > max_broadcast_rows:
        return general()
    versioned = asof_join(with_history, F.broadcast(history), fact_key, fact_date, dim_key, surrogate, start_col, end_col)
    return plain.unionByName(versioned)


# Per dimension DataFrame (immutable): the split of its ids by kind of
# history is the same for every fact and every micro-batch keyed against it.
_HISTORY: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def _history_split(dim, dim_key, surrogate, start_col, end_col, open_start, open_end, max_rows):
    """(ids with history, key offset of the others, their versions, version
    count), or None when the split does not apply. Computed once per
    dimension; the id set and the versions are stashed."""
    memo = _HISTORY.setdefault(dim, {})
    k = (dim_key, surrogate, start_col, end_col, open_start, open_end, max_rows)
    if k in memo:
        return memo[k]
    per_id = dim.groupBy(F.col(dim_key).alias("_vk_id")).agg(
        F.count(F.lit(1)).alias("_vk_n"),
        F.min(start_col).alias("_vk_s"),
        F.max(end_col).alias("_vk_e"),
        F.min(surrogate).alias("_vk_k"),
    )
    per_id = stash(per_id, "version-history-per-id")  # dimension-sized, read several times
    single = (F.col("_vk_n") == 1) & (F.col("_vk_s") == F.lit(open_start)) & (F.col("_vk_e") == F.lit(open_end))
    complex_ids = per_id.where(~single | F.col("_vk_id").isNull()).select("_vk_id")
    result = None
    if complex_ids.count() <= max_rows:
        offset = arithmetic_key(per_id.where(single), "_vk_id", "_vk_k")
        if offset is not None:
            history = stash(
                dim.join(F.broadcast(complex_ids), F.col(dim_key) == F.col("_vk_id"), "left_semi"),
                "version-history",
            )
            result = (complex_ids, offset, history, history.count())
    memo[k] = result
    return result
