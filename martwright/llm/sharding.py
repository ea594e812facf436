"""Balanced label propagation: shards of equal row counts with few cut groups.

Documents of equal text are linked. A group larger than a quarter of a shard, or
than ``PART_ROWS`` rows, is first split by a hash into parts that fit. Every part
has a star of edges, kept as rows (document, part): no pair of documents is ever
listed. In each round

1. every part counts its members' shards (aggregated first, then ranked);
2. members want their part's commonest shard;
3. demand between each pair of shards is matched, plus the target's free room;
   whole parts move where a hash of (part, round) falls below the granted share.

A last step cuts the sequence (shard, position, part, document) into equal
ranges, so that row counts differ by one at most; lone documents stand at both
ends of a shard, so that the cut moves them rather than split a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.text import documents, store

SHARDS = 16
ROUNDS = 4
#: Rows of one bucket of the final order, ranked by one task, about.
BUCKET_ROWS = 100_000
#: A part of a group lies in one bucket, so it has this many rows at most: a larger
#: group is cut into parts, which may go to different shards.
PART_ROWS = 1_000_000
LAW = "rows"


def _share(*parts) -> Column:
    """A hash in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _round(nodes: DataFrame, shards: int, number: int) -> DataFrame:
    """One propagation round over (row, part, lone, shard)."""
    linked = nodes.where("NOT lone")
    votes = linked.groupBy("part", "shard").agg(F.count("*").alias("n"))
    best = (votes.groupBy("part").agg(F.max(F.struct(
        "n", F.xxhash64("part", "shard").alias("tie"), "shard")).alias("best"))
            .select("part", F.col("best.shard").alias("wish")))
    wishes = votes.join(best, "part").where("shard <> wish").groupBy("shard", "wish").agg(F.sum("n").alias("n")).collect()
    loads = {r["shard"]: r["count"] for r in nodes.groupBy("shard").count().collect()}
    room = {s: max(0, max(loads.values(), default=0) - loads.get(s, 0)) for s in range(shards)}
    asked = {(r["shard"], r["wish"]): r["n"] for r in wishes}  # at most shards ** 2 rows, as are the grants
    grants = []
    for (a, b), n in asked.items():
        inbound = sum(v for (_, t), v in asked.items() if t == b)
        granted = min(n, asked.get((b, a), 0) + room[b] * n / inbound)
        grants.append((a, b, granted / n))
    granted = nodes.sparkSession.createDataFrame(grants, "shard int, wish int, share double")
    moved = (nodes.join(best, "part", "left")
             .join(F.broadcast(granted), ["shard", "wish"], "left")
             .withColumn("shard", F.when((~F.col("lone")) & (_share("part", F.lit(number)) < F.col("share")), F.col("wish"))
                         .otherwise(F.col("shard"))))
    return moved.select("row", "part", "lone", "shard")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot,
    grown_shard (null: the law is ``rows``), group_size.

    Null texts count as empty (size 1) and are one group with the empty ones;
    repeated rows and null ids are rows like any other; ties fall by hash, then
    by the stored row key. Fewer rows than shards leave shards empty; an empty
    table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    rows = store(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(text).alias("group"),
        F.monotonically_increasing_id().alias("row")), "shard-rows")
    groups = rows.groupBy("group").agg(F.count("*").alias("group_size"))
    total = rows.count()
    fits = max(1, min(PART_ROWS, total // (4 * shards)))
    buckets = max(256, total // (shards * BUCKET_ROWS))
    nodes = (rows.join(groups, "group").select(
        "row", (F.col("group_size") == 1).alias("lone"), "group_size",
        F.xxhash64("group", F.when(F.col("group_size") > fits, F.pmod(
            F.xxhash64("row"), F.ceil(F.col("group_size") / fits))).otherwise(F.lit(0))).alias("part"),
        F.pmod(F.xxhash64("row", F.lit("start")), F.lit(shards)).cast("int").alias("shard")))
    nodes = store(nodes, "shard-nodes")
    sizes = nodes.select("row", "group_size")
    state = nodes.drop("group_size")
    for number in range(rounds):
        state = store(_round(state, shards, number), "shard-round")
    # a position in the shard: lone rows around the groups
    place = F.when(F.col("lone"), F.when(F.pmod(F.xxhash64("row", F.lit("end")), F.lit(2)) == 0, F.lit(0.0)).otherwise(F.lit(2.0))).otherwise(F.lit(1.0))
    placed = state.withColumn("place", place + _share("part") * 0.999).withColumn(
        "bucket", F.floor(F.col("place") / 3 * buckets).cast("int"))
    order = Window.partitionBy("shard", "bucket").orderBy("place", "part", "row")
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))  # a row per bucket, not per document
    before = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(
        Window.orderBy("shard", "bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = (placed.withColumn("position", F.row_number().over(order) - 1)
              .join(F.broadcast(before), ["shard", "bucket"])
              .withColumn("position", F.col("position") + F.col("before")))
    # ranges of floor or ceil(total / shards): the first `total mod shards` have one more
    low, more = divmod(total, shards)
    edge = more * (low + 1)
    shard = F.when(F.col("position") < edge, F.floor(F.col("position") / (low + 1))).otherwise(
        more + F.floor((F.col("position") - edge) / max(1, low)))
    first = F.when(F.col("shard") < more, F.col("shard") * (low + 1)).otherwise(edge + (F.col("shard") - more) * low)
    final = ranked.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("position") - first)
    return (rows.join(final.select("row", "shard", "slot"), "row").join(sizes, "row")
            .select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "group_size"))


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir))
