"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many virtual nodes on a ring of 2^60 positions; a row belongs to the first node
clockwise of its hash.  The bound is exact: a shard takes its share of the rows and no more (the
shares differ by one row at most), dealt to its nodes in proportion to their arcs.  A full node
keeps its own first rows; the others continue clockwise to the next node with room.  So only
rows of overfull arcs leave the place that plain consistent hashing gives them.

The rows' numbers come from a parallel sort; what is decided in one place is a table of the
ring's nodes, whose size is shards x replicas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gapweave.llm.common import by_interval, number_rows
from gapweave.operators.settle import settle

REPLICAS = 64
_POSITIONS = 1 << 60
_CELLS = 4096


def ring_position(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def ring(spark: SparkSession, shards: int, replicas: int = REPLICAS) -> DataFrame:
    """The nodes clockwise: ``arc, shard, position, previous``; ``previous`` of the first is null."""
    shard = (F.col("id") % shards).cast("int")
    replica = F.floor(F.col("id") / shards)
    place = ring_position(F.concat_ws(":", F.lit("shard"), shard.cast("string"), replica.cast("string")))
    clockwise = Window.orderBy("position", "shard")
    return (
        spark.range(shards * replicas)
        .select(shard.alias("shard"), place.alias("position"))
        .withColumn("previous", F.lag("position").over(clockwise))
        .withColumn("arc", (F.row_number().over(clockwise) - 1).cast("int"))
    )


def _intervals(nodes: DataFrame) -> DataFrame:
    """Arcs as ``[low, high)``; the first node also has what lies past the last one, ``turn`` 0."""
    plain = nodes.select(
        "arc", F.lit(1).alias("turn"), F.coalesce(F.col("previous") + 1, F.lit(0)).alias("low"), (F.col("position") + 1).alias("high")
    )
    wrapped = nodes.agg((F.max("position") + 1).alias("low")).select(
        F.lit(0).alias("arc"), F.lit(0).alias("turn"), "low", F.lit(_POSITIONS).cast("bigint").alias("high")
    )
    return plain.unionByName(wrapped)


def _loads(nodes: DataFrame, counts: DataFrame, shards: int) -> DataFrame:
    """Per node: rows of its own, room, and where its surplus or spare places stand in the flow.

    One row per node of the ring, so the unpartitioned windows are of bounded size.
    """
    ring_end = Window.partitionBy()
    clockwise = Window.orderBy("arc").rowsBetween(Window.unboundedPreceding, 0)
    of_shard = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("shard").orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.sum("width").over(of_shard) / F.sum("width").over(Window.partitionBy("shard"))
    arcs = (
        nodes.join(counts, "arc", "left")
        .withColumn("own", F.coalesce("own", F.lit(0)).cast("bigint"))
        .withColumn("rows", F.sum("own").over(ring_end))
        .withColumn(
            "width",
            F.col("position") - F.coalesce("previous", F.max("position").over(ring_end) - F.lit(_POSITIONS)),
        )
        .withColumn("share", F.expr(f"rows div {shards} + if(shard < rows % {shards}, 1, 0)"))
        .withColumn("room_upto", F.floor(F.col("share") * upto).cast("bigint"))
        .withColumn("room", F.col("room_upto") - F.coalesce(F.lag("room_upto").over(Window.partitionBy("shard").orderBy("arc")), F.lit(0)))
        .withColumn("kept", F.least("own", "room"))
        .withColumn("over", F.col("own") - F.col("kept"))
        .withColumn("free", F.col("room") - F.col("kept"))
        .withColumn("first_row", F.sum("own").over(clockwise) - F.col("own"))
        .withColumn("first_slot", F.coalesce(F.sum("room").over(before), F.lit(0)))
        .withColumn("balance", F.sum(F.col("over") - F.col("free")).over(clockwise))
        # Behind the node with the least balance nothing is on its way: the flow starts there.
        .withColumn("calm", F.min(F.struct("balance", "arc")).over(ring_end)["arc"])
        .withColumn("lap", (F.col("arc") <= F.col("calm")).cast("int"))
    )
    flow = Window.orderBy("lap", "arc").rowsBetween(Window.unboundedPreceding, 0)
    return (
        arcs.withColumn("over_from", F.sum("over").over(flow) - F.col("over"))
        .withColumn("free_from", F.sum("free").over(flow) - F.col("free"))
        .withColumn("over_all", F.greatest(F.sum("over").over(ring_end), F.lit(1)))
        .select("arc", "shard", "own", "kept", "free", "first_row", "first_slot", "over_from", "free_from", "over_all")
    )


def shard_rows(docs: DataFrame, shards: int, replicas: int = REPLICAS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, home_shard, slot`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  A null text counts as
    empty (size 1, checksum 0), a null id hashes by its text alone, equal rows are
    interchangeable.  ``home_shard`` is the shard before any overflow; slots run from 0 in each
    shard.  Fewer rows than shards leave some shards empty.
    """
    spark = docs.sparkSession
    nodes = settle(ring(spark, shards, replicas))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        ring_position(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))).alias("position"),
    )
    cell = lambda c: F.floor(c / F.lit(_POSITIONS // _CELLS)).cast("int")
    placed = settle(by_interval(keyed, "position", _intervals(nodes), "low", "high", cell, cell).drop("low", "high"))
    order = [F.col(c) for c in ("arc", "turn", "position", "doc_id", "text_crc32", "size")]
    numbered = number_rows(placed, order, "number")
    counts = placed.groupBy("arc").agg(F.count(F.lit(1)).alias("own"))
    loads = settle(_loads(nodes, counts, shards))

    at_home = numbered.join(F.broadcast(loads), "arc").withColumn("rank", F.col("number") - F.col("first_row"))
    columns = ["doc_id", "size", "text_crc32", "shard", "home_shard", "slot"]
    stay = at_home.where("rank < kept").select(
        "doc_id", "size", "text_crc32", "shard", F.col("shard").alias("home_shard"), (F.col("first_slot") + F.col("rank")).alias("slot")
    )
    leave = at_home.where("rank >= kept").select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("shard").alias("home_shard"),
        (F.col("over_from") + F.col("rank") - F.col("kept")).alias("queue"),
        "over_all",
    )
    spare = loads.select(
        "shard",
        F.col("over_all").alias("places"),
        F.col("free_from").alias("low"),
        (F.col("free_from") + F.col("free")).alias("high"),
        (F.col("first_slot") + F.col("kept")).alias("first_free"),
    )
    moved = by_interval(
        leave, "queue", spare, "low", "high",
        lambda c: F.floor(c * _CELLS / F.col("over_all")).cast("int"),
        lambda c: F.floor(c * _CELLS / F.col("places")).cast("int"),
    ).withColumn("slot", F.col("first_free") + F.col("queue") - F.col("low"))
    return stay.select(*columns).unionByName(moved.select(*columns))
