"""Steps that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapweave.operators.settle import settle


def number_rows(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the row's place (from 0, without gaps) in the order given.

    Rows are range-partitioned and sorted in parallel; the written table keeps each row's place
    in its partition, so one small sum over partitions gives the global place.  Rows that tie
    get consecutive numbers in any order.  The rows are read twice (the first time for the ranges),
    so ``df`` should be cheap to read.
    """
    placed = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    )
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the sort: as few as there are tasks.
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(upto), F.lit(0)).cast("bigint").alias("_start"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + inside)
        .drop("_part", "_start", "_at")
    )


def smallest_reachable(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges ``(u, v)``: one row ``(node, root)`` per node,
    ``root`` being the smallest node that it can reach.

    Alternating large-star and small-star rounds: every round is one grouping and one join on a
    node, long chains shrink geometrically, and only one number per round comes to the driver.
    """
    edges = settle(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while True:
        large = _star(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), larger_only=True)
        small = _star(settle(large), larger_only=False)
        after = settle(small)
        changed = edges.exceptAll(after).limit(1).count() + after.exceptAll(edges).limit(1).count()
        edges = after
        if not changed:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of every node to the smallest of the neighbours and the node itself.

    The large star links the larger neighbours only, the small star the smaller ones (edges then
    go from the larger to the smaller node) and the node itself.
    """
    low = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    joined = edges.join(low, "u")
    if larger_only:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).union(
            low.select("u", F.col("low").alias("v"))
        )
    return out.where("u <> v").distinct()


def by_interval(
    df: DataFrame,
    at: str,
    intervals: DataFrame,
    low: str,
    high: str,
    row_cell: Callable[[Column], Column],
    interval_cell: Callable[[Column], Column],
) -> DataFrame:
    """Join every row to the interval with ``low <= at < high`` by an equality on cells.

    ``intervals`` must be a table of bounded size.  The two cell functions are the same rising
    map to few integers, written for the columns of either side.
    """
    spread = intervals.where(F.col(low) < F.col(high)).withColumn(
        "_cell", F.explode(F.sequence(interval_cell(F.col(low)), interval_cell(F.col(high) - 1)))
    )
    return (
        df.withColumn("_cell", row_cell(F.col(at)))
        .join(F.broadcast(spread), "_cell")
        .where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high)))
        .drop("_cell")
    )


def as_row(docs: DataFrame, *extra: Column) -> DataFrame:
    """All columns as one struct ``row``, so that no name in it can clash with those of a step."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *extra)


def row_columns(names: list[str], **changed: Column) -> list[Column]:
    """The columns of ``row`` again, some of them replaced."""
    return [(changed[c] if c in changed else F.col(f"row.`{c}`")).alias(c) for c in names]
