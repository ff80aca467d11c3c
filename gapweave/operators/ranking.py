"""Exact ranks and exact smallest-k selections without a single-task sort.

Keys are md5 hex strings, so their leading digits are uniform buckets in key order.

* ``rank_cuts`` counts rows per bucket (combined on the map side), finds the bucket in
  which each wanted rank falls, and sorts only that bucket.  Its answer is the row that
  sits on the rank; everything else compares with it, so the table itself is not shuffled.
* ``rank_within`` gives every row its rank: rows are numbered inside (group, bucket) and
  the bucket's start is added.  A group that holds most of the table is spread over all
  its buckets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapweave.operators.settle import settle

WIDE = 4  # 65 536 buckets: one group, or a handful
NARROW = 2  # 256 buckets: any number of groups


def bucket_starts(df: DataFrame, groups: list[str], key: str, digits: int) -> DataFrame:
    """For every bucket of keys in a group the number of rows before it, up to its end, and of the group."""
    counts = df.groupBy(*groups, F.substring(key, 1, digits).alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    # At most 16**digits rows per group from here on, however many rows the group has.
    ordered = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*groups)
    return (
        counts.withColumn("_upto", F.sum("_n").over(ordered))
        .withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
    )


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join by columns of the same names where null equals null; the left side's columns stay."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    matches = F.lit(True)
    for c in on:
        matches = matches & F.col(c).eqNullSafe(F.col(f"_right_{c}"))
    return left.join(renamed, matches, how).drop(*[f"_right_{c}" for c in on])


def rank_within(
    df: DataFrame,
    groups: list[str],
    key: str,
    ties: list[str],
    rank: str = "rank",
    size: str | None = None,
    digits: int | None = None,
) -> DataFrame:
    """1-based rank by (key, ties) in each group; null is a group of its own."""
    digits = digits or (NARROW if groups else WIDE)
    starts = bucket_starts(df, groups, key, digits).select(*groups, "_bucket", "_before", "_total")
    by_key = Window.partitionBy(*groups, "_bucket").orderBy(key, *ties)
    numbered = df.withColumn("_bucket", F.substring(key, 1, digits)).withColumn("_rn", F.row_number().over(by_key))
    out = null_safe_join(numbered, starts, [*groups, "_bucket"]).withColumn(
        rank, F.col("_before") + F.col("_rn").cast("bigint")
    )
    if size:
        out = out.withColumn(size, F.col("_total"))
    keep = [*df.columns, rank] + ([size] if size else [])
    return out.select(*keep)


def rank_cuts(
    df: DataFrame,
    groups: list[str],
    key: str,
    ties: list[str],
    wanted: dict[str, Callable[[Column], Column]],
    quotas: DataFrame | None = None,
    digits: int | None = None,
) -> DataFrame:
    """One row per group; column ``label`` holds struct(key, ties) of the row on that rank.

    ``wanted`` maps a label to a function of the group's row count; it may also use the
    columns of ``quotas``.  A rank of 0 or below gives null, one beyond the last row gives
    the last row.  Null is a group of its own.
    """
    digits = digits or (3 if groups else WIDE)
    starts = bucket_starts(df, groups, key, digits)
    if quotas is not None:
        starts = null_safe_join(starts, quotas, groups)
    marks = starts.select(
        *groups,
        "_bucket",
        "_before",
        "_upto",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("label"),
                        F.least(fn(F.col("_total")).cast("bigint"), F.col("_total")).alias("want"),
                    )
                    for label, fn in wanted.items()
                ]
            )
        ).alias("mark"),
    ).where((F.col("_before") < F.col("mark.want")) & (F.col("mark.want") <= F.col("_upto")))

    slim = df.select(*groups, key, *ties).withColumn("_bucket", F.substring(key, 1, digits))
    edge = null_safe_join(slim, marks, [*groups, "_bucket"])
    by_key = Window.partitionBy(*groups, "_bucket", "mark.label").orderBy(key, *ties)
    on_rank = edge.withColumn("_rn", F.row_number().over(by_key)).where(
        F.col("_before") + F.col("_rn") == F.col("mark.want")
    )
    cut = F.struct(F.col(key), *[F.col(t) for t in ties])
    return on_rank.groupBy(*groups).agg(
        *[F.max(F.when(F.col("mark.label") == label, cut)).alias(label) for label in wanted]
    )


def attach_cuts(df: DataFrame, groups: list[str], cuts: DataFrame) -> DataFrame:
    if groups:
        return null_safe_join(df, cuts, groups, "left")
    one_row = cuts.select(F.struct(*cuts.columns).alias("cuts")).scalar()
    return df.withColumns({c: one_row[c] for c in cuts.columns})


def _cut_at(df: DataFrame, key: str, ties: list[str], k: int) -> DataFrame:
    # Counts and the bucket of the cut are read from a table of keys, so that ``df`` is computed once for both.
    return rank_cuts(settle(df.select(key, *ties)), [], key, ties, {"_cut": lambda total: F.lit(k)})


def keep_smallest(df: DataFrame, key: str, ties: list[str], k: int) -> DataFrame:
    """The k rows that come first by (key, ties), found without moving the table."""
    cuts = _cut_at(df, key, ties, k)
    here = F.struct(F.col(key), *[F.col(t) for t in ties])
    return attach_cuts(df, [], cuts).where(here <= F.col("_cut")).drop("_cut")


def drop_smallest(df: DataFrame, key: str, ties: list[str], k: int) -> DataFrame:
    """All rows but the k that come first by (key, ties)."""
    cuts = _cut_at(df, key, ties, k)
    here = F.struct(F.col(key), *[F.col(t) for t in ties])
    return attach_cuts(df, [], cuts).where(F.coalesce(here > F.col("_cut"), F.lit(True))).drop("_cut")


def keep_quota(
    df: DataFrame, groups: list[str], key: str, ties: list[str], quotas: DataFrame, quota: str = "quota"
) -> DataFrame:
    """In each group the ``quota`` rows that come first by (key, ties).

    ``quotas`` has one row per group, and is of bounded size: the cuts go to the rows, which stay where
    they are however many a group has.  Counts and cuts are read from a table of keys, so that ``df`` is
    computed once for both.
    """
    keys = settle(df.select(*groups, key, *ties))
    cuts = F.broadcast(rank_cuts(keys, groups, key, ties, {"_cut": lambda total: F.col(quota)}, quotas))
    here = F.struct(F.col(key), *[F.col(t) for t in ties])
    return attach_cuts(df, groups, cuts).where(here <= F.col("_cut")).select(*df.columns)
