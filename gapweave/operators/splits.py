"""Train / eval / test assignment as one ``split`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapweave.functions.keys import key_fraction, shuffle_key
from gapweave.operators.ranking import attach_cuts, rank_cuts, rank_within
from gapweave.params import SplitParams

SPLITS = ["train", "eval", "test"]


def _floor_share(n: Column, share: float) -> Column:
    return F.floor(n.cast("double") * F.lit(share))


def split_exact(df: DataFrame, ids: list[str], params: SplitParams = SplitParams()) -> DataFrame:
    """Seeded shuffle cut at exact counts; the rows themselves are not shuffled."""
    keyed = df.withColumn("_key", shuffle_key("split", params.rng_seed, *[F.col(c) for c in ids]))
    cuts = rank_cuts(
        keyed,
        [],
        "_key",
        ids,
        {
            "_train_end": lambda n: _floor_share(n, params.train_ratio),
            "_eval_end": lambda n: _floor_share(n, params.train_ratio + params.eval_ratio),
        },
    )
    here = F.struct(F.col("_key"), *[F.col(c) for c in ids])
    return (
        attach_cuts(keyed, [], cuts)
        .withColumn(
            "split",
            F.when(here <= F.col("_train_end"), "train").when(here <= F.col("_eval_end"), "eval").otherwise("test"),
        )
        .drop("_key", "_train_end", "_eval_end")
    )


def split_by_threshold(df: DataFrame, ids: list[str], params: SplitParams = SplitParams()) -> DataFrame:
    """Stateless split by key value: shares are expected, not exact.  Works on streams."""
    u = key_fraction(shuffle_key("split", params.rng_seed, *[F.col(c) for c in ids]))
    return df.withColumn(
        "split",
        F.when(u < params.train_ratio, "train")
        .when(u < params.train_ratio + params.eval_ratio, "eval")
        .otherwise("test"),
    )


def split_stratified(df: DataFrame, category: str, ids: list[str], params: SplitParams = SplitParams()) -> DataFrame:
    """Exact shares inside every category; ``ord`` is the shuffled order in the category."""
    keyed = df.withColumn("_key", shuffle_key("strata", params.rng_seed, *[F.col(c) for c in ids]))
    ranked = rank_within(keyed, [category], "_key", ids, rank="ord", size="_n")
    train_end = _floor_share(F.col("_n"), params.train_ratio)
    eval_end = train_end + _floor_share(F.col("_n"), params.eval_ratio)
    return ranked.withColumn(
        "split",
        F.when(F.col("ord") <= train_end, "train").when(F.col("ord") <= eval_end, "eval").otherwise("test"),
    ).drop("_key", "_n")


def category_counts(df: DataFrame, category: str) -> DataFrame:
    """Rows per category and split, with the total."""
    return (
        df.groupBy(category)
        .pivot("split", SPLITS)
        .agg(F.count(F.lit(1)))
        .select(
            category,
            *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in SPLITS],
        )
        .withColumn("total", F.col("train") + F.col("eval") + F.col("test"))
    )


def split_sizes(df: DataFrame) -> DataFrame:
    """Row count of each of the three splits, zero where a split is empty."""
    names = df.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    counts = df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(names).join(counts, "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n"))


def split_size_table(df: DataFrame, column: str) -> DataFrame:
    """Rows by ``column`` and split, by each alone, and of all, from one aggregation over grouping sets.

    ``level`` says which columns a row sums over (``"column, split"``, ``"column"``, ``"split"`` or
    ``"all"``), so that a null of the data is told apart from a sum over all values.  Shares are of
    the rows of the level above: of the split's rows, or of all.
    """
    summed = df.cube(column, "split").agg(
        F.count(F.lit(1)).alias("n"), F.grouping(column).alias("_any"), F.grouping("split").alias("_every")
    )
    level = (
        F.when((F.col("_any") == 0) & (F.col("_every") == 0), "column, split")
        .when(F.col("_every") == 1, F.when(F.col("_any") == 1, "all").otherwise("column"))
        .otherwise("split")
    )
    # One row per value and split: a table as small as the split report.
    whole = F.max(F.when(F.col("_any") == 1, F.col("n"))).over(Window.partitionBy("split", "_every"))
    everything = F.max(F.when((F.col("_any") == 1) & (F.col("_every") == 1), F.col("n"))).over(Window.partitionBy(F.lit(1)))
    share = F.col("n") / F.when(F.col("_any") == 0, whole).otherwise(everything)
    return summed.withColumn("share", share).select(level.alias("level"), column, "split", "n", "share")
