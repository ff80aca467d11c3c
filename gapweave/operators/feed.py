"""Training feed: shuffled order, resume point, padded batches, step plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapweave.functions.keys import shuffle_key
from gapweave.functions.tokens import ones, pad_left, pad_right
from gapweave.operators.ranking import WIDE, bucket_starts, drop_smallest, rank_within
from gapweave.operators.settle import settle
from gapweave.params import FeedParams


def feed_keys(examples: DataFrame, ids: list[str], seed: int) -> DataFrame:
    return examples.withColumn("feed_key", shuffle_key("feed", seed, *[F.col(c) for c in ids]))


def feed_order(examples: DataFrame, ids: list[str], params: FeedParams = FeedParams()) -> DataFrame:
    """Position of every example in one full seeded shuffle, starting at 1."""
    return rank_within(feed_keys(examples, ids, params.dataset_shuffle_seed), [], "feed_key", ids, rank="position")


def rows_to_skip(global_step: int, params: FeedParams) -> int:
    return global_step * params.effective_batch


def resume(examples: DataFrame, ids: list[str], skip: int, params: FeedParams = FeedParams()) -> DataFrame:
    """The feed after its first ``skip`` rows."""
    return drop_smallest(feed_keys(examples, ids, params.dataset_shuffle_seed), "feed_key", ids, skip)


def feed_batches(
    examples: DataFrame,
    ids: list[str],
    batch_size: int,
    ids_column: str = "input_ids",
    params: FeedParams = FeedParams(),
    length: Column | None = None,
) -> DataFrame:
    """The examples in feed order with ``position``, ``batch_no`` and ``batch_length``, by one shuffle of their arrays.

    Rows are dealt by the bucket of their key.  A bucket's first position is known from counts, so all
    rows of a batch stand in one bucket, but for the batches on a border of two or more; the longest row
    of those comes from the keys and lengths alone.  There are no more of them than buckets.  The examples
    are written once, as keys are counted before rows are dealt.  ``length`` is the size of the arrays,
    where it is known without building them: the examples then need not have them yet.
    """
    length = F.size(ids_column) if length is None else length
    keyed = feed_keys(examples, ids, params.dataset_shuffle_seed).withColumn("_bucket", F.substring("feed_key", 1, WIDE))
    keyed = settle(keyed.withColumn("_n", length))
    slim = keyed.select("feed_key", "_bucket", *ids, "_n")
    # 65 536 rows at most, as there are buckets.
    starts = F.broadcast(bucket_starts(slim, [], "feed_key", WIDE).select("_bucket", "_before"))

    def placed(rows: DataFrame) -> DataFrame:
        in_bucket = F.row_number().over(Window.partitionBy("_bucket").orderBy("feed_key", *ids)).cast("bigint")
        numbered = rows.withColumn("_rn", in_bucket).join(starts, "_bucket")
        position = F.col("_before") + F.col("_rn")
        return numbered.withColumn("position", position).withColumn(
            "batch_no", F.floor((F.col("position") - 1) / batch_size).cast("bigint")
        )

    border = (
        placed(slim)
        .groupBy("batch_no")
        .agg(F.max("_n").alias("_longest"), F.min("_bucket").alias("_low"), F.max("_bucket").alias("_high"))
        .where("_low < _high")
        .select("batch_no", "_longest")
    )
    longest = F.max("_n").over(Window.partitionBy("_bucket", "batch_no"))
    return (
        placed(keyed)
        .withColumn("batch_length", longest)
        .join(F.broadcast(border), "batch_no", "left")
        .withColumn("batch_length", F.coalesce("_longest", "batch_length"))
        .select(*examples.columns, "feed_key", "position", "batch_no", "batch_length")
    )


def _batched(ordered: DataFrame, ids_column: str, batch_size: int, position: str) -> DataFrame:
    if "batch_length" in ordered.columns:
        return ordered
    batch = F.floor((F.col(position) - 1) / batch_size).cast("bigint")
    # A window partition is one batch, so never more than batch_size rows.
    return ordered.withColumn("batch_no", batch).withColumn(
        "batch_length", F.max(F.size(ids_column)).over(Window.partitionBy("batch_no"))
    )


def collate_right(
    ordered: DataFrame, batch_size: int, pad_id: int, pad_label: int = -100, position: str = "position"
) -> DataFrame:
    """Pad ids, mask and labels on the right to the longest row of the batch (of ``feed_batches``, or by ``position``).

    Rows without ``attention_mask`` and ``labels`` get them here (ones, and the ids), after the
    last shuffle: order and batch such rows if the two hold nothing else.
    """
    length = F.col("batch_length")
    mask = F.col("attention_mask") if "attention_mask" in ordered.columns else ones(F.col("input_ids"))
    labels = F.col("labels") if "labels" in ordered.columns else F.col("input_ids")
    return (
        _batched(ordered, "input_ids", batch_size, position)
        .withColumn("attention_mask", pad_right(mask, length, 0))
        .withColumn("labels", pad_right(labels, length, pad_label))
        .withColumn("input_ids", pad_right(F.col("input_ids"), length, pad_id))
    )


def collate_left(ordered: DataFrame, batch_size: int, pad_id: int, position: str = "position") -> DataFrame:
    """Pad prompts on the left (of ``feed_batches``, or by ``position``); ``prompt_mask`` is 0 on the padding."""
    length = F.col("batch_length")
    ones = F.transform("prompt_ids", lambda _: F.lit(1))
    return (
        _batched(ordered, "prompt_ids", batch_size, position)
        .withColumn("prompt_mask", pad_left(ones, length, 0))
        .withColumn("prompt_ids", pad_left(F.col("prompt_ids"), length, pad_id))
    )


def steps_plan(examples: DataFrame, params: FeedParams = FeedParams()) -> DataFrame:
    """Row count, steps per epoch and total steps; all zero for an empty table."""
    counted = examples.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn(
        "steps_per_epoch", F.ceil(F.col("n_rows") / params.effective_batch).cast("bigint")
    ).withColumn("max_steps", F.col("steps_per_epoch") * params.trainer_num_train_epochs)
