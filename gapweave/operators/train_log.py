"""Training log, checkpoint choice and perplexity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gapweave.functions.metrics import perplexity


def split_log(history: DataFrame, keep: tuple[str, ...] = ("run_id", "step")) -> DataFrame:
    """Long log: a row with ``loss`` is a train entry, otherwise one with ``eval_loss`` is an eval entry."""
    kind = F.when(F.col("loss").isNotNull(), "train").when(F.col("eval_loss").isNotNull(), "eval")
    extra = [c for c in ("epoch", "learning_rate") if c in history.columns]
    return (
        history.withColumn("kind", kind)
        .where(F.col("kind").isNotNull())
        .select(
            *keep,
            "kind",
            F.coalesce("loss", "eval_loss").alias("loss"),
            *[
                (F.when(F.col("kind") == "train", F.col(c)) if c == "learning_rate" else F.col(c)).alias(c)
                for c in extra
            ],
        )
    )


def loss_curve(log: DataFrame) -> DataFrame:
    """Points of the loss curves; order by (run_id, kind, step) where order matters."""
    return log.select("run_id", "kind", "step", "loss")


def best_checkpoint(log: DataFrame) -> DataFrame:
    """Step with the lowest eval loss per run; the earliest wins a tie."""
    lowest = F.struct(F.col("loss"), F.col("step"))
    return (
        log.where((F.col("kind") == "eval") & ~F.isnan("loss"))
        .groupBy("run_id")
        .agg(F.min(lowest).alias("best"))
        .select("run_id", F.col("best.step").alias("step"), F.col("best.loss").alias("loss"))
    )


def last_checkpoint(names: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Checkpoint with the highest number at the end of its name."""
    group = group or []
    step = F.regexp_extract("name", r"(\d+)$", 1).cast("bigint")
    return (
        names.where(F.col("name").rlike(r"^checkpoint-.*?\d+$"))
        .groupBy(*group)
        .agg(F.max(F.struct(step.alias("step"), F.col("name").alias("name"))).alias("last"))
        .where(F.col("last").isNotNull())
        .select(*group, F.col("last.name").alias("name"), F.col("last.step").alias("step"))
    )


def select_checkpoint(log: DataFrame, names: DataFrame, run_id, strategy: str) -> str:
    """Name of the checkpoint to keep for one run; raises where there is none."""
    if strategy == "last":
        row = last_checkpoint(names).first()
        if row is None:
            raise FileNotFoundError("no checkpoints found")
        return row["name"]
    if strategy == "best":
        row = best_checkpoint(log.where(F.col("run_id") == run_id)).first()
        if row is None:
            raise ValueError("no eval steps in the training log")
        name = f"checkpoint-{row['step']}"
        if names.where(F.col("name") == name).isEmpty():
            raise FileNotFoundError(f"best checkpoint {name} not found")
        return name
    raise ValueError("strategy must be 'best' or 'last'")


def example_perplexity(logprobs: DataFrame, examples: DataFrame | None = None, key: str = "example_id") -> DataFrame:
    """``exp(mean negative log-likelihood)`` over unmasked tokens; infinite where none was scored."""
    mean_nll = -F.avg(F.when(~F.col("masked"), F.col("logprob")))
    out = logprobs.groupBy(key).agg(mean_nll.alias("mean_nll"))
    if examples is not None:
        out = examples.select(key).join(out, key, "left")
    return out.select(key, perplexity(F.col("mean_nll")).alias("perplexity"))
