"""JSON Lines sources with declared schemas; blank lines are skipped by the reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TRAINING_SCHEMA = "input_ids array<int>, attention_mask array<int>, labels array<int>"
BENCHMARK_SCHEMA = "input_ids array<bigint>, attention_mask array<bigint>, labels array<bigint>"
BENCHMARK_ROW_SCHEMA = (
    "example_token_ids array<bigint>, prefix_token_ids array<bigint>, suffix_token_ids array<bigint>, "
    "middle_token_ids array<bigint>, prefix string, suffix string, middle string"
)
SCORE_SCHEMA = (
    "example_id bigint, reference_middle string, base_generated_middle string, lora_generated_middle string, "
    "base_perplexity double, lora_perplexity double, codebleu_valid boolean, "
    "base_codebleu double, base_sentencebleu double, base_exact_match double, base_line_match double, "
    "base_edit_similarity double, lora_codebleu double, lora_sentencebleu double, lora_exact_match double, "
    "lora_line_match double, lora_edit_similarity double"
)
TRAIN_HISTORY_SCHEMA = (
    "run_id string, step bigint, loss double, eval_loss double, epoch double, learning_rate double"
)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_training(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TRAINING_SCHEMA)


def read_benchmark_input(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, BENCHMARK_SCHEMA)


def read_benchmark(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, BENCHMARK_ROW_SCHEMA)


def read_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """Rows without ``input_ids`` become empty examples."""
    return read_training(spark, path).withColumn(
        "input_ids", F.coalesce("input_ids", F.array().cast("array<int>"))
    )


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Score rows; a missing validity flag counts as valid."""
    return _read(spark, path, SCORE_SCHEMA).withColumn(
        "codebleu_valid", F.coalesce("codebleu_valid", F.lit(True))
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TRAIN_HISTORY_SCHEMA)
