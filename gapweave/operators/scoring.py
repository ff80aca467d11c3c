"""Score rows: two candidates per example against one reference."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions import codebleu as C, metrics as M
from gapweave.params import EvalParams

CANDIDATES = ("base", "lora")

# Metric name, whether higher is better, whether it is a 0/1 outcome.
METRICS = [
    ("codebleu", True, False),
    ("sentencebleu", True, False),
    ("exact_match", True, True),
    ("line_match", True, True),
    ("perplexity", False, False),
    ("edit_similarity", True, False),
]


@dataclass(frozen=True)
class Metric:
    """A metric of one's own: ``column(reference, candidate)`` builds the score from two column names."""

    name: str
    column: Callable[[str, str], Column]
    higher_is_better: bool = True
    is_binary: bool = False


def generations(
    references: DataFrame, base: DataFrame, lora: DataFrame, key: str = "example_id"
) -> DataFrame:
    """Join each example with both generations by key (never by position).

    ``references(key, reference_middle)``; ``base`` and ``lora`` are
    ``(key, generated_middle, perplexity)``.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            key,
            F.col("generated_middle").alias(f"{name}_generated_middle"),
            F.col("perplexity").alias(f"{name}_perplexity"),
        )

    return (
        references.select(key, "reference_middle")
        .join(side(base, "base"), key)
        .join(side(lora, "lora"), key)
        .select(
            key,
            "reference_middle",
            "base_generated_middle",
            "lora_generated_middle",
            "base_perplexity",
            "lora_perplexity",
        )
    )


def score_columns(ref: str, pred: str, params: EvalParams) -> dict[str, Column]:
    return {
        "sentencebleu": M.sentence_bleu(ref, pred, params.bleu_weights),
        "exact_match": M.exact_match(ref, pred),
        "line_match": M.line_match(ref, pred, params.line_match_number_of_lines),
        "edit_similarity": M.edit_similarity(ref, pred),
    }


def score_rows(rows: DataFrame, params: EvalParams = EvalParams(), own: Sequence[Metric] = ()) -> DataFrame:
    """Append the eleven score fields, and two for each metric of one's own, to the generation rows; no shuffle."""
    ref = "reference_middle"
    with_code = C.with_codebleu(
        rows,
        ref,
        {f"{name}_codebleu": f"{name}_generated_middle" for name in CANDIDATES},
        params.data_language,
        params.codebleu_weights,
    )
    columns = []
    for name in CANDIDATES:
        columns.append(F.col(f"{name}_codebleu"))
        others = score_columns(ref, f"{name}_generated_middle", params)
        others |= {m.name: m.column(ref, f"{name}_generated_middle") for m in own}
        columns += [c.alias(f"{name}_{metric}") for metric, c in others.items()]
    return with_code.select(*rows.columns, "codebleu_valid", *columns)


def metric_registry(spark, own: Sequence[Metric] = ()) -> DataFrame:
    rows = [*METRICS, *((m.name, m.higher_is_better, m.is_binary) for m in own)]
    return spark.createDataFrame(rows, "metric string, higher_is_better boolean, is_binary boolean")


def scores_long(
    scores: DataFrame, key: str = "example_id", metrics: list[str] | None = None, own: Sequence[Metric] = ()
) -> DataFrame:
    """``(key, metric, base, lora)``; rows without a valid CodeBLEU are left out of that metric only."""
    known = [*(m for m, _, _ in METRICS), *(m.name for m in own)]
    present = metrics or [m for m in known if f"base_{m}" in scores.columns]
    # Without CodeBLEU among the metrics its validity isn't computed either.
    flagged = "codebleu" in present and "codebleu_valid" in scores.columns
    valid = F.coalesce(F.col("codebleu_valid"), F.lit(True)) if flagged else F.lit(True)
    entries = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"base_{m}").cast("double").alias("base"),
                F.col(f"lora_{m}").cast("double").alias("lora"),
            )
            for m in present
        ]
    )
    kept = F.filter(entries, lambda e: (e["metric"] != "codebleu") | valid)
    return scores.select(key, F.inline(kept))
