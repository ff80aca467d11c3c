"""Generations to scores to report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gapweave.operators.scoring import score_rows, scores_long
from gapweave.operators.summary import metric_rows, metric_summary, report_json
from gapweave.operators.tokens import benchmark_sample, fim_parts, prompts
from gapweave.params import EvalParams, Markers


def benchmark(test_rows: DataFrame, params: EvalParams, ids: tuple[str, ...], markers: Markers = Markers()) -> DataFrame:
    sample = benchmark_sample(test_rows, params.benchmark_sample_size, params.benchmark_shuffle_seed, ids, markers)
    return fim_parts(sample, markers, keep=ids)


def benchmark_prompts(parts: DataFrame, markers: Markers = Markers()) -> DataFrame:
    return prompts(parts, markers=markers)


def scores(rows: DataFrame, params: EvalParams = EvalParams()) -> DataFrame:
    return score_rows(rows, params)


def summary(score_table: DataFrame) -> DataFrame:
    """One scan of the scores for all metrics."""
    return metric_summary(scores_long(score_table))


def report(score_table: DataFrame, checkpoint: str) -> DataFrame:
    return report_json(summary(score_table), checkpoint)


def tracked_metrics(score_table: DataFrame) -> DataFrame:
    return metric_rows(summary(score_table))
