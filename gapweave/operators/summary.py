"""Summaries: metric averages, outcomes, quantiles, histograms, length profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gapweave.functions.tokens import closed_middle_length
from gapweave.operators.ranking import null_safe_join
from gapweave.operators.scoring import METRICS, Metric, metric_registry
from gapweave.operators.settle import settle
from gapweave.operators.splits import SPLITS
from gapweave.params import Markers

# Bins and limits of the reports.
LENGTH_BINS = 59
MIDDLE_HEADROOM = 20
THRESHOLD_BINS = 50
DIFFERENCE_BINS = 30
DISPLAY_LIMIT = 25.0
DISPLAY_HEADROOM = 1.1

SPLITTER_STEPS = 10  # 1 023 splitters
SPLITTER_ACCURACY = 20_000


# ---------------------------------------------------------------- metric summary


def with_registry(long: DataFrame, own: Sequence[Metric] = ()) -> DataFrame:
    """Add direction and kind; a metric that is registered nowhere stays, with both null."""
    return long.join(metric_registry(long.sparkSession, own), "metric", "left")


def improvement(base: Column, lora: Column, higher_is_better: Column) -> Column:
    return F.when(higher_is_better, lora - base).when(~higher_is_better, base - lora)


def metric_summary(long: DataFrame, own: Sequence[Metric] = ()) -> DataFrame:
    """All metrics in one pass: count, averages, improvement and its share of the base average."""
    averages = long.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((F.abs("base") < float("inf")) & (F.abs("lora") < float("inf"))).alias("n_finite"),
        F.avg("base").alias("base_average"),
        F.avg("lora").alias("lora_average"),
    )
    gain = improvement(F.col("base_average"), F.col("lora_average"), F.col("higher_is_better"))
    return (
        with_registry(averages, own)
        .withColumn("improvement", gain)
        .withColumn("improvement_pct", gain / F.nullif(F.abs("base_average"), F.lit(0.0)) * 100)
    )


def win_tie_loss(long: DataFrame) -> DataFrame:
    """Outcome counts of the 0/1 metrics."""
    win = F.count_if((F.col("lora") == 1) & (F.col("base") == 0))
    loss = F.count_if((F.col("lora") == 0) & (F.col("base") == 1))
    return (
        long.groupBy("metric")
        .agg(win.alias("wins"), loss.alias("losses"), F.count(F.lit(1)).alias("n"))
        .withColumn("ties", F.col("n") - F.col("wins") - F.col("losses"))
        .select("metric", "wins", "ties", "losses", "n")
    )


def metric_rows(summary: DataFrame) -> DataFrame:
    """Long rows ``evaluate.<metric>.{base, lora, improvement}``."""
    entries = F.array(
        *[
            F.struct(F.concat(F.lit("evaluate."), F.col("metric"), F.lit(f".{name}")).alias("name"), value.alias("value"))
            for name, value in (
                ("base", F.col("base_average")),
                ("lora", F.col("lora_average")),
                ("improvement", F.col("improvement")),
            )
        ]
    )
    return summary.select(F.inline(entries))


def paired_scores(long: DataFrame, key: str = "example_id") -> DataFrame:
    """Per-example pairs with the side they fall on relative to a tie."""
    gap = F.col("lora") - F.col("base")
    return long.select(
        key, "metric", "base", "lora", F.when(gap > 0, "above").when(gap < 0, "below").otherwise("tie").alias("side")
    )


def report_json(summary: DataFrame, checkpoint: str, stamp: Column | None = None) -> DataFrame:
    """One JSON document with the statistics of every metric, in registry order.

    Per-example arrays are not repeated here; they are the score table.
    """
    position = F.array_position(F.array(*[F.lit(m) for m, _, _ in METRICS]), F.col("metric"))
    stat = F.struct(
        position.alias("pos"),
        F.struct("metric", "n", "base_average", "lora_average", "is_binary", "higher_is_better").alias("stat"),
    )
    # The list has one entry per registered metric.
    stats = F.transform(F.sort_array(F.collect_list(stat)), lambda x: x["stat"])
    stamp = stamp if stamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return summary.agg(stats.alias("all_metric_stats")).select(
        F.to_json(
            F.struct(F.lit(checkpoint).alias("checkpoint"), stamp.alias("evaluation_date"), "all_metric_stats")
        ).alias("report")
    )


# ---------------------------------------------------------------- quantiles


def _count_below(df: DataFrame, value: str, splitters: str, steps: int, out: str) -> DataFrame:
    """Number of sorted splitters below the value: binary search, one projection per step."""
    df = df.withColumn(out, F.lit(0))
    for step in reversed(range(steps)):
        jump = 1 << step
        # Splitters at index out .. out + jump - 1 are all below the value if the last one is.
        probe = F.get(splitters, F.col(out) + (jump - 1))
        df = df.withColumn(out, F.col(out) + F.when(F.col(value) > probe, jump).otherwise(0))
    return df


def order_statistics(df: DataFrame, groups: list[str], value: str, quantiles: list[float]) -> DataFrame:
    """Exact interpolated quantiles per group, one row per (group, q).

    Equal values are combined first and written once; all that follows reads them.  Approximate splitters cut the value axis into ranges;
    counts per range tell which range holds each wanted rank, and only those ranges are
    sorted, each in its own task.  Null is a group of its own.
    """
    distinct = settle(df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n")))
    n_splitters = (1 << SPLITTER_STEPS) - 1
    shares = [i / (n_splitters + 1) for i in range(1, n_splitters + 1)]
    ranges = distinct.groupBy(*groups).agg(
        F.percentile_approx(value, shares, SPLITTER_ACCURACY).alias("_splitters"), F.sum("_n").alias("_total")
    )
    placed = _count_below(
        null_safe_join(distinct, ranges, groups), value, "_splitters", SPLITTER_STEPS, "_range"
    ).select(*groups, value, "_n", "_range")
    running = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    starts = (
        placed.groupBy(*groups, "_range")
        .agg(F.sum("_n").alias("_in"))
        .withColumn("_upto", F.sum("_in").over(running))
        .withColumn("_total", F.sum("_in").over(Window.partitionBy(*groups)))
        .withColumn("_before", F.col("_upto") - F.col("_in"))
    )

    def wanted(q: float, side: str) -> Column:
        h = F.lit(float(q)) * (F.col("_total") - 1)
        rank = (F.floor(h) if side == "low" else F.ceil(h)) + 1
        return F.struct(
            F.lit(float(q)).alias("q"),
            F.lit(side).alias("side"),
            rank.cast("bigint").alias("rank"),
            (h - F.floor(h)).alias("share"),
        )

    marks = starts.select(
        *groups,
        "_range",
        "_before",
        "_upto",
        F.explode(F.array(*[wanted(q, side) for q in quantiles for side in ("low", "high")])).alias("want"),
    ).where((F.col("_before") < F.col("want.rank")) & (F.col("want.rank") <= F.col("_upto")))
    in_range = Window.partitionBy(*groups, "_range", "want").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hits = (
        null_safe_join(placed, marks, [*groups, "_range"])
        .withColumn("_end", F.col("_before") + F.sum("_n").over(in_range))
        .where((F.col("_end") - F.col("_n") < F.col("want.rank")) & (F.col("want.rank") <= F.col("_end")))
    )
    low = F.max(F.when(F.col("want.side") == "low", F.col(value)))
    high = F.max(F.when(F.col("want.side") == "high", F.col(value)))
    return (
        hits.groupBy(*groups, F.col("want.q").alias("q"))
        .agg(low.alias("_low"), high.alias("_high"), F.max("want.share").alias("_share"))
        .select(
            *groups,
            "q",
            F.when(F.col("_low") == F.col("_high"), F.col("_low"))
            .otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share"))
            .alias("value"),
        )
    )


def five_number(long: DataFrame) -> DataFrame:
    """Minimum, quartiles, maximum and the 1.5 IQR fences per metric and candidate."""
    tall = long.select(
        "metric",
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("candidate"), F.col(c).alias("score")) for c in ("base", "lora")]
            )
        ),
    )
    names = {0.0: "minimum", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "maximum"}
    stats = (
        order_statistics(tall, ["metric", "candidate"], "score", list(names))
        .groupBy("metric", "candidate")
        .agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(name) for q, name in names.items()])
    )
    spread = F.col("q3") - F.col("q1")
    return stats.withColumn("low_fence", F.col("q1") - 1.5 * spread).withColumn(
        "high_fence", F.col("q3") + 1.5 * spread
    )


# ---------------------------------------------------------------- histograms


def bin_number(x: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; the last bin includes its right edge; null outside the range."""
    x, low, high = x.cast("double"), low.cast("double"), high.cast("double")
    width = (high - low) / bins
    guess = F.least(F.floor((x - low) / width), F.lit(bins - 1))
    # One step of correction makes the result agree with the edges ``low + i * width``.
    settled = (
        F.when(x < low + guess * width, guess - 1)
        .when((x >= low + (guess + 1) * width) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    return F.when((x >= low) & (x <= high), settled.cast("int"))


def dense_histogram(counted: DataFrame, bins: int, groups: DataFrame | None = None) -> DataFrame:
    """Fill in the empty bins."""
    every_bin = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    if groups is None:
        grid, keys = counted.sparkSession.range(1).select(every_bin), ["bin"]
    else:
        grid, keys = groups.select("*", every_bin), [*groups.columns, "bin"]
    return null_safe_join(grid, counted, keys, "left").select(*keys, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def split_histogram(lengths: DataFrame, value: str, high: float, bins: int = LENGTH_BINS) -> DataFrame:
    """Histogram on ``[0, high]`` for each of the three splits."""
    numbered = lengths.withColumn("bin", bin_number(F.col(value), F.lit(0.0), F.lit(float(high)), bins))
    counted = numbered.where(F.col("bin").isNotNull()).groupBy("split", "bin").agg(F.count(F.lit(1)).alias("n"))
    names = lengths.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    return dense_histogram(counted, bins, names)


def observed_histogram(df: DataFrame, groups: list[str], value: str, bins: int) -> DataFrame:
    """Histogram on the observed range of each group; ``non_finite`` counts what lies in no bin.

    The values are written once: range, bins and leftovers are three readings.
    """
    df = settle(df.select(*groups, value))
    finite = df.where(F.abs(value) < float("inf"))
    span = finite.groupBy(*groups).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    # A single-valued group gets a range of one around the value.
    span = span.withColumn("_flat", F.col("_low") == F.col("_high")).select(
        *groups,
        (F.col("_low") - F.when(F.col("_flat"), 0.5).otherwise(0.0)).alias("_low"),
        (F.col("_high") + F.when(F.col("_flat"), 0.5).otherwise(0.0)).alias("_high"),
    )

    def with_span(rows: DataFrame) -> DataFrame:
        if groups:
            return null_safe_join(rows, span, groups)
        one_row = span.select(F.struct("_low", "_high").alias("span")).scalar()
        return rows.withColumns({c: one_row[c] for c in ("_low", "_high")})

    counted = (
        with_span(finite).withColumn("bin", bin_number(F.col(value), F.col("_low"), F.col("_high"), bins))
        .groupBy(*groups, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    dense = dense_histogram(counted, bins, span.select(*groups) if groups else None)
    edges = with_span(dense)
    odd = ~F.coalesce(F.abs(value) < float("inf"), F.lit(False))
    others = df.groupBy(*groups).agg(F.count_if(odd).alias("non_finite"))
    if groups:
        edges = null_safe_join(edges, others, groups)
    else:
        edges = edges.withColumn("non_finite", others.scalar())
    width = (F.col("_high") - F.col("_low")) / bins
    return edges.select(*groups, "bin", (F.col("_low") + F.col("bin") * width).alias("left_edge"), "n", "non_finite")


def differences(long: DataFrame, own: Sequence[Metric] = ()) -> DataFrame:
    """Signed per-example improvement."""
    gap = improvement(F.col("base"), F.col("lora"), F.col("higher_is_better"))
    return with_registry(long, own).withColumn("difference", gap)


def difference_histogram(long: DataFrame, bins: int = DIFFERENCE_BINS) -> DataFrame:
    return observed_histogram(differences(long).select("metric", "difference"), ["metric"], "difference", bins)


def difference_summary(long: DataFrame) -> DataFrame:
    """Mean difference and the display bound of each continuous metric."""
    stats = (
        differences(long)
        .where(~F.col("is_binary"))
        .groupBy("metric")
        .agg(
            F.avg("difference").alias("mean_difference"),
            F.greatest(F.max("base"), F.max("lora")).alias("max_score"),
        )
    )
    bound = F.when(F.col("max_score") > DISPLAY_LIMIT, DISPLAY_LIMIT).otherwise(F.col("max_score") * DISPLAY_HEADROOM)
    return stats.withColumn("display_bound", bound)


# ---------------------------------------------------------------- length profiles


def length_rows(
    tokenized: DataFrame, markers: Markers = Markers(), keep: tuple[str, ...] = ("split",)
) -> DataFrame:
    """Token length and middle length per example; missing ids count as an empty example."""
    ids = F.coalesce("input_ids", F.array().cast("array<int>"))
    return tokenized.select(
        *keep, F.size(ids).alias("token_length"), closed_middle_length(ids, markers).alias("middle_length")
    )


def threshold_coverage(lengths: DataFrame, threshold: int, value: str = "token_length") -> DataFrame:
    return lengths.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.max(value), F.lit(0)).cast("bigint").alias("max_length"),
        F.count_if(F.col(value) <= threshold).alias("n_within"),
    )
