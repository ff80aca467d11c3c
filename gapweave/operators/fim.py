"""Fill-in-the-middle examples from blocks, and their tokenized form.

Everything here works inside the block's row: sampling without replacement is a sort of
the block's own sub-block array by key, and one explode yields the examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions.keys import shuffle_key
from gapweave.functions.tokens import count_ids, count_middle_ids, encode_text, ones, psm_text, tail_middle_length
from gapweave.params import FimParams, Markers


def within_end_limit(subblocks: Column, max_len: int, ratio: Column) -> Column:
    """Sub-blocks that end within the byte budget (the end offset counts, not the length)."""
    limit = F.floor(F.lit(max_len) * ratio)
    return F.filter(subblocks, lambda s: s["rel_end"] <= limit)


def sample_size(n: Column, share: float) -> Column:
    return F.when(n > 0, F.greatest(F.lit(1), F.floor(n * F.lit(float(share))).cast("int"))).otherwise(F.lit(0))


def sample_subblocks(subblocks: Column, share: float, seed: int, *block_ids: Column) -> Column:
    """Seeded sample without replacement of ``max(1, int(n * share))`` sub-blocks."""
    keyed = F.transform(
        subblocks,
        lambda s: F.struct(shuffle_key("pick", seed, *block_ids, s["sub_id"]).alias("key"), s.alias("sub")),
    )
    ordered = F.sort_array(keyed)
    return F.transform(
        F.slice(ordered, F.lit(1), sample_size(F.size(subblocks), share)), lambda x: x["sub"]
    )


def truncate_blocks(blocks: DataFrame, n_bytes: Column) -> DataFrame:
    """Blocks cut to a byte budget; sub-blocks that end beyond it go."""
    return blocks.withColumn("code", F.substring(F.col("code"), F.lit(1), n_bytes.cast("int"))).withColumn(
        "subblocks", F.filter("subblocks", lambda s: s["rel_end"] <= n_bytes)
    )


def marker_in(text: Column, markers: Markers) -> Column:
    hit = F.lit(False)
    for marker in markers.id_by_text():
        hit = hit | F.contains(text, F.lit(marker))
    return hit


def fim_picks(
    blocks: DataFrame, params: FimParams, ratio: Column | float, markers: Markers = Markers()
) -> DataFrame:
    """One row per sampled sub-block with its block's ``code``; ``marked`` says that a marker text is in there.

    ``ratio`` is bytes per token; pass a column (for example from a broadcast one-row table)
    or a number.  Picks whose estimated length is out of range are dropped, not replaced.
    """
    ratio = F.lit(float(ratio)) if not isinstance(ratio, Column) else ratio
    picks = sample_subblocks(
        within_end_limit(F.col("subblocks"), params.max_token_sequence_length, ratio),
        params.fim_examples_per_subblock_ratio,
        params.rng_seed,
        F.col("file_id"),
        F.col("block_id"),
    )
    in_range = F.filter(
        picks,
        lambda s: ((s["rel_end"] - s["rel_start"]) / ratio).between(
            params.min_middle_tokens_length, params.max_middle_tokens_length
        ),
    )
    passing = [c for c in blocks.columns if c in ("file_id", "split")]
    judged = blocks.withColumn("marked", marker_in(F.col("code").cast("string"), markers))
    return judged.select(*passing, "block_id", "code", "marked", F.explode(in_range).alias("sub"))


def cut_examples(picks: DataFrame, markers: Markers = Markers()) -> DataFrame:
    """Prefix, middle, suffix and the marked-up text of every pick."""
    passing = [c for c in picks.columns if c in ("file_id", "split")]

    def piece(start: Column, length: Column) -> Column:
        return F.substring(F.col("code"), (start + 1).cast("int"), length.cast("int")).cast("string")

    start, end = F.col("sub.rel_start"), F.col("sub.rel_end")
    parts = picks.select(
        *passing,
        "block_id",
        "marked",
        F.col("sub.sub_id").alias("sub_id"),
        piece(F.lit(0), start).alias("prefix"),
        piece(start, end - start).alias("middle"),
        piece(end, F.octet_length("code") - end).alias("suffix"),
    )
    return parts.withColumn("example", psm_text(F.col("prefix"), F.col("suffix"), F.col("middle"), markers))


def fim_examples(
    blocks: DataFrame, params: FimParams, ratio: Column | float, markers: Markers = Markers()
) -> DataFrame:
    """One row per sampled sub-block, with prefix, middle, suffix and the marked-up text; see ``fim_picks``."""
    return cut_examples(fim_picks(blocks, params, ratio, markers), markers)


def drop_overlong(blocks: DataFrame, max_len: int, markers: Markers = Markers()) -> DataFrame:
    """Skip blocks all of whose byte-level examples would exceed the length limit.

    A byte-level example has one id per byte and four markers.  A block that contains a
    marker text may come out shorter, so it stays and is judged on its ids.
    """
    return blocks.where(
        (F.octet_length("code") + 4 <= max_len) | marker_in(F.make_valid_utf8(F.col("code").cast("string")), markers)
    )


def length_filters(df: DataFrame, params: FimParams, markers: Markers = Markers()) -> DataFrame:
    """Exact total length, then exact middle length, both on ids."""
    ids = F.col("input_ids")
    return df.where(F.size(ids) <= params.max_token_sequence_length).where(
        tail_middle_length(ids, markers).between(params.min_middle_tokens_length, params.max_middle_tokens_length)
    )


def training_arrays(df: DataFrame) -> DataFrame:
    return df.withColumn("attention_mask", ones(F.col("input_ids"))).withColumn("labels", F.col("input_ids"))


def byte_level_filters(examples: DataFrame, params: FimParams, markers: Markers = Markers()) -> DataFrame:
    """The two length filters for the byte-level tokenizer, from byte counts.

    Such an example has one id per byte and four markers, so ids are built for the rows that
    pass and not at all where rows are only counted.  Rows of a block with a marker text (``marked``)
    are judged on what the ids are made of.  ``n_ids`` is the number of ids, from the same counts.
    """
    marked, example = F.col("marked"), F.col("example")
    n_bytes = F.octet_length("prefix") + F.octet_length("middle") + F.octet_length("suffix")
    total = F.when(marked, count_ids(example, markers)).otherwise(n_bytes + 4)
    middle = F.when(marked, count_middle_ids(example, markers)).otherwise(F.octet_length("middle"))
    kept = examples.where(total <= params.max_token_sequence_length).where(
        middle.between(params.min_middle_tokens_length, params.max_middle_tokens_length)
    )
    return kept.withColumn("n_ids", total).drop("marked")


def tokenize_and_filter(
    examples: DataFrame, params: FimParams, markers: Markers = Markers(), tokenizer=None
) -> DataFrame:
    """Ids by the byte-level tokenizer, or by a function of a text column (see ``plugins``)."""
    if tokenizer is None:
        kept = byte_level_filters(examples, params, markers)
        return training_arrays(kept.withColumn("input_ids", encode_text(F.col("example"), markers)))
    with_ids = examples.drop("marked").withColumn("input_ids", tokenizer(F.col("example")))
    return training_arrays(length_filters(with_ids, params, markers).withColumn("n_ids", F.size("input_ids")))
