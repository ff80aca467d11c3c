"""Corpus to training rows.

The plan has two parts that look at the whole corpus: the split (counts per key bucket) and
the bytes-per-token ratio.  The rest - scan, blocks, sub-block sample, examples, ids,
length filters - is one pass over the files without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from gapweave.functions.text import clean, leading_keyword, structures, words
from gapweave.operators.fim import cut_examples, drop_overlong, fim_picks, tokenize_and_filter, training_arrays
from gapweave.operators.random_fim import random_examples, window_bytes
from gapweave.operators.settle import settle
from gapweave.operators.splits import SPLITS, split_exact, split_stratified
from gapweave.operators.structure import extract_blocks, with_nodes
from gapweave.operators.tokens import bytes_per_token, ratio_value
from gapweave.params import FimParams, Markers, SplitParams
from gapweave.sinks.writers import replace_examples
from gapweave.sources.rules import LanguageRules, scanner_rules


def file_blocks(
    files: DataFrame, scanner: str, params: FimParams, rules: LanguageRules | None = None, nodes: bool = False
) -> DataFrame:
    """Blocks of files with ``file_id, text, content`` and, if present, ``split``.

    With ``nodes=True`` the files already carry a ``nodes`` array from another scanner.
    """
    rules = rules or scanner_rules(scanner)
    keep = tuple(c for c in ("file_id", "split") if c in files.columns)
    scanned = files if nodes else with_nodes(files, scanner)
    return extract_blocks(
        scanned, rules.block_types, rules.subblock_types, params.max_code_blocks_ast_depth, passing=keep
    )


def corpus_ratio(train_blocks: DataFrame, tokenizer=None) -> DataFrame:
    """Bytes per token over all train blocks, as a one-row table.

    ``tokenizer`` is the column function of the tokenizer in use; without one words count.
    """
    text = F.make_valid_utf8(F.col("code").cast("string"))
    return bytes_per_token(train_blocks, F.size(tokenizer(text) if tokenizer else words(text)))


def structural_examples(
    files: DataFrame,
    scanner: str,
    params: FimParams = FimParams(),
    ratio: Column | float = 1.0,
    markers: Markers = Markers(),
    tokenizer=None,
    rules: LanguageRules | None = None,
    nodes: bool = False,
    observed: Observation | None = None,
) -> DataFrame:
    """Tokenized training rows from blocks and sub-blocks; see ``training_rows`` for the hooks.

    ``observed`` counts the examples of each split before the exact length filters.
    """
    blocks = file_blocks(files, scanner, params, rules, nodes)
    if tokenizer is None and observed is None:
        blocks = drop_overlong(blocks, params.max_token_sequence_length, markers)
    picks = fim_picks(blocks, params, ratio, markers)
    if observed is not None:
        # A pick is an example; counted here, its text is cut for the rows that stay.
        picks = picks.observe(observed, *_split_counts())
    return tokenize_and_filter(cut_examples(picks, markers), params, markers, tokenizer)


def _split_counts() -> list[Column]:
    return [F.count_if(F.col("split") == s).alias(s) for s in SPLITS]


def quotas_of(counts: DataFrame, params: FimParams) -> DataFrame:
    """``int(n * ratio)`` for the ``n`` structural rows of each split."""
    share = F.lit(float(params.rand_to_ast_fim_examples_ratio))
    return counts.select("split", F.floor(F.col("n") * share).alias("quota"))


def random_quotas(structural: DataFrame, params: FimParams) -> DataFrame:
    """How many random examples each split gets: ``int(structural rows * ratio)``."""
    return quotas_of(structural.groupBy("split").agg(F.count(F.lit(1)).alias("n")), params)


def _two_kinds(
    files: DataFrame,
    scanner: str,
    split_params: SplitParams = SplitParams(),
    params: FimParams = FimParams(),
    ratio: Column | float | None = None,
    markers: Markers = Markers(),
    tokenizer=None,
    rules: LanguageRules | None = None,
    nodes: bool = False,
    observed: Observation | None = None,
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The structural rows, and a function from the quotas to the random rows; see ``training_rows``."""
    assigned = files if "split" in files.columns else split_exact(files, ["file_id"], split_params)
    if ratio is None and tokenizer is not None:
        blocks = file_blocks(assigned, scanner, params, rules, nodes).where(F.col("split") == "train")
        ratio = ratio_value(corpus_ratio(blocks, tokenizer))
    if not isinstance(ratio, Column):
        ratio = F.lit(float(1.0 if ratio is None else ratio))
    structural = structural_examples(assigned, scanner, params, ratio, markers, tokenizer, rules, nodes, observed)
    chunk_files = assigned.select("file_id", "split", "content")
    window = window_bytes(params.max_token_sequence_length, ratio)
    return structural, lambda quotas: random_examples(chunk_files, window, params, quotas, markers, tokenizer)


def training_rows(
    files: DataFrame,
    scanner: str,
    split_params: SplitParams = SplitParams(),
    params: FimParams = FimParams(),
    ratio: Column | float | None = None,
    markers: Markers = Markers(),
    tokenizer=None,
    rules: LanguageRules | None = None,
    nodes: bool = False,
    observed: Observation | None = None,
) -> DataFrame:
    """Structural and random examples of every split (bag union, told apart by ``kind``).

    ``tokenizer`` is a column function from text to ids (plans.plugins.tokenizer), byte ids by
    default.  ``rules`` name the node types of blocks and sub-blocks, those of the scanner by
    default.  With ``nodes=True`` the files carry the node array of a parser of one's own.
    ``ratio`` is bytes per token; without one it is estimated over all train blocks with the
    tokenizer in use (a byte has one byte id).

    The structural rows are written once to the shared folder: the quotas of the random rows are
    counted there, so the scanner doesn't run again.  ``observed`` takes the number of examples of each
    split before the exact length filters from that job.
    """
    found, random_rows = _two_kinds(files, scanner, split_params, params, ratio, markers, tokenizer, rules, nodes, observed)
    # Mask and labels follow from the ids.
    structural = training_arrays(settle(found.select("file_id", "split", "input_ids")))
    extra = random_rows(random_quotas(structural, params))
    columns = ["file_id", "split", "input_ids", "attention_mask", "labels"]
    return (
        structural.select(*columns)
        .withColumn("kind", F.lit("structural"))
        .unionByName(extra.select(*columns).withColumn("kind", F.lit("random")))
    )


def write_training_rows(
    files: DataFrame, scanner: str, path: str, fmt: str = "json", params: FimParams = FimParams(), **options
) -> DataFrame:
    """The rows of ``training_rows`` to a folder per split; returns what the writing jobs counted.

    One row per split: ``n_examples`` (before the exact length filters), ``n_structural`` and
    ``n_random`` (written).  The counts come with the rows, no job reads them again.  A length filter
    on block bytes ahead of the examples is left out, so that every example is counted.

    The structural rows go straight to their folder; the quotas of the random rows, which follow them
    there, come from the count of that job.
    """
    spark = files.sparkSession
    before, structural, extra = Observation(), Observation(), Observation()
    found, random_rows = _two_kinds(files, scanner, params=params, observed=before, **options)

    def random_part() -> DataFrame:
        counts = spark.createDataFrame([(s, structural.get[s]) for s in SPLITS], "split string, n bigint")
        # Read from a table: an observation on rows that Spark finds to be none would never be answered.
        chosen = settle(random_rows(quotas_of(counts, params)).select("split", "input_ids"))
        return training_arrays(chosen).observe(extra, *_split_counts())

    stored = found.select("split", "input_ids", "attention_mask", "labels")
    replace_examples(stored.observe(structural, *_split_counts()), path, fmt=fmt, then=random_part)
    counted = [(s, before.get[s], structural.get[s], extra.get[s]) for s in SPLITS]
    return spark.createDataFrame(counted, "split string, n_examples bigint, n_structural bigint, n_random bigint")


def stratified_structures(files: DataFrame, split_params: SplitParams = SplitParams()) -> DataFrame:
    """Clean files, cut out keyword structures, split them within each leading keyword."""
    blocks = files.select("file_id", F.posexplode(structures(clean(F.col("text")))).alias("block_no", "block"))
    categorized = blocks.withColumn("category", leading_keyword(F.col("block")))
    return split_stratified(categorized, "category", ["file_id", "block_no"], split_params)
