"""Incremental preprocessing of arriving files.

A key-threshold split instead of exact counts and a given bytes-per-token ratio make the structural
rows a map over files: the same functions as in batch are applied, so a stream over a set of files
gives the rows of the batch plan over that set.

Random rows are chosen from all files, up to a share of the structural rows.  ``run_training`` keeps
that state as tables: every micro-batch writes its structural rows and the byte chunks of its files
under its own number, over what an earlier try of the same batch may have left.  When the files that
are there have been read, quotas are counted on the rows written and the choice is made anew over the
chunks, of which only lengths and keys are read; it takes the place of the choice before.  After any
number of triggers the tables hold the rows of the batch plan over all files seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gapweave.operators.fim import training_arrays
from gapweave.operators.random_fim import byte_chunks, chosen_spans, random_pool, spans_to_examples, window_bytes
from gapweave.operators.splits import split_by_threshold
from gapweave.params import FimParams, Markers, SplitParams
from gapweave.plans.preprocess import random_quotas, structural_examples
from gapweave.sinks.writers import replace_table
from gapweave.sources.files import valid_files, with_extension
from gapweave.sources.rules import LanguageRules

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, root: str, extensions: list[str]) -> DataFrame:
    raw = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", True)
        .load(root)
    )
    files = with_extension(raw.select("path", F.col("length").alias("n_bytes"), "content"), extensions)
    return valid_files(files).withColumn("file_id", F.col("path"))


def incremental_examples(
    files: DataFrame,
    scanner: str,
    split_params: SplitParams = SplitParams(),
    params: FimParams = FimParams(),
    ratio: float = 1.0,
    markers: Markers = Markers(),
    tokenizer=None,
    rules: LanguageRules | None = None,
    nodes: bool = False,
) -> DataFrame:
    """Batch or streaming files to structural training rows; the hooks are those of ``training_rows``."""
    assigned = split_by_threshold(files, ["file_id"], split_params)
    return structural_examples(assigned, scanner, params, ratio, markers, tokenizer, rules, nodes)


def run_available(examples: DataFrame, out: str, checkpoint: str) -> None:
    """Process all files that are there now, then stop; call again for later arrivals."""
    query = (
        examples.select("split", "file_id", "input_ids", "attention_mask", "labels")
        .writeStream.format("parquet")
        .partitionBy("split")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()


#: What is stored of a row; mask and labels follow from the ids.
STORED = ["file_id", "split", "input_ids"]
#: What identifies a row of each kind, kept beside the arrays.
ROW_IDS = {"structural": ["block_id", "sub_id"], "random": ["chunk_no", "draw"]}


def run_training(
    files: DataFrame,
    scanner: str,
    out: str,
    checkpoint: str,
    split_params: SplitParams = SplitParams(),
    params: FimParams = FimParams(),
    ratio: float = 1.0,
    markers: Markers = Markers(),
    tokenizer=None,
    rules: LanguageRules | None = None,
    nodes: bool = False,
) -> None:
    """Process all files of the stream that are there now, structural and random rows; call again for later arrivals.

    The tables lie in ``out``: ``structural``, ``chunks`` (one folder per micro-batch) and ``random``.
    """

    def add(batch: DataFrame, number: int) -> None:
        # A micro-batch may have come in one piece; all cores scan it.
        dealt = batch.repartition(batch.sparkSession.sparkContext.defaultParallelism, "file_id")
        assigned = split_by_threshold(dealt, ["file_id"], split_params)
        structural = structural_examples(assigned, scanner, params, ratio, markers, tokenizer, rules, nodes)
        structural.select(*STORED, *ROW_IDS["structural"]).write.mode("overwrite").parquet(f"{out}/structural/batch={number}")
        window = window_bytes(params.max_token_sequence_length, F.lit(float(ratio)))
        chunks = byte_chunks(assigned.select("file_id", "split", "content"), window, keep=("file_id", "split"))
        if tokenizer is not None:
            chunks = chunks.withColumn("ids", tokenizer(F.make_valid_utf8(F.col("bytes").cast("string"))))
        chunks.write.mode("overwrite").parquet(f"{out}/chunks/batch={number}")

    query = (
        files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    choose_random(files.sparkSession, out, params, markers)


def choose_random(spark: SparkSession, out: str, params: FimParams = FimParams(), markers: Markers = Markers()) -> None:
    """Choose the random rows anew, for the structural rows and chunks that ``out`` holds now."""
    read = lambda name: spark.read.parquet(f"{out}/{name}").drop("batch")
    quotas = random_quotas(read("structural").select("split"), params)
    chosen = chosen_spans(random_pool(read("chunks"), params), quotas)
    rows = spans_to_examples(chosen, markers).select(*STORED, *ROW_IDS["random"])
    replace_table(rows, f"{out}/random")


def read_training(spark: SparkSession, out: str) -> DataFrame:
    """Structural and random rows written so far with their arrays, told apart by ``kind``."""
    kinds = [spark.read.parquet(f"{out}/{kind}").select(*STORED, F.lit(kind).alias("kind")) for kind in ROW_IDS]
    return training_arrays(kinds[0].unionByName(kinds[1]))
