"""Hooks for user-supplied parsers, tokenizers and generators.  All are Arrow-batched."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

NODE_ROWS = "file_id string, node_id bigint, depth int, type string, start_byte bigint, end_byte bigint"


def tokenizer(encode: Callable[[list[str]], list[list[int]]]):
    """Column function around a batch encoder.

    Marked non-deterministic so that a filter on the ids does not run the encoder twice.
    """

    def ids(text: pd.Series) -> pd.Series:
        return pd.Series(encode(text.tolist()), index=text.index)

    return F.pandas_udf(ids, "array<int>").asNondeterministic()


def parse_nodes(
    files: DataFrame, parse: Callable[[str], list[tuple[int, str, int, int]]], file_id_type: str = "bigint"
) -> DataFrame:
    """Run ``parse(text) -> [(depth, type, start_byte, end_byte), ...]`` (pre-order) on every file.

    Returns ``file_id, nodes, error``: a file that fails has an error and no nodes, and does not
    stop the run.
    """
    schema = (
        f"file_id {file_id_type}, error string, "
        "nodes array<struct<start_byte:bigint,depth:int,end_byte:bigint,type:string>>"
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            errors, nodes = [], []
            for text in batch["text"]:
                try:
                    found = [
                        {"start_byte": s, "depth": d, "end_byte": e, "type": t} for d, t, s, e in parse(text)
                    ]
                    errors.append(None)
                    nodes.append(found)
                except Exception as exc:  # one bad file must not end the job
                    errors.append(f"{type(exc).__name__}: {exc}")
                    nodes.append([])
            yield pd.DataFrame({"file_id": batch["file_id"], "error": errors, "nodes": nodes})

    return files.select("file_id", "text").mapInPandas(run, schema).select("file_id", "nodes", "error")


def table_function(
    spark: SparkSession, name: str, parse: Callable[[str], list[tuple[int, str, int, int]]], file_id_type: str = "bigint"
):
    """Register ``parse`` as the SQL table function ``name(TABLE(files))``; also returns it for ``df.asTable()``.

    The table needs ``file_id`` and ``text``.  One row per node with its pre-order number; a file that
    fails, and a null text, has one row with ``error`` and no node.
    """

    class Nodes:
        def eval(self, row):
            if row["text"] is None:
                yield row["file_id"], None, None, None, None, None, "no text"
                return
            try:
                found = list(parse(row["text"]))
            except Exception as exc:  # one bad file must not end the job
                yield row["file_id"], None, None, None, None, None, f"{type(exc).__name__}: {exc}"
                return
            for number, (depth, kind, start, end) in enumerate(found):
                yield row["file_id"], number, depth, kind, start, end, None

    made = F.udtf(Nodes, returnType=f"file_id {file_id_type}, node_id bigint, depth int, type string, start_byte bigint, end_byte bigint, error string")
    spark.udtf.register(name, made)
    return made


def generate(
    prompts: DataFrame,
    model: Callable[[list[list[int]]], list[tuple[str, float]]],
    batch_size: int,
    key: str = "example_id",
) -> DataFrame:
    """Run ``model(prompt id lists) -> [(text, perplexity), ...]`` in batches of ``batch_size``.

    Only the last batch of a task may be smaller: what an Arrow batch leaves over goes before the next
    one's rows.  The result joins back by key.
    """
    key_type = prompts.schema[key].dataType.simpleString()

    def answered(part: pd.DataFrame) -> pd.DataFrame:
        made = model([list(p) for p in part["prompt_ids"]])
        return pd.DataFrame(
            {
                key: part[key].to_numpy(),
                "generated_middle": [text for text, _ in made],
                "perplexity": [float(p) for _, p in made],
            }
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            whole = len(rows) // batch_size * batch_size
            for at in range(0, whole, batch_size):
                yield answered(rows.iloc[at : at + batch_size])
            rest = rows.iloc[whole:] if whole < len(rows) else None
        if rest is not None:
            yield answered(rest)

    return prompts.select(key, "prompt_ids").mapInPandas(
        run, f"{key} {key_type}, generated_middle string, perplexity double"
    )
