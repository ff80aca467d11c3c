"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces whose lengths are the binary digits of n (pieces of the
largest length first, as often as they fit).  Every piece is a sequence of its own in the bucket
of its length: no sequence crosses documents and none needs padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from gapweave.llm import kernels
from gapweave.operators.settle import settle

LARGEST = 1024
END_ID = 0
#: The vocabulary of byte_bpe_50k.json as a rank file, which is encoded about five times faster.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
_TEXT_BYTES = 2 << 20  # of texts per output batch

PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, task int, place bigint"


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, largest: int = LARGEST, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens``, and where the task met it:
    ``task, place`` (its place among the task's pieces of that length).

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  ``ids`` are unsigned
    little-endian 32-bit numbers.  Special-token strings in a text are ordinary text.  A null or
    empty text has the end id only; repeated rows and null ids are packed like any other row.
    """

    def run(batches):
        encoder, task, met = kernels.byte_bpe(vocabulary), TaskContext.get().partitionId(), {}
        rows, size = [], 0
        for batch in kernels.slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array(encoder.encode_ordinary(text or "") + [end_id], dtype="<u4")
                start = 0
                for length in kernels.binary_lengths(len(ids), largest):
                    place = met.get(length, 0)
                    met[length] = place + 1
                    rows.append((doc_id, start, length, ids[start : start + length].tobytes(), len(ids), task, place))
                    start += length
                size += len(text or "")
                if size > _TEXT_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _batch(rows):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "task", "place"]
        return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names)

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, PIECES)


def sequences(cut: DataFrame) -> DataFrame:
    """Number the pieces bucket by bucket, longest first, without gaps: ``sequence_id, offset, bucket``.

    A piece fills its sequence, so the offset is 0 and the bucket is the piece's length.  The
    pieces are written once, as they come from the tasks, and never shuffled: a piece's number is
    its place in its task after the pieces of that length in earlier tasks.
    """
    cut = settle(cut)
    counts = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy(F.col("length").desc(), "task").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each length in each task of the scan.
    first = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("bigint").alias("_first"))
    return (
        cut.join(F.broadcast(first), ["length", "task"])
        .withColumn("sequence_id", F.col("_first") + F.col("place"))
        .withColumn("offset", F.lit(0).cast("bigint"))
        .withColumn("bucket", F.col("length"))
        .drop("_first", "task", "place")
    )


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, largest: int = LARGEST, end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids and their sequences."""
    return sequences(pieces(docs, vocabulary, largest, end_id))
