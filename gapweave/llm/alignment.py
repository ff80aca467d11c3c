"""Alignment of two tokenizers' tokens by the bytes that they cover.

Tokenizer A reads a blank and the text, tokenizer B puts a blank before the text itself.  A batch of
texts becomes list arrays of ids; the ids are flattened with their texts' numbers, segmented sums of
the tokens' sizes give the place where each one ends, and hash joins on (text, end) give the groups
and all overlaps.  A table of the batch counts the texts that link a pair of ids.

Texts are dealt with in blocks of about ``LINKS`` different pairs.  A block writes one row per text
(its pairs as places in the block's list of pairs) and that list with the block's counts.  Spark adds
the counts of all blocks, finds the highest of each A id, and returns them to the blocks, where each
text's sums are taken.  So texts and ids are never shuffled, and what is shuffled grows with the
pairs of a block and not with its links.

Texts that are null, empty, or that one of the tokenizers doesn't spell byte for byte have no
tokens: zeros and an empty text of groups.  Repeated rows and null ids are rows like any other.
Strings of special tokens inside a text are ordinary text.  Vocabulary A is read from its rank file,
which has the ids of ``byte_bpe_50k.json`` and encodes faster; texts with a very long run of white
space, which that library can't read, go through the file itself.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gapweave.llm import arrays, kernels
from gapweave.operators.settle import settle

RANKS_A = public_tokenizers.path("byte_bpe_50k.tiktoken")
FILE_A = public_tokenizers.path("byte_bpe_50k.json")
FILE_B = public_tokenizers.path("piece_bpe_32k.model")
#: Different pairs of all texts of a block, texts of a block, bytes of the texts aligned at once.
LINKS, TEXTS, SLICE_BYTES = 1 << 20, 1 << 16, 1 << 20

_TEXT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, groups_sha256 string"
_BLOCK = "block bigint, places array<int>, times array<int>, first bigint, pairs array<bigint>, documents array<bigint>"


def aligned(docs: DataFrame, with_groups: bool = True, ranks_a: str = RANKS_A, file_a: str = FILE_A, file_b: str = FILE_B) -> DataFrame:
    """The rows of all texts and of all blocks, in one table of ``_TEXT`` and ``_BLOCK``.

    Rows of texts have no ``pairs``.  ``groups`` is null where ``with_groups`` is false.
    """
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.int64()] + [pa.list_(pa.int32())] * 2 + [pa.int64()] + [pa.list_(pa.int64())] * 2
    names = [c.split()[0] for c in f"{_TEXT}, {_BLOCK}".split(", ")]

    def run(batches):
        a, b = kernels.byte_tokens(ranks_a, file_a), kernels.piece_tokens(file_b)
        task, serial = TaskContext.get().partitionId() << 33, 0
        waiting, pairs, size = [], [], 0

        def flush():
            # Texts of a block are numbered in the order in which they wait.
            counts, placed = arrays.pair_dictionary(pa.concat_tables(pairs))
            texts = [pa.concat_arrays([w[k] for w in waiting]) for k in range(7)]
            rows, block = len(texts[0]), task + serial
            places, times = arrays.lists_by_text(placed, rows)
            columns = [*texts, pa.array([block] * rows, pa.int64()), places, times, *(pa.nulls(rows, k) for k in kinds[10:])]
            whole = pa.RecordBatch.from_arrays([pc.cast(c, k) for c, k in zip(columns, kinds)], names)
            for at in range(0, rows, 1000):
                yield whole.slice(at, 1000)
            for at in range(0, counts.num_rows, 1 << 16):
                part = counts.slice(at, 1 << 16).combine_chunks()
                lists = [pa.array([part[c].to_pylist()], pa.list_(pa.int64())) for c in ("pair", "count_all")]
                columns = [*(pa.nulls(1, k) for k in kinds[:7]), pa.array([block]), *(pa.nulls(1, k) for k in kinds[8:10]), pa.array([at]), *lists]
                yield pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for some in arrays.byte_slices(batch, 1, SLICE_BYTES):
                columns, found = arrays.aligned_texts(some.column(1).to_pylist(), a, b, with_groups)
                so_far = sum(len(w[0]) for w in waiting)
                waiting.append([some.column(0), *columns])
                pairs.append(found.set_column(0, "text", pc.cast(pc.add(found["text"], so_far), pa.int32())))
                size += found.num_rows
                if size >= LINKS or so_far + some.num_rows >= TEXTS:
                    yield from flush()
                    serial += 1
                    waiting, pairs, size = [], [], 0
        if waiting:
            yield from flush()

    picked = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return picked.mapInArrow(run, f"{_TEXT}, {_BLOCK}")


def pair_counts(table: DataFrame) -> DataFrame:
    """``pair, documents, best`` of every pair in a table of ``aligned``: in how many texts the pair
    a * 2^32 + b is linked, and whether no pair of its A id is linked in more."""
    listed = table.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "documents")).alias("p"))
    summed = listed.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.documents").alias("documents"))
    summed = settle(summed)
    # One row for each id of vocabulary A, which is fixed: 50 257 rows at most.
    highest = summed.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("documents").alias("highest"))
    joined = summed.join(F.broadcast(highest), F.shiftright("pair", 32) == F.col("a"))
    return joined.select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def alignments(docs: DataFrame, with_groups: bool = True) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, groups_sha256, n_best, count_sum`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  ``groups`` are the groups in
    order as ``a1,a2|b1;a3|b2,b3`` (null unless ``with_groups``).
    """
    table = settle(aligned(docs, with_groups))
    of_pairs = table.where("pairs is not null").select("block", "first", F.posexplode("pairs").alias("at", "pair"))
    answers = of_pairs.join(pair_counts(table), "pair").select(F.col("block").alias("of_block"), (F.col("first") + F.col("at")).alias("place"), "documents", "best")
    texts = table.where("pairs is null").select(*[c.split()[0] for c in _TEXT.split(", ")], "block", "places", "times")
    names = [*[c.split()[0] for c in _TEXT.split(", ")], "n_best", "count_sum"]

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("place").combine_chunks()
        left = left.combine_chunks()
        parts = [left[c].combine_chunks() for c in ("places", "times")]
        best, total = arrays.summed_over_pairs(*parts, right["documents"].combine_chunks(), right["best"].combine_chunks())
        out = left.drop_columns(["block", "places", "times"])
        return out.append_column("n_best", best).append_column("count_sum", total).select(names)

    # A block's texts and its pairs meet in one task; both are bounded by LINKS and TEXTS.
    return texts.groupBy("block").cogroup(answers.groupBy("of_block")).applyInArrow(sums, f"{_TEXT}, n_best bigint, count_sum bigint")
