"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

Equal texts are one node.  A node's sketch of weighted samples is cut into bands; nodes that share
a band are candidates.  Not all pairs of a band are compared: every band has a pivot, the member
with the most company over all its bands, and all members are compared with it.  Two members
similar to the pivot are connected by it.  A member that isn't can only be similar to one that
differs from the pivot in nearly the same shingles: such pairs meet by their rarest differences
(prefix and positional filtering, without loss; a shingle of one row only is no such difference),
and are compared in a second round.  A comparison is the exact
weighted Jaccard similarity of the whole texts.

Document counts for the IDF are those of the single 64-bit shingles over all documents.  Shingles
travel in order of size, packed by chunk of texts and part of their range; what comes back to a chunk
are the counts in that order, and the texts' own shingles tell whose they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from gapweave.llm import kernels
from gapweave.llm.common import as_row, row_columns, smallest_reachable
from gapweave.operators.settle import settle, settle_last

LEAST_SIMILARITY = 0.8
#: At a similarity of 0.8 all 12 bands of 3 samples miss a pair with probability 0.0004.
BANDS, ROWS, SEED = 12, 3, 41
#: Characters of text for a part of the shingles, and bytes of texts (a row has 32 besides) for a chunk.
PART_CHARACTERS, CHUNK = 8 << 20, 4 << 20


def with_frequencies(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, text, common, documents, bands`` for every row of ``docs``.

    ``common`` marks the distinct shingles of the text (rising) that more than one row has, a bit each,
    ``documents`` tells in how many rows each of these occurs (kernels.planes).  ``bands`` are those of
    the text's sketch; a text without words has none.
    """
    return settle_last(lambda: _with_frequencies(docs))


def _with_frequencies(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", text_digest().alias("digest"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = CHUNK

    def number(batches):
        first, filled = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            if batch.num_rows:
                sizes = pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False).astype(np.int64) + 32
                ends = filled + np.cumsum(sizes)
                filled = ends[-1]
                yield batch.append_column("chunk", pa.array(first + (ends - sizes) // size, pa.int64()))

    chunked = settle(texts.mapInArrow(number, "doc_id bigint, digest binary, text string, chunk bigint"))
    total, characters = chunked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = 8 + characters // PART_CHARACTERS

    def batch_of(rows, names, kinds):
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names=names)

    def deal(batches):
        names, kinds = ["part", "chunk", "shingles"], [pa.int32(), pa.int64(), pa.binary()]
        last, found = None, []

        def flush():
            rows = [(part, last, steps) for part, steps in kernels.dealt_steps(np.sort(np.concatenate(found)), parts)]
            return batch_of(rows, names, kinds)

        for batch in kernels.slices(batches):
            for chunk, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if chunk != last and found:
                    yield flush()
                    found = []
                last = chunk
                some, _ = kernels.shingles(text)
                if len(some):
                    found.append(some)
        if found:
            yield flush()

    def count(batches):
        names, kinds = ["chunk", "part", "documents"], [pa.int64(), pa.int32(), pa.binary()]
        for part, kept in kernels.grouped_rows(batches):
            chunks, values = kernels.merged_steps(kept)
            _, inverse, counts = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
            bounds = np.cumsum([0, *map(len, values)])
            for low in range(0, len(chunks), 1000):
                rows = [
                    (chunks[k], part, kernels.planes(counts[inverse[bounds[k] : bounds[k + 1]]]))
                    for k in range(low, min(low + 1000, len(chunks)))
                ]
                yield batch_of(rows, names, kinds)

    def gather(texts, counted):
        order = np.argsort(counted.column("part").to_numpy())
        answers = counted.column("documents").to_pylist()
        n = np.concatenate([kernels.from_planes(answers[k]) for k in order] or [np.zeros(0, dtype=np.uint64)])
        found, times = zip(*(kernels.shingles(text) for text in texts.column("text").to_pylist()))
        counts = np.empty(len(n), dtype=np.uint64)
        counts[np.argsort(np.concatenate(found))] = n  # equal shingles have equal counts
        of_text = np.split(counts, np.cumsum([len(f) for f in found])[:-1])
        sampler = kernels.once("sampler", lambda: kernels.ConsistentSampler(BANDS * ROWS, SEED))
        bands = [
            kernels.band_hashes(sampler.sketch(f, t * kernels.rarity(own.astype(float), total)), ROWS).view(np.int64) if len(f) else None
            for f, t, own in zip(found, times, of_text)
        ]
        common, documents = (pa.array(c, pa.binary()) for c in zip(*map(kernels.marked_counts, of_text)))
        out = texts.drop_columns(["chunk"]).append_column("common", common).append_column("documents", documents)
        return out.append_column("bands", pa.array(bands, pa.list_(pa.int64())))

    # A chunk may be read by several tasks: what they send of it is merged before it is answered.
    dealt = chunked.select("chunk", "text").mapInArrow(deal, "part int, chunk bigint, shingles binary")
    ordered = dealt.repartition(parts, "part").sortWithinPartitions("part", "chunk")
    counted = settle(ordered.mapInArrow(count, "chunk bigint, part int, documents binary"))
    form = "doc_id bigint, digest binary, text string, common binary, documents binary, bands array<bigint>"
    return chunked.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(gather, form)


def text_digest():
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def _with_texts(pairs: DataFrame, nodes: DataFrame, rich: DataFrame) -> DataFrame:
    """``a, b`` and the texts with their frequencies of distinct pairs of digests."""
    pairs = settle(pairs)
    wanted = pairs.select(F.col("a").alias("digest")).union(pairs.select("b")).distinct()
    rows = nodes.join(wanted, "digest").select(F.col("digest").alias("of_digest"), F.col("first_id").alias("of"))
    # One row of the table for each text that is asked for (repeated rows give the same answers twice).
    texts = settle(
        rich.join(rows, (F.col("of_digest") == F.col("digest")) & F.col("of").eqNullSafe(F.col("doc_id"))).select(
            "digest", "text", "common", "documents"
        )
    )
    names = ["text", "common", "documents"]
    side = lambda k: texts.select(F.col("digest").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in names])
    columns = [f"{c}_{k}" for k in ("a", "b") for c in names]
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", *columns)


def _compared_with_pivots(pairs: DataFrame, nodes: DataFrame, rich: DataFrame, total: int, least: float) -> DataFrame:
    """``a, b, similar, need, leading, behind, beside`` (kernels.difference_prefixes) for pivots ``a`` and members ``b``."""
    names = ["a", "b", "similar", "need", "leading", "behind", "beside"]
    kinds = [pa.binary(), pa.binary(), pa.bool_(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.int32()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

    def run(batches):
        rows, once_only = [], float(kernels.rarity(1.0, total))
        for a, left, b, right in kernels.compared_pairs(batches, total):
            similarity, *found = kernels.difference_prefixes(left, right, least, once_only)
            rows.append((a, b, similarity >= least, *found))
            if len(rows) >= 1000:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    form = "a binary, b binary, similar boolean, need double, leading array<bigint>, behind array<double>, beside int"
    return settle_last(lambda: _with_texts(pairs, nodes, rich).mapInArrow(run, form))


def _links(pairs: DataFrame, nodes: DataFrame, rich: DataFrame, total: int, least: float) -> DataFrame:
    """The pairs ``u, v`` whose whole texts have at least the wanted weighted Jaccard similarity."""

    def run(batches):
        found = [
            (a, b)
            for a, left, b, right in kernels.compared_pairs(batches, total)
            if kernels.weighted_jaccard(left, right) >= least
        ]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], ["u", "v"])

    return settle_last(lambda: _with_texts(pairs, nodes, rich).mapInArrow(run, "u binary, v binary"))


def near_duplicates(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """``doc_id, digest, class_id, kept`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored.  Rows are in one class when
    a chain of texts with similarity ``least`` or more connects them; ``class_id`` is the smallest
    id of the class.  Texts without words (null, empty, white space) are classes of their own.
    ``kept`` marks the rows with the class's id and the smallest digest among these: one row, or
    equal rows where the table repeats a row.  Where all ids of a class are null so is its id, and
    its rows of smallest digest are kept.
    """
    return settle_last(lambda: _near_duplicates(docs, least))


def _near_duplicates(docs: DataFrame, least: float) -> DataFrame:
    rich = with_frequencies(docs)
    total = rich.count()
    rows = rich.select("doc_id", "digest", "bands")
    nodes = settle(
        rows.where(F.col("bands").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"))
    )
    members = nodes.select("digest", F.posexplode("bands").alias("band", "hash"))
    crowded = members.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = settle(members.join(crowded, ["band", "hash"]))
    company = placed.groupBy("digest").agg(F.sum("n").alias("company"))
    pivots = (
        placed.join(company, "digest")
        .groupBy("band", "hash")
        .agg(F.max_by("digest", F.struct("company", "digest")).alias("pivot"))
    )
    centred = settle(placed.join(pivots, ["band", "hash"]))
    first = centred.where("pivot <> digest").select(F.col("pivot").alias("a"), F.col("digest").alias("b")).distinct()
    compared = _compared_with_pivots(first, nodes, rich, total, least)
    links = compared.where("similar").select(F.col("a").alias("u"), F.col("b").alias("v"))

    # Second round: members that are not similar to a pivot, with the other members of its bands.
    of = settle(smallest_reachable(links))
    labelled = compared.join(of.select(F.col("node").alias("b"), "root"), "b", "left").withColumn("root", F.coalesce("root", "b"))
    places = labelled.select("*", F.posexplode("leading").alias("place", "shingle")).withColumn("behind", F.expr("behind[place]"))
    beside = places.where("place < beside").select(
        "a", "shingle", F.col("b").alias("x"), F.col("root").alias("root_x"), "similar", F.col("need").alias("need_x"), F.col("behind").alias("behind_x")
    )
    alone = places.where("not similar").select(
        "a", "shingle", F.col("b").alias("y"), F.col("root").alias("root_y"), F.col("need").alias("need_y"), F.col("behind").alias("behind_y")
    )
    # Two members that are both not similar to the pivot meet one way round.  A pair that can't reach the
    # similarity from a shingle on was either met by an earlier one or isn't similar.
    reached = "least(behind_x, behind_y) >= need_x + need_y - 1e-6"
    second = (
        beside.join(alone, ["a", "shingle"])
        .where(f"root_x <> root_y and (similar or x < y) and {reached}")
        .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    )
    more = _links(second.distinct(), nodes, rich, total, least)
    roots = smallest_reachable(of.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more))
    return _classes(rows, settle(roots))


def _classes(rows: DataFrame, roots: DataFrame) -> DataFrame:
    node = F.when(F.col("bands").isNotNull(), F.coalesce("root", "digest"))
    labelled = rows.join(roots, F.col("node") == F.col("digest"), "left").select("doc_id", "digest", node.alias("root"))
    classes = (
        labelled.where("root is not null")
        .groupBy("root")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("chosen"))
    )
    joined = labelled.join(classes, "root", "left")
    alone = F.col("root").isNull()
    same_row = F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("digest") == F.col("chosen.digest"))
    return joined.select(
        "doc_id",
        "digest",
        F.when(alone, F.col("doc_id")).otherwise(F.col("chosen.doc_id")).alias("class_id"),
        (alone | same_row).alias("kept"),
    )


def keep_first(docs: DataFrame, least: float = LEAST_SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class; columns unchanged."""
    kept = (
        near_duplicates(docs, least)
        .where("kept")
        .groupBy(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"))
        .agg(F.lit(1).alias("_"))
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A repeated row has its copies in one partition already; texts without words all stay.
    once = F.when(text.rlike(r"\S"), F.lit(0)).otherwise(F.monotonically_increasing_id())
    keyed = as_row(docs, F.col("doc_id"), text_digest().alias("digest"), once.alias("once"))
    joined = keyed.join(kept, (F.col("digest") == F.col("of_digest")) & F.col("doc_id").eqNullSafe(F.col("of")))
    return joined.dropDuplicates(["digest", "doc_id", "once"]).select(*row_columns(docs.columns))
