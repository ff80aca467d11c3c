"""Exact inner-product search with a paged M-tree.

Inner products become distances by one more coordinate: with M the largest norm of the data, x
gets sqrt(M^2 - |x|^2) and a query 0, so that d(q, x)^2 = |q|^2 + M^2 - 2 q.x and the nearest
vector is the one with the largest product.  The tree has a root of routing objects (a bounded
sample) and pages below them: every vector lies under its nearest routing object, and the vectors
of an object are paged in the order of their distance to it, so a page knows its covering radius,
its inner radius and its entries' distances to the parent.

A query is an entry itself: the k-th score within its own page limits its search from the start.
Queries go in blocks, in the tree's order.  A block visits pages in the order of their lower
bounds; a page whose bounds exceed the k-th distance so far of every query is skipped, and within
a page only entries are scored whose stored distance to the parent lets them come closer.

Pages and blocks meet in pieces of bounded size: a slice of pages travels once for ``BLOCKS`` blocks,
a block once for each slice, and neither with the other.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from gapweave.llm import kernels
from gapweave.llm.common import number_rows
from gapweave.operators.settle import settle

PAGE = 1024  # vectors
QUERIES = 1024  # per block
BLOCKS = 16  # that share a copy of a page
#: Components of the vectors of a slice; each slice is searched by itself.
SLICE_VALUES = 1 << 21
#: The root's routing objects come from this many vectors at most.
SAMPLE, ROUTING = 4096, 256


def integer_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, ints`` of the vectors that take part: floor(256 x) of every component."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad).select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("ints")
    )


def _routing(vectors: DataFrame, n: int) -> tuple[np.ndarray, float, int]:
    """Routing objects (rows of a matrix), the largest squared norm and the number of components."""
    squared = F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    facts = vectors.agg(F.max(squared).alias("norm"), F.max(F.size("ints")).alias("width")).first()
    width = facts["width"] or 0
    chance = F.conv(F.substring(F.md5(F.col("vec_id").cast("string")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    sample = vectors.where(chance < SAMPLE / max(n, 1)).orderBy(chance, "vec_id").limit(ROUTING).select("ints").collect()
    objects = np.zeros((len(sample), width))
    for row, found in zip(objects, sample):
        row[: len(found["ints"])] = found["ints"]
    if not len(objects):
        objects = np.zeros((1, width))
    return np.unique(objects, axis=0), float(facts["norm"] or 0.0), width


def _kind(top: float) -> str:
    """The narrowest type that holds every component of vectors up to this squared norm."""
    return next((kind for kind, bits in (("<i2", 15), ("<i4", 31)) if top < 4.0 ** (bits - 1)), "<i8")


def build(rows: DataFrame, is_query, k: int) -> tuple[DataFrame, int, np.ndarray, float, int, str]:
    """The pages of the tree, how many full ones the vectors make, the routing objects, the largest
    squared norm, the width, the type of a packed component.

    A page is a row ``page, parent, inner, outer, numbers, ids, ints, distances, asked, floors`` of
    packed arrays; the last two are the places of its queries and their k-th scores within the page.
    """
    vectors = settle(integer_vectors(rows))
    n = vectors.count()
    objects, top, width = _routing(vectors, n)
    kind = _kind(top)

    def place(batches):
        return kernels.place_vectors(batches, objects, top, width, kind)

    def pack(group):
        return kernels.pack_page(group, top, width, kind, k)

    entries = number_rows(
        settle(vectors.mapInArrow(place, "vec_id bigint, ints binary, parent int, distance double")),
        [F.col("parent"), F.col("distance"), F.col("vec_id")],
        "number",
    )
    pages = (
        entries.withColumn("page", F.floor(F.col("number") / PAGE))
        .withColumn("asked", F.coalesce(is_query, F.lit(False)))
        .groupBy("page", "parent")  # a page of the order may hold the last of one object and the first of the next
        .applyInArrow(
            pack,
            "page bigint, parent int, inner double, outer double, numbers binary, ids binary, ints binary, distances binary, "
            "asked binary, floors binary",
        )
    )
    return settle(pages), -(-n // PAGE), objects, top, width, kind


def _each(n: int):
    """A row for each number below ``n``, one row at least."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(n - 1, 0)).cast("bigint")))


def search(rows: DataFrame, is_query, k: int = 5, slices: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of every query.

    ``rows`` needs ``vec_id`` and ``embedding``; other columns are ignored.  Vectors that are
    null or hold null or non-finite components take no part, nor do those without an id; shorter
    vectors count as filled with zeros.  A row is no candidate for itself, other rows with its id
    are.  Ties go to the smaller id.  Sums beyond 64 bits are undefined.
    """
    pages, n_pages, objects, top, width, kind = build(rows, is_query, k)
    in_slice = -(-n_pages // slices) if slices else SLICE_VALUES // (PAGE * max(width, 1))
    in_slice = max(in_slice, 1)

    def queries(batches):
        return kernels.queries_of_pages(batches, width, kind)

    def meet(some, blocks):
        return kernels.search_pages(some, blocks, objects, top, width, kind, k)

    asked = number_rows(
        settle(
            pages.select("numbers", "ids", "ints", "asked", "floors").mapInArrow(
                queries, "number bigint, vec_id bigint, ints binary, floor bigint"
            )
        ),
        [F.col("number")],
        "place",
    )
    n_blocks = -(-asked.count() // QUERIES)
    blocks = (
        asked.withColumn("block", F.floor(F.col("place") / QUERIES))
        .groupBy("block")
        .applyInArrow(kernels.pack_block, "block bigint, q_numbers binary, q_ids binary, q_floors binary, q_ints binary")
    )
    some = pages.drop("asked", "floors").select(
        "*",
        F.floor(F.col("page") / in_slice).alias("slice"),
        _each(-(-n_blocks // BLOCKS)).alias("bundle"),
    )
    wanted = blocks.select(
        "*",
        F.floor(F.col("block") / BLOCKS).alias("bundle"),
        _each(-(-n_pages // in_slice)).alias("slice"),
    )
    found = (
        some.groupBy("slice", "bundle")
        .cogroup(wanted.groupBy("slice", "bundle"))
        .applyInArrow(meet, "number bigint, query_id bigint, vec_id bigint, score bigint")
    )
    # k rows of each slice at most per query.
    ranked = found.groupBy("number", "query_id").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("vec_id").alias("vec_id"), F.col("score").alias("score")))), 1, k).alias("best")
    )
    return ranked.select("query_id", F.posexplode("best").alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score")
    )
