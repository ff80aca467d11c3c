"""Embedding near-duplicates by random-hyperplane sign hashing.

Equal vectors of a label are one class first.  Every class gets one sign code per table; classes
that share a code in a table are compared exactly, in blocks of bounded size, so that a bucket
may be as large as it likes.  Each pair is counted in the first table that brings it together.
Links of classes give the counts, and distributed connected components the groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gapweave.llm import kernels
from gapweave.llm.common import smallest_reachable
from gapweave.operators.settle import settle

#: At a cosine of 0.98 one table of 16 planes catches a pair with probability 0.35, all 24 miss it with 0.00004.
TABLES, BITS, SEED = 24, 16, 20
LEAST_COSINE = 0.98
BLOCK = 512  # classes per side of a comparison


def usable(label: str, vector: str):
    """Vectors that can link: a label, finite components, none null, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(label).isNotNull() & F.col(vector).isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def classes(rows: DataFrame) -> DataFrame:
    """``class_id, label, embedding, members, first_id`` of the distinct vectors of each label."""
    return settle(
        rows.where(usable("label", "embedding"))
        .groupBy("label", "embedding")
        .agg(F.count(F.lit(1)).alias("members"), F.min("vec_id").alias("first_id"))
        .withColumn("class_id", F.monotonically_increasing_id())
    )


def _with_codes(distinct: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            codes, packed = [None] * len(vectors), [None] * len(vectors)
            for width in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == width]
                block = np.array([vectors[i] for i in at], dtype=np.float64)
                scaled = block / np.abs(block).max(axis=1, keepdims=True)
                for i, row, code in zip(at, block, kernels.sign_codes(scaled, tables, bits, seed)):
                    codes[i], packed[i] = code.tolist(), row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(v) for v in vectors], pa.int32()),
                    pa.array(packed, pa.binary()),
                    batch.column(3),
                    pa.array(codes, pa.list_(pa.int32())),
                ],
                ["class_id", "label", "width", "vector", "members", "codes"],
            )

    label = distinct.schema["label"].dataType.simpleString()
    return distinct.select("class_id", "label", "embedding", "members").mapInArrow(
        run, f"class_id bigint, label {label}, width int, vector binary, members bigint, codes array<int>"
    )


def links(distinct: DataFrame, tables: int = TABLES, bits: int = BITS, seed: int = SEED, least_cosine: float = LEAST_COSINE, block: int = BLOCK) -> DataFrame:
    """``class_id, linked, first_class``: partial counts of vectors linked to a class, and a class reached."""
    coded = settle(_with_codes(distinct, tables, bits, seed))
    bucket = ["label", "width", "table", "code"]
    placed = coded.select("class_id", "label", "width", F.posexplode("codes").alias("table", "code"))
    crowded = placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # A bucket of several blocks is compared block by block: every class goes to each pair with its own block.
    dealt = (
        placed.join(crowded, bucket)
        .withColumn("blocks", F.ceil(F.col("n") / block))
        .withColumn("own", F.pmod(F.xxhash64("class_id"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .select("class_id", *bucket, "own", "low", "high")
    )
    group = [*bucket, "low", "high"]
    full = (
        dealt.join(coded.select("class_id", "vector", "members", "codes"), "class_id")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .select(F.struct(*[F.col(c) for c in group]).alias("group"), "table", "low", "high", "own", "class_id", "vector", "members", "codes")
    )

    def compare(rows):
        key, table, low, high = rows[0][:4]
        vectors = np.frombuffer(b"".join(r[6] for r in rows), dtype=np.float64).reshape(len(rows), -1)
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        own = np.array([r[4] for r in rows])
        codes = np.array([r[8] for r in rows])
        counts, first = kernels.linked_in_bucket(
            vectors, np.array([r[7] for r in rows]), codes, table, own == low, own == high, least_cosine
        )
        return [(r[5], int(n), rows[f][5]) for r, n, f in zip(rows, counts, first) if n]

    def run(batches):
        waiting = []
        for batch in batches:
            found = []
            keys = batch.column(0).to_pylist()
            for row in zip(keys, *[batch.column(k).to_pylist() for k in range(1, 9)]):
                if waiting and waiting[0][0] != row[0]:
                    found += compare(waiting) if len(waiting) > 1 else []
                    waiting = []
                waiting.append(row)
            if found:
                yield _links(found)
        if len(waiting) > 1 and (found := compare(waiting)):
            yield _links(found)

    def _links(found):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["class_id", "linked", "first_class"])

    return full.mapInArrow(run, "class_id bigint, linked bigint, first_class bigint")


def near_duplicates(rows: DataFrame, **options) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    ``rows`` needs ``vec_id``, ``embedding`` and ``label``; other columns are ignored.  Vectors
    without a label, null, zero or with null or non-finite components link with nothing; so do
    vectors of different lengths.  Equal vectors of a label link with each other.  Rows with a null
    id count as links but never name a component; where no row of a component has an id the
    component is null.  An empty table gives no rows.
    """
    distinct = classes(rows)
    found = settle(links(distinct, **options))
    counts = found.groupBy("class_id").agg(F.sum("linked").alias("linked"))
    edges = found.select(F.col("class_id").alias("u"), F.col("first_class").alias("v")).where("u <> v").distinct()
    roots = settle(smallest_reachable(edges))
    rooted = distinct.join(roots, F.col("node") == F.col("class_id"), "left").withColumn("root", F.coalesce("root", "class_id"))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    facts = settle(
        rooted.join(firsts, "root")
        .join(counts, "class_id", "left")
        .select(
            "label",
            "embedding",
            (F.col("members") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
            "component_id",
            F.lit(True).alias("linkable"),
        )
    )
    return (
        rows.select("vec_id", "embedding", "label")
        .join(facts, ["label", "embedding"], "left")
        .withColumn("component_id", F.when(F.col("linkable"), F.col("component_id")).otherwise(F.col("vec_id")))
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            "component_id",
            F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )
