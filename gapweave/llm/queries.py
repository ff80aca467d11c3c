"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gapweave.llm import alignment, embeddings, exact, infill, languages, licenses, minhash, mixing, packing, pii, repeats, sharding, topk

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents; the ids are reduced to their checksum before the numbering."""
    cut = packing.pieces(table(spark, folder, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.sequences(cut)


@query("op7_sharding")
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents on eight shards under the law ``rows``."""
    return sharding.shard_rows(table(spark, folder, "documents"), 8).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )


@query("op3_mixing", mixing.MIX_SQL)
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken"
    )


@query("op9_licenses", licenses.SCAN_SQL)
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Licences of all documents."""
    return licenses.scan(table(spark, folder, "documents"))


@query("op5_pii")
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of all documents."""
    found = pii.personal_data(table(spark, folder, "documents"), support=1)
    counts = [F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listing(tuple(pii.KINDS)), 256).alias("base_sha256"),
        pii.listing((*pii.KINDS, "term")).alias("spans"),
    )


@query("op4_language")
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Languages of all documents; what was learnt excludes the held-out fifth."""
    docs = table(spark, folder, "documents")
    found = languages.identify(docs, languages.train(docs))
    return found.withColumn("held_out", languages.held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score")


@query("op8_embeddings")
def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near-equal embeddings of a label."""
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


TOPK_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.n AS n, q.vec_id AS query_id, x.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.ints, x.ints), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v x ON q.n <> x.n WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op10_topk", TOPK_SQL)
def op10_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector."""
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op6_minhash")
def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    return minhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "kept")


@query("op2_repeats")
def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without their repeated strings of 200 bytes."""
    return repeats.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


@query("op12_infill", infill.INFILL_SQL)
def op12_infill(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with a middle moved to the end, and the texts rebuilt from that."""
    rows = infill.infill(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("bigint").alias("prefix_chars"),
        F.length("middle").cast("bigint").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query("op11_exact", exact.EXACT_SQL)
def op11_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts among all documents."""
    return exact.duplicates(table(spark, folder, "documents"))


@query("op13_alignment")
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers over all documents."""
    return alignment.alignments(table(spark, folder, "documents"), with_groups=False).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
