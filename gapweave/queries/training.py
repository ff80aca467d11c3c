"""Examples, tokens, random spans, benchmark rows and the training feed."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gapweave.functions import tokens as T
from gapweave.functions.text import words
from gapweave.operators import feed as Feed, fim as Fim, random_fim as R, summary as Summary, tokens as Tok
from gapweave.operators.settle import shared_folder
from gapweave.operators.splits import split_exact, split_sizes
from gapweave.params import FeedParams, FimParams, Markers
from gapweave.plans.preprocess import corpus_ratio, file_blocks, random_quotas, structural_examples, training_rows, write_training_rows
from gapweave.queries import sql as Q
from gapweave.queries.registry import query
from gapweave.sources.tables import as_files, document_files, table
from gapweave.streaming.incremental import ROW_IDS, run_training

PARAMS = FimParams(
    max_token_sequence_length=1024,
    min_middle_tokens_length=16,
    max_middle_tokens_length=256,
    fim_examples_per_subblock_ratio=0.5,
    rand_to_ast_fim_examples_ratio=0.1,
    rand_examples_per_chunk=4,
)
FEED = FeedParams(trainer_per_device_train_batch_size=2, trainer_gradient_accumulation_steps=8, trainer_num_train_epochs=3)
M = Markers()

BASE = (Q.FILES, Q.ASSIGNED, Q.LINES, Q.BLOCKS)
FIM_SQL = Q.fim(1024, 16, 256, 0.5)
TOKENIZED_SQL = Q.tokenized(1024, 16, 256)
TOKENIZED = Q.with_(*BASE, FIM_SQL, TOKENIZED_SQL)
IDS = "file_id, split, block_id, sub_id"
IDS_MD5 = "md5(array_to_string(ids, ','))"


def assigned_files(spark, folder):
    return split_exact(document_files(spark, folder), ["file_id"])


def ids_md5(column: str = "input_ids"):
    return F.md5(F.array_join(column, ","))


def tokenized_rows(spark, folder):
    return structural_examples(assigned_files(spark, folder), "prose", PARAMS)


# ---------------------------------------------------------------- examples


@query(
    "subblock_sample",
    Q.with_(*BASE, FIM_SQL) + "SELECT file_id, block_id, sub_id, rel_start, rel_end FROM sampled",
)
def subblock_sample(spark, folder):
    blocks = file_blocks(document_files(spark, folder), "prose", PARAMS)
    limited = Fim.within_end_limit(F.col("subblocks"), PARAMS.max_token_sequence_length, F.lit(1.0))
    picks = Fim.sample_subblocks(
        limited, PARAMS.fim_examples_per_subblock_ratio, PARAMS.rng_seed, F.col("file_id"), F.col("block_id")
    )
    return blocks.select("file_id", "block_id", F.explode(picks).alias("s")).select(
        "file_id",
        "block_id",
        F.col("s.sub_id").alias("sub_id"),
        F.col("s.rel_start").alias("rel_start"),
        F.col("s.rel_end").alias("rel_end"),
    )


@query(
    "fim_text",
    Q.with_(*BASE, FIM_SQL)
    + """SELECT file_id, block_id, sub_id, strlen(middle)::INTEGER AS middle_bytes, md5('<|fim_prefix|>' || prefix ||
         '<|fim_suffix|>' || suffix || '<|fim_middle|>' || middle || '<|endoftext|>') AS example_md5 FROM examples""",
)
def fim_text(spark, folder):
    blocks = file_blocks(document_files(spark, folder), "prose", PARAMS)
    examples = Fim.fim_examples(blocks, PARAMS, 1.0)
    return examples.select(
        "file_id", "block_id", "sub_id", F.octet_length("middle").alias("middle_bytes"), F.md5("example").alias("example_md5")
    )


RATIO_SQL = f"""
ratio AS (
  SELECT sum(strlen(code)) / sum(n_words)::DOUBLE AS ratio FROM (
    SELECT b.file_id, b.block_id, b.code, len(regexp_extract_all(b.code, '{Q.WORD}')) AS n_words
    FROM blocks b JOIN assigned a USING (file_id) WHERE a.split = 'train'))"""


def word_ratio(spark, folder):
    blocks = file_blocks(assigned_files(spark, folder), "prose", PARAMS)
    return corpus_ratio(blocks.where(F.col("split") == "train"))


@query("bytes_per_token", Q.with_(*BASE, RATIO_SQL) + "SELECT round(ratio, 9) AS ratio FROM ratio")
def bytes_per_token(spark, folder):
    return word_ratio(spark, folder).select(F.round("ratio", 9).alias("ratio"))


@query(
    "fim_middle_estimate",
    Q.with_(*BASE, RATIO_SQL, Q.fim(1024, 16, 256, 0.5, "(SELECT ratio FROM ratio)"))
    + "SELECT file_id, block_id, sub_id, md5(middle) AS middle_md5 FROM examples",
)
def fim_middle_estimate(spark, folder):
    """Estimated middle length from the corpus ratio, a scalar subquery."""
    blocks = file_blocks(document_files(spark, folder), "prose", PARAMS)
    with_ratio = blocks.withColumn("ratio", word_ratio(spark, folder).scalar())
    examples = Fim.fim_examples(with_ratio, PARAMS, F.col("ratio"))
    return examples.select("file_id", "block_id", "sub_id", F.md5("middle").alias("middle_md5"))


@query(
    "block_truncation",
    Q.with_(*BASE)
    + """SELECT b.file_id, b.block_id, least(strlen(b.code), 400)::INTEGER AS n_bytes,
         count(s.sub_id) FILTER (WHERE s.rel_end <= 400) AS n_subblocks
         FROM blocks b LEFT JOIN subs s USING (file_id, block_id) GROUP BY ALL""",
)
def block_truncation(spark, folder):
    cut = Fim.truncate_blocks(file_blocks(document_files(spark, folder), "prose", PARAMS), F.lit(400))
    return cut.select(
        "file_id",
        "block_id",
        F.octet_length("code").alias("n_bytes"),
        F.size("subblocks").cast("bigint").alias("n_subblocks"),
    )


# ---------------------------------------------------------------- tokens


@query(
    "token_ids",
    Q.with_(Q.FILES)
    + f"SELECT file_id, strlen(text)::INTEGER AS n_ids, md5(array_to_string({Q.ids_of('text')}, ',')) AS ids_md5 FROM files",
)
def token_ids(spark, folder):
    ids = document_files(spark, folder).select("file_id", T.encode_text(F.col("text")).alias("ids"))
    return ids.select("file_id", F.size("ids").alias("n_ids"), ids_md5("ids").alias("ids_md5"))


@query("decode_roundtrip", "SELECT doc_id AS file_id, md5(text) AS text_md5 FROM documents")
def decode_roundtrip(spark, folder):
    ids = document_files(spark, folder).select("file_id", T.encode_text(F.col("text")).alias("ids"))
    return ids.select("file_id", F.md5(T.decode_ids(F.col("ids"))).alias("text_md5"))


@query("marker_ids", "SELECT 256 AS prefix_id, 257 AS middle_id, 258 AS suffix_id, count(*) AS n_texts FROM benchmark")
def marker_ids(spark, folder):
    """Marker lookup: each benchmark text between markers starts, splits and ends with the marker ids."""
    marked = F.concat(F.lit(M.prefix), F.col("text"), F.lit(M.suffix + M.middle + M.eos))
    ids = table(spark, folder, "benchmark").select(T.encode_text(marked).alias("ids"))
    n = F.size("ids")
    return ids.groupBy(
        F.get("ids", F.lit(0)).alias("prefix_id"),
        F.get("ids", n - 2).alias("middle_id"),
        F.get("ids", n - 3).alias("suffix_id"),
    ).agg(F.count(F.lit(1)).alias("n_texts"))


VOCABULARY_SQL = f"""
vocabulary AS (
  SELECT token, row_number() OVER (ORDER BY md5('vocabulary:0:' || token), token) + 999 AS id FROM (
    SELECT DISTINCT unnest(regexp_extract_all(text, '{Q.WORD}')) AS token FROM benchmark)),
doc_tokens AS (
  SELECT doc_id AS file_id, unnest(regexp_extract_all(text, '{Q.WORD}')) AS token,
         generate_subscripts(regexp_extract_all(text, '{Q.WORD}'), 1) AS pos FROM documents),
doc_ids AS (
  SELECT d.doc_id AS file_id, coalesce(list(coalesce(v.id, 7) ORDER BY t.pos) FILTER (WHERE t.pos IS NOT NULL), []) AS ids
  FROM documents d LEFT JOIN doc_tokens t ON t.file_id = d.doc_id LEFT JOIN vocabulary v USING (token) GROUP BY d.doc_id)"""


def benchmark_vocabulary(spark, folder):
    from gapweave.functions.keys import shuffle_key
    from gapweave.operators.ranking import rank_within

    tokens = table(spark, folder, "benchmark").select(F.explode(words(F.col("text"))).alias("token")).distinct()
    keyed = tokens.withColumn("_key", shuffle_key("vocabulary", 0, F.col("token")))
    return rank_within(keyed, [], "_key", ["token"]).select("token", (F.col("rank") + 999).alias("id"))


def document_ids(spark, folder):
    docs = document_files(spark, folder).select("file_id", "text")
    return Tok.vocabulary_ids(docs, benchmark_vocabulary(spark, folder), 7, "file_id")


@query(
    "vocab_ids",
    Q.with_(VOCABULARY_SQL) + f"SELECT file_id, len(ids)::INTEGER AS n_ids, {IDS_MD5} AS ids_md5 FROM doc_ids",
)
def vocab_ids(spark, folder):
    return document_ids(spark, folder).select("file_id", F.size("ids").alias("n_ids"), ids_md5("ids").alias("ids_md5"))


@query(
    "vocab_text",
    Q.with_(VOCABULARY_SQL)
    + """SELECT d.doc_id AS file_id, md5(coalesce(string_agg(v.token, ' ' ORDER BY t.pos), '')) AS text_md5
         FROM documents d LEFT JOIN doc_tokens t ON t.file_id = d.doc_id LEFT JOIN vocabulary v USING (token) GROUP BY d.doc_id""",
)
def vocab_text(spark, folder):
    back = Tok.vocabulary_text(document_ids(spark, folder), benchmark_vocabulary(spark, folder), "file_id")
    return back.select("file_id", F.md5("text").alias("text_md5"))


@query(
    "missing_markers",
    Q.with_(VOCABULARY_SQL)
    + """SELECT w.token FROM (VALUES ('<|fim_prefix|>'), ('the'), ('.'), ('<|endoftext|>')) w(token)
         WHERE w.token NOT IN (SELECT token FROM vocabulary)""",
)
def missing_markers(spark, folder):
    return Tok.missing_markers(benchmark_vocabulary(spark, folder), [M.prefix, "the", ".", M.eos])


# ---------------------------------------------------------------- tokenized examples


@query("fim_tokenized", TOKENIZED + f"SELECT {IDS}, len(ids)::INTEGER AS n_ids, {IDS_MD5} AS ids_md5 FROM tokenized")
def fim_tokenized(spark, folder):
    """Flagship: documents to filtered training rows of every split."""
    rows = tokenized_rows(spark, folder)
    return rows.select(
        "file_id", "split", "block_id", "sub_id", F.size("input_ids").alias("n_ids"), ids_md5().alias("ids_md5")
    )


@query(
    "training_arrays",
    TOKENIZED
    + f"""SELECT {IDS}, {IDS_MD5} AS labels_md5, repeat('1', len(ids)) AS mask FROM tokenized""",
)
def training_arrays(spark, folder):
    rows = tokenized_rows(spark, folder)
    return rows.select(
        "file_id",
        "split",
        "block_id",
        "sub_id",
        ids_md5("labels").alias("labels_md5"),
        F.array_join("attention_mask", "").alias("mask"),
    )


@query(
    "total_length_filter",
    Q.with_(*BASE, FIM_SQL, Q.tokenized(300, 0, 100000))
    + f"SELECT {IDS}, len(ids)::INTEGER AS n_ids FROM tokenized",
)
def total_length_filter(spark, folder):
    blocks = file_blocks(assigned_files(spark, folder), "prose", PARAMS)
    ids = Fim.fim_examples(blocks, PARAMS, 1.0).withColumn("input_ids", T.encode_text(F.col("example")))
    limit = FimParams(max_token_sequence_length=300, min_middle_tokens_length=0, max_middle_tokens_length=100000)
    return Fim.length_filters(ids, limit).select(
        "file_id", "split", "block_id", "sub_id", F.size("input_ids").alias("n_ids")
    )


@query(
    "middle_length_filter",
    Q.with_(*BASE, FIM_SQL, Q.tokenized(100000, 40, 60))
    + f"SELECT {IDS}, (len(ids) - list_position(ids, 257) - 1)::INTEGER AS middle_ids FROM tokenized",
)
def middle_length_filter(spark, folder):
    blocks = file_blocks(assigned_files(spark, folder), "prose", PARAMS)
    ids = Fim.fim_examples(blocks, PARAMS, 1.0).withColumn("input_ids", T.encode_text(F.col("example")))
    limit = FimParams(max_token_sequence_length=100000, min_middle_tokens_length=40, max_middle_tokens_length=60)
    kept = Fim.length_filters(ids, limit)
    return kept.select(
        "file_id", "split", "block_id", "sub_id", T.tail_middle_length(F.col("input_ids")).alias("middle_ids")
    )


# ---------------------------------------------------------------- chunks and random spans

CHUNKS_SQL = """
hexed AS (SELECT file_id, split, hex(encode(text)) AS h, strlen(text) AS n FROM assigned),
edges AS (
  SELECT file_id, split, h, n, unnest(CASE WHEN n > 1228 THEN range(0, n - 1228 + 1, 1228) ELSE [0] END) AS pos FROM hexed),
moved AS (
  SELECT *, pos // 1228 AS chunk_no,
    list_filter([0, 1, 2, 3], lambda d: NOT regexp_matches(substr(h, 2 * (pos + d) + 1, 1), '[89AB]'))[1] AS skip,
    list_filter([0, 1, 2, 3], lambda d: NOT regexp_matches(substr(h, 2 * (pos + 1228 - d) + 1, 1), '[89AB]'))[1] AS back
  FROM edges),
chunks AS (
  SELECT file_id, split, chunk_no, CASE WHEN n <= 1228 THEN h
         ELSE substr(h, 2 * (pos + skip) + 1, 2 * (1228 - back - skip)) END AS h
  FROM moved)"""

POOL_SQL = """
draws AS (
  SELECT file_id, split, chunk_no, draw, least(length(h) // 2, 1020) AS n_ids, h,
         16 + ('0x' || substr(md5('length:0:' || file_id::VARCHAR || ':' || chunk_no::VARCHAR || ':' || draw::VARCHAR), 1, 8))::BIGINT % 241 AS length
  FROM chunks, range(4) d(draw)),
pool AS (
  SELECT file_id, split, chunk_no, draw, n_ids, length, substr(h, 1, 2 * n_ids) AS h,
         10 + ('0x' || substr(md5('start:0:' || file_id::VARCHAR || ':' || chunk_no::VARCHAR || ':' || draw::VARCHAR), 1, 8))::BIGINT
              % (n_ids - length - 20 + 1) AS start
  FROM draws WHERE length <= n_ids - 20),
quotas AS (SELECT split, floor(count(*) * 0.1::DOUBLE) AS quota FROM tokenized GROUP BY split),
chosen AS (
  SELECT p.* FROM (
    SELECT *, row_number() OVER (PARTITION BY split ORDER BY
       md5('pool:0:' || file_id::VARCHAR || ':' || chunk_no::VARCHAR || ':' || draw::VARCHAR), file_id, chunk_no, draw) AS place
    FROM pool) p JOIN quotas q USING (split) WHERE place <= quota),
random_rows AS (
  SELECT file_id, split, chunk_no, draw,
         list_concat([256], ids[1:start], [258], ids[start + length + 1:], [257], ids[start + 1:start + length], [260]) AS ids
  FROM (SELECT *, list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::INTEGER) AS ids FROM chosen))"""


def chunk_window():
    return R.window_bytes(PARAMS.max_token_sequence_length, F.lit(1.0))


@query(
    "byte_chunks",
    Q.with_(*BASE, CHUNKS_SQL)
    + "SELECT file_id, chunk_no::INTEGER AS chunk_no, (length(h) // 2)::INTEGER AS n_bytes, md5(decode(unhex(h))) AS chunk_md5 FROM chunks",
)
def byte_chunks(spark, folder):
    chunks = R.byte_chunks(document_files(spark, folder), chunk_window())
    return chunks.select(
        "file_id", "chunk_no", F.octet_length("bytes").alias("n_bytes"), F.md5("bytes").alias("chunk_md5")
    )


@query(
    "random_spans",
    Q.with_(*BASE, CHUNKS_SQL, FIM_SQL, TOKENIZED_SQL, POOL_SQL)
    + """SELECT file_id, chunk_no::INTEGER AS chunk_no, draw::INTEGER AS draw, start::INTEGER AS start,
         length::INTEGER AS length FROM pool""",
)
def random_spans(spark, folder):
    chunks = R.byte_chunks(document_files(spark, folder), chunk_window())
    return R.random_pool(chunks, PARAMS).select("file_id", "chunk_no", "draw", "start", "length")


@query(
    "random_quota",
    Q.with_(*BASE, CHUNKS_SQL, FIM_SQL, TOKENIZED_SQL, POOL_SQL)
    + f"""SELECT file_id, split, chunk_no::INTEGER AS chunk_no, draw::INTEGER AS draw, {IDS_MD5} AS ids_md5 FROM random_rows""",
)
def random_quota(spark, folder):
    files = assigned_files(spark, folder)
    quotas = random_quotas(structural_examples(files, "prose", PARAMS), PARAMS)
    rows = R.random_examples(files.select("file_id", "split", "content"), chunk_window(), PARAMS, quotas)
    return rows.select("file_id", "split", "chunk_no", "draw", ids_md5().alias("ids_md5"))


@query(
    "fim_union",
    Q.with_(*BASE, CHUNKS_SQL, FIM_SQL, TOKENIZED_SQL, POOL_SQL)
    + f"""SELECT split, kind, count(*) AS n, sum(len(ids))::BIGINT AS n_ids FROM (
            SELECT split, 'structural' AS kind, ids FROM tokenized UNION ALL SELECT split, 'random', ids FROM random_rows)
          GROUP BY split, kind""",
)
def fim_union(spark, folder):
    rows = training_rows(document_files(spark, folder), "prose", params=PARAMS)
    return rows.groupBy("split", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("input_ids")).alias("n_ids")
    )


@query(
    "kept_examples",
    Q.with_(*BASE, CHUNKS_SQL, FIM_SQL, TOKENIZED_SQL, POOL_SQL)
    + """SELECT s.split, (SELECT count(*) FROM examples e JOIN assigned a USING (file_id) WHERE a.split = s.split) AS n_examples,
         (SELECT count(*) FROM tokenized t WHERE t.split = s.split) AS n_structural,
         (SELECT count(*) FROM random_rows r WHERE r.split = s.split) AS n_random
         FROM (SELECT unnest(['train', 'eval', 'test']) AS split) s""",
)
def kept_examples(spark, folder):
    """The training rows written to the shared folder; the counts are those of the writing jobs."""
    out = f"{shared_folder(spark)}/examples-{uuid.uuid4().hex}"
    return write_training_rows(document_files(spark, folder), "prose", out, fmt="parquet", params=PARAMS)


THRESHOLD_ASSIGNED = """
assigned AS (
  SELECT file_id, path, lang, text, CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.9::DOUBLE THEN 'eval' ELSE 'test' END AS split
  FROM (SELECT *, CAST('0x' || substr(md5('split:0:' || file_id::VARCHAR), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM files))
"""


@query(
    "stream_rows",
    Q.with_(Q.FILES, THRESHOLD_ASSIGNED, Q.LINES, Q.BLOCKS, CHUNKS_SQL, FIM_SQL, TOKENIZED_SQL, POOL_SQL)
    + f"""SELECT split, 'structural' AS kind, file_id, block_id::BIGINT AS part_no, sub_id::BIGINT AS item_no, {IDS_MD5} AS ids_md5 FROM tokenized
          UNION ALL SELECT split, 'random', file_id, chunk_no::BIGINT, draw::BIGINT, {IDS_MD5} FROM random_rows""",
)
def stream_rows(spark, folder):
    """Documents as a stream, one file a trigger, to structural and random rows; read back from the tables."""
    schema = table(spark, folder, "documents").schema
    # The glob makes one file and a folder of files read alike.
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/documents.parque[t]")
    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    run_training(as_files(stream), "prose", f"{out}/rows", f"{out}/checkpoint", params=PARAMS)
    kinds = [
        spark.read.parquet(f"{out}/rows/{kind}").select(
            "split", F.lit(kind).alias("kind"), "file_id", *[F.col(c).cast("bigint").alias(n) for c, n in zip(ids, ("part_no", "item_no"))],
            ids_md5().alias("ids_md5"),
        )
        for kind, ids in ROW_IDS.items()
    ]
    return kinds[0].unionByName(kinds[1])


# ---------------------------------------------------------------- benchmark rows

ORDERED_IDS = "md5('bench:42:' || file_id::VARCHAR || ':' || block_id::VARCHAR || ':' || sub_id::VARCHAR)"
BENCH_SQL = f"""
bench AS (
  SELECT * FROM tokenized WHERE split = 'test' ORDER BY {ORDERED_IDS}, file_id, block_id, sub_id LIMIT 50),
cut AS (
  SELECT file_id, block_id, sub_id, ids, ids[2:list_position(ids, 258) - 1] AS pre,
         ids[list_position(ids, 258) + 1:list_position(ids, 257) - 1] AS suf,
         ids[list_position(ids, 257) + 1:list_position(ids, 260) - 1] AS mid FROM bench),
labelled AS (
  SELECT *, list_concat([256], pre, [258], suf, [257]) AS prompt FROM cut)"""
BENCH = Q.with_(*BASE, FIM_SQL, TOKENIZED_SQL, BENCH_SQL)
ROW_ID = ["file_id", "block_id", "sub_id"]


def id_text(ids: str) -> str:
    return f"decode(unhex(array_to_string(list_transform({ids}, lambda x: lpad(to_hex(x), 2, '0')), '')))"


def bench_rows(spark, folder):
    test = tokenized_rows(spark, folder).where(F.col("split") == "test")
    return Tok.benchmark_sample(test, 50, ids=tuple(ROW_ID))


def bench_parts(spark, folder):
    return Tok.fim_parts(bench_rows(spark, folder), keep=tuple(ROW_ID))


@query("benchmark_sample", BENCH + f"SELECT file_id, block_id, sub_id, {IDS_MD5} AS ids_md5 FROM bench")
def benchmark_sample(spark, folder):
    return bench_rows(spark, folder).select(*ROW_ID, ids_md5().alias("ids_md5"))


@query(
    "fim_parts",
    TOKENIZED
    + """, parts AS (SELECT file_id, block_id, sub_id, ids[2:list_position(ids, 258) - 1] AS pre,
         ids[list_position(ids, 258) + 1:list_position(ids, 257) - 1] AS suf,
         ids[list_position(ids, 257) + 1:list_position(ids, 260) - 1] AS mid FROM tokenized) """
    + f"""SELECT file_id, block_id, sub_id, len(pre)::INTEGER AS n_prefix, len(suf)::INTEGER AS n_suffix,
          len(mid)::INTEGER AS n_middle, md5({id_text('pre')}) AS prefix_md5, md5({id_text('suf')}) AS suffix_md5,
          {id_text('mid')} AS middle FROM parts""",
)
def fim_parts(spark, folder):
    parts = Tok.fim_parts(tokenized_rows(spark, folder), keep=tuple(ROW_ID))
    return parts.select(
        *ROW_ID,
        F.size("prefix_token_ids").alias("n_prefix"),
        F.size("suffix_token_ids").alias("n_suffix"),
        F.size("middle_token_ids").alias("n_middle"),
        F.md5("prefix").alias("prefix_md5"),
        F.md5("suffix").alias("suffix_md5"),
        "middle",
    )


DAMAGED_SQL = """
damaged AS (
  SELECT file_id, split, block_id, sub_id, k,
         CASE k WHEN 0 THEN ids WHEN 1 THEN list_filter(ids, lambda x: x <> 257) WHEN 2 THEN list_reverse(ids)
                ELSE ids[1:len(ids) - 1] END AS ids
  FROM (SELECT *, ('0x' || substr(md5('wreck:0:' || file_id::VARCHAR || ':' || block_id::VARCHAR || ':' || sub_id::VARCHAR), 1, 8))::BIGINT % 4 AS k
        FROM tokenized))"""


@query(
    "fim_integrity",
    Q.with_(*BASE, FIM_SQL, TOKENIZED_SQL, DAMAGED_SQL)
    + """SELECT k, count(*) AS n, count(*) FILTER (WHERE list_position(ids, 256) < list_position(ids, 258)
           AND list_position(ids, 258) < list_position(ids, 257) AND list_position(ids, 257) < list_position(ids, 260)) AS n_well_formed
         FROM damaged GROUP BY k""",
)
def fim_integrity(spark, folder):
    """Rows left as they are, without a middle marker, reversed, or without their end."""
    from gapweave.functions.keys import draw_below, shuffle_key

    ids = F.col("input_ids")
    k = draw_below(shuffle_key("wreck", 0, *[F.col(c) for c in ROW_ID]), F.lit(4))
    wrecked = (
        F.when(F.col("k") == 0, ids)
        .when(F.col("k") == 1, F.array_remove(ids, M.middle_id))
        .when(F.col("k") == 2, F.reverse(ids))
        .otherwise(F.slice(ids, F.lit(1), F.size(ids) - 1))
    )
    rows = tokenized_rows(spark, folder).withColumn("k", k).withColumn("input_ids", wrecked)
    return rows.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(T.well_formed(F.col("input_ids"))).alias("n_well_formed")
    )


@query(
    "prompts",
    BENCH
    + """SELECT file_id, block_id, sub_id, len(prompt)::INTEGER AS n_prompt,
         md5(array_to_string(prompt, ',')) AS prompt_md5 FROM labelled""",
)
def prompts(spark, folder):
    rows = Tok.prompts(bench_parts(spark, folder))
    return rows.select(*ROW_ID, F.size("prompt_ids").alias("n_prompt"), ids_md5("prompt_ids").alias("prompt_md5"))


@query(
    "masked_labels",
    BENCH
    + """SELECT file_id, block_id, sub_id, md5(array_to_string(list_concat(list_transform(prompt, lambda x: -100),
         ids[len(prompt) + 1:]), ',')) AS labels_md5 FROM labelled""",
)
def masked_labels(spark, folder):
    rows = Tok.prompts(bench_parts(spark, folder))
    return rows.select(*ROW_ID, ids_md5("label_ids").alias("labels_md5"))


@query(
    "generation_tail",
    BENCH + "SELECT file_id, block_id, sub_id, md5(array_to_string(ids[len(prompt) + 1:], ',')) AS tail_md5 FROM labelled",
)
def generation_tail(spark, folder):
    """The part of a generated row after its prompt; here the example itself stands for the output."""
    rows = Tok.prompts(bench_parts(spark, folder))
    tail = T.drop_leading(F.col("example_token_ids"), F.size("prompt_ids")).alias("tail")
    return rows.select(*ROW_ID, tail).select(*ROW_ID, ids_md5("tail").alias("tail_md5"))


@query(
    "clean_generation",
    r"""SELECT conv_id, turn, regexp_replace(text, '^\s+|\s+$', '', 'g') AS cleaned FROM conversations""",
)
def clean_generation(spark, folder):
    padded = F.concat(F.lit(f"{M.pad}{M.pad} \n"), F.col("text"), F.lit(f"\n {M.pad}"))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", T.clean_generation(padded).alias("cleaned")
    )


# ---------------------------------------------------------------- feed

FEED_SQL = """
feed AS (
  SELECT file_id, block_id, sub_id, ids, row_number() OVER (ORDER BY
     md5('feed:0:' || file_id::VARCHAR || ':' || block_id::VARCHAR || ':' || sub_id::VARCHAR), file_id, block_id, sub_id) AS position
  FROM tokenized WHERE split = 'train'),
batched AS (
  SELECT *, (position - 1) // 16 AS batch_no, max(len(ids)) OVER (PARTITION BY (position - 1) // 16) AS longest FROM feed)"""
FED = Q.with_(*BASE, FIM_SQL, TOKENIZED_SQL, FEED_SQL)


def train_rows(spark, folder):
    rows = tokenized_rows(spark, folder).where(F.col("split") == "train")
    return rows.select(*ROW_ID, "example", "n_ids", "input_ids", "attention_mask", "labels")


@query("feed_order", FED + "SELECT file_id, block_id, sub_id, position FROM feed")
def feed_order(spark, folder):
    return Feed.feed_order(train_rows(spark, folder), ROW_ID, FEED).select(*ROW_ID, "position")


@query("feed_resume", FED + "SELECT file_id, block_id, sub_id FROM feed WHERE position > 5 * 2 * 8")
def feed_resume(spark, folder):
    skip = Feed.rows_to_skip(5, FEED)
    return Feed.resume(train_rows(spark, folder), ROW_ID, skip, FEED).select(*ROW_ID)


@query(
    "batch_right_pad",
    FED
    + """SELECT file_id, block_id, sub_id, batch_no::BIGINT AS batch_no, longest::INTEGER AS batch_length,
         md5(array_to_string(list_concat(ids, list_transform(range(longest - len(ids)), lambda x: 259)), ',')) AS ids_md5,
         md5(array_to_string(list_concat(ids, list_transform(range(longest - len(ids)), lambda x: -100)), ',')) AS labels_md5,
         repeat('1', len(ids)) || repeat('0', (longest - len(ids))::BIGINT) AS mask FROM batched""",
)
def batch_right_pad(spark, folder):
    # Texts are dealt, a byte for an id; the ids follow in place.
    narrow = train_rows(spark, folder).select(*ROW_ID, "example", "n_ids")
    dealt = Feed.feed_batches(narrow, ROW_ID, 16, params=FEED, length=F.col("n_ids"))
    batches = Feed.collate_right(dealt.withColumn("input_ids", T.encode_text(F.col("example"))), 16, M.pad_id)
    return batches.select(
        *ROW_ID,
        "batch_no",
        "batch_length",
        ids_md5().alias("ids_md5"),
        ids_md5("labels").alias("labels_md5"),
        F.array_join("attention_mask", "").alias("mask"),
    )


@query(
    "batch_left_pad",
    BENCH
    + """, placed AS (
  SELECT *, (row_number() OVER (ORDER BY md5('feed:0:' || file_id::VARCHAR || ':' || block_id::VARCHAR || ':' || sub_id::VARCHAR),
         file_id, block_id, sub_id) - 1) // 10 AS batch_no FROM labelled),
padded AS (SELECT *, max(len(prompt)) OVER (PARTITION BY batch_no) AS longest FROM placed)
SELECT file_id, block_id, sub_id, batch_no::BIGINT AS batch_no, md5(array_to_string(list_concat(
  list_transform(range(longest - len(prompt)), lambda x: 259), prompt), ',')) AS prompt_md5,
  repeat('0', (longest - len(prompt))::BIGINT) || repeat('1', len(prompt)) AS mask FROM padded""",
)
def batch_left_pad(spark, folder):
    ordered = Feed.feed_batches(Tok.prompts(bench_parts(spark, folder)), ROW_ID, 10, "prompt_ids", FEED)
    batches = Feed.collate_left(ordered, 10, M.pad_id)
    return batches.select(
        *ROW_ID, "batch_no", ids_md5("prompt_ids").alias("prompt_md5"), F.array_join("prompt_mask", "").alias("mask")
    )


@query(
    "steps_plan",
    FED
    + """SELECT count(*) AS n_rows, ceil(count(*) / 16.0)::BIGINT AS steps_per_epoch, 3 * ceil(count(*) / 16.0)::BIGINT AS max_steps
         FROM feed""",
)
def steps_plan(spark, folder):
    return Feed.steps_plan(train_rows(spark, folder), FEED)


@query(
    "dataset_slice",
    FED
    + """SELECT position - 1 AS line, decode(unhex(array_to_string(list_transform(list_filter(ids, lambda x: x < 256),
         lambda x: lpad(to_hex(x), 2, '0')), ''))) AS bare FROM feed WHERE position - 1 >= 100 AND position - 1 < 140""",
)
def dataset_slice(spark, folder):
    """Lines 100 to 139 of the feed, decoded without markers."""
    line = F.col("position") - 1
    # Texts are sorted, a byte for an id; the lines wanted get their ids after that.
    ordered = Feed.feed_order(train_rows(spark, folder).select(*ROW_ID, "example"), ROW_ID, FEED)
    rows = ordered.where((line >= 100) & (line < 140)).withColumn("input_ids", T.encode_text(F.col("example")))
    return rows.select(line.alias("line"), T.decode_ids(F.col("input_ids")).alias("bare"))


# ---------------------------------------------------------------- dataset profile

LENGTH_SQL = """
lengths AS (
  SELECT split, len(ids) AS token_length, list_position(ids, 260) - list_position(ids, 257) - 1 AS middle_length FROM tokenized)"""
LENGTHS = Q.with_(*BASE, FIM_SQL, TOKENIZED_SQL, LENGTH_SQL)


def histogram_sql(value: str, high: int) -> str:
    return (
        LENGTHS
        + f""", binned AS (SELECT split, least(floor({value} / ({high} / 59.0::DOUBLE))::INTEGER, 58) AS bin FROM lengths
              WHERE {value} BETWEEN 0 AND {high})
        SELECT s.split, b.bin::INTEGER AS bin, count(x.bin) AS n FROM (VALUES ('train'),('eval'),('test')) s(split)
        CROSS JOIN range(59) b(bin) LEFT JOIN binned x ON x.split = s.split AND x.bin = b.bin GROUP BY s.split, b.bin"""
    )


def lengths(spark, folder):
    return Summary.length_rows(tokenized_rows(spark, folder), keep=("split",))


@query(
    "length_stats",
    LENGTHS
    + """SELECT split, count(*) AS n, min(token_length)::INTEGER AS min_length, max(token_length)::INTEGER AS max_length,
         round(avg(token_length), 6) AS mean_length, count(middle_length) AS n_middles, round(avg(middle_length), 6) AS mean_middle
         FROM lengths GROUP BY split""",
)
def length_stats(spark, folder):
    return (
        lengths(spark, folder)
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("token_length").alias("min_length"),
            F.max("token_length").alias("max_length"),
            F.round(F.avg("token_length"), 6).alias("mean_length"),
            F.count("middle_length").alias("n_middles"),
            F.round(F.avg("middle_length"), 6).alias("mean_middle"),
        )
    )


@query("length_hist", histogram_sql("token_length", 1024))
def length_hist(spark, folder):
    return Summary.split_histogram(lengths(spark, folder), "token_length", PARAMS.max_token_sequence_length)


@query("middle_hist", histogram_sql("middle_length", 276))
def middle_hist(spark, folder):
    high = PARAMS.max_middle_tokens_length + Summary.MIDDLE_HEADROOM
    return Summary.split_histogram(lengths(spark, folder), "middle_length", high)


@query(
    "example_split_sizes",
    LENGTHS
    + "SELECT s.split, count(x.split) AS n FROM (VALUES ('train'),('eval'),('test')) s(split) LEFT JOIN lengths x USING (split) GROUP BY s.split",
)
def example_split_sizes(spark, folder):
    return split_sizes(tokenized_rows(spark, folder).select("split"))


@query(
    "threshold_coverage",
    LENGTHS
    + """SELECT count(*) AS total, max(token_length)::BIGINT AS max_length, count(*) FILTER (WHERE token_length <= 512) AS n_within
         FROM lengths""",
)
def threshold_coverage(spark, folder):
    return Summary.threshold_coverage(lengths(spark, folder), 512)


@query(
    "threshold_hist",
    LENGTHS
    + """, span AS (SELECT min(token_length)::DOUBLE AS low, max(token_length)::DOUBLE AS high FROM lengths),
    binned AS (SELECT least(floor((token_length - low) / ((high - low) / 50))::INTEGER, 49) AS bin FROM lengths, span)
    SELECT b.bin::INTEGER AS bin, round(low + b.bin * ((high - low) / 50), 6) AS left_edge, count(x.bin) AS n
    FROM range(50) b(bin) CROSS JOIN span LEFT JOIN binned x ON x.bin = b.bin GROUP BY b.bin, low, high""",
)
def threshold_hist(spark, folder):
    hist = Summary.observed_histogram(lengths(spark, folder), [], "token_length", Summary.THRESHOLD_BINS)
    return hist.select("bin", F.round("left_edge", 6).alias("left_edge"), "n")

