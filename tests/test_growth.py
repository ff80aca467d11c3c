"""Steps that once moved or computed whole tables more often than they need."""

import contextlib
import io
import re

import pyarrow as pa
from pyspark.sql import functions as F

from gapweave.functions import idarrays, tokens as T
from gapweave.functions.arrays import sums_before
from gapweave.functions.sqltext import rstrip
from gapweave.operators import ranking
from gapweave.operators.feed import feed_batches
from gapweave.operators.ranking import drop_smallest, keep_quota, keep_smallest
from gapweave.operators.settle import settle
from gapweave.plans import preprocess
from gapweave.queries import training as Q
from gapweave.streaming.incremental import run_training


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def keyed(spark, n=1000):
    return spark.range(n).select("id", F.md5(F.col("id").cast("string")).alias("key"), (F.col("id") % 3).alias("g"))


def test_quota_leaves_rows_where_they_are(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        quotas = spark.createDataFrame([(0, 5), (1, 7), (2, 1)], "g long, quota long")
        kept = keep_quota(keyed(spark), ["g"], "key", ["id"], quotas)
        top = plan(kept).split("BroadcastHashJoin", 1)
        assert len(top) == 2 and "SortMergeJoin" not in top[0]
        assert {r["g"]: r["count"] for r in kept.groupBy("g").count().collect()} == {0: 5, 1: 7, 2: 1}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_table_is_computed_once_for_the_cut(spark):
    for step in (keep_smallest, drop_smallest):
        assert len(re.findall(r"\bRange\b", plan(step(keyed(spark), "key", ["id"], 10)))) == 1


def test_batches_read_the_examples_once(spark):
    rows = keyed(spark).select("id", F.array(F.lit(1), F.lit(2)).alias("input_ids"))
    assert "Range" not in plan(feed_batches(rows, ["id"], 16))


def test_sliced_feed_sorts_texts(spark):
    steps = plan(Q.dataset_slice(spark, "/root/testdata/sf0.001"))
    assert "ArrowEvalPython" in steps and steps.index("ArrowEvalPython") < steps.index("Window")


def test_pieces_grow_with_the_array(spark):
    text = sums_before("a")
    assert "cbrt" in text
    for n in (0, 1, 15, 16, 17, 255, 257, 5000):
        row = spark.sql(f"SELECT {sums_before('a')} AS s FROM (SELECT sequence(1L, {n + 1}L) AS a)").first()
        assert row["s"] == [k * (k + 1) // 2 for k in range(n + 1)]


def test_trailing_white_space(spark):
    texts = ["", " ", "a", "a b \n\x1c  ", "\n\n x\ny\u0085", "\U0001F600 ", None, " \x1f"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(F.expr(rstrip("t")).alias("r")).collect()
    assert [r["r"] for r in rows] == [t if t is None else t.rstrip() for t in texts]


def test_ids_are_counted_without_being_built(spark):
    texts = ["añ<|fim_prefix|>x<|fim_middle|>yz\U0001F600<|endoftext|>", None, "", "<|fim_middle|>", "<|fim_<|fim_pad|>middle|>"]
    t = F.col("t")
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(
        T.encode_text(t).alias("ids"), T.count_ids(t).alias("n"), T.count_middle_ids(t).alias("m"), T.tail_middle_length(T.encode_text(t)).alias("tail")
    )
    found = rows.collect()
    assert [r["n"] for r in found] == [None if r["ids"] is None else len(r["ids"]) for r in found]
    assert [r["m"] for r in found] == [r["tail"] for r in found]
    assert found[0]["ids"][:4] == [97, 195, 177, 256] and found[2]["ids"] == []


def test_one_arriving_file_is_scanned_by_several_tasks(spark, tmp_path):
    text = "One sentence of some length. Another one that is long. And a third here.\n"
    files = spark.range(64).select(F.col("id").alias("file_id"), F.repeat(F.lit(text), 3).alias("text"))
    files.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(files.schema).parquet(f"{tmp_path}/in").withColumn("content", F.encode("text", "UTF-8"))
    run_training(stream, "prose", f"{tmp_path}/out", f"{tmp_path}/check", params=Q.PARAMS)
    assert len(list(tmp_path.glob("out/structural/batch=0/*.parquet"))) > 1


def test_settled_tables_are_packed_tightly(spark, tmp_path):
    import pyarrow.parquet as pq

    from gapweave.operators.settle import settle

    files = settle(spark.range(10)).inputFiles()
    assert {pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def marked_texts():
    """Marker texts whole, cut, nested, at the ends of rows and across them."""
    return ["", "<|fim_pre", "fix|>x", "a<|fim_pad|><|endoftext|>", "<|fim_<|fim_pad|>prefix|>", None, "<|", "fim_middle|>é日", "<|fim_suffix|>"] * 3


def test_ids_of_a_batch_are_those_of_its_rows(spark):
    def row_by_row(text):
        chars = text.encode().decode("latin-1")
        for marker, marker_id in Q.M.id_by_text().items():
            chars = chars.replace(marker, chr(marker_id))
        return [ord(c) for c in chars]

    replaced = [(m, chr(i)) for m, i in Q.M.id_by_text().items()]
    texts = marked_texts()
    for given in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(texts)[2:-1], pa.array([], pa.string())):
        ids = idarrays.text_encoder(replaced)(given)
        assert ids.to_pylist() == [None if t is None else row_by_row(t) for t in given.to_pylist()]
        content = given.cast(pa.large_binary() if pa.types.is_large_string(given.type) else pa.binary())
        assert idarrays.of_bytes(content).to_pylist() == [None if t is None else list(t) for t in content.to_pylist()]
    # Marker texts that share bytes are replaced one after the other.
    tangled = idarrays.text_encoder([("aba", chr(300)), ("bab", chr(301))])
    assert tangled(pa.array(["ababab"])).to_pylist() == [[300, 301]]


def test_training_rows_are_written_once(spark, tmp_path, monkeypatch):
    settled = []
    for module in (preprocess, ranking):
        monkeypatch.setattr(module, "settle", lambda df: settled.append(df.columns) or settle(df))
    files = Q.document_files(spark, "/root/testdata/sf0.001")
    counts = preprocess.write_training_rows(files, "prose", str(tmp_path / "out"), fmt="parquet", params=Q.PARAMS).collect()
    # Keys and ids of the random draws are settled; structural rows go straight to their folder.
    assert settled == [["split", "pool_key", "file_id", "chunk_no", "draw"], ["split", "input_ids"]]
    rows = preprocess.training_rows(files, "prose", params=Q.PARAMS).select("split", "input_ids", "attention_mask", "labels")
    written = spark.read.parquet(str(tmp_path / "out")).select(rows.columns)
    assert written.count() == rows.count() > 100
    assert written.exceptAll(rows).isEmpty() and rows.exceptAll(written).isEmpty()
    for r in counts:
        assert r["n_structural"] + r["n_random"] == written.where(F.col("split") == r["split"]).count()


def test_markers_are_looked_for_once_a_block(spark):
    steps = plan(Q.tokenized_rows(spark, "/root/testdata/sf0.001"))
    above = steps.split("Generate", 1)[0]
    assert "Contains" not in above and "Contains" in steps
