import json
import zipfile

import pytest
from pyspark.sql import functions as F

from gapweave.operators.settle import shared_folder, settle
from gapweave.params import FimParams, SplitParams
from gapweave.plans import plugins
from gapweave.plans.evaluate import report
from gapweave.sinks import writers as W
from gapweave.sources import files as Src, jsonl
from gapweave.functions.tokens import encode_text
from gapweave.operators.random_fim import byte_chunks
from gapweave.operators.splits import split_by_threshold
from gapweave.plans.preprocess import training_rows, write_training_rows
from gapweave.streaming.incremental import incremental_examples, read_training, run_available, run_training, stream_files

TEXT = "First sentence here. Second one there!\nAnother paragraph. With two."


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "src"
    for split, n in (("train", 3), ("eval", 1), ("test", 1)):
        (root / split / "deep").mkdir(parents=True)
        for i in range(n):
            (root / split / "deep" / f"f{i}.C").write_bytes(f"{TEXT}\r\nFile {split} {i} ends here.".encode())
    (root / "train" / ".c").write_text("dot file")
    (root / "train" / "x.py").write_text("other")
    (root / "train" / "bad.c").write_bytes(b"\xff\xfe\x80")
    return root


def test_scan_by_suffix(spark, tree):
    names = {r["path"].rsplit("/", 1)[-1] for r in Src.scan(spark, str(tree), [".c"]).select("path").collect()}
    assert names == {"f0.C", "f1.C", "f2.C", "bad.c"}


def test_empty_files_are_scanned_split_and_chunked(spark, tree):
    (tree / "train" / "deep" / "none.c").write_bytes(b"")
    (tree / "eval" / "none.c").write_bytes(b"")
    (tree / "eval" / "none.py").write_bytes(b"")
    (tree / "eval" / "_none.c").write_bytes(b"")
    (tree / "eval" / ".none.c").write_bytes(b"")
    files = Src.scan(spark, str(tree), [".c"])
    sizes = {r["path"]: (r["n_bytes"], len(r["content"])) for r in files.collect()}
    assert len(sizes) == 8 and sum(s == (0, 0) for s in sizes.values()) == 2 and all(a == b for a, b in sizes.values())
    assert all(p.startswith("file:/") for p in sizes) and len({p.split("src/")[0] for p in sizes}) == 1
    by_split = {r["split"]: r["count"] for r in Src.scan_splits(spark, str(tree), [".c"]).groupBy("split").count().collect()}
    assert by_split == {"train": 5, "eval": 2, "test": 1}
    valid = Src.valid_files(files).withColumn("file_id", F.col("path"))
    assert valid.where("text = ''").count() == 2
    chunks = byte_chunks(valid, F.lit(1000)).where(F.octet_length("bytes") == 0)
    assert chunks.count() == 2 and Src.scan(spark, str(tree), [".c"], empty=False).count() == 6


def test_listing_in_parts(spark, tmp_path, monkeypatch):
    from gapweave.sources import listing

    names = set()
    for a in range(5):
        for b in range(4):
            (tmp_path / f"a{a}" / f"b{b}" / "c").mkdir(parents=True)
            for name in (f"a{a}/x{b}.txt", f"a{a}/b{b}/y", f"a{a}/b{b}/c/z"):
                (tmp_path / name).write_text("x" * b)
                names.add((name, b))
    for folders in (1, 4, 7, 256):
        monkeypatch.setattr(listing, "FOLDERS", folders)
        got = listing.listing(spark, str(tmp_path)).collect()
        assert {(r["path"].removeprefix(f"file:{tmp_path}/"), r["n_bytes"]) for r in got} == names and len(got) == len(names)
    with pytest.raises(Exception, match="no folder"):
        listing.listing(spark, str(tmp_path / "missing")).collect()


def test_pre_split_tree(spark, tree, tmp_path):
    files = Src.scan_splits(spark, str(tree), [".c"])
    assert {r["split"]: r["count"] for r in files.groupBy("split").count().collect()} == {"train": 4, "eval": 1, "test": 1}
    with pytest.raises(FileNotFoundError, match="eval"):
        Src.scan_splits(spark, str(tree / "train"), [".c"])


def test_quarantine(spark, tree):
    files = Src.scan(spark, str(tree), [".c"])
    assert [r["path"].rsplit("/", 1)[-1] for r in Src.quarantined(files).collect()] == ["bad.c"]
    texts = [r["text"] for r in Src.valid_files(files).collect()]
    assert len(texts) == 5 and all("\r" not in t and t.startswith(TEXT) for t in texts)


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/x.c", "int a;")
        z.writestr("y.c", "int b;")
    rows = Src.archive_entries(spark, str(tmp_path)).collect()
    assert {r["path"].rsplit("/a/", 1)[-1]: bytes(r["content"]).decode() for r in rows} == {"d/x.c": "int a;", "y.c": "int b;"}


def test_stream_equals_batch_and_runs_once(spark, tree, tmp_path):
    params, split = FimParams(min_middle_tokens_length=1), SplitParams(0.5, 0.25, 0.25)
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    examples = incremental_examples(stream_files(spark, str(tree), [".c"]), "prose", split, params)
    columns = ["file_id", "split", "input_ids"]

    def batch():
        files = Src.valid_files(Src.scan(spark, str(tree), [".c"])).withColumn("file_id", F.col("path"))
        return sorted(incremental_examples(files, "prose", split, params).select(*columns).collect())

    run_available(examples, out, mark)
    first = sorted(spark.read.parquet(out).select(*columns).collect())
    assert first == batch() and first
    (tree / "train" / "late.c").write_text("A late file. It has two sentences.")
    run_available(examples, out, mark)
    run_available(examples, out, mark)
    assert sorted(spark.read.parquet(out).select(*columns).collect()) == batch()


def test_writing_job_counts_what_it_writes_and_drops(spark, tree, tmp_path):
    params = FimParams(
        min_middle_tokens_length=1, max_middle_tokens_length=22, max_token_sequence_length=36, rand_to_ast_fim_examples_ratio=0.5,
        rand_examples_min_prefix_suffix_tokens_length=2,
    )
    files = Src.valid_files(Src.scan_splits(spark, str(tree), [".c"])).withColumn("file_id", F.col("path"))
    path = str(tmp_path / "ds")
    for fmt in ("json", "parquet"):
        counts = {r["split"]: r for r in write_training_rows(files, "prose", path, fmt, params=params).collect()}
        back = spark.read.format(fmt).load(path).groupBy("split").count().collect()
        assert {r["split"]: r["count"] for r in back} == {s: r["n_structural"] + r["n_random"] for s, r in counts.items() if r["n_structural"]}
        assert counts["train"]["n_examples"] > counts["train"]["n_structural"] > 0
        none = write_training_rows(files.limit(0), "prose", str(tmp_path / "none"), fmt, params=params).collect()
        assert [tuple(r)[1:] for r in none] == [(0, 0, 0)] * 3


@pytest.mark.parametrize("own_tokenizer", [False, True])
def test_random_rows_of_a_stream_are_those_of_the_batch(spark, tree, tmp_path, own_tokenizer):
    params = FimParams(
        min_middle_tokens_length=1, max_middle_tokens_length=60, max_token_sequence_length=200, rand_to_ast_fim_examples_ratio=0.6,
        rand_examples_min_prefix_suffix_tokens_length=2, rand_examples_per_chunk=3,
    )
    tokenizer = encode_text if own_tokenizer else None
    split, out, mark = SplitParams(0.5, 0.25, 0.25), str(tmp_path / "out"), str(tmp_path / "mark")

    def batch():
        files = Src.valid_files(Src.scan(spark, str(tree), [".c"])).withColumn("file_id", F.col("path"))
        assigned = split_by_threshold(files, ["file_id"], split)
        rows = training_rows(assigned, "prose", split, params, ratio=1.0, tokenizer=tokenizer)
        return sorted((r["kind"], r["file_id"], r["split"], r["input_ids"]) for r in rows.collect())

    def stream():
        run_training(stream_files(spark, str(tree), [".c"]), "prose", out, mark, split, params, tokenizer=tokenizer)
        rows = read_training(spark, out).collect()
        assert all(r["labels"] == r["input_ids"] and r["attention_mask"] == [1] * len(r["labels"]) for r in rows)
        return sorted((r["kind"], r["file_id"], r["split"], r["input_ids"]) for r in rows)

    for late in range(3):
        if late:
            (tree / "train" / f"late{late}.c").write_text(f"A late file no {late}. It has two sentences. Or three, {late}.\n" * 4)
        want = batch()
        assert stream() == want and {k for k, *_ in want} == {"structural", "random"}
    assert stream() == want
    for table in ("structural", "chunks"):
        assert len(list((tmp_path / "out" / table).glob("batch=*"))) == 3


def rows(spark):
    return spark.createDataFrame(
        [("train", [1, 2], [1, 1], [1, 2]), ("eval", [3], [1], [3])],
        "split string, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )


def test_examples_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "ds")
    W.write_examples(rows(spark), path)
    W.write_examples(rows(spark), path)
    assert jsonl.read_training(spark, path + "/split=train").count() == 2
    W.replace_examples(rows(spark), path)
    back = jsonl.read_benchmark_input(spark, path + "/split=train").collect()
    assert [r["input_ids"] for r in back] == [[1, 2]]


def test_replacing_leaves_no_stale_split(spark, tmp_path):
    path = str(tmp_path / "ds")
    both = spark.createDataFrame([("train", [1]), ("test", [2])], "split string, input_ids array<int>")
    W.replace_examples(both, path)
    W.replace_examples(both.where("split = 'train'"), path)
    assert [p.name for p in (tmp_path / "ds").glob("split=*")] == ["split=train"]
    assert [p.name for p in tmp_path.iterdir()] == ["ds"]


def test_failing_job_keeps_the_earlier_scores(spark, tmp_path):
    path = str(tmp_path / "s")
    W.write_scores(spark.range(3), path)
    failing = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        W.write_scores(failing, path)
    assert spark.read.json(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["s"]
    W.write_scores(spark.range(4), path)
    assert spark.read.json(path).count() == 4


def test_tolerant_read(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"input_ids": [1]}\n\n{"labels": [2]}\n')
    got = jsonl.read_tolerant(spark, str(tmp_path / "t.jsonl")).collect()
    assert sorted(r["input_ids"] for r in got) == [[], [1]]


def test_scores_survive_infinity_and_missing_flag(spark, tmp_path):
    df = spark.createDataFrame([(1, float("inf"))], "example_id bigint, base_perplexity double")
    W.write_scores(df, str(tmp_path / "s"))
    row = jsonl.read_scores(spark, str(tmp_path / "s")).first()
    assert row["base_perplexity"] == float("inf") and row["codebleu_valid"] is True


def test_benchmark_reuse(spark, tmp_path):
    path = str(tmp_path / "b")
    W.write_benchmark(spark.range(2), path)
    W.write_benchmark(spark.range(5), path, reuse=True)
    assert spark.read.json(path).count() == 2
    W.write_benchmark(spark.range(5), path)
    assert spark.read.json(path).count() == 5


def test_manifest(spark, tmp_path):
    files = spark.createDataFrame([("train", "a/1.c"), ("train", "a/2.c"), ("test", "b.c")], "split string, path string")
    W.write_manifest(files, str(tmp_path / "m"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "m" / "split=train")).collect()) == ["a/1.c", "a/2.c"]
    assert json.loads(W.manifest(files).where("split = 'test'").first()["line"]) == {"split": "test", "path": "b.c"}


def test_blocks_as_text(spark, tmp_path):
    blocks = spark.createDataFrame([("train", i, f"BLOCK {i}\nEND") for i in range(5)], "split string, ord int, block string")
    W.write_blocks(blocks, str(tmp_path / "t"), ["ord"])
    parts = sorted((tmp_path / "t" / "split=train").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert text.strip("\n").split("\n\n") == [f"BLOCK {i}\nEND" for i in range(5)]


def test_train_log_sink(spark, tmp_path):
    log = spark.createDataFrame([("r", s, "train", 1.0 / s) for s in (3, 1, 2)], "run_id string, step bigint, kind string, loss double")
    W.write_train_log(log, str(tmp_path / "l"))
    assert spark.read.json(str(tmp_path / "l")).where("run_id = 'r' and kind = 'train'").count() == 3


def test_report(spark, tmp_path):
    scores = spark.createDataFrame([(1, 0.0, 1.0), (2, 1.0, 1.0)], "example_id int, base_exact_match double, lora_exact_match double")
    out = report(scores, "checkpoint-7")
    W.write_report(out, str(tmp_path / "r"))
    document = json.loads(spark.read.text(str(tmp_path / "r")).first()["value"])
    assert document["checkpoint"] == "checkpoint-7" and "T" in document["evaluation_date"]
    assert document["all_metric_stats"] == [
        {"metric": "exact_match", "n": 2, "base_average": 0.5, "lora_average": 1.0, "is_binary": True, "higher_is_better": True}
    ]


def test_settle_reads_back_the_same_rows(spark):
    assert sorted(settle(spark.range(9)).collect()) == sorted(spark.range(9).collect())


def test_plugins(spark):
    files = spark.createDataFrame([(1, "ab cd"), (2, "boom"), (3, "x")], "file_id bigint, text string")
    encode = plugins.tokenizer(lambda texts: [[len(w) for w in t.split()] for t in texts])
    ids = files.select("file_id", encode("text").alias("ids")).where(F.size("ids") > 1)
    assert [r["ids"] for r in ids.collect()] == [[2, 2]]
    assert ids._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1

    def parse(text):
        if text == "boom":
            raise SyntaxError("no")
        return [(1, "file", 0, len(text))]

    parsed = {r["file_id"]: r for r in plugins.parse_nodes(files, parse).collect()}
    assert {i for i, r in parsed.items() if r["error"] is None and r["nodes"]} == {1, 3}
    assert parsed[2]["error"] == "SyntaxError: no" and parsed[2]["nodes"] == []

    made = plugins.table_function(spark, "own_parser", parse)
    files.createOrReplaceTempView("own_files")
    want = {(i, k, n["depth"], n["type"], n["start_byte"], n["end_byte"]) for i, r in parsed.items() for k, n in enumerate(r["nodes"])}
    for rows in (spark.sql("SELECT * FROM own_parser(TABLE(own_files))").collect(), made(files.asTable()).collect()):
        assert {tuple(r)[:6] for r in rows if r["error"] is None} == want
        assert {r["file_id"]: r["error"] for r in rows if r["error"] is not None} == {2: "SyntaxError: no"}

    prompts = spark.createDataFrame([(i, [i, i + 1]) for i in range(7)], "example_id bigint, prompt_ids array<int>")
    made = plugins.generate(prompts, lambda batch: [(f"{len(batch) <= 3}:{sum(p)}", 1.0) for p in batch], 3)
    assert {r["example_id"]: r["generated_middle"] for r in made.collect()} == {i: f"True:{2 * i + 1}" for i in range(7)}


def test_batches_of_prompts_cross_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        prompts = spark.range(0, 23, 1, 1).select(F.col("id").alias("example_id"), F.array(F.col("id").cast("int")).alias("prompt_ids"))
        made = plugins.generate(prompts, lambda batch: [(str(len(batch)), float(p[0])) for p in batch], 10).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r["example_id"], r["generated_middle"], r["perplexity"]) for r in made] == [
        (i, "10" if i < 20 else "3", float(i)) for i in range(23)
    ]


def test_settle_uses_the_folder_of_the_session(spark, tmp_path, monkeypatch):
    class Conf:
        def __init__(self, value):
            known = {"spark.checkpoint.dir": value, "spark.sql.warehouse.dir": "hdfs://warehouse"}
            self.get = lambda key, default=None: known.get(key) or default

    class Session:
        def __init__(self, value):
            self.conf = Conf(value)

    assert shared_folder(Session("hdfs://shared/folder")) == "hdfs://shared/folder"
    assert shared_folder(Session(None)) == "hdfs://warehouse/settled"
    monkeypatch.setattr("gapweave.operators.settle.shared_folder", lambda _: str(tmp_path / "shared"))
    assert settle(spark.range(3)).count() == 3
    assert len(list((tmp_path / "shared").glob("settled-*"))) == 1
