import pytest
from pyspark.sql import functions as F

from gapweave.functions import tokens as T
from gapweave.operators import feed, fim, random_fim as R, tokens as Tok
from gapweave.params import FeedParams, FimParams, Markers
from gapweave.plans.preprocess import structural_examples, training_rows

M = Markers()
PROSE = "First one here. Second ônè there! Third?\nAnother paragraph with more words. And its end."


def files(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "file_id bigint, text string")
    return df.withColumn("content", F.encode("text", "UTF-8")).withColumn("split", F.lit("train"))


def ids_frame(spark, *rows):
    return spark.createDataFrame([(i, list(r)) for i, r in enumerate(rows)], "row bigint, input_ids array<int>")


def kept(df):
    return [r["row"] for r in df.orderBy("row").collect()]


def test_encode_decode(spark):
    for text in ["", "abc", "πr² – 漢字 🙂", f"a{M.prefix}b{M.middle}{M.eos}", "\x00\x01"]:
        row = spark.createDataFrame([(text,)], "t string").select(T.encode_text(F.col("t")).alias("i")).select(
            "i", T.decode_ids(F.col("i"), M).alias("back"), T.decode_ids(F.col("i")).alias("bare")
        ).first()
        assert row["back"] == text
        bare = text
        for marker, marker_id in M.id_by_text().items():
            assert row["i"].count(marker_id) == text.count(marker)
            bare = bare.replace(marker, "")
        assert row["bare"] == bare and [i for i in row["i"] if i < 256] == list(bare.encode())


def test_end_limit_is_inclusive(spark):
    ends = spark.createDataFrame([([10, 50, 200],), ([100],), ([500],)], "e array<int>").select(
        F.transform("e", lambda e: F.struct(F.lit(0).alias("rel_start"), e.alias("rel_end"))).alias("s")
    )
    got = [len(r[0]) for r in ends.select(fim.within_end_limit(F.col("s"), 50, F.lit(2.0))).collect()]
    assert got == [2, 1, 0]


def test_parts_make_up_the_block(spark):
    params = FimParams(min_middle_tokens_length=1, fim_examples_per_subblock_ratio=1.0)
    rows = structural_examples(files(spark, PROSE), "prose", params).collect()
    assert len(rows) == 5
    for r in rows:
        assert r["prefix"] + r["middle"] + r["suffix"] in PROSE.split("\n")
        assert r["input_ids"] == r["labels"] and set(r["attention_mask"]) == {1}
        assert r["input_ids"][0] == M.prefix_id and r["input_ids"][-1] == M.eos_id


def test_sample_is_at_least_one_and_without_replacement(spark):
    low = FimParams(min_middle_tokens_length=1, fim_examples_per_subblock_ratio=0.01)
    assert structural_examples(files(spark, PROSE), "prose", low).count() == 2
    with pytest.raises(ValueError):
        FimParams(fim_examples_per_subblock_ratio=1.5)


def test_middle_estimate_bounds(spark):
    ranges = [(17, 24), (25, 107), (31, 68), (43, 68), (53, 62), (73, 105)]
    blocks = spark.createDataFrame(
        [(0, 0, bytearray(b"x" * 120), [(i, "s", a, b) for i, (a, b) in enumerate(ranges)])],
        "file_id bigint, block_id bigint, code binary, "
        "subblocks array<struct<sub_id:bigint,type:string,rel_start:bigint,rel_end:bigint>>",
    )
    params = FimParams(min_middle_tokens_length=10, max_middle_tokens_length=14)
    lengths = sorted(len(r["middle"]) for r in fim.fim_examples(blocks, params, 3.0).collect())
    assert lengths == [32, 37]


def test_byte_count_filters_equal_id_filters(spark):
    text = PROSE + f"\nMarker {M.middle} inside. A tail of it."
    params = FimParams(max_token_sequence_length=70, min_middle_tokens_length=5, max_middle_tokens_length=30)
    from gapweave.plans.preprocess import file_blocks

    examples = fim.fim_examples(file_blocks(files(spark, text), "prose", params), params, 1.0)
    by_bytes = fim.tokenize_and_filter(examples, params)
    by_ids = fim.length_filters(examples.withColumn("input_ids", T.encode_text(F.col("example"))), params)
    columns = ["file_id", "block_id", "sub_id", "input_ids"]
    assert sorted(by_bytes.select(*columns).collect()) == sorted(by_ids.select(*columns).collect())
    assert by_ids.count() > 0
    blocks = file_blocks(files(spark, text), "prose", params)
    assert fim.drop_overlong(blocks, 30).count() == 1  # the line with a marker text stays


def test_total_and_middle_length_filters(spark):
    params = FimParams(max_token_sequence_length=5, min_middle_tokens_length=0, max_middle_tokens_length=99)
    m, e = M.middle_id, M.eos_id
    rows = ids_frame(spark, [1, m, e], [1, 2, 3, m, e], [1, 2, 3, 4, m, e])
    assert kept(fim.length_filters(rows, params)) == [0, 1]
    bounds = FimParams(min_middle_tokens_length=2, max_middle_tokens_length=3)
    rows = ids_frame(spark, [9, m, 1, 2, e], [9, m, 1, e], [9, m, 1, 2, 3, 4, e], [9, 1, 2, e])
    assert kept(fim.length_filters(rows, bounds)) == [0]


def test_two_middle_length_definitions(spark):
    marks = Markers(middle_id=10, eos_id=2)
    rows = ids_frame(spark, [1, 10, 11, 12, 2], [1, 10, 2], [1, 10, 11], [])
    got = [r[0] for r in rows.orderBy("row").select(T.closed_middle_length(F.col("input_ids"), marks)).collect()]
    assert got == [2, 0, None, None]


def test_marker_order(spark):
    p, s, m, e = M.prefix_id, M.suffix_id, M.middle_id, M.eos_id
    rows = ids_frame(spark, [p, 1, s, 2, m, 3, e], [p, 1, m, 2, s, 3, e], [p, 1, s, 2, 3, e], [p, s, m, 3], [])
    assert kept(rows.where(T.well_formed(F.col("input_ids")))) == [0]
    parts = Tok.fim_parts(rows.withColumn("example_id", F.col("row"))).collect()
    assert [(r["prefix_token_ids"], r["suffix_token_ids"], r["middle_token_ids"]) for r in parts] == [([1], [2], [3])]


def test_benchmark_sample_does_not_count_malformed_rows(spark):
    good = [M.prefix_id, 1, M.suffix_id, 2, M.middle_id, 3, M.eos_id]
    rows = ids_frame(spark, good, good, [1, 2], good).withColumn("example_id", F.col("row"))
    assert Tok.benchmark_sample(rows, 2).count() == 2
    assert Tok.benchmark_sample(rows, 9).count() == 3


def test_prompt_and_labels(spark):
    good = [M.prefix_id, 1, M.suffix_id, 2, M.middle_id, 3, M.eos_id]
    row = Tok.prompts(Tok.fim_parts(ids_frame(spark, good).withColumn("example_id", F.col("row")))).first()
    assert row["prompt_ids"] == good[:5] and row["label_ids"] == [-100] * 5 + [3, M.eos_id]


def chunk_sizes(spark, data, window):
    df = spark.createDataFrame([(0, bytearray(data))], "file_id bigint, content binary")
    return [bytes(r["bytes"]) for r in R.byte_chunks(df, F.lit(window)).orderBy("chunk_no").collect()]


def test_chunks(spark):
    assert [len(c) for c in chunk_sizes(spark, b"a" * 50, 24)] == [24, 24]
    assert chunk_sizes(spark, b"a" * 10, 240) == [b"a" * 10]
    assert chunk_sizes(spark, b"", 240) == [b""]
    text = "aé漢🙂" * 20
    for window in (7, 11, 16):
        for chunk in chunk_sizes(spark, text.encode(), window):
            assert chunk.decode() in text and len(chunk) <= window


def test_random_spans(spark):
    params = FimParams(
        min_middle_tokens_length=2, max_middle_tokens_length=4, rand_examples_min_prefix_suffix_tokens_length=2,
        rand_examples_per_chunk=50,
    )
    chunks = spark.createDataFrame([(0, 0, bytearray(range(100, 120)))], "file_id bigint, chunk_no int, bytes binary")
    rows = R.spans_to_examples(R.random_pool(chunks, params)).collect()
    assert len(rows) == 50
    lengths, starts = set(), set()
    for r in rows:
        ids = r["input_ids"]
        s, m = ids.index(M.suffix_id), ids.index(M.middle_id)
        prefix, suffix, middle = ids[1:s], ids[s + 1 : m], ids[m + 1 : -1]
        assert prefix + middle + suffix == list(range(100, 120)) and ids[-1] == M.eos_id
        assert len(prefix) >= 2 and len(suffix) >= 2
        lengths.add(len(middle)), starts.add(len(prefix))
    assert lengths == {2, 3, 4} and len(starts) > 5
    tight = FimParams(min_middle_tokens_length=10, max_middle_tokens_length=12, rand_examples_min_prefix_suffix_tokens_length=6)
    assert R.random_pool(chunks, tight).count() == 0


def test_random_quota_is_met(spark):
    quotas = spark.createDataFrame([("train", 3)], "split string, quota bigint")
    params = FimParams(max_token_sequence_length=64, min_middle_tokens_length=4, max_middle_tokens_length=8)
    text = "some repeated line\n" * 50
    rows = R.random_examples(files(spark, text), F.lit(76), params, quotas)
    assert rows.count() == 3


def test_union_keeps_duplicates_and_kinds(spark):
    params = FimParams(min_middle_tokens_length=1, rand_to_ast_fim_examples_ratio=0.5, max_middle_tokens_length=20)
    rows = training_rows(files(spark, *[PROSE] * 4), "prose", params=params)
    counts = {r["kind"]: r["count"] for r in rows.groupBy("kind").count().collect()}
    assert counts["random"] == counts["structural"] // 2


def test_vocabulary_both_join_forms(spark):
    texts = spark.createDataFrame([(0, "a b a , zz"), (1, ""), (2, "b")], "k bigint, text string")
    vocabulary = spark.createDataFrame([("a", 5), ("b", 6), (",", 9)], "token string, id int")
    want = {0: [5, 6, 5, 9, 1], 1: [], 2: [6]}
    for broadcast in (True, False):
        ids = Tok.vocabulary_ids(texts, vocabulary, 1, "k", broadcast=broadcast)
        assert {r["k"]: r["ids"] for r in ids.collect()} == want
        back = {r["k"]: r["text"] for r in Tok.vocabulary_text(ids, vocabulary, "k", broadcast=broadcast).collect()}
        assert back == {0: "a b a ,", 1: "", 2: "b"}
    with pytest.raises(ValueError, match="fim_pad"):
        Tok.require_markers(vocabulary)


def test_ratio(spark):
    blocks = spark.createDataFrame([(0, bytearray(b"abcdef")), (1, bytearray(b"ab"))], "id bigint, code binary")
    assert Tok.ratio_value(Tok.bytes_per_token(blocks, F.lit(2))) == 2.0
    with pytest.raises(ValueError):
        Tok.ratio_value(Tok.bytes_per_token(blocks.where("id > 5"), F.lit(2)))


def test_feed(spark):
    rows = spark.range(10).withColumn("input_ids", F.array(F.col("id").cast("int")))
    order = [r["id"] for r in feed.feed_order(rows, ["id"]).orderBy("position").collect()]
    rest = {r["id"] for r in feed.resume(rows, ["id"], 4).collect()}
    assert rest == set(order[4:])
    params = FeedParams(trainer_per_device_train_batch_size=2, trainer_gradient_accumulation_steps=2, trainer_num_train_epochs=3)
    assert feed.steps_plan(spark.range(100), params).first()["max_steps"] == 75
    assert feed.steps_plan(spark.range(0), params).first()["max_steps"] == 0
    assert feed.rows_to_skip(5, FeedParams(trainer_per_device_train_batch_size=2, trainer_gradient_accumulation_steps=8)) == 80
    with pytest.raises(ValueError):
        FeedParams(trainer_per_device_train_batch_size=0)


def test_collation(spark):
    rows = spark.createDataFrame(
        [(1, [1, 2, 3], [1, 1, 1], [1, 2, 3]), (2, [4, 5], [1, 1], [4, 5]), (3, [6], [1], [6])],
        "position bigint, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )
    got = feed.collate_right(rows, 2, 0).orderBy("position").collect()
    assert got[1]["input_ids"] == [4, 5, 0] and got[1]["attention_mask"] == [1, 1, 0] and got[1]["labels"] == [4, 5, -100]
    assert got[2]["input_ids"] == [6]
    prompts = rows.withColumn("prompt_ids", F.col("input_ids"))
    left = feed.collate_left(prompts, 2, 0).orderBy("position").collect()
    assert left[1]["prompt_ids"] == [0, 4, 5] and left[1]["prompt_mask"] == [0, 1, 1]


def test_own_tokenizer_and_parser_reach_the_training_rows(spark):
    """Word ids, and a parser whose only blocks are whole files with their words as sub-blocks."""
    import re

    from gapweave.plans import plugins
    from gapweave.sources.rules import LanguageRules

    marks = Markers().id_by_text()
    pieces = "|".join(map(re.escape, marks)) + r"|\w+|\W"

    def encode(texts):
        return [[marks.get(p, 1000 + len(p)) for p in re.findall(pieces, t)] for t in texts]

    def parse(text):
        size = len(text.encode())
        words = [(2, "word", len(text[: m.start()].encode()), len(text[: m.end()].encode())) for m in re.finditer(r"\w+", text)]
        return [(0, "all", 0, size), (1, "file", 0, size), *words]

    params = FimParams(
        max_token_sequence_length=200,
        min_middle_tokens_length=1,
        rand_examples_min_prefix_suffix_tokens_length=1,
        rand_to_ast_fim_examples_ratio=0.5,
    )
    some = files(spark, *[PROSE] * 6).withColumn("split", F.lit("train"))
    nodes = plugins.parse_nodes(some, parse).select("file_id", "nodes")
    rules = LanguageRules("own", ["file"], ["word"])
    rows = training_rows(
        some.join(nodes, "file_id"), "own", params=params, tokenizer=plugins.tokenizer(encode), rules=rules, nodes=True
    ).collect()
    assert {r["kind"] for r in rows} == {"structural", "random"}
    for r in rows:
        ids = r["input_ids"]
        assert len(ids) <= 200 and {i for i in ids if i < 1000} == set(marks.values()) - {Markers().pad_id}
