import pytest
from pyspark.sql import functions as F

from gapweave.functions import text as X
from gapweave.functions.arrays import sums_before
from gapweave.operators import structure as S
from gapweave.params import FimParams
from gapweave.plans.preprocess import file_blocks, stratified_structures
from gapweave.sources.rules import LanguageRules, built_in_rules, language_rules, read_rules, scanner_rules

CODE = """#include "x.h"
enum color {
  RED, GREEN
};
union value { int i; float f; };
/* { not a block */
int twice(int n) {
  char *s = "}";
  for (int k = 0; k < n; k++) { n += k; }
  return n;
}
void broken(int x) { if (x) {
"""


def files(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "file_id bigint, text string")
    return df.withColumn("content", F.encode("text", "UTF-8"))


def test_prefix_sums_across_piece_borders(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 255, 256, 257, 600, 1300)], "n int")
    ones = df.select("n", F.expr("transform(if(n > 0, sequence(1, n), array()), x -> x * 2)").alias("a"))
    for r in ones.select("n", F.expr(sums_before("a")).alias("s")).collect():
        assert r["s"] == [i * (i + 1) for i in range(r["n"])]


def test_brace_blocks_and_nesting(spark):
    blocks = file_blocks(files(spark, CODE), "brace", FimParams(max_code_blocks_ast_depth=2)).collect()
    texts = [bytes(b["code"]).decode() for b in blocks]
    assert [t.split("{")[0].split("\n")[-1].strip() for t in texts] == ["enum color", "union value", "int twice(int n)"]
    assert texts[2].endswith("return n;\n}")
    twice = bytes(blocks[2]["code"])
    subs = [twice[s["rel_start"] : s["rel_end"]].decode() for s in blocks[2]["subblocks"]]
    assert 'char *s = "}";' in subs and "{ n += k; }" in subs and "return n;" in subs
    deeper = file_blocks(files(spark, CODE), "brace", FimParams(max_code_blocks_ast_depth=4)).collect()
    assert len(deeper) == len(blocks) + 1  # the loop repeats part of its function


def test_sentences_tile_paragraphs_with_multibyte_text(spark):
    text = "Héé! Wie gëht es?  Gut.\n\n  \nZwei Sätze. Ende"
    nodes = S.explode_nodes(S.with_nodes(files(spark, text), "prose")).collect()
    raw = text.encode()
    got = [(n["type"], raw[n["start_byte"] : n["end_byte"]].decode()) for n in nodes]
    assert got[1:] == [
        ("paragraph", "Héé! Wie gëht es?  Gut."),
        ("sentence", "Héé!"),
        ("sentence", "Wie gëht es?"),
        ("sentence", "Gut."),
        ("paragraph", "Zwei Sätze. Ende"),
        ("sentence", "Zwei Sätze."),
        ("sentence", "Ende"),
    ]


def test_join_form_equals_row_form(spark):
    df = S.with_nodes(files(spark, CODE, CODE * 40, "a { b; }"), "brace")
    nodes = S.explode_nodes(df)
    rules = scanner_rules("brace")
    blocks = nodes.where(F.col("type").isin(rules.block_types))
    subs = nodes.where(F.col("type").isin(rules.subblock_types))
    joined = S.contained(blocks, subs, bin_bytes=64).select("file_id", "block_id", "sub_id", "rel_start", "rel_end")
    rows = S.extract_blocks(df, rules.block_types, rules.subblock_types, 9999)
    direct = rows.select("file_id", "block_id", F.inline("subblocks")).select(
        "file_id", "block_id", "sub_id", "rel_start", "rel_end"
    )
    assert sorted(joined.collect()) == sorted(direct.collect())


def test_type_in_both_lists_gives_the_whole_block(spark):
    both = LanguageRules("prose", ["paragraph"], ["paragraph"])
    block = file_blocks(files(spark, "One. Two."), "prose", FimParams(), both).first()
    assert [(s["rel_start"], s["rel_end"]) for s in block["subblocks"]] == [(0, 9)]


def test_empty_and_unbalanced_files(spark):
    for scanner in S.SCANNERS:
        rows = S.explode_nodes(S.with_nodes(files(spark, "", "}} { ; ) (", "END_TYPE TYPE"), scanner)).collect()
        assert {r["file_id"] for r in rows if r["depth"] == 1} == {0, 1, 2}


def test_cleaning_and_keyword_structures(spark):
    raw = "(* head\n*)\n\n\nFUNCTION f // one\n  x := 1;   \n\n\n\nEND_FUNCTION\nprogram p END_PROGRAM\n"
    row = files(spark, raw).select(X.clean(F.col("text")).alias("c")).select("c", X.structures(F.col("c")).alias("s")).first()
    assert row["c"] == "FUNCTION f\n  x := 1;\n\nEND_FUNCTION\nprogram p END_PROGRAM"
    assert row["s"] == ["FUNCTION f\n  x := 1;\n\nEND_FUNCTION", "program p END_PROGRAM"]
    split = stratified_structures(files(spark, raw)).select("category", "block").collect()
    assert sorted(r["category"] for r in split) == ["FUNCTION", "PROGRAM"]


def test_lines_like_python(spark):
    for text in ["", "a", "a\n", "a\r\nb\rc", "a\n\n", "x\x0by\x1cz "]:
        assert files(spark, text).select(X.lines(F.col("text")).alias("l")).first()["l"] == text.splitlines()


def test_rules(spark, tmp_path):
    rules = built_in_rules(spark)
    c = language_rules(rules, "c")
    assert "function_definition" in c.block_types and "return_statement" in c.subblock_types
    with pytest.raises(ValueError):
        language_rules(rules, "klingon")
    path = tmp_path / "rules.json"
    path.write_text('{"toy": {"block_types": ["b"], "subblock_types": ["s", "s"]},\n "bad": {"block_types": ["b"]}}')
    own = read_rules(spark, str(path))
    assert language_rules(own, "toy").subblock_types == ["s"]
    with pytest.raises(ValueError):
        language_rules(own, "bad")


def test_brace_scanner_is_linear(spark):
    """Twice the text takes about twice the time (a factor of 3.5 leaves room for noise)."""
    import time

    one = "int f(int n) {\n  // {\n  char *s = \"} \";\n  for (int k = 0; k < n; k++) { n += k; }\n  return n;\n}\n"
    took = []
    for times in (2500, 5000, 10000):
        df = spark.createDataFrame([(one * times,)], "text string")
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            df.select(F.size(F.expr(S.brace_nodes("text")))).collect()
            best = min(best, time.perf_counter() - start)
        took.append(best)
    assert took[1] < 3.5 * took[0] + 1 and took[2] < 3.5 * took[1] + 1, took


def test_wide_blocks_are_not_copied_into_every_bin(spark):
    import random

    rng = random.Random(3)
    spans = [(0, 4096 * 100_000), (4096 * 7, 4096 * 60_000), (10, 10), (4096 * 32, 4096 * 64), (4095, 4097), (5, 4096 * 40_000 + 1)]
    spans += [(s, s + rng.choice([0, 1, 5000, 200_000, 10**7])) for s in (rng.randrange(4096 * 100_000) for _ in range(60))]
    rows = [(f, i, "t", s, e) for f in (1, 2) for i, (s, e) in enumerate(sorted(spans, key=lambda x: (x[0], -x[1])))]
    nodes = spark.createDataFrame(rows, "file_id int, node_id bigint, type string, start_byte bigint, end_byte bigint")
    copies = S.binned_blocks(nodes).groupBy("file_id", "node_id").count()
    assert copies.agg(F.max("count")).first()[0] <= S.SPREAD + 1 and copies.count() == len(rows)
    got = sorted((r["file_id"], r["block_id"], r["sub_id"], r["rel_start"], r["rel_end"]) for r in S.contained(nodes, nodes).collect())
    want = sorted(
        (f, i, j, s2 - s1, e2 - s1)
        for f, i, _, s1, e1 in rows
        for g, j, _, s2, e2 in rows
        if f == g and j >= i and s2 >= s1 and e2 <= e1 and (s2 < max(e1, s1 + 1) or s2 == s1)
    )
    assert got == want


def test_brace_nodes_in_batches_are_those_of_the_expression(spark):
    import random

    rng = random.Random(5)
    parts = ["{", "}", ";", "(", ")", "/", "//", "/*", "*/", '"', "'", "\\", "\n", " ", "#", "a", "f(int n) {", "k++;", "\xe9\U0001F600", "\x0b", "\x1c", "\x85"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [None, "", CODE, CODE * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "file_id long, text string").repartition(3)
    want = {r["file_id"]: r["nodes"] for r in S.with_nodes(df, "brace").collect()}
    got = S.with_brace_nodes(df)
    assert got.schema["nodes"].dataType.simpleString() == S.with_nodes(df, "brace").schema["nodes"].dataType.simpleString()
    assert {r["file_id"]: r["nodes"] for r in got.collect()} == want


def test_code_scores_scan_their_files_in_batches(spark):
    from gapweave.queries.evaluation import codebleu_rows

    plan = codebleu_rows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2 and "Exchange" not in plan and "regexp_extract_all" not in plan
