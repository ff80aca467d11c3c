import math
import random
import time

import pytest
from pyspark.sql import functions as F

from gapweave.functions import metrics as M
from gapweave.functions.arrays import multiset_overlap
from gapweave.functions.codebleu import with_codebleu
from gapweave.operators import scoring as Score, summary as S, train_log as L
from gapweave.params import EvalParams

FUNCTION = "int total(int n) {\n    if (n <= 0) {\n        return 0;\n    }\n    return n + total(n - 1);\n}"
VARIABLE = "int i = 0;"


def pairs(spark, *rows):
    return spark.createDataFrame([(i, r, p) for i, (r, p) in enumerate(rows)], "i int, ref string, pred string")


def values(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_exact_match(spark):
    df = pairs(spark, ("def a(): x", "def a(): x"), ("def a(): x", "  def a():\n x\u00a0 "), ("a", "b"), (None, "a"), ("a", None))
    assert values(df, M.exact_match("ref", "pred")) == [1.0, 1.0, 0.0, 0.0, 0.0]


def test_line_match(spark):
    df = pairs(
        spark,
        ("l1\nl2\nl3", "l1\nl2\nother"),
        ("l1   \nl2", "l1\nl2"),
        ("l1\nl2", "x\nl2"),
        ("l1\nl2", "l1"),
        ("l1", "l1\nmore"),
        ("", "l1"),
        (None, "l1"),
        (" l1", "l1"),
    )
    assert values(df, M.line_match("ref", "pred", 2)) == [1.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0]


def table_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_edit_similarity(spark):
    rows = [("", ""), ("", "a"), ("a", ""), ("line", "line"), ("kitten", "sitting"), ("äöü🙂", "aöu"), ("ab" * 90, "ba" * 70), (FUNCTION, VARIABLE), (None, None)]
    want = []
    for r, p in rows:
        r, p = r or "", p or ""
        want.append(1.0 if r == p else 0.0 if not r or not p else 1 - table_distance(r, p) / max(len(r), len(p)))
    assert values(pairs(spark, *rows), M.edit_similarity("ref", "pred")) == pytest.approx(want)


def brute_bleu(r, p):
    def grams(t, n):
        out = {}
        for i in range(len(t) - n + 1):
            out[tuple(t[i : i + n])] = out.get(tuple(t[i : i + n]), 0) + 1
        return out

    logs = 0.0
    for n in range(1, 5):
        rg, pg = grams(r, n), grams(p, n)
        hit = sum(min(c, rg.get(g, 0)) for g, c in pg.items())
        if n == 1 and hit == 0:
            return 0.0
        logs += 0.25 * math.log((hit or 0.1) / max(len(p) - n + 1, 1))
    return (1.0 if len(p) > len(r) else math.exp(1 - len(r) / len(p))) * math.exp(logs)


def test_bleu(spark):
    rows = [("a b c d e", "a b c d e"), ("the the the the the cat", "the the the the the the the"), ("a b", "c d"), ("a b c", "a"), ("", "a"), ("a", ""),
            ("a a a a a a b b b b b", "b b b b b a a a a a c")]
    want = [brute_bleu(r.split(), p.split()) for r, p in rows]
    assert values(pairs(spark, *rows), M.sentence_bleu("ref", "pred")) == pytest.approx(want)
    assert values(pairs(spark, (FUNCTION, FUNCTION), (FUNCTION, VARIABLE), (None, "a")), M.sentence_bleu("ref", "pred")) == [
        pytest.approx(1.0), pytest.approx(0.0, abs=0.1), 0.0
    ]


def test_overlap_of_many_copies(spark):
    df = spark.createDataFrame([(["a"] * 9 + ["b"] * 2 + ["c"], ["a"] * 7 + ["b"] * 5 + ["d"]), ([], ["a"])], "l array<string>, r array<string>")
    assert [r[0] for r in df.select(F.expr(multiset_overlap("l", "r"))).collect()] == [9.0, 0.0]


def test_codebleu(spark):
    df = pairs(spark, (FUNCTION, FUNCTION), (VARIABLE, VARIABLE), (FUNCTION, "return 1;"), (FUNCTION, None))
    rows = with_codebleu(df, "ref", {"score": "pred"}, "c").orderBy("i").collect()
    assert [r["codebleu_valid"] for r in rows] == [True, False, True, True]
    assert rows[0]["score"] > 0.9 and rows[1]["score"] == 0.0 and rows[2]["score"] < 0.5
    other = with_codebleu(df, "ref", {"score": "pred"}, "iec61131_3_st").collect()
    assert all(not r["codebleu_valid"] and r["score"] == 0.0 for r in other)


def test_score_rows_add_eleven_columns(spark):
    generations = spark.createDataFrame(
        [(1, FUNCTION, FUNCTION, VARIABLE, 1.5, float("inf"))],
        "example_id bigint, reference_middle string, base_generated_middle string, lora_generated_middle string, "
        "base_perplexity double, lora_perplexity double",
    )
    scored = Score.score_rows(generations)
    assert len(scored.columns) == len(generations.columns) + 11
    row = scored.first()
    assert row["base_exact_match"] == 1.0 and row["lora_exact_match"] == 0.0 and row["reference_middle"] == FUNCTION
    summary = {r["metric"]: r for r in S.metric_summary(Score.scores_long(scored)).collect()}
    assert summary["perplexity"]["n_finite"] == 0 and summary["perplexity"]["lora_average"] == float("inf")


def test_summary(spark):
    wide = spark.createDataFrame(
        [(1, 0.4, 0.7, True), (2, 0.6, 0.9, None), (3, 0.0, 0.0, False)],
        "example_id int, base_codebleu double, lora_codebleu double, codebleu_valid boolean",
    )
    row = S.metric_summary(Score.scores_long(wide)).first()
    assert (row["n"], row["base_average"], row["lora_average"]) == (2, pytest.approx(0.5), pytest.approx(0.8))
    assert row["improvement_pct"] == pytest.approx(60.0) and row["higher_is_better"] and not row["is_binary"]
    zero = wide.select("example_id", F.lit("perplexity").alias("metric"), F.lit(0.0).alias("base"), F.lit(1.0).alias("lora"))
    row = S.metric_summary(zero).first()
    assert row["improvement"] == -1.0 and row["improvement_pct"] is None
    assert S.metric_summary(zero.where("example_id > 9")).count() == 0


def test_order_statistics_with_hot_values(spark):
    data = [("a", 0.0)] * 300 + [("a", float(i)) for i in range(101)] + [("b", 7.0)] + [("c", float("inf")), ("c", 1.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {(r["g"], r["q"]): r["value"] for r in S.order_statistics(df, ["g"], "x", [0.0, 0.25, 0.9, 1.0]).collect()}
    a = sorted(x for g, x in data if g == "a")
    for q in (0.0, 0.25, 0.9, 1.0):
        h = q * (len(a) - 1)
        low = a[math.floor(h)]
        assert got["a", q] == pytest.approx(low + (a[math.ceil(h)] - low) * (h - math.floor(h)))
        assert got["b", q] == 7.0
    assert got["c", 0.0] == 1.0 and got["c", 1.0] == float("inf")


def test_histogram_edges(spark):
    x = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 1.0, 9.999, 10.0, 10.1)], "x double")
    bins = [r[0] for r in x.select(S.bin_number(F.col("x"), F.lit(0.0), F.lit(10.0), 10)).collect()]
    assert bins == [None, 0, 1, 9, 9, None]
    flat = S.observed_histogram(x.select(F.lit(3.0).alias("x")), [], "x", 4).collect()
    assert sum(r["n"] for r in flat) == 6 and min(r["left_edge"] for r in flat) == 2.5


def test_threshold_coverage_of_nothing(spark):
    empty = spark.createDataFrame([], "token_length int")
    assert tuple(S.threshold_coverage(empty, 5).first()) == (0, 0, 0)


HISTORY = [
    ("r", 10, 1.3, None), ("r", 10, None, 1.2), ("r", 20, 1.1, None), ("r", 20, None, 0.9), ("r", 30, 1.0, None),
    ("r", 30, None, 0.9), ("r", 40, None, float("inf")), ("r", 50, None, None),
]


def test_train_log(spark):
    history = spark.createDataFrame(HISTORY, "run_id string, step bigint, loss double, eval_loss double")
    log = L.split_log(history)
    assert {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()} == {"train": 3, "eval": 4}
    names = spark.createDataFrame([("checkpoint-5",), ("checkpoint-20",), ("checkpoint-100",), ("notes",)], "name string")
    assert L.select_checkpoint(log, names, "r", "best") == "checkpoint-20"
    assert L.select_checkpoint(log, names, "r", "last") == "checkpoint-100"
    with pytest.raises(ValueError):
        L.select_checkpoint(log.where("kind = 'train'"), names, "r", "best")
    with pytest.raises(FileNotFoundError):
        L.select_checkpoint(log, names.where("name = 'notes'"), "r", "last")
    with pytest.raises(FileNotFoundError):
        L.select_checkpoint(log, names.where("name = 'checkpoint-5'"), "r", "best")


def test_perplexity(spark):
    probs = spark.createDataFrame(
        [(1, -0.693, False), (1, -9.0, True), (2, -1.0, True)], "example_id int, logprob double, masked boolean"
    )
    examples = spark.createDataFrame([(1,), (2,), (3,)], "example_id int")
    got = {r["example_id"]: r["perplexity"] for r in L.example_perplexity(probs, examples).collect()}
    assert got == {1: pytest.approx(math.exp(0.693)), 2: float("inf"), 3: float("inf")}


def test_weights_are_checked():
    with pytest.raises(ValueError):
        EvalParams(codebleu_ngram_weight=0.5)


def test_a_metric_of_ones_own_reaches_the_summary(spark):
    from gapweave.operators import scoring

    rows = spark.createDataFrame([(1, "abc", "ab", "abc", 2.0, 1.0)], "example_id bigint, reference_middle string, base_generated_middle string, lora_generated_middle string, base_perplexity double, lora_perplexity double")
    own = [scoring.Metric("missing", lambda ref, pred: (F.length(ref) - F.length(pred)).cast("double"), higher_is_better=False)]
    long = scoring.scores_long(scoring.score_rows(rows, own=own), own=own)
    summary = {r["metric"]: r for r in S.metric_summary(long, own).collect()}
    assert summary["missing"]["improvement"] == 1.0 and "exact_match" in summary
    assert {r["metric"]: r["improvement"] for r in S.metric_summary(long).collect()}["missing"] is None


def test_summaries_have_codebleu_with_its_validity(spark, monkeypatch):
    from gapweave.queries import QUERIES, evaluation

    code = "int f(int n) {\n    int s = 0;\n    for (int k = 0; k < n; k++) {\n        s += k;\n    }\n    return s;\n}"
    some = [(i, code, code.replace("k", "j"), code[: 40 + i], 2.0, 1.5) for i in range(4)] + [(9, "", code, "x", 2.0, 3.0)]
    names = "example_id long, reference_middle string, base_generated_middle string, lora_generated_middle string, base_perplexity double, lora_perplexity double"
    monkeypatch.setattr(evaluation, "code_generation_rows", lambda spark, folder: spark.createDataFrame(some, names))
    rows = QUERIES["score_rows_all"](spark, "").collect()
    valid = [r for r in rows if r.codebleu_valid is not False]
    assert 0 < len(valid) < len(rows)
    summary = {r.metric: r for r in QUERIES["metric_summary_all"](spark, "").collect()}
    assert len(summary) == 6 and summary["codebleu"].n == len(valid) and summary["exact_match"].n == len(rows)
    for side in ("base", "lora"):
        want = sum(r[f"{side}_codebleu"] for r in valid) / len(valid)
        assert summary["codebleu"][f"{side}_average"] == pytest.approx(want, abs=2e-6)
    paired = QUERIES["paired_scores_all"](spark, "").collect()
    assert sum(r.metric == "codebleu" for r in paired) == len(valid)
    assert "codebleu" in str(QUERIES["report_json"](spark, "").collect())
    for name in ("improvement", "metric_registry", "five_number", "diff_hist", "diff_summary"):
        assert "codebleu" in {r.metric for r in QUERIES[f"{name}_all"](spark, "").select("metric").collect()}
    assert "evaluate.codebleu.base" in {r.name for r in QUERIES["metrics_long_all"](spark, "").collect()}


def test_edit_similarity_skips_what_both_texts_begin_and_end_with(spark):
    # The bit vectors of the whole texts would take some 10 ** 11 steps of a processor.
    ends = "one two three " * 40_000
    rows = [(f"{ends}kitten{ends}", f"{ends}sitting{ends}"), ("abc", "xaby"), ("ab" * 50, "ba" * 50 + "c")]
    started = time.monotonic()
    got = values(pairs(spark, *rows), M.edit_similarity("ref", "pred"))
    assert time.monotonic() - started < 20
    assert got == pytest.approx([1 - 3 / (2 * len(ends) + 7), 1 - 2 / 4, 1 - 2 / 101])


def test_sentence_bleu_of_many_rows_runs_in_batches(spark):
    rng = random.Random(3)
    some = [" ".join(rng.choice("abcdefg.") for _ in range(rng.randint(1, 30))) for _ in range(300)]
    rows = [(r, rng.choice([p, r, r[:-4]])) for r, p in zip(some, reversed(some))]

    scored = pairs(spark, *rows).select(M.sentence_bleu("ref", "pred"))
    assert "ArrowEvalPython" in scored._jdf.queryExecution().executedPlan().toString()
    assert values(pairs(spark, *rows), M.sentence_bleu("ref", "pred")) == pytest.approx([brute_bleu(r.split(), p.split()) for r, p in rows])
