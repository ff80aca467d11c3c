import pytest
from pyspark.sql import functions as F

from gapweave.functions.keys import shuffle_key
from gapweave.operators import feed as Feed
from gapweave.operators.ranking import drop_smallest, keep_quota, keep_smallest, rank_within
from gapweave.operators.splits import category_counts, split_exact, split_size_table, split_sizes, split_stratified
from gapweave.params import SplitParams


def keyed(spark, n):
    return spark.range(n).withColumn("key", shuffle_key("t", 0, F.col("id")))


def brute_order(df):
    return [r["id"] for r in sorted(df.collect(), key=lambda r: (r["key"], r["id"]))]


@pytest.mark.parametrize("k", [0, 1, 7, 499, 500, 501])
def test_keep_and_drop_smallest(spark, k):
    df = keyed(spark, 500)
    order = brute_order(df)
    assert sorted(r["id"] for r in keep_smallest(df, "key", ["id"], k).collect()) == sorted(order[:k])
    assert sorted(r["id"] for r in drop_smallest(df, "key", ["id"], k).collect()) == sorted(order[k:])


def test_equal_keys_fall_back_to_the_tie_column(spark):
    df = spark.range(50).withColumn("key", F.lit("ab12"))
    assert sorted(r["id"] for r in keep_smallest(df, "key", ["id"], 20).collect()) == list(range(20))
    ranked = rank_within(df, [], "key", ["id"]).collect()
    assert {r["id"]: r["rank"] for r in ranked} == {i: i + 1 for i in range(50)}


def test_rank_with_one_group_holding_most_rows(spark):
    df = keyed(spark, 600).withColumn("g", F.when(F.col("id") < 500, "hot").otherwise(F.col("id").cast("string")))
    rows = rank_within(df, ["g"], "key", ["id"], size="n").collect()
    assert len(rows) == 600
    hot = sorted((r for r in rows if r["g"] == "hot"), key=lambda r: r["rank"])
    assert [r["rank"] for r in hot] == list(range(1, 501))
    assert [r["id"] for r in hot] == [i for i in brute_order(df) if i < 500]
    assert all(r["n"] == (500 if r["g"] == "hot" else 1) for r in rows)


def test_quota_per_group(spark):
    df = keyed(spark, 300).withColumn("g", F.when(F.col("id") < 200, "a").when(F.col("id") < 290, "b").otherwise("c"))
    quotas = spark.createDataFrame([("a", 15), ("b", 1000), ("c", 0)], "g string, quota bigint")
    counts = {r["g"]: r["count"] for r in keep_quota(df, ["g"], "key", ["id"], quotas).groupBy("g").count().collect()}
    assert counts == {"a": 15, "b": 90}


def test_result_does_not_depend_on_partitions(spark):
    params = SplitParams(0.7, 0.2, 0.1)
    one = split_exact(spark.range(0, 1000, 1, 1), ["id"], params)
    many = split_exact(spark.range(0, 1000, 1, 13).repartition(7), ["id"], params)
    assert sorted(one.collect()) == sorted(many.collect())


def test_ten_files_cut_seven_two_one(spark):
    split = split_exact(spark.range(10), ["id"], SplitParams(0.7, 0.2, 0.1))
    assert {r["split"]: r["n"] for r in split_sizes(split).collect()} == {"train": 7, "eval": 2, "test": 1}


def test_empty_input_gives_empty_splits(spark):
    split = split_exact(spark.range(0), ["id"])
    assert {r["split"]: r["n"] for r in split_sizes(split).collect()} == {"train": 0, "eval": 0, "test": 0}


def test_the_two_splits_round_differently(spark):
    df = spark.range(19).withColumn("c", F.lit("K"))
    exact = split_sizes(split_exact(df, ["id"])).collect()
    assert {r["split"]: r["n"] for r in exact} == {"train": 15, "eval": 2, "test": 2}
    counts = category_counts(split_stratified(df, "c", ["id"]), "c").collect()
    assert [(r["train"], r["eval"], r["test"], r["total"]) for r in counts] == [(15, 1, 3, 19)]


def test_ratios_must_sum_to_one():
    with pytest.raises(ValueError):
        SplitParams(0.8, 0.1, 0.2)
    assert SplitParams.from_mapping({"train_ratio": 0.5, "eval_ratio": 0.4, "unknown": 1}).train_ratio == 0.5


def test_null_is_a_group_of_its_own(spark):
    from gapweave.operators.ranking import rank_within
    from gapweave.operators.summary import observed_histogram, order_statistics

    rows = spark.createDataFrame(
        [("a", "00", 1.0), (None, "01", 2.0), (None, "02", 4.0), ("a", "03", float("inf"))], "g string, k string, x double"
    )
    ranks = {(r["g"], r["k"]): r["rank"] for r in rank_within(rows, ["g"], "k", []).collect()}
    assert ranks == {("a", "00"): 1, ("a", "03"): 2, (None, "01"): 1, (None, "02"): 2}
    medians = {r["g"]: r["value"] for r in order_statistics(rows.where("k < '03'"), ["g"], "x", [0.5]).collect()}
    assert medians == {"a": 1.0, None: 3.0}
    bins = observed_histogram(rows, ["g"], "x", 2).collect()
    assert {(r["g"], r["non_finite"]) for r in bins} == {("a", 1), (None, 0)}
    assert sum(r["n"] for r in bins) == 3


@pytest.mark.parametrize("size", [1, 7, 64])
def test_batches_of_one_shuffle(spark, monkeypatch, size):
    monkeypatch.setattr(Feed, "WIDE", 1)  # sixteen buckets, so that batches lie on borders and over several buckets
    rows = [(i % 50, i, list(range(i % 13))) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b int, input_ids array<int>")
    batches = Feed.feed_batches(df, ["a", "b"], size)
    got = {r["position"]: r for r in batches.collect()}
    order = {(r["a"], r["b"]): r["position"] for r in Feed.feed_order(df, ["a", "b"]).collect()}
    assert sorted(got) == list(range(1, 301)) and all(order[r["a"], r["b"]] == p for p, r in got.items())
    for p, r in got.items():
        mates = [x for q, x in got.items() if (q - 1) // size == (p - 1) // size]
        assert r["batch_no"] == (p - 1) // size and r["batch_length"] == max(len(x["input_ids"]) for x in mates)
    old = Feed.collate_right(Feed.feed_order(df, ["a", "b"]), size, 9).select("position", "input_ids", "labels", "attention_mask")
    new = Feed.collate_right(batches, size, 9).select("position", "input_ids", "labels", "attention_mask")
    assert sorted(old.collect()) == sorted(new.collect())


def test_id_arrays_are_shuffled_once(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [3])], "a int, input_ids array<int>")
    with_ids = [n for n in _exchanged_columns(Feed.feed_batches(df, ["a"], 2)) if "input_ids" in n]
    assert len(with_ids) == 1


def _exchanged_columns(df):
    """Output columns of every shuffle in the physical plan."""
    found, plan = [], df._jdf.queryExecution().executedPlan()

    def walk(node):
        name = node.nodeName()
        if name == "Exchange":
            out = node.output()
            found.append([out.apply(k).name() for k in range(out.size())])
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(plan.initialPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    return found


def test_batches_of_nothing(spark):
    df = spark.createDataFrame([], "a int, input_ids array<int>")
    assert Feed.collate_right(Feed.feed_batches(df, ["a"], 4), 4, 0).collect() == []


def test_size_table_tells_nulls_from_sums(spark):
    df = spark.createDataFrame([("c", "train"), ("c", "train"), ("c", "test"), (None, "train")], "lang string, split string")
    got = {(r["level"], r["lang"], r["split"]): (r["n"], r["share"]) for r in split_size_table(df, "lang").collect()}
    assert got == {
        ("column, split", "c", "train"): (2, pytest.approx(2 / 3)), ("column, split", "c", "test"): (1, 1.0),
        ("column, split", None, "train"): (1, pytest.approx(1 / 3)), ("column", "c", None): (3, 0.75), ("column", None, None): (1, 0.25),
        ("split", None, "train"): (3, 0.75), ("split", None, "test"): (1, 0.25), ("all", None, None): (4, 1.0),
    }
    assert split_size_table(df.limit(0), "lang").where("level <> 'all'").count() == 0
