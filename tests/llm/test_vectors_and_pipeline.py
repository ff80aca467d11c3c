import collections
import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from gapweave.llm import embeddings, kernels, queries, topk
from gapweave.llm.common import number_rows, smallest_reachable
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tests.llm.fixtures import documents, empty, words
from tests.oracle import compare, connect
from tests.test_growth import plan

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id bigint, embedding array<float>, label int, class_id int, number int"


def _vectors(seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for group in range(6):
        base = rng.normal(size=16)
        for k in range(12):
            out.append((base + rng.normal(size=16) * 0.02 * k).astype(np.float32).tolist())
    labelled = [(i, v, i % 2) for i, v in enumerate(out)]
    copies = [(100 + i, out[0], 0) for i in range(5)]
    odd = [
        (200, None, 0),
        (201, [0.0] * 16, 0),
        (202, [1.0, None] + [0.0] * 14, 0),
        (203, [float("nan")] * 16, 0),
        (204, [float("inf")] * 16, 0),
        (205, out[0], None),
        (None, out[0], 0),
        (206, out[0][:8], 0),
        (207, [], 0),
        (100, out[0], 0),
    ]
    return labelled + copies + odd


def _frame(spark, some):
    return spark.createDataFrame([(*r, 7, 7) for r in some], VECTORS)


def _usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


@pytest.mark.parametrize("block", [512, 3])
def test_links_against_all_pairs(spark, block):
    some = _vectors()
    n = len(some)
    linked = np.zeros((n, n), dtype=bool)
    for i, (_, a, la) in enumerate(some):
        for j, (_, b, lb) in enumerate(some):
            if i != j and la is not None and la == lb and _usable(a) and _usable(b) and len(a) == len(b) and any(a) and any(b):
                x, y = np.array(a, dtype=float), np.array(b, dtype=float)
                linked[i, j] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98 or a == b
    group = list(range(n))
    for i, j in zip(*np.nonzero(linked)):
        old, new = group[i], group[j]
        group = [new if g == old else g for g in group]
    want = collections.Counter()
    for i, (vec_id, *_) in enumerate(some):
        ids = [some[k][0] for k in range(n) if group[k] == group[i] and some[k][0] is not None]
        component = min(ids, default=None)
        want[(vec_id, int(linked[i].sum()), component, vec_id is not None and vec_id == component)] += 1
    out = embeddings.near_duplicates(_frame(spark, some), block=block).collect()
    assert collections.Counter(tuple(r) for r in out) == want


def test_no_vectors(spark):
    assert embeddings.near_duplicates(_frame(spark, [])).collect() == []
    assert topk.search(_frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("page,queries_per_block", [(1024, 1024), (8, 3)])
def test_top_k_against_all_products(spark, monkeypatch, page, queries_per_block):
    monkeypatch.setattr(topk, "PAGE", page)
    monkeypatch.setattr(topk, "QUERIES", queries_per_block)
    some = [r for r in _vectors(4)]
    usable = [(i, np.floor(256 * np.array(v, dtype=float)).astype(int).tolist()) for i, v, _ in some if i is not None and _usable(v)]
    want = collections.Counter()
    for at, (q, a) in enumerate(usable):
        if q % 10 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for k, (i, b) in enumerate(usable) if k != at]
            want.update((q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:5]))
    out = topk.search(_frame(spark, some), F.col("vec_id") % 10 == 0, k=5, slices=3).collect()
    assert collections.Counter(tuple(r) for r in out) == want


def test_pages_and_queries_travel_apart(spark):
    some = _frame(spark, [(i, v, c) for i, v, c in _vectors(4) if i is not None])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        steps = plan(topk.search(some, F.col("vec_id") % 10 == 0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "FlatMapCoGroupsInArrow" in steps and "SortMergeJoin" not in steps


def test_search_needs_no_package_on_the_workers(tmp_path):
    steps = [kernels.place_vectors, kernels.pack_page, kernels.queries_of_pages, kernels.pack_block, kernels.search_pages]
    (tmp_path / "steps").write_bytes(cloudpickle.dumps(steps))
    code = "from pyspark import cloudpickle; import sys; print(len(cloudpickle.load(open('steps', 'rb'))), 'gapweave' in sys.modules)"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.stdout.split() == ["5", "False"]


def test_page_limits_its_queries():
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, size=(40, 8))
    group = pa.table({
        "number": range(40), "vec_id": range(40), "ints": [row.astype("<i2").tobytes() for row in x], "page": [0] * 40,
        "parent": [0] * 40, "distance": rng.random(40), "asked": [i % 4 == 0 for i in range(40)],
    })
    packed = kernels.pack_page(group, float((x**2).sum(axis=1).max()), 8, "<i2", 5).to_pylist()[0]
    want = [sorted(np.delete(x @ x[i], i))[-5] for i in range(0, 40, 4)]
    assert np.frombuffer(packed["floors"], dtype=np.int64).tolist() == want


def test_fewer_rows_than_k(spark):
    out = topk.search(_frame(spark, [(0, [1.0, 2.0], 0), (1, [1.0], 0)]), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in out] == [(0, 1, 1, 256 * 256)]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(500, 499), (499, 498), (7, 7)]
    out = {r.node: r.root for r in smallest_reachable(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert out == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(30)}, **{k: 498 for k in (498, 499, 500)}}


def test_row_numbers(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), "id").repartition(6)
    out = number_rows(df, [F.col("a"), F.col("id")], "n").orderBy("n").collect()
    assert [r.n for r in out] == list(range(1000))
    assert [(r.a, r.id) for r in out] == sorted((r.a, r.id) for r in out)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) == []


def test_pipeline_stages_keep_clean_documents(spark, tmp_path):
    rng = np.random.default_rng(1)
    kinds = {"xx": "abcde", "zz": "mnopq"}
    some = []
    for i in range(60):
        lang = "xx" if i % 2 else "zz"
        text = " ".join("".join(rng.choice(list(kinds[lang]), 5)) for _ in range(80))
        some.append((i, text, lang, "s" + str(i % 3)))
    some += [(100, some[0][1], "zz", "s0"), (101, None, "xx", "s1"), (102, "?! 12", "xx", "s1"), (103, some[1][1] + " a@b.cc", "xx", "s1")]
    docs = documents(spark, some).select("doc_id", "text", "lang", "source", "n_chars")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids = {r.doc_id for r in docs.collect()}
        if name != "packing":
            assert docs.columns == before.columns
        if name == "language":
            assert ids == set(range(60)) | {100, 103}
        if name == "near_duplicates":
            assert ids == set(range(60)) and docs.count() == 60
    assert docs.count() > 0 and sum(r.length for r in docs.collect()) > 0


def test_pipeline_of_nothing(spark, tmp_path):
    docs = empty(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() == 0
