import collections
import hashlib
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from gapweave.llm import arrays, infill
from gapweave.llm.queries import op12_infill
from tests.llm.fixtures import documents, empty, rows


def _plainly(text, draws, rate=100, spm_rate=50):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(lines)
    a, b = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    if not text or any(m in text for m in infill.MARKERS) or draws[2] % 100 >= rate:
        return n, "plain", None, None, None, text
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if draws[3] % 100 < spm_rate:
        return n, "spm", prefix, middle, suffix, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", prefix, middle, suffix, f"<P>{prefix}<S>{suffix}<M>{middle}"


def _draws(doc_id):
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


_TEXTS = st.one_of(st.none(), st.text("a\n<S>é😀\r ", max_size=30), st.text("ab\n", max_size=12))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(_TEXTS, st.lists(st.integers(0, 2**32 - 1), min_size=4, max_size=4)), min_size=1, max_size=8))
def test_columns_equal_the_plain_way(some):
    texts = pa.array([t for t, _ in some], pa.string())
    draws = [pa.array([d[k] for _, d in some], pa.int64()) for k in range(4)]
    out = arrays.infilled(texts, draws, 70, 50, infill.MARKERS)
    got = list(zip(*(column.to_pylist() for column in out)))
    assert got == [_plainly(t or "", d, rate=70) for t, d in some]


def test_slices_hold_every_row_once():
    batch = pa.record_batch({"id": list(range(9)), "text": ["x" * 5, None, "y" * 40, "", "z" * 9, "", "w" * 30, None, "v"]})
    parts = list(arrays.byte_slices(batch, 1, 20))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(9)) and len(parts) > 3
    assert all(sum(map(len, filter(None, p.column(1).to_pylist()))) <= 20 or p.num_rows == 1 for p in parts)


def _awkward():
    texts = ["one\ntwo\nthree", "\n\n\n", "no break", "a <P> b\nc", "x\r\ny\r\n", "<<S\n>", "é\n😀\n" * 40, "line\n" * 20_000]
    return rows() + [(100 + i, t, "en", "a") for i, t in enumerate(texts)]


def test_documents_and_their_restoration(spark):
    docs = documents(spark, _awkward())
    out = infill.infill(docs).withColumn("again", infill.restored(infill.F.col("output"), infill.F.col("form"))).collect()
    want = collections.Counter((i, *_plainly(t or "", _draws(i))) for i, t, *_ in _awkward())
    got = collections.Counter((r.doc_id, r.n, r.form, r.prefix, r.middle, r.suffix, r.output) for r in out)
    assert got == want and len({r.form for r in out}) == 3
    texts = collections.Counter((i, t or "") for i, t, *_ in _awkward())
    assert collections.Counter((r.doc_id, r.again) for r in out) == texts


def test_rate_leaves_texts_plain(spark):
    out = infill.infill(documents(spark), rate=0).collect()
    assert {r.form for r in out} == {"plain"}


def test_no_documents(spark):
    out = infill.infill(empty(spark))
    assert out.collect() == [] and out.columns == ["doc_id", "n", "form", "prefix", "middle", "suffix", "output"]


def test_registered_query(spark, tmp_path):
    documents(spark, _awkward()).write.parquet(str(tmp_path / "documents.parquet"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = collections.Counter()
    for i, t, *_ in _awkward():
        n, form, prefix, middle, _, output = _plainly(t or "", _draws(i))
        size = lambda part: None if part is None else len(part)
        want[(i, n, form, size(prefix), size(middle), sha(output), sha(t or ""))] += 1
    out = op12_infill(spark, str(tmp_path))
    assert collections.Counter(map(tuple, out.collect())) == want
    assert dict(out.dtypes)["prefix_chars"] == dict(out.dtypes)["n"] == "bigint"


@pytest.mark.parametrize("markers", [("[1]", "[2]", "[3]")])
def test_own_markers(spark, markers):
    out = infill.infill(documents(spark), markers=markers)
    back = out.select("doc_id", infill.restored(infill.F.col("output"), infill.F.col("form"), markers).alias("t"))
    assert collections.Counter(map(tuple, back.collect())) == collections.Counter((i, t or "") for i, t, *_ in rows())
