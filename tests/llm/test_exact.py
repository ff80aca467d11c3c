import collections
import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from gapweave.llm import exact, kernels
from gapweave.llm.queries import op11_exact
from tests.llm.fixtures import documents, empty, rows, words


def _normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _plainly(some):
    groups = collections.defaultdict(list)
    for i, t, *_ in some:
        groups[_normal(t)].append(i)
    out = collections.Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        for place, i in enumerate(ids):
            out[(i, ids[0], len(ids), place == 0, sha)] += 1
    return out


def _awkward():
    long = words(8, 4000)
    some = rows() + [(100 + i, t, "en", "a") for i, t in enumerate(["a  b", "a b", "a\tb", " a b", "a b", "a\x0b\x0cb", "A b"])]
    some += [(-5, "a b", "en", "a"), (None, "a b", "en", "b"), (None, "lone", "en", "b"), (None, "lone", "en", "b")]
    some += [(200 + i, long, "en", "a") for i in range(40)] + [(300, long + ".", "en", "a"), (301, long.replace(" ", "\n"), "en", "a")]
    some += [(400 + i, words(50 + i % 7, 30), "en", "a") for i in range(60)]
    return some


@settings(max_examples=200, deadline=None)
@given(st.text("ab \t\n\x0b\x0c\r\x85 ", max_size=30))
def test_white_space(text):
    assert kernels.one_blank(text) == _normal(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(-2, 2), st.binary(max_size=2)), max_size=200))
def test_table_compares_contents_where_fingerprints_clash(some):
    table, known = kernels.ContentTable(), {}
    for mark, content in some:
        assert table.place(mark, content) == known.setdefault((mark, content), len(known))
    assert table.held == sum(len(c) for _, c in known)


def test_table_grows():
    table = kernels.ContentTable()
    marks = [kernels.fingerprint(b"%d" % i) for i in range(5000)]
    assert [table.place(m, b"%d" % i) for i, m in enumerate(marks)] == list(range(5000))
    assert [table.place(m, b"%d" % i) for i, m in enumerate(marks)] == list(range(5000))


# The least fits make every bucket large, so that levels follow each other and copies are dealt by salt.
@pytest.mark.parametrize("fit", [exact.FIT, 20_000, 300])
def test_groups_against_brute_force(spark, fit):
    some = _awkward()
    docs = documents(spark, some).repartition(5)
    out = exact.duplicates(docs, fit=fit)
    assert collections.Counter(map(tuple, out.collect())) == _plainly(some)


def test_hot_text_is_dealt_by_salt(spark, monkeypatch):
    monkeypatch.setattr(exact, "SALTS", 2)
    monkeypatch.setattr(exact, "_ROWS", 3)
    some = [(i, "hot text " * 40 if i % 3 else words(i, 4), "en", "a") for i in range(120)]
    levels = []
    respilled = exact._respilled
    monkeypatch.setattr(exact, "_respilled", lambda *a: levels.append(1) or respilled(*a))
    out = exact.duplicates(documents(spark, some).repartition(4), fit=500)
    assert collections.Counter(map(tuple, out.collect())) == _plainly(some)
    assert levels


def test_keep_first_keeps_rows_and_columns(spark):
    some = _awkward()
    docs = documents(spark, some)
    out = exact.keep_first(docs)
    assert out.schema == docs.schema
    want = [(i, sha) for (i, _, _, kept, sha), n in _plainly(some).items() for _ in range(n) if kept]
    sha = lambda t: hashlib.sha256(_normal(t).encode()).hexdigest()
    assert sorted(((r.doc_id, sha(r.text)) for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_no_documents(spark):
    assert exact.duplicates(empty(spark)).collect() == []
    assert exact.keep_first(empty(spark)).collect() == []


def test_registered_query(spark, tmp_path):
    documents(spark, _awkward()).write.parquet(str(tmp_path / "documents.parquet"))
    out = op11_exact(spark, str(tmp_path))
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(map(tuple, out.collect())) == _plainly(_awkward())
