import collections
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gapweave.llm import kernels, mixing, packing, sharding
from tests.llm.fixtures import documents, empty, rows


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@given(st.integers(1, 10_000))
def test_lengths_are_falling_powers_of_two(n):
    lengths = kernels.binary_lengths(n, 1024)
    assert sum(lengths) == n and lengths == sorted(lengths, reverse=True)
    assert all(x & (x - 1) == 0 and x <= 1024 for x in lengths)
    assert all(lengths.count(x) == 1 for x in lengths if x < 1024)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_rank_file_encodes_as_the_tokenizer_file(reference, text):
    encoder = kernels.byte_bpe(packing.VOCABULARY)
    assert encoder.encode_ordinary(text) == reference.encode(text, add_special_tokens=False).ids


def test_special_strings_are_text(reference):
    text = "a<|endoftext|>b"
    assert kernels.byte_bpe(packing.VOCABULARY).encode_ordinary(text) == reference.encode(text, add_special_tokens=False).ids


def test_pieces_round_trip(spark, reference):
    out = packing.pack(documents(spark)).collect()
    assert sorted(r.sequence_id for r in out) == list(range(len(out)))
    assert [r.bucket for r in sorted(out, key=lambda r: r.sequence_id)] == sorted((r.length for r in out), reverse=True)
    assert all(r.offset == 0 and len(r.ids) == 4 * r.length for r in out)
    got = collections.Counter()
    by_doc = collections.defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
    for doc_id, pieces in by_doc.items():
        texts = [t for i, t, *_ in rows() if i == doc_id]
        ids = reference.encode(texts[0] or "", add_special_tokens=False).ids + [0]
        found = {(p.start, p.ids) for p in pieces}
        assert len(pieces) == len(found) * len(texts)
        joined = b"".join(ids for _, ids in sorted(found))
        assert np.frombuffer(joined, "<u4").tolist() == ids
        assert all(p.doc_tokens == len(ids) for p in pieces)
        got[doc_id] += len(texts)
    assert sum(got.values()) == len(rows())


def test_packing_of_nothing(spark):
    assert packing.pack(empty(spark)).collect() == []


def _targets(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_weights = sum(weight[s] for s in sizes if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / open_weights for s in sizes}
        more = {s for s in sizes if s not in full and target[s] > 3 * sizes[s]}
        if not more:
            return target
        full |= more


def test_mix_meets_its_targets(spark):
    many = [(i, " ".join(["w"] * (1 + i * i % 37)), "en", "abcdé"[i % 5] if i % 7 else None) for i in range(400)]
    many += [(1000 + i, "x " * 5, "en", "tiny") for i in range(2)]
    out = mixing.mix(documents(spark, many)).collect()
    sizes = collections.Counter()
    for r in out:
        sizes[r.source] += r["size"]
    target = _targets(sizes)
    for s in sizes:
        taken = sum(r.taken for r in out if r.source == s)
        assert abs(taken - target[s]) <= 1
        assert all(math.isclose(r.target, target[s]) and r.source_size == sizes[s] for r in out if r.source == s)
    assert all(0 <= r.taken <= 3 * r["size"] for r in out)
    again = mixing.mix(documents(spark, many).repartition(7)).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_longer_documents_are_likelier(spark):
    many = [(i, "w " * (1 if i % 2 else 200), "en", "ab"[i % 4 // 2]) for i in range(2000)]
    out = [r for r in mixing.mix(documents(spark, many)).collect() if r.source == "a"]
    share = lambda size: np.mean([r.taken > 0 for r in out if r["size"] == size])
    assert share(200) > share(1) + 0.1


def test_mix_of_awkward_rows(spark):
    out = mixing.mix(documents(spark)).collect()
    assert len(out) == len(rows())
    assert all(r.taken == 0 for r in out if r.doc_id in (5, 6, 7))
    docs = documents(spark)
    applied = mixing.apply_mix(docs)
    assert applied.schema.names == docs.schema.names
    taken = collections.Counter()
    for r in out:
        taken[r.doc_id] += r.taken
    got = collections.Counter()
    for r in applied.collect():
        got[r.doc_id] += len([w for w in r.text.split() if w])
        assert r.n_chars == len(r.text) and r.key == "k"
    assert {k: v for k, v in taken.items() if v} == dict(got)


def test_mix_of_nothing(spark):
    assert mixing.mix(empty(spark)).collect() == []
    assert mixing.apply_mix(empty(spark)).collect() == []


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_exactly_balanced(spark, shards):
    many = rows() + [(100 + i, f"t{i}", "en", "a") for i in range(500)] + [(700, "same", "en", "a")] * 40
    out = sharding.shard_rows(documents(spark, many), shards, replicas=16).collect()
    assert len(out) == len(many)
    counts = collections.Counter(r.shard for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1 and set(counts) <= set(range(shards))
    for shard, n in counts.items():
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(n))
    want = collections.Counter((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in many)
    assert collections.Counter((r["size"], r.text_crc32) for r in out) == want


def test_few_rows_leave_home(spark):
    many = [(i, f"text {i}", "en", "a") for i in range(4000)]
    out = sharding.shard_rows(documents(spark, many), 8).collect()
    assert sum(r.shard != r.home_shard for r in out) < 0.25 * len(out)
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(documents(spark, many).repartition(5), 8).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in out}


def test_overflow_goes_to_the_next_place_with_room(spark):
    """Key by key on the driver: full nodes pass their last rows on clockwise."""
    many = [(i, f"text {i}", "en", "a") for i in range(300)]
    docs = documents(spark, many)
    out = sharding.shard_rows(docs, 4, replicas=3).collect()
    nodes = sharding.ring(spark, 4, 3).orderBy("position").collect()
    homes = collections.Counter(r.home_shard for r in out)
    kept = collections.Counter(r.home_shard for r in out if r.shard == r.home_shard)
    assert len(nodes) == 12 and sum(homes.values()) == 300
    for shard in range(4):
        assert kept[shard] <= 75


def test_shards_of_nothing_and_of_few(spark):
    assert sharding.shard_rows(empty(spark), 8).collect() == []
    few = sharding.shard_rows(documents(spark, rows()[:3]), 8).collect()
    assert len({r.shard for r in few}) == 3 and all(r.slot == 0 for r in few)
