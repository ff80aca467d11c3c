import collections
import hashlib
import json

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from gapweave.llm import alignment, arrays, kernels
from gapweave.llm.queries import op13_alignment
from tests.llm.fixtures import documents, empty, rows, words


def _byte_letters():
    """The letters that stand for the 256 bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Plainly:
    """Both tokenizers by their own files, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(alignment.FILE_A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=alignment.FILE_B)
        letters = _byte_letters()
        vocabulary = json.load(open(alignment.FILE_A))["model"]["vocab"]
        self.of_a = {k: bytes(letters[c] for c in entry) for entry, k in vocabulary.items() if all(c in letters for c in entry)}

    def piece(self, k):
        piece = self.b.id_to_piece(k)
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a = [(k, self.of_a[k]) for k in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(k, self.piece(k)) for k in self.b.encode(text)]
        wanted = (" " + text).encode()
        return (a, b) if b"".join(t for _, t in a) == wanted == b"".join(t for _, t in b) else ([], [])

    def places(self, tokens):
        out, at = [], 0
        for k, token in tokens:
            out.append((k, at, at + len(token)))
            at += len(token)
        return out

    def text(self, text):
        """n_a, n_b, groups, all links."""
        a, b = (self.places(t) for t in self.tokens(text))
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in ends:
            sides = [",".join(str(k) for k, low, high in side if start <= low and high <= end) for side in (a, b)]
            groups.append("|".join(sides))
            start = end
        links, first = [], 0
        for i, low, high in a:
            while b[first][2] <= low:
                first += 1
            at = first
            while at < len(b) and b[at][1] < high:
                links.append((i, b[at][0]))
                at += 1
        return len(a), len(b), groups, links


@pytest.fixture(scope="module")
def plainly():
    return _Plainly()


def _expected(plainly, some):
    found = [(i, *plainly.text(t)) for i, t, *_ in some]
    count = collections.Counter(pair for *_, links in found for pair in set(links))
    highest = collections.defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = collections.Counter()
    for i, n_a, n_b, groups, links in found:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(count[pair] == highest[pair[0]] for pair in links)
        out[(i, n_a, n_b, len(groups), len(links), best, sum(count[pair] for pair in links), sha)] += 1
    return out


def _awkward():
    texts = [
        " leading", "two  blanks", "tab\tand\nline\r\n", "é😀 naïve", "<|endoftext|> </s> <unk>", "▁ mark", "ﬁ ligature ½", "á",
        " ", " ", "日本語のテキスト", "x" * 3000, "a \x00 b", "﻿bom", "1234567 3.14", "don't WON'T", "​ ",
    ]
    return rows() + [(100 + i, t, "en", "a") for i, t in enumerate(texts)] + [(200 + i, words(i % 5, 60), "en", "a") for i in range(30)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab é😀\n▁<0x41>.", max_size=25), st.text(max_size=12)), min_size=1, max_size=6))
def test_columns_of_a_batch(plainly, texts):
    a, b = kernels.byte_tokens(alignment.RANKS_A, alignment.FILE_A), kernels.piece_tokens(alignment.FILE_B)
    columns, pairs = arrays.aligned_texts(texts, a, b, True)
    found = [plainly.text(t) for t in texts]
    assert list(zip(*(c.to_pylist() for c in columns)))  == [
        (n_a, n_b, len(groups), len(links), ";".join(groups), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for n_a, n_b, groups, links in found
    ]
    times = {(k, p >> 32, p & 0xFFFFFFFF): n for k, p, n in zip(*(pairs[c].to_pylist() for c in ("text", "pair", "times")))}
    assert times == {(k, *pair): n for k, (*_, links) in enumerate(found) for pair, n in collections.Counter(links).items()}


def test_overlaps_of_given_tokens():
    # ab|c|def against a|bcd|ef: every overlap once, one group (no end is shared before the last).
    ids = lambda *k: pa.array([list(k)], pa.list_(pa.int32()))
    a = arrays.token_ends(ids(0, 1, 2), pa.array([2, 1, 3]))
    b = arrays.token_ends(ids(0, 1, 2), pa.array([1, 3, 2]))
    text, left, right, shared, *_ = arrays.linked_tokens(a, b)
    assert list(zip(left.to_pylist(), right.to_pylist())) == [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2)]
    assert shared.to_pylist() == [False] * 4 + [True]


@pytest.mark.parametrize("links, texts", [(alignment.LINKS, alignment.TEXTS), (40, 1000), (1 << 20, 3)])
def test_alignment_against_brute_force(spark, plainly, monkeypatch, links, texts):
    monkeypatch.setattr(alignment, "LINKS", links)
    monkeypatch.setattr(alignment, "TEXTS", texts)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 2000)
    out = alignment.alignments(documents(spark, _awkward()).repartition(3)).collect()
    got = collections.Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in out)
    assert got == _expected(plainly, _awkward())
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in out)


def test_counts_of_pairs(spark, plainly):
    table = alignment.settle(alignment.aligned(documents(spark, _awkward())))
    got = {(r.pair >> 32, r.pair & 0xFFFFFFFF): (r.documents, r.best) for r in alignment.pair_counts(table).collect()}
    count = collections.Counter(pair for _, t, *_ in _awkward() for pair in set(plainly.text(t)[3]))
    best = {a: max(n for (x, _), n in count.items() if x == a) for a, _ in count}
    assert got == {pair: (n, n == best[pair[0]]) for pair, n in count.items()}


def test_no_documents(spark):
    assert alignment.alignments(empty(spark)).collect() == []


def test_registered_query(spark, plainly, tmp_path):
    documents(spark, _awkward()).write.parquet(str(tmp_path / "documents.parquet"))
    out = op13_alignment(spark, str(tmp_path))
    assert {t for c, t in out.dtypes if c != "groups_sha256"} == {"bigint"}
    assert collections.Counter(map(tuple, out.collect())) == _expected(plainly, _awkward())


def test_very_long_runs_of_blanks(spark):
    text = "x" + " " * 1_000_000 + "y"
    out = alignment.alignments(documents(spark, [(1, text, "en", "a")])).collect()
    reference = Tokenizer.from_file(alignment.FILE_A).encode(" " + text, add_special_tokens=False).ids
    assert out[0].n_a == len(reference) and out[0].n_links >= out[0].n_groups > 1
