"""Nodes of the brace scanner for all texts of an Arrow batch at once; runs inside tasks.

The rules are those of ``structure.brace_nodes``, on the bytes of the texts: each text is cut into
lexemes in one pass, levels, partners and orders come from running sums and sorts over the batch.
"""

from __future__ import annotations

import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: ``structure.LEXEME`` and ``LEADING_FILLER`` for bytes; where nothing follows, nothing is tried twice.
_LEXEME = (
    rb"[^{};()/\"']+|[{};()]|//[^\n]*|(?s:/\*.*?\*/)"
    rb"|\"[^\"\\\n]*+(?:\\[^\n][^\"\\\n]*+)*+\"|'[^'\\\n]*+(?:\\[^\n][^'\\\n]*+)*+'|[/\"']"
)
_FILLER = rb"(?:\s+|//[^\n]*|#[^\n]*|(?s:/\*.*?\*/))*"
# In the order of their names.
_TYPES = ["body", "definition", "file", "statement"]
_BODY, _DEFINITION, _FILE, _STATEMENT = range(4)


def _before(values, first):
    """The sum of the values ahead of each one in its text; ``first`` is the place of the text's first value."""
    sums = np.cumsum(values) - values
    return sums - sums[first]


def _first(text):
    return np.searchsorted(text, text)


def _found(texts: list[bytes], rows: int):
    """Text, start, depth, end and type of every node, in pre-order; places count from the first text's start."""
    findall, sizes, lengths = re.compile(_LEXEME).findall, [], []
    for one in texts:
        pieces = findall(one)
        lengths += map(len, pieces)
        sizes.append(len(pieces))
    joined = b"".join(texts)
    raw = np.frombuffer(joined, dtype=np.uint8)
    text_ends = np.cumsum([len(one) for one in texts], dtype=np.int64)
    text_starts = text_ends - [len(one) for one in texts]
    lengths = np.array(lengths, dtype=np.int64)
    places = np.cumsum(lengths) - lengths
    some = np.flatnonzero((lengths == 1) & np.isin(raw[places], np.frombuffer(b"{};()", dtype=np.uint8)))
    at, text = places[some], np.repeat(np.arange(rows), sizes)[some]
    token = raw[at]

    def steps(plus: bytes, minus: bytes):
        return (token == plus[0]).astype(np.int64) - (token == minus[0])

    nested = _before(steps(b"(", b")"), _first(text))
    kept = (token == ord("{")) | (token == ord("}")) | ((token == ord(";")) & (nested <= 0))
    at, text, token = at[kept], text[kept], token[kept]
    first = _first(text)
    level = _before(steps(b"{", b"}"), first)
    since = np.where(np.arange(len(at)) == first, text_starts[text], np.append(0, at + 1)[:-1])
    ends = token == ord(";")

    # At one level opens and closes alternate, so the partner of an open brace is its right neighbour.
    opens = token == ord("{")
    brace = np.flatnonzero(~ends)
    pair_level = level + opens
    brace = brace[np.lexsort((at[brace], pair_level[brace], text[brace]))]
    x, y = brace[:-1], brace[1:]
    paired = opens[x] & ~opens[y] & (text[x] == text[y]) & (pair_level[x] == pair_level[y])
    x, y = x[paired], y[paired]
    asked = np.append(np.flatnonzero(ends), x)
    filler = re.compile(_FILLER).match
    begins = np.array([filler(joined, s, e).end() for s, e in zip(since[asked].tolist(), at[asked].tolist())], dtype=np.int64)
    n = int(ends.sum())
    headed = begins[n:] < at[x]
    around = np.maximum(pair_level[x], 1)
    groups = [
        (np.arange(rows), text_starts, np.ones(rows, dtype=np.int64), text_ends, _FILE),
        (text[ends], begins[:n], np.maximum(level[ends], 0) * 2 + 2, at[ends] + 1, _STATEMENT),
        (text[x], at[x], around * 2 + 1, at[y] + 1, _BODY),
        (text[x[headed]], begins[n:][headed], around[headed] * 2, at[y[headed]] + 1, _DEFINITION),
    ]
    owner, start, depth, end = (np.concatenate([g[k] for g in groups]) for k in range(4))
    kind = np.repeat([g[4] for g in groups], [len(g[0]) for g in groups])
    order = np.lexsort((kind, end, depth, start, kind != _FILE, owner))
    owner = owner[order]
    return owner, start[order] - text_starts[owner], depth[order], end[order] - text_starts[owner], kind[order]


def nodes(texts: pa.Array) -> pa.Array:
    """A list of ``start_byte, depth, end_byte, type`` for every text, null for null."""
    missing = np.asarray(texts.is_null())
    owner, start, depth, end, kind = _found([one or b"" for one in texts.cast(pa.binary()).to_pylist()], len(texts))
    kinds = pa.DictionaryArray.from_arrays(pa.array(kind.astype(np.int32)), pa.array(_TYPES)).dictionary_decode()
    rows = pa.StructArray.from_arrays(
        [pa.array(start), pa.array(depth.astype(np.int32)), pa.array(end), kinds], ["start_byte", "depth", "end_byte", "type"]
    )
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), rows, mask=pa.array(missing))
