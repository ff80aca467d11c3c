"""Ids of texts and bytes as Arrow lists; runs inside tasks."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: No id is null; the type says so, as ``tokens.IDS`` does.
ID_LIST = pa.list_(pa.field("element", pa.int32(), nullable=False))


def lists(rows: list) -> pa.Array:
    """Arrays of 32-bit integers (or None) as one Arrow array of lists."""
    lengths = [0 if ids is None else len(ids) for ids in rows]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    found = [ids for ids in rows if ids is not None]
    values = pa.array(np.concatenate(found) if found else np.empty(0, dtype=np.int32))
    missing = pa.array([ids is None for ids in rows], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(offsets), values, type=ID_LIST, mask=missing)


def _laid_out(content: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow array of texts or bytes, and where each row starts and the last one ends."""
    wide = pa.types.is_large_string(content.type) or pa.types.is_large_binary(content.type)
    _, offsets, data = content.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[content.offset : content.offset + len(content) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, dtype=np.uint8)
    return raw, at.astype(np.int64) - at[0]


def _as_lists(values: np.ndarray, starts: np.ndarray, content: pa.Array) -> pa.Array:
    missing = content.is_null() if content.null_count else None
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values), type=ID_LIST, mask=missing)


def of_bytes(content: pa.Array) -> pa.Array:
    if not len(content):
        return lists([])
    raw, starts = _laid_out(content)
    return _as_lists(raw.astype(np.int32), starts, content)


def _apart(marks: list[bytes]) -> bool:
    """No two marker texts, nor two copies of one, can share a byte."""
    return all(
        a and (a is b or a not in b) and not any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b))))
        for a in marks
        for b in marks
    )


def _occurrences(raw: np.ndarray, starts: np.ndarray, mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the marker text stands inside a row, and in which."""
    at = np.flatnonzero(raw[: max(len(raw) - len(mark) + 1, 0)] == mark[0])
    for k in range(1, len(mark)):
        at = at[raw[at + k] == mark[k]]
    row = np.searchsorted(starts, at, side="right") - 1
    inside = at + len(mark) <= starts[row + 1]
    return at[inside], row[inside]


def text_encoder(replaced: list[tuple[str, str]]):
    """Texts to ids; ``replaced`` are marker texts, in their order, and the characters in their place."""
    marks = [(marker.encode(), ord(char)) for marker, char in replaced]
    # Then the order doesn't matter, and nothing that was replaced is part of a further marker text.
    plain = all(m.isascii() and i > 255 for m, i in marks) and _apart([m for m, _ in marks])

    def one(text):
        if text is None:
            return None
        chars = text.encode().decode("latin-1")
        for marker, char in replaced:
            chars = chars.replace(marker, char)
        return np.frombuffer(chars.encode("utf-32-le"), dtype=np.int32)

    def encode(texts: pa.Array) -> pa.Array:
        if not plain or not len(texts):
            return lists([one(t) for t in texts.to_pylist()])
        raw, starts = _laid_out(texts)
        ids, kept = raw.astype(np.int32), np.ones(len(raw), dtype=bool)
        gone = np.zeros(len(texts), dtype=np.int64)
        for mark, mark_id in marks:
            at, row = _occurrences(raw, starts, mark)
            ids[at] = mark_id
            for k in range(1, len(mark)):
                kept[at + k] = False
            gone += np.bincount(row, minlength=len(texts)) * (len(mark) - 1)
        return _as_lists(ids[kept], starts - np.concatenate([[0], np.cumsum(gone)]), texts)

    return encode
